"""Secret scanning: candidates by pattern, false positives removed by a random forest.

A candidate is a long run of key-like characters inside a word, or any value, of whatever length and
characters, that is assigned to a key word or stands as the password of an address. It ends with its word
at the latest. The forest sees its length, the make-up and
the changes of its character classes, how usual its letter pairs are and how much of it the corpus's own
dictionary covers, where it stands (path), and the words around it. It is trained on labelled findings and
scores every candidate. All steps are DataFrame operations and Spark's own forest; no Python runs on the
executors.

What depends on the value alone is computed once per distinct value, so a secret that very many documents
repeat costs one row there; the join back is an equi-join that the skew join can split.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstar.llm.common import sample_per_class
from ledgerstar.session import Scratch

CANDIDATE = r"[A-Za-z0-9+/_\-]{14,}={0,2}"
KEYS = "token|secret|passw|pwd|credential|bearer|auth|api_?key|access_?key|private_?key"
KEY_WORD = f"(?i){KEYS}"
# Every part that can repeat is bounded or cannot give back what it took, so a text is searched in time
# that grows with its length alone. A name goes on for 60 characters after its key word at most.
_REST = r"[\w.\-]{0,60}+"
_NAME = rf"(?:{KEYS}){_REST}[\"'`\])]{{0,2}}\s?(?::=|=>|={{1,3}}|:)"
_FOLLOWED = r"[&;,]\w{1,60}+[\"']?[=:]|[,;)}\]\"'`]{1,20}+(?:\s|$)"
# The lead and the value. A name that is assigned itself is no value: "auth: password: x" assigns x alone.
ASSIGNED = (
    rf"(?i)({_NAME}\s?(?![\"'`]?[\w.\-]{{0,60}}?{_NAME})[\"'`]?)"
    r"((?<=\")[^\s\"]++|(?<=')[^\s']++|(?<=`)[^\s`]++"
    rf"|(?<![\"'`])[^\s\"'`](?:(?!{_FOLLOWED})\S)*+)"
)
ADDRESS_PASSWORD = r"(://[^\s/:@]*:)([^\s/\"']+)(?=@)"
STAND_IN = r"(?i)example|sample|dummy|placeholder|changeme|xxxx|your[_-]"
TEST_PATH = r"(?i)test|example|sample|fixture|mock|docs?/"
CONFIG_PATH = r"(?i)\.(env|ya?ml|ini|cfg|conf|properties|toml|json)$"

FEATURES = (
    "length",
    "digit_share",
    "upper_share",
    "lower_share",
    "symbol_share",
    "class_changes",
    "letter_pairs",
    "dictionary_share",
    "alone_in_word",
    "key_word_near",
    "assigned",
    "quoted",
    "stand_in",
    "address_like",
    "test_path",
    "config_path",
    "path_length",
)
UNSEEN = math.log(40_960)
DICTIONARY_SHARE = 0.001


def _found(text: Column, form: str, skip: Column | int) -> Column:
    """``value, head`` of the matches of a form in a word: ``text`` is the word after ``skip`` characters."""
    leads = F.regexp_extract_all(text, F.lit(form), F.lit(1))
    values = F.regexp_extract_all(text, F.lit(form), F.lit(2))

    def one(lead: Column, value: Column) -> Column:
        at = F.call_function("instr", text, F.concat(lead, value)) - 1 + F.char_length(lead) - skip
        return F.struct(value.alias("value"), at.alias("at"))

    return F.filter(F.zip_with(leads, values, one), lambda x: x["at"] >= 0)


def candidates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", path: str = "source") -> DataFrame:
    """``doc_id, place, word, value, head, before, after, path``: every candidate with its neighbours.

    ``place`` numbers the words of the text from 0; a word may hold several candidates. ``head`` is what
    stands before the candidate in its word.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    holds = body.rlike(CANDIDATE) | body.rlike(ASSIGNED) | body.rlike(ADDRESS_PASSWORD)
    found = docs.filter(holds).select(
        F.col(doc_id).alias("doc_id"), F.col(path).cast("string").alias("path"), F.split(body, r"\s+").alias("words")
    )

    def occurrence(words: Column, word: Column, place: Column) -> Column:
        last = F.coalesce(F.get(words, place - 1), F.lit(""))
        before = F.concat_ws(" ", F.get(words, place - 2), F.get(words, place - 1))
        after = F.coalesce(F.get(words, place + 1), F.lit(""))
        hit = F.struct(place.alias("place"), word.alias("word"), before.alias("before"), after.alias("after"))
        sign = word.contains("=") | word.contains(":") | last.contains("=") | last.contains(":")
        return F.when(word.rlike(CANDIDATE) | sign, hit)

    # The words are a variable here, so that a text is cut once and not for each of its words.
    each = F.transform(F.array("words"), lambda words: F.transform(words, lambda w, i: occurrence(words, w, i)))
    hits = found.select("doc_id", "path", F.array_compact(F.flatten(each)).alias("hits"))
    rows = hits.select("doc_id", "path", F.explode("hits").alias("hit")).select("doc_id", "path", "hit.*")
    # The words that the name and its sign can stand in: both before, the last one, or the word alone.
    last = F.call_function("substring_index", F.col("before"), F.lit(" "), F.lit(-1))
    lead = (
        F.when(last.rlike(r"^(:=|=>|={1,3}|:)[\"'`]?$"), F.concat("before", F.lit(" ")))
        .when(last.rlike(r"[=:>][\"'`]?$") | F.col("word").rlike("^[=:]"), F.concat(last, F.lit(" ")))
        .otherwise("")
    )
    rows = rows.withColumn("lead", lead)
    long = F.array_distinct(F.regexp_extract_all("word", F.lit(CANDIDATE), F.lit(0)))
    rows = rows.withColumn("long", long)
    assigned = _found(F.concat("lead", "word"), ASSIGNED, F.char_length("lead"))
    password = _found(F.col("word"), ADDRESS_PASSWORD, 0)
    others = F.filter(F.array_union(assigned, password), lambda x: ~F.array_contains(F.col("long"), x["value"]))
    first = F.transform(
        "long", lambda v: F.struct(v.alias("value"), (F.call_function("instr", F.col("word"), v) - 1).alias("at"))
    )
    one = rows.withColumn("one", F.explode(F.concat(first, others)))
    head = F.substring(F.col("word"), F.lit(1), F.col("one.at"))
    return one.select("doc_id", "path", "place", "word", "before", "after", F.col("one.value").alias("value"), head.alias("head"))


def dictionary(docs: DataFrame, least_documents: int = 20, text: str = "text") -> DataFrame:
    """``word, documents``: lower-cased runs of three to twenty letters in at least so many different texts,
    and in at least ``DICTIONARY_SHARE`` of them."""
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("body"))
    n_texts = texts.agg(F.count_distinct(F.xxhash64("body"))).first()[0]
    floor = max(least_documents, math.ceil(DICTIONARY_SHARE * n_texts))
    words = F.array_distinct(F.regexp_extract_all(F.lower("body"), F.lit(r"\p{L}{3,}"), F.lit(0)))
    counts = texts.distinct().select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("documents"))
    return counts.filter((F.col("documents") >= floor) & (F.char_length("word") <= 20))


def letter_pairs(words: DataFrame) -> DataFrame:
    """``pair, surprise`` of the pairs of letters a to z, which are those of a long run, in a dictionary."""
    pairs = F.transform(F.sequence(F.lit(1), F.char_length("word") - 1), lambda i: F.substring("word", i, F.lit(2)))
    every = words.select(F.explode(pairs).alias("pair"), "documents").filter(F.col("pair").rlike("^[a-z]{2}$"))
    counts = every.groupBy("pair").agg(F.sum("documents").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 1
    return counts.select("pair", (-F.log(F.col("n") / total)).alias("surprise"))


def _share(value: Column, pattern: str) -> Column:
    return F.regexp_count(value, F.lit(pattern)) / F.char_length(value)


def value_features(values: DataFrame, words: DataFrame, pairs: DataFrame) -> DataFrame:
    """Features of distinct ``value`` rows that depend on the value alone."""
    value = F.col("value")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "0")
    base = values.select(
        "value",
        F.char_length(value).cast("double").alias("length"),
        _share(value, "[0-9]").alias("digit_share"),
        _share(value, "[A-Z]").alias("upper_share"),
        _share(value, "[a-z]").alias("lower_share"),
        _share(value, "[^A-Za-z0-9]").alias("symbol_share"),
        ((F.char_length(kinds) - 1) / F.greatest(F.char_length(value) - 1, F.lit(1))).alias("class_changes"),
    )
    lowered = F.lower(value)
    places = F.when(F.char_length(value) > 1, F.sequence(F.lit(1), F.char_length(value) - 1))
    of_pairs = F.transform(places, lambda i: F.substring(lowered, i, F.lit(2)))
    # The pair table has 26 times 26 rows at most, whatever the corpus.
    surprise = (
        values.select("value", F.explode(of_pairs).alias("pair"))
        .join(F.broadcast(pairs), "pair", "left")
        .groupBy("value")
        .agg(F.avg(F.coalesce("surprise", F.lit(UNSEEN))).alias("letter_pairs"))
    )
    runs = F.regexp_extract_all(lowered, F.lit(r"\p{L}{3,}"), F.lit(0))
    covered = (
        values.select("value", F.explode(runs).alias("word"))
        .join(words.select("word"), "word")
        .groupBy("value")
        .agg(F.sum(F.char_length("word")).alias("covered"))
    )
    joined = base.join(surprise, "value", "left").join(covered, "value", "left")
    return joined.withColumns(
        {
            "letter_pairs": F.coalesce("letter_pairs", F.lit(UNSEEN)),
            "dictionary_share": F.coalesce("covered", F.lit(0)) / F.col("length"),
        }
    ).drop("covered")


def _tail() -> Column:
    """What stands after the candidate in its word, 40 characters of it."""
    return F.substring(F.col("word"), F.char_length("head") + F.char_length("value") + 1, F.lit(40))


def with_context(rows: DataFrame) -> DataFrame:
    """Features of a candidate's place: the rest of its word, its neighbours and its path."""
    head, tail = F.col("head"), _tail()
    near = F.concat_ws(" ", F.col("before"), head)
    path = F.coalesce(F.col("path"), F.lit(""))
    flags = {
        "alone_in_word": F.col("word") == F.col("value"),
        "key_word_near": near.rlike(KEY_WORD),
        "assigned": near.rlike(r"[=:]\s*[\"']?$"),
        "quoted": head.rlike(r"[\"']$") & tail.rlike(r"^[\"']"),
        "stand_in": F.concat_ws(" ", near, F.col("value"), F.col("after")).rlike(STAND_IN),
        "address_like": F.col("word").rlike(r"@|://|^\d+(\.\d+){3}"),
        "test_path": path.rlike(TEST_PATH),
        "config_path": path.rlike(CONFIG_PATH),
    }
    columns = {name: flag.cast("double") for name, flag in flags.items()}
    return rows.withColumns({**columns, "path_length": F.char_length(path).cast("double")})


def labels_by_format(rows: DataFrame) -> DataFrame:
    """Findings whose label their format settles, as ``label``; the others are left out.

    Secrets: an access key id of fixed form, or a hexadecimal or mixed value assigned to a name that says
    so, or a shorter one of three kinds of characters that is so assigned or the password of an address.
    Not secrets: values of letters only or of digits only, and other parts of addresses.
    """
    value, word = F.col("value"), F.col("word")
    near = F.concat_ws(" ", F.col("before"), F.col("head"))
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.char_length(value) >= 16)
    assigned = near.rlike(KEY_WORD) & near.rlike(r"[=:]\s*[\"']?$") & ~near.rlike(STAND_IN)
    password = F.col("head").rlike(r"://[^\s/:@]*:$") & _tail().startswith("@") & ~near.rlike(STAND_IN)
    kinds = sum(value.rlike(kind).cast("int") for kind in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    short = (kinds >= 3) & (F.char_length(value) >= 8)
    plain = value.rlike(r"^([A-Za-z]+|[0-9]+)$") | (word.rlike(r"@|://") & ~assigned & ~password)
    settled = value.rlike("^AKIA[0-9A-Z]{16}$") | (mixed & assigned) | (short & (assigned | password))
    label = F.when(settled, 1).when(plain, 0)
    return rows.withColumn("label", label).filter(F.col("label").isNotNull())


def fit(labelled: DataFrame, rows_per_class: int = 4000, trees: int = 40, depth: int = 8, seed: int = 11):
    """A forest over at most ``rows_per_class`` findings of each ``label``; None without both labels."""
    sample = sample_per_class(labelled, "label", rows_per_class, 2, "doc_id", "place", "value")
    sample = sample.select(*FEATURES, F.col("label").cast("double").alias("label"))
    seen = {r[0] for r in sample.select("label").distinct().collect()}
    if seen != {0.0, 1.0}:
        return None
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
    forest = RandomForestClassifier(
        featuresCol="_features", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt"
    )
    return forest.fit(assembler.transform(sample))


def scan(
    docs: DataFrame,
    labelled=labels_by_format,
    least_documents: int = 20,
    text: str = "text",
    doc_id: str = "doc_id",
    path: str = "source",
) -> DataFrame:
    """``doc_id, place, value, path``, the features, ``score`` and ``is_secret`` of every candidate.

    ``labelled`` takes the candidates and returns labelled ones: rows with ``label`` 0 or 1. Without both
    labels there is no forest; every score is then 0.5 and everything stays a finding. NULL texts hold no
    candidate, a NULL path counts as empty, repeated rows come out repeated.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.store(candidates(docs, text, doc_id, path), "candidates")
    words = scratch.store(dictionary(docs, least_documents, text), "dictionary")
    pairs = scratch.store(letter_pairs(words), "pairs")
    values = scratch.store(value_features(rows.select("value").distinct(), words, pairs), "values")
    described = scratch.store(with_context(rows).join(values, "value"), "described")
    forest = fit(labelled(described))
    columns = ["doc_id", "place", "value", "path", *FEATURES]
    if forest is None:
        return described.select(*columns, F.lit(0.5).alias("score"), F.lit(True).alias("is_secret"))
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
    judged = forest.transform(assembler.transform(described))
    score = F.get(vector_to_array("probability"), 1)
    return judged.select(*columns, score.alias("score")).withColumn("is_secret", F.col("score") >= 0.5)

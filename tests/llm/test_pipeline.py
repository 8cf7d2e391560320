"""The pipeline's stages against plain versions, and the queries with SQL against that SQL."""

from __future__ import annotations

from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_line_dedup import plain_drop
from test_simhash import plain_fingerprint, plain_groups
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerstar.llm import language, mixing, queries
from ledgerstar.sources.tables import table

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What goes into each stage and comes out of it, over the smallest documents."""
    folder = tmp_path_factory.mktemp("steps")
    docs = table(spark, SMALL, "documents")
    out = {"documents": docs}
    for name, stage in STAGES.items():
        path = str(folder / name)
        stage(spark, docs, SMALL).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return {name: df.toPandas() for name, df in out.items()}


def test_language_stage_keeps_what_the_model_explains(spark, steps):
    model = language.fit(table(spark, SMALL, "documents"))
    docs = steps["documents"]
    judged = language.classify(model, docs["text"].tolist())
    kept = docs[(judged["lang_pred"] != "und") & (judged["explained"] >= 0.25)]
    assert sorted(steps["language ID"]["doc_id"]) == sorted(kept["doc_id"])
    assert len(kept) >= 0.98 * len(docs)


def test_line_stage(steps):
    before, after = steps["language ID"], steps["line dedup"]
    expected = {i: t for i, t, _, _ in plain_drop(list(zip(before["doc_id"], before["text"], strict=True)), 10, 1)}
    assert dict(zip(after["doc_id"], after["text"], strict=True)) == expected
    assert (after["n_chars"] == after["text"].str.len()).all()
    assert list(after.columns) == list(before.columns)


def test_near_duplicate_stage(steps):
    before = steps["line dedup"].sort_values("doc_id").reset_index(drop=True)
    roots = plain_groups([plain_fingerprint(t) for t in before["text"]])
    assert sorted(steps["SimHash near-dedup"]["doc_id"]) == sorted(before["doc_id"][i] for i in set(roots))


def test_mixing_stage(spark, steps):
    before, after = steps["SimHash near-dedup"], steps["mixing sources to target weights"]
    tokens = before["text"].str.split().str.len().to_numpy(dtype=float)
    frame = spark.createDataFrame(before[["doc_id", "text"]])
    topic = frame.select("doc_id", mixing.topic_of(F.col("text"), queries.TOPICS, "prose").alias("topic")).toPandas()
    labels = before.merge(topic, on="doc_id")
    places, sides = [], []
    for margin in queries.MIXTURE:
        names = list(margin.weights)
        places.append(labels[margin.column].map(lambda v, names=names: names.index(v) if v in names else len(names)))
        sides.append(len(names) + 1)
    cell = np.ravel_multi_index([p.to_numpy() for p in places], sides)
    cube = np.bincount(cell, weights=tokens, minlength=int(np.prod(sides)))
    shaped = cube.reshape(sides)
    targets = mixing._targets(shaped, queries.MIXTURE)
    weights = np.divide(mixing.rake(shaped, targets), shaped, out=np.ones_like(shaped), where=shaped > 0)
    chances = mixing.rake_probabilities(shaped, weights, targets, queries.TOKEN_BUDGET).ravel()
    draw = frame.select("doc_id", mixing.unit_hash(F.lit("mixing"), F.col("doc_id")).alias("draw")).toPandas()
    kept = labels.merge(draw, on="doc_id")["draw"].to_numpy() < chances[cell]
    assert sorted(after["doc_id"]) == sorted(before["doc_id"][kept])


def test_packing_stage(steps):
    before, after = steps["mixing sources to target weights"], steps["best-fit packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(queries.VOCABULARY))
    tokenizer.encode_special_tokens = True
    sizes = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in zip(before["doc_id"], before["text"], strict=True)}
    assert after.groupby("doc_id")["length"].sum().to_dict() == sizes
    assert (after.groupby("sequence_id")["length"].sum() <= 1024).all()
    used, least = after["sequence_id"].nunique(), -(-sum(sizes.values()) // 1024)
    assert used <= 1.1 * least + 2


def test_run_equals_the_stages_one_by_one(spark, steps):
    rows = corpus_pipeline.run(spark, SMALL).toPandas()
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    ordered = lambda df: df[keys].sort_values(keys).reset_index(drop=True)
    assert ordered(rows).equals(ordered(steps["best-fit packing"]))


@pytest.mark.parametrize("name", list(STAGES))
def test_awkward_documents(spark, name):
    """NULLs in every column, repeated rows, and columns named like the operators' own."""
    words = "the cat sat on the mat and looked at the dog that slept by the door"
    rows = [
        (i, f"{words} number {i} " + "x" * i, "en", "src1", 9, "keep", 1.5) for i in range(20)
    ] + [
        (20, None, None, None, None, None, None), (21, "", "en", "src1", 0, "keep", 1.5),
        (None, f"{words} again", "en", "src1", 9, "keep", 1.5), (22, words * 3000, "en", None, 9, "keep", 1.5),
        (23, f"{words} twice", "en", "src2", 9, "keep", 1.5), (23, f"{words} twice", "en", "src2", 9, "keep", 1.5),
        (24, "shared\n" * 3 + words, "en", "src2", 9, "keep", 1.5),
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, score double"
    names = {"kept": "n_lines", "score": "fp"}
    docs = spark.createDataFrame(rows, schema).withColumns(
        {"weight": F.lit("w"), "topic": F.lit("t"), "_row": F.lit("r"), "_judged": F.lit("j"), "_mark": F.lit("m")}
    )
    for frame in (docs, docs.withColumnsRenamed(names)):
        out = STAGES[name](spark, frame, "")
        assert out.count() > 0
        if name != "best-fit packing":
            assert out.columns == frame.columns
            extra = [c for c in frame.columns if c not in ("doc_id", "text", "n_chars", "lang", "source")]
            assert out.select(*extra).exceptAll(frame.select(*extra)).count() == 0
    assert STAGES[name](spark, docs.limit(0), "").count() == 0


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in Path(MEDIUM).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, oracle, name):
    got = queries.QUERIES[name](spark, MEDIUM)
    result = oracle.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    expected = sorted(tuple(map(str, r)) for r in result.fetchall())
    assert sorted(tuple(map(str, r)) for r in got.select(*columns).collect()) == expected
    assert sorted(columns) == sorted(got.columns)

"""One named query for each operator, over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar.llm import (
    divergence,
    exact_dedup,
    language,
    line_dedup,
    mixing,
    packing,
    quality,
    repeats,
    rotated_clusters,
    secret_scan,
    simhash,
    toxicity,
    vector_dedup,
)
from ledgerstar.llm.common import is_remainder
from ledgerstar.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = "byte_bpe_50k.json"

TOPICS = (
    mixing.Topic("licence", r"(?i)licen[sc]ed under|copyright"),
    mixing.Topic("contact", r"\w@\w+\.|\(\d{3}\) \d{3}-\d{4}"),
    mixing.Topic("tabular", r" \| "),
)

MIXTURE = (
    mixing.Margin("source", {f"src{i}": 1.0 for i in range(20)}),
    mixing.Margin("lang", {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}),
    mixing.Margin("topic", {"prose": 0.85, "licence": 0.05, "contact": 0.05, "tabular": 0.05}),
)

TOKEN_BUDGET = 0.5

PREDICTED_FROM = 0.3


def mixed(docs: DataFrame) -> DataFrame:
    """``docs`` weighed for the production mixture, with their topics."""
    with_topic = docs.withColumn("topic", mixing.topic_of(F.col("text"), TOPICS, "prose"))
    return mixing.mix(with_topic, MIXTURE, TOKEN_BUDGET, mixing.word_count(F.col("text")))


def packed(docs: DataFrame) -> DataFrame:
    """Pieces of ``docs`` in sequences of 1024 tokens, by their digests."""
    pieces = packing.packed_pieces(
        docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, with_ids=False, special_ids=True
    )
    return pieces.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return mixed(docs).drop("text")


def learnable(spark: SparkSession, sf_dir: str, held_out: Column) -> DataFrame:
    """Labels that may be learned from."""
    return table(spark, sf_dir, "labels").filter(F.col("doc_id").isNotNull() & ~held_out)


def scored(docs: DataFrame, held_out: Column, score: Column) -> DataFrame:
    judged = docs.select("doc_id", held_out.alias("held_out"), score.alias("score"))
    return judged.withColumn("predicted", F.when(F.col("score") >= PREDICTED_FROM, 1).otherwise(0))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = is_remainder(F.col("doc_id"), 4, 2)
    model = toxicity.fit(docs, learnable(spark, sf_dir, held_out))
    return scored(docs, held_out, toxicity.toxicity_of(model, F.col("text"), spark))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = is_remainder(F.col("doc_id"), 5, 0)
    model = quality.fit(docs, learnable(spark, sf_dir, held_out))
    return scored(docs, held_out, quality.quality_of(model, F.col("text"), spark))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    groups = simhash.near_duplicate_groups(docs, width=4, max_bits=4)
    fingerprint = simhash.hex_digits(F.col("fingerprint"))
    return groups.select("doc_id", fingerprint.alias("fingerprint"), "component_id")


def op5_vector_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = is_remainder(F.col("doc_id"), 4, 2)
    model = language.fit(docs.filter(F.col("doc_id").isNotNull() & ~held_out))
    judged = language.identify(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.keep_one_of_each(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.lower(F.hex("digest"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", digest.alias("text_sha256"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    digest = F.sha2("value", 256)
    return found.select("doc_id", "place", digest.alias("value_sha256"), *secret_scan.FEATURES, "score", "is_secret")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.drop_common_lines(docs, min_docs=10, min_chars=1)
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return kept.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.drop_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), window=50)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("lang", "source", "text")
    return divergence.source_divergence(docs, min_docs=3, top_terms=200)


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    placed = rotated_clusters.cluster(vectors, clusters=8, rounds=10, dims=64, scale=1024, salt="3:")
    joined = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return placed.withColumn("centroid_sha256", F.sha2(joined, 256)).drop("centroid")


QUERIES: dict[str, Query] = {
    "op1_source_mixing": op1_source_mixing,
    "op2_toxicity": op2_toxicity,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_quality": op4_quality,
    "op5_vector_near_dedup": op5_vector_near_dedup,
    "op6_language_id": op6_language_id,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_secret_scan": op9_secret_scan,
    "op10_line_dedup": op10_line_dedup,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_source_divergence": op12_source_divergence,
    "op13_centroid_clustering": op13_centroid_clustering,
}


def _clustering_sql(clusters: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, salt: str = "3:") -> str:
    """All rounds written out: assign every vector, then move every centroid that has any."""
    parts = [
        f"""whole AS MATERIALIZED (
            SELECT vec_id, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
            FROM embeddings
            WHERE len(embedding) = {dims}
              AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = {dims}
        )""",
        f"""centroids0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('{salt}' || vec_id), v) - 1 AS number, v FROM whole
            ORDER BY sha256('{salt}' || vec_id), v LIMIT {clusters}
        )""",
    ]
    for turn in range(rounds + 1):
        parts.append(
            f"""placed{turn} AS MATERIALIZED (
            SELECT vec_id, any_value(v) AS v, min(near).number AS number, min(near).distance AS distance
            FROM (
                SELECT w.vec_id, w.v, struct_pack(
                    distance := CAST(list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(w.v, c.v)]) AS BIGINT),
                    number := c.number) AS near
                FROM whole w CROSS JOIN centroids{turn} c
            ) GROUP BY vec_id
        )"""
        )
        if turn < rounds:
            parts.append(
                f"""centroids{turn + 1} AS MATERIALIZED (
            SELECT c.number, coalesce(m.v, c.v) AS v
            FROM centroids{turn} c LEFT JOIN (
                SELECT number, list((total - ((total % n) + n) % n) // n ORDER BY place) AS v
                FROM (
                    SELECT number, place, CAST(sum(x) AS BIGINT) AS total, count(*) AS n
                    FROM (SELECT number, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM placed{turn})
                    GROUP BY number, place
                ) GROUP BY number
            ) m ON m.number = c.number
        )"""
            )
    return f"""WITH {", ".join(parts)}
        SELECT p.vec_id, CAST(p.number AS INTEGER) AS "cluster", p.distance,
               CAST(sum(p.distance) OVER (PARTITION BY p.number) AS BIGINT) AS cluster_inertia,
               CAST(sum(p.distance) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(c.v, ',')) AS centroid_sha256
        FROM placed{rounds} p JOIN centroids{rounds} c ON c.number = p.number"""


ORACLE_SQL: dict[str, str] = {
    "op8_exact_dedup": """
        WITH normal AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz') AS body
            FROM documents
        )
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY body) AS keep_id,
               count(*) OVER (PARTITION BY body) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY body) AS kept,
               sha256(body) AS text_sha256
        FROM normal
    """,
    "op10_line_dedup": """
        WITH cut AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
        ),
        lines AS (
            SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place FROM cut
        ),
        keyed AS (
            SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS key
            FROM lines
        ),
        common AS (
            SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
        ),
        judged AS (
            SELECT k.*, c.key IS NOT NULL AS dropped FROM keyed k LEFT JOIN common c ON k.key = c.key
        )
        SELECT doc_id,
               count(*) AS n_lines,
               CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), ''))
                   AS kept_sha256
        FROM judged GROUP BY doc_id
    """,
    "op11_substring_dedup": r"""
        WITH cut AS (
            SELECT doc_id, [x for x in string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> ''] AS w
            FROM documents
        ),
        windows AS (
            SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS key
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM cut WHERE len(w) >= 50)
        ),
        least AS (SELECT key, min(doc_id) AS first_doc FROM windows GROUP BY key),
        covered AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS place
            FROM windows JOIN least USING (key) WHERE doc_id > first_doc
        ),
        words AS (
            SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM cut
        ),
        judged AS (
            SELECT w.*, c.place IS NOT NULL AS gone
            FROM words w LEFT JOIN covered c ON c.doc_id = w.doc_id AND c.place = w.place
        ),
        counted AS (
            SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed,
                   string_agg(word, ' ' ORDER BY place) FILTER (WHERE NOT gone) AS kept
            FROM judged GROUP BY doc_id
        )
        SELECT c.doc_id, CAST(len(c.w) AS BIGINT) AS n_words,
               CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM cut c LEFT JOIN counted k ON k.doc_id = c.doc_id
    """,
    "op12_source_divergence": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
            FROM documents
        ),
        words AS (
            SELECT r, lang, source, unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
        ),
        kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
        langs AS (SELECT lang, sum(n) AS n, count(*) AS v FROM kept GROUP BY lang),
        cells AS (
            SELECT w.lang, w.source, w.term, count(*) AS n
            FROM words w JOIN kept k ON k.lang = w.lang AND k.term = w.term GROUP BY w.lang, w.source, w.term
        ),
        sizes AS (
            SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n
            FROM (SELECT DISTINCT lang, source FROM docs) g
            LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source GROUP BY g.lang, g.source
        ),
        shares AS (
            SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
                   1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (s.n + l.v) AS p,
                   1 + (1000000000::HUGEINT * (k.n + 1)) // (l.n + l.v) AS q
            FROM sizes s JOIN langs l ON l.lang = s.lang JOIN kept k ON k.lang = s.lang
            LEFT JOIN cells c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
        ),
        pairs AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
            FROM shares a JOIN shares b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source
            GROUP BY a.lang, a.source, b.source
        ),
        parts AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
            FROM sizes a JOIN sizes b ON b.lang = a.lang AND b.source <> a.source
            LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q
        ),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM parts
        )
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank
        FROM ranked WHERE part = 'pair' OR place <= 200
    """,
    "op13_centroid_clustering": _clustering_sql(),
}

"""Documents to packed training sequences, in stages that each call one operator of the library.

Every stage takes (spark, docs, sf_dir), works on all of its predecessor's rows and returns the columns of
``docs``; only the last one returns pieces of packed sequences. Operators see the columns they need, with
the whole row beside them, so other columns of any name pass through untouched. In each stage: a NULL or
empty text goes with language ID, as do texts without letters; rows that repeat an id stay or go together
in near-dedup and mixing; a table without rows stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar.contracts import exact
from ledgerstar.llm import language, line_dedup, queries, simhash
from ledgerstar.session import Scratch
from ledgerstar.sources.tables import table

ROW = "_row"


def with_row(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns, and the whole row as one column."""
    return docs.select(F.struct(*[exact(c) for c in docs.columns]).alias(ROW), *columns)


def rows_of(held: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The whole rows again, with some of their columns changed."""
    return held.select(*[changed.get(c, F.col(ROW).getField(c)).alias(c) for c in docs.columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language of the labelled text; the others go."""
    model = language.fit(docs)
    return rows_of(language.accepted(with_row(docs, "text"), model), docs)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share; ``n_chars`` follows the text."""
    kept = line_dedup.drop_common_lines(with_row(docs, "doc_id", "text"), min_docs=10, min_chars=1)
    n_chars = F.char_length("text").cast("long")
    return rows_of(kept, docs, text=F.col("text"), n_chars=n_chars)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one of the least id."""
    return simhash.one_of_each_group(docs, width=4, max_bits=4).select(*[exact(c) for c in docs.columns])


def sample_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the raked sample keeps."""
    weighed = queries.mixed(with_row(docs, "doc_id", "text", "source", "lang"))
    return rows_of(weighed.filter("kept"), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in training sequences."""
    return queries.packed(docs)


STAGES = [
    ("language ID", identify_language),
    ("line dedup", drop_common_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("mixing sources to target weights", sample_mixture),
    ("best-fit packing", pack_sequences),
]

# Suffix automata and hashes of shingles have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written and read again for the next."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = scratch.store(stage(spark, docs, sf_dir), f"stage-{place}")
    return docs

"""Removal of lines that many documents share, over levelled sorted runs of line hashes.

The index holds two kinds of runs, each a Parquet table sorted by hash within its files: counting runs
of ``(line, n_docs)`` for lines not yet known to be common, and runs of common lines. A batch of documents
is first merge-anti-joined with the common runs, so a line that is settled is never counted again; what
is left becomes a counting run of level 0. As soon as a level holds ``fanout`` runs they are merged into
one run of the next level, and lines that reached ``min_docs`` documents move to a common run. A batch
therefore costs its own size plus its share of the merges, not the size of the index per batch.

A line's key is the line without white space at both ends and with A-Z lower-cased; its hash is the
128-bit MD5 of that key. NULL texts count as empty; an empty key is never common.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar.llm.common import ASCII_SPACE, ascii_lower
from ledgerstar.session import Scratch

RUN = "line binary, n_docs bigint"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.btrim(ascii_lower(line), F.lit(ASCII_SPACE))


def _digest(key: Column) -> Column:
    return F.unhex(F.md5(key))


def _row_mark(doc_id: Column, text: Column) -> Column:
    """What finds a document's row again. Rows that share a mark share their set of common lines."""
    return F.xxhash64(doc_id, text)


def document_lines(
    docs: DataFrame, min_chars: int = 1, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``mark, line``: each distinct line key of each document once."""
    keys = F.transform(lines_of(F.col(text)), line_key)
    long_enough = F.filter(keys, lambda k: F.char_length(k) >= min_chars)
    digests = F.array_distinct(F.transform(long_enough, _digest))
    return docs.select(
        _row_mark(F.col(doc_id), F.col(text)).alias("mark"), F.explode(digests).alias("line")
    )


class LineRuns:
    """The index: ``counting[level]`` and ``common[level]`` list the paths of its runs."""

    def __init__(self, spark: SparkSession, scratch: Scratch, min_docs: int = 10, fanout: int = 4):
        self.spark, self.scratch = spark, scratch
        self.min_docs, self.fanout = min_docs, fanout
        self.counting: list[list[str]] = [[]]
        self.common: list[list[str]] = [[]]
        self._written = 0

    def _write(self, rows: DataFrame) -> str:
        self._written += 1
        path = self.scratch.path(f"run-{self._written:05d}")
        rows.sortWithinPartitions("line").write.parquet(path)
        return path

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(RUN).parquet(*paths)

    def add(self, document_lines: DataFrame) -> None:
        """Add one batch; every document belongs to exactly one batch."""
        settled = [p for level in self.common for p in level]
        fresh = document_lines.select("line")
        if settled:
            fresh = reduce(
                lambda rows, path: rows.join(self._read([path]).hint("merge"), "line", "left_anti"),
                settled,
                fresh.groupBy("line").agg(F.count(F.lit(1)).alias("n_docs")),
            )
        else:
            fresh = fresh.groupBy("line").agg(F.count(F.lit(1)).alias("n_docs"))
        self.counting[0].append(self._write(fresh))
        level = 0
        while len(self.counting[level]) >= self.fanout:
            self._compact(level)
            level += 1

    def _compact(self, level: int) -> None:
        """Merge the runs of one level into one of the next, and move common lines out."""
        merged = self.scratch.store(
            self._read(self.counting[level]).groupBy("line").agg(F.sum("n_docs").alias("n_docs")),
            f"merge-{self._written:05d}",
        )
        if len(self.counting) == level + 1:
            self.counting.append([])
        self.counting[level] = []
        self.counting[level + 1].append(self._write(merged.filter(F.col("n_docs") < self.min_docs)))
        self._add_common(merged.filter(F.col("n_docs") >= self.min_docs))

    def _add_common(self, lines: DataFrame) -> None:
        self.common[0].append(self._write(lines))
        for level in range(len(self.common)):
            if len(self.common[level]) < self.fanout:
                break
            if len(self.common) == level + 1:
                self.common.append([])
            # A line settles once, so runs of common lines are disjoint.
            self.common[level + 1].append(self._write(self._read(self.common[level])))
            self.common[level] = []

    def common_lines(self) -> DataFrame:
        """Every line in at least ``min_docs`` documents of all batches so far.

        The counting runs of all levels are merged for the answer and stay as they are.
        """
        parts = []
        counting = [p for level in self.counting for p in level]
        if counting:
            totals = self._read(counting).groupBy("line").agg(F.sum("n_docs").alias("n_docs"))
            parts.append(totals.filter(F.col("n_docs") >= self.min_docs).select("line"))
        parts += [self._read([p]).select("line") for level in self.common for p in level]
        if not parts:
            return self.spark.createDataFrame([], "line binary")
        return reduce(DataFrame.union, parts)


def drop_common_lines(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    batches: int = 6,
    fanout: int = 3,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """``docs`` without the lines whose key occurs in ``min_docs`` documents, with ``n_lines`` (before)
    and ``n_dropped``; columns of these names are replaced.

    Documents are dealt into ``batches`` by a hash and enter the index batch by batch; after ``fanout`` of them
    the first compaction settles lines, and every later batch is anti-joined with those. A very common line
    is folded by the partial aggregates, and the join that finds a document's common lines is an
    equi-join that the skew join splits. Rows are documents; repeated rows count each by itself. A NULL
    text stays NULL where nothing is dropped.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    dealt = document_lines(docs, min_chars, text, doc_id).withColumn(
        "batch", F.pmod(F.xxhash64("mark"), F.lit(batches)).cast("int")
    )
    path = scratch.path("lines")
    dealt.write.partitionBy("batch").parquet(path)
    found = spark.read.schema("mark bigint, line binary, batch int").parquet(path)
    runs = LineRuns(spark, scratch, min_docs, fanout)
    for batch in range(batches):
        runs.add(found.filter(F.col("batch") == batch))
    hits = found.join(runs.common_lines().hint("merge"), "line")
    per_row = scratch.store(
        hits.groupBy("mark").agg(F.collect_set("line").alias("_common")), "common-of-documents"
    )

    kept_columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "_common", "_mark")]
    marked = docs.select(*kept_columns, _row_mark(F.col(doc_id), F.col(text)).alias("_mark"))
    # The same plan at every size: a table of this kind that is small today is large tomorrow.
    joined = marked.join(per_row.withColumnRenamed("mark", "_mark").hint("merge"), "_mark", "left")
    common = F.col("_common")
    lines = lines_of(F.col(text))

    def stays(line: Column) -> Column:
        key = line_key(line)
        return (F.char_length(key) < min_chars) | ~F.array_contains(common, _digest(key))

    kept = F.filter(lines, stays)
    hit = common.isNotNull()
    text_out = F.when(hit, F.array_join(kept, "\n")).otherwise(F.col(text))
    n_lines = F.size(lines).cast("long")
    n_dropped = F.when(hit, n_lines - F.size(kept)).otherwise(F.lit(0)).cast("long")
    counted = joined.withColumns({"n_lines": n_lines, "n_dropped": n_dropped, "_kept": text_out})
    return counted.select(
        *[F.col("_kept").alias(c) if c == text else F.col(c) for c in kept_columns], "n_lines", "n_dropped"
    )

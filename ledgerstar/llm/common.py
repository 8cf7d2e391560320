"""Expressions and small helpers that several operators of this subpackage use."""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

ORDERED_CLASSES = 4
ASCII_SPACE = "\t\n\x0b\x0c\r "


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z alone lower-cased; pure ASCII takes the faster general function."""
    plain = F.char_length(text) == F.octet_length(text)
    mapped = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(plain, F.lower(text)).otherwise(mapped)


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id's decimal text modulo ``divisor``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def is_remainder(doc_id: Column, divisor: int, value: int) -> Column:
    return F.coalesce(id_remainder(doc_id, divisor) == value, F.lit(False))


def unit_hash(*cols: Column) -> Column:
    """A number in [0, 1) that depends on the values alone."""
    top = F.shiftrightunsigned(F.xxhash64(*cols), 11)
    return top.cast("double") / float(1 << 53)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, text: str, key: str
) -> tuple[DataFrame, dict[int, int]]:
    """``key, y, text`` of at most ``per_class`` rows of either 0 or 1 label, and the labels' counts.

    Keys are chosen among the labels, before any text is read; as their number is bounded by
    ``per_class``, they go to the texts in a broadcast and no text is shuffled. Where a key has several
    texts or several labels, the bound holds for the rows all the same: rows of the chosen keys are taken in
    the order of a hash, and rows that repeat a key, label and text count once. NULL texts count as empty.
    """
    usable = labels.filter(F.col(label).isin(0, 1)).select(F.col(key).alias("key"), F.col(label).cast("int").alias("y"))
    counts = {r[0]: r[1] for r in usable.groupBy("y").count().collect()}
    chosen = sample_per_class(usable.distinct(), "y", per_class, 2, "key")
    texts = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    met = texts.join(F.broadcast(chosen), "key").withColumn("digest", F.xxhash64("text"))
    row = ["key", "y", "digest"]
    picked = sample_per_class(met.select(*row).distinct(), "y", per_class, 2, "key", "digest")
    return met.join(F.broadcast(picked), row, "left_semi").dropDuplicates(row).drop("digest"), counts


def sample_per_class(df: DataFrame, label: str, per_class: int, max_classes: int, *key: str) -> DataFrame:
    """At most ``per_class`` rows of each of the ``max_classes`` most frequent labels.

    The choice depends on the values of ``key`` alone. Classes are thinned by a hash first, to about four
    times their share. Where there are few classes, each is cut by an ordered limit, which tasks apply before
    any row moves; many classes are numbered side by side.
    """
    counts = (
        df.filter(F.col(label).isNotNull())
        .groupBy(label)
        .count()
        .orderBy(F.desc("count"), label)
        .limit(max_classes)
        .collect()
    )
    if not counts:
        return df.limit(0)
    shares = F.create_map(
        *[F.lit(v) for row in counts for v in (row[0], min(1.0, 4.0 * per_class / row[1]))]
    )
    place = unit_hash(*[F.col(k) for k in key])
    thinned = df.filter(F.try_element_at(shares, F.col(label)) > place)
    if max_classes <= ORDERED_CLASSES:
        parts = [thinned.filter(F.col(label) == row[0]).orderBy(place, *key).limit(per_class) for row in counts]
        return reduce(DataFrame.union, parts)
    order = W.Window.partitionBy(label).orderBy(place, *key)
    numbered = thinned.withColumn("_place", F.row_number().over(order))
    return numbered.filter(F.col("_place") <= per_class).drop("_place")

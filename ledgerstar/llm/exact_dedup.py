"""Exact deduplication over a sharded cuckoo-filter index of text digests.

The index keeps, for every live digest, its document and its number of copies (the stored keys), and for
every shard of the digest space one cuckoo filter: buckets of four 16-bit tags, a tag's second bucket
being reachable from its first and the tag alone. A batch asks the filters first. A digest whose tag is in
neither bucket is new and enters filter and stored keys without any look at the stored keys; a hit is
verified against the stored key rows, whole 256-bit digest and text length, so a chance equality of tags
drops nothing; a verified hit only adds its copies and its id to the key that is there. Deleting takes one equal tag out. A shard whose filter overflows, or that met a false hit,
gets a filter of the next fitting size, filled from its stored keys.

A shard's filter is one row and its batch one group, both of a size set by the number of shards. Copies of
a text are folded by a partial aggregate before the shuffle, so a text that a third of all rows repeat
reaches its shard as one row.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar.llm.common import ascii_lower
from ledgerstar.session import Scratch

SLOTS = 4
MAX_KICKS = 400
FULLEST = 0.9
TAG_SPREAD = 0x5BD1E995
KEYS = "shard int, digest binary, length bigint, doc_id bigint, copies bigint"
FILTERS = "shard int, buckets int, slots binary"
ANSWER = "shard int, digest binary, hit boolean, buckets int, slots binary, overflow boolean"


class CuckooFilter:
    """Tags of 256-bit digests in buckets of four; zero is a free slot."""

    def __init__(self, buckets: int, slots: bytes | None = None):
        self.buckets = buckets
        if slots is None:
            self.table = np.zeros((buckets, SLOTS), dtype=np.uint16)
        else:
            self.table = np.frombuffer(slots, dtype=np.uint16).reshape(buckets, SLOTS).copy()

    @staticmethod
    def size_for(entries: int) -> int:
        """The least power of two of buckets that holds ``entries`` below the fullest load."""
        return 1 << max(0, math.ceil(math.log2(max(1.0, entries / (SLOTS * FULLEST)))))

    def places(self, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tags and both buckets of digests given as rows of 32 bytes."""
        words = digests.view("<u4")
        tags = (words[:, 0] & 0xFFFF).astype(np.uint16)
        tags[tags == 0] = 1
        first = (words[:, 1] & np.uint32(self.buckets - 1)).astype(np.int64)
        return tags, first, self._other(tags, first)

    def _other(self, tags: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        step = tags.astype(np.uint64) * np.uint64(TAG_SPREAD) >> np.uint64(7)
        return bucket ^ (step & np.uint64(self.buckets - 1)).astype(np.int64)

    def contains(self, digests: np.ndarray) -> np.ndarray:
        tags, first, second = self.places(digests)
        in_first = (self.table[first] == tags[:, None]).any(axis=1)
        return in_first | (self.table[second] == tags[:, None]).any(axis=1)

    def insert(self, digests: np.ndarray) -> bool:
        """Insert all; False if one found no place, which leaves the filter unfit for use."""
        tags, first, second = self.places(digests)
        left = self._fill(tags, first, np.arange(len(tags)))
        left = self._fill(tags, second, left)
        return all(self._kick(int(tags[i]), int(second[i])) for i in left)

    def _fill(self, tags: np.ndarray, bucket: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Put rows into free slots of their buckets; the rows for which there was none."""
        rows = rows[np.argsort(bucket[rows], kind="stable")]
        at = bucket[rows]
        starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else np.zeros(0, int)
        rank = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
        free = self.table[at] == 0
        order = np.cumsum(free, axis=1) - 1
        slot = (free & (order == rank[:, None])).argmax(axis=1)
        placed = rank < free.sum(axis=1)
        self.table[at[placed], slot[placed]] = tags[rows[placed]]
        return rows[~placed]

    def _kick(self, tag: int, bucket: int) -> bool:
        for turn in range(MAX_KICKS):
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = tag
                return True
            victim = (turn * 7 + tag) % SLOTS
            tag, self.table[bucket, victim] = int(self.table[bucket, victim]), tag
            bucket = int(self._other(np.array([tag], np.uint16), np.array([bucket]))[0])
        return False

    def delete(self, digests: np.ndarray) -> None:
        """Take one tag of each digest out; only digests that were inserted may be deleted."""
        for tag, first, second in zip(*(x.tolist() for x in self.places(digests)), strict=True):
            for bucket in (first, second):
                slots = np.flatnonzero(self.table[bucket] == tag)
                if len(slots):
                    self.table[bucket, slots[0]] = 0
                    break


def _rows_of(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype=np.uint8).reshape(-1, 32)


def _ask_and_insert(batch: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
    """Answers for a shard's digests, and its filter with the new ones in it."""
    shard = int((batch if len(batch) else stored)["shard"].iloc[0])
    if len(stored):
        cuckoo = CuckooFilter(int(stored["buckets"].iloc[0]), stored["slots"].iloc[0])
    else:
        cuckoo = CuckooFilter(CuckooFilter.size_for(len(batch)))
    fits, hit = True, np.zeros(0, dtype=bool)
    if len(batch):
        digests = _rows_of(batch["digest"])
        hit = cuckoo.contains(digests)
        fits = cuckoo.insert(digests[~hit])
    rows = [(shard, d, bool(h), None, None, None) for d, h in zip(batch["digest"], hit, strict=True)]
    rows.append((shard, None, None, cuckoo.buckets, cuckoo.table.tobytes(), not fits))
    return pd.DataFrame(rows, columns=["shard", "digest", "hit", "buckets", "slots", "overflow"])


def _delete_tags(gone: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
    if not len(stored):
        return stored
    cuckoo = CuckooFilter(int(stored["buckets"].iloc[0]), stored["slots"].iloc[0])
    if len(gone):
        cuckoo.delete(_rows_of(gone["digest"]))
    return stored[["shard", "buckets"]].assign(slots=[cuckoo.table.tobytes()])


def _rebuild(keys: pd.DataFrame) -> pd.DataFrame:
    """A filter with room for half as many again, from the shard's stored keys."""
    digests = _rows_of(keys["digest"])
    buckets = CuckooFilter.size_for(len(digests) * 3 // 2)
    while True:
        cuckoo = CuckooFilter(buckets)
        if cuckoo.insert(digests):
            break
        buckets *= 2
    return pd.DataFrame([(int(keys["shard"].iloc[0]), buckets, cuckoo.table.tobytes())], columns=["shard", "buckets", "slots"])


class DigestIndex:
    """Live digests in ``shards`` shards. Every change writes new tables beside those it read."""

    def __init__(self, spark: SparkSession, scratch: Scratch, shards: int):
        self.spark, self.scratch, self.shards = spark, scratch, shards
        self._turn = 0
        self._keys: list[DataFrame] = []
        self._repeats: list[DataFrame] = []
        self._filters = spark.createDataFrame([], FILTERS)
        self.rebuilt = 0

    def _store(self, df: DataFrame, name: str) -> DataFrame:
        return self.scratch.store(df, f"{name}-{self._turn:04d}")

    def _shard(self) -> Column:
        return F.pmod(F.xxhash64("digest"), F.lit(self.shards)).cast("int")

    def _stored(self) -> DataFrame:
        """The stored keys, one for each digest that a filter or a look at the keys found to be new."""
        rows = self._keys[0]
        for more in self._keys[1:]:
            rows = rows.union(more)
        return rows

    def keys(self) -> DataFrame:
        """The live digests: ``digest, length, doc_id`` (the largest) and ``copies``."""
        if not self._keys:
            return self.spark.createDataFrame([], KEYS).drop("shard")
        rows = self._stored().select("digest", "length", "doc_id", "copies")
        if not self._repeats:
            return rows
        repeats = self._repeats[0]
        for more in self._repeats[1:]:
            repeats = repeats.union(more)
        added = repeats.groupBy("digest", "length").agg(F.max("doc_id").alias("_doc_id"), F.sum("copies").alias("_copies"))
        return rows.join(added.hint("merge"), ["digest", "length"], "left").select(
            "digest",
            "length",
            F.greatest("doc_id", "_doc_id").alias("doc_id"),
            (F.col("copies") + F.coalesce("_copies", F.lit(0))).alias("copies"),
        )

    def insert(self, rows: DataFrame) -> DataFrame:
        """Insert ``digest, length, doc_id`` rows; the digests among them that were live before.

        What the filters answer decides: a digest that misses becomes a key without a look at the keys,
        a hit is looked up, and either adds to its key or, where the tags were equal by chance, becomes one.
        """
        self._turn += 1
        folded = rows.groupBy("digest", "length").agg(
            F.max("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")
        )
        batch = self._store(folded.withColumn("shard", self._shard()).select("shard", "digest", "length", "doc_id", "copies"), "batch")
        answers = self._store(
            batch.select("shard", "digest").groupBy("shard").cogroup(self._filters.groupBy("shard")).applyInPandas(_ask_and_insert, ANSWER),
            "answers",
        )
        judged = batch.join(answers.filter("digest is not null").select("digest", "hit"), "digest").select(*batch.columns, "hit")
        judged = self._store(judged, "judged")
        hits = judged.filter("hit").drop("hit")
        live = self._stored().select("digest", "length") if self._keys else hits.select("digest", "length").limit(0)
        # A hit counts only where the stored key is the same in full.
        known = self._store(hits.join(live.hint("merge"), ["digest", "length"], "left_semi").select(*batch.columns), "known")
        false_hits = self._store(hits.join(known.select("digest"), "digest", "left_anti").select(*batch.columns), "false-hits")
        self._keys += [judged.filter("not hit").drop("hit"), false_hits]
        self._repeats.append(known)
        stale = self._store(answers.filter("overflow").select("shard").union(false_hits.select("shard")).distinct(), "stale")
        filters = answers.filter("slots is not null").select("shard", "buckets", "slots")
        if not stale.isEmpty():
            self.rebuilt += 1
            stored = self._stored().select(self._shard().alias("shard"), "digest").join(stale, "shard", "left_semi")
            fresh = stored.groupBy("shard").applyInPandas(_rebuild, FILTERS)
            filters = filters.join(stale, "shard", "left_anti").union(fresh)
        self._filters = self._store(filters, "filters")
        return known.select("digest")

    def contains(self, digests: DataFrame) -> DataFrame:
        """The rows of ``digest, length`` that are live: filters first, hits against the stored keys."""
        asked = digests.select("digest", "length").distinct().withColumn("shard", self._shard())
        answers = asked.select("shard", "digest").groupBy("shard").cogroup(self._filters.groupBy("shard")).applyInPandas(_ask_and_insert, ANSWER)
        hits = answers.filter("hit").select("digest").join(asked, "digest").select("digest", "length")
        return hits.join(self.keys(), ["digest", "length"], "left_semi")

    def delete(self, digests: DataFrame) -> None:
        """Delete those of ``digest`` that are live, all their copies; others are left out of account."""
        self._turn += 1
        gone = self._store(
            self.keys().select("digest").join(digests.select("digest").distinct(), "digest", "left_semi").withColumn("shard", self._shard()),
            "gone",
        )
        emptied = gone.groupBy("shard").cogroup(self._filters.groupBy("shard")).applyInPandas(_delete_tags, FILTERS)
        self._filters = self._store(emptied, "filters")
        left = self.keys().join(gone.select("digest"), "digest", "left_anti")
        self._keys = [self._store(left.select(self._shard().alias("shard"), "digest", "length", "doc_id", "copies"), "keys")]
        self._repeats = []


def with_digest(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, digest, length`` of each text with A-Z lower-cased; NULL counts as empty."""
    body = ascii_lower(F.coalesce(F.col(text), F.lit("")))
    return docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.unhex(F.sha2(body, 256)).alias("digest"),
        F.octet_length(body).cast("long").alias("length"),
    )


def keep_one_of_each(
    docs: DataFrame, batches: int = 3, keys_per_shard: int = 50_000, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, digest`` for each row of ``docs``.

    The rows enter the index in ``batches``. Of equal texts the row of the largest id stays. Rows that
    repeat the staying id stay together; a NULL id stays only where no row of the text has one.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    rows = scratch.store(
        with_digest(docs, text, doc_id).withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")),
        "digests",
    )
    index = DigestIndex(spark, scratch, max(1, math.ceil(rows.count() / keys_per_shard)))
    for batch in range(batches):
        index.insert(rows.filter(F.col("batch") == batch))
    live = scratch.store(index.keys().withColumnRenamed("doc_id", "keep_id"), "live")
    joined = rows.join(live.hint("merge"), ["digest", "length"])
    kept = F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull())
    return joined.select("doc_id", "keep_id", F.col("copies").alias("group_size"), kept.alias("kept"), "digest")

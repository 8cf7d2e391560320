"""SimHash near-duplicates found with pivot distance tables.

A fingerprint has 64 bits, each the majority of that bit in the hashes of the text's word shingles. Texts
link where fingerprints differ in at most ``max_bits`` bits.

Equal fingerprints are folded first. For every distinct fingerprint the Hamming distances to sixteen
fixed reference fingerprints (the pivots) are computed once. By the triangle inequality two linked
fingerprints differ by at most ``max_bits`` in every one of these coordinates, so a pair whose largest
coordinate difference is above that is discarded, and only survivors are compared bit by bit.

Pairs are met in buckets, so that no task sees all fingerprints: the bits are cut into
``max_bits + match`` blocks, and linked fingerprints agree in at least ``match`` of them, hence in one of
the choices of ``match`` blocks. This loses no pair. A bucket above ``bucket_rows`` is not compared but
dealt again by further blocks of its remaining bits, until every bucket is small; this is exact for the
same reason. A bucket yields a spanning forest of its links, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstar.contracts import exact
from ledgerstar.llm.components import connected_components
from ledgerstar.llm.forest import Forest
from ledgerstar.session import Scratch

BITS = 64
HASH_SEED = 42
N_PIVOTS = 16
SMALL_RUN = 24
TILE = 512
OUT = "a bigint, b bigint, mask bigint"


def text_fingerprint(text: str | None, width: int = 4) -> int:
    """The fingerprint of one text as a signed 64-bit number; zero without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter((len(w) + 1 for w in words), np.int64, len(words)))
    starts = np.concatenate([[0], ends[:-1]])
    span = min(width, len(words)) - 1
    pieces = zip(starts[: len(words) - span].tolist(), (ends[span:] - 1).tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], HASH_SEED) for s, e in pieces], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(majority.view("<i8")[0])


def fingerprint_of(text: Column, width: int = 4) -> Column:
    """The fingerprint of a text column as BIGINT; NULL counts as a text without words."""

    @F.pandas_udf("bigint")
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([text_fingerprint(t, width) for t in texts], dtype="int64")

    return fingerprints(text)


def hex_digits(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def pivots() -> list[int]:
    """Reference fingerprints: the hashes of their numbers, as signed 64-bit numbers."""
    return [_signed(xxhash.xxh64_intdigest(i.to_bytes(8, "little"), HASH_SEED)) for i in range(N_PIVOTS)]


def cut_bits(bits: list[int], parts: int) -> list[int]:
    """Masks of ``parts`` runs of about equal length over these bit places."""
    sizes = [len(bits) // parts + (i < len(bits) % parts) for i in range(parts)]
    masks, at = [], 0
    for size in sizes:
        masks.append(sum(1 << b for b in bits[at : at + size]))
        at += size
    return masks


def first_masks(max_bits: int, match: int) -> list[int]:
    blocks = cut_bits(list(range(BITS)), max_bits + match)
    return [_signed(sum(chosen)) for chosen in combinations(blocks, match)]


def finer_masks(mask: int, max_bits: int) -> list[int]:
    """Masks that extend ``mask``: fingerprints within ``max_bits`` that agree on it agree on one of them."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    return [_signed((mask & (1 << 64) - 1) | more) for more in cut_bits(free, max_bits + 1)]


def with_pivot_table(fingerprints: DataFrame) -> DataFrame:
    """``fp`` with its distances to the pivots, a byte each, packed into two BIGINT columns."""
    distances = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("bigint") for p in pivots()]

    def packed(parts: list[Column]) -> Column:
        total = parts[0]
        for i, part in enumerate(parts[1:], 1):
            total = total.bitwiseOR(F.shiftleft(part, 8 * i))
        return total

    return fingerprints.select("fp", packed(distances[:8]).alias("near"), packed(distances[8:]).alias("far"))


def _within(xs: np.ndarray, ys: np.ndarray, max_bits: int) -> np.ndarray:
    # bitwise_count takes the absolute value of signed numbers.
    return np.bitwise_count((xs ^ ys).view(np.uint64)) <= max_bits


def _survive(coordinates: np.ndarray, a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Which pairs have no coordinate that differs by more than ``max_bits``."""
    apart = np.abs(coordinates[a] - coordinates[b])
    return apart.max(axis=1, initial=0) <= max_bits


def _join_small(forest: Forest, run: np.ndarray, fp, coordinates, max_bits: int) -> None:
    """Compare rows of the same run at every distance apart; runs are contiguous."""
    at = np.arange(len(run))
    lag = 1
    while True:
        at = at[at + lag < len(run)]
        at = at[run[at] == run[at + lag]]
        if not len(at):
            return
        kept = at[_survive(coordinates, at, at + lag, max_bits)]
        kept = kept[_within(fp[kept], fp[kept + lag], max_bits)]
        forest.link(kept, kept + lag)
        lag += 1


def _join_large(forest: Forest, rows: np.ndarray, fp, coordinates, max_bits: int) -> None:
    """Compare the rows of one run in tiles, ordered by the first coordinate."""
    rows = rows[np.argsort(coordinates[rows, 0], kind="stable")]
    for i in range(0, len(rows), TILE):
        left = rows[i : i + TILE]
        reach = coordinates[left[-1], 0] + max_bits
        for j in range(i, len(rows), TILE):
            right = rows[j : j + TILE]
            if coordinates[right[0], 0] > reach:
                break
            near = np.ones((len(left), len(right)), dtype=bool)
            for c in range(4):
                near &= np.abs(coordinates[left, c][:, None] - coordinates[right, c][None, :]) <= max_bits
            a, b = np.nonzero(near)
            a, b = left[a], right[b]
            kept = _survive(coordinates, a, b, max_bits)
            a, b = a[kept], b[kept]
            kept = _within(fp[a], fp[b], max_bits)
            forest.link(a[kept], b[kept])


def _links(mask, fp, near, far, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints and the roots of their trees, for rows sorted by bucket."""
    n = len(fp)
    value = fp & mask
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])
    run = np.cumsum(fresh) - 1
    sizes = np.bincount(run)
    shared = np.flatnonzero(sizes[run] > 1)
    if not len(shared):
        return fp[:0], fp[:0]
    run, fp = run[shared], fp[shared]
    coordinates = np.column_stack([near[shared], far[shared]]).view(np.uint8).reshape(len(shared), -1)
    coordinates = coordinates.astype(np.int8)
    forest = Forest(len(fp))
    small = np.flatnonzero(sizes[run] <= SMALL_RUN)
    if len(small):
        inner = Forest(len(small))
        _join_small(inner, run[small], fp[small], coordinates[small], max_bits)
        below, root = inner.members()
        forest.link(small[below], small[root])
    large = np.flatnonzero(sizes[run] > SMALL_RUN)
    if len(large):
        edges = np.flatnonzero(np.diff(run[large])) + 1
        for rows in np.split(large, edges):
            _join_large(forest, rows, fp, coordinates, max_bits)
    below, root = forest.members()
    return fp[below], fp[root]


def _bucket_joiner(max_bits: int, bucket_rows: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("mask", pa.int64())])

    def batch_of(a, b, mask) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, mask)], schema=schema)

    def dealt_again(fp: np.ndarray, mask: int) -> pa.RecordBatch:
        finer = finer_masks(mask, max_bits)
        zeros = np.zeros(len(fp) * len(finer), dtype=np.int64)
        return batch_of(np.tile(fp, len(finer)), zeros, np.repeat(np.array(finer, np.int64), len(fp)))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive sorted by bucket; only the unfinished last bucket is carried over."""
        held = [np.zeros(0, np.int64)] * 4
        large: tuple[int, int] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            got = [np.asarray(batch.column(c)) for c in ("mask", "fp", "near", "far")]
            rows = [np.concatenate([x, y]) for x, y in zip(held, got, strict=True)]
            mask, fp = rows[0], rows[1]
            if large is not None:
                same = (mask == large[0]) & (fp & mask == large[1])
                until = int(np.argmin(same)) if not same.all() else len(same)
                if until:
                    yield dealt_again(fp[:until], large[0])
                rows = [x[until:] for x in rows]
                mask, fp = rows[0], rows[1]
                held = rows
                if not len(fp):
                    continue
                large = None
            last = (mask == mask[-1]) & (fp & mask == fp[-1] & mask[-1])
            cut = len(fp) - int(np.argmin(last[::-1])) if not last.all() else 0
            held = [x[cut:] for x in rows]
            yield from finished([x[:cut] for x in rows])
            if len(held[0]) > bucket_rows:
                large = (int(held[0][0]), int(held[1][0] & held[0][0]))
                yield dealt_again(held[1], large[0])
                held = [x[:0] for x in held]
        yield from finished(held)

    def finished(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        mask, fp = rows[0], rows[1]
        if not len(fp):
            return
        value = fp & mask
        fresh = np.ones(len(fp), dtype=bool)
        fresh[1:] = (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])
        sizes = np.bincount(np.cumsum(fresh) - 1)
        large = sizes > bucket_rows
        for first, size in zip(np.flatnonzero(fresh)[large], sizes[large], strict=True):
            yield dealt_again(fp[first : first + size], int(mask[first]))
        over = np.repeat(large, sizes)
        rows = [x[~over] for x in rows]
        a, b = _links(*rows, max_bits)
        yield batch_of(a, b, np.zeros(len(a), np.int64))

    return join


def link_fingerprints(
    distinct: DataFrame, scratch: Scratch, max_bits: int = 4, match: int = 3, bucket_rows: int = 20_000
) -> DataFrame:
    """Links ``a, b`` that connect exactly the fingerprints ``fp`` within ``max_bits`` of each other."""
    table = with_pivot_table(distinct)
    masks = F.array(*[F.lit(m) for m in first_masks(max_bits, match)])
    dealt = table.select(F.explode(masks).alias("mask"), "fp", "near", "far")
    join = _bucket_joiner(max_bits, bucket_rows)
    links = None
    for turn in range(BITS):
        value = F.col("fp").bitwiseAND(F.col("mask"))
        sorted_rows = dealt.repartition("mask", value).sortWithinPartitions("mask", value)
        found = scratch.store(sorted_rows.mapInArrow(join, OUT), f"buckets-{turn}")
        part = found.filter("mask = 0").select("a", "b").distinct()
        links = part if links is None else links.union(part)
        again = found.filter("mask <> 0").select(F.col("a").alias("fp"), "mask").distinct()
        if again.isEmpty():
            break
        dealt = again.join(with_pivot_table(again.select("fp")).distinct(), "fp").select(
            "mask", "fp", "near", "far"
        )
    return links


def near_duplicate_groups(
    docs: DataFrame,
    width: int = 4,
    max_bits: int = 4,
    text: str = "text",
    doc_id: str = "doc_id",
    match: int = 3,
    bucket_rows: int = 20_000,
) -> DataFrame:
    """``doc_id, fingerprint`` (BIGINT)``, component_id``, one row for each row of ``docs``.

    ``component_id`` is the least id reachable over links, the row's own included. Texts without words
    have fingerprint zero and link like any others. A NULL id takes part in linking and is never the
    least; repeated rows come out repeated.
    """
    marked, groups = _marked_and_groups(docs, width, max_bits, text, doc_id, match, bucket_rows)
    return marked.join(groups, "fp").select("doc_id", F.col("fp").alias("fingerprint"), "component_id")


def _marked_and_groups(
    docs: DataFrame, width: int, max_bits: int, text: str, doc_id: str, match: int = 3, bucket_rows: int = 20_000
) -> tuple[DataFrame, DataFrame]:
    """``doc_id, fp`` of all rows, and ``fp, component, component_id`` of all distinct fingerprints, where
    ``component`` is one of the group's fingerprints."""
    scratch = Scratch(docs.sparkSession)
    marked = scratch.store(
        docs.select(F.col(doc_id).alias("doc_id"), fingerprint_of(F.col(text), width).alias("fp")),
        "fingerprints",
    )
    folded = scratch.store(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "folded")
    links = link_fingerprints(folded.select("fp"), scratch, max_bits, match, bucket_rows)
    nodes = connected_components(links, scratch, "components")
    member = nodes.join(folded, nodes["node"] == folded["fp"]).select("fp", "component", "least")
    least = member.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = member.join(least, "component").select("fp", "component", "component_id")
    group = scratch.store(
        folded.join(linked, "fp", "left").select(
            "fp",
            F.coalesce("component", "fp").alias("component"),
            F.coalesce("component_id", "least").alias("component_id"),
        ),
        "groups",
    )
    return marked, group


def one_of_each_group(docs: DataFrame, width: int = 4, max_bits: int = 4, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row of each group of ``docs``: the one of the least id, or one without id where the whole group lacks ids.

    Of the rows of a group that share its least id, the one of the least text hash stays; among equal
    texts any one does.
    """
    scratch = Scratch(docs.sparkSession)
    marked, groups = _marked_and_groups(docs, width, max_bits, text, doc_id)
    judged = marked.filter("doc_id IS NOT NULL").join(groups, "fp").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("doc_id") == F.col("component_id")).alias("stays")
    )
    settled = scratch.store(judged.filter("n > 1 OR NOT stays").withColumnRenamed("doc_id", doc_id), "settled")
    key = F.col(doc_id)
    alone = docs.filter(key.isNotNull()).join(settled.select(doc_id), doc_id, "left_anti").select(*[exact(c) for c in docs.columns])
    repeated = settled.filter("n > 1 AND stays").select(doc_id)
    shared = docs.filter(key.isNull())
    if not repeated.isEmpty():
        shared = shared.unionByName(docs.join(repeated, doc_id, "left_semi").select(*[exact(c) for c in docs.columns]))
    # Rows that an id does not tell apart are told apart by their text; with ids that are ids there are none.
    whole = F.struct(*[exact(c) for c in docs.columns])
    rows = shared.select(whole.alias("row"), key.alias("id"), F.xxhash64(text).alias("order"), fingerprint_of(F.col(text), width).alias("fp"))
    least = rows.join(groups, "fp").filter("id <=> component_id")
    one = least.groupBy("component").agg(F.min_by("row", "order").alias("row"))
    return alone.unionByName(one.select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))

"""How far each source's words are from those of other sources and of its whole language.

The counts of terms by group (a language's source) form a matrix per language, with a column for each term
that enough of the language's documents hold. A group's share of a term is smoothed and scaled to whole
numbers, ``p = 1 + floor(10**9 * (count + 1) / (N + V))``, and two shares are ``floor((p - q)**2 / q)``
apart; all of it is exact.

The matrix is mostly zeros, and all zeros of a group have the same share. So it is held as a K-squared
tree (k = 2): a quadrant without a count is a leaf, others are cut in four down to single cells. Two groups
are compared by walking the tree from both rows at once. Where both quadrants are zero the walk stops: these columns
cost the groups' zero price times their number, whatever that number is. Only cells where one of the two
has a count are visited.

Columns are dealt into blocks by a hash and rows into bands, so a tree covers one block of at most some
thousand columns and two bands of groups, and blocks are summed up by Spark. Inside a block the columns are
ordered by the groups that hold them, which makes the zero quadrants large. A block's columns, and a column's
groups, are the only things a task ever holds.

Counting: words are counted per slice of documents in each task and folded again before the shuffle, so a
word or a source in a third of all rows brings a row for each task.

Defined cases: NULL text, language or source count as empty. Every row is a document, also where an id
repeats. A group without terms is compared by its zero shares; in a language without kept terms all values
are 0. Ties rank by the item's UTF-8 bytes. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ledgerstar.session import Scratch

SHARE = 10**9
SLICE_BYTES = 8_000_000
BLOCK_TERMS = 4096
BAND = 64

# What a byte of a term becomes; all other ASCII bytes part terms.
_BYTES = np.full(256, ord(" "), dtype=np.uint8)
_BYTES[128:] = np.arange(128, 256)
_BYTES[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_BYTES[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different terms, and for every occurrence its term's number and its text's place."""
    texts = texts.cast("large_string")
    if texts.offset or texts.null_count:
        texts = pa.concat_arrays([pc.fill_null(texts, "")])
    _, offsets, data = texts.buffers()
    data = pa.py_buffer(_BYTES[np.frombuffer(data, dtype=np.uint8)].tobytes()) if data else data
    plain = pa.Array.from_buffers(pa.large_string(), len(texts), [None, offsets, data], offset=texts.offset)
    parts = pc.ascii_split_whitespace(plain)
    flat = parts.flatten()
    held = np.asarray(pc.greater(pc.binary_length(flat), 0))
    place = np.repeat(np.arange(len(texts)), np.diff(np.asarray(parts.offsets)))[held]
    coded = flat.filter(pa.array(held)).dictionary_encode()
    return coded.dictionary, np.asarray(coded.indices).astype(np.int64), place


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    ends = np.cumsum(np.asarray(pc.binary_length(batch["text"])).astype(np.int64))
    at = 0
    while at < len(ends):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + SLICE_BYTES, side="right")))
        yield batch.slice(at, to - at)
        at = to


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per slice: a row for each group and term, with occurrences and documents."""
    for whole in batches:
        for batch in _slices(whole):
            terms, code, place = terms_of(batch["text"])
            if not len(code):
                continue
            names = pa.StructArray.from_arrays([batch["lang"], batch["source"]], ["lang", "source"])
            keys = {}
            group = np.array([keys.setdefault((x["lang"], x["source"]), len(keys)) for x in names.to_pylist()])
            cells, occurrences = np.unique(place * len(terms) + code, return_counts=True)
            by_group, where = np.unique(group[cells // len(terms)] * len(terms) + cells % len(terms), return_inverse=True)
            n = np.bincount(where, weights=occurrences).astype(np.int64)
            docs = np.bincount(where).astype(np.int64)
            owner = by_group // len(terms)
            lang, source = (pa.array([k[i] for k in keys]).take(pa.array(owner)) for i in (0, 1))
            found = terms.take(pa.array(by_group % len(terms))).cast("string")
            yield pa.RecordBatch.from_arrays([lang, source, found, pa.array(n), pa.array(docs)], ["lang", "source", "term", "n", "docs"])


def share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(10**9 * (count + 1) / (total + terms))`` by long division in thousands, so nothing overflows."""
    under = total + terms
    rest = count + 1
    out = F.lit(1).cast("bigint")
    for step in (SHARE, SHARE // 1000, SHARE // 1_000_000, 1):
        out = out + F.call_function("div", rest, under) * F.lit(step)
        rest = (rest % under) * F.lit(1000)
    return out


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def columns_of(docs: DataFrame, min_docs: int) -> DataFrame:
    """``lang, term, total, cells``: the kept terms with the count of each source that holds them."""
    counted = docs.mapInArrow(_count_terms, "lang string, source string, term string, n bigint, docs bigint")
    cells = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # A term has at most one cell a source here.
    columns = cells.groupBy("lang", "term").agg(
        F.sum("n").alias("total"),
        F.sum("docs").alias("docs"),
        F.collect_list(F.struct("source", "n")).alias("cells"),
    )
    return columns.filter(F.col("docs") >= min_docs).drop("docs")


def groups_of(docs: DataFrame, columns: DataFrame) -> DataFrame:
    """``lang, source, g, total, lang_total, terms`` for every group that occurs."""
    sums = columns.select("lang", F.explode("cells").alias("c")).groupBy("lang", F.col("c.source").alias("source"))
    totals = sums.agg(F.sum("c.n").alias("total"))
    langs = columns.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.count(F.lit(1)).alias("terms"))
    named = docs.groupBy("lang", "source").agg(F.lit(1).alias("one")).drop("one")
    zero = F.lit(0).cast("bigint")
    # One row a source: a language's groups are as many as the result has items for one of them.
    number = F.row_number().over(W.Window.partitionBy("lang").orderBy("source")) - 1
    return (
        named.join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select("lang", "source", number.alias("g"), *[F.coalesce(c, zero).alias(c) for c in ("total", "lang_total", "terms")])
    )


class QuadTree:
    """A K-squared tree over the rows of one band: ``levels[l]`` tells which squares of side 2**l hold a count."""

    def __init__(self, held: np.ndarray):
        self.levels = [held]
        while len(self.levels[-1]) > 1:
            a, b = self.levels[-1].shape
            self.levels.append(self.levels[-1].reshape(a // 2, 2, b // 2, 2).any(axis=(1, 3)))

    @property
    def height(self) -> int:
        return len(self.levels) - 1


def joint_leaves(a: QuadTree, b: QuadTree, square: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of ``a``, row of ``b`` and column of the cells of one top square where either has a count."""
    rows, others, columns = (np.array([0]), np.array([0]), np.array([square]))
    for level in range(a.height, -1, -1):
        if level < a.height:
            half = np.arange(8)
            rows = (2 * rows[:, None] + (half >> 2)).ravel()
            others = (2 * others[:, None] + (half >> 1 & 1)).ravel()
            columns = (2 * columns[:, None] + (half & 1)).ravel()
        held = a.levels[level][rows, columns] | b.levels[level][others, columns]
        rows, others, columns = rows[held], others[held], columns[held]
    return rows, others, columns


def _band(numbers: np.ndarray, values: np.ndarray, terms: np.ndarray, zero: np.ndarray, width: int) -> tuple[QuadTree, np.ndarray]:
    """The tree and the shares of one band; rows and columns beyond the real ones are zero."""
    shares = np.repeat(zero[:, None], width, axis=1)
    held = np.zeros((BAND, width), dtype=bool)
    shares[numbers, terms] = values
    held[numbers, terms] = True
    return QuadTree(held), shares


def _compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Leaves and their summed distances for each ordered pair of groups from two bands of one block."""
    lang, _, low, high = (k.as_py() for k in key)
    term, g, p = (table[c].combine_chunks() for c in ("term", "g", "p"))
    header = np.asarray(term.is_null())
    g, p = np.asarray(g).astype(np.int64), np.asarray(p)
    coded = term.filter(pa.array(~header)).dictionary_encode()
    codes, n_terms = np.asarray(coded.indices).astype(np.int64), len(coded.dictionary)
    width = max(BAND, -(-n_terms // BAND) * BAND)
    # Columns that the same groups hold stand together.
    both = np.zeros((2 * BAND, n_terms), dtype=bool)
    both[g[~header] - np.where(g[~header] // BAND == low, low, high - 1) * BAND, codes] = True
    order = np.lexsort(np.packbits(both, axis=0))
    place = np.empty(n_terms, dtype=np.int64)
    place[order] = np.arange(n_terms)
    bands = {}
    for band in {low, high}:
        zero = np.ones(BAND, dtype=np.int64)
        own = header & (g // BAND == band)
        zero[g[own] - band * BAND] = p[own]
        cell = ~header & (g // BAND == band)
        bands[band] = _band(g[cell] - band * BAND, p[cell], place[codes[cell[~header]]], zero, width)
    sums = {}
    for first, second in {(low, high), (high, low)}:
        (tree, shares), (other_tree, other_shares) = bands[first], bands[second]
        leaves, value = np.zeros(BAND * BAND, dtype=np.int64), np.zeros(BAND * BAND, dtype=np.int64)
        for square in range(width // BAND):
            rows, others, columns = joint_leaves(tree, other_tree, square)
            x, y = shares[rows, columns], other_shares[others, columns]
            pair = rows * BAND + others
            leaves += np.bincount(pair, minlength=BAND * BAND)
            np.add.at(value, pair, (x - y) * (x - y) // y)
        sums[first, second] = leaves, value
    out = []
    for (first, second), (leaves, value) in sums.items():
        pair = np.flatnonzero(leaves)
        out.append((first * BAND + pair // BAND, second * BAND + pair % BAND, leaves[pair], value[pair]))
    g, h, leaves, value = (np.concatenate(x) for x in zip(*out, strict=True))
    return pa.table({"lang": pa.array([lang] * len(g), type=pa.string()), "g": g, "h": h, "leaves": leaves, "value": value})


def pair_sums(columns: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, g, h, leaves, value`` over the cells where either of two groups has a count."""
    blocks = F.ceil(F.col("terms") / BLOCK_TERMS).cast("int")
    bands = F.ceil(F.col("groups") / BAND).cast("int")
    sized = groups.join(groups.groupBy("lang").agg(F.count(F.lit(1)).alias("groups")), "lang").filter("terms > 0")
    cells = columns.select("lang", "term", F.explode("cells").alias("c")).select("lang", "term", "c.source", "c.n")
    counted = cells.join(sized, ["lang", "source"]).select(
        "lang",
        F.pmod(F.xxhash64("term"), blocks).cast("int").alias("block"),
        "g",
        bands.alias("bands"),
        "term",
        share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
    )
    zeros = sized.select(
        "lang",
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"),
        "g",
        bands.alias("bands"),
        F.lit(None).cast("string").alias("term"),
        share(F.lit(0).cast("bigint"), F.col("total"), F.col("terms")).alias("p"),
    )
    own = F.floor(F.col("g") / BAND).cast("int")
    met = counted.unionByName(zeros).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("bands") - 1)))
    dealt = met.select(
        "lang", "block", F.least(own, "other").alias("low"), F.greatest(own, "other").alias("high"), "term", "g", "p"
    )
    sums = dealt.groupBy("lang", "block", "low", "high").applyInArrow(
        _compare, "lang string, g bigint, h bigint, leaves bigint, value bigint"
    )
    return sums.groupBy("lang", "g", "h").agg(F.sum("leaves").alias("leaves"), F.sum("value").alias("value"))


def _ranked(rows: DataFrame) -> DataFrame:
    best = W.Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.withColumn("rank", F.row_number().over(best))


def source_divergence(docs: DataFrame, min_docs: int = 3, top_terms: int = 200) -> DataFrame:
    """``lang, source, part, item, value, rank``.

    Part ``pair`` tells how far each other source of the language is, part ``term`` the ``top_terms`` terms
    that stand out most against the language as a whole.
    """
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    columns = scratch.store(columns_of(texts, min_docs), "columns")
    groups = scratch.store(groups_of(texts.select("lang", "source"), columns), "groups")
    sums = scratch.store(pair_sums(columns, groups), "sums")

    zero_share = share(F.lit(0).cast("bigint"), F.col("total"), F.col("terms"))
    one = groups.filter("terms > 0").withColumn("p", zero_share)
    other = one.select("lang", F.col("source").alias("item"), F.col("g").alias("h"), F.col("p").alias("q"))
    priced = one.join(other, "lang").filter("g <> h").join(sums, ["lang", "g", "h"], "left")
    none = F.lit(0).cast("bigint")
    untouched = F.col("terms") - F.coalesce("leaves", none)
    value = F.coalesce("value", none) + untouched * apart(F.col("p"), F.col("q"))
    pairs = priced.select("lang", "source", "item", value.alias("value"))
    bare = groups.filter("terms = 0").select("lang", "source", "g")
    empty = bare.join(bare.select("lang", F.col("source").alias("item"), F.col("g").alias("h")), "lang").filter("g <> h")
    pairs = pairs.unionByName(empty.select("lang", "source", "item", none.alias("value")))

    cells = columns.select("lang", "term", F.col("total").alias("all_n"), F.explode("cells").alias("c"))
    p = share(F.col("c.n"), F.col("total"), F.col("terms"))
    q = share(F.col("all_n"), F.col("lang_total"), F.col("terms"))
    shares = cells.withColumn("source", F.col("c.source")).join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")
    )
    standing_out = shares.filter("p > q").select("lang", "source", "item", apart(F.col("p"), F.col("q")).alias("value"))
    terms = _ranked(standing_out).filter(F.col("rank") <= top_terms)

    parts = [rows.withColumn("part", F.lit(part)) for part, rows in (("pair", _ranked(pairs)), ("term", terms))]
    return parts[0].unionByName(parts[1]).select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))

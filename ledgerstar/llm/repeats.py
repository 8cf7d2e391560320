"""Words of long passages that an earlier document holds, found by recompression.

A document is its sequence of words, cut at ASCII white space. A window is ``window`` consecutive words of
one document, and a word goes if it lies in a window whose words also start somewhere in a document of a
smaller id. Windows are judged on the input.

Recompression turns words into symbols in rounds. A round first names every maximal run of one symbol, then
cuts the alphabet in two by a bit of the names and names every pair of a left symbol before a right one. A
name is a hash of what it stands for, so it is the same in every document and every task, and equal
passages get equal symbols but at their ends. Each symbol carries the span of words that settles it: all
neighbours whose look decided that it is there. A window that holds this span holds the symbol, wherever
else the window occurs.

1. *Names*: every document is compressed; neighbouring high-level symbols form marks, of which every other
   one, chosen by its name, is counted. A mark that only one document holds rules out all windows that hold
   its span.
2. *Windows*: documents are compressed again beside the list of their shared marks. The windows that are left get
   96-bit hashes of their words.
3. *Verify*: a window goes where a smaller id has the same hash. Windows without any mark, such as
   very long runs, are never ruled out, so nothing depends on how a text compresses.

Counts of names and windows fold inside each task before they are shuffled, and both joins back to the
occurrences are plain joins that Spark splits where one passage is in very many documents.

Defined cases: a NULL or empty text has no words. A row without an id neither loses words nor makes others
lose any. Rows of one id never take words from each other. Columns of ``docs`` named like a result are
replaced; all others pass. An empty table stays empty. Words are equal when their bytes are; windows when
96 hash bits agree.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar.contracts import exact
from ledgerstar.session import Scratch, delete_folder

ROUNDS = 4
MARK_SYMBOLS = 2
# Bytes of text compressed at a time; a longer document is compressed whole.
SLICE_BYTES = 1_000_000

_MULTIPLIERS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15], dtype=np.uint64)
# Odd bases of the two rolling hashes.
_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MULTIPLIERS[0]
    x = (x ^ (x >> np.uint64(27))) * _MULTIPLIERS[1]
    return x ^ (x >> np.uint64(31))


def _name(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of a pair, or of a run of ``b`` times ``a``."""
    return _mix(_mix(a + _MULTIPLIERS[2]) * _MULTIPLIERS[0] + b)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two 64-bit hashes for each word of all texts, and where each text's words start."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts.cast("large_string"), ""))
    flat = parts.flatten()
    held = np.asarray(pc.greater(pc.binary_length(flat), 0))
    offsets = np.asarray(parts.offsets)
    offsets = np.concatenate([[0], np.cumsum(held)])[offsets - offsets[0]]
    coded = flat.filter(pa.array(held)).dictionary_encode()
    words = coded.dictionary.cast("large_binary").to_pylist()
    digests = b"".join([xxhash.xxh3_128_digest(w) for w in words])
    both = np.frombuffer(digests, dtype="<u8").reshape(-1, 2)[np.asarray(coded.indices)]
    return both[:, 0], both[:, 1], offsets


class Symbols:
    """The symbols of several documents side by side, with the spans of words that settle them.

    ``low`` is before the document's first word, or ``high`` behind its last, where the document's end
    settles a symbol: no window holds such a span.
    """

    def __init__(self, names: np.ndarray, offsets: np.ndarray):
        self.offsets = offsets
        at = np.arange(len(names), dtype=np.int64)
        self.name, self.low, self.high = names.copy(), at, at + 1
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))

    def _same_doc(self) -> np.ndarray:
        return self.doc[1:] == self.doc[:-1]

    def _left_spans(self) -> tuple[np.ndarray, np.ndarray]:
        """``low`` and ``high`` of each symbol's left neighbour; at a document's start a place outside."""
        low, high = self.offsets[self.doc] - 1, self.high.copy()
        same = self._same_doc()
        low[1:] = np.where(same, self.low[:-1], low[1:])
        high[1:] = np.where(same, self.high[:-1], high[1:])
        return low, high

    def _right_spans(self) -> tuple[np.ndarray, np.ndarray]:
        low, high = self.low.copy(), self.offsets[self.doc + 1] + 1
        same = self._same_doc()
        low[:-1] = np.where(same, self.low[1:], low[:-1])
        high[:-1] = np.where(same, self.high[1:], high[:-1])
        return low, high

    def name_runs(self) -> None:
        """Make every maximal run one symbol. That it ends where it does is seen from both neighbours."""
        equal = self._same_doc() & (self.name[1:] == self.name[:-1])
        (left_low, left_high), (right_low, right_high) = self._left_spans(), self._right_spans()
        low = np.minimum(np.minimum(left_low, right_low), self.low)
        high = np.maximum(np.maximum(left_high, right_high), self.high)
        if equal.any():
            heads = np.flatnonzero(np.concatenate([[True], ~equal]))
            count = np.diff(np.append(heads, len(self.name))).astype(np.uint64)
            low, high = np.minimum.reduceat(low, heads), np.maximum.reduceat(high, heads)
            name, self.doc = self.name[heads], self.doc[heads]
            self.name = np.where(count > 1, _name(name, count), name)
        self.low, self.high = low, high

    def name_pairs(self, turn: int) -> None:
        """Make every left symbol and the right one behind it one symbol.

        A pair is settled by its parts, a right symbol alone by what stands before it, a left symbol
        alone by what stands behind it.
        """
        right = (_mix(self.name + np.uint64(turn)) >> np.uint64(63)).astype(bool)
        (left_low, left_high), (right_low, right_high) = self._left_spans(), self._right_spans()
        low = np.minimum(self.low, np.where(right, left_low, right_low))
        high = np.maximum(self.high, np.where(right, left_high, right_high))
        first = np.flatnonzero(self._same_doc() & ~right[:-1] & right[1:])
        name = self.name.copy()
        name[first] = _name(name[first], name[first + 1])
        low[first] = np.minimum(self.low[first], self.low[first + 1])
        high[first] = np.maximum(self.high[first], self.high[first + 1])
        stays = np.ones(len(name), dtype=bool)
        stays[first + 1] = False
        self.name, self.low, self.high, self.doc = name[stays], low[stays], high[stays], self.doc[stays]

    def compress(self, rounds: int) -> Symbols:
        for turn in range(rounds if len(self.name) else 0):
            self.name_runs()
            self.name_pairs(turn)
        return self


def marks_of(symbols: Symbols, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``name, low, high, doc`` of the marks to count: those that some window can hold."""
    n = max(0, len(symbols.name) - MARK_SYMBOLS + 1)
    name, low, high = symbols.name[:n], symbols.low[:n], symbols.high[:n]
    for i in range(1, MARK_SYMBOLS):
        name = _name(name, symbols.name[i : i + n])
        low, high = np.minimum(low, symbols.low[i : i + n]), np.maximum(high, symbols.high[i : i + n])
    doc = symbols.doc[:n]
    used = (doc == symbols.doc[MARK_SYMBOLS - 1 :][:n]) & (high - low <= window) & (_mix(name) & np.uint64(1) == 0)
    used &= (low >= symbols.offsets[doc]) & (high <= symbols.offsets[doc + 1])
    return name[used], low[used], high[used], doc[used]


def _rolling(hashes: np.ndarray, base: int, window: int) -> np.ndarray:
    """A hash of each ``window`` words in a row: equal windows get equal hashes wherever they start."""
    n = len(hashes)
    powers = np.full(n + 1, base, dtype=np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    back = np.full(n + 1, pow(base, -1, 1 << 64), dtype=np.uint64)
    back[0] = 1
    back = np.cumprod(back)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(hashes * powers[:-1])])
    return _mix((sums[window:] - sums[:-window]) * back[: n - window + 1])


def open_windows(offsets: np.ndarray, low: np.ndarray, high: np.ndarray, window: int) -> np.ndarray:
    """Starts of the windows that hold none of the spans ``low`` to ``high``, which lie in one document each."""
    n = int(offsets[-1])
    if n < window:
        return np.zeros(0, dtype=np.int64)
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, np.maximum(high - window, 0), 1)
    np.add.at(change, low + 1, -1)
    free = np.cumsum(change[:-1]) == 0
    # A window that begins too near the end of its document is none.
    ends = np.repeat(offsets[1:], np.diff(offsets))
    free &= np.arange(n) + window <= ends
    return np.flatnonzero(free)


def _slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with a bounded number of bytes, or a single longer text."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch[text]), 0)).astype(np.int64))
    at = 0
    while at < len(ends):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + SLICE_BYTES, side="right")))
        yield batch.slice(at, to - at)
        at = to


def _lists(values: np.ndarray, doc: np.ndarray, n_docs: int, kind: pa.DataType) -> pa.Array:
    """``values``, which are sorted by ``doc``, as one list a document."""
    ends = np.searchsorted(doc, np.arange(n_docs + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, type=kind))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _mark_names(window: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, "_text"):
                first, _, offsets = word_hashes(batch["_text"])
                name, _, _, doc = marks_of(Symbols(first, offsets).compress(rounds), window)
                names = _lists(_signed(name), doc, len(batch), pa.int64())
                yield pa.RecordBatch.from_arrays([batch["_id"], batch["_digest"], names], ["_id", "_digest", "names"])

    return run


def _window_keys(window: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, "_text"):
                first, second, offsets = word_hashes(batch["_text"])
                _, low, high, doc = marks_of(Symbols(first, offsets).compress(rounds), window)
                alone = np.ones(len(doc), dtype=bool)
                shared = batch["shared"]
                begins = np.searchsorted(doc, np.arange(len(batch)))
                counts = np.asarray(pc.fill_null(pc.list_value_length(shared), 0))
                alone[np.repeat(begins, counts) + np.asarray(shared.flatten())] = False
                open_ = open_windows(offsets, low[alone], high[alone], window)
                if not len(open_):
                    continue
                of = np.searchsorted(offsets, open_, side="right") - 1
                keys = [_rolling(h, b, window)[open_] for h, b in zip((first, second), _BASES, strict=True)]
                short = (keys[1] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                columns = [
                    batch["_id"].take(pa.array(of)),
                    batch["_digest"].take(pa.array(of)),
                    pa.array((open_ - offsets[of]).astype(np.int32)),
                    pa.array(_signed(keys[0])),
                    pa.array(short),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["_id", "_digest", "place", "key", "more"])

    return run


def kept_words(text: str | None, places: np.ndarray | None, window: int) -> tuple[int, int, str]:
    """Words in all, words that go, and the others joined by spaces."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if places is None or not len(places):
        return len(words), 0, b" ".join(words).decode("utf-8", "surrogatepass")
    change = np.zeros(len(words) + 1, dtype=np.int64)
    places = np.unique(places)
    change[places] += 1
    change[places + window] -= 1
    goes = np.cumsum(change[:-1]) > 0
    left = [words[i] for i in np.flatnonzero(~goes)]
    return len(words), int(goes.sum()), b" ".join(left).decode("utf-8", "surrogatepass")


def _finish_step(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished steps, which Spark keeps until the driver collects garbage."""
    spark.range(1).count()  # else the session holds on to its last job
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _shared_marks(texts: DataFrame, scratch: Scratch, window: int, rounds: int) -> DataFrame:
    """``_id, _digest, shared``: the places in each text's list of marks whose name other documents hold too."""
    schema = f"_id {texts.schema['_id'].dataType.simpleString()}, _digest bigint, names array<bigint>"
    named = scratch.store(texts.mapInArrow(_mark_names(window, rounds), schema), "names")
    marks = named.select("_id", "_digest", F.posexplode("names").alias("mark", "name"))
    holders = marks.groupBy("name").agg(F.min("_id").alias("least"), F.max("_id").alias("most"))
    # Written, so that the join below shuffles both its sides itself and can split a name that very many hold.
    common = scratch.store(holders.filter("least < most").select("name"), "common")
    _finish_step(texts.sparkSession)
    shared = marks.join(common, "name", "left_semi")
    # Rows that repeat a text repeat its marks; each counts once.
    lists = shared.groupBy("_id", "_digest").agg(F.array_sort(F.collect_set("mark")).alias("shared"))
    return scratch.store(lists, "shared")


def _verified(windows: DataFrame, steps: Scratch, scratch: Scratch) -> DataFrame:
    """``_id, _digest, places``: the windows whose hash a smaller id has."""
    holders = windows.groupBy("key", "more").agg(F.min("_id").alias("least"), F.max("_id").alias("most"))
    first = steps.store(holders.filter("least < most").drop("most"), "first")
    _finish_step(windows.sparkSession)
    later = windows.join(first, ["key", "more"]).filter("_id > least")
    places = later.groupBy("_id", "_digest").agg(F.collect_list("place").alias("places"))
    return scratch.store(places, "places")


def repeated_windows(docs: DataFrame, scratch: Scratch, window: int = 50, rounds: int = ROUNDS) -> DataFrame:
    """``_id, _digest, places``: where the windows start that a smaller id also holds, for each text."""
    spark = docs.sparkSession
    texts = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_digest"), F.col("text").alias("_text")
    )
    steps = Scratch(spark)
    listed = _shared_marks(texts, steps, window, rounds)
    delete_folder(spark, steps.path("names"))
    _finish_step(spark)
    # Texts without a shared mark go on: they may hold windows without any mark.
    joined = texts.join(listed, ["_id", "_digest"], "left")
    schema = f"_id {texts.schema['_id'].dataType.simpleString()}, _digest bigint, place int, key bigint, more int"
    windows = steps.store(joined.mapInArrow(_window_keys(window, rounds), schema), "windows")
    _finish_step(spark)
    found = _verified(windows, steps, scratch)
    steps.drop()
    _finish_step(spark)
    return found


def drop_repeats(docs: DataFrame, window: int = 50, rounds: int = ROUNDS) -> DataFrame:
    """``docs`` with the words that stay as ``text``, and ``n_words`` and ``n_removed``.

    ``docs`` has ``doc_id`` and ``text``; other columns pass. See the module's notes for the cases.
    """
    scratch = Scratch(docs.sparkSession)
    found = repeated_windows(docs.select("doc_id", "text"), scratch, window, rounds)

    @F.pandas_udf("n_words bigint, n_removed bigint, text string")
    def kept(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, places in batches:
            rows = [kept_words(t, p, window) for t, p in zip(texts, places, strict=True)]
            yield pd.DataFrame(rows, columns=["n_words", "n_removed", "text"])

    rest = [c for c in docs.columns if c not in ("doc_id", "text", "n_words", "n_removed")]
    held = docs.select(
        F.col("doc_id").alias("_id"),
        F.xxhash64("text").alias("_digest"),
        F.col("text").alias("_text"),
        F.struct(*[exact(c) for c in rest]).alias("_rest") if rest else F.lit(None).cast("string").alias("_rest"),
    )
    judged = held.join(found, ["_id", "_digest"], "left").withColumn("_kept", kept("_text", "places"))
    return judged.select(
        F.col("_id").alias("doc_id"),
        *[F.col("_rest").getField(c).alias(c) for c in rest],
        F.col("_kept.text").alias("text"),
        F.col("_kept.n_words").alias("n_words"),
        F.col("_kept.n_removed").alias("n_removed"),
    )

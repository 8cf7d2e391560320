"""Packing of tokenized documents into sequences by hierarchical best fit.

Documents become pieces of at most ``capacity`` tokens; a full piece is a sequence by itself. The other
pieces are dealt into parts by a hash. Each part is packed by itself, largest first into the fullest
sequence that still has room; sequences within ``slack`` tokens of full leave at once. Those left over are
items of the next round: several parts meet in one, and their underfull sequences are packed again as
units, until one part is left or another round can gain nothing. A part holds a bounded number of rows
throughout, and every piece is placed exactly once.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerstar.session import Scratch

# The rank-based encoder's pattern search fails on about a million white-space characters in a row.
LONG_SPACE = 100_000
LONG_RUN = re.compile(rf"(?<!\s)\s{{{LONG_SPACE},}}")
PART_BITS, BIN_BITS = 26, 24
STATE = "item bigint, length int, part int, bin bigint, at int, done boolean"


def _byte_of_letter() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: itself where it prints, else one
    from 256 on, in the order of the bytes."""
    printing = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in printing]
    return {chr(b): b for b in printing} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass(frozen=True)
class Encoder:
    """A rank-based encoder, and the vocabulary file's own library for texts that the former cannot read."""

    path: str
    fast: tiktoken.Encoding
    special_ids: bool

    @cached_property
    def library(self) -> Tokenizer:
        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.encode_special_tokens = not self.special_ids
        return tokenizer

    def ids(self, text: str) -> list[int]:
        if len(text) >= LONG_SPACE and LONG_RUN.search(text):
            return self.library.encode(text, add_special_tokens=False).ids
        return self.fast.encode(text, allowed_special="all") if self.special_ids else self.fast.encode_ordinary(text)


@lru_cache(maxsize=4)
def byte_bpe(path: str, pattern: str, special_ids: bool = False) -> Encoder:
    """An encoder for the byte-level BPE of a tokenizers JSON file.

    The file's merges are in the order of its ids, so ids are the ranks of a rank-based encoder. It yields
    the same ids as the file's own library at a fifth of the CPU time. With ``special_ids`` an added token's
    string in a text is that token, as it is by the library's defaults; without, it is ordinary text. Texts
    with a very long run of white space go to the library itself.
    """
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    special = {t["content"]: t["id"] for t in content.get("added_tokens", [])}
    letters = _byte_of_letter()
    ranks = {
        bytes(letters[c] for c in token): rank
        for token, rank in content["model"]["vocab"].items()
        if token not in special
    }
    fast = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
    return Encoder(path, fast, special_ids)


def token_ids(text: str | None, encoder: Encoder, end_id: int) -> np.ndarray:
    ids = np.array(encoder.ids(text or ""), dtype="<u4")
    return np.append(ids, np.uint32(end_id)).astype("<u4")


def piece_lengths(n_tokens: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: all full but the first."""
    rest = n_tokens % capacity
    return ([rest] if rest else []) + [capacity] * (n_tokens // capacity)


def tokenized_pieces(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    end_id: int = 2,
    capacity: int = 1024,
    with_ids: bool = True,
    text: str = "text",
    doc_id: str = "doc_id",
    special_ids: bool = False,
) -> DataFrame:
    """``item, doc_id, piece, start, length, ids_crc32`` and, with ``with_ids``, ``ids`` of each piece.

    NULL text counts as empty: a document is never without its end id. ``item`` numbers the pieces; write
    the result before using it twice, as the numbers follow the partitions of the run.
    """
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    if with_ids:
        fields.append(("ids", pa.list_(pa.int32())))
    schema = pa.schema(fields)
    ddl = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe(vocabulary, pattern, special_ids)
        for batch in batches:
            rows: list[tuple] = []
            pending = 0
            for key, body in zip(batch.column(0), batch.column(1), strict=True):
                ids = token_ids(body.as_py(), encoder, end_id)
                start = 0
                for place, length in enumerate(piece_lengths(len(ids), capacity)):
                    part = ids[start : start + length]
                    row = (key.as_py(), place, start, length, zlib.crc32(part.tobytes()))
                    rows.append((*row, part.astype(np.int32)) if with_ids else row)
                    start += length
                    pending += 1
                if pending >= 8192:
                    yield packed(rows)
                    rows, pending = [], 0
            yield packed(rows)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(fields)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    read = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    made = read.mapInArrow(cut, ddl + (", ids array<int>" if with_ids else ""))
    return made.select(F.monotonically_increasing_id().alias("item"), "*")


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each unit, and the fill of each bin: largest unit first, tightest gap first."""
    order = np.argsort(-sizes, kind="stable")
    bins = np.empty(len(sizes), dtype=np.int64)
    at = np.empty(len(sizes), dtype=np.int64)
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_gaps = 0  # bit g is set while a bin has a gap of g
    n_bins = 0
    gaps: list[int] = []
    for unit, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        fitting = open_gaps >> size
        if fitting:
            gap = size + (fitting & -fitting).bit_length() - 1
            chosen = by_gap[gap].pop()
            if not by_gap[gap]:
                open_gaps ^= 1 << gap
        else:
            gap, chosen = capacity, n_bins
            n_bins += 1
            gaps.append(capacity)
        bins[unit], at[unit] = chosen, capacity - gap
        gap -= size
        gaps[chosen] = gap
        if gap:
            by_gap[gap].append(chosen)
            open_gaps |= 1 << gap
    return bins, at, capacity - np.array(gaps, dtype=np.int64)


def _pack_part(rows: pd.DataFrame, capacity: int, least_fill: int) -> pd.DataFrame:
    """Pack the underfull sequences of a part again as units; rows are their pieces."""
    rows = rows.sort_values(["part", "bin", "at", "item"], kind="stable").reset_index(drop=True)
    fresh = (rows["at"] == 0).to_numpy()
    unit = np.cumsum(fresh) - 1
    sizes = np.bincount(unit, weights=rows["length"]).astype(np.int64)
    bins, shift, fill = best_fit(sizes, capacity)
    chosen = bins[unit]
    return rows.assign(bin=chosen, at=rows["at"] + shift[unit], done=fill[chosen] >= least_fill)


def _part_packer(capacity: int, least_fill: int):
    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        out = _pack_part(rows, capacity, least_fill)
        return out.assign(part=out["meets"]).drop(columns="meets")

    return merged


def pack(
    items: DataFrame,
    scratch: Scratch,
    capacity: int = 1024,
    units_per_part: int = 8192,
    fan_in: int = 8,
    slack: int = 2,
) -> DataFrame:
    """``item, sequence_id, offset`` for items of 1 to ``capacity`` tokens, given as ``item, length``."""
    full = items.filter(F.col("length") == capacity).select(
        "item", (F.col("item") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    short = items.filter(F.col("length") < capacity)
    units = short.count()
    parts = max(1, math.ceil(units / units_per_part))
    deal = F.pmod(F.xxhash64("item"), F.lit(parts)).cast("int")
    state = short.select(
        "item",
        F.col("length").cast("int").alias("length"),
        deal.alias("part"),
        F.col("item").alias("bin"),
        F.lit(0).alias("at"),
        F.lit(False).alias("done"),
        deal.alias("meets"),
    )
    placed = [full]
    turn = 0
    while units:
        least_fill = capacity - slack if parts > 1 else 0
        merged = _part_packer(capacity, least_fill)
        out = scratch.store(state.groupBy("meets").applyInPandas(merged, STATE), f"round-{turn}")
        left = out.filter("not done and at = 0").count()
        fewer = max(1, math.ceil(parts / fan_in), math.ceil(left / units_per_part))
        ends = fewer >= parts or left > 0.9 * units
        number = F.lit((turn << PART_BITS)) + F.col("part").cast("long")
        sequence = (F.shiftleft(number, BIN_BITS) + F.col("bin")) * 2 + 1
        finished = out if ends else out.filter("done")
        placed.append(finished.select("item", sequence.alias("sequence_id"), F.col("at").cast("long").alias("offset")))
        if ends or not left:
            break
        meets = F.floor(F.col("part").cast("long") * fewer / parts).cast("int")
        state = out.filter("not done").withColumn("meets", meets)
        parts, units, turn = fewer, left, turn + 1
    result = placed[0]
    for more in placed[1:]:
        result = result.union(more)
    return result


def packed_pieces(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    end_id: int = 2,
    capacity: int = 1024,
    with_ids: bool = True,
    text: str = "text",
    doc_id: str = "doc_id",
    special_ids: bool = False,
) -> DataFrame:
    """The pieces of all documents with ``sequence_id`` and ``offset``.

    Repeated rows are packed each by themselves. A table without rows has no pieces.
    """
    scratch = Scratch(docs.sparkSession)
    pieces = scratch.store(
        tokenized_pieces(docs, vocabulary, pattern, end_id, capacity, with_ids, text, doc_id, special_ids), "pieces"
    )
    places = pack(pieces.select("item", "length"), scratch, capacity)
    return pieces.join(places, "item").drop("item")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_ids`` of packed pieces with ids: one row per training sequence."""
    part = F.struct("offset", "ids", "doc_id")
    ordered = F.array_sort(F.collect_list(part))
    grouped = packed.groupBy("sequence_id").agg(ordered.alias("parts"))
    return grouped.select(
        "sequence_id",
        F.flatten(F.col("parts.ids")).alias("ids"),
        F.col("parts.doc_id").alias("doc_ids"),
    )

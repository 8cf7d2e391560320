"""Tokenizing and packing against the vocabulary's own library and plain arithmetic."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerstar.llm import packing, queries
from ledgerstar.session import Scratch

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


TEXTS = [
    "",
    None,
    "Hello  world\n\n\ttabs\r\n",
    "<|endoftext|> is text",
    "ümläut ß 日本語 🙂 1234567 it's we'll",
    "\x00\x0b  odd   spaces  ",
    "word " * 1023,
    "word " * 1024,
    "a" * 5000,
    "lorem ipsum dolor " * 4000,
]


def test_ids_are_those_of_the_library(reference):
    encoder = packing.byte_bpe(PATH, public_tokenizers.PATTERN)
    for text in TEXTS:
        assert packing.token_ids(text, encoder, 2).tolist() == reference(text)


def test_special_strings_as_by_the_library_defaults(spark):
    library = Tokenizer.from_file(PATH)
    special = "<|endoftext|>"
    texts = [
        f"a {special} b", special, special * 3, f"  {special}  x\n{special}\n", f"it's{special}'s <|endoftext|",
        f"{special}a" + "\n" * packing.LONG_SPACE + f"b {special}", *TEXTS,
    ]
    expected = [[*library.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    assert expected[0] == [64, 220, 50256, 275, 2]
    encoder = packing.byte_bpe(PATH, public_tokenizers.PATTERN, special_ids=True)
    assert [packing.token_ids(t, encoder, 2).tolist() for t in texts] == expected
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {(r["doc_id"], r["start"]): (r["length"], r["ids_crc32"]) for r in queries.packed(docs).collect()}
    cut = {}
    for i, ids in enumerate(expected):
        start = 0
        for length in packing.piece_lengths(len(ids), 1024):
            cut[i, start] = (length, zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes()))
            start += length
    assert got == cut


@pytest.mark.parametrize("space", ["\n", " ", "\u3000", " \t\r\n"])
def test_very_long_white_space(reference, space):
    encoder = packing.byte_bpe(PATH, public_tokenizers.PATTERN)
    runs = [packing.LONG_SPACE - 1, packing.LONG_SPACE, packing.LONG_SPACE + 1]
    for text in [f"a{(space * n)[:n]}{end}" for n in runs for end in ("", "b", " b!")]:
        assert packing.token_ids(text, encoder, 2).tolist() == reference(text)


def test_very_long_white_space_in_the_query(spark):
    docs = spark.createDataFrame([(1, "a" + "\n" * 3_000_000 + "b"), (2, "c")], "doc_id bigint, text string")
    sizes = {r[0]: r[1] for r in queries.packed(docs).groupBy("doc_id").sum("length").collect()}
    assert sizes == {1: 1_500_004, 2: 2}


def test_pieces_round_trip(spark, reference):
    rows = [(i, t, 5) for i, t in enumerate(TEXTS * 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, item int")
    got = packing.packed_pieces(docs, PATH, public_tokenizers.PATTERN).collect()
    ids = {}
    for r in sorted(got, key=lambda r: (r["doc_id"], r["piece"])):
        assert r["start"] == len(ids.setdefault(r["doc_id"], []))
        assert r["length"] == len(r["ids"]) <= 1024
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        assert r["piece"] == 0 or r["length"] == 1024
        ids[r["doc_id"]] += r["ids"]
    assert ids == {i: reference(t) for i, t, _ in rows}
    assert_gapless(got)


def assert_gapless(rows):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    return len(by_sequence)


@pytest.mark.parametrize("units_per_part", [50, 8192])
@pytest.mark.parametrize("kind", ["mixed", "unpairable", "tiny", "one"])
def test_rounds_place_every_item_once(spark, units_per_part, kind):
    rng = random.Random(3)
    lengths = {
        "mixed": [rng.randint(1, 1024) for _ in range(3000)],
        "unpairable": [rng.randint(520, 900) for _ in range(1500)],
        "tiny": [rng.randint(1, 9) for _ in range(3000)],
        "one": [17],
    }[kind]
    items = spark.createDataFrame(list(enumerate(lengths)), "item bigint, length bigint")
    placed = packing.pack(items, Scratch(spark), units_per_part=units_per_part, fan_in=4)
    rows = placed.join(items, "item").collect()
    assert sorted(r["item"] for r in rows) == list(range(len(lengths)))
    used = assert_gapless(rows)
    bound = math.ceil(sum(lengths) / 1024) if kind != "unpairable" else len(lengths)
    # very small parts leave sequences that no longer pair as wholes
    assert used <= math.ceil(bound * (1.03 if units_per_part > 1000 else 1.1)) + 1


def test_best_fit_takes_the_tightest_gap():
    bins, at, fill = packing.best_fit(np.array([600, 500, 400, 520, 20]), 1024)
    assert bins.tolist() == [0, 1, 0, 1, 0]
    assert at.tolist() == [0, 520, 600, 0, 1000]
    assert fill.tolist() == [1020, 1020]


def test_empty_table_and_sequences(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert queries.packed(empty).count() == 0
    docs = spark.createDataFrame([(1, "a b c"), (None, "d e"), (1, "a b c")], "doc_id bigint, text string")
    made = packing.sequences(packing.packed_pieces(docs, PATH, public_tokenizers.PATTERN)).collect()
    assert len(made) == 1
    assert sorted(made[0]["doc_ids"], key=str) == [1, 1, None]
    assert made[0]["ids"].count(2) == 3

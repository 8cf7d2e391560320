"""Language identification by cross-parsing against suffix automata of labelled text.

Each language has a sample of labelled text. Its suffix automaton accepts exactly the substrings of the
sample, so walking a text through it from left to right cuts the text into the longest matches: a phrase
ends where the sample holds no longer match. A text in the sample's language needs few phrases. With
``c`` phrases over ``m`` symbols and a sample of ``n`` symbols the cost is ``c * log2(n) / m`` bits a
symbol, and the language of the least cost wins (the more frequent one on a tie).

Texts are lower-cased; letters are symbols, every run of other characters is one space. A text is parsed
in blocks of ``block`` symbols, whose ends also end a phrase: all blocks of a batch walk side by side.
Before the walk a text is laid out whole, at some 20 bytes a character.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstar.llm.common import sample_per_class

UNDETERMINED = "und"
SPACE = 0
CODE_POINTS = 0x110000
RESULT = "lang_pred string, score double, explained double"


@dataclass(frozen=True)
class Settings:
    """Bounds of the fit: all apply to the labelled sample only, never to the texts judged.

    They are the same for every language, however many there are. An automaton of 40,000 symbols takes about
    a megabyte, so a model of the most languages takes some 200 MB on each worker.
    """

    max_languages: int = 200
    documents_per_language: int = 96
    symbols_per_document: int = 1500
    symbols_per_language: int = 40_000
    max_letters: int = 20_000
    block: int = 2048


@dataclass(frozen=True)
class LanguageModel:
    """Automata of all languages in one table, their sparse rows laid over each other.

    A state is a number of its own, and its move by a symbol stands at the sum of both: the state it belongs
    to in the upper half of the entry, the next state in the lower. Where another state's move stands there,
    or none, the symbol begins a new phrase, and ``first`` has the state after it. ``own`` is what a symbol
    is to each language, and ``between`` are the languages' states without moves.
    """

    languages: tuple[str, ...]
    bits: np.ndarray
    symbol_of: np.ndarray
    n_symbols: int
    table: np.ndarray
    first: np.ndarray
    own: np.ndarray
    between: np.ndarray
    block: int


def symbols(text: str, symbol_of: np.ndarray) -> np.ndarray:
    """Symbols of one text, without leading spaces and with single ones between words."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    raw = symbol_of[points]
    return raw[_kept(raw, np.zeros(1, dtype=np.int64))]


def _kept(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    kept = np.ones(len(raw), dtype=bool)
    if len(raw):
        space = raw == SPACE
        kept[1:] = ~(space[1:] & space[:-1])
        firsts = starts[starts < len(raw)]
        kept[firsts] = ~space[firsts]
    return kept


def suffix_automaton(sequence: np.ndarray) -> list[dict[int, int]]:
    """Transitions of the least automaton of all substrings; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for symbol in sequence.tolist():
        state = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at != -1 and symbol not in moves[at]:
            moves[at][symbol] = state
            at = link[at]
        if at != -1:
            target = moves[at][symbol]
            if length[target] == length[at] + 1:
                link[state] = target
            else:
                copy = len(moves)
                moves.append(dict(moves[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                link[target] = link[state] = copy
                while at != -1 and moves[at].get(symbol) == target:
                    moves[at][symbol] = copy
                    at = link[at]
        last = state
    return moves


def _alphabet(texts: list[str], max_letters: int) -> tuple[np.ndarray, int]:
    """The symbol of every code point: space, one for each frequent letter, one for all others."""
    counts: Counter[str] = Counter()
    for text in texts:
        counts.update(text.lower())
    letters = [c for c in counts if c.isalpha()]
    known = sorted(letters, key=lambda c: (-counts[c], c))[:max_letters]
    other = len(known) + 1
    table = np.fromiter(
        (other if chr(i).isalpha() else SPACE for i in range(CODE_POINTS)), np.uint16, CODE_POINTS
    )
    for i, letter in enumerate(known):
        table[ord(letter)] = i + 1
    return table, other + 1


def even_shares(lengths: list[int], total: int) -> list[int]:
    """How much of each length to take for ``total`` in all: the same of each, and more where others are short."""
    shares, left = [0] * len(lengths), total
    for place, i in enumerate(sorted(range(len(lengths)), key=lambda i: lengths[i])):
        shares[i] = min(lengths[i], left // (len(lengths) - place))
        left -= shares[i]
    return shares


def laid_over(moves: list[dict[int, int]], n_symbols: int) -> tuple[list[int], int]:
    """A number for each state, so that no two states' moves meet at one sum of number and symbol, and the
    end of all those places.

    States of many moves come first, each at the first number that fits near the lowest free place; states of
    one move fill the places between. A number that did not fit a symbol's one move never fits one again.
    """
    taken, used = bytearray(4 * (len(moves) + n_symbols)), set()
    numbers = [0] * len(moves)
    next_number = [0] * n_symbols
    low, end = 0, 0
    for state in sorted(range(1, len(moves)), key=lambda i: -len(moves[i])):
        here = list(moves[state]) or [0]
        lead = min(here)
        if len(here) > 1:
            while taken[low]:
                low += 1
            number, most = max(0, low - lead), max(0, low - lead) + 64
            while number in used or any(taken[number + s] for s in here):
                number = number + 1 if number < most else max(number + 1, end)
        else:
            number = next_number[lead]
            while number in used or taken[number + lead]:
                number += 1
            next_number[lead] = number + 1
        for s in here:
            taken[number + s] = 1
        used.add(number)
        numbers[state] = number
        end = max(end, number + 1)
        if end + 2 * n_symbols + 64 >= len(taken):
            taken.extend(bytes(len(taken)))
    # The start state moves by the table of first states; it stands where nothing is.
    numbers[0] = end + n_symbols
    return numbers, numbers[0] + n_symbols + 1


def build_model(samples: dict[str, list[str]], settings: Settings = Settings()) -> LanguageModel:
    """The model of ``samples``: texts by language, the more frequent language first."""
    # Symbols beyond a document's share are cut here as well, before letters are counted.
    cut = {
        name: [t[: 4 * settings.symbols_per_document] for t in texts if t]
        for name, texts in samples.items()
    }
    symbol_of, n_symbols = _alphabet([t for texts in cut.values() for t in texts], settings.max_letters)
    names, bits, tables, firsts, own_symbols, between, base = [], [], [], [], [], [], 0
    for name, texts in cut.items():
        parts = [symbols(t, symbol_of)[: settings.symbols_per_document] for t in texts]
        parts = [p for p in parts if len(p)]
        if not parts:
            continue
        shares = even_shares([len(p) + 1 for p in parts], settings.symbols_per_language)
        sequence = np.concatenate([np.append(p, np.uint16(SPACE))[-n:] if n > len(p) else p[:n] for p, n in zip(parts, shares, strict=True)])
        # Each language counts its own symbols through, which keeps its rows short; -1 is none of them.
        present = np.unique(sequence)
        own = np.full(n_symbols, -1, dtype=np.int32)
        own[present] = np.arange(len(present))
        moves = suffix_automaton(own[sequence])
        numbers, size = laid_over(moves, len(present))
        table = np.full(size, -1, dtype=np.int64)
        for state, to in enumerate(moves):
            for symbol, target in to.items() if state else ():
                table[numbers[state] + symbol] = (base + numbers[state]) << 32 | (base + numbers[target])
        first = np.full(n_symbols, base + numbers[0], dtype=np.int64)
        for symbol, target in moves[0].items():
            first[present[symbol]] = base + numbers[target]
        own_symbols.append(own)
        names.append(name)
        bits.append(math.log2(max(2, len(sequence))))
        tables.append(table)
        firsts.append(first)
        between.append(base + numbers[0])
        base += size
    return LanguageModel(
        tuple(names),
        np.array(bits),
        symbol_of,
        n_symbols,
        np.concatenate(tables) if tables else np.zeros(0, np.int64),
        np.array(firsts, dtype=np.int64).reshape(len(names), n_symbols),
        np.array(own_symbols, dtype=np.int32).reshape(len(names), n_symbols),
        np.array(between, dtype=np.int64),
        settings.block,
    )


def fit(
    docs: DataFrame, settings: Settings = Settings(), text: str = "text", label: str = "lang", key: str = "doc_id"
) -> LanguageModel:
    """Fit on a bounded sample of the rows of ``docs`` whose text and label are given."""
    usable = docs.filter(F.col(text).isNotNull() & F.col(label).isNotNull()).select(key, label, text)
    chosen = sample_per_class(
        usable, label, settings.documents_per_language, settings.max_languages, key
    ).select(label, key, F.left(F.col(text), F.lit(4 * settings.symbols_per_document)).alias(text))
    rows = sorted(chosen.collect(), key=lambda r: (r[0], str(r[1]), r[2]))
    order = [r[0] for r in usable.groupBy(label).count().orderBy(F.desc("count"), label).limit(settings.max_languages).collect()]
    samples: dict[str, list[str]] = {name: [] for name in order}
    for name, _, body in rows:
        samples[name].append(body)
    return build_model(samples, settings)


def phrase_counts(model: LanguageModel, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Phrases of each block in each language: blocks x languages. All blocks walk in step."""
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    state = np.repeat(model.between[:, None], len(starts), axis=1)
    counts = np.zeros(state.shape, dtype=np.int64)
    # active[t]: how many blocks, the longest first, have more than t symbols
    active = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), side="left")
    table, first, own = model.table, model.first, model.own
    for step, live in enumerate(active.tolist()):
        symbol, here = flat[starts[:live] + step], state[:, :live]
        entry = table[here + own[:, symbol]]
        goes_on = (entry >> 32) == here
        counts[:, :live] += ~goes_on
        state[:, :live] = np.where(goes_on, entry & 0xFFFFFFFF, first[:, symbol])
    out = np.empty((len(starts), len(model.languages)), dtype=np.int64)
    out[order] = counts.T
    return out


def classify(model: LanguageModel, texts: list[str | None], at_once: int = 1 << 20) -> pd.DataFrame:
    """Language, score and share of phrases for each text."""
    names: list[str] = []
    scores: list[float] = []
    shares: list[float] = []
    batch: list[str] = []
    size = 0
    for text in [*texts, None]:
        batch.append(text or "")
        size += len(text or "")
        if size >= at_once or len(batch) >= 4096:
            _classify_batch(model, batch, names, scores, shares)
            batch, size = [], 0
    _classify_batch(model, batch, names, scores, shares)
    n = len(texts)
    return pd.DataFrame({"lang_pred": names[:n], "score": scores[:n], "explained": shares[:n]})


def _marks_before(marks: np.ndarray, places: np.ndarray) -> np.ndarray:
    """How many marks are set before each of these places."""
    counts = np.zeros(len(marks) + 1, dtype=np.int32 if len(marks) < 1 << 31 else np.int64)
    np.cumsum(marks, out=counts[1:], dtype=counts.dtype)
    return counts[places].astype(np.int64)


def _classify_batch(model, batch, names, scores, shares) -> None:
    if not batch:
        return
    lowered = [t.lower() for t in batch]
    sizes = np.array([len(t) for t in lowered], dtype=np.int64)
    firsts = np.concatenate([[0], np.cumsum(sizes)])
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    raw = model.symbol_of[points]
    kept = _kept(raw, firsts[:-1][sizes > 0])
    before = _marks_before(kept, firsts)
    has_letters = np.diff(_marks_before(raw != SPACE, firsts)) > 0
    flat = raw[kept]
    start, m = before[:-1], np.diff(before)
    blocks = np.where(has_letters, -(-m // model.block), 0)
    owner = np.repeat(np.arange(len(batch)), blocks)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    block_start = start[owner] + within * model.block
    block_length = np.minimum(model.block, m[owner] - within * model.block)
    phrases = np.zeros((len(batch), len(model.languages)), dtype=np.int64)
    if len(model.languages) and len(owner):
        np.add.at(phrases, owner, phrase_counts(model, flat, block_start, block_length))
    for i in range(len(batch)):
        if not has_letters[i] or not len(model.languages):
            names.append(UNDETERMINED)
            scores.append(0.0)
            shares.append(0.0)
            continue
        cost = phrases[i] * model.bits / m[i]
        best = int(np.argmin(cost))
        rest = np.delete(cost, best)
        names.append(model.languages[best])
        scores.append(float(1.0 - cost[best] / rest.min()) if len(rest) else 1.0)
        shares.append(float(1.0 - phrases[i, best] / m[i]))


def language_of(model: LanguageModel, text: Column, spark) -> Column:
    """A struct of ``lang_pred``, ``score`` and ``explained`` for a text column.

    ``score`` is the part of the second-best cost that the best saves (0 to 1). ``explained`` is one less
    the phrases a symbol: 0 where no two symbols in a row occur in the sample. NULL, empty and letterless
    texts, and every text where nothing could be learned, get ``und`` and 0.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield classify(shared.value, [t if isinstance(t, str) else None for t in texts])

    return judge(text)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``explained``; columns of those names are replaced."""
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "explained", "_judged")]
    judged = docs.select(*kept).withColumn("_judged", language_of(model, F.col(text), docs.sparkSession))
    return judged.select(*kept, "_judged.*")


def accepted(docs: DataFrame, model: LanguageModel, text: str = "text", least_explained: float = 0.25) -> DataFrame:
    """Rows in a learned language. Letterless texts go, and those that no sample explains: most of their
    symbols begin a phrase of their own, as in an unknown script."""
    judged = docs.withColumn("_judged", language_of(model, F.col(text), docs.sparkSession))
    passed = (F.col("_judged.lang_pred") != UNDETERMINED) & (F.col("_judged.explained") >= least_explained)
    return judged.filter(passed).select(*docs.columns)

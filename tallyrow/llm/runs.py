"""Runs of repeated words in whole texts, found by recompression.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical), of at least ``least`` words and three periods, that no neighbouring word
extends. Each is found on a harmonic grid: for every q up to a third of the text, places
0, q, 2q, ... A run of period q holds two neighbouring places at least whose word is also q
and 2q words on, so all other places are passed over by comparing words alone. For
the places left, how far the texts from i and i + q agree to the right, and those before them
to the left, gives the whole stretch at once; period and place are never extended word by word.

**How far texts agree** is asked of a grammar. The words of the texts are rewritten level by
level: *blocks* of one symbol become a symbol of their own, then *pairs* do, of a symbol that
falls on the left side of a split of the symbols and one on the right side. Equal stretches are
rewritten alike but for a few symbols at their ends. Two places are compared going up: at
each level what does not begin a symbol of the next level is compared and passed (at
most one pair's end or the rest of a block), until the symbols differ; then going down, where
what the differing symbols begin with alike is passed. Levels end when no symbol stands
twice in a text. Every level takes all open questions at once. Backwards, the grammar of
the reversed texts answers. Texts without a place left ask nothing and get no grammar.

Work goes text by text in blocks of words, n log n for a text of n words, without a
shuffle; memory follows the longest text, about 1 kB a word while its grammar stands and
a fixed number of places of the grid.

Null and empty texts have no words. Rows are kept as they come, repeated and id-less
ones too. Output columns replace input columns of the same name. An empty table
gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyrow.llm.words import blocks, mix64

LEAST = 24  # words of a run
PERIODS = 3  # periods of a run

# Places of the grid that are looked at together; words of texts that share a grammar.
_PLACES = 1 << 20
_WORDS = 1 << 15

WORD = re.compile(r"[^\x20\x09-\x0D]+")

Levels = list[tuple[np.ndarray, np.ndarray, np.ndarray]]


def _named(codes: np.ndarray) -> np.ndarray:
    return np.unique(codes, return_inverse=True)[1].astype(np.int64)


class Grammar:
    """Levels of texts that stand one after the other; symbols of different texts differ, and each text has an end of its own.

    A level holds its symbols, the place of each one's parent in the next level, and the place of
    each one's first child in the level below. Even levels are cut into blocks, odd ones into pairs.
    """

    def __init__(self, words: np.ndarray, texts: np.ndarray):
        """``words`` with an end mark after each text that is found nowhere else; ``texts`` numbers each word's text."""
        symbols = _named(texts * (int(words.max(initial=0)) + 1) + words)
        self.symbols, self.parent, self.child, self.again = [symbols], [], [np.arange(len(symbols))], []
        self.starts = [np.arange(len(symbols))]
        while True:
            seen = np.bincount(symbols)
            if seen.max(initial=0) < 2:
                break
            first = self._blocks(symbols) if len(self.parent) % 2 == 0 else self._pairs(symbols)
            begin = np.flatnonzero(first)
            size = np.diff(begin, append=len(symbols))
            if len(self.parent) % 2 == 0:
                above = _named(symbols[begin] * (int(size.max()) + 1) + size)
            else:
                last = np.where(size == 2, symbols[np.minimum(begin + 1, len(symbols) - 1)] + 1, 0)
                above = _named(symbols[begin] * (int(symbols.max()) + 2) + last)
            self.parent.append(np.cumsum(first) - 1)
            self.child.append(begin)
            self.starts.append(self.starts[-1][begin])
            self.symbols.append(above)
            symbols = above

    @staticmethod
    def _blocks(symbols: np.ndarray) -> np.ndarray:
        return np.r_[True, symbols[1:] != symbols[:-1]]

    def _pairs(self, symbols: np.ndarray) -> np.ndarray:
        """Where a symbol of the level above begins; neighbours differ here."""
        with np.errstate(over="ignore"):
            salt = mix64(np.array([len(self.parent) + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            left = (mix64(np.arange(int(symbols.max()) + 1, dtype=np.uint64) ^ salt) & np.uint64(1)).astype(bool)[symbols]
        first = np.ones(len(symbols), bool)
        forth, back = left[:-1] & ~left[1:], ~left[:-1] & left[1:]
        first[1:] = ~(forth if forth.sum() >= back.sum() else back)
        return first

    def agree(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words from x on equal those from y on. x differs from y."""
        here, there = x.copy(), y.copy()
        level_of = np.zeros(len(x), np.int64)
        rising = np.arange(len(x))
        for level, parent in enumerate(self.parent):
            symbols, child = self.symbols[level], self.child[level + 1]
            p, q = here[rising], there[rising]
            alike = symbols[p] == symbols[q]
            level_of[rising[~alike]] = level
            rising, p, q = rising[alike], p[alike], q[alike]
            if not len(rising):
                break
            inside = (child[parent[p]] != p) | (child[parent[q]] != q)
            # What is left of both parents, from p and from q on; equal symbols, so a block's rest or a pair's end.
            ends = np.append(child[1:], len(symbols))
            rest_p, rest_q = ends[parent[p]] - p, ends[parent[q]] - q
            passed = np.where(inside, np.minimum(rest_p, rest_q), 0)
            p, q = p + passed, q + passed
            here[rising], there[rising] = p, q
            # Past unequal rests of a block the next symbols differ.
            over = inside & (rest_p != rest_q) if level % 2 == 0 else np.zeros(len(p), bool)
            level_of[rising[over]] = level
            rising, p, q = rising[~over], p[~over], q[~over]
            here[rising], there[rising] = parent[p], parent[q]
        else:
            level_of[rising] = len(self.parent)
        for level in range(len(self.parent), 0, -1):
            now = np.flatnonzero(level_of == level)
            if not len(now):
                continue
            below, child = self.symbols[level - 1], self.child[level]
            ends = np.append(child[1:], len(below))
            p, q = here[now], there[now]
            size_p, size_q = ends[p] - child[p], ends[q] - child[q]
            p, q = child[p], child[q]
            passed = np.where(below[p] == below[q], np.minimum(size_p, size_q) if level % 2 else 1, 0)
            here[now], there[now] = p + passed, q + passed
            level_of[now] = level - 1
        return here - x


def _grid(lengths: np.ndarray, begins: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places i (counted over all texts) and periods q of the harmonic grid, with i + 2q inside the text."""
    most = lengths // PERIODS
    text = np.repeat(np.arange(len(lengths)), most)
    period = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    count = (lengths[text] - 1) // period - 1
    ends = np.cumsum(count)
    at = 0
    while at < len(text):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + _PLACES, side="right")))
        part = count[at:to]
        step = np.arange(part.sum()) - np.repeat(np.cumsum(part) - part, part)
        q = np.repeat(period[at:to], part)
        yield begins[np.repeat(text[at:to], part)] + step * q, q
        at = to


def find(texts: list[np.ndarray], least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each text, given as numbers that stand for its words."""
    lengths = np.array([len(t) for t in texts], np.int64)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    able = np.flatnonzero(lengths >= max(least, PERIODS))
    if not len(able):
        return found
    words = np.concatenate([texts[t] for t in able]).astype(np.int64)
    lengths = lengths[able]
    begins = np.cumsum(lengths) - lengths
    places, periods = [], []
    for i, q in _grid(lengths, begins):
        hit = np.flatnonzero(words[i] == words[i + q])
        hit = hit[words[i[hit] + q[hit]] == words[i[hit] + 2 * q[hit]]]
        places.append(i[hit])
        periods.append(q[hit])
    place, period = np.concatenate(places), np.concatenate(periods)
    owner = np.searchsorted(begins, place, side="right") - 1
    asked = np.unique(owner)
    if not len(asked):
        return found
    # The texts with a question, each followed by an end mark.
    size = lengths[asked] + 1
    base = np.cumsum(size) - size
    number = np.repeat(np.arange(len(asked)), size)
    row = np.zeros(size.sum(), np.int64)
    body = np.ones(len(row), bool)
    body[base + size - 1] = False
    row[body] = np.concatenate([words[begins[t] : begins[t] + lengths[t]] for t in asked]) + 1
    which = np.searchsorted(asked, owner)
    i = place - begins[owner] + base[which]
    length = _spans(row, number, base, size, i, period)
    start, span = i - length[1], length[0] + length[1] + period
    good = span >= np.maximum(least, PERIODS * period)
    start, span, period, which = start[good], span[good], period[good], which[good]
    # One stretch may be found with several periods: the smallest is its own.
    order = np.lexsort((period, span, start))
    start, span, period, which = start[order], span[order], period[order], which[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (span[1:] != span[:-1])
    for s, n, q, w in zip((start - base[which])[new].tolist(), span[new].tolist(), period[new].tolist(), which[new].tolist()):
        found[able[asked[w]]].append((s, n, q))
    for runs in found:
        runs.sort(key=lambda run: (run[0], run[2]))
    return found


def _spans(row: np.ndarray, number: np.ndarray, base: np.ndarray, size: np.ndarray, i: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many words from i and i + q on agree, and how many before them."""
    forth = Grammar(row, number).agree(i, i + q)
    # Reversed, the end mark stays behind: word k of a text becomes word size - 2 - k.
    mirror = np.repeat(2 * base + size - 2, size) - np.arange(len(row))
    mirror[base + size - 1] = base + size - 1
    back = Grammar(row[mirror], number)
    some = np.flatnonzero(i > base[number[i]])
    before = np.zeros(len(i), np.int64)
    before[some] = back.agree(mirror[i[some] - 1], mirror[i[some] + q[some] - 1])
    return forth, before


def kept(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words no run repeats: a run's first period stays."""
    drop = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return np.cumsum(drop[:n]) == 0


def numbered(words: list[str]) -> np.ndarray:
    """Equal words, equal numbers."""
    known: dict[str, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def repetitions(docs: DataFrame, column: str = "text", repeat: str | None = None, least: int = LEAST) -> DataFrame:
    """``docs`` without the text, with ``n_words``, ``runs`` (array of start, length, period by start) and ``collapsed``.

    ``collapsed`` is the text's words without what runs repeat, joined by a space. ``repeat`` names an optional
    column (struct of ``first`` and ``period``, both long): from word ``first`` on, a row's words are taken
    to repeat every ``period`` words; null leaves them as they are.
    """
    new = ("n_words", "runs", "collapsed")
    given = [c for c in docs.columns if c not in (column, *new, repeat)]
    fields = "n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in given), fields])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in blocks(batches, column, _WORDS * 8):
            rows = []
            plan = batch.column(repeat).to_pylist() if repeat else [None] * batch.num_rows
            for text, how in zip(batch.column(column).to_pylist(), plan):
                words = np.array(WORD.findall(text or ""), dtype=object)
                if how is not None and len(words):
                    where = np.arange(len(words))
                    words = words[np.where(where < how["first"], where, how["first"] + (where - how["first"]) % how["period"])]
                rows.append(words)
            runs = find([numbered(w) for w in rows], least)
            collapsed = [" ".join(w[kept(len(w), r)] if r else w) for w, r in zip(rows, runs)]
            listed = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in given),
                    pa.array([len(w) for w in rows], pa.int64()),
                    pa.array(listed, kind),
                    pa.array(collapsed, pa.string()),
                ],
                names=[*given, *new],
            )

    return docs.select(*given, column, *([repeat] if repeat else [])).mapInArrow(run, schema)

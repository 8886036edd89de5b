"""Words of whole texts as 64-bit hashes, in numpy, straight from Arrow buffers.

A word is a run of bytes that are neither white space nor, where asked, anything
but letters. Work goes piece by piece, so memory does not follow text length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

PIECE = 1 << 18

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64's finisher)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbered(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix64((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * _GOLDEN)


_BYTE = numbered(256, 1)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]  # A-Z count as a-z
_PLACE = numbered(1 << 12, 2) | np.uint64(1)


def byte_value(letters: np.ndarray, place: int) -> np.ndarray:
    """What letters at one place of a word add to its hash, A-Z as a-z."""
    with np.errstate(over="ignore"):
        return _FOLDED[letters] * _PLACE[place]


def others(docs: DataFrame, *names: str) -> list[str]:
    """The columns of a table but for those of some names, which Spark tells apart whatever their case."""
    return [c for c in docs.columns if c.lower() not in {n.lower() for n in names}]


NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, *range(9, 14)]] = False
LETTER = np.zeros(256, bool)  # letters of any script: every byte of a non-ASCII character counts
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and the n + 1 offsets of its rows; a null row is empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def _places(n: int) -> np.ndarray:
    global _PLACE
    if n > len(_PLACE):
        _PLACE = numbered(1 << (n - 1).bit_length(), 2) | np.uint64(1)
    return _PLACE


def _cuts(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray, piece: int) -> Iterator[tuple[int, int]]:
    """Pieces of about ``piece`` bytes that end where a word ends."""
    at = 0
    while at < len(raw):
        to, step = min(at + piece, len(raw)), piece
        while to < len(raw) and inside[raw[to - 1]] and inside[raw[to]]:
            far = min(to + step, len(raw))
            gap = np.flatnonzero(~inside[raw[to:far]])
            to, step = (to + int(gap[0]), step) if len(gap) else (far, step * 2)
            if len(gap):
                break
        yield at, to
        at = to


def word_hashes(
    raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray = NOT_SPACE, fold: bool = True, piece: int = PIECE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte, row) of every word, in text order; rows end words."""
    values = _FOLDED if fold else _BYTE
    hashes, starts = [], []
    for at, to in _cuts(raw, offsets, inside, piece):
        part = raw[at:to]
        word = inside[part]
        first = word.copy()
        first[1:] &= ~word[:-1]
        rows = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, to)] - at
        first[rows] = word[rows]
        begin = np.flatnonzero(first)
        if not len(begin):
            continue
        letters = part[word]
        where = np.cumsum(word, dtype=np.int32)
        start = where[begin] - 1
        length = np.diff(start, append=np.int32(len(letters)))
        place = np.arange(len(letters), dtype=np.int32) - np.repeat(start, length)
        with np.errstate(over="ignore"):
            product = values[letters]
            product *= _places(int(length.max()))[place]
            hashes.append(mix64(np.add.reduceat(product, start)))
        starts.append(begin.astype(np.int64) + at)
    if not hashes:
        empty = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), empty, empty
    begins = np.concatenate(starts)
    return np.concatenate(hashes), begins, np.searchsorted(offsets, begins, side="right") - 1


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``most`` bytes of text, one row at least."""
    for batch in batches:
        sizes = np.diff(text_buffer(batch.column(column))[1])
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(at, to - at)
            at = to


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Rows of one key after the other, from rows that come ordered by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = np.asarray(batch.column(key))
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                if held and held[0].column(key)[0].as_py() != keys[a]:
                    yield held[0].column(key)[0].as_py(), pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    held = []
                held.append(batch.slice(a, b - a))
    if held:
        yield held[0].column(key)[0].as_py(), pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and how often each stands."""
    keys = np.sort(keys)
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[new], np.diff(new, append=len(keys))


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[new], np.add.reduceat(counts, new)

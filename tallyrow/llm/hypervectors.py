"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1, drawn from its code point.
Three neighbouring letters are bound to one vector: the first letter's vector
rotated twice, times the second's rotated once, times the third's. A text is the
sum (bundle) of its trigrams' vectors, a language the sum over its texts. A text
gets the language whose prototype, less the mean of all prototypes' directions,
has the largest cosine with it.

Letters are lower-cased; every run of other characters counts as one space, and
a text begins and ends with one. Trigrams without a letter do not count.

Bundling is a count matrix times the trigram vectors, so neither training nor
scoring ever holds a vector per occurrence. Prototypes are bundled inside tasks;
Spark adds up one vector per task and language.

A text without a letter (or null) is ``und`` with score 0. If nothing could be
learned, every text is. Ties go to the language that sorts first. Repeated rows are
learned and predicted each; an empty table gives no rows. Columns named ``lang_pred``
or ``score`` give way to the prediction's. Bundling takes some 20 bytes per character
of the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrow.llm.words import blocks, mix64, others

DIM = 1024
UNKNOWN = "und"

# Trigram vectors that are held at once.
_SLICE = 8192
# Trigram codes up to this many are counted in a table, more are sorted.
_TABLE = 1 << 21


@cache
def _letters() -> np.ndarray:
    """Of every code point the lower-case letter, or 32 for what is no letter."""
    out = np.full(0x110000, 32, np.uint32)
    for code in range(0x110000):
        sign = chr(code)
        if sign.isalpha():
            low = sign.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


def letter_vectors(codes: np.ndarray, dim: int) -> np.ndarray:
    """The +1/-1 vectors of code points."""
    words = dim // 64
    with np.errstate(over="ignore"):
        seeds = (codes.astype(np.uint64)[:, None] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + np.arange(words, dtype=np.uint64)
        bits = np.unpackbits(mix64(mix64(seeds)).view(np.uint8), axis=1)
    return bits.astype(np.float32) * 2 - 1


def _trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct trigrams as three code points, trigram of each position, first position of each text).

    Positions that are no trigram hold the number of distinct ones.
    """
    joined = " " + "  ".join(t or "" for t in texts) + " "
    raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    seen = np.zeros(0x110000, bool)
    seen[raw] = True
    codes = np.flatnonzero(seen)
    alphabet, small = np.unique(np.append(_letters()[codes], np.uint32(32)), return_inverse=True)
    table = np.zeros(0x110000, np.int32)
    table[codes] = small[:-1]
    space, base = small[-1], len(alphabet)
    letters = table[raw]
    gap = letters == space
    first = np.cumsum([0, *(len(t or "") + 2 for t in texts[:-1])])
    keep = np.ones(len(letters), bool)
    keep[1:] = ~(gap[1:] & gap[:-1])
    keep[first] = True  # one text's last space, then the next one's first
    first = np.r_[0, np.cumsum(np.add.reduceat(keep, first, dtype=np.int64))[:-1]]
    letters = letters[keep]
    wide = letters if base**3 < 1 << 31 else letters.astype(np.int64)
    code = (wide[:-2] * base + wide[1:-1]) * base + wide[2:]
    if base**3 <= _TABLE:
        used = np.zeros(base**3, bool)
        used[code] = True
        distinct = np.flatnonzero(used)
        place = np.zeros(base**3, np.int32)
    else:
        distinct, inverse = np.unique(code, return_inverse=True)
    a, b, c = distinct // (base * base), distinct // base % base, distinct % base
    # The middle is a letter, or letters stand on both sides of a space; a step from text to text has two spaces.
    good = (b != space) | ((a != space) & (c != space))
    number = np.where(good, np.cumsum(good) - 1, good.sum()).astype(np.int32)
    if base**3 <= _TABLE:
        place[distinct] = number
        code = place[code]
    else:
        code = number[inverse]
    return np.stack([alphabet[x[good]] for x in (a, b, c)], axis=1), code, first


def bundle(texts: list[str | None], groups: np.ndarray, n_groups: int, dim: int = DIM) -> np.ndarray:
    """The summed trigram vectors of each group of texts."""
    out = np.zeros((n_groups, dim), np.float32)
    parts, code, first = _trigrams(texts)
    letters, place = np.unique(parts, return_inverse=True)
    vectors = letter_vectors(letters, dim)
    once, twice = np.roll(vectors, 1, axis=1), np.roll(vectors, 2, axis=1)
    a, b, c = place.reshape(parts.shape).T
    ends = np.append(first[1:], len(code))
    for at in range(0, len(parts), _SLICE):
        to = min(at + _SLICE, len(parts))
        counts = np.zeros((n_groups, to - at), np.float32)
        for group, start, end in zip(groups, first, ends):
            here = code[start:end]
            if len(parts) > _SLICE:
                here = here[(here >= at) & (here < to)] - at
            counts[group] += np.bincount(here, minlength=to - at)[: to - at]
        out += counts @ (twice[a[at:to]] * once[b[at:to]] * vectors[c[at:to]])
    return out


@dataclass(frozen=True)
class Profiles:
    languages: tuple[str, ...]
    directions: np.ndarray  # unit vectors, one per language

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language of each text and its cosine, no less than 0."""
        sums = bundle(texts, np.arange(len(texts)), len(texts), self.directions.shape[1])
        length = np.linalg.norm(sums, axis=1)
        some = np.fromiter((any(map(str.isalpha, t or "")) for t in texts), bool, len(texts))
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        cosine = sums @ self.directions.T / np.maximum(length, 1e-9)[:, None]
        best = cosine.argmax(axis=1)
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, some)]
        return names, np.where(some, np.clip(cosine[np.arange(len(texts)), best], 0, 1), 0.0)


def fit(docs: DataFrame, learn: Column, dim: int = DIM) -> Profiles:
    """Prototypes of the languages (``lang``) of the texts for which ``learn`` holds; all of them are bundled."""

    def run(batches: Iterator[pa.RecordBatch]):
        sums: dict[str, np.ndarray] = {}
        for batch in blocks(batches, most=1 << 20):
            names, group = np.unique(np.array(batch.column("lang").to_pylist(), dtype=object), return_inverse=True)
            for name, vector in zip(names, bundle(batch.column("text").to_pylist(), group, len(names), dim)):
                sums[name] = sums.get(name, 0) + vector.astype(np.float64)
        for name, vector in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": [name] * dim, "place": np.arange(dim), "value": vector})

    sums = (
        docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
        .select("lang", "text")
        .mapInArrow(run, "lang string, place bigint, value double")
        .groupBy("lang", "place")
        .agg(F.sum("value").alias("value"))
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("vector"))  # dim entries
        .collect()
    )
    rows = sorted((r["lang"], np.array([x["value"] for x in r["vector"]])) for r in sums if any(x["value"] for x in r["vector"]))
    if not rows:
        return Profiles((), np.zeros((0, dim), np.float32))
    unit = np.stack([v / np.linalg.norm(v) for _, v in rows])
    if len(rows) > 1:
        unit = unit - unit.mean(axis=0)
        unit = unit / np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-12)
    return Profiles(tuple(name for name, _ in rows), unit.astype(np.float32))


def predict(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """``docs`` without the text, with ``lang_pred`` and ``score``."""
    kept = others(docs, "text", "lang_pred", "score")
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept), "lang_pred string, score double"])

    def run(batches):
        for batch in blocks(batches, most=1 << 20):
            names, scores = profiles.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*kept, "lang_pred", "score"],
            )

    return docs.select(*kept, "text").mapInArrow(run, schema)

"""Interpolated modified Kneser-Ney over word pairs, counted in Spark, looked up in memory-mapped sorted arrays.

Counting passes:

1. words: every task counts the words of its texts; counts of one hash range meet
   in a task that writes them as a sorted array. A word's id is its place there.
2. pairs: every task counts its pairs of ids; pairs meet by a hash of the pair, so
   no frequent word makes a large shard, and are written sorted.
3. continuations: each pair shard sends, per word, how many pairs it starts with
   count 1, 2, 3 or more and how many it ends; these meet by id range.

A shard's merge holds about as many keys as one scan task counts, for there are
as many shards as scan tasks. The driver holds a few numbers per shard.

p(w | v) = max(c(vw) - D(c), 0) / c(v) + g(v) q(w), with
q(w) = (max(b(w) - E(b), 0) + E-mass / (V + 1)) / B, where b(w) counts the pairs
that end in w and B all pairs; g and the E-mass are what the discounts took away.
A word outside the vocabulary has b = 0; after such a word p is q. A text begins
after a mark of its own and its end is a token.

Null texts count as empty, empty texts have the end as their only token. An empty
corpus gives V = N = 0 and p = 1 for every token.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrow.llm import shards as sh
from tallyrow.llm.words import blocks, counted, mix64, others, text_buffer, word_hashes

END = np.uint64(0x5EED0E4D0F7E8715)
START_ID = np.uint64(0)
UNKNOWN = np.uint64(0xFFFFFFFF)
# Distinct keys a counting task holds before it passes them on.
HELD = 3 << 20

SCORE_FIELDS = "n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text and its end; first[i] is where text i begins."""
    raw, offsets = text_buffer(texts)
    words, _, row = word_hashes(raw, offsets)
    ends = np.cumsum(np.bincount(row, minlength=len(texts)) + 1) - 1
    out = np.empty(len(words) + len(texts), np.uint64)
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner] = words
    out[ends] = END
    return out, np.r_[0, ends[:-1] + 1].astype(np.int64) if len(ends) else ends


def _top(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.uint16) if bits else np.zeros(len(keys), np.uint16)


def _bits(parts: int) -> int:
    return min(16, max(1, (parts - 1).bit_length()))


@dataclass(frozen=True)
class Vocabulary:
    """Where the sorted word hashes lie and the id of the first word of each shard."""

    folder: str
    bits: int
    first_id: tuple[int, ...]

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """The id of each distinct ascending hash, UNKNOWN if it has none."""
        out = np.full(len(hashes), UNKNOWN)
        cuts = np.searchsorted(_top(hashes, self.bits), np.arange((1 << self.bits) + 1))
        for shard in np.flatnonzero(np.diff(cuts)):
            if self.first_id[shard] == self.first_id[shard + 1]:
                continue
            table = sh.mapped(f"{self.folder}/{shard}.hash.npy")
            asked = hashes[cuts[shard] : cuts[shard + 1]]
            at = np.searchsorted(table, asked)
            at[at == len(table)] = 0
            out[cuts[shard] : cuts[shard + 1]] = np.where(table[at] == asked, at + self.first_id[shard], UNKNOWN)
        return out

    def rows(self, ids: np.ndarray, name: str, columns: int) -> np.ndarray:
        """The ``name`` row of each ascending word id."""
        out = np.zeros((len(ids), columns), np.int64)
        cuts = np.searchsorted(ids, np.asarray(self.first_id, np.uint64))
        for shard in np.flatnonzero(np.diff(cuts)):
            table = sh.mapped(f"{self.folder}/{shard}.{name}.npy")
            part = slice(cuts[shard], cuts[shard + 1])
            out[part] = table[ids[part] - np.uint64(self.first_id[shard])].reshape(-1, columns)
        return out


@dataclass(frozen=True)
class KneserNey:
    """A fitted model: its files and the few numbers that are no files."""

    words: Vocabulary
    pairs: str
    pair_bits: int
    train_tokens: int
    n_words: int
    n_pairs: int
    start: tuple[int, int, int, int]
    discounts: tuple[float, float, float]
    low_discounts: tuple[float, float, float]
    low_mass: float

    def _low(self, endings: np.ndarray) -> np.ndarray:
        """q of words that end so many pairs."""
        if not self.n_pairs:
            return np.ones(len(endings))
        taken = np.asarray((0.0, *self.low_discounts))[np.minimum(endings, 3)]
        return (endings - taken + self.low_mass / (self.n_words + 1)) / self.n_pairs

    def _pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of distinct ascending pair keys."""
        out = np.zeros(len(keys), np.int64)
        shard = _top(mix64(keys), self.pair_bits)
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange((1 << self.pair_bits) + 1))
        for s in np.flatnonzero(np.diff(cuts)):
            table = sh.mapped(f"{self.pairs}/{s}.key.npy")
            if not len(table):
                continue
            mine = order[cuts[s] : cuts[s + 1]]
            at = np.searchsorted(table, keys[mine])
            at[at == len(table)] = 0
            out[mine] = np.where(table[at] == keys[mine], sh.mapped(f"{self.pairs}/{s}.count.npy")[at], 0)
        return out

    def score(self, texts: pa.Array) -> dict[str, np.ndarray]:
        """Per text: tokens, known tokens, add-one unigram score and model score, both log10."""
        if not len(texts):
            return {k: np.zeros(0, t) for k, t in (("n_tokens", int), ("n_known", int), ("base_score", float), ("score", float))}
        hashes, first = tokens(texts)
        distinct, _ = counted(hashes)
        ids = self.words.ids(distinct)
        place = np.searchsorted(distinct, hashes)
        known = np.flatnonzero(ids != UNKNOWN)
        facts = np.zeros((len(distinct), 5), np.int64)
        inside = self.words.rows(ids[known], "facts", 5)
        facts[known] = inside
        count, ends = facts[:, 0], facts[:, 4]
        low = self._low(ends)
        with np.errstate(divide="ignore", invalid="ignore"):
            back = np.where(count > 0, facts[:, 1:4] @ np.asarray(self.discounts) / count, 1.0)
        begin = np.zeros(len(hashes), bool)
        begin[first] = True
        before = np.r_[0, place[:-1]]
        left = ids[before]
        left[begin] = START_ID
        left_count, left_back = count[before], back[before]
        if self.start[0]:
            left_count[begin] = self.start[0]
            left_back[begin] = float(np.dot(self.start[1:], self.discounts)) / self.start[0]
        else:
            left_count[begin], left_back[begin] = 0, 1.0
        keys = (left << np.uint64(32)) | ids[place]
        both = (left != UNKNOWN) & (ids[place] != UNKNOWN)
        asked, _ = counted(keys[both])
        seen = np.zeros(len(keys), np.int64)
        seen[both] = self._pair_counts(asked)[np.searchsorted(asked, keys[both])]
        taken = np.asarray((0.0, *self.discounts))[np.minimum(seen, 3)]
        p = (seen - taken) / np.maximum(left_count, 1) + left_back * low[place]
        base = np.log10((count + 1) / (self.train_tokens + self.n_words + 1))
        return {
            "n_tokens": np.diff(first, append=len(hashes)),
            "n_known": np.add.reduceat((count > 0)[place].astype(np.int64), first),
            "base_score": np.add.reduceat(base[place], first),
            "score": np.add.reduceat(np.log10(p), first),
        }


def _discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Chen and Goodman's three discounts; a half of each count where the data cannot tell."""
    if not n1 or not n2:
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(float(np.clip(d, 0.05, k - 0.05)) for k, d in enumerate(found, 1))


def _flushing(batches: Iterator[pa.RecordBatch], keys_of, shard_of) -> Iterator[pa.RecordBatch]:
    sums = sh.Sums()
    for batch in blocks(batches):
        keys, counts = counted(keys_of(batch.column("text")))
        sums.add(keys, counts.astype(np.uint64))
        if len(sums) > HELD:
            keys, counts = sums.merged()
            yield from sh.packed_rows(keys, counts, shard_of(keys))
            sums = sh.Sums()
    keys, counts = sums.merged()
    yield from sh.packed_rows(keys, counts, shard_of(keys))


def _count_words(bits: int):
    def run(batches):
        return _flushing(batches, lambda t: tokens(t)[0], lambda keys: _top(keys, bits))

    return run


def _pair_keys(words: Vocabulary, texts: pa.Array) -> np.ndarray:
    hashes, first = tokens(texts)
    distinct, _ = counted(hashes)
    ids = words.ids(distinct)[np.searchsorted(distinct, hashes)]
    left = np.r_[START_ID, ids[:-1]]
    left[first] = START_ID
    return (left << np.uint64(32)) | ids


def _count_pairs(words: Vocabulary, bits: int):
    def run(batches):
        return _flushing(batches, lambda t: _pair_keys(words, t), lambda keys: _top(mix64(keys), bits))

    return run


def _write_words(folder: str):
    def run(batches):
        for shard, parts in sh.unpacked(batches):
            sums = sh.Sums()
            for _, keys, counts in parts:
                sums.add(keys, counts)
            keys, counts = sums.merged()
            sh.save(f"{folder}/{shard}.hash.npy", keys)
            sh.save(f"{folder}/{shard}.count.npy", sh.narrow(counts))
            yield pa.RecordBatch.from_pydict({"shard": [shard], "n": [len(keys)], "total": [int(counts.sum())]})

    return run


def _write_pairs(folder: str, words: Vocabulary):
    """Writes each pair shard; passes on per word the pairs it starts (kind 1) and ends (kind 2),
    those the start mark starts (kind 3) and how many pairs have which count (kind 4)."""
    first = np.asarray(words.first_id, np.uint64)

    def of_word(ids: np.ndarray) -> np.ndarray:
        return (np.searchsorted(first, ids, side="right") - 1).astype(np.uint16)

    def run(batches):
        for shard, parts in sh.unpacked(batches):
            sums = sh.Sums()
            for _, keys, counts in parts:
                sums.add(keys, counts)
            keys, counts = sums.merged()
            sh.save(f"{folder}/{shard}.key.npy", keys)
            sh.save(f"{folder}/{shard}.count.npy", sh.narrow(counts))
            left = keys >> np.uint64(32)
            new = np.flatnonzero(np.r_[True, left[1:] != left[:-1]])
            levels = np.minimum(counts, 3)
            starts = np.stack([np.add.reduceat((levels == k).astype(np.uint64), new) for k in (1, 2, 3)], axis=1)
            ids = left[new]
            yield from sh.packed_rows(ids[ids > 0], starts[ids > 0], of_word(ids[ids > 0]), 1)
            ends, n = counted(keys & np.uint64(0xFFFFFFFF))
            yield from sh.packed_rows(ends, n.astype(np.uint64), of_word(ends), 2)
            mark = starts[ids == 0]
            yield from sh.packed_rows(np.zeros(len(mark), np.uint64), mark, np.zeros(len(mark), np.uint16), 3)
            tally = np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6)[None, 1:].astype(np.uint64)
            yield from sh.packed_rows(np.zeros(1, np.uint64), tally, np.zeros(1, np.uint16), 4)

    return run


_WIDTH = {1: 3, 2: 1, 3: 3, 4: 5}


def _write_facts(words: Vocabulary):
    """Per word (count, pairs it starts with count 1, 2, 3+, pairs it ends), and what the driver needs of them."""

    def run(batches):
        for shard, parts in sh.unpacked(batches, _WIDTH):
            base, n = words.first_id[shard], words.first_id[shard + 1] - words.first_id[shard]
            facts = np.zeros((n, 5), np.uint64)
            if n:
                facts[:, 0] = sh.mapped(f"{words.folder}/{shard}.count.npy")
            rest = np.zeros(8, np.int64)
            for kind, keys, counts in parts:
                at = (keys - np.uint64(base)).astype(np.int64) if kind < 3 else None
                if kind == 1:
                    facts[at, 1:4] += counts
                elif kind == 2:
                    facts[at, 4] += counts
                else:
                    cut = slice(0, 3) if kind == 3 else slice(3, 8)
                    rest[cut] += counts.sum(axis=0).astype(np.int64)
            sh.save(f"{words.folder}/{shard}.facts.npy", sh.narrow(facts))
            ends = np.bincount(np.minimum(facts[:, 4], 5).astype(np.int64), minlength=6)[1:]
            yield pa.RecordBatch.from_pydict(
                {"ends": pa.array([ends.tolist()], pa.list_(pa.int64())), "rest": pa.array([rest.tolist()], pa.list_(pa.int64()))}
            )

    return run


def fit(docs: DataFrame, text: str = "text") -> KneserNey:
    """Counts the texts of ``docs`` and writes the model below the shared folder."""
    spark = docs.sparkSession
    texts = docs.select(F.col(text).alias("text"))
    n_texts = docs.count()
    bits = _bits(texts.rdd.getNumPartitions())
    word_bits = max(1, bits - 1)
    folder = sh.shared_folder(spark, "kneser-ney-words")
    made = sh.by_shard(texts.mapInArrow(_count_words(word_bits), sh.PACKED), 1 << word_bits, _write_words(folder), "shard bigint, n bigint, total bigint")
    sizes = {row["shard"]: row for row in made.collect()}
    first_id = np.cumsum([1, *(sizes[s]["n"] if s in sizes else 0 for s in range(1 << word_bits))])
    if first_id[-1] >= int(UNKNOWN):
        raise ValueError(f"{first_id[-1]} words: ids have 32 bits")
    words = Vocabulary(folder, word_bits, tuple(int(i) for i in first_id))
    pairs = sh.shared_folder(spark, "kneser-ney-pairs")
    for shard in range(1 << bits):  # shards that get no pair
        sh.save(f"{pairs}/{shard}.key.npy", np.zeros(0, np.uint64))
    sent = sh.by_shard(texts.mapInArrow(_count_pairs(words, bits), sh.PACKED), 1 << bits, _write_pairs(pairs, words), sh.PACKED)
    told = sh.by_shard(sent, 1 << word_bits, _write_facts(words), "ends array<bigint>, rest array<bigint>").collect()
    ends = np.sum([row["ends"] for row in told], axis=0) if told else np.zeros(5, int)
    rest = np.sum([row["rest"] for row in told], axis=0) if told else np.zeros(8, int)
    low = _discounts(*ends[:4])
    return KneserNey(
        words=words,
        pairs=pairs,
        pair_bits=bits,
        train_tokens=int(sum(row["total"] for row in sizes.values())),
        n_words=int(first_id[-1]) - 1,
        n_pairs=int(rest[3:].sum()),
        start=(n_texts, *(int(x) for x in rest[:3])),
        discounts=_discounts(*rest[3:7]),
        low_discounts=low,
        low_mass=float(low[0] * ends[0] + low[1] * ends[1] + low[2] * ends[2:].sum()),
    )


def score(docs: DataFrame, model: KneserNey, text: str = "text") -> DataFrame:
    """``docs`` without the text, with each text's token counts and log10 probabilities, which replace columns of their names."""
    kept = others(docs, text, *(f.split()[0] for f in SCORE_FIELDS.split(", ")))
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept), SCORE_FIELDS])

    def run(batches):
        for batch in blocks(batches):
            found = model.score(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(len(kept))),
                    pa.array(found["n_tokens"], pa.int64()),
                    pa.array(found["n_known"], pa.int64()),
                    pa.array(np.full(batch.num_rows, model.train_tokens), pa.int64()),
                    pa.array(found["base_score"], pa.float64()),
                    pa.array(found["score"], pa.float64()),
                ],
                names=[*kept, *(f.split()[0] for f in SCORE_FIELDS.split(", "))],
            )

    return docs.select(*kept, F.col(text).alias("text")).mapInArrow(run, schema)

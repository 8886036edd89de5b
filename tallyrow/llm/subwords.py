"""A quality classifier over averaged vectors of hashed words and character n-grams.

Features of a text: each word, each pair of neighbouring words that are equal,
and each run of 3 to 5 characters that lies within a word and the white space
around it, all hashed to 2**bits rows of a table of vectors. A text is the mean
of its features' vectors; a softmax layer gives its class probabilities. Table
and layer are learned together by stochastic gradient descent in numpy, on at
most ``sample`` labelled texts (the smallest hashes of their ids); every text is
scored whole.

The output layer is linear in the mean, so each feature's contribution to the
log-odds is one number: scoring sums a lookup per feature.

Null and empty texts have no features and score by the bias alone. With no
labelled text, or only one class among them, the bias is the log-odds of the
smoothed class shares and every text gets the same score. Repeated rows are scored
each; an empty table gives no rows. A column of the table that is named like the score
gives way to it. Scoring takes some 40 bytes per character of the longest text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrow.llm.shards import pack, steps, unpack
from tallyrow.llm.words import NOT_SPACE, blocks, counted, others, text_buffer, word_hashes

# Character runs of these lengths are features.
LENGTHS = (3, 4, 5)
# Labelled texts that a fit reads at most.
SAMPLE = 3000
# Steps of the descent, one text each.
PASSES = 15_000

_SPREAD, _STEP, _MIX = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35)
_PAD = b" \x00\x00\x00"


def _runs(texts: list[str | None], bits: int):
    """For each run length: the feature of every character position and whether it is one; and each text's first position."""
    sizes = np.fromiter((len(t or "") + 2 for t in texts), np.int64, len(texts))
    chars = np.frombuffer((" " + "  ".join(t or "" for t in texts) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    space = (chars == 32) | ((chars >= 9) & (chars <= 13))
    values = np.where(space, np.uint32(32), chars) * _SPREAD
    values ^= values >> np.uint32(15)
    first = np.cumsum(sizes) - sizes

    def features():
        total = len(chars)
        hashed = values.copy()
        inner = np.ones(total, bool)
        for n in range(2, max(LENGTHS) + 1):
            hashed = hashed[: total - n + 1] * _STEP + values[n - 1 :]
            if n > 2:
                inner = inner[: total - n + 1] & ~space[n - 2 : total - 1]
            else:
                inner = inner[: total - 1]
            if n in LENGTHS:
                mixed = (hashed ^ (hashed >> np.uint32(16))) * _MIX
                yield (mixed ^ (mixed >> np.uint32(13))) >> np.uint32(32 - bits), inner

    return features, first


def _words(texts: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(feature, row) of the words and of the equal neighbours."""
    raw, offsets = text_buffer(texts)
    hashes, _, row = word_hashes(raw, offsets, NOT_SPACE, fold=False)
    same = np.flatnonzero((hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])) + 1
    shift = np.uint64(64 - bits)
    return np.r_[hashes >> shift, np.zeros(len(same), np.uint64)].astype(np.uint32), np.r_[row, row[same]]


def _bags(texts: pa.Array, bits: int):
    """Per text the distinct features and their counts."""
    for text in texts.to_pylist():
        words, _ = _words(pa.array([text], pa.large_string()), bits)
        features, _ = _runs([text], bits)
        yield counted(np.concatenate([words, *(f[ok] for f, ok in features())]))


@dataclass(frozen=True)
class SubwordModel:
    """What a feature adds to the log-odds of class 1 before averaging, and the bias."""

    bits: int
    weights: np.ndarray
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        table = np.append(self.weights, np.float32(0))
        rows = texts.to_pylist()
        total, n = np.zeros(len(rows)), np.zeros(len(rows))
        features, row = _words(texts, self.bits)
        total += np.bincount(row, self.weights[features], minlength=len(rows))
        n += np.bincount(row, minlength=len(rows))
        runs, first = _runs(rows, self.bits)
        for found, ok in runs():
            cut = np.minimum(first, max(len(found) - 1, 0))
            if not len(found):
                continue
            # A run that would cross into the next text holds two spaces in its middle, so it is none.
            values = table[np.where(ok, found, np.uint32(1 << self.bits))]
            filled = np.diff(first, append=first[-1] + 2) > 0
            total += np.where(filled, np.add.reduceat(values, cut, dtype=np.float64), 0)
            n += np.add.reduceat(ok, cut, dtype=np.int64)
        logit = self.bias + total / np.maximum(n, 1)
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def train(
    bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, bits: int, dim: int, passes: int, rate: float, seed: int
) -> SubwordModel:
    """Table of feature vectors and softmax layer, one text a step, the rate falling to nothing."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    if len(set(labels.tolist())) < 2:
        return SubwordModel(bits, np.zeros(1 << bits, np.float32), float(np.log(share / (1 - share))))
    random = np.random.default_rng(seed)
    table = random.uniform(-1 / dim, 1 / dim, (1 << bits, dim)).astype(np.float32)
    layer = np.zeros((dim, 2), np.float32)
    bias = np.log(np.array([1 - share, share], np.float32))
    epochs = max(1, round(passes / len(bags)))
    left = total = epochs * len(bags)
    for _ in range(epochs):
        for i in random.permutation(len(bags)):
            step = rate * left / total
            left -= 1
            features, counts = bags[i]
            if not len(features):
                continue
            weight = (counts / counts.sum()).astype(np.float32)
            vectors = table[features]
            mean = weight @ vectors
            logits = mean @ layer + bias
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[labels[i]] -= 1
            table[features] = vectors - np.outer(step * np.sqrt(len(features)) * weight, layer @ error)
            layer -= step * np.outer(mean, error)
            bias -= 0.1 * step * error
    return SubwordModel(bits, (table @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def labelled(docs: DataFrame, labels: DataFrame, label: str, learn: Column, sample: int, key: str = "doc_id") -> DataFrame:
    """(key, text, label), a row for each of at most ``sample`` labelled documents for which ``learn`` holds, told by key alone.

    Drawn from the documents that ``docs`` holds, by the smallest hashes of their keys. Of
    several labels of a document the largest counts, of several texts the one with the
    smallest md5; null labels do not.
    """
    mine = docs.where(learn & F.col(key).isNotNull())
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & learn).groupBy(key).agg(F.max(label).cast("int").alias("label"))
    chosen = known.join(mine.select(key), key, "left_semi").orderBy(F.xxhash64(key), key).limit(sample)
    found = mine.select(key, F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), key)
    return found.groupBy(key).agg(F.min_by("text", F.md5("text")).alias("text"), F.first("label").alias("label"))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    learn: Column,
    bits: int = 18,
    dim: int = 8,
    passes: int = PASSES,
    rate: float = 0.5,
    sample: int = SAMPLE,
    seed: int = 1,
) -> SubwordModel:
    """Learns from the documents for whose key ``learn`` holds and that have a label.

    Repeated rows of a chosen document are learned once.
    """

    def bags(batches):
        for batch in blocks(batches):
            found = list(_bags(batch.column("text"), bits))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("label"),
                    pa.array([len(f) for f, _ in found], pa.int64()),
                    pa.array([pack(steps(f.astype(np.uint64))) for f, _ in found], pa.binary()),
                    pa.array([pack(c) for _, c in found], pa.binary()),
                ],
                names=["doc_id", "label", "n", "features", "counts"],
            )

    key_type = docs.schema["doc_id"].dataType.simpleString()
    rows = (
        labelled(docs, labels, label, learn, sample)
        .select("doc_id", "label", "text")
        .mapInArrow(bags, f"doc_id {key_type}, label int, n bigint, features binary, counts binary")
        .collect()
    )
    rows.sort(key=lambda r: r["doc_id"])
    data = [(np.cumsum(unpack(r["features"], r["n"])).astype(np.uint32), unpack(r["counts"], r["n"]).astype(np.uint32)) for r in rows]
    marks = np.array([int(r["label"] > 0) for r in rows], int)
    del rows
    return train(data, marks, bits, dim, passes, rate, seed)


def score(docs: DataFrame, model: SubwordModel, name: str = "score", keep: bool = False) -> DataFrame:
    """``docs`` with the probability of class 1 as ``name``; the text goes unless ``keep``."""
    kept = others(docs, "text", name)
    fields = [*kept, "text"] if keep else kept
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in fields), f"`{name}` double"])
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 4 bytes x 2**bits, whatever the corpus

    def run(batches):
        for batch in blocks(batches, most=1 << 20):
            scores = pa.array(sent.value.scores(batch.column("text")), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in fields), scores], names=[*fields, name])

    return docs.select(*kept, "text").mapInArrow(run, schema)

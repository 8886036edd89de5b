"""A count-based bigram language model over token ids."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrow.functions.keys import Key, key_columns
from tallyrow.functions.numbers import Numbers, is_mounted, write_numbers
from tallyrow.functions.skew import HOT_ROWS, lookup_join
from tallyrow.session import scratch_path

# Log-probabilities are summed as decimals: the total does not depend on the
# order in which tasks finish.
LOG_DECIMALS = 9
LOG_TYPE = f"decimal(38,{LOG_DECIMALS})"

# Models of up to this many distinct pairs, some 100 MB in memory, are broadcast.
BROADCAST_PAIRS = 1_000_000

# Models of more pairs are saved as sorted arrays that tasks map, and no token of a text leaves its task.
MAPPED_PAIRS = BROADCAST_PAIRS

# Tokens that a task looks up at a time.
LOOKUP_TOKENS = 1 << 20

# Tokens whose pairs a task counts at a time, some 100 MB with what sorting takes.
COUNTED_TOKENS = 1 << 22

BIGRAM_SCHEMA = "prev int, next int, n bigint"
CONTEXT_SCHEMA = "prev int, c bigint"
META_SCHEMA = "vocab_size bigint, add_k double"


@dataclass(frozen=True)
class BigramModel:
    """Bigram counts ``(prev, next, n)``, how many there are, and context counts ``(prev, c)``.

    p(next | prev) = (n + add_k) / (c + add_k * vocab_size)
    """

    bigrams: DataFrame
    contexts: DataFrame
    pairs: int
    vocab_size: int
    add_k: float = 0.1

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BigramModel:
        """The model saved at ``path``, with the vocabulary size and smoothing it was fitted with."""
        bigrams = spark.read.schema(BIGRAM_SCHEMA).parquet(f"{path}/bigrams")
        contexts = spark.read.schema(CONTEXT_SCHEMA).parquet(f"{path}/contexts")
        meta = spark.read.schema(META_SCHEMA).parquet(f"{path}/meta").first()
        # Counted from the file footers.
        return cls(bigrams, contexts, bigrams.count(), meta["vocab_size"], meta["add_k"])


def _bigrams(ids: str, first: Column) -> Column:
    """Array of (prev, next): each id with the one before it, ``first`` before the first."""
    shifted = F.slice(F.concat(F.array(first), F.col(ids)), F.lit(1), F.size(ids))
    return F.zip_with(shifted, F.col(ids), lambda p, n: F.struct(p.alias("prev"), n.alias("next")))


def _followed(ids: pa.ListArray, first: pa.Array) -> tuple[np.ndarray, ...]:
    """Of every token: the id before it, its own, whether either is one; and where each list begins and the last ends."""
    offsets = np.r_[0, np.cumsum(ids.value_lengths().fill_null(0).to_numpy())]
    flat = ids.flatten()
    is_token = flat.is_valid().to_numpy(zero_copy_only=False)
    numbers = flat.fill_null(0).to_numpy().astype(np.int64)
    prev, after_id = np.r_[0, numbers[:-1]][: len(numbers)], np.r_[False, is_token[:-1]][: len(numbers)]
    begun = np.diff(offsets) > 0
    prev[offsets[:-1][begun]] = first.fill_null(0).to_numpy().astype(np.int64)[begun]
    after_id[offsets[:-1][begun]] = first.is_valid().to_numpy(zero_copy_only=False)[begun]
    return prev, numbers, after_id, is_token, offsets


def _row_parts(batch: pa.RecordBatch, column: int, tokens: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of as many rows as have no more ``tokens`` together in a column of lists, at least one."""
    ends = np.cumsum(batch.column(column).value_lengths().fill_null(0).to_numpy())
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + tokens, side="right")))
        yield batch.slice(at, to - at)
        at = to


def _pair_counts(bos_id: int) -> Callable:
    """Counts the pairs of a task's lists, those with a null as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _row_parts(batch, 0, COUNTED_TOKENS):
                prev, following, after_id, is_token, _ = _followed(part.column(0), pa.array(np.full(part.num_rows, bos_id)))
                both = is_token & after_id
                keys, n = np.unique((prev[both] << 32) + following[both], return_counts=True)
                before = (keys + (1 << 31)) >> 32
                columns = [
                    pa.array(np.r_[before, prev[~both]].astype(np.int32), mask=np.r_[np.zeros(len(keys), bool), ~after_id[~both]]),
                    pa.array(np.r_[keys - (before << 32), following[~both]].astype(np.int32), mask=np.r_[np.zeros(len(keys), bool), ~is_token[~both]]),
                    pa.array(np.r_[n, np.ones(len(prev) - both.sum(), np.int64)], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["prev", "next", "n"])

    return run


def fit_bigram(
    df: DataFrame, vocab_size: int, path: str | None = None, ids: str = "input_ids", bos_id: int = 0, add_k: float = 0.1
) -> BigramModel:
    """Counts bigrams and saves the counts to ``path``, a fresh one below the shared folder unless given.

    Pairs are formed and counted in arrays of many rows' ids, and combined once more
    before the shuffle, so a pair that makes up a third of the text is one row per map task.
    """
    if add_k <= 0:
        raise ValueError("add_k must be positive: an unseen pair needs a probability")
    spark = df.sparkSession
    path = path or scratch_path(spark, "bigram-model")
    listed = df.select(F.col(ids).cast("array<int>").alias("_ids"))
    counts = listed.mapInArrow(_pair_counts(bos_id), BIGRAM_SCHEMA).groupBy("prev", "next").agg(F.sum("n").alias("n"))
    counts.write.mode("overwrite").parquet(f"{path}/bigrams")
    totals = spark.read.schema(BIGRAM_SCHEMA).parquet(f"{path}/bigrams").groupBy("prev").agg(F.sum("n").alias("c"))
    totals.write.mode("overwrite").parquet(f"{path}/contexts")
    meta = spark.createDataFrame([(vocab_size, float(add_k))], META_SCHEMA)
    meta.coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")
    return BigramModel.load(spark, path)


def placed_bigrams(ids: str, first: Column) -> Column:
    """Array of (pos, prev, next), counted from 0."""
    return F.transform(_bigrams(ids, first), lambda pair, i: F.struct(i.alias("pos"), pair["prev"].alias("prev"), pair["next"].alias("next")))


def token_logprob(name: str, model: BigramModel) -> Column:
    """The rounded log-probability of a pair, from its joined counts ``n_name`` and ``c_name``."""
    seen, context = F.coalesce(f"n_{name}", F.lit(0)), F.coalesce(f"c_{name}", F.lit(0))
    return F.round(F.log((seen + model.add_k) / (context + model.add_k * model.vocab_size)), LOG_DECIMALS)


def merged_counts(tables: Mapping[str, DataFrame], keys: list[str], count: str) -> DataFrame:
    """Several models' counts side by side, one ``count_model`` column each."""
    renamed = [t.select(*keys, F.col(count).alias(f"{count}_{name}")) for name, t in tables.items()]
    return reduce(lambda left, right: left.join(right, keys, "full"), renamed)


@dataclass(frozen=True)
class PairScores:
    """Log-probabilities of several models in units of the last decimal, to be looked up by pair, else by context."""

    pairs: Numbers
    contexts: Numbers
    unseen: tuple[int, ...]

    def get(self, prev: np.ndarray, following: np.ndarray) -> np.ndarray:
        """One row per pair, one column per model."""
        keys, place = np.unique((prev << 32) + following, return_inverse=True)
        known, found = self.pairs.get(keys)
        rest = np.flatnonzero(~known)
        before, at = np.unique((keys[rest] + (1 << 31)) >> 32, return_inverse=True)
        seen, default = self.contexts.get(before)
        default[~seen] = self.unseen
        found[rest] = default[at]
        return found[place]


def pair_scores(models: Mapping[str, BigramModel]) -> PairScores:
    """Saves what every pair and every context of the models is worth, as Spark computes it."""
    spark = next(iter(models.values())).bigrams.sparkSession
    nothing = spark.range(1).select(*(F.lit(None).cast("bigint").alias(f"{count}_{name}") for name in models for count in "nc"))

    def units(rows: DataFrame, *keys: Column) -> DataFrame:
        exact = (token_logprob(name, m).cast("decimal(18,9)") * F.lit(10**LOG_DECIMALS).cast("decimal(10,0)") for name, m in models.items())
        return rows.select(*keys, *(units.cast("bigint").alias(name) for units, name in zip(exact, models)))

    bigrams = merged_counts({name: m.bigrams for name, m in models.items()}, ["prev", "next"], "n")
    contexts = merged_counts({name: m.contexts for name, m in models.items()}, ["prev"], "c").where("prev is not null")
    unread = contexts.select("*", *(F.lit(None).cast("bigint").alias(f"n_{name}") for name in models))
    pair = (F.col("prev") * F.lit(1 << 32) + F.col("next")).alias("_pair")
    pairs = units(bigrams.where("prev is not null and next is not null").join(contexts, "prev", "left"), pair)
    return PairScores(
        write_numbers(pairs, "_pair", list(models), sum(m.pairs for m in models.values()), "pair-scores"),
        write_numbers(units(unread, F.col("prev").cast("bigint").alias("_prev")), "_prev", list(models), max(m.vocab_size for m in models.values()), "context-scores"),
        tuple(units(nothing).first()),
    )


def _scored_lists(scores: PairScores, ids: pa.ListArray, first: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(one row of scores per token, whether it is one, where each list begins and the last ends)."""
    prev, numbers, after_id, is_token, offsets = _followed(ids, first)
    out = np.zeros((len(numbers), len(scores.unseen)), np.int64)
    out[is_token] = scores.unseen
    both = is_token & after_id
    out[both] = scores.get(prev[both], numbers[both])
    return out, is_token, offsets


def scored_rows(
    df: DataFrame, models: Mapping[str, BigramModel], names: list[str], ids: str, first: Column, result: Callable, fields: str
) -> DataFrame:
    """The key columns and ``fields`` of every row, which ``result`` makes of its tokens' scores; no token leaves its task."""
    scores = pair_scores(models)
    schema = ", ".join([*(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names), fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _row_parts(batch, len(names), LOOKUP_TOKENS):
                made = result(*_scored_lists(scores, part.column(len(names)), part.column(len(names) + 1)))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], *made.values()], names=[*names, *made])

    return df.select(*names, F.col(ids).cast("array<int>").alias("_ids"), first.cast("int").alias("_before")).mapInArrow(run, schema)


def is_mapped(spark: SparkSession, size: int, mapped_pairs: int) -> bool:
    """Whether models of so many pairs are looked up in mapped arrays."""
    return size > mapped_pairs and is_mounted(spark)


def _totals(models: Mapping[str, BigramModel]) -> Callable:
    names = list(models)

    def run(scores: np.ndarray, is_token: np.ndarray, offsets: np.ndarray) -> dict[str, pa.Array]:
        def per_list(values: np.ndarray) -> pa.Array:
            return pa.array(np.diff(np.r_[0, np.cumsum(values)][offsets]), pa.int64())

        return {**{f"_units{i}": per_list(scores[:, i]) for i in range(len(names))}, "n_tokens": per_list(is_token)}

    return run


def sequence_logprobs(
    df: DataFrame,
    models: Mapping[str, BigramModel],
    key: Key,
    ids: str = "input_ids",
    first: Column | None = None,
    bos_id: int = 0,
    broadcast_pairs: int = BROADCAST_PAIRS,
    hot_rows: int = HOT_ROWS,
    mapped_pairs: int = MAPPED_PAIRS,
) -> DataFrame:
    """(key, <model>_logprob..., n_tokens) of every row; no tokens give 0.0 and 0.

    ``first`` is the id before the first token (say, the last one of the
    prompt), ``bos_id`` unless given. All models are scored in one pass: their
    counts are put side by side.

    Models of together at most ``broadcast_pairs`` pairs are broadcast with their
    contexts, of which there are no more; those of more than ``mapped_pairs`` are
    saved as sorted arrays, which the tasks map. Either way the text's pairs never
    leave their task.

    Models in between, and all larger ones if the shared folder is not mounted, are
    joined: each row's equal pairs are first counted, then shuffled by pair and by
    context, hot ones (say, after unknown) dealt over several tasks. That reads the
    ids more than once: give a stored table rather than ids still to be computed.
    """
    names = key_columns(key)
    before = F.lit(bos_id) if first is None else first
    size = sum(m.pairs for m in models.values())
    if is_mapped(df.sparkSession, size, mapped_pairs):
        fields = ", ".join([*(f"_units{i} bigint" for i in range(len(models))), "n_tokens bigint"])
        scored = scored_rows(df, models, names, ids, before, _totals(models), fields)
        unit = F.lit(f"1e-{LOG_DECIMALS}").cast(f"decimal({LOG_DECIMALS},{LOG_DECIMALS})")
        sums = (F.sum(F.col(f"_units{i}").cast("decimal(19,0)") * unit).cast("double").alias(f"{name}_logprob") for i, name in enumerate(models))
        return scored.groupBy(*names).agg(*sums, F.sum("n_tokens").alias("n_tokens"))
    pairs = df.select(*names, F.inline_outer(_bigrams(ids, before)))
    bigrams = merged_counts({name: m.bigrams for name, m in models.items()}, ["prev", "next"], "n")
    contexts = merged_counts({name: m.contexts for name, m in models.items()}, ["prev"], "c")

    def total(name: str, model: BigramModel) -> Column:
        term = F.when(F.col("next").isNotNull(), token_logprob(name, model).cast("decimal(18,9)") * F.col("_times").cast("decimal(18,0)"))
        return F.coalesce(F.sum(term).cast("double"), F.lit(0.0)).alias(f"{name}_logprob")

    pair = ["prev", "next"]
    if size <= broadcast_pairs:
        counted = pairs.withColumn("_times", F.lit(1)).join(F.broadcast(bigrams), pair, "left").join(F.broadcast(contexts), "prev", "left")
    else:
        pairs = pairs.groupBy(*names, *pair).agg(F.count(F.lit(1)).alias("_times"))
        with_pair = lookup_join(pairs, bigrams, pair, spread_by=names, how="left", hot_rows=hot_rows)
        counted = lookup_join(with_pair, contexts, "prev", spread_by=[*names, "next"], how="left", hot_rows=hot_rows)
    tokens = F.sum(F.when(F.col("next").isNotNull(), F.col("_times")).otherwise(0)).cast("long").alias("n_tokens")
    return counted.groupBy(*names).agg(*(total(name, model) for name, model in models.items()), tokens)


def sequence_logprob(
    df: DataFrame,
    model: BigramModel,
    key: Key,
    ids: str = "input_ids",
    first: Column | None = None,
    bos_id: int = 0,
) -> DataFrame:
    """(key, logprob, n_tokens) of every row under one model; see `sequence_logprobs`."""
    scored = sequence_logprobs(df, {"model": model}, key, ids, first, bos_id)
    return scored.withColumnRenamed("model_logprob", "logprob")


def eval_loss(scored: DataFrame) -> DataFrame:
    """One row: sequences, tokens, token-weighted negative log-likelihood, perplexity.

    ``scored`` is the output of `sequence_logprob` on held-out rows.
    """
    totals = scored.agg(
        F.count(F.lit(1)).alias("sequences"),
        F.sum("n_tokens").alias("tokens"),
        F.sum(F.col("logprob").cast(LOG_TYPE)).cast("double").alias("_total"),
    )
    return totals.withColumn("nll", -F.col("_total") / F.col("tokens")).select(
        "sequences", "tokens", "nll", F.exp("nll").alias("perplexity")
    )

"""Penalties and returns token by token, over arrays that line up with each row's ids."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrow.functions.keys import Key, key_columns
from tallyrow.functions.skew import HOT_ROWS, lookup_join
from tallyrow.operators.lm import (
    BROADCAST_PAIRS,
    LOG_DECIMALS,
    MAPPED_PAIRS,
    BigramModel,
    is_mapped,
    merged_counts,
    placed_bigrams,
    scored_rows,
    token_logprob,
)


def _listed(models: int):
    def run(scores: np.ndarray, is_token: np.ndarray, offsets: np.ndarray) -> dict[str, pa.Array]:
        ends = pa.array(np.r_[0, np.cumsum(is_token)][offsets], pa.int32())
        logprobs = scores[is_token] / 10.0**LOG_DECIMALS
        return {f"_list{i}": pa.ListArray.from_arrays(ends, np.ascontiguousarray(logprobs[:, i])) for i in range(models)}

    return run


def _mapped_logprobs(df: DataFrame, models: Mapping[str, BigramModel], names: list[str], ids: str, first: Column) -> DataFrame:
    lists = [f"_list{i}" for i in range(len(models))]
    scored = scored_rows(df, models, names, ids, first, _listed(len(models)), ", ".join(f"{c} array<double>" for c in lists))
    parts = scored.groupBy(*names).agg(F.collect_list(F.struct(*lists)).alias("_parts"))

    def merged(name: str) -> Column:
        """What rows of one key make together: their tokens by place."""
        placed = F.flatten(F.transform("_parts", lambda p: F.transform(F.arrays_zip(*(p[c] for c in lists)), lambda t, i: F.struct(i.alias("pos"), *(t[c] for c in lists)))))
        return F.array_sort(placed)[name]

    def only(name: str) -> Column:
        return F.when(F.size("_parts") == 1, F.col("_parts")[0][name]).otherwise(merged(name))

    return parts.select(*names, *(only(c).alias(f"{model}_logprobs") for c, model in zip(lists, models)))


def token_logprobs(
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
    """(key, <model>_logprobs...): one array per model, as long as the row's ids; no ids give empty arrays.

    The sums of the arrays are the totals of `lm.sequence_logprobs`, to which ``first`` and the limits are the same.
    Keys must be unique. Models that are neither broadcast nor mapped are joined, hot pairs dealt over several tasks; the
    arrays of one row meet again by its key. The ids are read more than once then: give a stored table.
    """
    names = key_columns(key)
    before = F.lit(bos_id) if first is None else first
    size = sum(m.pairs for m in models.values())
    if is_mapped(df.sparkSession, size, mapped_pairs):
        return _mapped_logprobs(df, models, names, ids, before)
    pairs = df.select(*names, F.inline_outer(placed_bigrams(ids, before)))
    bigrams = merged_counts({name: m.bigrams for name, m in models.items()}, ["prev", "next"], "n")
    contexts = merged_counts({name: m.contexts for name, m in models.items()}, ["prev"], "c")
    pair = ["prev", "next"]
    if size <= broadcast_pairs:
        scored = pairs.join(F.broadcast(bigrams), pair, "left").join(F.broadcast(contexts), "prev", "left")
    else:
        with_pair = lookup_join(pairs, bigrams, pair, spread_by=[*names, "pos"], how="left", hot_rows=hot_rows)
        scored = lookup_join(with_pair, contexts, "prev", spread_by=[*names, "pos"], how="left", hot_rows=hot_rows)
    terms = F.struct("pos", *(token_logprob(name, model).alias(name) for name, model in models.items()))
    listed = scored.groupBy(*names).agg(F.array_sort(F.collect_list(F.when(F.col("next").isNotNull(), terms))).alias("_terms"))
    return listed.select(*names, *(F.col(f"_terms.{name}").alias(f"{name}_logprobs") for name in models))


def token_rewards(df: DataFrame, beta: float = 0.05, reward: str = "reward") -> DataFrame:
    """Adds arrays ``kl`` (policy less reference) and ``rewards``: -beta * kl at each token, the sequence's reward on top at the last.

    Their sum is the penalised reward of `objectives.kl_reward`; a row without tokens keeps its reward nowhere and has empty arrays.
    """
    kl = F.zip_with("policy_logprobs", "reference_logprobs", lambda p, r: p - r)
    last = F.size("kl") - 1
    paid = F.transform("kl", lambda k, i: F.lit(-beta) * k + F.when(i == last, F.col(reward)).otherwise(F.lit(0.0)))
    return df.withColumn("kl", kl).withColumn("rewards", paid)


# Tokens of a row that are folded into an array of their own: appending copies what stands there already.
FOLDED_TOKENS = 32


def returns(rewards: str | Column, discount: float = 1.0) -> Column:
    """What each token and those after it earn: a fold from the last token back, discounted once a step.

    Tokens are folded in parts, each going on from the sum of the one before, so that a long row costs its length.
    """
    backward = F.reverse(rewards)
    size = F.lit(FOLDED_TOKENS)
    # One part more than there need be: an empty array has no other.
    parts = F.transform(F.sequence(F.lit(0), F.floor(F.size(rewards) / size).cast("int")), lambda i: F.slice(backward, i * size + 1, size))

    def step(state: Column, earned: Column) -> Column:
        total = earned + F.lit(float(discount)) * state["sum"]
        return F.struct(total.alias("sum"), F.array_append(state["out"], total).alias("out"))

    def part(state: Column, earned: Column) -> Column:
        folded = F.aggregate(earned, F.struct(state["sum"].alias("sum"), F.array().cast("array<double>").alias("out")), step)
        return F.struct(folded["sum"].alias("sum"), F.array_append(state["out"], folded["out"]).alias("out"))

    start = F.struct(F.lit(0.0).alias("sum"), F.array().cast("array<array<double>>").alias("out"))
    return F.reverse(F.aggregate(parts, start, part, lambda state: F.flatten(state["out"])))


def advantages(rewards: Column, values: Column, discount: float = 1.0, decay: float = 1.0) -> Column:
    """Generalised advantages: the discounted and decayed sum of r + discount * next value - value, from the last token back.

    ``values`` lines up with ``rewards``; nothing is worth anything after the last token.
    """
    following = F.concat(F.slice(values, F.lit(2), F.size(values)), F.array(F.lit(0.0)))
    steps = F.zip_with(F.zip_with(rewards, following, lambda r, n: r + F.lit(float(discount)) * n), values, lambda a, v: a - v)
    return returns(F.when(F.size(rewards) > 0, steps).otherwise(F.array().cast("array<double>")), discount * decay)

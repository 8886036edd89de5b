"""Preference loss, KL-penalised reward and advantages over scored sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrow.functions.keys import Key, key_columns
from tallyrow.functions.skew import HOT_ROWS, lookup_join


def align_logprobs(policy: DataFrame, reference: DataFrame, key: Key) -> DataFrame:
    """(key, policy_logprob, reference_logprob, n_tokens) for sequences scored by both models."""
    names = key_columns(key)
    ours = policy.select(*names, F.col("logprob").alias("policy_logprob"), "n_tokens")
    theirs = reference.select(*names, F.col("logprob").alias("reference_logprob"))
    return ours.join(theirs, names)


def log_sigmoid(x: Column) -> Column:
    """ln sigma(x), without overflow on either side."""
    return -(F.log1p(F.exp(-F.abs(x))) + F.greatest(-x, F.lit(0.0)))


def dpo_terms(df: DataFrame, beta: float = 0.1) -> DataFrame:
    """Adds implicit rewards, margin and loss of each pair.

    Needs policy_chosen, reference_chosen, policy_rejected, reference_rejected
    (log-probabilities). loss = -ln sigma(beta * (chosen ratio - rejected ratio)).
    """
    return (
        df.withColumn("chosen_reward", beta * (F.col("policy_chosen") - F.col("reference_chosen")))
        .withColumn("rejected_reward", beta * (F.col("policy_rejected") - F.col("reference_rejected")))
        .withColumn("margin", F.col("chosen_reward") - F.col("rejected_reward"))
        .withColumn("loss", -log_sigmoid(F.col("margin")))
    )


def dpo_metrics(df: DataFrame, beta: float = 0.1) -> DataFrame:
    """One row: pairs, mean loss, mean margin, share of pairs with a positive margin."""
    return dpo_summary(dpo_terms(df, beta))


def dpo_summary(terms: DataFrame) -> DataFrame:
    """The metrics of rows that already carry margin and loss."""
    return terms.agg(
        F.count(F.lit(1)).alias("pairs"),
        F.avg("loss").alias("loss"),
        F.avg("margin").alias("margin"),
        F.avg(F.when(F.col("margin") > 0, 1.0).otherwise(0.0)).alias("accuracy"),
    )


def kl_reward(df: DataFrame, beta: float = 0.05, reward: str = "reward") -> DataFrame:
    """Adds ``kl`` (policy minus reference log-probability) and ``kl_reward`` = reward - beta * kl."""
    return df.withColumn("kl", F.col("policy_logprob") - F.col("reference_logprob")).withColumn(
        "kl_reward", F.col(reward) - beta * F.col("kl")
    )


def value_advantage(rewards: DataFrame, values: DataFrame, key: Key, whiten: bool = False) -> DataFrame:
    """Adds ``advantage`` = reward - value, per sequence.

    ``whiten`` shifts and scales the advantages to mean 0 and deviation 1 over
    the whole table (one aggregate row, carried as a scalar).
    """
    joined = rewards.join(values, key_columns(key)).withColumn("advantage", F.col("reward") - F.col("value"))
    if not whiten:
        return joined
    stats = joined.agg(F.avg("advantage").alias("mean"), F.stddev_samp("advantage").alias("dev"))
    mean, dev = stats.select("mean").scalar(), stats.select("dev").scalar()
    return joined.withColumn("advantage", (F.col("advantage") - mean) / (F.coalesce(dev, F.lit(0.0)) + 1e-8))


def group_advantage(
    df: DataFrame,
    group: str = "prompt_id",
    reward: str = "reward",
    member: str = "gen_id",
    eps: float = 1e-4,
    std: str = "samp",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Adds ``advantage`` = (reward - group mean) / (group deviation + eps).

    A group of one gets 0. ``member`` tells the rows of a group apart. Group
    statistics are pre-aggregated and joined back rather than windowed: a window
    would put a group with a third of all rows into one task, while the join
    deals it over several.
    """
    deviation = {"samp": F.stddev_samp, "pop": F.stddev_pop}[std]
    stats = df.groupBy(group).agg(
        F.avg(reward).alias("_mean"),
        F.coalesce(deviation(reward), F.lit(0.0)).alias("_dev"),
        F.count(F.lit(1)).alias("_n"),
    )
    table = stats.drop("_n")
    joined = lookup_join(df, table, group, spread_by=member, counts=stats, hot_rows=hot_rows)
    advantage = (F.col(reward) - F.col("_mean")) / (F.col("_dev") + eps)
    return joined.withColumn("advantage", advantage).drop("_mean", "_dev")

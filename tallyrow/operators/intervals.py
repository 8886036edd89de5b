"""Metrics with intervals, by a Poisson bootstrap in one pass."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrow.functions.keys import Key, key_columns, key_digest
from tallyrow.functions.ordering import check_key

# A digest holds so many numbers of 16 bits: the weights of as many replicates.
_PER_DIGEST, _DIGITS = 8, 4


def poisson_steps(bits: int = 4 * _DIGITS) -> list[int]:
    """Where a uniform number of so many bits stands for one more: the distribution function of a Poisson count of mean 1."""
    whole, steps, total, k = 1 << bits, [], 0.0, 0
    while True:
        total += math.exp(-1) / math.factorial(k)
        at = int(whole * total)
        if at >= whole - 1 or (steps and at == steps[-1]):
            return steps
        steps.append(at)
        k += 1


def weights(df: DataFrame, key: Key, replicates: int, seed: int) -> DataFrame:
    """``df`` once per replicate that draws the row, with ``replicate`` and ``weight``, how often it does.

    The weight depends on seed, key and replicate alone: a row has the same one in every run, task and engine.
    """
    names = key_columns(key)
    blocks = df.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit((replicates - 1) // _PER_DIGEST))))
    spread = blocks.withColumn("_digest", key_digest(seed, [*names, "_block"])).withColumn("_at", F.explode(F.sequence(F.lit(0), F.lit(_PER_DIGEST - 1))))
    drawn = F.conv(F.substring("_digest", F.col("_at") * _DIGITS + 1, F.lit(_DIGITS)), 16, 10).cast("int")
    weight: Column = F.lit(0)
    for step in poisson_steps():
        weight = weight + (F.col("_u") >= step).cast("int")
    placed = spread.withColumn("_u", drawn).select(*df.columns, (F.col("_block") * _PER_DIGEST + F.col("_at")).alias("replicate"), weight.alias("weight"))
    return placed.where((F.col("replicate") < replicates) & (F.col("weight") > 0))


def ratio_intervals(
    df: DataFrame, key: Key, metrics: Mapping[str, tuple[Column, Column]], replicates: int = 200, level: float = 0.95, seed: int = 42
) -> DataFrame:
    """(metric, rows, estimate, low, high) of metrics that are a sum over a sum of row values (a mean: over ones).

    Each replicate weighs every row by a Poisson count, which stands for drawing as many rows with replacement; the
    interval lies between the replicates at the level's two ranks. Rows never meet: sums per replicate leave
    a task. A row without a value counts in no metric that needs it; a metric over nothing is null. Null or repeated keys are refused.
    """
    if replicates < 1 or not 0 < level < 1:
        raise ValueError("at least one replicate, and a level between 0 and 1")
    names = key_columns(key)
    check_key(df, names)
    tops, bottoms = [f"_top{i}" for i in range(len(metrics))], [f"_bottom{i}" for i in range(len(metrics))]
    values = []
    for (top, bottom), t, b in zip(metrics.values(), tops, bottoms):
        whole = top.isNotNull() & bottom.isNotNull()
        values += [F.when(whole, top.cast("double")).alias(t), F.when(whole, bottom.cast("double")).alias(b)]
    rows = df.select(*names, *values)

    def ratios(weight: Column) -> list[Column]:
        return [
            F.struct(
                F.lit(name).alias("metric"),
                F.try_divide(F.sum(weight * F.col(t)), F.sum(weight * F.col(b))).alias("value"),
                F.count(t).alias("rows"),
            )
            for name, t, b in zip(metrics, tops, bottoms)
        ]

    whole = rows.agg(F.array(*ratios(F.lit(1))).alias("_m")).select(F.inline("_m")).withColumnRenamed("value", "estimate")
    drawn = weights(rows, names, replicates, seed).groupBy("replicate").agg(F.array(*ratios(F.col("weight"))).alias("_m"))
    # One row per metric and replicate from here on.
    drawn = drawn.select("replicate", F.inline("_m")).where("value is not null")
    by_metric = Window.partitionBy("metric")
    ranked = drawn.withColumn("_rank", F.row_number().over(by_metric.orderBy("value", "replicate"))).withColumn("_n", F.count(F.lit(1)).over(by_metric))
    tail = (1 - level) / 2
    low = F.greatest(F.lit(1), F.ceil(F.round(F.col("_n") * tail, 9)))
    high = F.greatest(F.lit(1), F.ceil(F.round(F.col("_n") * (1 - tail), 9)))
    ends = ranked.groupBy("metric").agg(F.max(F.when(F.col("_rank") == low, F.col("value"))).alias("low"), F.max(F.when(F.col("_rank") == high, F.col("value"))).alias("high"))
    return whole.join(ends, "metric", "left").select("metric", "rows", "estimate", "low", "high")

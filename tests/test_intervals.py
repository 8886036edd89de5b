"""Bootstrap weights and intervals against the same draws made one by one."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tallyrow.operators import intervals


def drawn(key, replicate, seed):
    digest = hashlib.md5(f"{seed}:{key}:{replicate // 8}".encode()).hexdigest()
    u = int(digest[replicate % 8 * 4 :][:4], 16)
    return sum(u >= step for step in intervals.poisson_steps())


def test_steps_are_those_of_a_poisson_count():
    steps = [0, *intervals.poisson_steps(), 1 << 16]
    for k, (a, b) in enumerate(zip(steps, steps[1:])):
        assert (b - a) / (1 << 16) == pytest.approx(math.exp(-1) / math.factorial(k), abs=5e-5)


def test_intervals_equal_draws_made_one_by_one(spark):
    rows = [(k, float(k % 7), k % 3 + 1, None if k % 11 == 0 else 1.0) for k in range(90)]
    df = spark.createDataFrame(rows, "k bigint, a double, b int, c double").repartition(4)
    metrics = {"ratio": (F.col("a"), F.col("b")), "mean": (F.col("c") * F.col("a"), F.lit(1)), "none": (F.lit(None).cast("double"), F.lit(1))}
    got = {r.metric: r for r in intervals.ratio_intervals(df, "k", metrics, 30, 0.8, seed=5).collect()}
    pairs = {"ratio": [(a, b, k) for k, a, b, _ in rows], "mean": [(a, 1, k) for k, a, _, c in rows if c is not None]}
    for name, values in pairs.items():
        replicates = []
        for r in range(30):
            w = [drawn(k, r, 5) for _, _, k in values]
            replicates.append(sum(x * t for x, (t, _, _) in zip(w, values)) / sum(x * b for x, (_, b, _) in zip(w, values)))
        replicates.sort()
        assert got[name].rows == len(values)
        assert got[name].estimate == pytest.approx(sum(t for t, _, _ in values) / sum(b for _, b, _ in values))
        assert (got[name].low, got[name].high) == (pytest.approx(replicates[2]), pytest.approx(replicates[26]))
    assert tuple(got["none"])[1:] == (0, None, None, None)


def test_intervals_hold_the_truth_about_as_often_as_they_say(spark):
    """Means of 40 rows each of known mean: most 90 percent intervals hold it."""
    df = spark.range(40 * 30).selectExpr("id", "id % 30 as sample", "cast(conv(substring(md5(cast(id as string)), 1, 8), 16, 10) as double) / 4294967296 as x")
    metrics = {f"s{i}": (F.when(F.col("sample") == i, F.col("x")), F.lit(1)) for i in range(30)}
    found = intervals.ratio_intervals(df, "id", metrics, 100, 0.9).collect()
    assert sum(r.low <= 0.5 <= r.high for r in found) >= 22 and all(r.low < r.estimate < r.high for r in found)


def test_wrong_input(spark):
    df = spark.range(3)
    with pytest.raises(ValueError, match="repeat"):
        intervals.ratio_intervals(df.union(df), "id", {"m": (F.col("id"), F.lit(1))})
    for options in ({"replicates": 0}, {"level": 1.0}):
        with pytest.raises(ValueError):
            intervals.ratio_intervals(df, "id", {"m": (F.col("id"), F.lit(1))}, **options)
    assert [tuple(r) for r in intervals.ratio_intervals(df.limit(0), "id", {"m": (F.col("id"), F.lit(1))}).collect()] == [("m", 0, None, None, None)]

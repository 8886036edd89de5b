"""Pairs of better and worse rated responses, drawn from all pairs of a group without forming them.

The pairs of a group are numbered: row by row in order of score, each row with all rows
of its group that score lower. A pair number is turned back into its two rows: prefix
sums say which row's pairs hold the number, and what is left over is the place of the
worse row. So ``k`` pairs cost k lookups however many pairs there are, and a group that
holds a third of all rows is cut into runs of ``RUN`` rows like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrow.functions.ordering import check_key, with_ordinal
from tallyrow.functions.skew import lookup_join
from tallyrow.operators.preference import fetched
from tallyrow.session import written

# Rows that one window orders.
RUN = 1 << 17

# Pair numbers of a group of n rows go up to n * n / 2.
WIDE = "decimal(38,0)"


def _wide(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast(WIDE)


def _div(a: str, b: str) -> str:
    """Whole quotient of wide numbers."""
    return f"cast(({a} - ({a}) % ({b})) / ({b}) as {WIDE})"


def drawn_numbers(groups: DataFrame, total: str, k: int, seed: int, label: Column) -> DataFrame:
    """``groups`` once per drawn number: ``_draw`` and ``_number``, all of 0 .. total - 1 where there are at most ``k``.

    Else the numbers are cut into k even strata and one is drawn from each by md5(seed:label:draw): no number comes twice.
    """
    count = F.least(F.col(total), F.lit(k).cast(WIDE)).cast("bigint")
    drawn = groups.where(F.col(total) > 0).withColumn("_draw", F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1)))
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), label, F.col("_draw").cast("string")))
    lots = F.conv(F.substring(digest, 1, 15), 16, 10)
    n = f"least({total}, cast({k} as {WIDE}))"
    return (
        drawn.withColumn("_low", F.expr(_div(f"(_draw * {total})", n)))
        .withColumn("_high", F.expr(_div(f"((_draw + 1) * {total})", n)))
        .withColumn("_number", F.col("_low") + _wide(lots) % (F.col("_high") - F.col("_low")))
        .drop("_low", "_high")
    )


def pairs_all(
    rated: DataFrame,
    group: Sequence[str],
    score: str,
    key: str,
    response: str,
    k: int,
    seed: int = 42,
    texts: DataFrame | None = None,
    run: int = RUN,
) -> DataFrame:
    """(group, chosen_id, rejected_id, chosen, rejected): up to ``k`` of each group's pairs of a better and a worse response.

    All pairs of a group with at most ``k``; of larger ones k different pairs, spread evenly over the numbering by
    ``seed``. Pairs of equal scores are none; unrated rows do not count; null group values are equal to each other.
    Null or repeated keys are refused. ``texts`` (key, response) is where the texts of the drawn pairs are fetched,
    ``rated`` unless given.
    """
    if k < 1:
        raise ValueError("k must be positive")
    names = list(group)
    label = F.to_json(F.struct(*(F.col(n).cast("string").alias(n) for n in names)), {"ignoreNullFields": "false"})
    narrow = written(rated.where(F.col(score).isNotNull()).select(*names, label.alias("_group"), F.col(score).alias("_score"), F.col(key).alias("_key")), "rated")
    check_key(narrow, "_key")
    placed = with_ordinal(narrow.select("_group", "_score", "_key"), ["_group", "_score", "_key"], name="_at")
    placed = written(placed.withColumn("_run", F.expr(f"_at div {run}")), "placed")

    # Where each group and each score in it begin; a row has as many worse rows as stand between the two.
    classes = placed.groupBy("_group", "_score").agg(F.min("_at").alias("_class"), F.count(F.lit(1)).alias("_n"))
    classes = written(classes, "classes")
    firsts = classes.groupBy("_group").agg(F.min("_class").alias("_first"))
    starts = classes.select("_group", "_score", "_class")
    rows = lookup_join(placed, starts, ["_group", "_score"], spread_by="_key", counts=classes.select("_group", "_score", "_n"))
    sizes = classes.groupBy("_group").agg(F.sum("_n").alias("_n"))
    rows = lookup_join(rows, firsts, "_group", spread_by="_key", counts=sizes)
    rows = written(rows.withColumn("_worse", _wide(F.col("_class") - F.col("_first"))), "ranked")

    # Runs of a group: at most one row per ``run`` rows and group.
    runs = rows.groupBy("_group", "_run").agg(F.sum("_worse").cast(WIDE).alias("_pairs"), F.first("_first").alias("_first"))
    before = Window.partitionBy("_group").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = written(runs.withColumn("_begin", _wide(F.coalesce(F.sum("_pairs").over(before), F.lit(0)))), "runs")
    totals = runs.groupBy("_group").agg(F.sum("_pairs").cast(WIDE).alias("_total"), F.first("_first").alias("_first"))
    wanted = drawn_numbers(totals, "_total", k, seed, F.col("_group"))

    # The run that holds each number: runs and numbers of a group in one order, each number after the run it falls into.
    marks = runs.where("_pairs > 0").select("_group", F.col("_begin").alias("_number"), F.lit(0).alias("_kind"), F.struct("_run", "_begin").alias("_mark"))
    asked = wanted.select("_group", "_number", F.lit(1).alias("_kind"), F.lit(None).cast("struct<_run: bigint, _begin: decimal(38,0)>").alias("_mark"))
    along = Window.partitionBy("_group").orderBy("_number", "_kind")
    held = marks.union(asked).withColumn("_mark", F.last("_mark", ignorenulls=True).over(along)).where("_kind = 1")
    held = held.select("_group", F.col("_mark._run").alias("_run"), (F.col("_number") - F.col("_mark._begin")).cast(WIDE).alias("_number"))

    # The row that holds it, likewise within the run.
    inside = Window.partitionBy("_group", "_run").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    touched = rows.join(held.select("_group", "_run").distinct(), ["_group", "_run"], "left_semi")
    better = touched.withColumn("_begin", _wide(F.coalesce(F.sum("_worse").over(inside), F.lit(0)))).where("_worse > 0")
    kinds = "struct<_key: {}, _begin: decimal(38,0), _first: bigint>".format(narrow.schema["_key"].dataType.simpleString())
    marks = better.select("_group", "_run", F.col("_begin").alias("_number"), F.lit(0).alias("_kind"), F.struct("_key", "_begin", "_first").alias("_mark"))
    asked = held.select("_group", "_run", "_number", F.lit(1).alias("_kind"), F.lit(None).cast(kinds).alias("_mark"))
    along = Window.partitionBy("_group", "_run").orderBy("_number", "_kind")
    found = marks.union(asked).withColumn("_mark", F.last("_mark", ignorenulls=True).over(along)).where("_kind = 1")
    found = found.select(F.col("_mark._key").alias("chosen_id"), (F.col("_mark._first") + F.col("_number") - F.col("_mark._begin")).cast("bigint").alias("_at"))

    worse = placed.select("_at", F.col("_key").alias("rejected_id"))
    ids = found.join(worse, "_at").drop("_at")
    named = narrow.select(F.col("_key").alias("chosen_id"), *names)
    return fetched(ids.join(named, "chosen_id"), texts if texts is not None else rated, key, response).select(*names, "chosen_id", "rejected_id", "chosen", "rejected")

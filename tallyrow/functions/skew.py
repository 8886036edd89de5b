"""Joins whose row side may hold a hot key.

AQE splits a skewed join partition only where both sides come straight out of a
shuffle. A side that was just aggregated or joined does not, and neither do
windows, so hot keys are split here by the plan itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrow.functions.keys import Key, key_columns

# Rows of one key that a single task may take.
HOT_ROWS = 200_000


def _copies(counts: DataFrame, on: list[str], hot_rows: int) -> DataFrame:
    """Hot keys and how many parts each is split into.

    A key is hot if it has more rows than ``hot_rows`` and than an even share of all
    rows over the shuffle partitions. No more keys than partitions can have that, so
    the table is small at any size and no key is left out.
    """
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)) / parts).scalar()
    most = F.greatest(F.lit(float(hot_rows)), share)
    return counts.where(F.col("_n") > most).select(*on, F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias("_copies"))


def salted(
    rows: DataFrame, table: DataFrame, on: Key, spread_by: Key, counts: DataFrame | None = None, hot_rows: int = HOT_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``_salt``: a hot key's rows are dealt over as many salts
    as it needs, and its table row is repeated once per salt."""
    names = key_columns(on)
    if counts is None:
        counts = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    hot = F.broadcast(_copies(counts.select(*names, "_n"), names, hot_rows))
    copies = F.coalesce("_copies", F.lit(1))
    dealt = F.pmod(F.xxhash64(*key_columns(spread_by)), copies).cast("int")
    return (
        rows.join(hot, names, "left").withColumn("_salt", dealt).drop("_copies"),
        table.join(hot, names, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), copies - 1))).drop("_copies"),
    )


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    on: Key,
    spread_by: Key,
    how: str = "inner",
    counts: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row per key.

    ``spread_by`` tells the rows of one key apart. ``counts`` (key, _n) spares
    counting the rows per key where that is known already.
    """
    left, right = salted(rows, table, on, spread_by, counts, hot_rows)
    return left.join(right, [*key_columns(on), "_salt"], how).drop("_salt")

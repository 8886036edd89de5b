"""Row positions without a global sort in one task.

A table has no order, so every position is defined by a declared key. Keys must
be unique and non-null, which is checked; only key columns travel through the
ordering steps.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrow.functions.keys import Key, at_or_after, before, key_columns, key_digest
from tallyrow.session import checkpointed

# Positions below this are read from one bounded top-k; beyond it the key range
# is narrowed first.
DIRECT_LIMIT = 100_000

# Leading hex digits that name a digest bucket: 16**5 buckets split 10**12 rows
# into about a million rows each, and their start table stays near a million rows.
BUCKET_DIGITS = 5

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _nothing(names: Sequence[str]) -> Column:
    """Whether any part of a key is null."""
    return F.greatest(*(F.col(n).isNull() for n in names)) if len(names) > 1 else F.col(names[0]).isNull()


def _refuse(names: Sequence[str], nulls: int, again: int) -> None:
    if nulls or again:
        raise ValueError(f"key ({', '.join(names)}): {nulls} rows without one, {again} rows that repeat one")


def check_key(df: DataFrame, key: Key) -> DataFrame:
    """``df`` if every row has a key of its own without a null; else ValueError.

    Rows are counted per key with a combine before the shuffle; key columns alone travel.
    """
    names = key_columns(key)
    nothing = _nothing(names)
    found = (
        df.groupBy(*names)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.sum(F.when(nothing, F.col("_n")).otherwise(0)).alias("nulls"), F.sum(F.when(nothing, 0).otherwise(F.col("_n") - 1)).alias("again"))
        .first()
    )
    _refuse(names, found["nulls"], found["again"])
    return df


def head_end(df: DataFrame, key: Key, rows: int) -> tuple[Any, ...] | None:
    """The key that follows the first ``rows`` in key order (None: there are no more), checked without a shuffle of the keys.

    Null keys are counted in the scan. Of repeated ones those matter that stand in the head; it
    holds them all, as every task sends its own first rows.
    """
    names = key_columns(key)
    keys = df.select(*names)
    nulls = keys.agg(F.count_if(_nothing(names))).first()[0]
    along = Window.orderBy(*names)  # at most ``rows`` + 1 rows
    head = keys.orderBy(*names).limit(rows + 1).select(
        F.struct(*names).alias("_key"), F.row_number().over(along).alias("_at"), (F.lag(F.struct(*names)).over(along) == F.struct(*names)).alias("_same")
    )
    found = head.agg(F.count_if("_same").alias("again"), F.max(F.when(F.col("_at") == rows + 1, F.col("_key"))).alias("end")).first()
    _refuse(names, nulls, found["again"])
    return None if found["end"] is None else tuple(found["end"])


def _key_ranges(keys: DataFrame, names: list[str], parts: int) -> list[tuple[int, tuple]]:
    """(row count, smallest key) of each range partition, in key order: one row per partition."""
    ranges = (
        keys.repartitionByRange(parts, *names)
        .groupBy(F.spark_partition_id().alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*names)).alias("_first"))
        .orderBy("_first")
    )
    return [(row["_n"], tuple(row["_first"])) for row in ranges.collect()]


def keys_at(
    df: DataFrame, key: Key, positions: Sequence[int], direct_limit: int = DIRECT_LIMIT
) -> dict[int, tuple[Any, ...]]:
    """The key found at each 0-based position of the key order.

    Positions past the end are missing from the result. Reads key columns only.
    Far positions are found by repeated narrowing: count rows per key range,
    keep the range that holds the position, look again inside it.
    """
    names = key_columns(key)
    keys = df.select(*names)
    found: dict[int, tuple] = {}
    near = sorted({p for p in positions if p < direct_limit})
    if near:
        head = keys.orderBy(*names).limit(near[-1] + 1)
        place = (F.row_number().over(Window.orderBy(*names)) - 1).alias("_pos")
        for row in head.select(*names, place).where(F.col("_pos").isin(near)).collect():
            found[row["_pos"]] = tuple(row[n] for n in names)
    far = sorted({p for p in positions if p >= direct_limit})
    if not far:
        return found
    ranges = _key_ranges(keys, names, max(2, _partitions(df)))
    for position in far:
        skipped = 0
        for i, (count, first) in enumerate(ranges):
            if position < skipped + count:
                break
            skipped += count
        else:
            continue
        if len(ranges) == 1:
            row = keys.orderBy(*names).offset(position).limit(1).collect()
            found[position] = tuple(row[0])
            continue
        inside = keys.where(at_or_after(names, first))
        if i + 1 < len(ranges):
            inside = inside.where(before(names, ranges[i + 1][1]))
        found[position] = keys_at(inside, names, [position - skipped], direct_limit)[position - skipped]
    return found


def with_ordinal(df: DataFrame, key: Key, name: str = "ordinal", partitions: int | None = None) -> DataFrame:
    """Adds the 0-based position of each row in key order.

    Keys alone are range-sorted and checkpointed (range bounds are sampled, so a
    second run could cut them elsewhere), each partition's start is the running
    count of those before it, and the other columns join on by key.
    ``partitions`` is the number of key ranges, the session's shuffle partitions
    unless given. Null or repeated keys are refused.
    """
    names = key_columns(key)
    check_key(df, key)
    sorted_keys = (
        df.select(*names)
        .repartitionByRange(partitions or _partitions(df), *names)
        .sortWithinPartitions(*names)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    placed = checkpointed(sorted_keys).select(
        *names,
        F.shiftright("_at", _ROW_BITS).alias("_part"),
        F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    )
    # One row per shuffle partition: small enough to broadcast at any data size.
    ordinals = placed.join(F.broadcast(starts), "_part").select(
        *names, (F.col("_start") + F.col("_row")).cast("long").alias(name)
    )
    return ordinals if set(df.columns) == set(names) else df.join(ordinals, names)


def with_shuffled_position(
    df: DataFrame,
    key: Key,
    seed: int,
    per: Sequence[str] = (),
    name: str = "position",
    bucket_digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """Adds the 0-based position of each row in the order of md5(seed:per:key).

    The digest of a unique key is uniform, so its leading digits cut the rows
    into even buckets whatever the data looks like; ``per`` values (an epoch)
    each get their own sequence. Rows are shuffled once, by bucket.

    Null or repeated keys are refused where they are met: the first action on the result fails.
    """
    names, groups = key_columns(key), list(per)
    listed = ", ".join(names)
    without = F.raise_error(F.lit(f"key ({listed}): a row without one")).cast("boolean")
    again = F.raise_error(F.lit(f"key ({listed}): a row that repeats one")).cast("boolean")
    keyed = df.where(F.when(_nothing(names), without).otherwise(F.lit(True)))
    hashed = keyed.withColumn("_digest", key_digest(seed, [*groups, *names])).withColumn(
        "_bucket", F.substring("_digest", 1, bucket_digits)
    )
    # At most 16**bucket_digits rows per group.
    earlier = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        hashed.groupBy(*groups, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*groups, "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy(*groups, "_bucket").orderBy("_digest", *names)
    same = F.lag(F.struct(*names)).over(inside) == F.struct(*names)
    ranked = hashed.withColumn("_rank", F.row_number().over(inside) - 1).withColumn("_same", same)
    ranked = ranked.where(F.when(F.col("_same"), again).otherwise(F.lit(True)))
    return ranked.join(starts, [*groups, "_bucket"]).select(
        *df.columns, (F.col("_start") + F.col("_rank")).cast("long").alias(name)
    )

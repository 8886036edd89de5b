"""Epochs, batches and padding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrow.functions.keys import Key
from tallyrow.functions.ordering import with_ordinal, with_shuffled_position
from tallyrow.functions.skew import HOT_ROWS, lookup_join


def assign_batches(
    df: DataFrame, key: Key, epochs: int, batch_size: int, seed: int = 42, shuffle: bool = True
) -> DataFrame:
    """Each row once per epoch, with ``epoch``, ``batch_id`` and ``slot``.

    Shuffled epochs follow md5(seed:epoch:key); otherwise every epoch follows
    the key order.
    """
    if epochs < 1 or batch_size < 1:
        raise ValueError("epochs and batch_size must be positive")
    numbers = F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))
    if shuffle:
        placed = with_shuffled_position(df.withColumn("epoch", numbers), key, seed, per=["epoch"], name="_place")
    else:
        placed = with_ordinal(df, key, name="_place").withColumn("epoch", numbers)
    return placed.select(
        *df.columns,
        "epoch",
        F.floor(F.col("_place") / batch_size).alias("batch_id"),
        (F.col("_place") % batch_size).cast("int").alias("slot"),
    )


def pad_batches(df: DataFrame, ids: str, batch: str, key: Key, pad_id: int, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Pads ``ids`` to the longest row of its batch and adds ``attention_mask``.

    The mask comes from the lengths: a pad id may be a real token as well.
    Lengths are pre-aggregated per batch and joined back, so no batch is ever
    gathered into one task; ``key`` tells the rows of a batch apart. The ids are
    read twice: give a stored table rather than ids still to be computed.
    """
    sizes = df.groupBy(batch).agg(F.max(F.size(ids)).alias("_longest"), F.count(F.lit(1)).alias("_n"))
    longest = sizes.drop("_n")
    missing = F.col("_longest") - F.size(ids)
    return (
        lookup_join(df, longest, batch, spread_by=key, counts=sizes, hot_rows=hot_rows)
        .withColumn("attention_mask", F.concat(F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), missing)))
        .withColumn(ids, F.concat(F.col(ids), F.array_repeat(F.lit(pad_id), missing)))
        .drop("_longest")
    )

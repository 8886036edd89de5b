"""Packing by length buckets with the least padding.

The lengths of all documents are counted. Dynamic programming over that histogram
picks at most ``buckets`` boundaries such that padding every document to its
bucket's boundary adds the fewest tokens. Within a bucket documents are dealt in
a seeded order into batches of as many as fit the token budget once padded (one
at least, so that a document longer than the budget is a batch of its own: nothing
is cut).

Every distinct length is a column of the histogram, so the boundaries are the best of
all. There are far fewer lengths than rows: d of them take d * d / 2 tokens at least.

Documents without tokens (null or empty texts) have length 0 and share batches of
a bucket as if padded to 1. Repeated rows are packed as rows. An empty table gives
an empty result. Ties between equally good boundaries go to the smaller one.

The order within a bucket is that of an md5 of the seed and the key; it is cut
into slices by its leading digits, counted, and numbered slice by slice, so no
task holds a whole bucket.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyrow.session import written

# Documents of one slice of a bucket's order, about.
SLICE_ROWS = 20_000
# A slice of so many times SLICE_ROWS documents is cut further. Even slices come nowhere near.
HOT = 4
_DIGITS = 15


def boundaries(longest: np.ndarray, count: np.ndarray, buckets: int) -> list[int]:
    """The boundaries, ascending, that pad the least; ``longest`` is ascending.

    cost[j] after k rounds: the fewest padded tokens for columns 0..j in k buckets. A last
    bucket after column i costs cost[i] - longest[j] * docs[i], a line over longest[j] whose
    slope falls with i, so the lowest lines are kept in a hull and met in order.
    """
    if not len(longest):
        return []
    longest, docs = [int(x) for x in longest], [int(x) for x in np.cumsum(count)]
    cost = [x * d for x, d in zip(longest, docs)]
    choice = []
    for _ in range(min(buckets, len(longest)) - 1):
        better, start = cost.copy(), np.zeros(len(longest), int)
        hull: list[int] = []
        at = 0
        for j in range(1, len(longest)):
            # The line of i = j - 1 hides the last one if it meets the one before no later.
            i = j - 1
            while len(hull) > 1 and (cost[i] - cost[hull[-2]]) * (docs[hull[-1]] - docs[hull[-2]]) <= (cost[hull[-1]] - cost[hull[-2]]) * (docs[i] - docs[hull[-2]]):
                hull.pop()
            hull.append(i)
            at = min(at, len(hull) - 1)
            x = longest[j]
            while at + 1 < len(hull) and cost[hull[at + 1]] - x * docs[hull[at + 1]] < cost[hull[at]] - x * docs[hull[at]]:
                at += 1
            # The last bucket holds columns i + 1..j.
            i = hull[at]
            found = cost[i] + x * (docs[j] - docs[i])
            if found < better[j]:
                better[j], start[j] = found, i + 1
        choice.append(start)
        cost = better
    cuts, j = [], len(longest) - 1
    for start in reversed(choice):
        if start[j]:
            cuts.append(int(longest[j]))
            j = start[j] - 1
    return sorted({*cuts, int(longest[j])})


def pack(
    docs: DataFrame, buckets: int = 16, budget: int = 65_536, seed: int = 0, key: str = "doc_id", tokens: str = "n_tokens"
) -> DataFrame:
    """(key, tokens, bucket, boundary, batch_id, slot, padding) of every row of ``docs``.

    ``batch_id`` counts batches within the bucket, ``slot`` places within the batch.
    """
    rows = written(docs.select(key, tokens).withColumn("_row", F.monotonically_increasing_id()), "packing-rows")
    length = F.greatest(F.coalesce(F.col(tokens), F.lit(0)), F.lit(0))
    histogram = rows.groupBy(length.alias("longest")).agg(F.count(F.lit(1)).alias("n")).orderBy("longest").collect()
    bounds = boundaries(np.array([r["longest"] for r in histogram], np.int64), np.array([r["n"] for r in histogram], np.int64), buckets)
    if not bounds:
        bounds = [0]
    total = sum(r["n"] for r in histogram)
    width = (16**_DIGITS) // max(1, -(-total // SLICE_ROWS)) + 1
    bucket = F.lit(len(bounds) - 1)
    for i in reversed(range(len(bounds) - 1)):
        bucket = F.when(length <= bounds[i], F.lit(i)).otherwise(bucket)
    boundary = F.element_at(F.array(*(F.lit(b).cast("long") for b in bounds)), F.col("bucket") + 1)
    joined = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit("")))
    dealt = (
        rows.withColumn("bucket", bucket)
        .withColumn("_at", F.conv(F.substring(F.md5(joined), 1, _DIGITS), 16, 10).cast("long"))
        .withColumn("_slice", F.expr(f"_at div {width}"))
    )
    sizes = dealt.groupBy("bucket", "_slice").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOT * SLICE_ROWS)
    hot = written(sizes.select("bucket", "_slice", F.expr(f"_n div {SLICE_ROWS}").alias("_parts")), "packing-hot")
    if hot.head():
        part = F.when(F.col("_parts").isNotNull(), F.pmod(F.xxhash64("_row"), "_parts")).otherwise(F.lit(0))
        dealt = dealt.join(hot, ["bucket", "_slice"], "left").withColumn("_part", part).drop("_parts")
    else:
        dealt = dealt.withColumn("_part", F.lit(0))
    earlier = Window.partitionBy("bucket").orderBy("_slice", "_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("bucket", "_slice", "_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("bucket", "_slice", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy("bucket", "_slice", "_part").orderBy("_at", key, tokens)
    ranked = dealt.withColumn("_rank", F.row_number().over(inside) - 1)
    per_batch = F.greatest(F.expr(f"{int(budget)}L div greatest(boundary, 1L)"), F.lit(1)).cast("long")
    return (
        ranked.join(starts, ["bucket", "_slice", "_part"])
        .withColumn("boundary", boundary)
        .withColumn("_place", F.col("_start") + F.col("_rank"))
        .withColumn("_per", per_batch)
        .select(
            key,
            tokens,
            "bucket",
            "boundary",
            F.expr("_place div _per").cast("long").alias("batch_id"),
            (F.col("_place") % F.col("_per")).cast("long").alias("slot"),
            (F.col("boundary") - length).cast("long").alias("padding"),
        )
    )

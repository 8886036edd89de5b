"""Reports that answer exactly without sorting or gathering a table: percentiles, broken rows, large groups."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyrow.functions.keys import Key, key_columns
from tallyrow.functions.text import words
from tallyrow.operators.contracts import Contract, row_rules
from tallyrow.session import written

# Lengths that one window adds up.
SPAN = 4096


def length_percentiles(df: DataFrame, columns: Sequence[str], percents: Sequence[int], span: int = SPAN) -> DataFrame:
    """(field, percent, length) per text column: the smallest length that at least ``percent`` of 100 rows do not exceed.

    Lengths are counted in words and merged to a histogram, map side first; prefix counts over spans of lengths, then
    within each span, pick the length at the wanted rank. Rows are never sorted. A null text has no words; an empty table gives no row.
    """
    if any(not 0 < p <= 100 for p in percents):
        raise ValueError("percents are whole numbers from 1 to 100")
    lengths = F.array(*(F.struct(F.lit(c).alias("field"), F.size(words(F.col(c))).cast("bigint").alias("length")) for c in columns))
    histogram = df.select(F.inline(lengths)).groupBy("field", "length").agg(F.count(F.lit(1)).alias("_n"))
    histogram = histogram.withColumn("_span", F.expr(f"length div {int(span)}"))
    spans = histogram.groupBy("field", "_span").agg(F.sum("_n").alias("_rows"))
    before = Window.partitionBy("field").orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        "field", "_span", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"), F.sum("_rows").over(Window.partitionBy("field")).alias("_all")
    )
    upto = Window.partitionBy("field", "_span").orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    summed = histogram.join(spans, ["field", "_span"]).withColumn("_upto", F.col("_before") + F.sum("_n").over(upto))
    wanted = summed.withColumn("percent", F.explode(F.array(*(F.lit(p).cast("int") for p in dict.fromkeys(percents)))))
    # Rank ceil(percent * rows / 100), counted from 1.
    rank = F.expr("(percent * _all + 99) div 100")
    return wanted.where((F.col("_upto") >= rank) & (F.col("_upto") - F.col("_n") < rank)).select("field", "percent", "length")


def contract_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """(key, rule, field) of every rule that a row breaks, found in one pass; ``repeated_key`` names each row of a repeated key once more.

    Only offending rows come out. Rules of missing columns, and of types, are those of the table: `contract_report` has them.
    """
    names = key_columns(contract.key)
    if not set(names) <= set(df.columns):
        raise ValueError(f"no column for the key ({', '.join(names)})")
    rules = F.array_compact(F.array(*(F.when(broken, F.struct(F.lit(r).alias("rule"), F.lit(f).alias("field"))) for r, f, broken in row_rules(df, contract))))
    broken = df.select(*names, F.inline(rules))
    # Equal keys meet as counts, then come out as often as they stand.
    again = df.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    again = again.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("bigint"), "_n"))).select(*names, F.lit("repeated_key").alias("rule"), F.lit(", ".join(names)).alias("field"))
    return broken.union(again)


def _sketch(share: float, room: int):
    """A task's sketch: values and at most how many of its rows hold each, for all values that half of ``share`` of its rows hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str | None, int] = {}
        lost = rows = 0
        for batch in batches:
            rows += batch.num_rows
            for entry in pc.value_counts(batch.column(0)).to_pylist():
                kept[entry["values"]] = kept.get(entry["values"], 0) + entry["counts"]
            if len(kept) > 2 * room:
                # Drop to ``room`` values: what each of the others counted at most is what any value may have lost.
                bar = sorted(kept.values(), reverse=True)[room]
                kept = {value: n - bar for value, n in kept.items() if n > bar}
                lost += bar
        found = [(value, n + lost) for value, n in kept.items() if n + lost >= share / 2 * rows]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([v for v, _ in found] + [None], pa.string()), pa.array([n for _, n in found] + [rows], pa.int64()), pa.array([False] * len(found) + [True])],
                names=["value", "n", "total"],
            )

    return run


def group_report(df: DataFrame, group: str, share: float = 0.01) -> DataFrame:
    """(group, rows, of): the groups that hold at least ``share`` of all rows, exactly counted, and the number of all rows.

    A first pass sketches each task's rows in bounded room. Whatever holds ``share`` of all rows is named by the tasks
    with at least half of that between them, so at most some 2 / ``share`` groups stay; the second pass counts these and
    no others. No group key but theirs is shuffled. A null group is a group.
    """
    if not 0 < share <= 1:
        raise ValueError("share lies between 0 and 1")
    kind = df.schema[group].dataType
    keys = df.select(F.col(group).cast("string").alias("value"))
    sketch = written(keys.mapInArrow(_sketch(share, int(8 / share) + 1), "value string, n bigint, total boolean"), "sketch")
    total = sketch.where("total").agg(F.sum("n")).first()[0]
    if not total:
        return df.select(group, F.lit(0).cast("bigint").alias("rows"), F.lit(0).cast("bigint").alias("of")).limit(0)
    # A value named by no task with half of ``share`` there lacks at most half of ``share`` altogether.
    named = sketch.where("not total").groupBy(F.col("value").alias("_value")).agg(F.sum("n").alias("_most")).where(F.col("_most") >= share / 2 * total)
    held = keys.join(F.broadcast(named), F.col("value").eqNullSafe(F.col("_value")))
    counted = held.groupBy("value").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= share * total)
    return counted.select(F.col("value").cast(kind).alias(group), "rows", F.lit(total).cast("bigint").alias("of"))

"""How much of a held-out text stands in the training texts, passage by passage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrow.functions.keys import Key, key_columns
from tallyrow.functions.ordering import check_key
from tallyrow.functions.skew import HOT_ROWS, lookup_join
from tallyrow.functions.text import words
from tallyrow.session import written


def passages(text: Column, n: int) -> Column:
    """The digest of every run of ``n`` consecutive words, in text order; none for shorter texts."""
    listed = words(text)
    count = F.size(listed) - n + 1
    starts = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.md5(F.array_join(F.slice(listed, i, F.lit(n)), " ")))


def shared_passages(left: DataFrame, right: DataFrame, key: Key, text: str, n: int = 8, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(key, passages, shared) of every row of ``right``: its runs of ``n`` words, and how many of them ``left`` holds as well.

    Digests alone travel. A passage that fills a third of ``left`` is one row per map task; one that fills a
    third of ``right`` is dealt over several tasks. Passages of ``right`` that no text of ``left`` has meet nothing: the
    join keeps only those that do, and counts per row come back to the keys. Null or repeated keys of ``right`` are refused.
    """
    if n < 1:
        raise ValueError("a passage has at least one word")
    names = key_columns(key)
    check_key(right, names)
    asked = written(right.select(*names, passages(F.col(text), n).alias("_passages")), "passages")
    # Only passages that the other side asks for come out of the training texts.
    wanted = written(asked.select(F.explode("_passages").alias("_passage")).groupBy("_passage").agg(F.count(F.lit(1)).alias("_n")), "wanted")
    held = left.select(F.explode(passages(F.col(text), n)).alias("_passage")).distinct()
    known = written(held.join(wanted.select("_passage"), "_passage", "left_semi"), "known")
    rows = asked.select(*names, F.posexplode("_passages").alias("_at", "_passage"))
    found = lookup_join(rows, known.withColumn("_known", F.lit(1)), "_passage", spread_by=[*names, "_at"], counts=wanted, hot_rows=hot_rows)
    counted = found.groupBy(*names).agg(F.count("_known").alias("shared"))
    sized = asked.select(*names, F.size("_passages").cast("bigint").alias("passages"))
    return sized.join(counted, names, "left").select(*names, "passages", F.coalesce("shared", F.lit(0)).cast("bigint").alias("shared"))

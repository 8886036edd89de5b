"""The row-local operators over files as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def stream_jsonl(
    spark: SparkSession,
    source: str,
    schema: str | StructType,
    operator: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
) -> StreamingQuery:
    """Applies a row-local operator to every new JSONL file of a folder, then stops.

    The checkpoint remembers the files already taken, so a rerun adds only later ones.
    """
    rows = spark.readStream.schema(schema).json(source)
    return (
        operator(rows)
        .writeStream.format("json")
        .option("ignoreNullFields", "false")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )

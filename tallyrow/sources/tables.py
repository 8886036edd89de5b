"""Reading instruction tables and JSONL files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

INSTRUCTION_SCHEMA = "row_id bigint, instruction string, input string, output string"
PROMPT_SCHEMA = "row_id bigint, prompt string"
PAIR_SCHEMA = "row_id bigint, prompt string, chosen string, rejected string"
VALUE_SCHEMA = "row_id bigint, text string, label double"

SPLIT_COLUMN = "split"


def spread(df: DataFrame) -> DataFrame:
    """A scanned table over at least as many partitions as there are cores.

    Meant for heavy per-row work on a table in a few big files. A table that
    already comes in enough splits, any large one, passes through unshuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def select_split(df: DataFrame, name: str) -> DataFrame:
    """The rows of one named split. On a table partitioned by ``split`` only its folder is listed."""
    return df.where(F.col(SPLIT_COLUMN) == F.lit(name))


def read_instructions(
    spark: SparkSession,
    path: str,
    split: str | None = None,
    fmt: str = "parquet",
    schema: str | StructType = INSTRUCTION_SCHEMA,
) -> DataFrame:
    """An instruction table (parquet or JSONL), optionally one of its splits."""
    if fmt not in ("parquet", "json"):
        raise ValueError(f"unknown format {fmt!r}: parquet or json")
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if split is None:
        return spark.read.schema(wanted).format(fmt).load(path)
    if SPLIT_COLUMN not in wanted.fieldNames():
        wanted = StructType([*wanted.fields]).add(SPLIT_COLUMN, "string")
    return select_split(spark.read.schema(wanted).format(fmt).load(path), split)


def read_jsonl(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """One JSON object per line. The schema is the caller's contract: inference
    would cost a scan and reorder columns. A malformed line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)

"""JSONL files in key order, with a manifest of the rows each file holds.

Rows are range-partitioned by key and sorted within each range, so file k holds the
keys after those of file k - 1 and no task sees more than its range. The manifest is
written when every file is complete: an export that fails has none, and files that it
left behind are listed nowhere. ``path`` is a fresh folder; an existing one is refused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyrow.functions.keys import Key, key_columns
from tallyrow.functions.ordering import check_key
from tallyrow.sources.lines import SPLIT_BYTES, read_keyless

MANIFEST_SCHEMA = "name string, part int, first bigint, rows bigint"

# Rows of an export in order, and their key: the file's number and the place in it.
ORDER = ("part", "position")


def _name(path):
    return F.element_at(F.split(path, "/"), -1)


def export_ordered(df: DataFrame, key: Key, path: str, fields: Sequence[str] | None = None, files: int | None = None) -> int:
    """Writes ``fields`` (all columns unless given) in key order and returns how many rows were written.

    ``files`` is the number of key ranges, the session's shuffle partitions unless given. Null or repeated
    keys are refused: their order would not be one. The table is read twice: give a stored one.
    """
    spark, names = df.sparkSession, key_columns(key)
    check_key(df, names)
    kept = list(fields) if fields is not None else df.columns
    parts = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.select(*dict.fromkeys([*names, *kept])).repartitionByRange(parts, *names).sortWithinPartitions(*names).select(*kept)
    ordered.write.mode("errorifexists").option("ignoreNullFields", "false").json(f"{path}/data")
    return _commit(spark, path)


def _commit(spark: SparkSession, path: str) -> int:
    """Lists the complete files with the position of their first row; one manifest row per file."""
    counted = (
        spark.read.text(f"{path}/data")
        .select(F.col("_metadata.file_name").alias("name"))
        .groupBy("name")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("part", F.regexp_extract("name", r"^part-(\d+)", 1).cast("int"))
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    listed = counted.select("name", "part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("first"), "rows")
    listed.coalesce(1).write.mode("errorifexists").json(f"{path}/_manifest")
    return read_manifest(spark, path).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(name, part, first, rows) of every file of a complete export; without a manifest there is no export, and the read fails."""
    return spark.read.schema(MANIFEST_SCHEMA).option("mode", "FAILFAST").json(f"{path}/_manifest")


def read_ordered(spark: SparkSession, path: str, schema: str | StructType, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The rows of an export with ``ORDER`` as their key. Files the manifest does not list are left out."""
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if clash := set(ORDER) & set(wanted.fieldNames()):
        raise ValueError(f"fields named like the order of rows: {', '.join(sorted(clash))}")
    files = read_manifest(spark, path).select(F.col("name").alias("_name"), "part")
    rows = read_keyless(spark, f"{path}/data", wanted, split_bytes)
    return rows.withColumn("_name", _name("file")).join(files, "_name").select(*ORDER, *wanted.fieldNames())


def check_export(spark: SparkSession, path: str) -> None:
    """ValueError if a listed file is gone or holds another number of rows."""
    there = spark.read.text(f"{path}/data").select(F.col("_metadata.file_name").alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("_there"))
    odd = read_manifest(spark, path).join(there, "name", "left").where("_there is null or _there <> rows").orderBy("part").limit(5).collect()
    if odd:
        raise ValueError("; ".join(f"{r['name']}: {r['_there'] or 0} rows, {r['rows']} listed" for r in odd))

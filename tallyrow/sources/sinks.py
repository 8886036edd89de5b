"""JSONL output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

WRITE_MODES = ("overwrite", "append", "errorifexists")


def json_line(*columns: str) -> Column:
    """One row as a JSON object; null fields are kept, non-ASCII stays as it is."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Writes one JSON object per line and returns the number of rows written.

    The count is observed during the write, not by a second scan.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"unknown mode {mode!r}: one of {', '.join(WRITE_MODES)}")
    written = Observation()
    (
        df.observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode(mode)
        .option("ignoreNullFields", "false")
        .json(path)
    )
    return written.get["rows"]

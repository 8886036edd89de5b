"""Whole numbers by key as sorted arrays below the shared folder, for tasks to look up row by row.

A join would shuffle every row that asks. Here the table alone is shuffled, into shards of
bounded size; workers map the shards, so those of one machine share their pages. Files are
written under a name of their own and renamed when whole: a task that is run again leaves the same.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote, urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrow.session import scratch_path, shared_dir

# Keys that a task sorts and holds at a time.
SHARD_KEYS = 1 << 20


def is_mounted(spark: SparkSession) -> bool:
    """Whether the shared folder is a path that every machine mounts."""
    return urlsplit(shared_dir(spark)).scheme in ("", "file")


def _save(path: str, values: np.ndarray) -> None:
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as out:
        np.save(out, values)
    os.replace(part, path)


@dataclass(frozen=True)
class Numbers:
    """Where the sorted keys and the rows of their numbers lie."""

    folder: str
    shards: int
    held: tuple[int, ...]  # shards that hold any key
    width: int

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether the table has it, its numbers) of each of the ascending keys."""
        known, out = np.zeros(len(keys), bool), np.zeros((len(keys), self.width), np.int64)
        shard = keys % self.shards
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(self.shards + 1))
        for s in self.held:
            mine = order[cuts[s] : cuts[s + 1]]
            if len(mine):
                table = np.load(f"{self.folder}/{s}.key.npy", mmap_mode="r")
                at = np.searchsorted(table, keys[mine])
                at[at == len(table)] = 0
                same = table[at] == keys[mine]
                known[mine] = same
                out[mine[same]] = np.load(f"{self.folder}/{s}.number.npy", mmap_mode="r")[at[same]]
        return known, out


def _write(folder: str):
    """Saves each shard of rows (shard, key, numbers...) that come ordered by shard and key."""

    def save(shard: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        columns = [np.concatenate([p.column(i).to_numpy(zero_copy_only=False) for p in parts]) for i in range(1, parts[0].num_columns)]
        _save(f"{folder}/{shard}.key.npy", columns[0])
        _save(f"{folder}/{shard}.number.npy", np.stack(columns[1:], axis=1))
        return pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            shards = batch.column(0).to_numpy()
            for at, to in zip(*_spans(shards)):
                if parts and shards[at] != last:
                    yield save(last, parts)
                    parts = []
                last = int(shards[at])
                parts.append(batch.slice(at, to - at))
        if parts:
            yield save(last, parts)

    return run


def _spans(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each stretch of equal values begins and ends."""
    cuts = np.flatnonzero(np.r_[True, values[1:] != values[:-1], True]) if len(values) else np.zeros(1, int)
    return cuts[:-1], cuts[1:]


def write_numbers(rows: DataFrame, key: str, columns: Sequence[str], count: int, label: str, shard_keys: int = SHARD_KEYS) -> Numbers:
    """Saves the bigint ``columns`` of ``rows``, of which there are about ``count``, by their bigint ``key``, unique and not null."""
    folder = unquote(urlsplit(scratch_path(rows.sparkSession, label)).path)
    os.makedirs(folder, exist_ok=True)
    # Odd, so that both halves of a key made of two numbers tell.
    shards = -(-count // shard_keys) | 1
    placed = rows.select(F.pmod(F.col(key), F.lit(shards)).cast("int").alias("_shard"), F.col(key).alias("_key"), *columns)
    ordered = placed.repartition(shards, "_shard").sortWithinPartitions("_shard", "_key")
    held = sorted(row["shard"] for row in ordered.mapInArrow(_write(folder), "shard int").collect())
    return Numbers(folder, shards, tuple(held), len(columns))

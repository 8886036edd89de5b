"""Sorted number arrays cut into shards: packed for a shuffle, written to the shared folder, mapped by workers.

Files are written by tasks under a name of their own and renamed when whole, so
a task that is run again after a lost executor leaves the same files.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import unquote, urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallyrow.session import scratch_path

PACKED = "shard int, kind int, n bigint, keys binary, counts binary"


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one, as the path under which every machine mounts it."""
    uri = urlsplit(scratch_path(spark, label))
    if uri.scheme not in ("", "file"):
        raise ValueError(f"spark.checkpoint.dir is {uri.scheme}://: memory-mapped files need a mounted folder (file:/...)")
    path = unquote(uri.path)
    os.makedirs(path, exist_ok=True)
    return path


def save(path: str, values: np.ndarray) -> None:
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as out:
        np.save(out, values)
    os.replace(part, path)


def mapped(path: str) -> np.ndarray:
    found = np.load(path, mmap_mode="r")
    return found.view(np.ndarray) if found.size else np.zeros(found.shape, found.dtype)


def narrow(values: np.ndarray) -> np.ndarray:
    """The same counts in the fewest bytes that hold them all."""
    return values.astype(np.min_scalar_type(int(values.max()) if values.size else 0))


def pack(numbers: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes; ``steps`` first where they ascend."""
    planes = np.ascontiguousarray(numbers.astype("<u8")).view(np.uint8).reshape(-1, 8).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, n * 8, codec="zstd"), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(n)


def steps(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=np.uint64(0))


def packed_rows(keys: np.ndarray, counts: np.ndarray, shards: np.ndarray, kind: int = 0) -> Iterator[pa.RecordBatch]:
    """One row per shard that holds any of the ascending keys. ``counts`` may have several columns."""
    order = np.argsort(shards.astype(np.uint16), kind="stable")
    keys, counts, shards = keys[order], counts[order], shards[order]
    ends = np.flatnonzero(np.r_[shards[1:] != shards[:-1], True]) + 1 if len(keys) else []
    at = 0
    for to in ends:
        yield pa.RecordBatch.from_pydict(
            {
                "shard": pa.array([int(shards[at])], pa.int32()),
                "kind": pa.array([kind], pa.int32()),
                "n": pa.array([to - at], pa.int64()),
                "keys": pa.array([pack(steps(keys[at:to]))], pa.binary()),
                "counts": pa.array([pack(counts[at:to].T.ravel())], pa.binary()),
            }
        )
        at = to


Part = tuple[int, np.ndarray, np.ndarray]


def unpacked(batches: Iterator[pa.RecordBatch], width: dict[int, int] | int = 1) -> Iterator[tuple[int, Iterator[Part]]]:
    """(shard, its (kind, keys, counts) parts) of rows that come ordered by shard."""
    held: list = []

    def rows() -> Iterator[dict]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}

    source = rows()

    def parts(first: dict) -> Iterator[Part]:
        row: dict | None = first
        while row is not None and row["shard"] == first["shard"]:
            n, columns = row["n"], width if isinstance(width, int) else width[row["kind"]]
            keys = np.cumsum(unpack(row["keys"], n), dtype=np.uint64)
            counts = unpack(row["counts"], n * columns)
            yield row["kind"], keys, counts if columns == 1 else counts.reshape(columns, n).T
            row = next(source, None)
        if row is not None:
            held.append(row)

    row = next(source, None)
    while row is not None:
        held.clear()
        group = parts(row)
        yield row["shard"], group
        for _ in group:
            pass
        row = held.pop() if held else None


def by_shard(rows: DataFrame, shards: int, task: Callable, schema: str) -> DataFrame:
    """``task`` over the packed rows, all rows of a shard in one task and next to each other."""
    return rows.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(task, schema)


class Sums:
    """Counts per key in bounded room: parts are merged as soon as enough are waiting."""

    def __init__(self, most: int = 1 << 21):
        self.most, self.waiting, self.parts = most, 0, []

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.waiting += len(keys)
        if self.waiting > self.most and len(self.parts) > 1:
            self.parts = [self.merged()]
            # What has been merged waits no more; half as much again may come first.
            self.waiting = 0
            self.most = max(self.most, len(self.parts[0][0]) // 2)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        if len(self.parts) == 1:
            return self.parts[0]
        keys = np.concatenate([k for k, _ in self.parts])
        counts = np.concatenate([c for _, c in self.parts])
        self.parts = []
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        return keys[new], np.add.reduceat(counts, new) if len(new) else counts

    def __len__(self) -> int:
        return sum(len(k) for k, _ in self.parts)

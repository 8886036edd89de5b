"""JSON lines with their place: a data source whose rows are (file, position, line).

A file without a key column has an order all the same. Here the place of a line, the
file's path and the byte it begins at, is the key: it is the same whatever the splits, so
such a file can be sliced, numbered and batched like any keyed table.

Files are cut into byte ranges. A line belongs to the range it begins in, so every
range is read alone, and its task may be run again anywhere. Files are opened with
Arrow's file systems (local and mounted folders, ``s3``, ``gs``, ``hdfs``); compressed
files (.gz, .zst, .bz2) cannot be cut and are one range each, places counting the bytes
of the text they hold. Blank lines are passed over; a line may end with CR LF.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

# The key of rows that have none.
PLACE = ("file", "position")

SPLIT_BYTES = 128 << 20
_CHUNK = 4 << 20
_PACKED = {".gz": "gzip", ".zst": "zstd", ".bz2": "bz2"}
_BLANK = b" \t\r"


def _codec(path: str) -> str | None:
    return next((codec for end, codec in _PACKED.items() if path.endswith(end)), None)


@dataclass
class Range(InputPartition):
    """Lines of one file that begin at byte ``start`` or later and before ``stop`` (None: to the end)."""

    path: str
    start: int
    stop: int | None


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def ranges(uri: str, split_bytes: int) -> list[Range]:
    """The byte ranges of a file, or of the files of a folder by path; names that begin with ``_`` or ``.`` are none of its data."""
    system, path = _opened(uri)
    info = system.get_file_info(path)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(uri)
    found = [info]
    if info.type == fs.FileType.Directory:
        found = [f for f in system.get_file_info(fs.FileSelector(path, recursive=True)) if f.type == fs.FileType.File]
        found = [f for f in found if not any(part[0] in "_." for part in f.path[len(path) :].strip("/").split("/"))]
    out = []
    for file in sorted(found, key=lambda f: f.path):
        if _codec(file.path):
            out.append(Range(file.path, 0, None))
        else:
            out += [Range(file.path, at, min(at + split_bytes, file.size)) for at in range(0, file.size, split_bytes)]
    return out


def _chunks(source, start: int) -> Iterator[tuple[int, bytes]]:
    """(place, whole lines without their last line end) of the text from a byte on; the first line may be the rest of one."""
    at, held = start, []
    while chunk := source.read(_CHUNK):
        cut = chunk.rfind(b"\n")
        if cut < 0:
            held.append(chunk)
            continue
        whole = b"".join([*held, chunk[:cut]])
        yield at, whole
        at += len(whole) + 1
        held = [chunk[cut + 1 :]]
    if rest := b"".join(held):
        yield at, rest


def lines(system: fs.FileSystem, part: Range) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """(places, lines) of a range, chunk by chunk."""
    codec = _codec(part.path)
    with system.open_input_stream(part.path, compression=codec) if codec else system.open_input_file(part.path) as source:
        # The byte before tells whether a line begins here: what comes before the first line end belongs to an earlier range.
        first = max(part.start - 1, 0)
        if first:
            source.seek(first)
        own = not part.start
        for at, whole in _chunks(source, first):
            found = whole.split(b"\n")
            places = at + np.cumsum([0, *(len(line) + 1 for line in found[:-1])])
            if not own:
                found, places, own = found[1:], places[1:], True
            if part.stop is not None:
                found = found[: int(np.searchsorted(places, part.stop))]
            keep = [i for i, line in enumerate(found) if line.strip(_BLANK)]
            if keep:
                yield places[keep], [found[i].rstrip(b"\r") for i in keep]
            if part.stop is not None and at + len(whole) + 1 >= part.stop:
                return


class LineReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.uri = options["path"]
        self.split_bytes = int(options.get("splitbytes", SPLIT_BYTES))

    def partitions(self) -> list[Range]:
        return ranges(self.uri, self.split_bytes) or [Range("", 0, 0)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        system, _ = _opened(self.uri)
        for places, found in lines(system, part):
            yield pa.RecordBatch.from_arrays(
                [pa.array([part.path] * len(found), pa.string()), pa.array(places, pa.int64()), pa.array(found, pa.binary()).cast(pa.string())],
                names=[*PLACE, "line"],
            )


class LineSource(DataSource):
    """``spark.read.format("placed_lines")``; option ``splitbytes`` is the length of a range."""

    @classmethod
    def name(cls) -> str:
        return "placed_lines"

    def schema(self) -> str:
        return "file string, position bigint, line string"

    def reader(self, schema: StructType) -> LineReader:
        return LineReader(dict(self.options))


def read_lines(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(file, position, line) of the lines of a file or folder."""
    if split_bytes < 1:
        raise ValueError("split_bytes must be positive")
    spark.dataSource.register(LineSource)
    return spark.read.format("placed_lines").option("splitbytes", str(split_bytes)).load(path)


def read_keyless(spark: SparkSession, path: str, schema: str | StructType, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The objects of a JSONL file or folder that names no key, with ``PLACE`` as their key. A malformed line fails the read."""
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if clash := set(PLACE) & set(wanted.fieldNames()):
        raise ValueError(f"fields named like the place of a line: {', '.join(sorted(clash))}")
    parsed = F.from_json("line", wanted, {"mode": "FAILFAST"}).alias("_row")
    return read_lines(spark, path, split_bytes).select(*PLACE, parsed).select(*PLACE, "_row.*")

"""Lines with their places, whatever the byte ranges; slices of files without a key."""

import gzip
import json
import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from tallyrow.operators import batching, slices
from tallyrow.sources import lines

SCHEMA = "instruction string, input string, output string"


def plain(path):
    """(position, text) of every line that is not blank."""
    raw, at, out = path.read_bytes(), 0, []
    for line in raw.split(b"\n"):
        if line.strip(b" \t\r"):
            out.append((at, line.rstrip(b"\r").decode()))
        at += len(line) + 1
    return out


def write(path, seed, rows=60, end="\n"):
    rng = random.Random(seed)
    texts = [json.dumps({"instruction": rng.choice(["é", "日本", "a"]) * rng.randint(0, 40), "input": None, "output": str(i)}, ensure_ascii=False) for i in range(rows)]
    body = "".join(t + rng.choice([end, end, "\n\n", "\n \t\n", "\r\n"]) for t in texts)
    path.write_text(body if seed % 2 else body.rstrip(), encoding="utf-8", newline="")


@pytest.mark.parametrize("chunk", [1, 7, 64, 1 << 20])
@pytest.mark.parametrize("split", [1, 3, 50, 1000, 1 << 20])
def test_every_line_once_whatever_the_ranges(tmp_path, monkeypatch, chunk, split):
    monkeypatch.setattr(lines, "_CHUNK", chunk)
    for seed in (1, 2):
        path = tmp_path / f"{seed}.jsonl"
        write(path, seed, 12)
        system, _ = lines._opened(str(path))
        got = [(int(p), t.decode()) for part in lines.ranges(str(path), split) for ps, ts in lines.lines(system, part) for p, t in zip(ps, ts)]
        assert got == plain(path)


def test_a_range_ends_at_a_line_end(tmp_path):
    path = tmp_path / "x"
    path.write_bytes(b"aa\nbb\n\n\ncc")
    system, _ = lines._opened(str(path))
    for split in range(1, 12):
        got = [(int(p), t) for part in lines.ranges(str(path), split) for ps, ts in lines.lines(system, part) for p, t in zip(ps, ts)]
        assert got == [(0, b"aa"), (3, b"bb"), (8, b"cc")]


def test_folder_of_plain_and_packed_files(spark, tmp_path):
    folder = tmp_path / "in"
    (folder / "sub").mkdir(parents=True)
    write(folder / "b.jsonl", 1)
    write(folder / "sub" / "a.jsonl", 2, end="\r\n")
    write(tmp_path / "c.jsonl", 3)
    (folder / "c.jsonl.gz").write_bytes(gzip.compress((tmp_path / "c.jsonl").read_bytes()))
    (folder / "_SUCCESS").write_text("{}")
    (folder / ".hidden").write_text("not json")
    (folder / "empty.jsonl").write_text("")
    want = [(f"{folder}/{name}", p, t) for name, path in (("b.jsonl", folder / "b.jsonl"), ("c.jsonl.gz", tmp_path / "c.jsonl"), ("sub/a.jsonl", folder / "sub" / "a.jsonl")) for p, t in plain(path)]
    for split in (100, lines.SPLIT_BYTES):
        for path in (str(folder), f"file://{folder}"):
            df = lines.read_lines(spark, path, split)
            assert sorted(tuple(r) for r in df.collect()) == sorted(want)
    assert lines.read_lines(spark, str(folder), 100).rdd.getNumPartitions() > 10


def test_slices_of_a_file_without_a_key(spark, tmp_path):
    path = tmp_path / "rows.jsonl"
    write(path, 1, 50)
    rows = lines.read_keyless(spark, str(path), SCHEMA, split_bytes=200)
    assert rows.columns == ["file", "position", "instruction", "input", "output"]
    ids = lambda df: sorted(int(r.output) for r in df.collect())
    assert ids(slices.slice_spec(rows, "train[:7]", lines.PLACE)) == list(range(7))
    assert ids(slices.slice_spec(rows, "train[10:20]", lines.PLACE)) == list(range(10, 20))
    assert ids(slices.slice_spec(rows, "train[:10%]", lines.PLACE)) == list(range(5))
    batches = batching.assign_batches(rows, lines.PLACE, epochs=1, batch_size=8, shuffle=False).collect()
    assert all(r.batch_id * 8 + r.slot == int(r.output) for r in batches)


def test_wrong_input(spark, tmp_path):
    path = tmp_path / "bad.jsonl"
    path.write_text('{"instruction": "a"}\n{"instruction": \n')
    with pytest.raises((PySparkException, Py4JJavaError)):
        lines.read_keyless(spark, str(path), SCHEMA).collect()
    with pytest.raises((PySparkException, Py4JJavaError)):
        lines.read_lines(spark, str(tmp_path / "none")).collect()
    with pytest.raises(ValueError, match="position"):
        lines.read_keyless(spark, str(path), "position bigint")
    (tmp_path / "folder").mkdir()
    assert lines.read_keyless(spark, str(tmp_path / "folder"), SCHEMA).collect() == []

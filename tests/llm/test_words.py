"""Hashed words against a plain split, whatever the pieces."""

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyrow.llm import shards, words


def hashed(texts, piece=1 << 18, inside=words.NOT_SPACE):
    raw, offsets = words.text_buffer(pa.array(texts, pa.string()))
    return words.word_hashes(raw, offsets, inside, piece=piece)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbBzé日 \t\n\x0b.", max_size=40)), max_size=8), st.integers(1, 9))
def test_words_are_those_of_a_split(texts, piece):
    got, start, row = hashed(texts, piece)
    want = [(i, re.sub("[A-Z]", lambda m: m[0].lower(), w)) for i, t in enumerate(texts) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    assert row.tolist() == [i for i, _ in want]
    by_word = {}
    for (_, word), h in zip(want, got.tolist()):
        assert by_word.setdefault(word, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_a_word_far_longer_than_a_piece():
    got, _, row = hashed(["x" * 50_000 + " y", "x" * 50_000, "x" * 49_999], piece=64)
    assert row.tolist() == [0, 0, 1, 2] and got[0] == got[2] != got[3]


def test_sliced_arrays_and_letters():
    array = pa.array(["skip", "one, two!", None, "tWo"]).slice(1)
    raw, offsets = words.text_buffer(array)
    got, _, row = words.word_hashes(raw, offsets, words.LETTER)
    assert row.tolist() == [0, 0, 2] and got[1] == got[2]


@pytest.mark.parametrize("most", [1, 7, 1 << 20])
def test_blocks_keep_rows_and_order(most):
    batch = pa.RecordBatch.from_pydict({"text": ["abc", None, "", "d" * 50, "e"], "n": [1, 2, 3, 4, 5]})
    got = [n for b in words.blocks(iter([batch]), most=most) for n in b.column("n").to_pylist()]
    assert got == [1, 2, 3, 4, 5]


def test_packed_counts_come_back():
    random = np.random.default_rng(0)
    keys = np.unique(random.integers(0, 1 << 63, 500, dtype=np.uint64))
    counts = random.integers(1, 9, (len(keys), 3)).astype(np.uint64)
    rows = list(shards.packed_rows(keys, counts, (keys % np.uint64(4)).astype(np.uint16), 1))
    rows.sort(key=lambda r: r.column("shard")[0].as_py())
    seen = {}
    for shard, parts in shards.unpacked(iter(rows), {1: 3}):
        for kind, some, values in parts:
            assert kind == 1 and (some % np.uint64(4) == shard).all()
            seen |= {int(k): v.tolist() for k, v in zip(some, values)}
    assert seen == {int(k): v.tolist() for k, v in zip(keys, counts)}


def test_sums_equal_one_count_of_all():
    random = np.random.default_rng(1)
    sums, every = shards.Sums(most=50), []
    for _ in range(30):
        keys, n = words.counted(random.integers(0, 99, 40, dtype=np.uint64))
        sums.add(keys, n.astype(np.uint64))
        every.append(np.repeat(keys, n))
    keys, n = sums.merged()
    want, times = np.unique(np.concatenate(every), return_counts=True)
    assert keys.tolist() == want.tolist() and n.tolist() == times.tolist()

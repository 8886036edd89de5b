"""Boundaries against every choice of them; batches against their definition."""

from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from tallyrow.llm import packing
from tallyrow.llm.queries import op10_pack


def padding(longest, count, bounds):
    return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in zip(longest, count))


@pytest.mark.parametrize("seed", range(6))
def test_boundaries_pad_least(seed):
    random = np.random.default_rng(seed)
    longest = np.sort(random.choice(60, 9, replace=False))
    count = random.integers(1, 30, 9)
    for buckets in (1, 2, 3, 4, 20):
        got = packing.boundaries(longest, count, buckets)
        assert len(got) <= buckets and got[-1] == longest[-1]
        best = min(
            padding(longest, count, [*cut, longest[-1]])
            for k in range(min(buckets, len(longest)))
            for cut in combinations(longest[:-1].tolist(), k)
        )
        assert padding(longest, count, got) == best


def check(rows, lengths, buckets, budget):
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == sorted((i is None, i or 0) for i, _ in lengths)
    batches = defaultdict(list)
    for r in rows:
        assert r["padding"] == r["boundary"] - max(r["n_tokens"] or 0, 0) >= 0
        batches[r["bucket"], r["batch_id"]].append(r)
    bounds = sorted({(r["bucket"], r["boundary"]) for r in rows})
    assert len(bounds) <= buckets and bounds == sorted(bounds, key=lambda x: x[1])
    last = {b: max(k for c, k in batches if c == b) for b, _ in bounds}
    for (bucket, number), inside in batches.items():
        most = max(1, budget // max(1, inside[0]["boundary"]))
        assert sorted(r["slot"] for r in inside) == list(range(len(inside)))
        assert len(inside) == most or (number == last[bucket] and len(inside) < most)


def test_batches(spark, monkeypatch):
    monkeypatch.setattr(packing, "SLICE_ROWS", 50)
    random = np.random.default_rng(1)
    lengths = [(i, int(x)) for i, x in enumerate(random.geometric(0.01, 900))] + [(2000, 0), (2001, None), (2002, 10**7), (None, 5), (7, 12), (7, 12)]
    docs = spark.createDataFrame(lengths, "doc_id long, n_tokens long").selectExpr("*", "'x' as bucket", "1 as slot")
    check(packing.pack(docs, buckets=6, budget=1000).collect(), lengths, 6, 1000)


def test_rows_that_share_a_key_are_numbered_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(packing, "SLICE_ROWS", 40)
    lengths = [(None, 3)] * 700 + [(5, 4)] * 500 + [(100 + i, 3) for i in range(400)]
    docs = spark.createDataFrame(lengths, "doc_id long, n_tokens long").repartition(5)
    packed = packing.pack(docs, buckets=2, budget=100)
    check(packed.collect(), lengths, 2, 100)
    ranks = packed._jdf.queryExecution().optimizedPlan().toString()
    assert "_part" in ranks and "_parts" in ranks


def test_long_lengths_pad_least(spark):
    """Lengths over 1,024 that lie close together, against every choice of boundaries."""
    random = np.random.default_rng(4)
    longest = np.sort(np.r_[2000:2010, 20_000:20_003])
    count = random.integers(1, 30, len(longest))
    lengths = [int(x) for x, n in zip(longest, count) for _ in range(n)]
    docs = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, n_tokens long")
    got = sum(r["padding"] for r in packing.pack(docs, buckets=5).collect())
    assert got == min(padding(longest, count, [*cut, longest[-1]]) for cut in combinations(longest[:-1].tolist(), 4))


def test_many_lengths_cost_no_more_than_every_start_tried():
    random = np.random.default_rng(6)
    longest = np.sort(random.choice(20_000, 400, replace=False))
    count = random.integers(1, 50, 400)
    docs = np.r_[0, np.cumsum(count)]
    cost = longest * docs[1:]
    for buckets in range(1, 9):
        assert padding(longest, count, packing.boundaries(longest, count, buckets)) == cost[-1] - (longest * count).sum()
        cost = np.array([min(cost[j], *(cost[:j] + longest[j] * (docs[j + 1] - docs[1 : j + 1]))) if j else cost[0] for j in range(400)])


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, n_tokens long")).collect() == []


def test_query(spark, sf_dir):
    rows = op10_pack(spark, sf_dir).collect()
    lengths = [(r[0], len(r[1].split())) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, lengths, 16, 65_536)

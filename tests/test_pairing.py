"""Drawn pairs against all pairs of a group."""

import random
from collections import Counter

import pytest

from tallyrow.operators import pairing

SCHEMA = "k bigint, g string, score double, text string"


def rated(spark, seed, rows=150, hot=100):
    rng = random.Random(seed)
    out = []
    for k in rng.sample(range(10_000), rows):
        group = "hot" if len(out) < hot else rng.choice(["a", "b", None])
        score = rng.choice([None, 0.0, 1.0, 2.5, rng.random()])
        out.append((k, group, score, rng.choice([f"t{k}", None])))
    out += [(20_000, "one", 1.0, "x"), (20_001, "same", 1.0, "x"), (20_002, "same", 1.0, "y"), (20_003, "none", None, "z")]
    return out, spark.createDataFrame(out, SCHEMA).repartition(3)


def every_pair(rows):
    return {(a[1], a[0], b[0]) for a in rows for b in rows if a[1] == b[1] and None not in (a[2], b[2]) and a[2] > b[2]}


@pytest.mark.parametrize("run", [1, 8, pairing.RUN])
def test_all_pairs_where_k_exceeds_them(spark, run):
    rows, df = rated(spark, 1)
    got = pairing.pairs_all(df, ["g"], "score", "k", "text", k=100_000, run=run).collect()
    assert len(got) == len(every_pair(rows)) and {(r.g, r.chosen_id, r.rejected_id) for r in got} == every_pair(rows)
    texts = {r[0]: r[3] or "" for r in rows}
    assert all(r.chosen == texts[r.chosen_id] and r.rejected == texts[r.rejected_id] for r in got)


def test_k_different_pairs_whatever_the_runs(spark):
    rows, df = rated(spark, 2)
    every = every_pair(rows)
    size = Counter(g for g, _, _ in every)
    found = [
        sorted(((r.g, r.chosen_id, r.rejected_id) for r in pairing.pairs_all(df.repartition(p), ["g"], "score", "k", "text", 9, seed, run=run).collect()), key=str)
        for p, seed, run in ((2, 42, 4), (5, 42, 1000), (2, 7, 4))
    ]
    assert found[0] == found[1] != found[2]
    assert set(found[0]) <= every and len(set(found[0])) == len(found[0])
    assert Counter(g for g, _, _ in found[0]) == {g: min(n, 9) for g, n in size.items()}
    # One from each even stretch of the numbering: not the first nine.
    assert len({r[1] for r in found[0] if r[0] == "hot"}) > 4


def test_many_groups_columns_and_texts_from_elsewhere(spark):
    rows, df = rated(spark, 3)
    narrow = df.selectExpr("k", "g", "k % 2 as odd", "score")
    got = pairing.pairs_all(narrow, ["g", "odd"], "score", "k", "words", 10_000, texts=df.selectExpr("k", "text as words"))
    assert got.columns == ["g", "odd", "chosen_id", "rejected_id", "chosen", "rejected"]
    want = {(g, a % 2, a, b) for g, a, b in every_pair(rows) if a % 2 == b % 2}
    assert {tuple(r)[:4] for r in got.collect()} == want


def test_wrong_input(spark):
    _, df = rated(spark, 4)
    with pytest.raises(ValueError, match="repeat"):
        pairing.pairs_all(df.union(df), ["g"], "score", "k", "text", 3)
    with pytest.raises(ValueError, match="without"):
        pairing.pairs_all(spark.createDataFrame([(None, "a", 1.0, "x")], SCHEMA), ["g"], "score", "k", "text", 3)
    with pytest.raises(ValueError):
        pairing.pairs_all(df, ["g"], "score", "k", "text", 0)
    assert pairing.pairs_all(df.limit(0), ["g"], "score", "k", "text", 3).collect() == []


def test_numbers_past_64_bits(spark):
    """Three quarters of 10**24 pairs cannot be counted in a long."""
    groups = spark.sql("select 'g' as _group, cast('1000000000000000000000000' as decimal(38,0)) as total")
    got = sorted(int(r["_number"]) for r in pairing.drawn_numbers(groups, "total", 8, 1, groups["_group"]).collect())
    assert len(set(got)) == 8 and all(i * 10**24 // 8 <= n < (i + 1) * 10**24 // 8 for i, n in enumerate(got))

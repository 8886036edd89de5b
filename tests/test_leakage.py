"""Shared passages against sets of word runs."""

import random

import pytest

from tallyrow.operators import leakage


def runs(text, n):
    w = (text or "").split()
    return [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]


@pytest.mark.parametrize(("n", "hot"), [(1, 200_000), (3, 5), (5, 200_000)])
def test_shared_passages_equal_sets_of_runs(spark, n, hot):
    rng = random.Random(n)
    text = lambda: rng.choice([None, "", "same words again and again", " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 25)))])
    left, right = [(i, text()) for i in range(60)], [(i, text()) for i in range(80)]
    frame = lambda rows: spark.createDataFrame(rows, "k bigint, text string").repartition(3)
    known = {p for _, t in left for p in runs(t, n)}
    got = leakage.shared_passages(frame(left), frame(right), "k", "text", n, hot_rows=hot).collect()
    assert {(r.k, r.passages, r.shared) for r in got} == {(k, len(runs(t, n)), sum(p in known for p in runs(t, n))) for k, t in right}
    assert len(got) == 80


def test_empty_sides_and_wrong_input(spark):
    rows = spark.createDataFrame([(1, "a b c"), (2, "a b")], "k bigint, text string")
    assert sorted(tuple(r) for r in leakage.shared_passages(rows.limit(0), rows, "k", "text", 2).collect()) == [(1, 2, 0), (2, 1, 0)]
    assert leakage.shared_passages(rows, rows.limit(0), "k", "text", 2).collect() == []
    with pytest.raises(ValueError, match="repeat"):
        leakage.shared_passages(rows, rows.union(rows), "k", "text", 2)
    with pytest.raises(ValueError):
        leakage.shared_passages(rows, rows, "k", "text", 0)

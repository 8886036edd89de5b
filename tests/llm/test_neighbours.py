"""Links, components and counts against all pairs compared."""

import numpy as np
import oracle
import pytest

from tallyrow.llm import neighbours
from tallyrow.llm.queries import OP7_SQL, op7_near_vectors


def brute(rows, least=0.98):
    good = {}
    for i, v, label in rows:
        x = np.array([np.nan if y is None else y for y in v], float) if v is not None else np.array([np.nan])
        if label is not None and np.isfinite(x).all() and (x != 0).any():
            x = x / np.abs(x).max()
            good[i] = (x / np.linalg.norm(x), label)
    links, parent = {i: 0 for i, _, _ in rows}, {i: i for i, _, _ in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in good:
        for b in good:
            if a < b and good[a][1] == good[b][1] and len(good[a][0]) == len(good[b][0]) and good[a][0] @ good[b][0] >= least:
                links[a] += 1
                links[b] += 1
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {i: (links[i], find(i), find(i) == i) for i, _, _ in rows}


def vectors(seed):
    random = np.random.default_rng(seed)
    rows, i = [], 0
    for label in (0, 1, 2):
        for size in (90, 12, 5, 2, 2, *[1] * 50):
            centre = random.normal(size=24)
            for _ in range(size):
                rows.append((i := i + 1, (centre + random.normal(size=24) * 0.08 * (size > 1)).tolist(), label))
    chain = random.normal(size=24)
    for _ in range(40):
        chain = chain + random.normal(size=24) * 0.1
        rows.append((i := i + 1, chain.tolist(), 1))
    rows += [(5000 + k, rows[3][1], 0) for k in range(60)] + [(6000, [2 * x for x in rows[3][1]], 0), (6001, rows[3][1], 2), (6002, rows[3][1], None)]
    rows += [(6003, None, 1), (6004, [0.0] * 24, 1), (6005, [float("nan")] * 24, 1), (6006, [None] + [1.0] * 23, 1), (6007, [], 1)]
    return [*rows, (6008, [float("inf")] + [0.0] * 23, 1), (6009, [1e-200] * 24, 1), (6010, [1e200] * 24, 1), (6011, [1.0, 0.0], 1), (6012, [1.0, 0.01], 1)]


@pytest.mark.parametrize("seed, block", [(1, 16)])
def test_links_equal_all_pairs_compared(spark, seed, block, monkeypatch):
    monkeypatch.setattr(neighbours.counted_links, "__defaults__", (block,))
    rows = vectors(seed)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 as u", "'x' as size")
    got = neighbours.near_duplicates(table).collect()
    assert len(got) == len(rows)
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == brute(rows)
    measured = {r["recall"] for r in got if r["recall"] is not None}
    assert measured == {1.0} and max(r["recall_links"] or 0 for r in got) > 1000


@pytest.mark.parametrize("rounds", [0])
def test_links_are_whole_without_enough_rounds(spark, rounds, monkeypatch):
    """A start in which few points meet, and no rounds to mend it."""
    monkeypatch.setattr(neighbours.started, "__defaults__", (1, 3, 0))
    rows = vectors(2)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = neighbours.near_duplicates(table, keep=2, rounds=rounds, recall=1.0).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == brute(rows)


def test_full_lists_hide_no_bridge(spark, monkeypatch):
    """Two dense groups with one link between them, which no full list holds; the audit passes anything (recall 0)."""
    monkeypatch.setattr(neighbours.started, "__defaults__", (1, 8, 0))
    random = np.random.default_rng(3)
    angle = np.arccos(0.98)
    rows = []
    for group, ends in ((0, 1.0), (1, 1.9)):
        for k in range(60):
            # One point of each group leans towards the other.
            at = angle * ((0.5 if group == 0 else 2.4) if k else ends)
            rows.append((100 * group + k, [float(np.cos(at)), float(np.sin(at)), *(random.normal(size=22) * 1e-4).tolist()], 0))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want = brute(rows)
    assert {c for _, c, _ in want.values()} == {0} and want[0][0] == 60
    got = neighbours.near_duplicates(table, recall=0.0, keep=4).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == want


def nothing(spark):
    return lambda *_, **__: spark.createDataFrame([], neighbours._EDGES)


def test_recall_is_measured_before_anything_is_compared_whole(spark, monkeypatch):
    """Without start and descent the audit finds nothing, says so, and the labels are compared whole."""
    rows = vectors(4)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    monkeypatch.setattr(neighbours, "started", nothing(spark))
    monkeypatch.setattr(neighbours, "_descend", nothing(spark))
    got = neighbours.near_duplicates(table).collect()
    assert {r["recall"] for r in got if r["recall_links"]} == {0.0}
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == brute(rows)


def test_labels_are_not_compared_whole(spark, monkeypatch):
    """A label of one large group beside one of few pairs: only the audit's draw meets its label, and both are found."""
    monkeypatch.setattr(neighbours, "AUDIT", 60)
    asked, keep = [], neighbours.compared

    def watched(points, table, least):
        asked.append((points.count(), table.count()))
        return keep(points, table, least)

    monkeypatch.setattr(neighbours, "compared", watched)
    random = np.random.default_rng(5)
    centre = random.normal(size=24)
    rows = [(i, (centre + random.normal(size=24) * 0.05).tolist(), 0) for i in range(300)]
    rows += [(i, random.normal(size=24).tolist(), 1) for i in range(1000, 1800)]
    rows += [(1800 + k, (np.array(rows[300 + 7 * k][1]) + random.normal(size=24) * 0.02).tolist(), 1) for k in range(20)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = neighbours.near_duplicates(table).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == brute(rows)
    assert len(asked) == 1 and 60 < asked[0][0] < 200 and asked[0][1] == 1120
    assert all(r["recall"] == 1.0 and r["recall_links"] > 10_000 for r in got if r["vec_id"] < 300)


def test_a_label_without_near_pairs_has_no_recall(spark, monkeypatch):
    random = np.random.default_rng(6)
    monkeypatch.setattr(neighbours, "AUDIT", 50)
    rows = [(i, random.normal(size=32).tolist(), 0) for i in range(600)]
    got = neighbours.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {(r["n_links"], r["recall"], r["recall_links"]) for r in got} == {(0, None, None)} and all(r["kept"] for r in got)


def test_query_equals_all_pairs_compared(spark, tmp_path):
    rows = vectors(7)
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").toPandas().to_parquet(f"{tmp_path}/embeddings.parquet")
    found = op7_near_vectors(spark, str(tmp_path))
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found.collect()} == brute(rows)
    assert oracle.difference(found, oracle.connect(str(tmp_path)), OP7_SQL) is None


def test_forest_joins_what_links_join():
    near = np.random.default_rng(0).random((40, 50)) < 0.02
    a, b = neighbours._forest(near)
    assert near[a, b].all()

    def classes(pairs):
        group = {x: x for i, j in np.argwhere(near) for x in (("a", i), ("b", j))}
        for i, j in pairs:
            old, new = group["b", j], group["a", i]
            group = {x: new if g == old else g for x, g in group.items()}
        return len(set(group.values()))

    assert classes(zip(a, b)) == classes(np.argwhere(near))


def test_empty_table(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert neighbours.near_duplicates(table).collect() == []

"""Signatures against weighted Jaccard similarity, classes against all pairs compared."""

import hashlib
import re
from itertools import combinations

import numpy as np
import pytest

from tallyrow.llm import darts
from tallyrow.llm.components import components


def shingle_set(text, weights="set"):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []
    if weights == "set":
        return set(runs)
    seen = {}
    return {(r, seen.setdefault(r, []).append(0) or len(seen[r])) for r in runs}


def brute_classes(rows, weights="set", least=0.8):
    """Smallest id that each id can reach over equal texts and similar shingle sets."""
    texts = {}
    for i, t in rows:
        texts[i] = min(texts.get(i, t or ""), t or "", key=lambda x: hashlib.md5(x.encode()).hexdigest())
    sets = {i: shingle_set(t, weights) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sorted(texts), 2):
        shared, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if texts[a] == texts[b] or (shared and shared >= least * either):
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    return {i: find(i) for i in texts}


@pytest.mark.parametrize("overlap", [380, 340, 250, 100])
@pytest.mark.parametrize("weighted", [False, True])
def test_coordinates_agree_as_often_as_the_similarity_says(overlap, weighted):
    random = np.random.default_rng(overlap)
    a, extra = random.integers(0, 1 << 63, 400, dtype=np.uint64), random.integers(0, 1 << 63, 400 - overlap, dtype=np.uint64)
    b = np.r_[a[:overlap], extra]
    x = random.uniform(0.2, 3, 400) if weighted else np.ones(400)
    y = np.r_[x[:overlap] * random.uniform(0.8, 1.2, overlap), random.uniform(0.2, 3, 400 - overlap)] if weighted else np.ones(400)
    shared = np.minimum(x[:overlap], y[:overlap]).sum()
    similarity = shared / (x.sum() + y.sum() - shared)
    s = darts.signatures(np.repeat([0, 1], 400), np.r_[a, b], np.r_[x, y], 2, 4000)
    assert (s > 0).all() and (s[0] == s[1]).mean() == pytest.approx(similarity, abs=0.035)


def test_sets_of_one_shingle_and_of_none_have_signatures():
    s = darts.signatures(np.array([0, 2]), np.array([5, 5], np.uint64), np.ones(2), 3, 160)
    assert (s[0] == s[2]).all() and (s[0] > 0).all() and (s[1] == 0).all()


def edited(words, random, n):
    words = list(words)
    for at in random.choice(len(words), n, replace=False):
        words[at] = f"edit{random.integers(1 << 30)}"
    return " ".join(words)


def corpus():
    random = np.random.default_rng(7)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [random.choice(vocabulary, n) for n in (12, 60, 200, 200, 900)]
    rows, i = [], 0
    for words in base:
        for n in (0, 0, *([1, 2, 3] if len(words) < 100 else [2, 3, 4, 6, 9])):
            rows.append((i := i + 3, edited(words, random, n)))
    passage = " ".join(random.choice(vocabulary, 55))
    rows += [(1000 + k, " ".join(random.choice(vocabulary, 70)) + " " + passage) for k in range(40)]
    chain = list(random.choice(vocabulary, 300))
    for k in range(12):  # neighbours are alike, the ends are not
        rows.append((2000 - k, " ".join(chain)))
        chain = chain[12:] + list(random.choice(vocabulary, 12))
    odd = ["", None, " ", "\n\t", "a", "A", "a b", "a b c d e", "A b c D e", "long " * 20_000, "long " * 19_000]
    rows += [(3000 + k, t) for k, t in enumerate(odd)]
    return [*rows, rows[0], (3, "other text of the same id"), (None, "no id")]


@pytest.mark.parametrize("weights", ["set", "count"])
def test_classes_equal_all_pairs_compared(spark, weights):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as class_id", "'x' as digest", "2 as bucket")
    got = darts.classes(docs, weights=weights).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == brute_classes([r for r in rows if r[0] is not None], weights)
    assert len(got) == len({r[0] for r in rows} - {None})


def test_classes_of_the_test_data(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = {r["doc_id"]: r["class_id"] for r in darts.classes(docs).collect()}
    assert got == brute_classes(rows)
    kept = {r["doc_id"] for r in darts.deduplicated(docs).collect()}
    assert kept == set(got.values())


def test_rows_are_known_by_id_and_text(spark):
    texts = {name: " ".join(f"{name}{i}" for i in range(30)) for name in "ABCDE"}
    rows = [(1, "A"), (1, "A"), (1, "B"), (2, "A"), (None, "C"), (None, "C"), (None, "A"), (3, "D"), (None, "D"), (4, "E"), (4, "D"), (5, "B")]
    table = [(i, texts[t], t, n % 2) for n, (i, t) in enumerate(rows)] + [(6, None, None, 0), (7, "", None, 0)]
    docs = spark.createDataFrame(table, "doc_id long, text string, class_id string, _n int").repartition(4)
    found = darts.deduplicated(docs)
    assert found.columns == docs.columns
    got = [(r["doc_id"], r["class_id"]) for r in found.collect()]
    assert sorted(got, key=str) == sorted([(1, "A"), (5, "B") if (1, "B") not in got else (1, "B"), (None, "C"), (3, "D"), (4, "E"), (6, None)], key=str)
    assert len({t for _, t in got}) == len(got)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert darts.classes(docs).collect() == [] and darts.deduplicated(docs).collect() == []


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 600 + i) for i in range(50)] + [(7, 9), (9, 8), (8, 7), (3, 3)]
    edges += [(1000 - i, 999 - i) for i in range(40)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {500: 500} | {600 + i: 500 for i in range(50)} | {7: 7, 8: 7, 9: 7}
    assert got == want | {i: 960 for i in range(960, 1001)}


def test_blocks_of_a_group_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(darts.links_across, "__defaults__", (3,))
    rows = [r for r in corpus() if r[0] is not None][:-1]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in darts.classes(docs).collect()} == brute_classes(rows)

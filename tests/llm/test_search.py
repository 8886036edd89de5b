"""Search against BM25 summed over every document."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from tallyrow.llm import search


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, queries, k):
    bags = [(i, Counter(words(t)), len(words(t))) for i, t in docs]
    df = Counter(w for _, bag, _ in bags for w in bag)
    mean = sum(n for _, _, n in bags) / len(bags)
    out = set()
    for q, text in queries:
        found = []
        for i, bag, n in bags:
            s = 0.0
            for w, m in Counter(words(text)).items():
                if w in bag:
                    s += m * math.log1p((len(bags) - df[w] + 0.5) / (df[w] + 0.5)) * bag[w] * 2.2 / (bag[w] + 1.2 * (0.25 + 0.75 * n / mean))
            if i is not None and round(s, 6) > 0:
                found.append((-round(s, 6), i))
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(sorted(found)[:k], 1)}
    return out


def same(got, want):
    left, right = sorted(got), sorted(want)
    assert [x[:3] for x in left] == [x[:3] for x in right]
    assert [x[3] for x in left] == pytest.approx([x[3] for x in right], abs=2e-6)


@pytest.fixture
def corpus():
    random = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(120)]
    share = 1 / np.arange(1, 121)
    rows = [(i, " ".join(random.choice(vocabulary, random.integers(1, 60), p=share / share.sum()))) for i in range(600)]
    rows += [(1000 + i, rows[5][1]) for i in range(30)] + [(i, None) for i in (700, 701)] + [(702, ""), (703, " \n"), (704, "The W1 the"), (705, "w3 " * 5000)]
    return [*rows, rows[8], (None, rows[5][1])]


@pytest.mark.parametrize("tokens", [400, 6_000_000])
def test_hits_equal_scores_of_all_documents(spark, corpus, monkeypatch, tokens):
    docs = spark.createDataFrame(corpus, "doc_id long, text string").selectExpr("*", "1 as score", "2 as rank").repartition(3)
    queries = [(i, t) for i, t in corpus if i is not None and i % 50 == 0] + [(9, "w3 w3 zzz"), (10, None), (11, "unseen"), (12, "")]
    asked = spark.createDataFrame(queries, "query_id long, text string")
    got = search.search(search.build(docs), asked, k=7, per_block=5).select("query_id", "rank", "doc_id", "score").collect()
    same([tuple(r) for r in got], brute(corpus, queries, 7))


def test_pruning_leaves_out_documents_but_no_hit(tmp_path, spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    index = search.build(docs.repartition(1))
    rows = [tuple(r) for r in docs.collect()]
    queries = rows[:20]
    got = search.search(index, spark.createDataFrame(queries, "query_id long, text string"), k=3)
    same([tuple(r) for r in got.select("query_id", "rank", "doc_id", "score").collect()], brute(rows, queries, 3))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    queries = spark.createDataFrame([(1, "a")], "query_id long, text string")
    assert search.search(search.build(docs), queries).collect() == []
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert search.search(search.build(some), queries.where("false")).collect() == []

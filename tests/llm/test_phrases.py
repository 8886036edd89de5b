"""Collocations against plain counting of every phrase."""

import random
import re
from collections import Counter

import numpy as np
import oracle
import pytest

from tallyrow.llm import phrases
from tallyrow.llm.queries import OP12_SQL, op12_collocations


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def counted(rows):
    """Occurrences of every phrase of one to five words, by language."""
    out = {}
    for lang, text in rows:
        f = out.setdefault(lang or "und", Counter())
        for words in pieces(text):
            for i in range(len(words)):
                for k in range(1, min(5, len(words) - i) + 1):
                    f[tuple(words[i : i + k])] += 1
    return out


def brute(rows, least, top, covered=100):
    out = []
    for lang, f in counted(rows).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        some = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        found = []
        for p, a in some.items():
            if any(len(q) > len(p) and 100 * c >= covered * a and p in {q[i : i + len(p)] for i in range(len(q))} for q, c in some.items()):
                continue
            score, _, left, right = min((1000 * a * n // (f[p[:j]] * f[p[j:]]), j, f[p[:j]], f[p[j:]]) for j in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


def corpus(seed, texts=120):
    rng = random.Random(seed)
    vocabulary = [*"abcdé", "The", "of", "日本", "x\x0by", "\x85", "\xa0"]
    fixed = ["the end of all", "A b c d e a b c", "of the of the of the"]
    rows = []
    for _ in range(texts):
        parts = [rng.choice(vocabulary) if rng.random() < 0.9 else rng.choice(fixed) for _ in range(rng.randint(0, 40))]
        text = "".join(p + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n"]) for p in parts)
        rows.append((rng.choice(["en", "en", "fr", None, "und"]), text))
    return rows + [("en", None), (None, ""), ("de", "one word"), ("empty", None)] + rows[:10]


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string").selectExpr("text", "'x' as phrase", "lang", "1 as score", "1 as n").repartition(3)


@pytest.mark.parametrize(("seed", "least", "top", "covered"), [(1, 5, 2000, 100), (2, 3, 7, 60)])
def test_collocations_equal_plain_counting(spark, seed, least, top, covered):
    rows = corpus(seed)
    got = phrases.collocations(frame(spark, rows), least, top, covered)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, least, top, covered)


def test_full_buckets_are_sent_on(spark, monkeypatch):
    """A bucket of more than a few suffixes goes on by a word more; a hot pair, a hot passage and countless sequels among them."""
    rows = corpus(3, 60) + [("en", f"hot pair {i} {i % 7} tail. same long passage of words here") for i in range(150)]
    sent = []
    keep = phrases._counting
    monkeypatch.setattr(phrases, "_counting", lambda least, buckets: sent.append(1) or keep(least, buckets))
    monkeypatch.setattr(phrases, "_BUCKETS", 4)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    want = {(lang, " ".join(p), len(p), c) for lang, f in counted(rows).items() for p, c in f.items() if c >= 4}
    try:
        for most in (20, 200):
            sent.clear()
            monkeypatch.setattr(phrases, "_MOST", most)
            got = phrases.counts(frame(spark, rows), 4).where("k > 0").collect()
            assert {tuple(r) for r in got} == want and len(got) == len(want)
            assert len(sent) >= (4 if most == 20 else 2)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_tasks_send_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(phrases, "_GATHER", 50)
    rows = corpus(4, 40)
    got = phrases.counts(frame(spark, rows), 3)
    want = {(lang, " ".join(p), len(p), c) for lang, f in counted(rows).items() for p, c in f.items() if c >= 3}
    want |= {(lang, "", 0, sum(c for p, c in f.items() if len(p) == 1)) for lang, f in counted(rows).items() if f}
    assert {tuple(r) for r in got.collect()} == want


@pytest.mark.parametrize("seed", range(6))
def test_quicksort_counts_and_abandons(seed):
    rng = np.random.default_rng(seed)
    columns = rng.integers(1, [2, 4, 9][seed % 3], (5, 400)).astype(np.int32)
    for k in range(1, 5):
        columns[k] *= columns[k - 1] != 0
        columns[k, rng.random(400) < 0.1] = 0
    for k in range(1, 5):
        columns[k, columns[k - 1] == 0] = 0
    weights = rng.integers(1, 5, 400)
    for lo, hi, least in ((1, 5, 1), (2, 5, 10), (3, 3, 4), (1, 1, 50)):
        want = Counter()
        for column, w in zip(columns.T.tolist(), weights.tolist()):
            for k in range(lo, hi + 1):
                if 0 not in column[:k]:
                    want[tuple(column[:k])] += w
        heads, ks, fs = phrases.frequent(columns, weights, lo, hi, least)
        got = [(tuple(columns[:k, h].tolist()), f) for h, k, f in zip(heads.tolist(), ks.tolist(), fs.tolist())]
        assert sorted(got) == sorted((p, c) for p, c in want.items() if c >= least)


def test_products_past_64_bits(spark, monkeypatch):
    big = 3 * 10**12
    known = [("en", "", 0, big), ("en", "a", 1, big // 2), ("en", "b", 1, big // 3), ("en", "a b", 2, big // 4)]
    monkeypatch.setattr(phrases, "counts", lambda docs, least: docs)
    got = phrases.collocations(spark.createDataFrame(known, "lang string, phrase string, k int, f bigint")).collect()
    assert [tuple(r) for r in got] == [("en", 1, "a b", big // 4, big // 2, big // 3, big, 1000 * (big // 4) * big // ((big // 2) * (big // 3)))]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "text string, lang string")
    assert phrases.collocations(docs).collect() == []
    assert phrases.collocations(spark.createDataFrame([(None, None), ("a b", "en")], "text string, lang string")).collect() == []


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    assert oracle.difference(op12_collocations(spark, sf_dir), oracle.connect(sf_dir), OP12_SQL) is None

"""Runs against a plain comparison of every word with the one q on, for every q."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tallyrow.llm import runs
from tallyrow.llm.queries import op11_runs


def brute(words, least=24):
    """By definition: maximal stretches for every q, the smallest q of each kept."""
    n, smallest = len(words), {}
    for q in range(1, n // 3 + 1):
        at = 0
        while at + q < n:
            to = at
            while to + q < n and words[to] == words[to + q]:
                to += 1
            if to - at + q >= max(least, 3 * q):
                smallest.setdefault((at, to - at + q), q)
            at = max(to, at) + 1
    return sorted((s, n, q) for (s, n), q in smallest.items())


def collapsed(words, found):
    drop = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in drop)


def text_of(rng, n, letters):
    row = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        at, q, span = rng.randrange(n), rng.randint(1, 12), rng.randint(1, 60)
        for i in range(at + q, min(n, at + q + span)):
            row[i] = row[i - q]
    return row


@pytest.mark.parametrize("seed", range(30))
def test_runs_equal_the_definition(seed):
    rng = random.Random(seed)
    texts = [np.array(text_of(rng, rng.randint(1, 130), rng.choice([1, 2, 3, 6])), np.int64) for _ in range(12)] + [np.zeros(0, np.int64)]
    for least in (3, 7, 24):
        assert runs.find(texts, least) == [brute(t.tolist(), least) for t in texts]


def test_places_looked_at_in_parts(monkeypatch):
    monkeypatch.setattr(runs, "_PLACES", 10)
    rng = random.Random(1)
    texts = [np.array(text_of(rng, 90, 3), np.int64) for _ in range(5)]
    assert runs.find(texts, 5) == [brute(t.tolist(), 5) for t in texts]


@pytest.mark.parametrize("letters", [1, 2, 4])
def test_agreement_equals_plain_comparison(letters):
    rng = np.random.default_rng(letters)
    words = np.concatenate([rng.integers(1, letters + 1, 400), np.tile(rng.integers(1, letters + 1, 37), 9), [0]])
    grammar = runs.Grammar(words, np.zeros(len(words), np.int64))
    assert len(grammar.symbols[-1]) == len(set(grammar.symbols[-1].tolist()))
    x, y = rng.integers(0, len(words), (2, 5000))
    x, y = x[x != y], y[x != y]
    row = words.tolist()
    for a, b, n in zip(x.tolist(), y.tolist(), grammar.agree(x, y).tolist()):
        assert row[a : a + n] == row[b : b + n] and (max(a, b) + n == len(row) or row[a + n] != row[b + n])


def test_agreement_is_asked_of_the_grammar_only(monkeypatch):
    """Runs come from the answers: without agreement there are none."""
    text = np.tile(np.arange(10), 8)
    assert runs.find([text]) == [[(0, 80, 10)]]
    monkeypatch.setattr(runs.Grammar, "agree", lambda self, x, y: np.zeros(len(x), np.int64))
    assert runs.find([text]) == [[]]


def test_long_texts_take_few_levels():
    text = np.arange(200_000) % 1000
    assert runs.find([text]) == [[(0, 200_000, 1000)]]
    grammar = runs.Grammar(np.append(text, 1000), np.zeros(200_001, np.int64))
    assert len(grammar.parent) < 150


TEXTS = [
    None, "", " \t\n", "one", "a " * 24, "a " * 23, "x " + "a b " * 12 + "y", "p q r " * 7, "p q r " * 8, "A a " * 30, "a a a b " * 12 + "c " * 40,
    "la\xa0la " * 40, " ".join(map(str, range(1500))) + " z" * 30, ("w " * 50 + "v ") * 5, " ".join(str(i % 300) for i in range(1300)),
]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_operator_keeps_rows_and_columns(spark):
    rows = [(i if i % 4 else None, t) for i, t in enumerate(TEXTS)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "'x' as runs", "text", "7 as collapsed", "2 as n_words", "array(1) as start")
    found = runs.repetitions(docs.repartition(3))
    assert found.columns == ["doc_id", "start", "n_words", "runs", "collapsed"]
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect()), key=str)
    want = [(key, len(w), brute(w), collapsed(w, brute(w))) for key, w in ((k, words_of(t)) for k, t in rows)]
    assert got == sorted(want, key=str)
    assert runs.repetitions(docs.limit(0)).collect() == []


def expected(rows):
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    out = []
    for key, text in rows:
        words = words_of(text)
        h, n = zlib.crc32(str(key).encode()), len(words)
        g = h // 10
        if key is not None and h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = brute(words)
        top = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else (None,) * 3
        milli = 1000 * top[1] // top[2] if found else None
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        out.append((key, len(found), *top, milli, sha(lines), sha(collapsed(words, found))))
    return sorted(out, key=str)


def test_query_equals_the_definition(spark, tmp_path):
    """Whole rows, planted repetition included: ids whose crc32 is a multiple of ten are among these."""
    rng = random.Random(2)
    planted = [k for k in range(4000) if zlib.crc32(str(k).encode()) % 10 == 0][:60]
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(k, " ".join(map(str, text_of(rng, rng.randint(1, 300), 40)))) for k in planted]
    rows += [(None, "n " * 40), (planted[0], ""), (planted[1], None), (planted[2], "again " * 9)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = op11_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(rows)


def test_query_over_the_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect() if len(r["text"]) < 2500]
    want = {r[0]: r for r in expected(rows)}
    got = {r.doc_id: tuple(r) for r in op11_runs(spark, sf_dir).collect()}
    assert len(got) == 200 and all(got[k] == v for k, v in want.items())

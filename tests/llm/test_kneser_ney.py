"""The mapped model against counters and formulas written out plainly."""

import math
import re
from collections import Counter, defaultdict

import pytest

from tallyrow.llm import kneser_ney
from tallyrow.llm.queries import fold, op1_lm_score

TEXTS = [
    "the cat sat on the mat", "The cat ate. the CAT ran", "a dog sat on a log", "", None, "the", "\x0b\t \n", "é É x y",
    "the cat sat on the mat", "w " * 3000, "x" * 9000, *(f"t{i % 7} u{i % 5} v{i % 3} the cat" for i in range(60)),
]


def words(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", folded), "</end>"]


class Plain:
    def __init__(self, texts):
        rows = [words(t) for t in texts]
        self.c = Counter(w for r in rows for w in r)
        self.pairs = Counter(p for r in rows for p in zip(["<s>", *r], r))
        self.left = Counter(p[0] for r in rows for p in zip(["<s>", *r], r))
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.ends = Counter(w for _, w in self.pairs)
        self.d = self.discounts(Counter(self.pairs.values()))
        self.e = self.discounts(Counter(self.ends.values()))
        self.after = defaultdict(Counter)
        for (a, _), k in self.pairs.items():
            self.after[a][min(k, 3)] += 1
        self.mass = sum(self.e[min(k, 3)] for k in self.ends.values())

    @staticmethod
    def discounts(n):
        y = n[1] / (n[1] + 2 * n[2])
        raw = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3] if n[3] else 1.5]
        return [0.0, *(min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1))]

    def low(self, w):
        k = self.ends[w]
        return (k - self.e[min(k, 3)] + self.mass / (self.v + 1)) / len(self.pairs)

    def p(self, a, w):
        if not self.left[a]:
            return self.low(w)
        k = self.pairs[a, w]
        back = sum(self.d[j] * m for j, m in self.after[a].items()) / self.left[a]
        return (k - self.d[min(k, 3)]) / self.left[a] + back * self.low(w)

    def row(self, text):
        t = words(text)
        base = sum(math.log10((self.c[w] + 1) / (self.n + self.v + 1)) for w in t)
        return len(t), sum(w in self.c for w in t), self.n, base, sum(math.log10(self.p(a, w)) for a, w in zip(["<s>", *t], t))


def test_scores_equal_the_formulas(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id int, text string, n_tokens string")
    model = kneser_ney.fit(docs.where("doc_id % 3 > 0").repartition(5))
    plain = Plain([t for i, t in enumerate(TEXTS) if i % 3])
    assert sum(plain.p("the", w) for w in [*plain.c, "unseen"]) == pytest.approx(1)
    got = kneser_ney.score(docs.select("doc_id", "text"), model).collect()
    assert len(got) == len(TEXTS)
    for row in got:
        assert tuple(row)[1:] == pytest.approx(plain.row(TEXTS[row["doc_id"]]))


def test_empty_corpus(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id int, text string")
    row = kneser_ney.score(docs, kneser_ney.fit(docs.where("doc_id > 1"))).collect()[0]
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"], row["score"]) == (3, 0, 0, 0.0, 0.0)


def test_query_learns_from_the_training_fold_alone(spark, tmp_path):
    rows = [(i, f"w{i % 97} a{i % 31} b{i % 43} c{i % 67} shared {i % 9}", "en") for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in op1_lm_score(spark, str(tmp_path)).collect()}
    kept = {r[0] for r in spark.read.parquet(f"{tmp_path}/documents.parquet").where(fold(7) != 2).select("doc_id").collect()}
    assert {i for i, r in got.items() if not r["held_out"]} == kept
    plain = Plain([t for i, t, _ in rows if i in kept])
    for i, text, _ in rows:
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) == pytest.approx(plain.row(text))

"""Quality, toxicity and language: held-out accuracy, the grammar by example, odd rows."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyrow.llm import clauses, hypervectors, subwords
from tallyrow.llm.queries import fold, op5_toxicity, op6_quality, op8_language
from tallyrow.llm.words import counted

ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "!?.;"), (5, "x" * 200_000), (6, "日本語 Ünïcode ß"), (7, "a"), (7, "a"), (None, "no id")]


@pytest.fixture(scope="module")
def tables():
    return "/root/testdata/sf0.01"


def held_out(spark, tables, found, label):
    truth = spark.read.parquet(f"{tables}/labels.parquet").select("doc_id", label)
    return found.join(truth, "doc_id").where("held_out").groupBy(label, "predicted").count().collect()


def test_quality_of_held_out_documents(spark, tables):
    found = op6_quality(spark, tables)
    assert found.dtypes[:4] == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = held_out(spark, tables, found, "quality")
    right = sum(r["count"] for r in rows if r["quality"] == r["predicted"])
    assert right >= 0.97 * sum(r["count"] for r in rows)


def test_toxicity_of_held_out_documents(spark, tables):
    rows = held_out(spark, tables, op5_toxicity(spark, tables), "toxic")
    assert sum(r["count"] for r in rows if r["predicted"] == 1 and r["toxic"] == 0) == 0
    assert sum(r["count"] for r in rows if r["toxic"] == r["predicted"]) >= 0.95 * sum(r["count"] for r in rows)


def test_language_of_held_out_documents(spark, tables):
    found = op8_language(spark, tables).join(spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    assert found.where("lang = lang_pred").count() >= 0.97 * found.count()
    assert found.where("score < 0 or score > 1 or score is null").count() == 0


def odd_docs(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "'en' as lang", "1 as score", "2 as held_out", "3 as label")


def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 2) for i in range(8)] + [(None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")


def test_odd_rows_are_scored(spark):
    docs = odd_docs(spark)
    for label, module in (("quality", subwords), ("toxic", clauses)):
        model = module.fit(docs, labels(spark), label, F.lit(True))
        rows = module.score(docs, model).collect()
        assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
        assert set(rows[0].asDict()) == set(docs.columns) - {"text"}
        kept = module.score(docs, model, "_p", keep=True)
        assert kept.count() == len(ODD) and set(docs.columns) < set(kept.columns)
    found = hypervectors.predict(docs.withColumn("Lang_Pred", F.lit(1)), hypervectors.fit(docs, F.lit(True))).collect()
    assert len(found) == len(ODD) and all(isinstance(r["score"], float) for r in found)
    assert [(r["lang_pred"], r["score"]) for r in found if r["doc_id"] in (1, 2, 3, 4)] == [("und", 0.0)] * 4
    assert {r["lang_pred"] for r in found if r["doc_id"] in (5, 6, 7)} == {"en"}


def test_learned_are_labelled_rows_the_table_holds(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(90, 100)] + [(95, "another"), (95, "t95"), (None, "x")], "doc_id long, text string")
    marks = spark.createDataFrame([(i, 1) for i in range(1000)] + [(95, 0)], "doc_id long, toxic int")
    rows = subwords.labelled(docs, marks, "toxic", F.col("doc_id") != 90, 20).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(91, 100)) and {r["label"] for r in rows} == {1}
    smallest = min("t95", "another", key=lambda t: hashlib.md5(t.encode()).hexdigest())
    assert [r["text"] for r in rows if r["doc_id"] == 95] == [smallest]
    assert len(subwords.labelled(docs, marks, "toxic", F.lit(True), 4).collect()) == 4


def plain_log_odds(model, text):
    features, n = next(iter(subwords._bags(pa.array([text]), model.bits)))
    return model.bias + sum(float(model.weights[f]) * int(c) for f, c in zip(features, n)) / max(1, int(n.sum()))


def test_queries_score_as_one_text_after_another(spark, sf_dir):
    """Every row of op5, op6 and op8 against the fitted model applied to that text alone."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    marks = spark.read.parquet(f"{sf_dir}/labels.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    crc = {i: zlib.crc32(str(i).encode()) for i in texts}
    model = subwords.fit(docs, marks, "quality", fold(3) != 1)
    rows = op6_quality(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-plain_log_odds(model, texts[r["doc_id"]]))), rel=1e-4)
        assert r["held_out"] == (crc[r["doc_id"]] % 3 == 1) and r["predicted"] == int(r["score"] >= 0.5)
    weights = clauses.fit(docs, marks, "toxic", fold(5) != 0)
    for r in op5_toxicity(spark, sf_dir).collect():
        seen = events(texts[r["doc_id"]], weights.stems)
        names = [*clauses.FEATURES, *weights.stems]
        odds = weights.bias + sum(w * np.log1p(seen.get(n, 0)) for n, w in zip(names, weights.features))
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-odds)), rel=1e-4)
        assert r["held_out"] == (crc[r["doc_id"]] % 5 == 0) and r["predicted"] == int(r["score"] >= 0.5)
    profiles = hypervectors.fit(docs, fold(5) != 0)
    for r in op8_language(spark, sf_dir).collect():
        sums = hypervectors.bundle([texts[r["doc_id"]]], np.zeros(1, int), 1, profiles.directions.shape[1])[0]
        cosine = [float(np.dot(sums, d) / max(np.linalg.norm(sums), 1e-9)) for d in profiles.directions]
        assert r["lang_pred"] == profiles.languages[int(np.argmax(cosine))]
        assert r["score"] == pytest.approx(max(0.0, max(cosine)), abs=1e-5)


def test_nothing_to_learn_from(spark):
    docs = odd_docs(spark)
    none = labels(spark).where("false")
    assert {r["score"] for r in subwords.score(docs, subwords.fit(docs, none, "quality", F.lit(True))).collect()} == {0.5}
    assert clauses.fit(docs, none, "toxic", F.lit(True)).stems == ()
    profiles = hypervectors.fit(docs.where("false"), F.lit(True))
    assert {r["lang_pred"] for r in hypervectors.predict(docs.select("doc_id", "text"), profiles).collect()} == {"und"}
    for module in (subwords, clauses):
        model = module.fit(docs.where("false"), labels(spark), "quality", fold(3) != 1)
        assert module.score(docs.where("false"), model).count() == 0


def events(text, stems=()):
    rows, found = clauses.counts(pa.array([text]), stems)
    names = [*clauses.FEATURES, *stems]
    return {names[i]: int(found[0][i]) for i in np.flatnonzero(found[0])} if len(rows) else {}


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("The weather is fine.", {}),
        ("Moron", {"insult": 1, "moron": 1}),
        ("you are an IDIOT!!", {"insult+target": 1, "idiot": 1}),
        ("she is not a loser", {"insult+target+negation": 1, "loser": 1}),
        ("not so. loser", {"insult": 1, "loser": 1}),
        ("no one of all these many words is a loser", {"insult+target": 1, "loser": 1}),
        ("he said trash", {"insult+target+report": 1, "trash": 1}),
        ("trash and scum, you", {"insult": 2, "again": 1, "after": 1, "trash": 1, "scum": 1}),
        ("i will kill you", {"threat": 1, "after": 1, "kill": 1}),
    ],
)
def test_grammar(text, wanted):
    assert events(text) == wanted


def test_events_weigh_as_the_grammar_says():
    score = lambda text: clauses.prior().scores(pa.array([text]))[0]
    assert score("you idiot") > score("an idiot") > 0.49
    assert score("she is not an idiot") < score("she is an idiot")
    assert score("she reported: fine") < 0.05 and score(None) == score("") < 0.05


def test_composition_equals_the_machines_one_after_another():
    random = np.random.default_rng(0)
    table = clauses.composed(clauses.GRAMMAR)
    for _ in range(300):
        states, state = [m[0] for m in clauses.GRAMMAR], 0
        for tag in random.choice(clauses.TAGS, 12):
            symbol = tag
            for i, machine in enumerate(clauses.GRAMMAR):
                if symbol:
                    states[i], symbol = clauses._step(machine, states[i], symbol)
            state, got = table[state][tag]
            body, _, again = symbol.partition(" ")
            assert got == tuple(e for e in (body, again) if e in clauses.EVENTS)


def test_stems_explain_what_the_lexicon_misses(spark):
    random = np.random.default_rng(2)
    clean = [" ".join(f"word{random.integers(300)}" for _ in range(20)) for _ in range(300)]
    ending = lambda: "".join(random.choice(list("abcdefgh"), 4))
    toxic = [f"{t} grobi{ending()}" for t in clean[:30]] + [f"{t} vilx" for t in clean[30:50]]
    rows = [(i, t, 0) for i, t in enumerate(clean)] + [(1000 + i, t, 1) for i, t in enumerate(toxic)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, l int")
    weights = clauses.fit(docs.drop("l"), docs.selectExpr("doc_id", "l as toxic"), "toxic", F.lit(True))
    assert [n for n, _ in weights.stems] == [5, clauses.WHOLE]  # grobi..., vilx
    unseen = ["some grobixyz here", "a VILX b", "word1 word2", "robi vil", "grob vilxa"]
    assert (weights.scores(pa.array(unseen)) > 0.5).tolist() == [True, True, False, False, False]


def test_score_of_a_text_is_the_mean_over_its_features():
    texts = ["Ab abc  abcdef", None, "", "x", "élan vital 日本語語", "a a a b"]
    random = np.random.default_rng(0)
    model = subwords.SubwordModel(12, random.normal(size=1 << 12).astype(np.float32), 0.25)
    got = model.scores(pa.array(texts))
    for text, score, (features, counts) in zip(texts, got, subwords._bags(pa.array(texts), 12)):
        mean = (model.weights[features] * counts).sum() / max(1, counts.sum())
        assert score == pytest.approx(1 / (1 + np.exp(-(0.25 + mean))), rel=1e-5)
        assert counts.sum() == plain_features(text)


def plain_features(text):
    words = (text or "").split()
    runs = 0
    padded = " " + (text or "") + " "
    for n in (3, 4, 5):
        runs += sum(not any(c.isspace() for c in padded[i + 1 : i + n - 1]) for i in range(len(padded) - n + 1))
    return len(words) + sum(a == b for a, b in zip(words, words[1:])) + runs


def test_bundles_equal_bound_and_summed_vectors():
    texts, dim = ["Ab c", "é, ab!", "", "日本"], 128
    got = hypervectors.bundle(texts, np.array([0, 1, 1, 2]), 3, dim)
    want = np.zeros((3, dim))
    for text, group in zip(texts, (0, 1, 1, 2)):
        letters = " " + " ".join("".join(c.lower() if c.isalpha() else " " for c in text).split()) + " "
        for a, b, c in zip(letters, letters[1:], letters[2:]):
            if b != " " or (a != " " and c != " "):
                x, y, z = hypervectors.letter_vectors(np.array([ord(a), ord(b), ord(c)]), dim)
                want[group] += np.roll(x, 2) * np.roll(y, 1) * z
    assert (got == want).all()


def test_counted():
    keys, n = counted(np.array([3, 1, 3, 3], np.uint64))
    assert keys.tolist() == [1, 3] and n.tolist() == [1, 3]

from collections import Counter

import pytest

from tallyrow.functions.lookup import MAX_INLINE_ROWS, word_lookup
from tallyrow.operators import batching, preference, templates, tokens
from tallyrow.operators.tokens import Specials

TEXTS = [(1, "b a  b\tc\nb"), (2, "a é 日本 \"q\" a"), (3, ""), (4, None), (5, "zz b")]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "k bigint, text string")


@pytest.fixture(scope="module")
def vocab(texts):
    return tokens.load_vocab(tokens.fit_vocab(texts, "text", 3))


def by_key(df, name):
    return {r["k"]: r[name] for r in df.collect()}


def test_vocabulary_is_most_frequent_first_then_word_order(texts):
    counts = Counter(w for _, t in TEXTS for w in (t or "").split())
    ranked = sorted(counts, key=lambda w: (-counts[w], w.encode()))
    rows = {r.tok: r.id for r in tokens.fit_vocab(texts, "text", 100).collect()}
    assert rows == {w: n + 2 for n, w in enumerate(ranked)}
    assert {r.tok for r in tokens.fit_vocab(texts, "text", 2).collect()} == set(ranked[:2])


def test_several_columns_share_one_vocabulary(spark):
    df = spark.createDataFrame([("x y", "y"), ("y", None)], "a string, b string")
    assert {r.tok: r.id for r in tokens.fit_vocab(df, ["a", "b"], 10).collect()} == {"y": 2, "x": 3}


def test_ids_and_unknown_words(texts, vocab):
    ids = by_key(tokens.tokenize(texts, vocab, "text"), "input_ids")
    assert ids[1][:3] == [2, 3, 2] and ids[3] == [] and ids[4] == []
    assert ids[5] == [1, 2]


SPECIALS = Specials(eos=3, unk=5, pad=7)


def test_a_joined_vocabulary_gives_the_same(spark, texts):
    inline = tokens.load_vocab(tokens.fit_vocab(texts, "text", 3, SPECIALS), SPECIALS)
    joined = tokens.load_vocab(tokens.fit_vocab(texts, "text", 3, SPECIALS), SPECIALS, limit=2)
    assert inline.entries and joined.entries is None and inline.size == joined.size == 11
    prompts = texts.withColumnRenamed("text", "prompt").union(texts)  # keys repeat
    examples = preference.value_examples(spark.createDataFrame([(1, "a", None, "b q"), (2, "zz", "b", "")], "k long, instruction string, input string, output string"))

    def all_of(vocab):
        ids = tokens.tokenize(texts, vocab, "text")
        special = ids.selectExpr("k", "concat(array(3, 5, 7), input_ids, array(7, 99)) as ids")
        return [
            sorted(map(tuple, df.collect()), key=str)
            for df in (
                ids,
                tokens.detokenize(special, vocab, "ids"),
                tokens.detokenize(special, vocab, "ids", skip_special=False),
                tokens.prompt_tokens(prompts, vocab, keep=["k"]),
                tokens.value_tokens(examples, vocab),
            )
        ]

    assert all_of(inline) == all_of(joined)
    assert by_key(tokens.tokenize(texts, joined, "text"), "input_ids")[5] == [5, 8]


def test_a_saved_vocabulary_comes_back(spark, texts, tmp_path):
    vocab = tokens.load_vocab(tokens.fit_vocab(texts, "text", 4, SPECIALS), SPECIALS)
    tokens.save_vocab(vocab, str(tmp_path / "v"))
    for limit in (100, 1):
        again = tokens.read_vocab(spark, str(tmp_path / "v"), limit)
        assert (again.size, again.specials) == (vocab.size, SPECIALS)
        assert tokens.tokenize(texts, again, "text").collect() == tokens.tokenize(texts, vocab, "text").collect() or limit == 1


def test_awkward_words_survive_the_inline_table(spark):
    awkward = ['"', "\\", "\\n", "a\u00a0b", "\u0001", "\U0001f600", "${x}", "'", "null", "{}", "\u2028", "\x0b", "é", "e\u0301"]
    df = spark.createDataFrame([(1, " ".join(awkward)), (2, "\r\n\t ".join(reversed(awkward)))], "k bigint, text string")
    table = tokens.fit_vocab(df, "text", 100)
    vocab = tokens.load_vocab(table)
    ids = by_key(tokens.tokenize(df, vocab, "text"), "input_ids")
    assert sorted(ids[1]) == list(range(2, 2 + len(awkward))) and ids[2] == ids[1][::-1]
    assert by_key(tokens.tokenize(df, tokens.load_vocab(table, limit=1), "text"), "input_ids") == ids
    back = tokens.detokenize(tokens.tokenize(df, vocab, "text"), vocab, "input_ids", name="back")
    assert by_key(back, "back")[1] == " ".join(awkward)


def test_inline_lookup_does_not_shuffle(texts, vocab):
    plan = tokens.tokenize(texts, vocab, "text")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_oversized_inline_tables_are_refused():
    with pytest.raises(ValueError):
        word_lookup([("w", 1, 1)] * (MAX_INLINE_ROWS + 1))


def test_decode_gives_back_normalised_text(texts):
    vocab = tokens.load_vocab(tokens.fit_vocab(texts, "text", 100))
    ids = tokens.tokenize(texts, vocab, "text").drop("text")
    assert by_key(tokens.detokenize(ids, vocab, "input_ids"), "text") == {
        k: " ".join((t or "").split()) for k, t in TEXTS
    }


def test_decode_skips_or_names_specials(spark, vocab):
    ids = spark.createDataFrame([(1, [2, 1, 0, 3]), (2, [0, 0]), (3, [])], "k bigint, ids array<int>")
    words = by_key(tokens.detokenize(ids, vocab, "ids"), "text")
    assert words == {1: "b a", 2: "", 3: ""}
    named = by_key(tokens.detokenize(ids, vocab, "ids", skip_special=False), "text")
    assert named == {1: "b <unk> </s> a", 2: "</s> </s>", 3: ""}


def test_pad_falls_back_to_end_of_text():
    assert Specials(eos=7).pad_id == 7
    assert Specials(eos=7, pad=9).pad_id == 9
    assert Specials(eos=7, pad=9).first_word == 10


def test_truncation_keeps_the_first_ids(spark):
    ids = spark.createDataFrame([(1, list(range(300))), (2, [5])], "k bigint, ids array<int>")
    cut = by_key(tokens.truncate(ids, "ids", 256), "ids")
    assert cut == {1: list(range(256)), 2: [5]}


def test_prompt_tokens_drop_every_other_column(instructions, vocab):
    prompts = templates.build_prompt(instructions)
    assert tokens.prompt_tokens(prompts, vocab).columns == ["input_ids"]


def test_value_tokens_replace_text_and_label(instructions, vocab):
    rows = tokens.value_tokens(preference.value_examples(instructions), vocab, limit=4)
    assert rows.columns == ["row_id", "input_ids", "attention_mask", "labels"]
    assert rows.schema["labels"].dataType.simpleString() == "double"
    for row in rows.collect():
        assert len(row.input_ids) == 4 and row.attention_mask == [1] * 4


def test_padding_and_mask(spark):
    rows = [(1, 0, [5, 6, 7]), (2, 0, [8]), (3, 1, [0]), (4, 1, []), (5, 2, [])]
    padded = batching.pad_batches(spark.createDataFrame(rows, "k bigint, b int, ids array<int>"), "ids", "b", "k", 0)
    assert {r.k: (r.ids, r.attention_mask) for r in padded.collect()} == {
        1: ([5, 6, 7], [1, 1, 1]),
        2: ([8, 0, 0], [1, 0, 0]),
        3: ([0], [1]),
        4: ([0], [0]),
        5: ([], []),
    }


@pytest.mark.parametrize("shuffle", [True, False])
def test_each_epoch_is_a_partition_into_full_batches(spark, shuffle):
    df = spark.range(23).withColumnRenamed("id", "k")
    rows = batching.assign_batches(df, "k", epochs=3, batch_size=4, shuffle=shuffle).collect()
    assert len(rows) == 69
    for epoch in range(3):
        seen = [r for r in rows if r.epoch == epoch]
        assert sorted(r.k for r in seen) == list(range(23))
        sizes = Counter(r.batch_id for r in seen)
        assert sizes == {**dict.fromkeys(range(5), 4), 5: 3}
        assert len({(r.batch_id, r.slot) for r in seen}) == 23
    orders = {tuple(r.k for r in sorted(rows, key=lambda r: (r.batch_id, r.slot)) if r.epoch == e) for e in range(3)}
    assert len(orders) == (3 if shuffle else 1)


def test_batches_are_repeatable_and_follow_the_seed(spark):
    df = spark.range(50).withColumnRenamed("id", "k")
    plan = lambda seed: {(r.k, r.batch_id) for r in batching.assign_batches(df.repartition(3), "k", 1, 4, seed).collect()}
    assert plan(1) == plan(1) != plan(2)


def test_batching_never_windows_over_everything(spark):
    df = spark.range(50).withColumnRenamed("id", "k")
    batches = batching.assign_batches(df, "k", 2, 4)
    plan = batches._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan

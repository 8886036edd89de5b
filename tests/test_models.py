import math
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from registry import queries
from tallyrow.operators import lm, objectives, preference, reward, rollouts, tokens
from tallyrow.plans.preference import LAST_WORD, completion_ids
from tallyrow.session import scratch_path

TRAIN = [(1, [2, 3, 2]), (2, [3]), (3, []), (4, [2, 2, 3, 4])]
HELD_OUT = [(1, [2, 3]), (2, [5, 5, 2]), (3, []), (4, [4])]
IDS = "k bigint, input_ids array<int>"
V, ADD_K = 6, 0.1


@pytest.fixture(scope="module")
def model(spark):
    return lm.fit_bigram(spark.createDataFrame(TRAIN, IDS), V, add_k=ADD_K)


def counts(rows, bos=0):
    return Counter(pair for _, ids in rows for pair in zip([bos, *ids], ids))


def logprob(ids, first, bigrams):
    context = Counter()
    for (prev, _), n in bigrams.items():
        context[prev] += n
    return sum(math.log((bigrams[p] + ADD_K) / (context[p[0]] + ADD_K * V)) for p in zip([first, *ids], ids))


def test_bigram_counts(model):
    assert {(r.prev, r.next): r.n for r in model.bigrams.collect()} == dict(counts(TRAIN))
    assert {r.prev: r.c for r in model.contexts.collect()} == {0: 3, 2: 3, 3: 2}


def test_logprobs_match_brute_force(spark, model):
    scored = {r.k: (r.logprob, r.n_tokens) for r in lm.sequence_logprob(spark.createDataFrame(HELD_OUT, IDS), model, "k").collect()}
    bigrams = counts(TRAIN)
    assert set(scored) == {1, 2, 3, 4}
    for k, ids in HELD_OUT:
        assert scored[k] == (pytest.approx(logprob(ids, 0, bigrams), abs=1e-7), len(ids))


def test_a_large_model_is_joined_with_the_same_result(spark, model):
    df = spark.createDataFrame(HELD_OUT, IDS)
    score = lambda **options: lm.sequence_logprobs(df, {"policy": model, "reference": model}, "k", **options)
    small, large = score(), score(broadcast_pairs=model.pairs * 2 - 1)
    assert sorted(small.collect()) == sorted(large.collect())
    plan = lambda frame: frame._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan(large) and "_salt" not in plan(small)


def test_first_token_follows_the_prompt(spark, model):
    df = spark.createDataFrame([(1, [2, 3], 3)], "k bigint, input_ids array<int>, last int")
    row = lm.sequence_logprob(df, model, "k", first=F.col("last")).first()
    assert row.logprob == pytest.approx(logprob([2, 3], 3, counts(TRAIN)), abs=1e-7)


def test_several_models_in_one_pass_equal_one_by_one(spark, model):
    df = spark.createDataFrame(HELD_OUT, IDS)
    other = lm.fit_bigram(df, V, add_k=0.5)
    both = {r.k: (r.policy_logprob, r.reference_logprob) for r in lm.sequence_logprobs(df, {"policy": model, "reference": other}, "k").collect()}
    aligned = objectives.align_logprobs(lm.sequence_logprob(df, model, "k"), lm.sequence_logprob(df, other, "k"), "k")
    assert both == {r.k: (r.policy_logprob, r.reference_logprob) for r in aligned.collect()}


def test_a_saved_model_scores_alike(spark, model):
    df = spark.createDataFrame(HELD_OUT, IDS)
    path = scratch_path(spark, "lm")
    lm.fit_bigram(spark.createDataFrame(TRAIN, IDS), V, path)
    loaded = lm.BigramModel.load(spark, path)
    assert sorted(lm.sequence_logprob(df, loaded, "k").collect()) == sorted(lm.sequence_logprob(df, model, "k").collect())


def test_smoothing_must_be_positive(spark):
    with pytest.raises(ValueError):
        lm.fit_bigram(spark.createDataFrame(TRAIN, IDS), V, add_k=0.0)


def test_eval_loss_weighs_by_tokens(spark, model):
    row = lm.eval_loss(lm.sequence_logprob(spark.createDataFrame(HELD_OUT, IDS), model, "k")).first()
    total = sum(logprob(ids, 0, counts(TRAIN)) for _, ids in HELD_OUT)
    assert (row.sequences, row.tokens) == (4, 6)
    assert row.nll == pytest.approx(-total / 6, abs=1e-6)
    assert row.perplexity == pytest.approx(math.exp(-total / 6), rel=1e-5)


def test_equal_models_give_no_kl_and_loss_ln2(spark, model):
    df = spark.createDataFrame(HELD_OUT, IDS)
    scored = lm.sequence_logprobs(df, {"policy": model, "reference": model}, "k").withColumn("reward", F.lit(1.5))
    rows = objectives.kl_reward(scored, beta=0.3).collect()
    assert all(r.kl == 0.0 and r.kl_reward == 1.5 for r in rows)
    pairs = scored.selectExpr(
        "policy_logprob AS policy_chosen", "reference_logprob AS reference_chosen",
        "policy_logprob - 1 AS policy_rejected", "reference_logprob - 1 AS reference_rejected",
    )
    row = objectives.dpo_metrics(pairs).first()
    assert row.loss == pytest.approx(math.log(2)) and row.margin == 0.0 and row.accuracy == 0.0


def test_dpo_terms(spark):
    names = "policy_chosen double, reference_chosen double, policy_rejected double, reference_rejected double"
    row = objectives.dpo_terms(spark.createDataFrame([(-1.0, -2.0, -5.0, -3.0)], names), beta=0.5).first()
    assert (row.chosen_reward, row.rejected_reward, row.margin) == (0.5, -1.0, 1.5)
    assert row.loss == pytest.approx(math.log(1 + math.exp(-1.5)))


@pytest.mark.parametrize("x, expected", [(0.0, -math.log(2)), (1000.0, 0.0), (-1000.0, -1000.0)])
def test_log_sigmoid_does_not_overflow(spark, x, expected):
    assert spark.range(1).select(objectives.log_sigmoid(F.lit(x)).alias("y")).first().y == pytest.approx(expected)


def test_kl_penalty(spark):
    df = spark.createDataFrame([(1.0, -2.0, -5.0)], "reward double, policy_logprob double, reference_logprob double")
    row = objectives.kl_reward(df, beta=0.1).first()
    assert (row.kl, row.kl_reward) == (3.0, pytest.approx(0.7))


def test_group_advantage(spark):
    rewards = {1: [1.0, 1.0, 1.0, 1.0], 2: [5.0], 3: [1.0, 2.0, 4.0, 9.0]}
    rows = [(g, i, r) for g, rs in rewards.items() for i, r in enumerate(rs)]
    out = objectives.group_advantage(spark.createDataFrame(rows, "prompt_id bigint, gen_id int, reward double")).collect()
    got = {(r.prompt_id, r.gen_id): r.advantage for r in out}
    assert all(got[1, i] == 0.0 for i in range(4)) and got[2, 0] == 0.0
    dev = math.sqrt(sum((r - 4.0) ** 2 for r in rewards[3]) / 3)
    for i, r in enumerate(rewards[3]):
        assert got[3, i] == pytest.approx((r - 4.0) / (dev + 1e-4))
    assert sum(got[3, i] for i in range(4)) == pytest.approx(0.0, abs=1e-9)


def test_value_advantage_and_whitening(spark):
    rewards = spark.createDataFrame([(1, 3.0), (2, 1.0), (3, 8.0)], "k bigint, reward double")
    values = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "k bigint, value double")
    rows = {r.k: r.advantage for r in objectives.value_advantage(rewards, values, "k").collect()}
    assert rows == {1: 2.0, 2: -1.0, 3: 5.0}
    white = [r.advantage for r in objectives.value_advantage(rewards, values, "k", whiten=True).collect()]
    assert sum(white) == pytest.approx(0.0, abs=1e-9) and sum(w * w for w in white) / 2 == pytest.approx(1.0)


@pytest.fixture(scope="module")
def corpus(spark):
    topics = ["ships", "bread", "rivers", "chess", "stars", "paper"]
    rows = [(i, f"tell me about {t} please", "", f"{t} are known for many things and here is why {i}") for i, t in enumerate(topics * 5)]
    return spark.createDataFrame(rows, "row_id bigint, instruction string, input string, output string")


@pytest.fixture(scope="module")
def reward_model(corpus):
    return reward.fit_reward(preference.reward_pairs(corpus), buckets=64)


def test_reward_ranks_answers_over_refusals(corpus, reward_model):
    pairs = preference.reward_pairs(corpus, include_prompt=False)
    for side in ("chosen", "rejected"):
        pairs = reward.score_reward(reward_model, pairs, completion=side, name=f"{side}_score")
    row = reward.preference_metrics(pairs).first()
    assert row.pairs == 30 and row.accuracy > 0.95 and row.margin > 0


def test_reward_weights_of_the_two_sides_are_opposite(reward_model):
    weights = reward_model.stages[-1].coefficients.toArray()
    half = len(weights) // 2
    assert weights[:half] == pytest.approx(-weights[half:], abs=1e-6)
    assert reward_model.stages[-1].intercept == 0.0


def test_an_empty_completion_scores_zero(spark, reward_model):
    df = spark.createDataFrame([("p", "")], "prompt string, completion string")
    assert reward.score_reward(reward_model, df).first().reward == 0.0


def test_a_saved_reward_model_scores_alike(spark, corpus):
    path = scratch_path(spark, "rm")
    fitted = reward.fit_reward(preference.reward_pairs(corpus), path, buckets=64)
    df = preference.reward_pairs(corpus, include_prompt=False)
    score = lambda m: sorted(reward.score_reward(m, df, completion="chosen").select("row_id", "reward").collect())
    assert score(fitted) == score(reward.load_model(path))


def test_value_model_tells_good_from_bad(corpus, reward_model):
    examples = preference.value_examples(corpus, keep_prompt=True)
    model = reward.fit_value(examples, reward_model, buckets=64)
    scored = reward.score_value(model, reward_model, examples)
    assert reward.value_metrics(scored).first().mse < 0.05
    low, high = (scored.where(f"label = {x}").agg({"value": "avg"}).first()[0] for x in (0.0, 1.0))
    assert low < 0.3 < 0.7 < high


def test_value_metrics(spark):
    row = reward.value_metrics(spark.createDataFrame([(1.0, 0.0), (0.5, 1.0)], "value double, label double")).first()
    assert (row.rows, row.mse) == (2, 0.625)


def test_response_features(spark):
    df = spark.createDataFrame([("a b b c", "b c c d"), ("a", "")], "prompt string, response string")
    assert [(r.n_words, r.n_shared) for r in reward.response_features(df).collect()] == [(4, 2), (0, 0)]


def test_fan_out_and_back(spark):
    prompts = spark.createDataFrame([(1, "p1"), (2, "p2")], "prompt_id bigint, prompt string")
    fanned = rollouts.fan_out(prompts, 4)
    assert sorted((r.prompt_id, r.gen_id) for r in fanned.collect()) == [(p, g) for p in (1, 2) for g in range(4)]
    made = fanned.select("prompt_id", "gen_id", F.concat(F.lit(" c"), "gen_id").alias("completion"))
    rows = rollouts.completion_text(rollouts.attach_completions(prompts, made)).collect()
    assert {(r.prompt_id, r.gen_id): r.text for r in rows} == {(p, g): f"p{p} c{g}" for p in (1, 2) for g in range(4)}


def test_strip_prompt_only_where_the_text_opens_with_it(spark):
    rows = [("ab.c", "ab."), ("xab.", "ab."), ("ab.", "ab."), ("日本語", "日本")]
    df = spark.createDataFrame(rows, "text string, prompt string")
    assert [r.response for r in rollouts.strip_prompt(df).collect()] == ["c", "xab.", "", "語"]


def test_strip_prompt_ids(spark):
    df = spark.createDataFrame([([1, 2, 3], [1, 2]), ([1], [1]), ([], []), ([4, 5], [])], "ids array<int>, p array<int>")
    assert [r.response_ids for r in rollouts.strip_prompt_ids(df, "ids", "p").collect()] == [[3], [], [], [4, 5]]


def test_reward_callback_loads_once_per_task(spark, tmp_path):
    marks = str(tmp_path)

    def load():
        import os
        import uuid

        open(os.path.join(marks, uuid.uuid4().hex), "w").close()
        return lambda prompts, completions: [float(len(p) - len(c)) for p, c in zip(prompts, completions)]

    df = spark.range(2000).selectExpr("repeat('p', cast(id % 7 as int)) AS prompt", "repeat('c', cast(id % 3 as int)) AS completion").coalesce(2)
    rows = rollouts.score_with(df, load).collect()
    assert len(rows) == 2000 and all(r.reward == len(r.prompt) - len(r.completion) for r in rows)
    assert len(list(tmp_path.iterdir())) == 2


def test_slopes_are_nothing_at_the_fit_and_something_elsewhere(spark):
    """A model that was not fitted on these pairs does not pass."""
    rows = [(f"word{i} ask {i % 5}", f"good answer {i % 7} of word{i}", f"no idea {i % 3}") for i in range(60)]
    pairs = spark.createDataFrame(rows, "prompt string, chosen string, rejected string").cache()
    swapped = pairs.selectExpr("prompt", "if(prompt like '%3', chosen, rejected) as chosen", "if(prompt like '%3', rejected, chosen) as rejected")
    model, other = reward.fit_reward(pairs), reward.fit_reward(swapped)
    n, slope = reward.reward_slope(model, pairs)
    assert n == 120 and slope < 1e-5 < 1e-2 < reward.reward_slope(other, pairs)[1]
    both = "stack(2, prompt, concat(prompt, chosen), 1.0D, prompt, concat(prompt, rejected), 0.0D) as (prompt, text, label)"
    examples = pairs.selectExpr(both)
    value = reward.fit_value(examples, model)
    assert reward.value_slope(value, model, examples)[1] < 1e-4
    assert reward.value_slope(value, model, examples.selectExpr("prompt", "text", "1 - label as label"))[1] > 1e-2
    assert reward.reward_slope(model, pairs.limit(0)) == (0, 0.0)


def test_mapped_models_score_alike_without_shuffling_tokens(spark, model):
    rows = [*HELD_OUT, (2, [2, 3, None, 4]), (None, [4, 4]), (7, None), (8, [2] * 40)]
    df = spark.createDataFrame([(k, ids, None if k == 4 else 3) for k, ids in rows], f"{IDS}, last int")
    other = lm.fit_bigram(df.where("k = 8"), V, add_k=0.5)
    score = lambda **options: lm.sequence_logprobs(df, {"policy": model, "reference": other}, "k", first=F.col("last"), **options)
    small, mapped = score(), score(mapped_pairs=0)
    by_key = lambda frame: sorted(frame.collect(), key=str)
    plan = mapped._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1  # of one row's sums
    assert by_key(small) == by_key(mapped) and small.dtypes == mapped.dtypes


def test_a_mapped_model_takes_rows_in_parts(spark, model, monkeypatch):
    df = spark.createDataFrame([(k, [2, 3, 4, 5][: k % 5] * (k % 3)) for k in range(50)], IDS).coalesce(1)
    want = sorted(lm.sequence_logprob(df, model, "k").collect())
    scores = lm.pair_scores({"model": model})
    assert scores.pairs.held and scores.pairs.get(lm.np.asarray([-1, 1 << 40]))[0].tolist() == [False, False]
    monkeypatch.setattr(lm, "LOOKUP_TOKENS", 5)
    got = lm.sequence_logprobs(df, {"model": model}, "k", mapped_pairs=0)
    assert sorted(tuple(r) for r in got.collect()) == [tuple(r) for r in want]


def test_fits_read_features_made_once(spark, monkeypatch):
    rows = [(i, f"ask {i % 3}", f"good word{i % 5} ask", f"bad w{i % 4}") for i in range(24)]
    pairs = spark.createDataFrame(rows, "k int, prompt string, chosen string, rejected string")
    made = []
    written = reward.written
    monkeypatch.setattr(reward, "written", lambda df, label: made.append((label, df.columns)) or written(df, label))
    features = reward.stored_pair_rows(pairs)
    model = reward.fit_reward(pairs, rows=features)
    examples = preference.value_examples(pairs.selectExpr("cast(k as bigint) conv_id", "cast(0 as bigint) turn", "prompt instruction", "'' input", "chosen output"), keep_prompt=True)
    values = reward.stored_value_rows(examples, model)
    value_model = reward.fit_value(examples, model, rows=values)
    assert made == [("pair-rows", ["features", "label"]), ("value-rows", ["features", "label"])]
    n, slope = reward.reward_slope(model, pairs)
    assert reward.reward_slope(model, pairs, rows=features) == (n, pytest.approx(slope, abs=1e-9)) and n == 48 and slope < 1e-3
    n, slope = reward.value_slope(value_model, model, examples)
    assert reward.value_slope(value_model, model, examples, rows=values) == (n, pytest.approx(slope, abs=1e-9)) and n == 48
    fitted, scored = reward.fitted_values(value_model, values), reward.score_value(value_model, model, examples)
    by_value = lambda frame: sorted((round(r.label, 9), round(r.value, 9)) for r in frame.collect())
    assert by_value(fitted) == by_value(scored)


def test_a_roundtrip_stores_no_text_twice(spark, sf_dir, monkeypatch):
    """Prompts stand once in the ring, not once more per completion; training texts are made of the stored instructions."""
    stored = []
    written = queries.written
    monkeypatch.setattr(queries, "written", lambda df, label: stored.append(set(df.columns)) or written(df, label))
    found = queries.model_roundtrip(spark, sf_dir).collect()
    assert {(r.reward_difference, r.logprob_difference) for r in found} == {(0.0, 0.0)}
    assert len(found) == len({(r.prompt_id, r.gen_id) for r in found}) == 4 * queries.instructions(spark, sf_dir).count()
    assert [c for c in stored if "text" in c or {"gen_id", "prompt"} <= c or {"gen_id", "completion"} <= c] == []


# Two null lists, null ids inside, negative and largest ids.
ODD = [(1, [2, None, 3]), (2, None), (3, []), (4, [None]), (5, [-5, 2**31 - 1, -5, 2**31 - 1]), (6, None), (7, [2, 2, 2, 2, 2, 2])]


@pytest.mark.parametrize("tokens_at_once", [1, 5, 1 << 22])
def test_pairs_are_counted_before_they_leave_their_task(spark, monkeypatch, tokens_at_once):
    monkeypatch.setattr(lm, "COUNTED_TOKENS", tokens_at_once)
    df = spark.createDataFrame(ODD, IDS).coalesce(1)
    want = counts([(k, ids) for k, ids in ODD if ids], bos=7)
    found = lm.fit_bigram(df, V, bos_id=7).bigrams.collect()
    assert {(r.prev, r.next): r.n for r in found} == dict(want) and len(found) == len(want)
    formed = df.select("input_ids").mapInArrow(lm._pair_counts(7), lm.BIGRAM_SCHEMA)
    assert formed.count() < sum(want.values()) and formed.agg(F.sum("n")).first()[0] == sum(want.values())


def test_no_texts_make_a_model_of_no_pairs(spark):
    found = lm.fit_bigram(spark.createDataFrame([], IDS), V)
    assert found.pairs == 0 and found.bigrams.count() == found.contexts.count() == 0


def test_the_last_word_of_a_prompt_is_found_in_one_pass(spark):
    texts = ["", " ", "a", " a b ", "a b\n", "a\r\n", "b ", "a b  ", "a b\n ", "é  日本\t\r", "a\u0085 ", "a\n b\u0085\n", "x" * 50 + " y"]
    df = spark.createDataFrame([(t,) for t in texts], "prompt string")
    plain = F.regexp_extract("prompt", r"([^ \n\t\r]+)[ \n\t\r]*$", 1)
    assert df.where(plain != F.regexp_extract("prompt", LAST_WORD, 1)).count() == 0
    vocab = tokens.load_vocab(spark.createDataFrame([("end", 2)], "tok string, id int"))
    long = spark.range(4).selectExpr("id k", "concat(repeat('x', 400000), ' end ', cast(id as string), ' end') prompt", "'end' completion")
    begun = time.monotonic()
    assert {r._first for r in completion_ids(long, "k", vocab).collect()} == {2}
    assert time.monotonic() - begun < 20

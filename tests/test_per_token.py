"""Per-token penalties and returns against loops, and their sums against the sequence totals."""

import pytest
from pyspark.sql import functions as F

from tallyrow.operators import lm, objectives, per_token


@pytest.fixture(scope="module")
def scored(spark):
    train = spark.createDataFrame([([1, 2, 3, 1, 2, 2],), ([2, 2, 1],), ([3],)], "input_ids array<int>")
    other = spark.createDataFrame([([1, 1, 1, 2],)], "input_ids array<int>")
    models = {"policy": lm.fit_bigram(train, 5), "reference": lm.fit_bigram(other, 5)}
    rows = [(0, [1, 2, 3, 4]), (1, []), (2, None), (3, [2] * 50), (4, [4])]
    return models, spark.createDataFrame(rows, "k bigint, input_ids array<int>").repartition(3)


@pytest.mark.parametrize("limits", [{}, {"broadcast_pairs": 0}, {"broadcast_pairs": 0, "hot_rows": 5}])
def test_sums_are_the_sequence_totals(scored, limits):
    models, rows = scored
    got = {r.k: r for r in per_token.token_logprobs(rows, models, "k", first=F.lit(3), **limits).collect()}
    for r in lm.sequence_logprobs(rows, models, "k", first=F.lit(3)).collect():
        assert len(got[r.k].policy_logprobs) == len(got[r.k].reference_logprobs) == r.n_tokens
        assert sum(got[r.k].policy_logprobs) == pytest.approx(r.policy_logprob) and sum(got[r.k].reference_logprobs) == pytest.approx(r.reference_logprob)
    assert len({round(x, 6) for x in got[3].policy_logprobs}) == 2  # after the first token, the same pair again and again


def test_rewards_add_up_to_the_penalised_reward(scored):
    models, rows = scored
    with_reward = rows.select("k", (F.col("k") + 0.5).alias("reward"))
    tokens = per_token.token_rewards(with_reward.join(per_token.token_logprobs(rows, models, "k"), "k"), beta=0.1)
    whole = objectives.kl_reward(with_reward.join(lm.sequence_logprobs(rows, models, "k"), "k"), beta=0.1)
    want = {r.k: (r.kl, r.kl_reward) for r in whole.collect()}
    for r in tokens.withColumn("earned", per_token.returns("rewards")).collect():
        assert len(r.kl) == len(r.rewards) == len(r.earned)
        if r.kl:
            assert sum(r.kl) == pytest.approx(want[r.k][0], abs=1e-7) and sum(r.rewards) == pytest.approx(want[r.k][1], abs=1e-7)
            assert r.earned[0] == pytest.approx(want[r.k][1], abs=1e-7) and r.earned[-1] == pytest.approx(r.rewards[-1])


@pytest.mark.parametrize(("discount", "decay"), [(1.0, 1.0), (0.9, 1.0), (0.95, 0.5)])
def test_returns_and_advantages_equal_loops(spark, discount, decay):
    rows = [([1.0, -2.0, 0.5, 3.0], [0.1, 0.2, -0.3, 0.4]), ([], []), ([7.0], [2.0])]
    df = spark.createDataFrame(rows, "r array<double>, v array<double>")
    got = df.select("r", "v", per_token.returns("r", discount).alias("g"), per_token.advantages(F.col("r"), F.col("v"), discount, decay).alias("a")).collect()
    for row in got:
        total, ahead, following, g, a = 0.0, 0.0, 0.0, [], []
        for r, v in zip(reversed(row.r), reversed(row.v)):
            total = r + discount * total
            ahead = r + discount * following - v + discount * decay * ahead
            following = v
            g.insert(0, total)
            a.insert(0, ahead)
        assert row.g == pytest.approx(g) and row.a == pytest.approx(a)


def test_mapped_models_give_the_same_arrays(scored):
    models, rows = scored
    rows = rows.union(rows.where("k < 2")).withColumn("last", F.when(F.col("k") != 4, F.lit(3)))
    want, got = (per_token.token_logprobs(rows, models, "k", first=F.col("last"), **o) for o in ({}, {"mapped_pairs": 0}))
    assert sorted(got.collect()) == sorted(want.collect()) and got.dtypes == want.dtypes
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 64, 1000])
def test_long_rows_are_folded_in_parts(spark, n):
    rewards = [((i * 37) % 101) / 100 for i in range(n)]
    earned, total = [], 0.0
    for r in reversed(rewards):
        total = r + 0.9 * total
        earned.insert(0, total)
    row = spark.createDataFrame([(rewards,)], "r array<double>").select(per_token.returns("r", 0.9).alias("e")).first()
    assert row.e == earned


def test_a_fold_copies_no_more_than_its_part(spark, monkeypatch):
    appended = []
    plain = F.array_append
    monkeypatch.setattr(F, "array_append", lambda out, x: appended.append(out) or plain(out, x))
    per_token.returns("r")
    assert len(appended) == 2  # to a part, and of parts

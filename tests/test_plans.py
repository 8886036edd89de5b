"""What the physical plans of the operators must and must not hold."""

import pytest
from pyspark.sql import functions as F

from registry.queries import QUERIES
from tallyrow.functions.skew import lookup_join, salted
from tallyrow.operators import batching, lm, objectives
from tallyrow.sources.dialogue import instructions_from_turns

def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_local_texts_add_no_shuffle(spark, sf_dir):
    base = physical(QUERIES["read_instructions"](spark, sf_dir)).count("Exchange")
    for name in ("format_sft", "build_prompt", "reward_pairs", "value_examples", "to_jsonl", "fan_out"):
        assert physical(QUERIES[name](spark, sf_dir)).count("Exchange") == base, name


def test_instructions_read_their_table_three_times_at_most(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    plan = physical(instructions_from_turns(turns))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    texts = [line for line in scans if "text" in line.split("ReadSchema")[1]]
    assert len(texts) == 2 and all("EqualTo(role," in line or "In(role," in line for line in scans)
    # Questions and answers come together by one shuffle.
    assert "SortMergeJoin" not in plan.split("HashAggregate")[-1]


@pytest.fixture
def hot(spark):
    """20,000 rows over 180 groups; group 7 holds more than a third."""
    group = F.when(F.col("id") % 5 < 2, F.lit(7)).otherwise(F.col("id") % 300)
    return spark.range(0, 20000, 1, 8).select(
        group.alias("prompt_id"), F.col("id").alias("gen_id"), (F.col("id") % 97).cast("double").alias("reward")
    )


def test_a_hot_key_is_dealt_over_salts_and_its_row_repeated(spark, hot):
    table = hot.groupBy("prompt_id").agg(F.max("reward").alias("top"))
    rows, copies = salted(hot, table, "prompt_id", "gen_id", hot_rows=500)
    sizes = {tuple(r)[:2]: r["count"] for r in rows.groupBy("prompt_id", "_salt").count().collect()}
    assert sum(sizes.values()) == 20000 and max(sizes.values()) < 700
    assert {k[0] for k in sizes if k[1] > 0} == {7}
    assert {tuple(r) for r in copies.select("prompt_id", "_salt").collect()} >= set(sizes)
    assert copies.count() == 180 + 16  # one row per group; the 8,040 rows of group 7 are in 17 parts


def test_no_key_over_the_threshold_stays_whole(spark):
    rows = spark.range(0, 40000, 1, 8).select((F.col("id") % 4).alias("k"), "id")
    counts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("_n"))
    for hot_rows in (100, 5000, 9999):
        dealt, _ = salted(rows, counts, "k", "id", hot_rows=hot_rows)
        sizes = dealt.groupBy("k", "_salt").count().collect()
        # An even share of 4 partitions is 10,000 rows: no key is over it.
        assert max(r["count"] for r in sizes) <= 10000
    more = rows.union(rows.where("k = 1"))
    dealt, _ = salted(more, counts, "k", "id", hot_rows=3000)
    assert max(r["count"] for r in dealt.where("k = 1").groupBy("_salt").count().collect()) < 3400
    assert "NestedLoop" not in physical(dealt)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_salted_join_equals_the_plain_join(spark, hot, how):
    table = hot.where("prompt_id < 200").groupBy("prompt_id").agg(F.max("reward").alias("top"))
    ours = lookup_join(hot, table, "prompt_id", "gen_id", how, hot_rows=500)
    plain = hot.join(table, "prompt_id", how)
    assert ours.columns == plain.columns
    assert sorted(ours.collect(), key=str) == sorted(plain.collect(), key=str)


def test_hot_group_advantage(hot):
    out = objectives.group_advantage(hot, hot_rows=500)
    assert sorted(map(str, out.collect())) == sorted(map(str, objectives.group_advantage(hot).collect()))
    brute = hot.toPandas().groupby("prompt_id").reward.agg(["mean", "std"])
    for row in out.where("gen_id < 50").collect():
        mean, dev = brute.loc[row.prompt_id]
        assert row.advantage == pytest.approx((row.reward - mean) / (dev + 1e-4))


def test_hot_batch_padding(hot):
    rows = hot.select("gen_id", "prompt_id", F.sequence(F.lit(1), (F.col("gen_id") % 7 + 1).cast("int")).alias("ids"))
    out = batching.pad_batches(rows, "ids", "prompt_id", "gen_id", 0, hot_rows=500)
    assert out.count() == 20000
    assert out.where("size(ids) != size(attention_mask)").count() == 0
    assert out.where("prompt_id = 7 AND size(ids) != 7").count() == 0


def test_group_statistics_need_no_window(hot):
    assert "Window" not in physical(objectives.group_advantage(hot))


def test_a_hot_pair_is_scored_whole(spark):
    ids = spark.range(0, 400, 1, 4).select(F.col("id").alias("k"), F.array_repeat(F.lit(1), 20).alias("input_ids"))
    model = lm.fit_bigram(ids, 5)
    plain = sorted(lm.sequence_logprobs(ids, {"m": model}, "k").collect())
    joined = lm.sequence_logprobs(ids, {"m": model}, "k", broadcast_pairs=0, hot_rows=100)
    assert sorted(joined.collect()) == plain
    assert len(plain) == 400 and all(r.n_tokens == 20 for r in plain)


def test_a_hot_conversation_keeps_every_answer(spark):
    conv = F.when(F.col("id") < 14000, F.lit(3)).otherwise(F.col("id") + 10).alias("conv_id")
    turn = F.when(F.col("id") < 14000, F.col("id") + 1).otherwise(F.lit(0)).alias("turn")
    role = F.when(F.col("id") % 2 == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role")
    turns = spark.range(0, 20000, 1, 8).select(conv, turn, role, F.md5(F.col("id").cast("string")).alias("text"))
    system = spark.createDataFrame([(3, 0, "system", "S")], turns.schema)
    out = instructions_from_turns(turns.union(system))
    assert "Window" not in physical(out)
    assert out.count() == out.where("conv_id = 3 AND input = 'S'").count() == 7000

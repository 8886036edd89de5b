"""Percentiles, violations and large groups against plain counting."""

import math
import random
from collections import Counter

import pytest

from tallyrow.operators import contracts, reports


@pytest.mark.parametrize("span", [1, 3, reports.SPAN])
def test_percentiles_are_those_of_the_sorted_lengths(spark, span):
    rng = random.Random(span)
    rows = [(" ".join("w" * rng.randint(0, 9)), rng.choice([None, "", "a b", "x " * rng.randint(0, 300)])) for _ in range(257)]
    df = spark.createDataFrame(rows, "a string, b string").repartition(3)
    percents = [1, 37, 50, 90, 99, 100, 50]
    got = {(r.field, r.percent): r.length for r in reports.length_percentiles(df, ["a", "b"], percents, span).collect()}
    want = {}
    for i, name in enumerate("ab"):
        lengths = sorted(len((r[i] or "").split()) for r in rows)
        want |= {(name, p): lengths[math.ceil(p * len(lengths) / 100) - 1] for p in set(percents)}
    assert got == want


def test_percentiles_of_few_rows(spark):
    one = spark.createDataFrame([("a b c",)], "a string")
    assert {r.length for r in reports.length_percentiles(one, ["a"], [1, 100]).collect()} == {3}
    assert reports.length_percentiles(one.limit(0), ["a"], [50]).collect() == []
    with pytest.raises(ValueError):
        reports.length_percentiles(one, ["a"], [0])


PAIR = contracts.Contract.of(
    "id bigint, prompt string, chosen string, score double", "id", after_prompt=("chosen",), completions=("chosen",)
)


def test_violations_name_each_row_and_agree_with_the_report(spark):
    rows = [
        (1, "p", "p good"), (2, "p", "other"), (2, "p", "p"), (3, None, "x"), (4, "p", None), (None, "p", "p a"), (None, "p", "p a"), (5, "p", "p \n"),
    ]
    df = spark.createDataFrame(rows, "id long, prompt string, chosen string").repartition(3)
    got = Counter((r.id, r.rule, r.field) for r in reports.contract_violations(df, PAIR).collect())
    assert got == Counter(
        {
            (2, "prompt_prefix", "chosen"): 1, (2, "empty_completion", "chosen"): 1, (2, "repeated_key", "id"): 2,
            (3, "null", "prompt"): 1, (3, "prompt_prefix", "chosen"): 1, (4, "null", "chosen"): 1, (4, "prompt_prefix", "chosen"): 1,
            (4, "empty_completion", "chosen"): 1, (None, "null", "id"): 2, (None, "repeated_key", "id"): 2, (5, "empty_completion", "chosen"): 1,
        }
    )
    by_rule = Counter()
    for (_, rule, field), n in got.items():
        by_rule[rule, field] += n
    report = {(r.rule, r.field): r.rows for r in contracts.contract_report(df, PAIR).collect()}
    assert all(report[rule] == n for rule, n in by_rule.items() if rule[0] != "repeated_key")
    assert all(not n or rule in by_rule for rule, n in report.items() if rule[0] not in ("missing", "type", "repeated_key"))


def test_violations_of_sound_and_empty_tables(spark):
    sound = spark.createDataFrame([(1, "p", "p good"), (2, "", "x")], "id long, prompt string, chosen string")
    assert reports.contract_violations(sound, PAIR).collect() == []
    assert reports.contract_violations(sound.limit(0), PAIR).collect() == []
    with pytest.raises(ValueError, match="id"):
        reports.contract_violations(sound.drop("id"), PAIR)


@pytest.mark.parametrize("share", [0.3, 0.05, 0.011, 0.002, 1.0])
def test_large_groups_are_counted_exactly(spark, conf, share):
    conf(spark__sql__execution__arrow__maxRecordsPerBatch="50")
    rng = random.Random(7)
    values = ["hot"] * 1000 + [None] * 60 + ["edge"] * 33 + [f"g{rng.randint(0, 900)}" for _ in range(1907)]
    rng.shuffle(values)
    # One task holds a group that the others do not have.
    df = spark.createDataFrame([(v,) for v in values], "g string").repartition(7).union(spark.createDataFrame([("late",)] * 100, "g string").coalesce(1))
    count = Counter([*values, *["late"] * 100])
    got = {(r.g, r.rows, r["of"]) for r in reports.group_report(df, "g", share).collect()}
    assert got == {(v, n, 3100) for v, n in count.items() if n >= share * 3100}


def test_group_report_keeps_types_and_takes_empty_tables(spark):
    df = spark.range(90).selectExpr("if(id < 60, 7L, id) as k")
    report = reports.group_report(df, "k", 0.5)
    assert report.dtypes == [("k", "bigint"), ("rows", "bigint"), ("of", "bigint")] and [tuple(r) for r in report.collect()] == [(7, 60, 90)]
    assert reports.group_report(df.limit(0), "k").collect() == []
    with pytest.raises(ValueError):
        reports.group_report(df, "k", 0)

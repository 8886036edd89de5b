"""Reports and rated pairs on small tables whose faults are known."""

import pytest

from tallyrow.operators import contracts, preference
from tallyrow.operators.contracts import Contract

FIELDS = "row_id bigint, prompt string, chosen string, rejected string"
CONTRACT = Contract.of(FIELDS, "row_id", after_prompt=("chosen", "rejected"), completions=("chosen", "rejected"))


def report(df):
    return {(r.rule, r.field): r.rows for r in contracts.contract_report(df, CONTRACT).collect()}


def test_every_fault_is_counted(spark):
    rows = [
        (1, "P", "P good", "P bad"), (1, "P", "P", "bad"), (None, "P", "P \n", None), (2, None, "x", "x"), (3, "P", "", "Px"),
    ]
    got = report(spark.createDataFrame(rows, FIELDS))
    assert {k: n for k, n in got.items() if n} == {
        ("null", "row_id"): 1, ("null", "prompt"): 1, ("null", "rejected"): 1, ("prompt_prefix", "chosen"): 2,
        ("prompt_prefix", "rejected"): 3, ("empty_completion", "chosen"): 3, ("empty_completion", "rejected"): 1, ("repeated_key", "row_id"): 1,
    }
    assert got["type", "chosen"] == got["missing", "chosen"] == 0


def test_missing_columns_and_other_types_break_every_row(spark):
    got = report(spark.createDataFrame([("1", "P"), ("2", "P")], "row_id string, prompt string"))
    assert got["missing", "chosen"] == got["missing", "rejected"] == got["type", "row_id"] == 2
    assert got["type", "prompt"] == 0 and ("prompt_prefix", "chosen") not in got
    assert set(report(spark.createDataFrame([], FIELDS)).values()) == {0}


def test_lengths_over_limits(spark):
    df = spark.createDataFrame([("a b c", None), ("a", "x y"), ("", "z")], "t string, u string")
    got = {(r.field, r.limit): (r.rows, r.over, r.longest, r.tokens) for r in contracts.length_report(df, ["t", "u"], [1, 2]).collect()}
    assert got == {("t", 1): (3, 1, 3, 4), ("t", 2): (3, 1, 3, 4), ("u", 1): (3, 1, 2, 3), ("u", 2): (3, 0, 2, 3)}
    assert [tuple(r)[2:] for r in contracts.length_report(df.where("false"), ["t"], [5]).collect()] == [(0, 0, 0, 0)]


def test_overlap_of_splits(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k long, t string")
    right = spark.createDataFrame([(3, "c"), (4, "a"), (5, "a"), (6, "")], "k long, t string")
    got = {r.by: (r.shared, r.only) for r in contracts.split_overlap(left, right, "k", "t").collect()}
    assert got == {"key": (1, 3), "text": (3, 1)}
    assert {r.by: (r.shared, r.only) for r in contracts.split_overlap(left, right.where("false"), "k", "t").collect()} == {"key": (0, 0), "text": (0, 0)}


def test_best_against_worst(spark):
    rows = [
        ("g", 1, 0.5, "mid"), ("g", 2, 0.9, "top"), ("g", 3, 0.9, "also top"), ("g", 4, 0.1, "low"), ("g", 5, None, "unrated"),
        ("h", 6, 1.0, "same"), ("h", 7, 1.0, "same too"), ("i", 8, 1.0, None), ("i", 9, 0.0, "x"), ("j", 10, None, "no"), (None, 11, 1.0, "n"), (None, 12, 0.0, "m"),
    ]
    df = spark.createDataFrame(rows, "g string, id long, score double, text string")
    got = sorted((tuple(r) for r in preference.pairs_best_worst(df, ["g"], "score", "id", "text").collect()), key=str)
    assert got == [("g", 2, 4, "top", "low"), ("i", 8, 9, "", "x"), (None, 11, 12, "n", "m")]


@pytest.mark.parametrize("key", ["row_id", ["row_id", "prompt"]])
def test_a_key_may_have_several_columns(spark, key):
    df = spark.createDataFrame([(1, "P", "P a", "P b"), (1, "Q", "Q a", "Q b")], FIELDS)
    rows = contracts.contract_report(df, Contract.of(FIELDS, key)).where("rule = 'repeated_key'").collect()
    assert rows[0].rows == (1 if key == "row_id" else 0)

"""Questions and answers that arrive in files of their own."""

import os

import pytest

from tallyrow.sources.dialogue import instructions_from_turns
from tallyrow.streaming.dialogue import TURNS, stream_instructions, streamed_instructions

TALK = [
    (1, 0, "system", "Be brief."),
    (1, 1, "user", "q1"),
    (1, 2, "assistant", "a1"),
    (1, 3, "user", "q2"),
    (1, 4, "assistant", None),
    (2, 0, "user", None),
    (2, 1, "assistant", "a3"),
    (2, 2, "user", "unanswered"),
    (3, 1, "assistant", "unasked"),
    (3, 5, "user", "q4"),
    (3, 6, "user", "q5"),
    (3, 7, "assistant", "a5"),
    (4, 0, "system", None),
    (4, 1, "user", ""),
    (4, 2, "assistant", ""),
    (None, 0, "user", "nowhere"),
    (None, 1, "assistant", "nowhere"),
    (5, None, "user", "never"),
    (6, 0, None, "nobody"),
]
HOUR = 3600


def store(spark, folder, rows, at):
    """A file of rows that was written at a given second."""
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    spark.createDataFrame(rows, TURNS).coalesce(1).write.mode("append").parquet(str(folder))
    for name in set(os.listdir(folder)) - before:
        os.utime(f"{folder}/{name}", (at, at))


def run(spark, folder, **options):
    stream_instructions(spark, f"{folder}/in", f"{folder}/out", f"{folder}/state", **options).awaitTermination()
    return streamed_instructions(spark, f"{folder}/out")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("order", ["as written", "backwards", "answers first"])
def test_the_stream_equals_the_batch_view_whatever_the_order(spark, tmp_path, order):
    rows = {"as written": TALK, "backwards": TALK[::-1], "answers first": sorted(TALK, key=lambda r: str(r[2]))}[order]
    for i in range(0, len(rows), 5):
        store(spark, tmp_path / "in", rows[i : i + 5], 1_700_000_000 + i)
    want = rows_of(instructions_from_turns(spark.createDataFrame(TALK, TURNS)))
    assert len(want) == 5
    assert rows_of(run(spark, tmp_path, files_per_batch=1)) == want


def test_an_answer_of_a_later_run_meets_its_question_once(spark, tmp_path):
    store(spark, tmp_path / "in", [(1, 1, "user", "q")], 1_700_000_000)
    assert rows_of(run(spark, tmp_path)) == []
    store(spark, tmp_path / "in", [(1, 2, "assistant", "a"), (1, 0, "system", "s")], 1_700_000_000 + HOUR)
    for _ in range(2):
        assert rows_of(run(spark, tmp_path)) == [(1, 1, "q", "s", "a")]


def test_halves_further_apart_than_the_wait_are_no_pair(spark, tmp_path):
    start = 1_700_000_000
    store(spark, tmp_path / "in", [(1, 1, "user", "q"), (2, 1, "user", "q"), (3, 2, "assistant", "a")], start)
    store(spark, tmp_path / "in", [(1, 2, "assistant", "a")], start + 2 * HOUR)
    store(spark, tmp_path / "in", [(2, 2, "assistant", "late"), (3, 1, "user", "late")], start + 2 * HOUR + 1)
    assert rows_of(run(spark, tmp_path, wait="2 hours", files_per_batch=1)) == [(1, 1, "q", "", "a")]


def test_state_is_dropped_after_the_wait(spark, tmp_path):
    start = 1_700_000_000
    store(spark, tmp_path / "in", [(i, 1, "user", "q") for i in range(50)], start)
    for i in range(1, 5):
        store(spark, tmp_path / "in", [(100 + i, 1, "user", "q")], start + 3 * HOUR * i)
    query = stream_instructions(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state", wait="1 hour", files_per_batch=1)
    query.awaitTermination()
    held = [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in query.recentProgress if p["stateOperators"]]
    assert max(held) >= 50 and held[-1] < 5


def test_a_repeated_turn_is_refused(spark, tmp_path):
    store(spark, tmp_path / "in", [(1, 1, "user", "q"), (1, 2, "assistant", "a")], 1_700_000_000)
    store(spark, tmp_path / "in", [(1, 2, "assistant", "another")], 1_700_000_060)
    with pytest.raises(Exception, match="more than once"):
        run(spark, tmp_path).collect()


def test_no_turns(spark, tmp_path):
    store(spark, tmp_path / "in", [], 1_700_000_000)
    found = run(spark, tmp_path)
    assert found.columns == ["conv_id", "turn", "instruction", "input", "output"] and found.collect() == []

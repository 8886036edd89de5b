import pytest

from tallyrow.operators import preference, templates
from tallyrow.sources.dialogue import instructions_from_turns

PROMPT_A = "### Instruction:\nA\n\n### Input:\n\n\n### Response:"


def column(df, name):
    return {r["row_id"]: r[name] for r in df.collect()}


def test_sft_text_of_empty_and_null_input(instructions):
    texts = column(templates.format_sft(instructions), "text")
    assert texts[0] == texts[1] == PROMPT_A + "\nB"


def test_sft_keeps_the_other_columns(instructions):
    assert templates.format_sft(instructions).columns == [*instructions.columns, "text"]


def test_padded_style_adds_one_newline_on_both_sides(instructions):
    plain = column(templates.format_sft(instructions), "text")
    padded = column(templates.format_sft(instructions, "padded"), "text")
    assert padded == {k: f"\n{v}\n" for k, v in plain.items()}


def test_unknown_style_is_refused(instructions):
    with pytest.raises(ValueError):
        templates.format_sft(instructions, "other")


def test_prompt_has_no_newline_after_the_response_header(instructions):
    assert column(templates.build_prompt(instructions), "prompt")[0] == PROMPT_A


def test_inference_prompt_ends_with_a_newline(instructions):
    expected = "### Instruction:\nName the capital\n\n### Input:\nOf Norway\n\n### Response:\n"
    assert column(templates.build_prompt(instructions, "\n"), "prompt")[2] == expected


def test_dpo_pairs_leave_the_prompt_out(instructions):
    row = preference.dpo_pairs(instructions).where("row_id = 0").first()
    assert row.asDict() == {
        "row_id": 0,
        "prompt": PROMPT_A,
        "chosen": " This response is more helpful and complete.",
        "rejected": " This response is shorter and less detailed.",
    }


def test_reward_pairs_open_with_the_prompt(instructions):
    row = preference.reward_pairs(instructions).where("row_id = 0").first()
    assert (row.prompt, row.chosen) == (PROMPT_A, PROMPT_A + " B")
    assert row.rejected == PROMPT_A + " I don't know, figure it out yourself."


def test_reward_pairs_without_prompt(instructions):
    row = preference.reward_pairs(instructions, include_prompt=False).where("row_id = 0").first()
    assert (row.chosen, row.rejected) == (" B", " I don't know, figure it out yourself.")


def test_value_examples_are_two_rows_each(instructions):
    rows = preference.value_examples(instructions).where("row_id = 0").orderBy("label").collect()
    assert [(r.text, r.label) for r in rows] == [
        (PROMPT_A + " I don't know, figure it out yourself.", 0.0),
        (PROMPT_A + " B", 1.0),
    ]


def test_value_examples_scan_once(instructions):
    plan = preference.value_examples(instructions)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("Generate") == 1


MESSAGES = "id bigint, messages array<struct<role:string,content:string>>"


def test_chat_prompt_of_a_message_list(spark):
    df = spark.createDataFrame([(1, [("user", "Hi"), ("assistant", "Yo")])], MESSAGES)
    expected = "<|im_start|>user\nHi<|im_end|>\n<|im_start|>assistant\nYo<|im_end|>\n"
    assert templates.chat_prompt(df, add_generation_prompt=False).first().prompt == expected
    assert templates.chat_prompt(df).first().prompt == expected + "<|im_start|>assistant\n"


def test_default_system_only_where_there_is_none(spark):
    df = spark.createDataFrame([(1, [("user", "Hi")]), (2, [("system", "S"), ("user", "Hi")])], MESSAGES)
    rows = {r.id: r.prompt for r in templates.chat_prompt(df, default_system="D").collect()}
    assert rows[1].startswith("<|im_start|>system\nD<|im_end|>\n<|im_start|>user\nHi")
    assert rows[2].startswith("<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nHi")


TURNS = "conv_id bigint, turn bigint, role string, text string"


def test_chat_from_turns_equals_the_message_list(spark):
    turns = spark.createDataFrame([(1, 1, "assistant", "Yo"), (1, 0, "user", "Hi"), (2, 0, "user", None)], TURNS)
    rows = {r.conv_id: r.prompt for r in templates.chat_prompt_from_turns(turns).collect()}
    lists = spark.createDataFrame([(1, [("user", "Hi"), ("assistant", "Yo")]), (2, [("user", None)])], MESSAGES)
    assert rows == {r.id: r.prompt for r in templates.chat_prompt(lists).collect()}


def test_a_long_conversation_is_one_row_whatever_the_block(spark):
    rows = [(1, t, "user", f"m{t}") for t in range(25)] + [(2, 0, "user", "x"), (3, 5000, "user", "y"), (3, 4999, None, None)]
    turns = spark.createDataFrame(rows, TURNS)
    whole = sorted((r.conv_id, r.prompt) for r in templates.chat_prompt_from_turns(turns).collect())
    assert [c for c, _ in whole] == [1, 2, 3]
    assert whole[0][1].count("<|im_start|>") == 26 and whole[0][1].endswith("assistant\n")
    for block in (1, 4, 25):
        assert sorted((r.conv_id, r.prompt) for r in templates.chat_prompt_from_turns(turns, block_turns=block).collect()) == whole


def test_instructions_need_an_answer_in_the_next_turn(spark):
    turns = [
        (1, 0, "system", "S"), (1, 1, "user", "q1"), (1, 2, "assistant", "a1"), (1, 3, "user", "q2"),
        (2, 0, "user", "q3"), (2, 1, "assistant", "a3"), (2, 2, "user", "q4"), (2, 4, "assistant", "late"),
        (3, 0, "user", "q5"), (3, 1, "user", "q6"), (3, 2, "assistant", None),
    ]
    rows = instructions_from_turns(spark.createDataFrame(turns, TURNS)).collect()
    assert sorted(tuple(r) for r in rows) == [
        (1, 1, "q1", "S", "a1"),
        (2, 0, "q3", "", "a3"),
        (3, 1, "q6", "", ""),
    ]


@pytest.mark.parametrize("again", [(1, 1, "user", "other"), (1, 2, "assistant", "other"), (1, 2, "assistant", "a1")])
def test_repeated_turns_are_refused(spark, again):
    """Two questions or answers at one turn have no one pair; no text is chosen in silence."""
    turns = [(1, 1, "user", "q1"), (1, 2, "assistant", "a1"), (2, 1, "user", "q2"), (2, 2, "assistant", "a2"), again]
    with pytest.raises(Exception, match="more than once: conversation 1, turn 1"):
        instructions_from_turns(spark.createDataFrame(turns, TURNS)).collect()


def test_turns_without_a_place_are_left_out(spark):
    turns = [(None, 1, "user", "q"), (None, 2, "assistant", "a"), (1, None, "user", "q"), (1, None, "assistant", "a"), (1, 1, "user", "q1"), (1, 2, "assistant", None)]
    rows = instructions_from_turns(spark.createDataFrame(turns, TURNS)).collect()
    assert [tuple(r) for r in rows] == [(1, 1, "q1", "", "")]

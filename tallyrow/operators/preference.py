"""Preference pairs and value-regression rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrow.functions.ordering import check_key
from tallyrow.functions.text import text_or_empty
from tallyrow.operators.templates import build_prompt
from tallyrow.session import written

# The synthetic responses, leading space included where there is one.
HELPFUL_RESPONSE = " This response is more helpful and complete."
SHORT_RESPONSE = " This response is shorter and less detailed."
REFUSAL = "I don't know, figure it out yourself."


def _others(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in ("instruction", "input", "output")]


def dpo_pairs(df: DataFrame, chosen: str = HELPFUL_RESPONSE, rejected: str = SHORT_RESPONSE) -> DataFrame:
    """prompt / chosen / rejected, the completions without the prompt."""
    return build_prompt(df).select(
        *_others(df), "prompt", F.lit(chosen).alias("chosen"), F.lit(rejected).alias("rejected")
    )


def reward_pairs(df: DataFrame, rejected: str = REFUSAL, include_prompt: bool = True) -> DataFrame:
    """prompt / chosen / rejected from the real answer and a refusal.

    Both texts open with the prompt; ``include_prompt=False`` leaves it to the
    ``prompt`` column, for consumers that put it in front themselves.
    """
    lead = F.col("prompt") if include_prompt else F.lit("")
    return build_prompt(df).select(
        *_others(df),
        "prompt",
        F.concat(lead, F.lit(" "), text_or_empty("output")).alias("chosen"),
        F.concat(lead, F.lit(" " + rejected)).alias("rejected"),
    )


def value_examples(df: DataFrame, bad: str = REFUSAL, keep_prompt: bool = False) -> DataFrame:
    """Two (text, label) rows per instruction, 1.0 for the answer and 0.0 for the
    refusal, generated from one scan."""
    good_text = F.concat("prompt", F.lit(" "), text_or_empty("output"))
    bad_text = F.concat("prompt", F.lit(" " + bad))
    rows = F.array(
        F.struct(good_text.alias("text"), F.lit(1.0).alias("label")),
        F.struct(bad_text.alias("text"), F.lit(0.0).alias("label")),
    )
    kept = [*_others(df), *(["prompt"] if keep_prompt else [])]
    return build_prompt(df).select(*kept, F.inline(rows))


def pairs_best_worst(
    rated: DataFrame, group: Sequence[str], score: str, key: str, response: str, texts: DataFrame | None = None
) -> DataFrame:
    """(group, chosen_id, rejected_id, chosen, rejected): of each group's rated responses the best against the worst.

    Ties go to the smaller key. Groups whose scores are all equal give no pair;
    unrated rows do not count. Null or repeated keys are refused. One aggregation over
    narrow rows finds the ids, which then fetch their texts from ``texts`` (key, response;
    ``rated`` unless given): no group is gathered.
    """
    known = written(rated.where(F.col(score).isNotNull()).select(*group, score, key), "rated")
    check_key(known, key)
    ends = known.groupBy(*group).agg(
        F.max(F.struct(F.col(score).alias("_score"), (-F.col(key)).alias("_id"))).alias("_best"),
        F.min(F.struct(F.col(score).alias("_score"), F.col(key).alias("_id"))).alias("_worst"),
    )
    pairs = ends.where("_best._score > _worst._score").select(*group, (-F.col("_best._id")).alias("chosen_id"), F.col("_worst._id").alias("rejected_id"))
    return fetched(pairs, texts if texts is not None else rated, key, response).select(*group, "chosen_id", "rejected_id", "chosen", "rejected")


def fetched(pairs: DataFrame, texts: DataFrame, key: str, response: str) -> DataFrame:
    """``pairs`` of chosen_id and rejected_id with the two texts; a null text is empty."""
    side = lambda name: texts.select(F.col(key).alias(f"{name}_id"), F.coalesce(response, F.lit("")).alias(name))
    return pairs.join(side("chosen"), "chosen_id").join(side("rejected"), "rejected_id")

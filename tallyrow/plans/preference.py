"""DPO: both models' scores of each pair, its implicit rewards and loss."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrow.functions.keys import Key, key_columns
from tallyrow.operators.lm import BigramModel, sequence_logprobs
from tallyrow.operators.objectives import dpo_terms
from tallyrow.operators.per_token import token_logprobs
from tallyrow.operators.tokens import Vocabulary, tokenize
from tallyrow.session import written
from tallyrow.sources.tables import spread

SIDES = ("chosen", "rejected")

# The last word of a text, tried at the beginnings of words alone, without giving back what it took.
LAST_WORD = r"(?<![^ \n\t\r])([^ \n\t\r]++)[ \n\t\r]*+$"


def completion_ids(rows: DataFrame, key: Key, vocab: Vocabulary, completion: str = "completion") -> DataFrame:
    """(key, input_ids, _first) of each completion, stored; ``_first`` is its prompt's last token."""
    last = rows.withColumn("_last", F.regexp_extract(F.coalesce("prompt", F.lit("")), LAST_WORD, 1))
    ids = tokenize(tokenize(last, vocab, completion), vocab, "_last", name="_last_id").select(
        *key_columns(key), "input_ids", F.coalesce(F.get("_last_id", F.lit(0)), F.lit(vocab.specials.eos)).alias("_first")
    )
    return spread(written(ids, "completion-ids"))


def completion_logprobs(
    rows: DataFrame, key: Key, vocab: Vocabulary, policy: BigramModel, reference: BigramModel, completion: str = "completion"
) -> DataFrame:
    """(key, policy_logprob, reference_logprob, n_tokens) of each completion, read on from its prompt's last token."""
    ids = completion_ids(rows, key, vocab, completion)
    return sequence_logprobs(ids, {"policy": policy, "reference": reference}, key, first=F.col("_first"))


def completion_token_logprobs(
    rows: DataFrame, key: Key, vocab: Vocabulary, policy: BigramModel, reference: BigramModel, completion: str = "completion"
) -> DataFrame:
    """(key, policy_logprobs, reference_logprobs): the same token by token."""
    ids = completion_ids(rows, key, vocab, completion)
    return token_logprobs(ids, {"policy": policy, "reference": reference}, key, first=F.col("_first"))


def score_pairs(
    pairs: DataFrame, key: Key, vocab: Vocabulary, policy: BigramModel, reference: BigramModel, beta: float = 0.1
) -> DataFrame:
    """Per pair: policy_chosen, ..., margin and loss.

    ``pairs`` has prompt, chosen, rejected, the completions without the prompt.
    """
    names = key_columns(key)
    sides = F.array(*(F.struct(F.lit(s).alias("_side"), F.col(s).alias("completion")) for s in SIDES))
    rows = pairs.select(*names, "prompt", F.inline(sides))
    scored = completion_logprobs(rows, [*names, "_side"], vocab, policy, reference)
    # Two rows per pair.
    columns = [
        F.max(F.when(F.col("_side") == side, F.col(f"{model}_logprob"))).alias(f"{model}_{side}")
        for model in ("policy", "reference")
        for side in SIDES
    ]
    return dpo_terms(scored.groupBy(*names).agg(*columns), beta)

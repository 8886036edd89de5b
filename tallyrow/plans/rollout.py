"""PPO and GRPO: fit the reward and value models, then score a table of completions."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from tallyrow.functions.keys import key_columns
from tallyrow.operators.lm import BigramModel
from tallyrow.operators.objectives import group_advantage, kl_reward, value_advantage
from tallyrow.operators.reward import fit_reward, fit_value, score_reward, score_value
from tallyrow.operators.rollouts import attach_completions, completion_text
from tallyrow.operators.tokens import Vocabulary
from tallyrow.plans.files import read_file
from tallyrow.plans.preference import completion_logprobs
from tallyrow.session import written

SEQUENCE = ("prompt_id", "gen_id")


def fit_models(spark: SparkSession, folder: str, key_schema: str, with_value: bool = True):
    """Reward model from the pairs file and, for PPO, the value model from the value file on top of it."""
    reward_model = fit_reward(read_file(spark, folder, "reward_pairs", key_schema), f"{folder}/reward_model")
    if not with_value:
        return reward_model, None
    examples = read_file(spark, folder, "value_data", key_schema)
    return reward_model, fit_value(examples, reward_model, f"{folder}/value_model")


def score_groups(prompts: DataFrame, completions: DataFrame, reward_model: PipelineModel) -> DataFrame:
    """GRPO: each completion's reward and its advantage within its prompt's group."""
    rows = score_reward(reward_model, attach_completions(prompts, completions))
    return group_advantage(written(rows.select(*SEQUENCE, "reward"), "rewards"))


def score_sequences(
    prompts: DataFrame,
    completions: DataFrame,
    reward_model: PipelineModel,
    value_model: PipelineModel,
    vocab: Vocabulary,
    policy: BigramModel,
    reference: BigramModel,
    beta: float = 0.05,
) -> DataFrame:
    """PPO: each completion's reward, value, KL-penalised reward and advantage."""
    keys = key_columns(SEQUENCE)
    rows = written(completion_text(attach_completions(prompts, completions)), "rollouts")
    rewards = score_reward(reward_model, rows).select(*keys, "reward")
    values = score_value(value_model, reward_model, rows).select(*keys, "value")
    logprobs = completion_logprobs(rows, keys, vocab, policy, reference)
    penalised = kl_reward(rewards.join(logprobs, keys), beta)
    total = penalised.select(*keys, "kl", penalised["reward"].alias("raw_reward"), penalised["kl_reward"].alias("reward"))
    return value_advantage(total, values, keys)

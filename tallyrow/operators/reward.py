"""Reward and value models on MLlib, and the metrics of their scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrow.functions.text import shared_words, words
from tallyrow.operators.rollouts import without_prompt
from tallyrow.session import scratch_path, written

HASH_BUCKETS = 1024


def _features(asked: Column, said: Column) -> Column:
    """(words, length, overlap) of a response, from the words of prompt and response.

    The prompt's own words are left out: they are the same on both sides of a
    pair and would cancel. Overlap with them is what tells responses apart.
    """
    return F.struct(
        said.alias("words"),
        F.log1p(F.size(said)).alias("length"),
        F.log1p(shared_words(asked, said)).alias("overlap"),
    )


def response_features(df: DataFrame, prompt: str = "prompt", response: str = "response") -> DataFrame:
    """Adds n_words and n_shared: response words, and distinct ones shared with the prompt."""
    split = df.select("*", words(F.col(prompt)).alias("_asked"), words(F.col(response)).alias("_said"))
    return split.select(
        *df.columns,
        F.size("_said").alias("n_words"),
        shared_words(F.col("_asked"), F.col("_said")).alias("n_shared"),
    )


def linear_score(df: DataFrame, weights: Mapping[str, float], name: str = "reward") -> DataFrame:
    """Adds the weighted sum of numeric columns."""
    total = F.lit(0.0)
    for column, weight in weights.items():
        total = total + F.col(column) * F.lit(float(weight))
    return df.withColumn(name, total)


def _unpack(side: str, features: Column) -> list[Column]:
    return [features[part].alias(f"{side}_{part}") for part in ("words", "length", "overlap")]


def _side_stages(side: str, buckets: int) -> tuple[list, list[str]]:
    tf = HashingTF(inputCol=f"{side}_words", outputCol=f"{side}_tf", numFeatures=buckets, binary=True)
    return [tf], [f"{side}_tf", f"{side}_length", f"{side}_overlap"]


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Loads a saved reward or value model (needs an active session)."""
    return PipelineModel.load(path)


def _saved(model: PipelineModel, path: str) -> PipelineModel:
    """Saves a model and returns it as loaded. A freshly fitted one carries its
    training summary, and with it the session, into every scoring task."""
    save_model(model, path)
    return load_model(path)


def fit_reward(
    pairs: DataFrame, path: str | None = None, buckets: int = HASH_BUCKETS, reg: float = 0.01, max_iter: int = 50, rows: DataFrame | None = None
) -> PipelineModel:
    """Bradley-Terry fit: P(chosen over rejected) = sigma(score(chosen) - score(rejected)).

    The model is saved to ``path``, a fresh one below the shared folder unless given.

    Both sides' features go side by side into a logistic regression without
    intercept, each pair once in either order. By that symmetry the optimum
    gives the two sides opposite weights, so the model is a difference of scores.
    ``rows`` are the pairs' `stored_pair_rows` where they are used again.
    """
    rows = stored_pair_rows(pairs, buckets) if rows is None else rows
    regression = LogisticRegression(
        featuresCol="features", labelCol="label", fitIntercept=False, regParam=reg, maxIter=max_iter, standardization=False, tol=1e-9
    )
    model = PipelineModel([*_pair_stages(buckets), regression.fit(rows)])
    return _saved(model, path or scratch_path(pairs.sparkSession, "reward-model"))


def _pair_stages(buckets: int) -> list:
    stages_a, inputs_a = _side_stages("a", buckets)
    stages_b, inputs_b = _side_stages("b", buckets)
    return [*stages_a, *stages_b, VectorAssembler(inputCols=inputs_a + inputs_b, outputCol="features")]


def _value_stages(buckets: int) -> list:
    stages, inputs = _side_stages("v", buckets)
    return [*stages, VectorAssembler(inputCols=[*inputs, "reward_score"], outputCol="features")]


def _stored_features(stages: list, rows: DataFrame, label: str) -> DataFrame:
    return written(PipelineModel(stages).transform(rows).select("features", "label"), label)


def stored_pair_rows(pairs: DataFrame, buckets: int = HASH_BUCKETS) -> DataFrame:
    """Features and labels that the reward model is fitted on, made once: MLlib reads them more than once."""
    return _stored_features(_pair_stages(buckets), _pair_rows(pairs), "pair-rows")


def _pair_rows(pairs: DataFrame) -> DataFrame:
    """Both sides' features of each pair in either order, with the label that the first is the chosen one."""
    prompt = F.col("prompt")
    split = pairs.select(
        words(prompt).alias("_asked"),
        words(without_prompt(F.col("chosen"), prompt)).alias("_chosen"),
        words(without_prompt(F.col("rejected"), prompt)).alias("_rejected"),
    )
    chosen = _features(F.col("_asked"), F.col("_chosen"))
    rejected = _features(F.col("_asked"), F.col("_rejected"))
    both_orders = F.array(
        F.struct(chosen.alias("a"), rejected.alias("b"), F.lit(1.0).alias("label")),
        F.struct(rejected.alias("a"), chosen.alias("b"), F.lit(0.0).alias("label")),
    )
    return split.select(F.inline(both_orders)).select(*_unpack("a", F.col("a")), *_unpack("b", F.col("b")), "label")


def _slope(scored: DataFrame, error: Column, weights: Sequence[float], reg: float, standardized: bool) -> tuple[int, float]:
    """(rows, largest entry) of the penalised loss's gradient: mean of error times features, plus the penalty's share.

    Positive and negative errors are summed apart, as weights of a summary: a few vectors reach the driver.
    ``standardized`` penalties weigh each feature by its variance.
    """
    if scored.isEmpty():
        return 0, 0.0
    parts = {s: F.greatest(F.lit(0.0), F.lit(float(s)) * error) for s in (1, -1)}
    found = scored.agg(
        F.count(F.lit(1)).alias("n"),
        Summarizer.variance(F.col("features")).alias("variance"),
        *(Summarizer.sum(F.col("features"), part).alias(f"side{s}") for s, part in parts.items()),
    ).first()
    n = found["n"]
    up, down = found["side1"].toArray(), found["side-1"].toArray()
    scale = found["variance"].toArray() * (n - 1) / n if standardized else 1.0
    return n, float(np.abs((up - down) / n + reg * scale * np.asarray(weights)).max())


def reward_slope(model: PipelineModel, pairs: DataFrame, reg: float = 0.01, rows: DataFrame | None = None) -> tuple[int, float]:
    """(rows, largest entry of the gradient) of the reward fit's loss at the fitted weights: at its minimum every entry is 0."""
    scored = (model.transform(_pair_rows(pairs)) if rows is None else model.stages[-1].transform(rows)).withColumn("_p", vector_to_array("probability")[1])
    return _slope(scored, F.col("_p") - F.col("label"), model.stages[-1].coefficients.toArray(), reg, False)


def value_slope(
    model: PipelineModel, reward_model: PipelineModel, examples: DataFrame, reg: float = 0.01, rows: DataFrame | None = None
) -> tuple[int, float]:
    """The same of the value regression, whose penalty MLlib divides by the deviation of the labels."""
    scored = model.transform(_value_rows(examples, reward_model)) if rows is None else model.stages[-1].transform(rows)
    reg /= scored.agg(F.stddev_pop("label")).first()[0] or 1.0
    return _slope(scored, F.col("prediction") - F.col("label"), model.stages[-1].coefficients.toArray(), reg, True)


def score_reward(
    model: PipelineModel, df: DataFrame, prompt: str = "prompt", completion: str = "completion", name: str = "reward"
) -> DataFrame:
    """Adds the reward of each completion: its margin over saying nothing, whose features are all 0."""
    nothing = F.struct(
        F.array().cast("array<string>").alias("words"), F.lit(0.0).alias("length"), F.lit(0.0).alias("overlap")
    )
    split = df.select("*", words(F.col(prompt)).alias("_asked"), words(F.col(completion)).alias("_said"))
    features = _features(F.col("_asked"), F.col("_said"))
    rows = split.select(*df.columns, *_unpack("a", features), *_unpack("b", nothing))
    return model.transform(rows).select(*df.columns, vector_to_array("rawPrediction")[1].alias(name))


def fit_value(
    examples: DataFrame,
    reward_model: PipelineModel,
    path: str | None = None,
    buckets: int = HASH_BUCKETS,
    reg: float = 0.01,
    max_iter: int = 50,
    rows: DataFrame | None = None,
) -> PipelineModel:
    """Regression of ``label`` on the response, started from the reward model.

    ``examples`` has prompt, text, label. The reward score is one of the
    features, so the fit only learns what the reward leaves open. ``rows`` are the
    examples' `stored_value_rows` where they are used again.
    """
    rows = stored_value_rows(examples, reward_model, buckets) if rows is None else rows
    regression = LinearRegression(featuresCol="features", labelCol="label", regParam=reg, maxIter=max_iter)
    model = PipelineModel([*_value_stages(buckets), regression.fit(rows)])
    return _saved(model, path or scratch_path(examples.sparkSession, "value-model"))


def stored_value_rows(examples: DataFrame, reward_model: PipelineModel, buckets: int = HASH_BUCKETS) -> DataFrame:
    """The same of the value model."""
    return _stored_features(_value_stages(buckets), _value_rows(examples, reward_model), "value-rows")


def _value_rows(df: DataFrame, reward_model: PipelineModel) -> DataFrame:
    response = without_prompt(F.col("text"), F.col("prompt"))
    scored = score_reward(reward_model, df.withColumn("_response", response), "prompt", "_response", "reward_score")
    split = scored.select("*", words(F.col("prompt")).alias("_asked"), words(F.col("_response")).alias("_said"))
    features = _features(F.col("_asked"), F.col("_said"))
    return split.select(*df.columns, "reward_score", *_unpack("v", features))


def score_value(model: PipelineModel, reward_model: PipelineModel, df: DataFrame, name: str = "value") -> DataFrame:
    """Adds the value of each (prompt, text) row."""
    scored = model.transform(_value_rows(df, reward_model))
    return scored.select(*df.columns, F.col("prediction").alias(name))


def fitted_values(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """(label, value) of the examples whose `stored_value_rows` are given."""
    return model.stages[-1].transform(rows).select("label", F.col("prediction").alias("value"))


def preference_metrics(df: DataFrame, chosen: str = "chosen_score", rejected: str = "rejected_score") -> DataFrame:
    """One row: pairs, share of pairs whose chosen side scores higher, mean margin."""
    margin = F.col(chosen) - F.col(rejected)
    return df.agg(
        F.count(F.lit(1)).alias("pairs"),
        F.avg(F.when(margin > 0, 1.0).otherwise(0.0)).alias("accuracy"),
        F.avg(margin).alias("margin"),
    )


def value_metrics(df: DataFrame, prediction: str = "value", label: str = "label") -> DataFrame:
    """One row: rows and mean squared error."""
    error = F.col(prediction) - F.col(label)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.avg(error * error).alias("mse"))

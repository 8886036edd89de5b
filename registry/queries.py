"""The registered queries: each runs one operator over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrow.functions.ordering import with_ordinal, with_shuffled_position
from tallyrow.operators import batching, contracts, intervals, leakage, lm, objectives, pairing, per_token, preference, reports, reward, rollouts, slices, templates, tokens
from tallyrow.plans.files import FILES, write_files
from tallyrow.plans.preference import completion_logprobs, completion_token_logprobs, score_pairs
from tallyrow.plans.rollout import score_groups, score_sequences
from tallyrow.session import scratch_path, written
from tallyrow.sources import export, lines, sinks, tables
from tallyrow.sources.dialogue import KEY, instructions_from_turns
from tallyrow.streaming import dialogue

Query = Callable[[SparkSession, str], DataFrame]

VOCAB_WORDS = 8192
SEED = 42
GENERATIONS = 4
N_TRAIN, N_VAL = 150, 50
# Share of the rows that train where a query splits the whole table.
TRAIN_PERCENT = 75
# Words of a passage that training and held-out texts may share.
PASSAGE_WORDS = 4
# Pairs drawn from each group of rated documents; the share of all rows that makes a group a large one.
PAIRS_PER_GROUP = 4
GROUP_SHARE = 0.03
# Weights of the reward that the SQL side can compute as well.
REWARD_WEIGHTS = {"n_words": 0.01, "n_shared": 0.1}
VALUE_WEIGHTS = {"n_words": 0.005, "n_shared": 0.05}

PAIR_COLUMNS = (*KEY, "prompt", "chosen", "rejected")
SEQUENCE = ("prompt_id", "gen_id")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


def instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return instructions_from_turns(table(spark, sf_dir, "conversations"))


def stored_instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The instructions as a table of their own, for queries that read them more than once."""
    return written(instructions(spark, sf_dir), "instructions")


def sft(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.format_sft(instructions(spark, sf_dir))


def vocabulary(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> tokens.Vocabulary:
    """The vocabulary of the training texts of ``rows``, the instructions unless given (stored ones where they are read again)."""
    texts = sft(spark, sf_dir) if rows is None else templates.format_sft(rows)
    return tokens.load_vocab(tokens.fit_vocab(texts, "text", VOCAB_WORDS))


def joined(ids: str, name: str | None = None):
    """Arrays as text, so that both engines hash them alike."""
    return F.array_join(F.col(ids).cast("array<string>"), ",").alias(name or ids)


def completions(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Prompts and the completions table a generator would have returned.

    Prompts stand in a ring in md5 order; generation g of a prompt is the answer
    given g places further on.
    """
    asked = templates.build_prompt(instructions(spark, sf_dir) if rows is None else rows).select(*KEY, "prompt", "output")
    ring = written(with_shuffled_position(asked, list(KEY), SEED, name="prompt_id"), "ring")
    prompts = ring.select("prompt_id", "prompt")
    count = ring.count()
    wanted = rollouts.fan_out(ring.select("prompt_id"), GENERATIONS)
    answers = ring.select(
        F.col("prompt_id").alias("_place"), F.concat(F.lit(" "), F.col("output")).alias("completion")
    )
    place = (F.col("prompt_id") + F.col("gen_id")) % F.lit(max(count, 1))
    given = wanted.withColumn("_place", place).join(answers, "_place").drop("_place")
    return prompts, given


def scored_completions(spark: SparkSession, sf_dir: str, *kept: str, rows: DataFrame | None = None) -> DataFrame:
    """Sequence key, reward, value and the columns named, stored: every use reads it more than once."""
    given = rollouts.attach_completions(*completions(spark, sf_dir, rows))
    featured = reward.response_features(given, "prompt", "completion")
    scored = reward.linear_score(reward.linear_score(featured, REWARD_WEIGHTS), VALUE_WEIGHTS, "value")
    return written(scored.select(*SEQUENCE, "reward", "value", *kept), "scored")


def language_models(spark: SparkSession, sf_dir: str, rows: DataFrame):
    """(vocabulary, policy model of the training texts of ``rows``, reference model of the documents)."""
    vocab = vocabulary(spark, sf_dir, rows)
    policy = lm.fit_bigram(tokens.tokenize(templates.format_sft(rows), vocab, "text"), vocab.size)
    reference = lm.fit_bigram(tokens.tokenize(documents(spark, sf_dir), vocab, "text"), vocab.size)
    return vocab, policy, reference


# ---- sources and sinks ----


def stream_instructions(spark, sf_dir):
    """The turns in files by role, answers first, taken in three batches: a question's answer lies in an earlier one."""
    folder = scratch_path(spark, "turns")
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text")
    for role in ("assistant", "user", "system"):
        turns.where(F.col("role") == role).write.mode("append").parquet(f"{folder}/in")
    files = len(spark.read.parquet(f"{folder}/in").inputFiles())
    taken = dialogue.stream_instructions(spark, f"{folder}/in", f"{folder}/out", f"{folder}/state", files_per_batch=max(1, -(-files // 3)))
    taken.awaitTermination()
    return dialogue.streamed_instructions(spark, f"{folder}/out")


def read_instructions(spark, sf_dir):
    return instructions(spark, sf_dir)


def select_split(spark, sf_dir):
    rows = slices.split_by_share(stored_instructions(spark, sf_dir), KEY, TRAIN_PERCENT)
    path = scratch_path(spark, "splits")
    rows.write.partitionBy(tables.SPLIT_COLUMN).parquet(path)
    schema = "conv_id bigint, turn bigint, instruction string, input string, output string"
    return tables.read_instructions(spark, path, split="validation", schema=schema)


def jsonl_roundtrip(spark, sf_dir):
    pairs = preference.reward_pairs(instructions(spark, sf_dir))
    path = scratch_path(spark, "pairs")
    sinks.write_jsonl(pairs, path)
    schema = "conv_id bigint, turn bigint, prompt string, chosen string, rejected string"
    return tables.read_jsonl(spark, path, schema)


def write_counts(spark, sf_dir):
    counts = write_files(instructions(spark, sf_dir), KEY, scratch_path(spark, "files"), list(FILES), "train")
    return spark.createDataFrame(list(counts.items()), "sink string, rows bigint")


INSTRUCTION = "instruction string, input string, output string"


def read_keyless(spark, sf_dir):
    """Instructions from files without their key, numbered by the place of their lines, less the numbers."""
    path = scratch_path(spark, "keyless")
    sinks.write_jsonl(instructions(spark, sf_dir).select("instruction", "input", "output"), path)
    rows = lines.read_keyless(spark, path, INSTRUCTION, split_bytes=1 << 16)
    return with_ordinal(rows, lines.PLACE).select("instruction", "input", "output")


def export_ordered(spark, sf_dir):
    """Instructions written in key order without their key, with the position their files give them."""
    path = scratch_path(spark, "export")
    export.export_ordered(stored_instructions(spark, sf_dir), KEY, path, ["instruction", "input", "output"])
    export.check_export(spark, path)
    return with_ordinal(export.read_ordered(spark, path, INSTRUCTION), export.ORDER).drop(*export.ORDER)


def to_jsonl(spark, sf_dir):
    rows = instructions(spark, sf_dir).withColumn("_line", sinks.json_line("instruction", "input", "output"))
    parsed = F.from_json("_line", "instruction string, input string, output string").alias("_parsed")
    return rows.select(*KEY, parsed).select(*KEY, "_parsed.*")


def write_modes(spark, sf_dir):
    """Rows in a folder after each mode has written the instructions to it once more."""
    rows = stored_instructions(spark, sf_dir)
    path = scratch_path(spark, "modes")
    found = []
    for mode in ("errorifexists", "append", "overwrite"):
        sinks.write_jsonl(rows, path, mode)
        found.append((mode, tables.read_jsonl(spark, path, rows.schema).count()))
    return spark.createDataFrame(found, "mode string, rows bigint")


# ---- reports ----


PAIR_CONTRACT = contracts.Contract.of(
    "conv_id bigint, turn bigint, prompt string, chosen string, rejected string, score double",
    KEY,
    after_prompt=("chosen", "rejected"),
    completions=("chosen", "rejected"),
)


def contract_report(spark, sf_dir):
    return contracts.contract_report(preference.reward_pairs(stored_instructions(spark, sf_dir)), PAIR_CONTRACT)


RATED_CONTRACT = contracts.Contract.of(
    "doc_id bigint, digest string, text string, quality int", "digest", prompt="source", after_prompt=("text",), completions=("text",)
)


def contract_violations(spark, sf_dir):
    """Documents as rated texts: unrated ones, copies, and texts that do not open with their source's name."""
    docs = table(spark, sf_dir, "documents").withColumn("digest", F.md5("text"))
    rated = docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    found = reports.contract_violations(rated, RATED_CONTRACT)
    return found.groupBy("digest", "rule", "field").agg(F.count(F.lit(1)).alias("rows"))


def group_report(spark, sf_dir):
    return reports.group_report(table(spark, sf_dir, "documents"), "source", GROUP_SHARE)


def length_percentiles(spark, sf_dir):
    rows = sft(spark, sf_dir)
    return reports.length_percentiles(rows, ["instruction", "output", "text"], [50, 90, 99, 100])


def length_report(spark, sf_dir):
    rows = sft(spark, sf_dir)
    return contracts.length_report(rows, ["instruction", "output", "text"], [32, 256, 512])


def split_overlap(spark, sf_dir):
    rows = written(slices.split_by_share(stored_instructions(spark, sf_dir), KEY, TRAIN_PERCENT), "splits")
    train, held_out = tables.select_split(rows, "train"), tables.select_split(rows, "validation")
    return contracts.split_overlap(train, held_out, KEY, "output")


def passage_overlap(spark, sf_dir):
    """Passages of each held-out training text that the training part holds as well."""
    rows = written(slices.split_by_share(stored_instructions(spark, sf_dir), KEY, TRAIN_PERCENT), "splits")
    train, held_out = tables.select_split(rows, "train"), tables.select_split(rows, "validation")
    return leakage.shared_passages(train, held_out, KEY, "output", PASSAGE_WORDS)


# ---- slices ----


def ordinal(spark, sf_dir):
    return with_ordinal(instructions(spark, sf_dir).select(*KEY, "instruction"), KEY)


def slice_head(spark, sf_dir):
    return templates.build_prompt(slices.slice_spec(stored_instructions(spark, sf_dir), "train[:200]", KEY)).select(*KEY, "prompt")


def slice_range(spark, sf_dir):
    return slices.slice_spec(stored_instructions(spark, sf_dir), "train[200:400]", KEY)


def slice_percent(spark, sf_dir):
    return slices.slice_spec(stored_instructions(spark, sf_dir), "train[:10%]", KEY)


def train_val_split(spark, sf_dir):
    return slices.train_val_split(stored_instructions(spark, sf_dir), KEY, N_TRAIN, N_VAL)


# ---- texts and pairs ----


def format_sft(spark, sf_dir):
    return sft(spark, sf_dir)


def format_sft_padded(spark, sf_dir):
    return templates.format_sft(instructions(spark, sf_dir), "padded")


def build_prompt(spark, sf_dir):
    return templates.build_prompt(instructions(spark, sf_dir)).select(*KEY, "prompt")


def build_infer_prompt(spark, sf_dir):
    return templates.build_prompt(instructions(spark, sf_dir), "\n").select(*KEY, "prompt")


def chat_prompt(spark, sf_dir):
    return templates.chat_prompt_from_turns(table(spark, sf_dir, "conversations"))


def dpo_pairs(spark, sf_dir):
    return preference.dpo_pairs(instructions(spark, sf_dir))


def reward_pairs(spark, sf_dir):
    return preference.reward_pairs(instructions(spark, sf_dir))


def value_examples(spark, sf_dir):
    return preference.value_examples(instructions(spark, sf_dir))


def _rated(spark, sf_dir):
    """Documents with their grade, without the texts, and the texts."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", "lang", "source").join(table(spark, sf_dir, "labels"), "doc_id"), docs.select("doc_id", "text")


def pairs_best_worst(spark, sf_dir):
    rated, texts = _rated(spark, sf_dir)
    return preference.pairs_best_worst(rated, ["lang", "source"], "quality", "doc_id", "text", texts)


def pairs_all(spark, sf_dir):
    rated, texts = _rated(spark, sf_dir)
    return pairing.pairs_all(rated, ["lang", "source"], "quality", "doc_id", "text", PAIRS_PER_GROUP, SEED, texts)


# ---- tokens and batches ----


def fit_vocab(spark, sf_dir):
    return tokens.fit_vocab(sft(spark, sf_dir), "text", VOCAB_WORDS)


def tokenize(spark, sf_dir):
    ids = tokens.tokenize(documents(spark, sf_dir), vocabulary(spark, sf_dir), "text")
    return ids.select("doc_id", joined("input_ids"), F.size("input_ids").alias("n_tokens"))


def detokenize(spark, sf_dir):
    vocab = vocabulary(spark, sf_dir)
    ids = tokens.tokenize(documents(spark, sf_dir), vocab, "text")
    return tokens.detokenize(ids.select("doc_id", "input_ids"), vocab, "input_ids").select("doc_id", "text")


def ppo_tokens(spark, sf_dir):
    rows = stored_instructions(spark, sf_dir)
    ids = tokens.prompt_tokens(templates.build_prompt(rows), vocabulary(spark, sf_dir, rows), keep=KEY)
    return ids.select(*KEY, joined("input_ids"))


def value_tokens(spark, sf_dir):
    rows = stored_instructions(spark, sf_dir)
    ids = tokens.value_tokens(preference.value_examples(rows), vocabulary(spark, sf_dir, rows))
    return ids.select(*KEY, joined("input_ids"), joined("attention_mask"), "labels")


def truncate_256(spark, sf_dir):
    ids = tokens.truncate(tokens.tokenize(documents(spark, sf_dir), vocabulary(spark, sf_dir), "text"), "input_ids", 256)
    return ids.select("doc_id", joined("input_ids"), F.size("input_ids").alias("n_tokens"))


def epoch_batches(spark, sf_dir):
    rows = instructions(spark, sf_dir).select(*KEY)
    return batching.assign_batches(rows, KEY, epochs=3, batch_size=4, seed=SEED)


def pad_batches(spark, sf_dir):
    rows = stored_instructions(spark, sf_dir)
    ids = tokens.prompt_tokens(templates.build_prompt(rows), vocabulary(spark, sf_dir, rows), keep=KEY)
    batches = written(batching.assign_batches(ids, KEY, epochs=1, batch_size=4, seed=SEED), "batches")
    padded = batching.pad_batches(batches, "input_ids", "batch_id", KEY, tokens.Specials().pad_id)
    return padded.select(*KEY, "batch_id", joined("input_ids"), joined("attention_mask"))


def pad_own_token(spark, sf_dir):
    """Batches padded with a pad token of their own instead of the end of text."""
    specials = tokens.Specials(eos=0, unk=1, pad=2)
    texts = written(sft(spark, sf_dir), "texts")
    vocab = tokens.load_vocab(tokens.fit_vocab(texts, "text", VOCAB_WORDS, specials), specials)
    ids = tokens.prompt_tokens(templates.build_prompt(texts), vocab, keep=KEY)
    batches = written(batching.assign_batches(ids, KEY, epochs=1, batch_size=4, seed=SEED), "batches")
    padded = batching.pad_batches(batches, "input_ids", "batch_id", KEY, specials.pad_id)
    return padded.select(*KEY, "batch_id", joined("input_ids"), joined("attention_mask"))


def fan_out(spark, sf_dir):
    prompts = templates.build_prompt(instructions(spark, sf_dir)).select(*KEY, "prompt")
    return rollouts.fan_out(prompts, GENERATIONS)


# ---- completions ----


def completion_text(spark, sf_dir):
    return rollouts.completion_text(rollouts.attach_completions(*completions(spark, sf_dir)))


def score_inputs(spark, sf_dir):
    rows = stored_instructions(spark, sf_dir)
    texts = rollouts.completion_text(rollouts.attach_completions(*completions(spark, sf_dir, rows)))
    ids = tokens.truncate(tokens.tokenize(texts, vocabulary(spark, sf_dir, rows), "text"), "input_ids", 512)
    ids = written(ids.select(*SEQUENCE, "input_ids"), "ids")
    padded = batching.pad_batches(ids, "input_ids", "prompt_id", "gen_id", tokens.Specials().pad_id)
    return padded.select(*SEQUENCE, joined("input_ids"), joined("attention_mask"))


def strip_prompt(spark, sf_dir):
    rows = stored_instructions(spark, sf_dir)
    pairs = preference.reward_pairs(rows)
    vocab = vocabulary(spark, sf_dir, rows)
    ids = tokens.tokenize(rollouts.strip_prompt(pairs, "chosen"), vocab, "chosen")
    ids = tokens.tokenize(ids, vocab, "prompt", name="prompt_ids")
    stripped = rollouts.strip_prompt_ids(ids, "input_ids", "prompt_ids")
    return stripped.select(*KEY, "response", joined("response_ids"))


def reward_callback(spark, sf_dir):
    def load():
        return lambda prompts, texts: [len(p) + 2.0 * len(t) for p, t in zip(prompts, texts)]

    rows = rollouts.attach_completions(*completions(spark, sf_dir))
    return rollouts.score_with(rows, load).select(*SEQUENCE, "reward")


def group_advantage(spark, sf_dir):
    rows = objectives.group_advantage(scored_completions(spark, sf_dir))
    return rows.select(*SEQUENCE, F.round("reward", 6).alias("reward"), F.round("advantage", 6).alias("advantage"))


def value_advantage(spark, sf_dir):
    scored = scored_completions(spark, sf_dir)
    rows = objectives.value_advantage(scored.select(*SEQUENCE, "reward"), scored.select(*SEQUENCE, "value"), SEQUENCE)
    return rows.select(*SEQUENCE, *(F.round(c, 6).alias(c) for c in ("reward", "value", "advantage")))


def kl_reward(spark, sf_dir):
    rows = stored_instructions(spark, sf_dir)
    vocab, policy, reference = language_models(spark, sf_dir, rows)
    scored = scored_completions(spark, sf_dir, "prompt", "completion", rows=rows)
    aligned = completion_logprobs(scored, SEQUENCE, vocab, policy, reference)
    rows = objectives.kl_reward(scored.select(*SEQUENCE, "reward").join(aligned, list(SEQUENCE)))
    return rows.select(*SEQUENCE, "n_tokens", *(F.round(c, 5).alias(c) for c in ("reward", "kl", "kl_reward")))


def token_returns(spark, sf_dir):
    """One row per token of every completion: its penalty, its reward and what it and the tokens after it earn."""
    rows = stored_instructions(spark, sf_dir)
    vocab, policy, reference = language_models(spark, sf_dir, rows)
    scored = scored_completions(spark, sf_dir, "prompt", "completion", rows=rows)
    aligned = completion_token_logprobs(scored, SEQUENCE, vocab, policy, reference)
    rows = per_token.token_rewards(scored.select(*SEQUENCE, "reward").join(aligned, list(SEQUENCE)))
    rows = rows.withColumn("earned", per_token.returns("rewards"))
    tokens_ = F.arrays_zip("kl", "rewards", "earned")
    return rows.select(*SEQUENCE, F.posexplode(tokens_).alias("pos", "_t")).select(
        *SEQUENCE, "pos", *(F.round(f"_t.{c}", 4).alias(n) for c, n in (("kl", "kl"), ("rewards", "token_reward"), ("earned", "token_return")))
    )


# ---- models ----


def bigram_fit(spark, sf_dir):
    vocab = vocabulary(spark, sf_dir)
    ids = tokens.tokenize(documents(spark, sf_dir), vocab, "text")
    return lm.fit_bigram(ids, vocab.size).bigrams


def seq_logprob(spark, sf_dir):
    rows = stored_instructions(spark, sf_dir)
    vocab = vocabulary(spark, sf_dir, rows)
    policy = lm.fit_bigram(tokens.tokenize(templates.format_sft(rows), vocab, "text"), vocab.size)
    ids = written(tokens.tokenize(documents(spark, sf_dir), vocab, "text").select("doc_id", "input_ids"), "ids")
    scored = lm.sequence_logprob(ids, policy, "doc_id")
    return scored.select("doc_id", F.round("logprob", 5).alias("logprob"), "n_tokens")


def lm_eval(spark, sf_dir):
    texts = templates.format_sft(slices.split_by_share(stored_instructions(spark, sf_dir), KEY, TRAIN_PERCENT))
    train, held_out = tables.select_split(texts, "train"), tables.select_split(texts, "validation")
    vocab = tokens.load_vocab(tokens.fit_vocab(train, "text", VOCAB_WORDS))
    model = lm.fit_bigram(tokens.tokenize(train, vocab, "text"), vocab.size)
    ids = written(tokens.tokenize(held_out, vocab, "text").select(*KEY, "input_ids"), "ids")
    loss = lm.eval_loss(lm.sequence_logprob(ids, model, KEY))
    return loss.select("sequences", "tokens", F.round("nll", 6).alias("nll"), F.round("perplexity", 2).alias("perplexity"))


def dpo_metrics(spark, sf_dir):
    rows = stored_instructions(spark, sf_dir)
    vocab, policy, reference = language_models(spark, sf_dir, rows)
    pairs = preference.reward_pairs(rows, include_prompt=False)
    metrics = objectives.dpo_summary(score_pairs(pairs, KEY, vocab, policy, reference))
    return metrics.select("pairs", *(F.round(c, 6).alias(c) for c in ("loss", "margin", "accuracy")))


def _scored_pairs(spark, sf_dir):
    """Pairs with a linear score of either side."""
    pairs = preference.reward_pairs(instructions(spark, sf_dir), include_prompt=False)
    for side in ("chosen", "rejected"):
        featured = reward.response_features(pairs, "prompt", side)
        pairs = reward.linear_score(featured, REWARD_WEIGHTS, f"{side}_score").drop("n_words", "n_shared")
    return pairs


def preference_metrics(spark, sf_dir):
    metrics = reward.preference_metrics(_scored_pairs(spark, sf_dir))
    return metrics.select("pairs", F.round("accuracy", 6).alias("accuracy"), F.round("margin", 6).alias("margin"))


# Replicates of a bootstrap.
REPLICATES = 40


def metric_intervals(spark, sf_dir):
    """Accuracy and margin of the scored pairs with 90 percent intervals."""
    pairs = written(_scored_pairs(spark, sf_dir).select(*KEY, "chosen_score", "rejected_score"), "scored-pairs")
    margin = F.col("chosen_score") - F.col("rejected_score")
    metrics = {"accuracy": ((margin > 0).cast("int"), F.lit(1)), "margin": (margin, F.lit(1))}
    found = intervals.ratio_intervals(pairs, KEY, metrics, REPLICATES, 0.9, SEED)
    return found.select("metric", "rows", *(F.round(c, 6).alias(c) for c in ("estimate", "low", "high")))


def value_metrics(spark, sf_dir):
    rows = preference.value_examples(instructions(spark, sf_dir), keep_prompt=True)
    featured = reward.response_features(rollouts.strip_prompt(rows), "prompt", "response")
    metrics = reward.value_metrics(reward.linear_score(featured, VALUE_WEIGHTS, "value"))
    return metrics.select("rows", F.round("mse", 6).alias("mse"))


def _reward_model(rows):
    return reward.fit_reward(preference.reward_pairs(rows))


def reward_fit(spark, sf_dir):
    rows = stored_instructions(spark, sf_dir)
    model = _reward_model(rows)
    pairs = preference.reward_pairs(rows, include_prompt=False)
    for side in ("chosen", "rejected"):
        pairs = reward.score_reward(model, pairs, completion=side, name=f"{side}_score")
    return reward.preference_metrics(pairs)


def reward_scores(spark, sf_dir):
    rows = stored_instructions(spark, sf_dir)
    given = rollouts.attach_completions(*completions(spark, sf_dir, rows))
    return reward.score_reward(_reward_model(rows), given).select(*SEQUENCE, "reward")


def model_roundtrip(spark, sf_dir):
    """How far scores of the saved reward model, vocabulary and language model are from those of the fitted ones.

    Prompts and completions are put together and read once, by both sides: only keys, rewards and ids are stored.
    """
    rows = stored_instructions(spark, sf_dir)
    path = scratch_path(spark, "models")
    fitted = reward.fit_reward(preference.reward_pairs(rows), f"{path}/reward")
    texts = templates.format_sft(rows)
    vocab = tokens.load_vocab(written(tokens.fit_vocab(texts, "text", VOCAB_WORDS), "vocab"))
    tokens.save_vocab(vocab, f"{path}/vocab")
    policy = lm.fit_bigram(tokens.tokenize(texts, vocab, "text"), vocab.size, f"{path}/policy", add_k=0.25)
    sides = {
        "a": (fitted, vocab, policy),
        "b": (reward.load_model(f"{path}/reward"), tokens.read_vocab(spark, f"{path}/vocab"), lm.BigramModel.load(spark, f"{path}/policy")),
    }
    both = rollouts.attach_completions(*completions(spark, sf_dir, rows))
    for name, (model, words, _) in sides.items():
        both = tokens.tokenize(reward.score_reward(model, both, name=f"{name}_reward"), words, "completion", name=f"{name}_ids")
    both = scored = written(both.select(*SEQUENCE, *(f"{name}_{c}" for name in sides for c in ("reward", "ids"))), "scored")
    for name, (_, _, language) in sides.items():
        logprobs = lm.sequence_logprobs(scored, {name: language}, SEQUENCE, f"{name}_ids").select(*SEQUENCE, f"{name}_logprob")
        both = both.join(logprobs, list(SEQUENCE))
    return both.select(*SEQUENCE, *(F.abs(F.col(f"a_{c}") - F.col(f"b_{c}")).alias(f"{c}_difference") for c in ("reward", "logprob")))


def _value_model(rows):
    reward_model = _reward_model(rows)
    examples = preference.value_examples(rows, keep_prompt=True)
    return reward.fit_value(examples, reward_model), reward_model, examples


def value_fit(spark, sf_dir):
    value_model, reward_model, examples = _value_model(stored_instructions(spark, sf_dir))
    return reward.value_metrics(reward.score_value(value_model, reward_model, examples))


def value_scores(spark, sf_dir):
    rows = stored_instructions(spark, sf_dir)
    value_model, reward_model, _ = _value_model(rows)
    texts = rollouts.completion_text(rollouts.attach_completions(*completions(spark, sf_dir, rows)))
    return reward.score_value(value_model, reward_model, texts).select(*SEQUENCE, "value")


# Share of the pairs it was fitted on that a reward model must put in the right order.
ACCURACY_FLOOR = 0.9


def model_facts(spark, sf_dir):
    """What must hold of a fit: the slope of both losses is 0 at the fitted weights (no other weights fit better), saying
    nothing earns nothing, a regression with an intercept is right on average, and most pairs come out in order."""
    rows = stored_instructions(spark, sf_dir)
    pairs, apart = (preference.reward_pairs(rows, include_prompt=opened) for opened in (True, False))
    pair_rows = reward.stored_pair_rows(pairs)
    reward_model = reward.fit_reward(pairs, rows=pair_rows)
    examples = preference.value_examples(rows, keep_prompt=True)
    value_rows = reward.stored_value_rows(examples, reward_model)
    value_model = reward.fit_value(examples, reward_model, rows=value_rows)
    nothing = rows.select(F.lit("").alias("prompt"), F.lit("").alias("completion"))
    silent = reward.score_reward(reward_model, nothing).agg(F.count(F.lit(1)), F.max(F.abs("reward"))).first()
    values = reward.fitted_values(value_model, value_rows)
    mean = values.agg(F.count(F.lit(1)), F.abs(F.avg(F.col("value") - F.col("label")))).first()
    for side in ("chosen", "rejected"):
        apart = reward.score_reward(reward_model, apart, completion=side, name=f"{side}_score")
    order = reward.preference_metrics(apart).first()
    facts = [
        ("reward of nothing", *silent),
        ("mean value less mean label", *mean),
        ("slope of the reward loss", *reward.reward_slope(reward_model, pairs, rows=pair_rows)),
        ("slope of the value loss", *reward.value_slope(value_model, reward_model, examples, rows=value_rows)),
        ("accuracy short of its floor", order["pairs"], max(0.0, ACCURACY_FLOOR - (order["accuracy"] or 0.0))),
    ]
    return spark.createDataFrame([(name, n, round(float(error or 0.0), 4) + 0.0) for name, n, error in facts], "fact string, rows bigint, error double")


def grpo_scores(spark, sf_dir):
    """Fitted rewards of every group: its size and the mean of its advantages, which is 0."""
    rows = stored_instructions(spark, sf_dir)
    prompts, given = completions(spark, sf_dir, rows)
    scored = score_groups(prompts, given, _reward_model(rows))
    return scored.groupBy("prompt_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.abs(F.avg("advantage")), 6).alias("mean_advantage"))


def ppo_scores(spark, sf_dir):
    """Every completion scored with fitted models: its penalty, and how far its advantage is from penalised reward less value."""
    rows = stored_instructions(spark, sf_dir)
    value_model, reward_model, _ = _value_model(rows)
    vocab, policy, reference = language_models(spark, sf_dir, rows)
    prompts, given = completions(spark, sf_dir, rows)
    scored = score_sequences(prompts, given, reward_model, value_model, vocab, policy, reference)
    gap = F.col("raw_reward") - 0.05 * F.col("kl") - F.col("value") - F.col("advantage")
    return scored.select(*SEQUENCE, F.round("kl", 5).alias("kl"), F.round(F.abs(gap), 9).alias("gap"))


QUERIES: dict[str, Query] = {
    "read_instructions": read_instructions,
    "select_split": select_split,
    "jsonl_roundtrip": jsonl_roundtrip,
    "read_keyless": read_keyless,
    "stream_instructions": stream_instructions,
    "export_ordered": export_ordered,
    "write_counts": write_counts,
    "to_jsonl": to_jsonl,
    "write_modes": write_modes,
    "contract_report": contract_report,
    "contract_violations": contract_violations,
    "group_report": group_report,
    "length_report": length_report,
    "length_percentiles": length_percentiles,
    "split_overlap": split_overlap,
    "passage_overlap": passage_overlap,
    "with_ordinal": ordinal,
    "slice_head": slice_head,
    "slice_range": slice_range,
    "slice_percent": slice_percent,
    "train_val_split": train_val_split,
    "format_sft": format_sft,
    "format_sft_padded": format_sft_padded,
    "build_prompt": build_prompt,
    "build_infer_prompt": build_infer_prompt,
    "chat_prompt": chat_prompt,
    "dpo_pairs": dpo_pairs,
    "reward_pairs": reward_pairs,
    "value_examples": value_examples,
    "pairs_best_worst": pairs_best_worst,
    "pairs_all": pairs_all,
    "fit_vocab": fit_vocab,
    "tokenize": tokenize,
    "detokenize": detokenize,
    "ppo_tokens": ppo_tokens,
    "value_tokens": value_tokens,
    "truncate_256": truncate_256,
    "epoch_batches": epoch_batches,
    "pad_batches": pad_batches,
    "pad_own_token": pad_own_token,
    "fan_out": fan_out,
    "completion_text": completion_text,
    "score_inputs": score_inputs,
    "strip_prompt": strip_prompt,
    "reward_callback": reward_callback,
    "group_advantage": group_advantage,
    "value_advantage": value_advantage,
    "kl_reward": kl_reward,
    "token_returns": token_returns,
    "bigram_fit": bigram_fit,
    "seq_logprob": seq_logprob,
    "lm_eval": lm_eval,
    "dpo_metrics": dpo_metrics,
    "preference_metrics": preference_metrics,
    "metric_intervals": metric_intervals,
    "value_metrics": value_metrics,
    "reward_fit": reward_fit,
    "reward_scores": reward_scores,
    "model_roundtrip": model_roundtrip,
    "value_fit": value_fit,
    "value_scores": value_scores,
    "model_facts": model_facts,
    "grpo_scores": grpo_scores,
    "ppo_scores": ppo_scores,
}

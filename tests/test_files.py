import glob
import json

import pytest

from tallyrow import session
from tallyrow.operators import preference, templates
from tallyrow.plans import files, preference as dpo, rollout, sft
from tallyrow.operators.lm import fit_bigram
from tallyrow.operators.rollouts import fan_out
from tallyrow.operators.tokens import tokenize
from tallyrow.sources import sinks, tables
from tallyrow.streaming.files import stream_jsonl


def lines(path):
    return [json.loads(line) for f in glob.glob(f"{path}/part-*") for line in open(f, encoding="utf-8")]


def test_jsonl_round_trip(spark, instructions, tmp_path):
    path = str(tmp_path / "rows.jsonl")
    assert sinks.write_jsonl(instructions, path) == 4
    back = tables.read_jsonl(spark, path, tables.INSTRUCTION_SCHEMA)
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == sorted(map(tuple, instructions.collect()))


def test_text_is_not_escaped_and_nulls_stay(spark, instructions, tmp_path):
    path = str(tmp_path / "rows.jsonl")
    sinks.write_jsonl(instructions, path)
    raw = "".join(open(f, encoding="utf-8").read() for f in glob.glob(f"{path}/part-*"))
    assert 'é 日本 \\"q\\"' in raw and "\\u" not in raw
    assert {tuple(sorted(row)) for row in lines(path)} == {("input", "instruction", "output", "row_id")}


def test_write_modes(spark, instructions, tmp_path):
    path = str(tmp_path / "rows.jsonl")
    assert sinks.write_jsonl(instructions, path, "errorifexists") == 4
    with pytest.raises(Exception):
        sinks.write_jsonl(instructions, path, "errorifexists")
    assert sinks.write_jsonl(instructions, path, "append") == 4
    assert len(lines(path)) == 8
    assert sinks.write_jsonl(instructions.limit(1), path) == 1
    assert len(lines(path)) == 1
    with pytest.raises(ValueError):
        sinks.write_jsonl(instructions, path, "ignore")


def test_a_broken_line_fails_the_read(spark, tmp_path):
    (tmp_path / "bad.jsonl").write_text('{"row_id": 1, "prompt": "a"}\n{"row_id": 2, "pro\n')
    with pytest.raises(Exception):
        tables.read_jsonl(spark, str(tmp_path), tables.PROMPT_SCHEMA).collect()


def test_float_labels_are_written_as_floats(spark, instructions, tmp_path):
    path = str(tmp_path / "v.jsonl")
    assert sinks.write_jsonl(preference.value_examples(instructions), path) == 8
    assert {type(row["label"]) for row in lines(path)} == {float}


def test_read_instructions_formats(spark, instructions, tmp_path):
    instructions.write.parquet(str(tmp_path / "p"))
    sinks.write_jsonl(instructions, str(tmp_path / "j"))
    for fmt, name in (("parquet", "p"), ("json", "j")):
        assert tables.read_instructions(spark, str(tmp_path / name), fmt=fmt).count() == 4
    with pytest.raises(ValueError):
        tables.read_instructions(spark, str(tmp_path / "p"), fmt="csv")


def test_small_scans_are_spread_and_large_ones_left_alone(spark, instructions):
    assert tables.spread(instructions.coalesce(1)).rdd.getNumPartitions() == 4
    wide = instructions.repartition(9)
    assert tables.spread(wide) is wide


class Context:
    """Stands in for a SparkContext with or without the setting."""

    def __init__(self, master, setting=None):
        self.master, self.setting, self.folder = master, setting, None
        self.sparkContext = self

    def getConf(self):
        return {session.CHECKPOINT_DIR: self.setting} if self.setting else {}

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_the_configured_shared_folder_is_used():
    assert session.shared_dir(Context("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert session.scratch_path(Context("yarn", "hdfs:///shared"), "x").startswith("hdfs:///shared/x-")


def test_only_a_local_session_gets_a_temporary_folder():
    local = Context("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local) == local.folder
    with pytest.raises(RuntimeError):
        session.shared_dir(Context("yarn"))


def test_written_tables_go_to_the_shared_folder(spark):
    table = session.written(spark.range(3).toDF("k"), "t")
    assert table.count() == 3 and session.shared_dir(spark) in table.inputFiles()[0]


@pytest.fixture(scope="module")
def corpus(spark):
    topics = ["ships", "bread", "rivers", "chess"]
    rows = [(i, f"tell me about {t}", "", f"{t} are known for many things {i}") for i, t in enumerate(topics * 4)]
    return spark.createDataFrame(rows, "row_id bigint, instruction string, input string, output string")


def test_creator_files(spark, corpus, tmp_path):
    counts = files.write_files(corpus, "row_id", str(tmp_path), list(files.FILES), "train[:5]")
    assert counts == {"ppo_prompts": 5, "grpo_items": 5, "dpo_pairs": 5, "reward_pairs": 5, "value_data": 10}
    pairs = files.read_file(spark, str(tmp_path), "reward_pairs", "row_id bigint")
    expected = preference.reward_pairs(corpus.where("row_id < 5"))
    assert sorted(map(tuple, pairs.collect())) == sorted(map(tuple, expected.collect()))


def test_sft_to_dpo_and_rollouts(spark, corpus, tmp_path):
    folder = str(tmp_path)
    run = sft.fit(sft.prepare(corpus, "row_id", 12, 4), "row_id", 200)
    loss = run.loss.first()
    assert loss.sequences == 4 and 0 < loss.nll < 5

    files.write_files(corpus, "row_id", folder, ["dpo_pairs", "reward_pairs", "value_data", "ppo_prompts"])
    pairs = files.read_file(spark, folder, "dpo_pairs", "row_id bigint")
    same = dpo.score_pairs(pairs, "row_id", run.vocab, run.model, run.model).collect()
    assert len(same) == 16 and all(abs(r.loss - 0.693147) < 1e-5 for r in same)

    reward_model, value_model = rollout.fit_models(spark, folder, "row_id bigint")
    prompts = files.read_file(spark, folder, "ppo_prompts", "row_id bigint").withColumnRenamed("row_id", "prompt_id")
    completions = fan_out(prompts.select("prompt_id"), 4).selectExpr(
        "prompt_id", "gen_id", "CASE WHEN gen_id = 0 THEN concat(' known for many things ', prompt_id) ELSE repeat(' x', gen_id) END AS completion"
    )
    groups = rollout.score_groups(prompts, completions, reward_model)
    sums = groups.groupBy("prompt_id").agg({"advantage": "sum", "gen_id": "count"}).collect()
    assert len(sums) == 16 and all(abs(r[1]) < 1e-6 or abs(r[2]) < 1e-6 for r in sums)

    reference = fit_bigram(tokenize(corpus.withColumnRenamed("output", "text"), run.vocab, "text"), run.vocab.size)
    scored = rollout.score_sequences(
        prompts.drop("instruction"), completions, reward_model, value_model, run.vocab, run.model, reference
    ).collect()
    assert len(scored) == 64
    for r in scored:
        assert r.reward == pytest.approx(r.raw_reward - 0.05 * r.kl)
        assert r.advantage == pytest.approx(r.reward - r.value)


def test_prompts_over_a_file_stream(spark, instructions, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ckpt"))

    def run():
        stream_jsonl(
            spark, source, tables.INSTRUCTION_SCHEMA, lambda df: templates.build_prompt(df).select("row_id", "prompt"), target, checkpoint
        ).awaitTermination()
        return {r.row_id: r.prompt for r in tables.read_jsonl(spark, target, tables.PROMPT_SCHEMA).collect()}

    expected = {r.row_id: r.prompt for r in templates.build_prompt(instructions).collect()}
    sinks.write_jsonl(instructions.where("row_id < 2"), source)
    assert run() == {k: v for k, v in expected.items() if k < 2}
    sinks.write_jsonl(instructions.where("row_id >= 2"), source, "append")
    assert run() == expected

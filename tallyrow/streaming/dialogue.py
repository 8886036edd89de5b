"""Instruction rows out of dialogue turns that arrive file by file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyrow.sources.dialogue import KEY, with_system_text

TURNS = "conv_id bigint, turn bigint, role string, text string"
_SIDES = "conv_id bigint, turn bigint, instruction string, output string, system string"


def arriving_turns(spark: SparkSession, source: str, format: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """The turns of a folder's files as a stream; ``arrived`` is when a file was last written. Older files come first."""
    reader = spark.readStream.schema(TURNS).format(format)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(source).select("*", F.col("_metadata.file_modification_time").alias("arrived"))


def paired_turns(turns: DataFrame, wait: str = "1 day") -> DataFrame:
    """Pairs of a question and its answer, and system texts, as one append-only stream.

    ``turns`` has (conv_id, turn, role, text, arrived). Either half may come first; it is kept
    as state under (conv_id, asked turn), a key no other row shares, until the other half
    comes, at most ``wait``: halves that arrive further apart are no pair, and what has
    waited longer leaves the state. System texts pass through and need no state. Turns
    without a conversation or a number follow nothing and are left out.
    """
    placed = turns.where("conv_id is not null and turn is not null").withWatermark("arrived", wait)
    text = F.coalesce("text", F.lit(""))
    asked = placed.where("role = 'user'").select(*KEY, text.alias("instruction"), F.col("arrived").alias("_asked"))
    given = placed.where("role = 'assistant'").select(
        F.col("conv_id").alias("_conv"), (F.col("turn") - 1).alias("_turn"), text.alias("output"), F.col("arrived").alias("_given")
    )
    near = F.expr(f"_given between _asked - interval {wait} and _asked + interval {wait}")
    met = asked.join(given, (F.col("conv_id") == F.col("_conv")) & (F.col("turn") == F.col("_turn")) & near)
    pairs = met.select(*KEY, "instruction", "output", F.lit(None).cast("string").alias("system"))
    none = F.lit(None).cast("string")
    texts = turns.where("role = 'system' and conv_id is not null and text is not null")
    return pairs.union(texts.select(*KEY, none.alias("instruction"), none.alias("output"), F.col("text").alias("system")))


def stream_instructions(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    wait: str = "1 day",
    format: str = "parquet",
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Pairs the turns of every new file of a folder, then stops.

    The checkpoint holds the files taken and the halves that wait, so the answer may come in
    a file of a later run. A restarted or repeated batch adds no row twice. Files more than
    seven days older than the newest one taken are not read (the file source's own limit).
    """
    return (
        paired_turns(arriving_turns(spark, source, format, files_per_batch), wait)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )


def streamed_instructions(spark: SparkSession, target: str) -> DataFrame:
    """The instructions that ``stream_instructions`` has found so far, as the batch view has them.

    The system text is joined here, so it may arrive before or after the pairs. A turn that
    stands twice fails the first action on the result. Before the first batch the view is empty.
    """
    rows = spark.read.schema(_SIDES).parquet(target)
    pairs = rows.where("instruction is not null").groupBy(*KEY).agg(
        F.max("instruction").alias("instruction"), F.max("output").alias("output"), F.count(F.lit(1)).alias("_times")
    )
    refused = F.raise_error(F.concat(F.lit("a question or its answer stands more than once: conversation "), F.col("conv_id").cast("string"), F.lit(", turn "), F.col("turn").cast("string")))
    single = pairs.where(F.when(F.col("_times") > 1, refused.cast("boolean")).otherwise(F.lit(True))).drop("_times")
    return with_system_text(single, rows.where("system is not null").select("conv_id", F.col("system").alias("text")))

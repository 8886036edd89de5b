"""The corpus pipeline: stages of the operators in tallyrow.llm, each over all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrow.llm import clauses, darts, mixing, packing, subwords
from tallyrow.llm.queries import DOMAIN_SQL, fold, mixture
from tallyrow.session import written

# The levels of the mixture's tree, from the columns of documents.
LEVELS_SQL = (DOMAIN_SQL, "lang", "source")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = subwords.score(docs, subwords.fit(docs, labels, "quality", fold(3) != 1), "_quality", keep=True)
    return scored.where("_quality >= 0.5").select(*docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar does not find toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = clauses.score(docs, clauses.fit(docs, labels, "toxic", fold(5) != 0), "_toxic", keep=True)
    return scored.where("_toxic < 0.5").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate class."""
    return darts.deduplicated(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights want them; extra epochs repeat rows."""
    _, found = mixture(docs.select("doc_id", "lang", "source", "text"))
    levels = {f"_{name}": F.expr(sql) for name, sql in zip(found.levels, LEVELS_SQL)}
    kept = found.copies(docs.withColumns(levels), "_copies", tuple(levels))
    return kept.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The batch and slot of every document."""
    return packing.pack(docs.select("doc_id", mixing.n_tokens().alias("n_tokens")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("mix", mix),
    ("pack", pack),
]

# Classifiers are trained: SQL cannot express the rows of run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Every stage's rows are stored in the shared folder before the next reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

"""Connected components of an edge table, by contraction.

Every round hooks each node to its smallest neighbour if that is smaller, follows
the hooks to their ends by doubling, and maps the edges to these ends. A round
leaves at most half of the nodes that still have edges. All tables stay
distributed; each is written to the shared folder, so that joins start from stored
tables, whose hot keys Spark can split, and lineage is cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrow.session import written


def _ends(hooks: DataFrame) -> DataFrame:
    """(node, root): hooks followed to their ends; each pass doubles the length followed."""
    while True:
        further = hooks.join(hooks.select(F.col("node").alias("root"), F.col("root").alias("_next")), "root", "left")
        stepped = written(further.select("node", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "hooks")
        if not stepped.where("_moved").limit(1).count():
            return stepped.select("node", "root")
        hooks = stepped.select("node", "root")


def _through(edges: DataFrame, ends: DataFrame, side: str) -> DataFrame:
    mapped = edges.join(ends.withColumnRenamed("node", side), side, "left")
    other = "b" if side == "a" else "a"
    return mapped.select(F.coalesce("root", side).alias(side), other)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b): the smallest node it can reach."""
    rest = written(
        edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"
    )
    labels = None
    while rest.limit(1).count():
        ends = _ends(written(rest.groupBy("b").agg(F.min("a").alias("root")).withColumnRenamed("b", "node"), "hooks"))
        if labels is None:
            roots = rest.select(F.col("a").alias("node")).union(rest.select(F.col("b").alias("node"))).distinct()
            labels = written(roots.join(ends, "node", "left").select("node", F.coalesce("root", "node").alias("component")), "labels")
        else:
            moved = labels.join(ends.select(F.col("node").alias("component"), "root"), "component", "left")
            labels = written(moved.select("node", F.coalesce("root", "component").alias("component")), "labels")
        half = written(_through(rest, ends, "a"), "edges")
        full = _through(half, ends, "b").where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        rest = written(full.distinct(), "edges")
    if labels is None:
        return rest.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels

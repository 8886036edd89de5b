"""Mixing sources to target weights, in DataFrame operations alone.

The leaves are the distinct values of ``levels`` (say domain, language, source);
each prefix of them is a node of a tree. A node's capacity is the tokens below it
times ``max_epochs``. The root's budget is handed down level by level: a node's
budget goes to its children by weight; a child that cannot hold its share takes
its capacity, and what it leaves is shared among its siblings by weight until all
is placed or all are full. As a node never gets more than its capacity, a shortage
only leaves it for the ancestors' other children when no sibling has room.

A leaf that gets q full epochs and a rest keeps each document q times, and once
more the prefix of epoch q + 1: its documents in the seeded order of that epoch,
up to and with the one that reaches the rest.

Budgets are whole tokens; what division leaves over goes in ones to the open
children, largest weight first. Documents without tokens (null or empty texts)
are in every full epoch and in a prefix if their place in the order is before its
end. Null levels are values of their own. Repeated rows count as rows. An empty
table gives an empty result. Weights that are missing, null or not positive count
as 0: such a node gets tokens only when all its weighted siblings are full.

Scale: rows are narrow (no text). One pass sums tokens per leaf and another per
leaf and slice of the order; only the slice in which a leaf's prefix ends is
ordered row by row. Tree tables have one row per leaf and are joined to
documents by broadcast only where counted to be small, else by a salted join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrow.functions.skew import lookup_join
from tallyrow.session import written

WORD = r"[^\x20\x09-\x0D]+"
# Leaves up to this many, a few MB, are broadcast.
BROADCAST_LEAVES = 50_000
# Documents of one slice of a leaf's order, about.
SLICE_ROWS = 20_000
# Hex digits of an order key: below 2**60, so that sums of slices stay whole numbers.
_DIGITS = 15


def n_tokens(text: str = "text") -> Column:
    """Words between ASCII white space."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def order_key(seed: int, epoch: Column, key: str) -> Column:
    """A document's place in the order of an epoch: the leading digits of an md5."""
    joined = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(joined), 1, _DIGITS), 16, 10).cast("long")


def _slice(place: Column, width: int) -> Column:
    return F.call_function("div", place, F.lit(width).cast("long"))


def _nodes(leaves: DataFrame, levels: Sequence[str], depth: int) -> DataFrame:
    """Nodes of one level: capacity and weight (the largest given below it)."""
    names = list(levels[:depth])
    return leaves.groupBy(*names).agg(F.sum("_cap").alias("_cap"), F.max(f"_w{depth}").alias("_w"))


def _matched(rows: DataFrame, table: DataFrame, names: Sequence[str]) -> DataFrame:
    """``rows`` with the other columns of ``table``; equal nulls match."""
    renamed = table.withColumnsRenamed({n: f"_of_{n}" for n in names})
    on = [F.col(n).eqNullSafe(F.col(f"_of_{n}")) for n in names]
    return rows.join(renamed, on).drop(*(f"_of_{n}" for n in names))


def budgets(leaves: DataFrame, levels: Sequence[str], total: int) -> DataFrame:
    """``leaves`` (levels, _cap, _w1 ... _wn) with ``_budget``.

    One level after another: with children by capacity per weight, the k-th is full
    if its capacity is at most its share of what the k - 1 before it leave.
    """
    given: DataFrame | None = None
    for depth in range(1, len(levels) + 1):
        names, parents = list(levels[:depth]), list(levels[: depth - 1])
        nodes = _nodes(leaves, levels, depth)
        if given is None:
            nodes = nodes.withColumn("_b", F.lit(total).cast("long"))
        else:
            nodes = _matched(nodes, given, parents).withColumnRenamed("_budget", "_b")
        by_parent = Window.partitionBy(*parents)
        # Children without weight come last, in a round of their own with equal weights.
        nodes = nodes.withColumn("_late", (F.col("_w") <= 0).cast("int")).withColumn("_v", F.when(F.col("_w") > 0, F.col("_w")).otherwise(F.lit(1)))
        first = nodes.withColumn("_room", F.sum(F.when(F.col("_late") == 0, F.col("_cap")).otherwise(0)).over(by_parent)).withColumn(
            "_b", F.when(F.col("_late") == 0, F.least("_b", "_room")).otherwise(F.greatest(F.col("_b") - F.col("_room"), F.lit(0)))
        )
        parts = Window.partitionBy(*parents, "_late").orderBy(F.col("_cap") / F.col("_v"), *names)
        before = parts.rowsBetween(Window.unboundedPreceding, -1)
        onward = parts.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        every = Window.partitionBy(*parents, "_late")
        ranked = (
            first.withColumn("_left", F.col("_b") - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
            .withColumn("_sum", F.sum("_v").over(onward))
            # Full: capacity x weights still open <= tokens left x own weight.
            .withColumn("_full", (F.col("_cap").cast("decimal(38,0)") * F.col("_sum") <= F.col("_left").cast("decimal(38,0)") * F.col("_v")).cast("int"))
        )
        placed = (
            ranked.withColumn("_open_w", F.sum(F.when(F.col("_full") == 0, F.col("_v")).otherwise(0)).over(every))
            .withColumn("_open_b", F.col("_b") - F.sum(F.when(F.col("_full") == 1, F.col("_cap")).otherwise(0)).over(every))
            .withColumn(
                "_share",
                F.when(F.col("_full") == 1, F.col("_cap")).otherwise(
                    F.expr("cast((cast(_open_b as decimal(20,0)) * cast(_v as decimal(10,0))) div _open_w as long)")
                ),
            )
            .withColumn("_spare", F.col("_b") - F.sum("_share").over(every))
            .withColumn("_turn", F.row_number().over(Window.partitionBy(*parents, "_late").orderBy("_full", F.desc("_v"), *names)))
        )
        extra = F.when((F.col("_full") == 0) & (F.col("_turn") <= F.col("_spare")), 1).otherwise(0)
        given = placed.select(*names, (F.col("_share") + extra).cast("long").alias("_budget"))
    return _matched(leaves, given, levels)


def _attach(docs: DataFrame, leaves: DataFrame, count: int, key: str) -> DataFrame:
    """Documents with their leaf's columns; ``_leaf`` identifies it in both."""
    if count <= BROADCAST_LEAVES:
        return docs.join(F.broadcast(leaves), "_leaf")
    return lookup_join(docs, leaves, "_leaf", key)


def _leaf(levels: Sequence[str]) -> Column:
    return F.xxhash64(*(F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in levels))


@dataclass(frozen=True)
class Mixture:
    """How often each document is kept: per leaf the full epochs and where the next one's prefix ends."""

    leaves: DataFrame
    n_leaves: int
    levels: tuple[str, ...]
    seed: int
    key: str

    def copies(self, docs: DataFrame, name: str = "copies", levels: Sequence[str] = ()) -> DataFrame:
        """The rows of ``docs`` that are kept, with how often; ``levels`` if the columns have other names.

        No row moves where the leaves are broadcast.
        """
        at = order_key(self.seed, F.col("_epochs"), self.key)
        in_prefix = F.coalesce(F.struct(at.alias("_at"), F.col(self.key).alias("_id")) <= F.col("_end"), F.lit(False))
        chosen = _attach(docs.withColumn("_leaf", _leaf(levels or self.levels)), self.leaves, self.n_leaves, self.key)
        return chosen.withColumn(name, F.col("_epochs") + in_prefix.cast("long")).where(F.col(name) > 0).select(*docs.columns, name)


def plan(
    docs: DataFrame,
    levels: Sequence[str],
    weights: Sequence[Column],
    total: int | None = None,
    max_epochs: int = 4,
    seed: int = 0,
    key: str = "doc_id",
    tokens: str = "n_tokens",
) -> Mixture:
    """The mixture of ``docs`` (key, levels, tokens).

    ``weights`` has one whole-number expression per level, over the level columns:
    the node's weight among its siblings. ``total`` is the budget in tokens, by
    default as many as there are.
    """
    levels = list(levels)
    rows = written(docs.select(key, *levels, tokens).withColumn("_leaf", _leaf(levels)), "mixing-rows")
    supply = written(
        rows.groupBy("_leaf", *levels).agg(F.sum(tokens).alias("_supply"), F.count(F.lit(1)).alias("_docs")).select(
            "*",
            (F.col("_supply") * max_epochs).alias("_cap"),
            *(F.greatest(F.coalesce(w.cast("long"), F.lit(0)), F.lit(0)).alias(f"_w{i}") for i, w in enumerate(weights, 1)),
        ),
        "mixing-leaves",
    )
    facts = supply.agg(F.count(F.lit(1)).alias("n"), F.sum("_supply").alias("tokens"), F.max("_docs").alias("most"), F.sum("_cap").alias("cap")).first()
    budget = min(facts["tokens"] or 0 if total is None else total, facts["cap"] or 0)
    slices = max(1, -(-(facts["most"] or 0) // SLICE_ROWS))
    width = (16**_DIGITS) // slices + 1
    shares = written(
        budgets(supply, levels, budget).select(
            "_leaf",
            F.when(F.col("_supply") > 0, F.expr("_budget div _supply")).otherwise(F.lit(0)).cast("long").alias("_epochs"),
            F.when(F.col("_supply") > 0, F.col("_budget") % F.col("_supply")).otherwise(F.lit(0)).cast("long").alias("_rest"),
        ),
        "mixing-shares",
    )
    place = order_key(seed, F.col("_epochs"), key)
    sliced = _attach(rows, shares.where("_rest > 0"), facts["n"], key).withColumn("_slice", _slice(place, width))
    earlier = Window.partitionBy("_leaf").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # Of each leaf the slice in which its prefix ends, and what the slices before it hold.
    ends = (
        sliced.groupBy("_leaf", "_slice", "_rest")
        .agg(F.sum(tokens).alias("_in"))
        .withColumn("_before", F.coalesce(F.sum("_in").over(earlier), F.lit(0)))
        .where("_before < _rest and _before + _in >= _rest")
        .select("_leaf", F.col("_slice").alias("_last"), "_before")
    )
    ends = written(shares.join(ends, "_leaf", "left"), "mixing-ends")
    inside = _attach(rows, ends.where("_rest > 0"), facts["n"], key).withColumn("_at", place).where(_slice(F.col("_at"), width) == F.col("_last"))
    running = Window.partitionBy("_leaf").orderBy("_at", key).rowsBetween(Window.unboundedPreceding, -1)
    bounds = (
        inside.withColumn("_sofar", F.col("_before") + F.coalesce(F.sum(tokens).over(running), F.lit(0)))
        .where("_sofar < _rest")
        .groupBy("_leaf")
        .agg(F.max(F.struct("_at", F.col(key).alias("_id"))).alias("_end"))
    )
    final = written(ends.join(bounds, "_leaf", "left").select("_leaf", "_epochs", "_end"), "mixing-bounds")
    return Mixture(final, facts["n"], tuple(levels), seed, key)

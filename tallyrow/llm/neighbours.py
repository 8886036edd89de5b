"""Near-duplicate vectors by NN-descent.

Only vectors of equal, non-null label are compared. A vector that is null, zero or
holds a null or non-finite component links with nothing. Equal vectors of a label
(all components equal) are one point from the start.

1. Start: points of a label are cut into small cells by the signs of random
   projections, several times over; a cell's points are compared with each other.
2. Descent: a point's neighbours, and a bounded random draw of the points that have
   it as neighbour, meet and are compared with each other (neighbours of neighbours).
   Each keeps its best; rounds follow until a round brings few links. Points whose whole
   list is over the threshold are saturated: their lists are enlarged, up to ``WIDEST`` times,
   and they and their neighbours meet again.
3. Every comparison also hands on threshold edges: a forest over those points that
   met and are alike, so that a class larger than a list stays connected.
4. Components of the threshold edges, verified in double precision. A component with points still saturated
   may hide links to others behind its own. By the triangle inequality only points within its reach and the threshold's
   angle of one of its points can link with it; these alone are compared with its points, in blocks.
5. Within each component links are counted in blocks (the list that an enlarged list would
   end at), in double precision. Counts, not pairs, leave a task. Copies count with their number.
6. Audit: up to ``AUDIT`` points drawn from each label are compared with their whole label. ``recall`` is
   the share of their links that steps 1 to 5 found; what the audit sees is not added to the result.
   Labels below ``RECALL`` have their lists enlarged and descend again; one that stays below it at the
   widest lists is compared whole. ``recall`` stays the figure measured before. Where none of the
   drawn points has a link there is nothing to measure, and ``recall`` is null.

Vectors in cells and lists are single precision; a link counts by the cosine of
the stored components in double precision. Vectors of other dimensions than the
most frequent one link only with their own kind: the dimension is part of the label.
Null vec_ids get no row; rows that repeat a vec_id count once, by the smallest vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyrow.llm.components import components
from tallyrow.llm.words import grouped, mix64
from tallyrow.session import written

LEAST = 0.98
# Neighbours in a list, and of those that list a point as many again are drawn.
LIST = 8
# Points of a cell, about, and how often cells are cut.
CELL, CUTS = 64, 8
# Points of a label that the audit compares with the whole label, and the share of their links that must be found.
AUDIT, RECALL = 512, 0.95
# Rounds for each length of the lists, and up to how many times ``keep`` lists grow.
ROUNDS, WIDEST = 12, 4
# Points of a block in the exact count.
BLOCK = 512
# Points of a block at most where all points of a label are compared.
WIDE = 4096
# Single precision may be off by so much.
SLACK = 1e-5

_EDGES = "u bigint, v bigint, cosine float, made boolean"
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    """The rows of a binary column of equal lengths as a matrix."""
    n = len(column)
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(kind).reshape(n, -1)


def points(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, points): which point each valid vec_id belongs to; the points with label group, size and unit vector."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            out = []
            for v in batch.column("embedding").to_pylist():
                x = np.array([np.nan if y is None else y for y in v or []], np.float64)
                size = np.sqrt((x * x).sum()) if len(x) and np.isfinite(x).all() else 0.0
                if not np.isfinite(size) or size == 0:
                    scale = np.abs(x).max() if len(x) and np.isfinite(x).all() else 0.0
                    x = x / scale if scale > 0 else x
                    size = np.sqrt((x * x).sum()) if scale > 0 else 0.0
                out.append((x / size).astype("<f8").tobytes() if size > 0 else None)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(out, pa.binary())], names=["vec_id", "label", "unit"])

    valid = (
        vectors.where("vec_id is not null and label is not null and embedding is not null")
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "embedding")
        .mapInArrow(run, "vec_id bigint, label string, unit binary")
        .where("unit is not null")
        .groupBy("vec_id")
        .agg(F.min(F.struct("label", "unit")).alias("_v"))
        .select("vec_id", F.xxhash64("_v.label", F.length("_v.unit")).alias("side"), "_v.unit", F.xxhash64("_v.label", F.md5("_v.unit")).alias("same"))
    )
    valid = written(valid, "vectors")
    grouped = valid.groupBy("same").agg(F.min("vec_id").alias("u"), F.count(F.lit(1)).alias("size"), F.first("side").alias("side"), F.first("unit").alias("unit"))
    table = written(grouped, "points")
    members = valid.select("vec_id", "same").join(table.select("same", "u"), "same").select("vec_id", "u")
    return members, table.select("u", "side", "size", "unit")


def _best(ids: np.ndarray, cosines: np.ndarray, keep: int, least: float, floor: np.ndarray | None = None, bounds: np.ndarray | None = None):
    """Of each point of a group its ``keep`` best others (made False) and a forest of threshold edges (made True)."""
    n = len(ids)
    np.fill_diagonal(cosines, -2)
    keep = min(keep, n - 1)
    top = np.argpartition(-cosines, keep - 1, axis=1)[:, :keep] if keep < n - 1 else np.argsort(-cosines, axis=1)[:, :keep]
    u, v = np.repeat(np.arange(n), keep), top.ravel()
    value = cosines[u, v]
    good = value > -2 if bounds is None else value > bounds[u]
    u, v, value = u[good], v[good], value[good]
    yield ids[u], ids[v], value, False
    near = cosines >= least - SLACK
    seen, roots = np.zeros(n, bool), []
    while True:
        # Breadth first from the first point not reached: a tree for each class of the group.
        start = np.flatnonzero(~seen & near.any(axis=1))
        if not len(start):
            break
        front = start[:1]
        seen[front] = True
        while len(front):
            reach = near[front] & ~seen
            fresh = np.flatnonzero(reach.any(axis=0))
            if len(fresh):
                parent = front[reach[:, fresh].argmax(axis=0)]
                roots.append((parent, fresh))
                seen[fresh] = True
            front = fresh
    if roots:
        a, b = np.concatenate([r[0] for r in roots]), np.concatenate([r[1] for r in roots])
        yield ids[a], ids[b], cosines[a, b], True


def _edges(parts: list) -> pa.RecordBatch:
    u, v, c = (np.concatenate([p[i] for p in parts]) for i in range(3))
    made = np.concatenate([np.full(len(p[0]), p[3]) for p in parts])
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(c.astype(np.float32)), pa.array(made)], names=["u", "v", "cosine", "made"])


def _compare(keep: int, least: float):
    """Compares the points of each group; those with a bound hand on what beats it."""

    def run(batches: Iterator[pa.RecordBatch]):
        waiting, n = [], 0
        for _, group in grouped(batches, "cell"):
            if group.num_rows < 2:
                continue
            ids = np.asarray(group.column("u"))
            x = _matrix(group.column("unit"), "<f4")
            bounds = np.asarray(group.column("bound")) if "bound" in group.schema.names else None
            for part in _best(ids, x @ x.T, keep, least, bounds=bounds):
                waiting.append(part)
                n += len(part[0])
            if n > 50_000:
                yield _edges(waiting)
                waiting, n = [], 0
        if waiting:
            yield _edges(waiting)

    return run


def _single(unit: str = "unit"):
    """Unit vectors in single precision, by which points are compared until links are verified."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            units = [np.frombuffer(x, "<f8").astype("<f4").tobytes() for x in batch.column(unit).to_pylist()]
            yield batch.set_column(batch.schema.get_field_index(unit), unit, pa.array(units, pa.binary()))

    return run


def started(table: DataFrame, keep: int, least: float, cuts: int = CUTS, cell: int = CELL, seed: int = 0) -> DataFrame:
    """Edges between points that fall into the same cell of some cut.

    A side of n points is cut by the signs of about log2(n / cell) projections; the
    points of one cell are then dealt out evenly over groups of about ``cell``.
    """
    sides = table.groupBy("side").agg(F.count(F.lit(1)).alias("_n")).select("side", F.greatest(F.lit(0), F.ceil(F.log2(F.col("_n") / cell))).cast("int").alias("bits"))

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if not batch.num_rows:
                continue
            units, bits = batch.column("unit").to_pylist(), np.asarray(batch.column("bits"))
            u, side = np.asarray(batch.column("u")), np.asarray(batch.column("side"))
            sizes = np.array([len(x) for x in units])
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                x = np.frombuffer(b"".join(units[i] for i in rows), "<f4").reshape(len(rows), -1)
                for cut in range(cuts):
                    planes = np.random.default_rng([seed, cut, x.shape[1]]).normal(size=(x.shape[1], 40)).astype(np.float32)
                    signs = ((x @ planes) > 0) @ (1 << np.arange(40, dtype=np.int64))
                    code = signs & ((1 << bits[rows].astype(np.int64)) - 1)
                    with np.errstate(over="ignore"):
                        key = mix64(mix64(side[rows].view(np.uint64) + code.astype(np.uint64) * _GOLDEN) + np.uint64(cut))
                    yield pa.RecordBatch.from_arrays([pa.array(u[rows]), pa.array(key.view(np.int64)), pa.array([units[i] for i in rows], pa.binary())], names=["u", "part", "unit"])

    cells = written(table.join(sides, "side").select("u", "side", "bits", "unit").mapInArrow(run, "u bigint, part bigint, unit binary"), "nn-cells")
    # A full cell is split by hash; which of its points meet differs from cut to cut.
    filled = written(cells.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / (2 * cell)).cast("int").alias("_parts")), "nn-parts")
    dealt = cells.join(filled, "part").select("u", "unit", F.xxhash64("part", F.pmod(F.xxhash64("u", "part"), F.col("_parts"))).alias("cell"))
    return _met(dealt, keep, least)


def _met(dealt: DataFrame, keep: int, least: float) -> DataFrame:
    parts = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(parts, "cell").sortWithinPartitions("cell").mapInArrow(_compare(keep, least), _EDGES)


def _lists(edges: DataFrame, keep: DataFrame) -> DataFrame:
    """(u, v, cosine, old): each point's best distinct neighbours, ``old`` those that were listed before."""
    best = edges.groupBy("u", "v").agg(F.max("cosine").alias("cosine"), F.max("old").alias("old"))
    ranked = best.withColumn("_place", F.row_number().over(Window.partitionBy("u").orderBy(F.desc("cosine"), "v")))
    return ranked.join(keep, "u").where(F.col("_place") <= F.col("keep")).select("u", "v", "cosine", "old")


def _enlarged(kept: DataFrame, narrow: DataFrame) -> DataFrame:
    """``kept`` with the lists of the points ``narrow`` twice as long."""
    more = kept.join(narrow.withColumn("_more", F.lit(True)), "u", "left")
    return written(more.select("u", F.when(F.col("_more"), F.col("keep") * 2).otherwise(F.col("keep")).alias("keep")), "nn-keep")


def _descend(lists: DataFrame, table: DataFrame, keep: DataFrame, longest: int, least: float, turn: int, only: DataFrame | None = None) -> DataFrame:
    """One round: edges that a meeting of each point's neighbours (of the points ``only``, if given) brings forth."""
    forward = lists.select(F.col("u").alias("cell"), F.col("v").alias("u"))
    draw = Window.partitionBy("v").orderBy(F.xxhash64("u", F.lit(turn)))
    backward = lists.select("u", "v").withColumn("_draw", F.row_number().over(draw)).where(F.col("_draw") <= longest).select(F.col("v").alias("cell"), "u")
    selves = lists.select(F.col("u").alias("cell"), "u")
    bounds = lists.join(keep, "u").groupBy("u").agg(
        F.when(F.count(F.lit(1)) >= F.first("keep"), F.min("cosine")).otherwise(F.lit(-2.0)).cast("float").alias("bound")
    )
    known = table.select("u", "unit").join(bounds, "u", "left").select("u", "unit", F.coalesce("bound", F.lit(-2.0).cast("float")).alias("bound"))
    met = forward.union(backward).union(selves)
    if only is not None:
        met = met.join(only.select(F.col("u").alias("cell")), "cell", "left_semi")
    return _met(met.distinct().join(known, "u").select("u", "unit", "cell", "bound"), longest, least)


def _verified(edges: DataFrame, table: DataFrame, least: float) -> DataFrame:
    """Edges whose cosine in double precision reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            left, right = batch.column("left").to_pylist(), batch.column("right").to_pylist()
            good = np.array([float(np.frombuffer(x, "<f8") @ np.frombuffer(y, "<f8")) >= least for x, y in zip(left, right)], bool)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    pairs = edges.where(F.col("cosine") >= least - SLACK).select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
    one = pairs.join(table.select(F.col("u").alias("a"), F.col("unit").alias("left")), "a")
    both = one.join(table.select(F.col("u").alias("b"), F.col("unit").alias("right")), "b")
    return both.mapInArrow(run, "a bigint, b bigint")


def counted_links(table: DataFrame, comps: DataFrame, least: float, block: int = BLOCK) -> DataFrame:
    """(u, links): with how many vectors of its component each point links, copies counted.

    A component is cut into blocks; every two of its blocks meet in a task.
    """
    sized = comps.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_blocks"))
    inside = (
        table.select("u", "size", "unit")
        .join(comps.withColumnRenamed("node", "u"), "u")
        .join(written(sized, "nn-sizes"), "component")
        .withColumn("_block", F.pmod(F.xxhash64("u"), F.col("_blocks")).cast("int"))
    )
    # Block i meets block j in the cell (min, max); it is told apart there by ``mine``.
    spread = inside.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).select(
        "u", "size", "unit", F.col("_block").alias("mine"), F.xxhash64("component", F.least("_block", "_other"), F.greatest("_block", "_other")).alias("cell")
    )

    def run(batches: Iterator[pa.RecordBatch]):
        for _, group in grouped(batches, "cell"):
            ids, sizes, mine = (np.asarray(group.column(c)) for c in ("u", "size", "mine"))
            x = _matrix(group.column("unit"), "<f8")
            sides = [np.flatnonzero(mine == m) for m in np.unique(mine)]
            a, b = sides[0], sides[-1]
            near = _alike(x[a], x[b], least)
            if len(sides) == 1:
                np.fill_diagonal(near, False)
                links, who = near @ sizes[b], a
            else:
                links, who = np.r_[near @ sizes[b], near.T @ sizes[a]], np.r_[a, b]
            yield pa.RecordBatch.from_arrays([pa.array(ids[who]), pa.array(links.astype(np.int64))], names=["u", "links"])

    parts = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = spread.repartition(parts, "cell").sortWithinPartitions("cell").mapInArrow(run, "u bigint, links bigint")
    return met.groupBy("u").agg(F.sum("links").alias("links"))


def _alike(x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    """Which rows' cosine reaches ``least``; products too close to it are summed one by one."""
    products = x @ y.T
    near = products >= least
    for i, j in np.argwhere(np.abs(products - least) < 1e-12):
        near[i, j] = float(x[i] @ y[j]) >= least
    return near


def _forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of links that join whatever the links of a rectangle join."""
    rows, columns = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
    near = near[np.ix_(rows, columns)]
    old_rows, old_columns = np.zeros(len(rows), bool), np.zeros(len(columns), bool)
    a, b = [rows[:0]], [columns[:0]]
    for start in range(len(rows)):
        front = np.array([] if old_rows[start] else [start], int)
        old_rows[front] = True
        while len(front):
            fresh = np.flatnonzero(near[front].any(axis=0) & ~old_columns)
            if not len(fresh):
                break
            old_columns[fresh] = True
            a.append(rows[front[near[np.ix_(front, fresh)].argmax(axis=0)]])
            b.append(columns[fresh])
            front = np.flatnonzero(near[:, fresh].any(axis=1) & ~old_rows)
            old_rows[front] = True
            a.append(rows[front])
            b.append(columns[fresh[near[np.ix_(front, fresh)].argmax(axis=1)]])
    return np.concatenate(a), np.concatenate(b)


def _blocks_met(asked: DataFrame, table: DataFrame, own: tuple[str, ...], run, schema: str, block: int = BLOCK) -> DataFrame:
    """``run`` over cells in which a block of ``asked`` (asks = 1) meets a block of the ``table`` of the same side (asks = 0).

    ``own`` names further columns of ``asked``; the table's rows have nulls there. Every two blocks of a side meet in a task.
    """
    count = F.count(F.lit(1))
    blocks = F.greatest(F.ceil(count / WIDE), F.least(F.lit(4), F.ceil(count / block))).cast("int")
    sized = asked.groupBy("side").agg(blocks.alias("_a")).join(table.groupBy("side").agg(blocks.alias("_b")), "side")
    sized = written(sized, "nn-sizes")

    def spread(points: DataFrame, asks: int, mine: str, other: str) -> DataFrame:
        inside = points.join(sized, "side").withColumn(mine, F.pmod(F.xxhash64("u"), F.col(mine)).cast("int"))
        each = inside.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        more = [F.col(c) if asks else F.lit(None).cast(asked.schema[c].dataType).alias(c) for c in own]
        return each.select("u", "size", "unit", F.lit(asks).alias("asks"), F.xxhash64("side", "_a", "_b").alias("cell"), *more)

    parts = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = spread(asked, 1, "_a", "_b").union(spread(table, 0, "_b", "_a"))
    return written(met.repartition(parts, "cell").sortWithinPartitions("cell").mapInArrow(run, schema), "nn-compared")


def compared(asked: DataFrame, table: DataFrame, least: float, block: int = BLOCK) -> DataFrame:
    """(u, v, links): the points of ``asked`` compared with all points of their side.

    Rows without v tell with how many vectors of some of the side's blocks u links, copies
    counted; the others are links, a forest of each two blocks, so all links of the
    points asked for join the same points.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        for _, group in grouped(batches, "cell"):
            ids, sizes, asks = (np.asarray(group.column(c)) for c in ("u", "size", "asks"))
            x = _matrix(group.column("unit"), "<f8")
            a, b = np.flatnonzero(asks == 1), np.flatnonzero(asks == 0)
            if not len(a) or not len(b):
                continue
            near = np.empty((len(a), len(b)), bool)
            for at in range(0, len(a), BLOCK):
                near[at : at + BLOCK] = _alike(x[a[at : at + BLOCK]], x[b], least)
            near &= ids[a][:, None] != ids[b][None, :]
            u, v = _forest(near)
            some = np.flatnonzero(near.any(axis=1))
            links = np.zeros(len(a), np.int64)
            links[some] = near[some] @ sizes[b]
            yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.nulls(len(a), pa.int64()), pa.array(links)], names=["u", "v", "links"])
            yield pa.RecordBatch.from_arrays([pa.array(ids[a][u]), pa.array(ids[b][v]), pa.nulls(len(u), pa.int64())], names=["u", "v", "links"])

    return _blocks_met(asked, table, (), run, "u bigint, v bigint, links bigint", block)


def bridges(table: DataFrame, comps: DataFrame, full: DataFrame, least: float) -> DataFrame | None:
    """Links (a, b) that join the components of the points ``full`` with whatever else links with them; None if there are none.

    A component's pivot is its first point, its reach the largest angle from there to another of its points.
    """
    named = comps.withColumnRenamed("node", "u")
    dense = written(named.join(full.select("u"), "u").select("component").distinct(), "nn-dense")
    if dense.isEmpty():
        return None
    members = written(table.join(named.join(dense, "component"), "u"), "nn-members")
    pivots = members.where("u = component").select("component", F.col("unit").alias("pivot"))

    def angles(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            pairs = zip(batch.column("unit").to_pylist(), batch.column("pivot").to_pylist())
            cosines = [float(np.frombuffer(x, "<f8") @ np.frombuffer(y, "<f8")) for x, y in pairs]
            yield pa.RecordBatch.from_arrays([batch.column("component"), pa.array(np.arccos(np.clip(cosines, -1, 1)), pa.float64())], names=["component", "angle"])

    spans = members.select("component", "unit").join(pivots, "component").mapInArrow(angles, "component bigint, angle double")
    reach = spans.groupBy("component").agg(F.max("angle").alias("reach"))
    asking = members.where("u = component").join(reach, "component").select(*table.columns, "reach")
    angle = float(np.arccos(least)) + 1e-6

    def within(batches: Iterator[pa.RecordBatch]):
        for _, group in grouped(batches, "cell"):
            ids, asks = np.asarray(group.column("u")), np.asarray(group.column("asks"))
            x = _matrix(group.column("unit"), "<f8")
            a, b = np.flatnonzero(asks == 1), np.flatnonzero(asks == 0)
            most = np.array([group.column("reach")[int(i)].as_py() for i in a]) + angle
            for i, limit in zip(a, most):
                near = b[np.arccos(np.clip(x[b] @ x[i], -1, 1)) <= limit]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(near), ids[i])), pa.array(ids[near])], names=["component", "u"])

    found = _blocks_met(asking, table, ("reach",), within, "component bigint, u bigint")
    others = found.join(named.withColumnRenamed("component", "_own"), "u", "left").where("_own is null or _own <> component").select("u", "component")
    others = written(others.join(table, "u").select("u", F.col("component").alias("side"), "size", "unit"), "nn-others")
    if others.isEmpty():
        return None
    return _linked(compared(others, members.select("u", F.col("component").alias("side"), "size", "unit"), least))


def _linked(compared: DataFrame) -> DataFrame:
    """The links (a, b) among the rows of ``compared``."""
    return compared.where("v is not null").select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"))


def audited(table: DataFrame, found: DataFrame, least: float, n: int) -> DataFrame:
    """(side, there, held): the links of up to about ``n`` points drawn from each label, and how many of them ``found`` counts."""
    sizes = table.groupBy("side").agg((n / F.count(F.lit(1))).alias("_share"))
    place = F.pmod(F.xxhash64("u", F.lit("audit")), F.lit(1 << 31)) / F.lit(1 << 31)
    asked = table.join(sizes, "side").where(place < F.col("_share")).select(*table.columns)
    true = compared(asked, table, least).where("v is null").groupBy("u").agg(F.sum("links").alias("there")).where("there > 0")
    both = true.join(found, "u", "left").join(table.select("u", "side"), "u")
    return written(both.groupBy("side").agg(F.sum("there").alias("there"), F.sum(F.coalesce("links", F.lit(0))).alias("held")), "nn-audit")


def near_duplicates(
    vectors: DataFrame, least: float = LEAST, keep: int = LIST, recall: float = RECALL, rounds: int = ROUNDS, seed: int = 0
) -> DataFrame:
    """(vec_id, n_links, component_id, kept, recall, recall_links) of every vector.

    ``recall`` is what the audit measured for the vector's label before the label was compared whole, if it was; ``recall_links``
    the number of links it was measured on.
    """
    members, table = points(vectors)
    single = written(table.mapInArrow(_single(), "u bigint, side bigint, size bigint, unit binary"), "nn-single")
    edges = written(started(single, keep, least, seed=seed), "nn-start")
    kept = table.select("u", F.lit(keep).alias("keep"))
    listed = lambda rows, old: rows.select("u", "v", "cosine", F.lit(old).alias("old"))
    lists = written(_lists(listed(edges.where("not made"), False), kept), "nn-lists")
    forest = [edges.where("made").select("u", "v", "cosine")]
    near = F.col("cosine") >= least - SLACK
    longest, turn = keep, 0

    def round_of(lists: DataFrame, only: DataFrame | None = None) -> DataFrame:
        fresh = written(_descend(lists, single, kept, longest, least, turn, only), "nn-round")
        forest.append(fresh.where("made").select("u", "v", "cosine"))
        return written(_lists(listed(lists, True).union(listed(fresh.where("not made"), False)), kept), "nn-lists")

    while True:
        for _ in range(rounds):
            turn += 1
            lists = round_of(lists)
            new, all_ = lists.agg(F.count_if(near & ~F.col("old")), F.count_if(near)).first()
            if new <= 0.01 * all_:
                break
        # Lists of nothing but links may hide further ones.
        while True:
            full = lists.groupBy("u").agg(F.min("cosine").alias("_least")).where(F.col("_least") >= least - SLACK)
            full = written(full.join(kept, "u").select("u", "keep"), "nn-full")
            narrow = full.where(F.col("keep") * 2 <= WIDEST * keep).select("u")
            if narrow.isEmpty():
                break
            kept = _enlarged(kept, narrow)
            longest = kept.agg(F.max("keep")).first()[0]
            turn += 1
            lists = round_of(lists, narrow)
        links = _verified(reduce(DataFrame.union, [lists.select("u", "v", "cosine"), *forest]), table, least)
        links = written(links, "nn-verified")
        comps = written(components(links), "nn-components")
        more = bridges(table, comps, full, least)
        if more is not None and not more.isEmpty():
            comps = written(components(links.union(more)), "nn-components")
        found = written(counted_links(table, comps, least), "nn-links")
        audit = audited(table, found, least, AUDIT)
        failed = audit.where(F.col("held") < recall * F.col("there")).select("side")
        if failed.isEmpty():
            break
        again = written(table.join(failed, "side").select(*table.columns), "nn-again")
        narrow = again.join(kept.where(F.col("keep") * 2 <= WIDEST * keep), "u").select("u")
        if narrow.isEmpty():
            # The widest lists do not do: compared whole.
            whole = _linked(compared(again, again, least))
            comps = written(components(whole.union(links) if more is None else whole.union(links).union(more)), "nn-components")
            found = written(counted_links(table, comps, least), "nn-links")
            break
        kept = _enlarged(kept, narrow)
        longest = kept.agg(F.max("keep")).first()[0]
    facts = written(
        table.select("u", "size", "side")
        .join(audit.select("side", (F.col("held") / F.col("there")).alias("recall"), F.col("there").alias("recall_links")), "side", "left")
        .join(found, "u", "left")
        .join(comps.withColumnRenamed("node", "u"), "u", "left")
        .select("u", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "u").alias("component_id"), "recall", "recall_links"),
        "nn-facts",
    )
    ids = vectors.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id")).distinct()
    of_vector = members.join(facts, "u").select("vec_id", "n_links", "component_id", "recall", "recall_links")
    return ids.join(of_vector, "vec_id", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.coalesce("component_id", "vec_id") == F.col("vec_id")).alias("kept"),
        "recall",
        "recall_links",
    )

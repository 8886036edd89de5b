"""Near-duplicate documents by DartMinHash signatures over word shingles.

A document is a weighted set of shingles (runs of five words, A-Z as a-z; a text
of fewer words is one shingle). Darts are thrown at every shingle's weight axis by
a hash of the shingle alone: a Poisson stream in rank order, each dart with a
height on the axis and a coordinate of the signature. A dart below the shingle's
weight hits; each coordinate keeps its earliest hit. Two documents agree in a
coordinate with the probability of their weighted Jaccard similarity, and a
document needs about k (ln k + 3) darts whatever its length. Streams are followed
until every coordinate is hit.

Bands of ``rows`` coordinates make buckets. Equal texts are one class member from
the start, and so are texts of equal signatures' whole band list only once their
similarity is checked: every link is verified on the exact shingle sets.

Within a bucket pairs are not all formed. The member that shares most buckets is
its hub and is compared with the others. Members of all buckets of one hub make a
group; those that are not yet in the hub's class (outsiders) are compared with the
whole group, block by block inside tasks that hand on links alone, so that no link
between classes is lost. Classes are the connected components of links with
similarity >= ``least``.

With 32 bands of 5 a pair of similarity 0.8 shares no bucket with probability
3e-6, one of 0.9 with 1e-12.

Null texts count as empty; empty texts are equal. Texts of white space alone have no
shingles: they are in a class with equal texts only. Null doc_ids are no documents
and get no row. Repeated doc_ids: the rows of an id are one document, whose text is
the one with the smallest md5 (``deduplicated`` compares the others too). An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrow.llm.components import components
from tallyrow.llm.words import blocks, grouped, mix64, text_buffer, word_hashes
from tallyrow.session import written

SHINGLE = 5
LEAST = 0.8
BANDS, ROWS = 32, 5
# Members of a block.
BLOCK = 256

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_NEXT = np.uint64(0xD1B54A32D192ED03)


def shingles(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, count) of the distinct shingles of each text, ascending."""
    words, _, row = word_hashes(*text_buffer(texts))
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    per_row = np.bincount(row, minlength=len(texts))
    with np.errstate(over="ignore"):
        # A position's shingle runs to the fifth word or, in a shorter text, to its end.
        first = np.cumsum(per_row) - per_row
        place = np.arange(len(words)) - first[row]
        begins = np.flatnonzero((place + size <= per_row[row]) | ((place == 0) & (per_row[row] < size)))
        hashes = np.zeros(len(begins), np.uint64)
        for k in range(size):
            at = np.minimum(begins + k, len(words) - 1)
            inside = place[begins] + k < per_row[row[begins]]
            hashes = mix64(hashes * _GOLDEN + np.where(inside, words[at], np.uint64(0)))
    row = row[begins]
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])])
    return row[new], hashes[new], np.diff(new, append=len(row))


def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(row: np.ndarray, element: np.ndarray, weight: np.ndarray, n_rows: int, k: int, reach: float = 1.0) -> np.ndarray:
    """The k kept darts of each of ``n_rows`` weighted sets; a set without weight has zeros."""
    out = np.zeros((n_rows, k), np.uint64)
    total = np.bincount(row, weight, minlength=n_rows)
    if not len(row):
        return out
    with np.errstate(over="ignore"):
        # The weight axis is cut into regions of height one, each with a stream of its own.
        layers = np.ceil(weight).astype(np.int64)
        source = np.repeat(np.arange(len(row)), layers)
        layer = np.arange(len(source)) - np.repeat(np.cumsum(layers) - layers, layers)
        stream = mix64(element[source] + (layer.astype(np.uint64) + np.uint64(1)) * _GOLDEN)
        height = np.minimum(weight[source] - layer, 1.0)
        where = row[source]
        limit = (reach * k * (np.log(k) + 3) / np.maximum(total, 1e-300))[where]
        earliest = np.full(n_rows * k, np.inf)
        rank = np.zeros(len(stream))
        hits = []
        while len(stream):
            stream = mix64(stream + _NEXT)
            rank = rank - np.log(_uniform(stream))
            go = np.flatnonzero(rank <= limit)
            stream, rank, limit, where, height = stream[go], rank[go], limit[go], where[go], height[go]
            detail = mix64(stream ^ _GOLDEN)
            coordinate = where * k + ((detail & np.uint64(0xFFFFFFFF)) % np.uint64(k)).astype(np.int64)
            low = _uniform(detail & ~np.uint64(0x7FF)) < height if height.size and height.min() < 1 else slice(None)
            np.minimum.at(earliest, coordinate[low], rank[low])
            hits.append((coordinate[low], rank[low], detail[low]))
        for coordinate, rank, detail in hits:
            best = earliest[coordinate] == rank
            out.reshape(-1)[coordinate[best]] = detail[best]
    # A set with an empty coordinate throws on, twice as far.
    short = np.flatnonzero(~np.isfinite(earliest.reshape(n_rows, k)).all(axis=1) & (total > 0))
    if len(short):
        number = np.full(n_rows, -1)
        number[short] = np.arange(len(short))
        mine = number[row] >= 0
        out[short] = signatures(number[row[mine]], element[mine], weight[mine], len(short), k, reach * 2)
    return out


def bands(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """The bucket of each band."""
    n, k = signature.shape
    parts = signature.reshape(n, k // rows, rows)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(numbered_bands(k // rows), (n, k // rows)).copy()
        for r in range(rows):
            key = mix64(key * _GOLDEN + parts[:, :, r])
    return key


def numbered_bands(n: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64))


def sketched(docs: DataFrame, weights: str = "set", size: int = SHINGLE, n_bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, digest of the text, buckets) of every row; texts without words have no bucket.

    ``weights``: a shingle weighs 1 ("set") or as often as it stands ("count").
    """

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in blocks(batches, most=2 << 20):
            row, element, count = shingles(batch.column("text"), size)
            weight = count.astype(float) if weights == "count" else np.ones(len(row))
            found = bands(signatures(row, element, weight, batch.num_rows, n_bands * rows), rows)
            some = np.bincount(row, minlength=batch.num_rows) > 0
            ends = np.r_[0, np.cumsum(some * n_bands)].astype(np.int32)
            keys = pa.ListArray.from_arrays(pa.array(ends), pa.array(found[some].ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), keys], names=["doc_id", "digest", "buckets"])

    text = F.coalesce(F.col("text"), F.lit(""))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.md5(text).alias("digest"), text.alias("text")).mapInArrow(run, f"doc_id {kind}, digest string, buckets array<bigint>")


def _sets(docs: DataFrame, ids: DataFrame, weights: str, size: int) -> DataFrame:
    """(doc_id, shingles, counts) of the documents in ``ids``: hashes of 32 bits, in order."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in blocks(batches):
            row, element, count = shingles(batch.column("text"), size)
            ends = np.r_[0, np.cumsum(np.bincount(row, minlength=batch.num_rows))].astype(np.int32)
            if weights == "count":
                # Every further standing of a shingle is an element of its own.
                again = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                with np.errstate(over="ignore"):
                    element = mix64(np.repeat(element, count) + again.astype(np.uint64) * _GOLDEN)
                ends = np.r_[0, np.cumsum(np.bincount(row, count, minlength=batch.num_rows))].astype(np.int32)
            values = pa.array((element >> np.uint64(32)).astype(np.uint32).view(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), values)], names=["doc_id", "shingles"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    chosen = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by("text", F.md5("text")).alias("text"))
    return chosen.mapInArrow(run, f"doc_id {kind}, shingles array<int>")


def linked(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets are at least ``least`` alike."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("_left"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("_right"))
    shared = F.size(F.array_intersect("_left", "_right"))
    sizes = F.size("_left") + F.size("_right")
    near = F.least(F.size("_left"), F.size("_right")) >= F.greatest(F.size("_left"), F.size("_right")) * least
    with_left = written(pairs.join(left, "a"), "dart-pairs")
    return with_left.join(right, "b").where(near).where(shared >= (sizes - shared) * least).select("a", "b")


def shared_counts(rows: np.ndarray, columns: np.ndarray, n: int, first: np.ndarray, width: int = 4096) -> np.ndarray:
    """How many elements each of the ``first`` sets shares with each of n sets, given as (set, element) pairs."""
    _, columns, times = np.unique(columns, return_inverse=True, return_counts=True)
    common = times[columns] > 1
    rows, columns = rows[common], np.cumsum(times > 1)[columns[common]] - 1
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    out = np.zeros((len(first), n), np.float32)
    total = int(columns[-1]) + 1 if len(columns) else 0
    for at in range(0, total, width):
        part = slice(*np.searchsorted(columns, [at, at + width]))
        table = np.zeros((n, min(width, total - at)), np.float32)
        table[rows[part], columns[part] - at] = 1
        out += table[first] @ table.T
    return out


def _links_of_cells(least: float):
    """Links of a cell's outsiders to members of other classes: of each outsider one per class."""

    def run(batches: Iterator[pa.RecordBatch]):
        for _, cell in grouped(batches, "cell"):
            ids, of = np.asarray(cell.column("id")), np.asarray(cell.column("class"))
            lists = cell.column("shingles")
            sizes = np.asarray(lists.value_lengths()).astype(np.int64)
            first = np.flatnonzero(np.asarray(cell.column("outside").cast(pa.int8())))
            rows = np.repeat(np.arange(len(ids)), sizes)
            shared = shared_counts(rows, np.asarray(lists.flatten()), len(ids), first)
            either = sizes[first][:, None] + sizes[None, :] - shared
            near = (shared > 0) & (shared >= either * least) & (of[first][:, None] != of[None, :])
            a, b = np.nonzero(near)
            if len(a):
                _, one = np.unique(np.stack([a, of[b]]), axis=1, return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids[first[a[one]]]), pa.array(ids[b[one]])], names=["a", "b"])

    return run


def links_across(groups: DataFrame, sets: DataFrame, least: float, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between members of different classes of a group (hub, id, class, outside).

    Outsiders and the rest of a group are cut into blocks; each block of outsiders meets
    every block of the group in a cell.
    """
    sizes = groups.groupBy("hub").agg(
        F.ceil(F.sum(F.col("outside").cast("int")) / block).cast("int").alias("_out"),
        F.ceil(F.sum((~F.col("outside")).cast("int")) / block).cast("int").alias("_in"),
    )
    open_ = groups.join(written(sizes.where("_out > 0"), "dart-open"), "hub")
    placed = open_.withColumn("_block", F.pmod(F.xxhash64("id"), F.greatest(F.when(F.col("outside"), F.col("_out")).otherwise(F.col("_in")), F.lit(1))).cast("int"))
    to = lambda n: F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1)
    mine = F.col("_block")
    with_outside = F.transform(to(F.col("_out")), lambda o: F.xxhash64("hub", F.lit("o"), F.least(mine, o), F.greatest(mine, o)))
    with_inside = F.transform(to(F.col("_in")), lambda i: F.xxhash64("hub", F.lit("i"), mine, i))
    from_inside = F.transform(to(F.col("_out")), lambda o: F.xxhash64("hub", F.lit("i"), o, mine))
    cells = F.when(F.col("outside"), F.concat(with_outside, with_inside)).otherwise(from_inside)
    spread = written(placed.select("id", "class", "outside", F.explode(cells).alias("cell")), "dart-cells")
    parts = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = spread.join(sets.withColumnRenamed("doc_id", "id"), "id").select("cell", "id", "class", "outside", "shingles")
    return met.repartition(parts, "cell").sortWithinPartitions("cell").mapInArrow(_links_of_cells(least), "a bigint, b bigint")


def classes(
    docs: DataFrame, weights: str = "set", least: float = LEAST, size: int = SHINGLE, n_bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """(doc_id, class_id) of every document: the smallest doc_id of its class."""
    texts = docs.where("doc_id is not null").select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    sketches = written(sketched(texts, weights, size, n_bands, rows), "dart-sketches")
    # One row per document, then one document per text.
    single = sketches.groupBy("doc_id").agg(F.min(F.struct("digest", "buckets")).alias("_s")).select("doc_id", "_s.*")
    single = written(single, "dart-documents")
    firsts = written(single.groupBy("digest").agg(F.min(F.struct("doc_id", "buckets")).alias("_s")).select("digest", F.col("_s.doc_id").alias("text_id"), "_s.buckets"), "dart-texts")
    exploded = firsts.select(F.explode("buckets").alias("bucket"), F.col("text_id").alias("id"))
    shared = exploded.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    members = written(exploded.join(shared, "bucket"), "dart-members")
    degree = written(members.groupBy("id").agg(F.sum("_n").alias("_degree")), "dart-degrees")
    ranked = written(members.select("bucket", "id").join(degree, "id"), "dart-ranked")
    hubs = written(ranked.groupBy("bucket").agg(F.max_by("id", F.struct("_degree", -F.col("id"))).alias("hub")), "dart-hubs")
    groups = written(members.select("bucket", "id").join(hubs, "bucket").select("hub", "id").distinct(), "dart-groups")
    pairs = groups.where("id != hub").select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()
    sets = written(_sets(texts, degree.select(F.col("id").alias("doc_id")), weights, size), "dart-sets")
    known = written(components(linked(pairs, sets, least)), "dart-known")
    class_of = lambda name, to: known.select(F.col("node").alias(name), F.col("component").alias(to))
    of_id = written(groups.join(class_of("id", "class"), "id", "left").select("hub", "id", F.coalesce("class", "id").alias("class")), "dart-placed")
    of_hub = of_id.join(class_of("hub", "_hubs"), "hub", "left").select("hub", "id", "class", (F.col("class") != F.coalesce("_hubs", "hub")).alias("outside"))
    second = written(links_across(written(of_hub, "dart-sided"), sets, least), "dart-links")
    found = known.select(F.col("node").alias("a"), F.col("component").alias("b")).union(second.select("a", "b"))
    final = written(components(found), "dart-classes").withColumnRenamed("node", "text_id")
    of_text = written(
        firsts.select("digest", "text_id").join(final, "text_id", "left").select("digest", F.coalesce("component", "text_id").alias("class_id")),
        "dart-text-classes",
    )
    return single.select("doc_id", "digest").join(of_text, "digest").select("doc_id", "class_id")


# Numbers from here on stand for texts that have no id of their own.
_ASIDE = 1 << 62


def _identified(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_item``, the same for rows of equal id and text alone.

    It is the doc_id for the text of smallest md5 of an id; further texts of an id and
    texts without one get a number above all ids by a hash of both.
    """
    digest = F.md5(F.coalesce("text", F.lit("")))
    facts = docs.where("doc_id is not null").select("doc_id", digest.alias("_d")).groupBy("doc_id").agg(F.min("_d").alias("_first"), F.max("_d").alias("_last"))
    several = written(facts.where("_first != _last").select("doc_id", "_first"), "dart-several")
    aside = F.lit(_ASIDE) + F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), digest), 2)
    other = F.col("doc_id").isNull() | (F.col("_first").isNotNull() & (digest != F.col("_first")))
    return docs.join(several, "doc_id", "left").withColumn("_item", F.when(other, aside).otherwise(F.col("doc_id"))).select(*docs.columns, "_item")


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """One row of each class of ``docs``: of its smallest doc_id, or of a text without one if it has only those.

    A row is known by its id and text: further texts of a doc_id and rows without one are compared
    like all others, and of rows equal in both the one with the smallest JSON stays.
    """
    items = written(_identified(docs), "dart-items")
    found = classes(items.select(F.col("_item").alias("doc_id"), "text"), **options)
    dropped = written(found.where("doc_id != class_id").select(F.col("doc_id").alias("_item")), "dart-dropped")
    kept = items.join(dropped, "_item", "left_anti")
    again = written(kept.groupBy("_item").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_item"), "dart-again")
    row = F.struct(*docs.columns)
    single = kept.join(again, "_item", "left_semi").groupBy("_item").agg(F.min_by(row, F.to_json(row)).alias("_s")).select("_s.*")
    return kept.join(again, "_item", "left_anti").select(*docs.columns).unionByName(single)

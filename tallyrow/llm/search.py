"""Exact BM25 top-k by an inverted index with block-max WAND pruning.

Index: every scan task cuts its documents into shards of a bounded number of
tokens. A shard's documents are ordered by length and cut into blocks; its files
hold sorted term hashes, their postings and document lengths. Document counts of
terms meet by hash in global tables, so every shard scores with the same
statistics.

Search: queries are stored in blocks with their global term weights; each pair of
shard and query block is a task. For a query, postings of its rarer terms are added
up exactly; its most frequent terms contribute, per block of documents, the largest
value they reach there (block-max). The block of largest bound is scored first and
gives a k-th best score; a block whose bound stays below it is never scored (WAND's
test). The others are, for all queries that need them at once, in single precision;
what comes within its error of the k best is scored again in double precision. The
shards' best are merged exactly.

score = sum over query terms of qtf * idf * tf (k1 + 1) / (tf + k1 (1 - b + b * length / mean length)),
idf = ln(1 + (N - df + 0.5) / (df + 0.5)), rounded to 6 decimals so that equal
texts tie in every shard; ties go to the smaller doc_id.

Words are runs of non-space, A-Z as a-z. Null and empty texts count as documents of
length 0 and match nothing; as queries they have no rows. Documents that share no
term are not returned, so a query may have fewer than k rows. Rows with a null
doc_id are documents that cannot be returned. Rows that repeat a doc_id are
documents of their own; a query id is the query once per row. Every pair of query and
document is covered, in blocks: work grows with the product of both counts.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyrow.llm import shards as sh
from tallyrow.llm.words import blocks, text_buffer, word_hashes
from tallyrow.session import written

K1, B = 1.2, 0.75
# Tokens of a shard, documents of a block, queries of a query block.
SHARD_TOKENS, BLOCK, QUERIES = 8_000_000, 64, 1024
# Shards that a task searches one after the other, about.
SHARDS = 4
# Queries that are scored together.
_AT_ONCE = 128
# Terms of a query block whose postings a shard holds as a table, most frequent first.
DENSE = 384
DECIMALS = 6

HITS = "query_id bigint, doc_id bigint, score double"


def _counted(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(term, row, count) of every distinct pair, by term then row, and the rows' lengths."""
    hashes, _, row = word_hashes(*text_buffer(texts))
    length = np.bincount(row, minlength=len(texts))
    order = np.argsort(hashes, kind="stable")  # rows ascend within a term
    hashes, row = hashes[order], row[order]
    new = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])]) if len(row) else np.zeros(0, np.int64)
    return hashes[new], row[new], np.diff(new, append=len(row)), length


def _build(folder: str, bits: int):
    def shard(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        ids = table.column("doc_id").chunk(0)
        term, row, count, length = _counted(table.column("text").chunk(0))
        order = np.argsort(length, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        by = np.lexsort((place[row], term))
        term, row, count = term[by], place[row][by], count[by]
        new = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, np.int64)
        known = np.array([i.is_valid for i in ids], bool)[order]
        name = f"{folder}/{uuid.uuid4().hex}"
        files = {
            "doc": np.asarray(ids.fill_null(0))[order].astype(np.int64),
            "known": known,
            "length": length[order].astype(np.int64),
            "term": term[new],
            "start": np.append(new, len(term)).astype(np.int64),
            "row": sh.narrow(row),
            "count": sh.narrow(count),
        }
        os.makedirs(name, exist_ok=True)
        for part, values in files.items():
            sh.save(f"{name}/{part}.npy", values)
        df = np.diff(new, append=len(term)).astype(np.uint64)
        if len(new):
            yield from sh.packed_rows(term[new], df, (term[new] >> np.uint64(64 - bits)).astype(np.uint16))
        # kind 1: a shard's name, documents and tokens.
        info = {"shard": pa.array([0], pa.int32()), "kind": pa.array([1], pa.int32()), "n": pa.array([len(ids)], pa.int64())}
        yield pa.RecordBatch.from_pydict({**info, "keys": pa.array([name.encode()], pa.binary()), "counts": pa.array([str(length.sum()).encode()], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]):
        held, size = [], 0
        for batch in blocks(batches):
            held.append(batch)
            size += int(text_buffer(batch.column("text"))[1][-1])
            if size > SHARD_TOKENS * 5:
                yield from shard(held)
                held, size = [], 0
        if held:
            yield from shard(held)

    return run


def _write_frequencies(folder: str):
    def run(batches):
        for shard, parts in sh.unpacked(batches):
            sums = sh.Sums()
            for _, keys, counts in parts:
                sums.add(keys, counts)
            keys, counts = sums.merged()
            sh.save(f"{folder}/{shard}.term.npy", keys)
            sh.save(f"{folder}/{shard}.df.npy", sh.narrow(counts))
            yield pa.RecordBatch.from_pydict({"n": [len(keys)]})

    return run


@dataclass(frozen=True)
class Statistics:
    """Global counts; document counts of terms lie in files by the terms' leading bits."""

    folder: str
    bits: int
    n_docs: int
    n_tokens: int

    def idf(self, terms: np.ndarray) -> np.ndarray:
        """Of distinct ascending terms; 0 for a term that no document has."""
        df = np.zeros(len(terms))
        cuts = np.searchsorted(terms >> np.uint64(64 - self.bits), np.arange((1 << self.bits) + 1, dtype=np.uint64))
        for s in np.flatnonzero(np.diff(cuts)):
            path = f"{self.folder}/{s}.term.npy"
            if not os.path.exists(path):
                continue
            table, part = sh.mapped(path), slice(cuts[s], cuts[s + 1])
            at = np.minimum(np.searchsorted(table, terms[part]), max(len(table) - 1, 0))
            if len(table):
                df[part] = np.where(table[at] == terms[part], sh.mapped(f"{self.folder}/{s}.df.npy")[at], 0)
        return np.where(df > 0, np.log1p((self.n_docs - df + 0.5) / (df + 0.5)), 0.0)


@dataclass(frozen=True)
class Index:
    shards: DataFrame  # name, docs, tokens
    statistics: Statistics


def build(docs: DataFrame) -> Index:
    """Indexes every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    bits = min(12, max(1, (rows.rdd.getNumPartitions() // 4).bit_length()))
    folder = sh.shared_folder(spark, "search-shards")
    made = written(rows.mapInArrow(_build(folder, bits), sh.PACKED), "search-built")
    frequencies = sh.shared_folder(spark, "search-frequencies")
    sh.by_shard(made.where("kind = 0"), 1 << bits, _write_frequencies(frequencies), "n bigint").agg(F.sum("n")).collect()
    info = made.where("kind = 1").select(F.decode("keys", "utf-8").alias("name"), F.col("n").alias("docs"), F.decode("counts", "utf-8").cast("long").alias("tokens"))
    shards = written(info, "search-index")
    total = shards.agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).first()
    return Index(shards, Statistics(frequencies, bits, total["docs"] or 0, total["tokens"] or 0))


def _write_queries(folder: str, statistics: Statistics):
    """Stores each block of queries: ids, and per query its terms with their weights."""

    def run(batches: Iterator[pa.RecordBatch]):
        held: dict[int, list[pa.RecordBatch]] = {}
        for batch in batches:
            of = np.asarray(batch.column("block"))
            for b in np.unique(of):
                held.setdefault(int(b), []).append(batch.filter(pa.array(of == b)))
        for b, parts in held.items():
            table = pa.Table.from_batches(parts).combine_chunks()
            term, row, count, _ = _counted(table.column("text").chunk(0))
            by = np.lexsort((term, row))
            term, row, count = term[by], row[by], count[by]
            distinct = np.unique(term)
            idf = statistics.idf(distinct)
            weight = idf[np.searchsorted(distinct, term)] * count
            keep = weight > 0
            starts = np.r_[0, np.cumsum(np.bincount(row[keep], minlength=table.num_rows))]
            sh.save(f"{folder}/{b}.id.npy", np.asarray(table.column("query_id").chunk(0)).astype(np.int64))
            sh.save(f"{folder}/{b}.start.npy", starts)
            sh.save(f"{folder}/{b}.term.npy", term[keep])
            sh.save(f"{folder}/{b}.weight.npy", weight[keep])
            yield pa.RecordBatch.from_pydict({"block": pa.array([b], pa.int32())})

    return run


def _lower(rough: np.ndarray) -> np.ndarray:
    """No more than what a score in single precision stands for."""
    return np.where(rough > -np.inf, rough * (1 - 1e-4) - 1e-3, -np.inf)


def _postings(start: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of all postings of the terms, how many each has)."""
    begin, many = start[terms], start[terms + 1] - start[terms]
    return np.repeat(begin - (np.cumsum(many) - many), many) + np.arange(many.sum()), many


def search_shard(name: str, queries: str, mean: float, k: int, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query's place, doc_id, score) of the best k of each query of a block in a shard, and how many pairs were scored.

    ``least`` is a score that each query's hits must reach, known from other shards.
    """
    doc, length, terms, start, known = (sh.mapped(f"{name}/{p}.npy") for p in ("doc", "length", "term", "start", "known"))
    q_id, q_start, q_term, q_weight = (sh.mapped(f"{queries}.{p}.npy") for p in ("id", "start", "term", "weight"))
    nothing = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), 0
    if not len(terms) or not len(q_term):
        return nothing
    n, rows = len(doc), np.asarray(sh.mapped(f"{name}/row.npy"), np.int64)
    count = np.asarray(sh.mapped(f"{name}/count.npy"), np.float64)
    impact = count * (K1 + 1) / (count + (K1 * (1 - B + B * length / mean))[rows])
    wanted = np.unique(q_term)
    at = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
    here = terms[at] == wanted
    wanted, at = wanted[here], at[here]
    if not len(wanted):
        return nothing
    # The most frequent terms as a table of documents x terms, with the blocks' largest values.
    size = start[at + 1] - start[at]
    frequent = np.argsort(-size, kind="stable")[:DENSE]
    frequent = frequent[size[frequent] * 32 >= n]
    column = np.full(len(wanted), -1)
    column[frequent] = np.arange(len(frequent))
    table = np.zeros((n, len(frequent)))
    for c, t in enumerate(at[frequent]):
        part = slice(start[t], start[t + 1])
        table[rows[part], c] = impact[part]
    table_rough = table.astype(np.float32)
    edges = np.arange(0, n, BLOCK)
    peaks = np.maximum.reduceat(table, edges, axis=0) if len(frequent) else np.zeros((len(edges), 0))
    found, scored = [], 0
    for first in range(0, len(q_id), _AT_ONCE):
        chosen = range(first, min(first + _AT_ONCE, len(q_id)))
        often, exact = np.zeros((len(chosen), len(frequent))), np.zeros((len(chosen), n))
        for i, q in enumerate(chosen):
            term, weight = q_term[q_start[q] : q_start[q + 1]], q_weight[q_start[q] : q_start[q + 1]]
            place = np.minimum(np.searchsorted(wanted, term), len(wanted) - 1)
            hit = wanted[place] == term
            place, weight = place[hit], weight[hit]
            dense = column[place] >= 0
            often[i, column[place[dense]]] = weight[dense]
            posting, many = _postings(start, at[place[~dense]])
            exact[i] = np.bincount(rows[posting], np.repeat(weight[~dense], many) * impact[posting], minlength=n)
        exact[:, ~known] = -np.inf
        # A block's bound: its best sum over rarer terms and the largest values of the frequent ones.
        bound = np.maximum.reduceat(exact, edges, axis=1) + often @ peaks.T
        known_floor = np.zeros(len(chosen)) if least is None else least[first : first + len(chosen)] * (1 - 1e-4) - 1e-3
        todo = (bound > 0) & (bound >= known_floor[:, None])
        # The blocks of largest bound give each query a k-th best score to beat.
        here = np.zeros_like(todo)
        np.put_along_axis(here, np.argsort(-bound, axis=1)[:, : 1 + k // BLOCK], True, axis=1)
        here &= todo
        rough, often_rough = np.full((len(chosen), n), -np.inf, np.float32), often.astype(np.float32)
        for turn in range(2):
            for b in np.flatnonzero(here.any(axis=0)):
                who = np.flatnonzero(here[:, b])
                part = slice(edges[b], min(edges[b] + BLOCK, n))
                rough[who, part] = exact[who, part] + often_rough[who] @ table_rough[part].T
                scored += len(who) * (part.stop - part.start)
            floor = _lower(np.partition(rough, n - k, axis=1)[:, n - k]) if n >= k else np.zeros(len(chosen))
            floor = np.maximum(floor, known_floor)
            # The test: a block that cannot reach it is not scored.
            todo &= ~here
            here = todo & (bound >= floor[:, None])
        i, j = np.nonzero((rough >= floor[:, None]) & (rough > -np.inf))
        for at_once in range(0, len(i), 1 << 14):
            x, y = i[at_once : at_once + (1 << 14)], j[at_once : at_once + (1 << 14)]
            score = np.round(exact[x, y] + np.einsum("ij,ij->i", often[x], table[y]), DECIMALS)
            good = score > 0
            found.append((first + x[good], y[good], score[good]))
    if not found:
        return nothing
    q, d, s = (np.concatenate([f[i] for f in found]) for i in range(3))
    return *best(q, doc[d], s, k), scored


def best(query: np.ndarray, doc: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's k best hits: by score, then the smaller doc_id."""
    order = np.lexsort((doc, -score, query))
    query, doc, score = query[order], doc[order], score[order]
    new = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.zeros(0, np.int64)
    kept = np.arange(len(query)) - np.repeat(new, np.diff(new, append=len(query))) < k
    return query[kept], doc[kept], score[kept]


def search_shards(names: list[str], queries: str, mean: float, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query_id, doc_id, score) of the best k of each query of a block in several shards, one after the other.

    A query with k hits so far only takes what is no worse in the next shard.
    """
    ids = sh.mapped(f"{queries}.id.npy")
    q, d, s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    for name in names:
        filled = np.bincount(q, minlength=len(ids)) >= k
        least = np.full(len(ids), np.inf)
        np.minimum.at(least, q, s)
        more = search_shard(name, queries, mean, k, np.where(filled, least, 0.0))
        q, d, s = best(*(np.concatenate(x) for x in zip((q, d, s), more[:3])), k)
    return ids[q], d, s


def search(index: Index, queries: DataFrame, k: int = 10, per_block: int = QUERIES) -> DataFrame:
    """(query_id, rank, doc_id, score) of each query (query_id, text) against all indexed documents."""
    spark = queries.sparkSession
    folder = sh.shared_folder(spark, "search-queries")
    asked = queries.where("query_id is not null and text is not null").select(F.col("query_id").cast("long").alias("query_id"), F.col("text"))
    n_blocks = max(1, -(-asked.count() // per_block))
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)).cast("int"))
    stored = written(dealt.repartition(n_blocks, "block").mapInArrow(_write_queries(folder, index.statistics), "block int"), "search-blocks")
    # A task for some shards and a block of queries: file names, no rows of either.
    names = sorted(r["block"] for r in stored.collect())
    groups = max(1, -(-index.shards.count() // SHARDS))
    some = index.shards.groupBy(F.pmod(F.xxhash64("name"), F.lit(groups)).alias("group")).agg(F.sort_array(F.collect_list("name")).alias("names"))
    tasks = written(some.select("names", F.explode(F.array(*map(F.lit, names or [0]))).alias("block")), "search-tasks")
    if not names:
        tasks = tasks.where("false")
    mean = max(index.statistics.n_tokens / max(index.statistics.n_docs, 1), 1e-9)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for names, block in zip(batch.column("names").to_pylist(), batch.column("block").to_pylist()):
                q, d, s = search_shards(names, f"{folder}/{block}", mean, k)
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(d, pa.int64()), pa.array(s, pa.float64())], names=["query_id", "doc_id", "score"])

    hits = tasks.repartition(max(1, tasks.count()), "names", "block").mapInArrow(run, HITS)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    # At most k rows per group of shards and query come together here.
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")

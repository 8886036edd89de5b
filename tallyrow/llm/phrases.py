"""Collocations: phrases whose words stand together more often than their parts suggest, counted by multikey quicksort.

1. **Pointers.** Every word of a text points at its suffix: itself and up to four words that follow
   in its piece. A task puts equal suffixes together with a count, so a passage
   that stands everywhere travels once per task.
2. **Routing.** Suffixes go to buckets by language and their first two words; the counts of
   single words go by the word. A bucket that holds more than ``_MOST`` different suffixes
   (one pair of words with countless sequels) is not sorted: its suffixes are sent on by
   three words, then four, then five, the counts of their first words on their own. So no task
   holds more, however frequent a word or phrase is, and nothing is left out.
3. **Sorting.** Within a bucket three-way radix quicksort parts the pointers of each segment by one word into
   smaller, equal and greater ones, all segments at once; equal ones go on with the next word. The weight of an
   equal part is the count of the phrase it has in common. A part lighter than
   ``least`` is abandoned on the spot: no phrase in it can be frequent.
4. **Scores.** Only phrases with ``least`` occurrences come out of the tasks; they are
   joined with the counts of their parts, in decimals.

Pieces end at ``.,;:!?`` and line breaks; words end at blanks and tabs; A-Z count as a-z. A null
text is empty, a null language ``und``. Repeated rows count as often as they stand. Columns other
than ``text`` and ``lang`` are not looked at. An empty table, or one without a frequent phrase, gives no row.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyrow.llm.words import blocks, mix64
from tallyrow.session import written

LONGEST = 5
LEAST = 100
TOP = 2000
UNKNOWN = "und"

# Suffixes that a task gathers before it sends them on, and different ones that it sorts together.
_GATHER, _MOST = 1 << 21, 1 << 21
_BUCKETS = 256
# Parts a language's phrases are ranked in before they are ranked as a whole.
_SPREAD = (4096, 64)

_TOKEN = re.compile(rb"[^\x20\x09.,;:!?\x0A-\x0D]+|[.,;:!?\x0A-\x0D]")
_ENDS = [bytes([c]) for c in (*b".,;:!?", *range(10, 14))]

# Suffixes of one language in one bucket; they count phrases of lo to hi words. Or a phrase and its count.
_SCHEMA = "bucket bigint, lo int, hi int, lang string, n bigint, words binary, ids binary, counts binary, phrase string, k int, f bigint"
_NAMES = [field.split()[0] for field in _SCHEMA.split(", ")]
_TYPES = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = [_TYPES[field.split()[1]] for field in _SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], t) for c, t in zip(_NAMES, kinds)], names=_NAMES)


class _Numbers(dict):
    """Numbers words from 1 in the order they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) + 1
        return number


def _merged(columns: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different rows of columns (one word place each) in order, with the sums of their counts."""
    if not len(counts):
        return columns, counts
    wide = columns.astype(np.int64)
    keys = [wide[i] << 32 | wide[i + 1] if i + 1 < len(wide) else wide[i] for i in range(0, len(wide), 2)]
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[0] = True
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    begin = np.flatnonzero(new)
    return columns[:, order[begin]], np.add.reduceat(counts[order], begin)


def _suffixes(row: np.ndarray) -> np.ndarray:
    """The columns of every suffix in a row of word numbers, where 0 ends a piece."""
    at = np.flatnonzero(row)
    row = np.append(row, np.zeros(LONGEST, row.dtype))
    columns = np.zeros((LONGEST, len(at)), row.dtype)
    open_ = np.ones(len(at), bool)
    for k in range(LONGEST):
        columns[k] = np.where(open_, row[at + k], 0)
        open_ &= columns[k] != 0
    return columns


Key = tuple[int, int, int, str]  # bucket, lo, hi, language


def _routed(columns: np.ndarray, counts: np.ndarray, words: np.ndarray, key: Key, buckets: int) -> Iterator[dict]:
    """Rows of suffixes by bucket of the bucket they come from (0: the first deal); ``words`` holds the word of each number (0: none)."""
    source, lo, hi, lang = key
    if not len(counts):
        return
    used = np.zeros(len(words), bool)
    used[columns[:lo]] = True
    hashed = np.zeros(len(words), np.uint64)
    hashed[used] = [zlib.crc32(w) for w in words[used]]
    with np.errstate(over="ignore"):
        route = np.full(len(counts), zlib.crc32(lang.encode()) ^ source, np.uint64)
        for column in columns[:lo]:
            route = mix64(route * np.uint64(0x9E3779B97F4A7C15) + hashed[column])
        bucket = route % np.uint64(buckets) + np.uint64(1)
        if source:  # a part of that bucket alone, so that it gets smaller
            bucket = mix64(bucket + np.uint64(source) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(1)
    bucket = bucket.astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    columns, counts, bucket = columns[:hi, order], counts[order], bucket[order]
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    for at, to in zip(cuts, np.append(cuts[1:], len(bucket))):
        own, ids = np.unique(columns[:, at:to], return_inverse=True)
        if own[0]:
            own, ids = np.append(0, own), ids + 1  # 0 stays the end
        ids = ids.astype(np.min_scalar_type(len(own)))
        yield {
            "bucket": int(bucket[at]), "lo": lo, "hi": hi, "lang": lang, "n": int(to - at),
            "words": pa.compress(b" ".join(words[own[1:]]), codec="zstd", asbytes=True),
            "ids": pa.compress(ids.tobytes(), codec="zstd", asbytes=True),
            "counts": pa.compress(counts[at:to].astype("<i8").tobytes(), codec="zstd", asbytes=True),
        }


def _sized(rows: Iterator[dict], most: int = 64) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _deeper(columns: np.ndarray, counts: np.ndarray, words: np.ndarray, key: Key, buckets: int) -> Iterator[dict]:
    """The counts of the first ``lo`` words on their own, and the suffixes by one word more."""
    source, lo, hi, lang = key
    yield from _routed(*_merged(columns[:lo], counts), words, (source, lo, lo, lang), buckets)
    if lo < hi:
        on = columns[lo] != 0
        yield from _routed(columns[:, on], counts[on], words, (source, lo + 1, hi, lang), buckets)


def _pointers(buckets: int):
    """The task that turns texts into routed suffixes."""

    def flushed(rows: dict[str, list[np.ndarray]], numbers: _Numbers) -> Iterator[dict]:
        words = np.empty(len(numbers) + 1, object)
        words[0] = b""
        for word, number in numbers.items():
            words[number] = word
        for lang, parts in rows.items():
            columns = _suffixes(np.concatenate(parts))
            columns, counts = _merged(columns, np.ones(columns.shape[1], np.int64))
            yield from _deeper(columns, counts, words, (0, 1, LONGEST, lang), buckets)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        numbers, rows, gathered = _Numbers(), {}, 0
        for batch in blocks(batches):
            by_lang: dict[str, list[str]] = {}
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                if text:
                    by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                tokens = _TOKEN.findall("\n".join(texts).encode().lower() + b"\n")
                row = np.fromiter(map(numbers.__getitem__, tokens), np.int32, len(tokens))
                rows.setdefault(lang, []).append(row)
                gathered += len(row)
            if gathered >= _GATHER:
                yield from flushed(_cut(rows, numbers), numbers)
                numbers, rows, gathered = _Numbers(), {}, 0
        yield from flushed(_cut(rows, numbers), numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _sized(rows_of(batches))

    return run


def _cut(rows: dict[str, list[np.ndarray]], numbers: _Numbers) -> dict[str, list[np.ndarray]]:
    """The same rows with 0 for what ends a piece."""
    ends = [numbers[sign] for sign in _ENDS]
    zero = np.arange(len(numbers) + 1, dtype=np.int32)
    zero[ends] = 0
    return {lang: [zero[row] for row in parts] for lang, parts in rows.items()}


def frequent(columns: np.ndarray, weights: np.ndarray, lo: int, hi: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multikey quicksort: (a suffix that begins with the phrase, its words, its weight) of phrases with ``lo`` to ``hi`` words.

    Each round parts every open segment at the word of its middle pointer. Segments lighter than ``least`` are abandoned.
    """
    pointers = np.arange(columns.shape[1])
    begin, depth = np.zeros(1 if len(pointers) else 0, np.int64), np.zeros(1 if len(pointers) else 0, np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(begin):
        size = np.diff(begin, append=len(pointers))
        segment = np.repeat(np.arange(len(begin)), size)
        at = depth[segment]
        word = columns[at, pointers]
        side = np.sign(word - word[begin + size // 2][segment]) + 1
        # Stable three-way split of all segments at once.
        part = segment * 3 + side
        length = np.bincount(part, minlength=3 * len(begin))
        first = np.cumsum(length) - length
        place = np.empty(len(pointers), np.int64)
        for s in range(3):
            here = np.flatnonzero(side == s)
            run = part[here]
            rank = np.arange(len(here)) - np.repeat(np.cumsum(length[s::3]) - length[s::3], length[s::3])
            place[here] = first[run] + rank
        moved = np.empty_like(pointers)
        moved[place] = pointers
        weight = np.zeros(len(length), np.int64)
        filled = np.flatnonzero(length)
        weight[filled] = np.add.reduceat(weights[moved], first[filled])
        kind = np.arange(len(length)) % 3
        deep = np.repeat(depth, 3) + (kind == 1)
        head = moved[np.minimum(first, len(moved) - 1)]
        ended = (kind == 1) & (columns[deep - (kind == 1), head] == 0)
        heavy = (weight >= least) & (length > 0) & ~ended
        done = heavy & (kind == 1) & (deep >= lo)
        found.append((head[done], deep[done], weight[done]))
        stay = heavy & (deep < hi)
        pointers = moved[np.repeat(stay, length)]
        begin = np.cumsum(length[stay]) - length[stay]
        depth = deep[stay]
    if not found:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    return tuple(np.concatenate(x) for x in zip(*found))  # type: ignore[return-value]


class _Bucket:
    """Suffixes of one language that are sorted together."""

    def __init__(self):
        self.numbers, self.parts, self.waiting = _Numbers(), [], 0

    def add(self, columns: np.ndarray, counts: np.ndarray, words: list[bytes]) -> None:
        table = np.fromiter((0, *map(self.numbers.__getitem__, words)), np.int32, len(words) + 1)
        self.parts.append((table[columns], counts))
        self.waiting += len(counts)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        columns, counts = _merged(np.concatenate([c for c, _ in self.parts], axis=1), np.concatenate([n for _, n in self.parts]))
        self.parts, self.waiting = [(columns, counts)], len(counts)
        return columns, counts

    def words(self) -> np.ndarray:
        out = np.empty(len(self.numbers) + 1, object)
        out[0] = b""
        out[1:] = list(self.numbers)
        return out


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Columns, counts and words of a routed row."""
    n, hi = row["n"], row["hi"]
    words = _inflate(row["words"]).split(b" ")
    ids = np.frombuffer(_inflate(row["ids"]), np.min_scalar_type(len(words) + 1)).reshape(hi, n)
    return ids, np.frombuffer(_inflate(row["counts"]), "<i8"), words


def _inflate(data: bytes) -> bytes:
    return pa.CompressedInputStream(pa.BufferReader(data), "zstd").read()


def _counting(least: int, buckets: int):
    """The task that sorts buckets, or sends on those that are too large."""

    def one(key: Key, rows: Iterator[dict]) -> Iterator[dict]:
        lo, hi, lang = key[1:]
        bucket, spread = _Bucket(), False
        for row in rows:
            columns, counts, words = _unpacked(row)
            if spread:
                yield from _deeper(columns, counts, np.array([b"", *words], object), key, buckets)
                continue
            bucket.add(columns, counts, words)
            if bucket.waiting > _MOST and len(bucket.merged()[1]) > _MOST // 2:
                yield from _deeper(*bucket.merged(), bucket.words(), key, buckets)
                bucket, spread = _Bucket(), True
        if spread:
            return
        columns, counts = bucket.merged()
        if lo == hi == 1:
            yield {"lang": lang, "phrase": "", "k": 0, "f": int(counts.sum())}
        words = bucket.words()
        for head, k, f in zip(*(x.tolist() for x in frequent(columns, counts, lo, hi, least))):
            yield {"lang": lang, "phrase": b" ".join(words[columns[:k, head]]).decode(), "k": k, "f": f}

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        source = (row for batch in batches for i in range(batch.num_rows) for row in batch.slice(i, 1).to_pylist())
        row = next(source, None)
        while row is not None:
            key, rest = tuple(row[c] for c in ("bucket", "lo", "hi", "lang")), []

            def same(first: dict) -> Iterator[dict]:
                now: dict | None = first
                while now is not None and tuple(now[c] for c in ("bucket", "lo", "hi", "lang")) == key:
                    yield now
                    now = next(source, None)
                rest.append(now)

            yield from one(key, same(row))
            row = rest[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _sized(rows_of(batches), 256)

    return run


def counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, k, f): phrases of k = 1 to 5 words with at least ``least`` occurrences; k = 0: all words of a language."""
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(_BUCKETS, tasks)
    texts = docs.select("text", F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"))
    waiting, found, turn = texts.mapInArrow(_pointers(buckets), _SCHEMA), None, 1
    while True:
        dealt = waiting.repartitionById(tasks, F.expr(f"cast(pmod(bucket, {tasks}) as int)")).sortWithinPartitions("bucket", "lo", "hi", "lang")
        out = written(dealt.mapInArrow(_counting(least, buckets), _SCHEMA), f"phrases-{turn}")
        here = out.where("f is not null").select("lang", "phrase", "k", "f")
        found = here if found is None else found.unionByName(here)
        waiting = out.where("bucket is not null")
        if waiting.select("bucket").isEmpty():
            break
        turn += 1
    words = found.where("k = 0").groupBy("lang").agg(F.sum("f").alias("f"))
    return found.where("k > 0").unionByName(words.select("lang", F.lit("").alias("phrase"), F.lit(0).alias("k"), "f"))


def _top(rows: DataFrame, top: int) -> DataFrame:
    """The first rows of each language, ranked in parts first so that no task sorts a whole language."""
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    for parts in _SPREAD:
        salt = F.pmod(F.xxhash64("phrase"), F.lit(parts))
        place = F.row_number().over(Window.partitionBy("lang", salt).orderBy(*order))
        rows = rows.withColumn("_place", place).where(F.col("_place") <= top).drop("_place")
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, covered: int = 100) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's first ``top`` phrases of two to five words.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its weakest cut, ``n`` all words of the language; score is
    floor(1000 a n / (l r)). A phrase inside a longer one that has at least ``covered`` percent of its occurrences is left out.
    """
    known = written(counts(docs, least), "phrases")
    words = known.where("k = 0").select("lang", F.col("f").alias("n"))
    known = known.where("k > 0")
    some = known.where("k > 1").withColumnRenamed("f", "a")
    # Every cut into a first part of j words and a rest.
    cuts = (
        some.join(words, "lang")
        .withColumn("j", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
        .withColumn("first", F.expr("substring_index(phrase, ' ', j)"))
        .withColumn("rest", F.expr("substring_index(phrase, ' ', j - k)"))
    )
    part = lambda name, count: known.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))
    wide = "cast({} as decimal(38, 0))"
    score = F.expr(f"({wide.format('1000')} * a * n) div ({wide.format('l')} * r)")
    weakest = (
        cuts.join(part("first", "l"), ["lang", "first"])
        .join(part("rest", "r"), ["lang", "rest"])
        .withColumn("score", score)
        .groupBy("lang", "phrase", "a", "n")
        .agg(F.min(F.struct("score", "j", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "n", "cut.l", "cut.r", "cut.score")
    )
    inner = F.expr(
        "flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1), s -> array_join(slice(split(phrase, ' '), s, m), ' '))))"
    )
    longer = (
        some.where("k > 2").select("lang", "a", F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    )
    free = weakest.join(longer, ["lang", "phrase"], "left").where(f"_longer is null or 100 * _longer < {int(covered)} * a")
    return _top(free.drop("_longer"), top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

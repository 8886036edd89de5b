"""Row-local lookups in small, size-checked tables.

A join would multiply text rows by their token count and shuffle the result.
These lookups keep one row per text: the table travels as a literal in the plan.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Larger tables must be joined instead.
MAX_INLINE_ROWS = 131_072


def word_lookup(entries: Sequence[tuple[str, int, int]]):
    """A function from a word column to its id (null when absent).

    ``entries`` are (word, id, xxhash64 of the word as Spark computes it). Spark
    scans a map entry by entry, so one big map costs its length per token. The
    words are therefore spread over an array of tiny maps, addressed by the
    word's hash: constant cost per token.
    """
    if len(entries) > MAX_INLINE_ROWS:
        raise ValueError(f"{len(entries)} words are too many to inline; join the table")
    buckets = max(1, len(entries))
    table: list[dict[str, int]] = [{} for _ in range(buckets)]
    for word, number, digest in entries:
        table[digest % buckets][word] = number
    maps = F.from_json(F.lit(json.dumps(table)), "array<map<string,int>>")

    def find(word: Column) -> Column:
        return F.get(maps, F.pmod(F.xxhash64(word), F.lit(buckets)).cast("int"))[word]

    return find


def position_lookup(values: Sequence[str]):
    """A function from a 0-based position column to the value there (null outside)."""
    if len(values) > MAX_INLINE_ROWS:
        raise ValueError(f"{len(values)} values are too many to inline; join the table")
    array = F.from_json(F.lit(json.dumps(list(values))), "array<string>")
    return lambda position: F.get(array, position)

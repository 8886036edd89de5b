"""Predicates and identities over a declared, possibly composite, row key."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

Key = str | Sequence[str]


def key_columns(key: Key) -> list[str]:
    """Column names of a key; an empty key is refused (a table has no order of its own)."""
    names = [key] if isinstance(key, str) else list(key)
    if not names:
        raise ValueError("declare at least one key column")
    return names


def _all(parts: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts)


def _any(parts: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts)


def _beyond(names: list[str], values: Sequence[Any], upward: bool) -> list[Column]:
    """One alternative per key column: equal before it, strictly beyond at it."""
    out = []
    for i, name in enumerate(names):
        column, value = F.col(name), F.lit(values[i])
        strict = column > value if upward else column < value
        out.append(_all([*(F.col(n) == F.lit(v) for n, v in zip(names[:i], values)), strict]))
    return out


def at_or_after(key: Key, values: Sequence[Any]) -> Column:
    """key >= values, in key order.

    The leading comparison is implied by the rest; stated on its own it reaches
    the parquet scan and skips row groups.
    """
    names = key_columns(key)
    same = _all(F.col(n) == F.lit(v) for n, v in zip(names, values))
    return (F.col(names[0]) >= F.lit(values[0])) & _any([*_beyond(names, values, True), same])


def before(key: Key, values: Sequence[Any]) -> Column:
    """key < values, in key order, with the same scan-side bound."""
    names = key_columns(key)
    return (F.col(names[0]) <= F.lit(values[0])) & _any(_beyond(names, values, False))


def key_digest(seed: int, columns: Sequence[str]) -> Column:
    """md5 of ``seed:col:col...``; the same text hashes the same in any engine."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *(F.col(c).cast("string") for c in columns)))

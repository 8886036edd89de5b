"""Positional slices in key order.

A slice [a:b] is turned into two key bounds, then into a filter: rows are never
sorted or numbered, and the bounds reach the scan.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrow.functions.keys import Key, at_or_after, before
from tallyrow.functions.ordering import DIRECT_LIMIT, check_key, head_end, keys_at
from tallyrow.sources.tables import SPLIT_COLUMN, select_split

_BOUND = r"(\d+%?)?"
_SPEC = re.compile(rf"^(\w+)(?:\[{_BOUND}:{_BOUND}\])?$")


def slice_rows(
    df: DataFrame,
    key: Key,
    start: int = 0,
    stop: int | None = None,
    strict: bool = False,
    direct_limit: int = DIRECT_LIMIT,
) -> DataFrame:
    """Rows at positions [start, stop) of the key order.

    Bounds past the end are clamped; ``strict`` raises instead. Null or repeated
    keys raise ValueError: no position is theirs. A short head (``start`` 0, at most
    ``direct_limit`` rows) is checked as far as it goes, without a shuffle of the keys; repeated
    keys after it do not move it.
    """
    if start < 0 or (stop is not None and stop < 0):
        raise ValueError("slice bounds must not be negative")
    if not start and not strict and stop and stop <= direct_limit:
        end = head_end(df, key, stop)
        return df if end is None else df.where(before(key, end))
    check_key(df, key)
    wanted = [start] if start else []
    if stop is not None:
        wanted += [stop, stop - 1] if strict and stop else [stop]
    found = keys_at(df, key, wanted, direct_limit)
    if strict and ((stop and stop - 1 not in found) or (start and start not in found and start != stop)):
        raise ValueError(f"slice [{start}:{'' if stop is None else stop}] runs past the last row")
    if (stop is not None and stop <= start) or (start and start not in found):
        return df.where(F.lit(False))
    if start:
        df = df.where(at_or_after(key, found[start]))
    if stop in found:
        df = df.where(before(key, found[stop]))
    return df


def _position(bound: str | None, rows: int | None) -> int | None:
    if bound is None:
        return None
    if bound.endswith("%"):
        return round(int(bound[:-1]) * rows / 100)
    return int(bound)


def slice_spec(
    df: DataFrame, spec: str, key: Key, strict: bool = False, direct_limit: int = DIRECT_LIMIT
) -> DataFrame:
    """A slice written as ``name``, ``name[:n]``, ``name[a:b]`` or with percents.

    The name picks a split where the table has a ``split`` column. A percent p
    stands for position round(p * rows / 100), halves to even.
    """
    parsed = _SPEC.match(spec)
    if parsed is None:
        raise ValueError(f"cannot read slice {spec!r}")
    name, low, high = parsed.groups()
    if SPLIT_COLUMN in df.columns:
        df = select_split(df, name)
    if low is None and high is None:
        return df
    percent = any(bound and bound.endswith("%") for bound in (low, high))
    rows = df.count() if percent else None
    return slice_rows(df, key, _position(low, rows) or 0, _position(high, rows), strict, direct_limit)


def train_val_split(df: DataFrame, key: Key, n_train: int, n_val: int) -> DataFrame:
    """The first ``n_train`` rows as split ``train``, the next ``n_val`` as ``validation``.

    Later rows are in neither.
    """
    check_key(df, key)
    bounds = keys_at(df, key, [n_train, n_train + n_val])
    if n_train + n_val in bounds:
        df = df.where(before(key, bounds[n_train + n_val]))
    name = F.lit("train")
    if n_train in bounds:
        name = F.when(before(key, bounds[n_train]), name).otherwise(F.lit("validation"))
    return df.withColumn(SPLIT_COLUMN, name)


def split_by_share(df: DataFrame, key: Key, percent: int) -> DataFrame:
    """Every row, the first ``percent`` of the key order as split ``train``, the others as ``validation``.

    Rounded like a percent slice: halves to even.
    """
    rows = df.count()
    n_train = _position(f"{percent}%", rows)
    return train_val_split(df, key, n_train, rows - n_train)

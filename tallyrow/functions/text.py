"""Text columns: null handling, word splitting, response features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a word is a run of anything but space, newline, tab, return.
WORD_PATTERN = r"[^ \n\t\r]+"


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def words(column: Column) -> Column:
    """The words of a text; none for a null text."""
    return F.regexp_extract_all(F.coalesce(column, F.lit("")), F.lit(WORD_PATTERN), F.lit(0))


def shared_words(left: Column, right: Column) -> Column:
    """How many distinct words two word arrays have in common."""
    return F.size(F.array_intersect(left, right))

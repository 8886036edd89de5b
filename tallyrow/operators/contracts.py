"""What a table of prompts, pairs or values must hold, and a report of where it does not."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrow.functions.keys import Key, key_columns
from tallyrow.functions.text import words


@dataclass(frozen=True)
class Contract:
    """Column names and types; which texts must open with the prompt, and which must add words to it."""

    fields: Mapping[str, str]
    key: Key
    prompt: str = "prompt"
    after_prompt: tuple[str, ...] = ()
    completions: tuple[str, ...] = ()

    @classmethod
    def of(cls, schema: str, key: Key, **rules) -> Contract:
        """A contract whose fields are written ``name type, name type`` (plain types as `DataFrame.dtypes` names them)."""
        return cls(dict(part.split() for part in schema.split(",")), key, **rules)


def _own(contract: Contract, name: str) -> Column:
    """A text without the prompt it opens with."""
    text = F.coalesce(F.col(name), F.lit(""))
    if name not in contract.after_prompt:
        return text
    prompt = F.coalesce(F.col(contract.prompt), F.lit(""))
    return F.when(F.startswith(text, prompt), F.substring(text, F.length(prompt) + 1, F.length(text))).otherwise(text)


Rule = tuple[str, str, Column]


def row_rules(df: DataFrame, contract: Contract) -> list[Rule]:
    """(rule, field, whether a row breaks it) of the rules that each row keeps or breaks; none for missing columns."""
    types = dict(df.dtypes)
    rules: list[Rule] = [("null", name, F.col(name).isNull()) for name in contract.fields if name in types]
    for name in contract.after_prompt:
        if {name, contract.prompt} <= types.keys():
            opens = F.coalesce(F.startswith(F.col(name), F.col(contract.prompt)), F.lit(False))
            rules.append(("prompt_prefix", name, ~opens))
    for name in contract.completions:
        if name in types and (name not in contract.after_prompt or contract.prompt in types):
            rules.append(("empty_completion", name, F.size(words(_own(contract, name))) == 0))
    return rules


def contract_report(df: DataFrame, contract: Contract) -> DataFrame:
    """(rule, field, rows): how many rows break each rule; every rule has a row.

    ``missing`` and ``type`` count all rows where the column breaks them; other
    rules of a missing column are left out. The row rules take one pass over the
    table, ``repeated_key`` groups the key columns.
    """
    types = dict(df.dtypes)
    rules: list[Rule] = []
    for name, kind in contract.fields.items():
        rules.append(("missing", name, F.lit(name not in types)))
        if name in types:
            rules.append(("type", name, F.lit(types[name] != kind)))
    rules += row_rules(df, contract)
    counted = df.agg(*(F.coalesce(F.count_if(broken), F.lit(0)).alias(f"_{i}") for i, (_, _, broken) in enumerate(rules)))
    listed = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(f).alias("field"), F.col(f"_{i}").alias("rows")) for i, (r, f, _) in enumerate(rules)))
    report = counted.select(F.inline(listed))
    names = key_columns(contract.key)
    if not set(names) <= types.keys():
        return report
    again = df.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("rows"))
    return report.union(again.select(F.lit("repeated_key"), F.lit(", ".join(names)), "rows"))


def length_report(df: DataFrame, columns: list[str], limits: list[int]) -> DataFrame:
    """(field, limit, rows, over, longest, tokens) per text column and limit, in one pass: what truncation would cut.

    Tokens are words; ``over`` counts rows with more than ``limit``.
    """
    lengths = df.select(*(F.size(words(F.col(c))).cast("long").alias(f"_{i}") for i, c in enumerate(columns)))
    totals = [F.count(F.lit(1)).alias("_rows")]
    for i in range(len(columns)):
        totals += [F.max(f"_{i}").alias(f"_max{i}"), F.sum(f"_{i}").alias(f"_sum{i}")]
        totals += [F.count_if(F.col(f"_{i}") > limit).alias(f"_over{i}_{j}") for j, limit in enumerate(limits)]
    listed = F.array(
        *(
            F.struct(
                F.lit(c).alias("field"),
                F.lit(limit).cast("long").alias("limit"),
                F.col("_rows").alias("rows"),
                F.coalesce(f"_over{i}_{j}", F.lit(0)).alias("over"),
                F.coalesce(f"_max{i}", F.lit(0)).alias("longest"),
                F.coalesce(f"_sum{i}", F.lit(0)).alias("tokens"),
            )
            for i, c in enumerate(columns)
            for j, limit in enumerate(limits)
        )
    )
    return lengths.agg(*totals).select(F.inline(listed))


def split_overlap(left: DataFrame, right: DataFrame, key: Key, text: str) -> DataFrame:
    """(by, shared, only): rows of ``right`` whose key, or whose text, ``left`` holds as well, and the others.

    Keys and digests alone travel; a text that fills a third of either side is one
    row per map task there.
    """
    names = key_columns(key)
    sides = [df.select(*names, F.md5(F.coalesce(text, F.lit(""))).alias("_digest")) for df in (left, right)]

    def by(label: str, columns: list[str]) -> DataFrame:
        asked = sides[1].groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
        known = sides[0].select(*columns).distinct().withColumn("_known", F.lit(1))
        found = asked.join(known, columns, "left")
        count = lambda shared: F.coalesce(F.sum(F.when(F.col("_known").isNotNull() == shared, F.col("_n"))), F.lit(0))
        return found.agg(count(True).alias("shared"), count(False).alias("only")).select(F.lit(label).alias("by"), "shared", "only")

    return by("key", names).union(by("text", ["_digest"]))

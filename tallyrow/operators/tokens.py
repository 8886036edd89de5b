"""Vocabulary, tokenizing, truncation and decoding."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyrow.functions.lookup import MAX_INLINE_ROWS, position_lookup, word_lookup
from tallyrow.functions.skew import lookup_join
from tallyrow.functions.text import words


@dataclass(frozen=True)
class Specials:
    """Ids of the special tokens; a missing pad token falls back to end-of-text."""

    eos: int = 0
    unk: int = 1
    pad: int | None = None

    @property
    def pad_id(self) -> int:
        return self.eos if self.pad is None else self.pad

    @property
    def first_word(self) -> int:
        """The lowest id free for words."""
        return max(self.eos, self.unk, self.pad_id) + 1


def fit_vocab(df: DataFrame, columns: str | Sequence[str], size: int, specials: Specials = Specials()) -> DataFrame:
    """(tok, id) of the ``size`` most frequent words, ties in word order.

    Counts combine before the shuffle, so a word that makes up a third of the
    text is one row per map task.
    """
    names = [columns] if isinstance(columns, str) else list(columns)
    found = F.concat(*(words(F.col(name)) for name in names))
    ranked = (
        df.select(F.explode(found).alias("tok"))
        .groupBy("tok")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "tok")
        .limit(size)
    )
    # The window sees at most `size` rows.
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "tok"))
    return ranked.select("tok", (rank + (specials.first_word - 1)).cast("int").alias("id"))


@dataclass(frozen=True)
class Vocabulary:
    """Words with their ids, and the ids of the special tokens.

    The table is what counts. A small one also has its rows inline, to be looked up
    row by row without a shuffle; results are the same either way.
    """

    table: DataFrame = field(repr=False, compare=False)  # tok, id
    words: int
    specials: Specials = field(default_factory=Specials)
    entries: tuple[tuple[str, int, int], ...] | None = field(default=None, repr=False)  # word, id, xxhash64(word)

    @property
    def size(self) -> int:
        """Number of ids, specials included."""
        return self.specials.first_word + self.words

    @cached_property
    def _find(self):
        return word_lookup(self.entries)

    @cached_property
    def _word_at(self):
        listed = [""] * self.size
        for word, number, _ in self.entries:
            listed[number] = word
        return position_lookup(listed)

    @property
    def marks(self) -> dict[int, str]:
        """How the special tokens are written."""
        return {self.specials.pad_id: "<pad>", self.specials.unk: "<unk>", self.specials.eos: "</s>"}

    def ids(self, tokens: Column) -> Column:
        """Ids of an array of words, where the vocabulary is inline."""
        unknown = F.lit(self.specials.unk)
        return F.transform(tokens, lambda t: F.coalesce(self._find(t), unknown))

    def text(self, ids: Column, skip_special: bool = True) -> Column:
        """Words of an array of ids, joined by single spaces, where the vocabulary is inline."""
        if skip_special:
            return F.array_join(F.transform(F.filter(ids, lambda i: ~i.isin(*self.marks)), self._word_at), " ")
        return F.array_join(F.transform(ids, lambda i: self._marked(i, self._word_at(i))), " ")

    def _marked(self, number: Column, word: Column) -> Column:
        return reduce(lambda rest, m: F.when(number == m, self.marks[m]).otherwise(rest), self.marks, word)


def load_vocab(table: DataFrame, specials: Specials = Specials(), limit: int = MAX_INLINE_ROWS) -> Vocabulary:
    """The vocabulary ready for use, with its rows inline if there are at most ``limit``."""
    rows = table.select("tok", "id", F.xxhash64("tok").alias("h")).limit(limit + 1).collect()
    if len(rows) > limit:
        return Vocabulary(table.select("tok", "id"), table.count(), specials)
    return Vocabulary(table.select("tok", "id"), len(rows), specials, tuple((r["tok"], r["id"], r["h"]) for r in rows))


def save_vocab(vocab: Vocabulary, path: str) -> None:
    """The words and the special ids, as a table with one row of specials."""
    vocab.table.write.parquet(f"{path}/words")
    s = vocab.specials
    vocab.table.sparkSession.createDataFrame([(s.eos, s.unk, s.pad)], "eos int, unk int, pad int").coalesce(1).write.parquet(f"{path}/specials")


def read_vocab(spark: SparkSession, path: str, limit: int = MAX_INLINE_ROWS) -> Vocabulary:
    row = spark.read.parquet(f"{path}/specials").first()
    return load_vocab(spark.read.schema("tok string, id int").parquet(f"{path}/words"), Specials(row["eos"], row["unk"], row["pad"]), limit)


def _joined(df: DataFrame, items: Column, found: DataFrame, on: str, result: Column, name: str, empty: Column) -> DataFrame:
    """``df`` with the joined-up values of each row's items.

    Equal item lists are looked up once, so no row key is needed, and rows may repeat.
    """
    same = F.md5(F.to_json(F.struct(items.alias("_items"))))
    keyed = df.withColumn("_same", same)
    lists = keyed.select("_same", items.alias("_items")).dropDuplicates(["_same"])
    exploded = lists.select("_same", F.posexplode("_items").alias("_pos", on))
    matched = lookup_join(exploded, found, on, spread_by=["_same", "_pos"], how="left")
    # One group is the items of one list.
    listed = matched.groupBy("_same").agg(F.array_sort(F.collect_list(F.struct("_pos", result.alias("_value"))))["_value"].alias("_values"))
    return keyed.join(listed, "_same", "left").withColumn(name, F.coalesce("_values", empty)).drop("_values", "_same")


def tokenize(df: DataFrame, vocab: Vocabulary, text: str, name: str = "input_ids") -> DataFrame:
    """Adds the token ids of a text column; words outside the vocabulary become ``unk``."""
    tokens = words(F.col(text))
    if vocab.entries is not None:
        return df.withColumn(name, vocab.ids(tokens))
    known = F.coalesce("id", F.lit(vocab.specials.unk))
    return _joined(df, tokens, vocab.table, "tok", known, name, F.array().cast("array<int>"))


def truncate(df: DataFrame, ids: str, limit: int) -> DataFrame:
    """Keeps the first ``limit`` ids."""
    return df.withColumn(ids, F.slice(ids, 1, limit))


def attention_mask(ids: str) -> Column:
    return F.array_repeat(F.lit(1), F.size(ids))


def detokenize(df: DataFrame, vocab: Vocabulary, ids: str, skip_special: bool = True, name: str = "text") -> DataFrame:
    """Adds the text of token ids. A row of specials only gives the empty text."""
    if vocab.entries is not None:
        return df.withColumn(name, vocab.text(F.col(ids), skip_special))
    wanted = F.filter(ids, lambda i: ~i.isin(*vocab.marks)) if skip_special else F.col(ids)
    word = F.col("tok") if skip_special else vocab._marked(F.col("id"), F.col("tok"))
    listed = _joined(df, wanted, vocab.table, "id", word, "_words", F.array().cast("array<string>"))
    return listed.withColumn(name, F.array_join("_words", " ")).drop("_words")


def prompt_tokens(df: DataFrame, vocab: Vocabulary, keep: Sequence[str] = ()) -> DataFrame:
    """``input_ids`` of the prompts, untruncated, in place of all columns but ``keep``."""
    return tokenize(df, vocab, "prompt").select(*keep, "input_ids")


def value_tokens(df: DataFrame, vocab: Vocabulary, limit: int = 256) -> DataFrame:
    """input_ids, attention_mask and double ``labels`` in place of text and label."""
    cut = truncate(tokenize(df, vocab, "text"), "input_ids", limit)
    return (
        cut.withColumn("attention_mask", attention_mask("input_ids"))
        .withColumn("labels", F.col("label").cast("double"))
        .drop("text", "label")
    )

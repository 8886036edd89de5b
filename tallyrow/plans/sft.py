"""Supervised fine-tuning data: split, format, fit a count model, evaluate on held-out rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallyrow.functions.keys import Key
from tallyrow.functions.lookup import MAX_INLINE_ROWS
from tallyrow.operators.lm import BigramModel, eval_loss, fit_bigram, sequence_logprob
from tallyrow.operators.slices import train_val_split
from tallyrow.operators.templates import format_sft
from tallyrow.operators.tokens import Specials, Vocabulary, fit_vocab, load_vocab, tokenize
from tallyrow.session import written
from tallyrow.sources.tables import select_split


@dataclass(frozen=True)
class SftRun:
    vocab: Vocabulary
    model: BigramModel
    loss: DataFrame


def prepare(
    instructions: DataFrame, key: Key, n_train: int, n_val: int, style: str = "plain"
) -> DataFrame:
    """Training and validation texts, named by the ``split`` column."""
    return format_sft(train_val_split(instructions, key, n_train, n_val), style)


def fit(texts: DataFrame, key: Key, vocab_words: int, specials: Specials = Specials(), inline: int = MAX_INLINE_ROWS) -> SftRun:
    """Vocabulary and count model of the training texts, and the loss on the validation texts."""
    texts = written(texts, "sft-texts")
    train = select_split(texts, "train")
    vocab = load_vocab(fit_vocab(train, "text", vocab_words, specials), specials, inline)
    model = fit_bigram(tokenize(train, vocab, "text"), vocab.size)
    held_out = written(tokenize(select_split(texts, "validation"), vocab, "text"), "held-out-ids")
    return SftRun(vocab, model, eval_loss(sequence_logprob(held_out, model, key)))

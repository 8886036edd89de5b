"""Encoding and decoding with the merges of a public tokenizer, compiled into an automaton.

**Compiling.** The automaton reads tokens; at first it has one state, and every
base symbol leads back to it. Merges are then built in one after the other. The
gadget of a merge (u, v) -> w gives the arcs labelled u a new target, a copy of the
old one without its arc v, and lets arcs labelled w lead past u and v to where v led.
What the automaton accepts after the last gadget are the token rows that the merges
give for their text, and no others. Two things keep it small:

- All arcs of one label lead to the same state, so a state is known by its label.
- A state lacks the arcs that some gadget took away, and those of every later token that
  begins with such an arc's label. Tokens numbered along the tree "token, its left
  part", latest first, make these one interval for each gadget. A state is a sorted
  row of intervals; whether an arc exists is one binary search.

**Encoding.** A word's bytes are symbols, its last byte a symbol of its own (the
end-of-word suffix). A prefix of a word ends in exactly one token that
the automaton lets follow what stands before it, so reading a symbol is a
deterministic step. The state after it is the longest run of symbols that may still
become a token, with the automaton's states along that run; steps are looked up in a
table whose missing cells are filled in as the words need them. At the word's end
the tokens are walked back from the last one. Words that were met are remembered.
Both tables are emptied when full: they hold what can be worked out again.

**Decoding** emits the labels of the arcs, joined by a space.

Text is split as the tokenizer's file says (``word_bpe``): the strings of special
tokens count where they stand in the text as it is; what lies between is
NFC-normalised, white space made blanks, letters lower-cased one by one, then cut into
contractions, runs of letters, single digits and runs of other signs. Other kinds of
file are refused. Characters that are newer than Python's tables are handed to the
library's own normaliser and splitter, so that both agree on every character.

Null and empty texts have no tokens. Rows are kept as they come, repeated and id-less
ones too. Output columns replace input columns of the same name. An empty table
gives an empty table. Rows are independent: no shuffle, and a lost task is run again.
Long texts go piece by piece, but a row's ids are one array and the decoded text one
string: some 30 bytes a character of the longest text in a task.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrow.functions.lookup import position_lookup
from tallyrow.llm.words import blocks

# Words and automaton steps that a worker remembers.
MOST_WORDS, MOST_STEPS = 1 << 18, 1 << 18
# Characters of a long text that are normalised and split at a time.
PIECE = 1 << 18

# The one kind of file that is understood.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

_WORD = regex.compile(_SPLIT)


def byte_signs() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 as it is, the rest from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


@dataclass(frozen=True)
class Automaton:
    """Token t leads to state ``target[t]``; state s has no arc for tokens numbered in its intervals."""

    labels: tuple[str, ...]
    special: dict[str, int]
    symbols: tuple[int, ...]  # token of each byte, then of each byte that ends a word
    parts: tuple[tuple[int, int, int], ...]
    number: array
    target: array
    rows: array  # where each state's intervals begin
    begins: array
    ends: array

    def follows(self, state: int, token: int) -> bool:
        """Whether the state has an arc for the token."""
        at = self.number[token]
        i = bisect_right(self.begins, at, self.rows[state], self.rows[state + 1]) - 1
        return i < self.rows[state] or at >= self.ends[i]


def _numbered(size: int, merges: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """Each token's number, and the number after the last token that begins with it; later tokens come first."""
    begin_with: list[list[int]] = [[] for _ in range(size)]
    inner = set()
    for u, _, w in reversed(merges):
        begin_with[u].append(w)
        inner.add(w)
    number, order = [0] * size, []
    waiting = [t for t in range(size) if t not in inner]
    while waiting:
        token = waiting.pop()
        number[token] = len(order)
        order.append(token)
        waiting.extend(reversed(begin_with[token]))
    until = [n + 1 for n in number]
    left = {w: u for u, _, w in merges}
    for token in reversed(order):
        if token in left:
            until[left[token]] = max(until[left[token]], until[token])
    return number, until


def compiled(symbols: list[int], merges: list[tuple[int, int, int]], labels: list[str], special: dict[str, int]) -> Automaton:
    """The automaton of merges (left, right, merged), earliest first."""
    size = len(labels)
    known = set(symbols)
    if len(known) != len(symbols):
        raise ValueError("two symbols share a token")
    for u, v, w in merges:
        if u not in known or v not in known or w in known:
            raise ValueError(f"merge of {labels[u]!r} and {labels[v]!r}: parts come before what they give, and each token comes once")
        known.add(w)
    number, until = _numbered(size, merges)
    start = (array("i"), array("i"))
    target = [start] * size
    alive, parts = set(symbols), []
    for u, v, w in merges:
        begins, ends = target[u]
        i = bisect_right(begins, number[v])
        if u in alive and v in alive and (not i or number[v] >= ends[i - 1]):
            # The gadget: u leads to a copy without v, and without what will begin with v.
            past = target[v]
            target[u] = (begins[:i] + array("i", [number[v]]) + begins[i:], ends[:i] + array("i", [until[v]]) + ends[i:])
            target[w] = past
            alive.add(w)
            parts.append((u, v, w))
        # Else no text leaves u before v: nothing is ever merged to w, and no arc bears it.
        until[u] = number[w]  # tokens that begin with u from now on are numbered before w
    states, rows, all_begins, all_ends = {id(start): 0}, array("i", [0, 0]), array("i"), array("i")
    for found in target:
        if id(found) not in states:
            states[id(found)] = len(states)
            all_begins.extend(found[0])
            all_ends.extend(found[1])
            rows.append(len(all_begins))
    return Automaton(
        tuple(labels), special, tuple(symbols), tuple(parts), array("i", number), array("i", (states[id(t)] for t in target)),
        rows, all_begins, all_ends,
    )


def read(path: str) -> Automaton:
    """The automaton of a ``word_bpe`` tokenizer file."""
    with open(path, encoding="utf-8") as file:
        said = json.load(file)
    model, splitter = said["model"], (said.get("pre_tokenizer") or {}).get("pretokenizers") or [{}, {}]
    fits = (
        model["type"] == "BPE"
        and model.get("end_of_word_suffix")
        and not any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        and (said.get("normalizer") or {}).get("normalizers") == _NORMALIZERS
        and splitter[0].get("pattern") == {"Regex": _SPLIT}
        and splitter[0].get("invert") and splitter[0].get("behavior") == "Removed"
        and splitter[1].get("type") == "ByteLevel" and not splitter[1].get("add_prefix_space") and not splitter[1].get("use_regex")
        and said.get("decoder") is None
        and not any(t[x] for t in said["added_tokens"] for x in ("single_word", "lstrip", "rstrip", "normalized"))
    )
    if not fits:
        raise ValueError(f"{path} is not a byte-level vocabulary with word ends")
    vocab, suffix = model["vocab"], model["end_of_word_suffix"]
    special = {t["content"]: t["id"] for t in said["added_tokens"]}
    labels = [""] * (max([*vocab.values(), *special.values()]) + 1)
    for label, token in (*vocab.items(), *special.items()):
        labels[token] = label
    pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
    signs = byte_signs()
    return compiled([vocab[s] for s in signs] + [vocab[s + suffix] for s in signs], merges, labels, special)


class _Memory(dict):
    """What ``find`` gives for a key, kept."""

    def __init__(self, find):
        super().__init__()
        self.find = find

    def __missing__(self, key):
        self[key] = found = self.find(key)
        return found


class Encoder:
    """Reads words through an automaton."""

    def __init__(self, automaton: Automaton, most_words: int = MOST_WORDS, most_steps: int = MOST_STEPS):
        self.automaton, self.most_words, self.most_steps = automaton, most_words, most_steps
        self._grow_trie()
        self._forget_steps()
        self._forget_words()
        strings = sorted(automaton.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, strings)) + ")") if strings else None

    def _grow_trie(self) -> None:
        """Nodes are runs of symbols that begin some token; ``shorter`` is a node's longest proper end that is a node."""
        a = self.automaton
        spelled: dict[int, tuple[int, ...]] = {t: (s,) for s, t in enumerate(a.symbols)}
        for u, v, w in a.parts:
            spelled[w] = spelled[u] + spelled[v]
        self.width = {t: len(s) for t, s in spelled.items()}
        self.child: dict[int, int] = {}
        self.depth, self.token, edges = [0], [-1], [(-1, -1)]
        for token, row in spelled.items():
            node = 0
            for symbol in row:
                key = node << 9 | symbol
                below = self.child.get(key)
                if below is None:
                    below = self.child[key] = len(self.depth)
                    self.depth.append(self.depth[node] + 1)
                    self.token.append(-1)
                    edges.append((node, symbol))
                node = below
            if self.token[node] >= 0:
                raise ValueError(f"two tokens stand for {a.labels[token]!r}")
            self.token[node] = token
        self.shorter = [0] * len(self.depth)
        for node in sorted(range(1, len(self.depth)), key=self.depth.__getitem__):
            above, symbol = edges[node]
            if above:
                self.shorter[node] = self._down(self.shorter[above], symbol)

    def _down(self, node: int, symbol: int) -> int:
        while True:
            below = self.child.get(node << 9 | symbol)
            if below is not None:
                return below
            if not node:
                raise ValueError("a symbol without a token")
            node = self.shorter[node]

    def _forget_steps(self) -> None:
        """Only the state before any symbol: the root, where the automaton starts."""
        self.step: dict[int, int] = {}
        self.states: dict[tuple, int] = {(0, (0,)): 0}
        self.nodes, self.trails, self.last = [0], [(0,)], [-1]

    def _forget_words(self) -> None:
        self.place = _Memory(self._remember)
        self.ids, self.begin, self.count = array("i"), array("q"), array("i")

    def _stepped(self, state: int, symbol: int) -> int:
        """The state after one more symbol: fills in a cell of the table."""
        a, trail = self.automaton, self.trails[state]
        node = ends = self._down(self.nodes[state], symbol)
        while ends:
            token = self.token[ends]
            if token >= 0 and a.follows(trail[self.depth[ends] - 1], token):
                break
            ends = self.shorter[ends]
        trail = (a.target[token], *trail[: self.depth[node]])
        key = (node, trail, token)
        found = self.states.get(key)
        if found is None:
            found = self.states[key] = len(self.nodes)
            self.nodes.append(node)
            self.trails.append(trail)
            self.last.append(token)
        self.step[state << 9 | symbol] = found
        return found

    def word(self, text: str) -> list[int]:
        """The tokens of one word."""
        if len(self.step) > self.most_steps:
            self._forget_steps()
        raw = text.encode("utf-8")
        state, path, step = 0, [], self.step
        for symbol in (*raw[:-1], 256 + raw[-1]):
            after = step.get(state << 9 | symbol)
            state = self._stepped(state, symbol) if after is None else after
            path.append(self.last[state])
        out, at = [], len(path)
        while at:
            out.append(path[at - 1])
            at -= self.width[path[at - 1]]
        return out[::-1]

    def _remember(self, word: str | int) -> int:
        found = [word] if isinstance(word, int) else self.word(word)
        self.begin.append(len(self.ids))
        self.count.append(len(found))
        self.ids.extend(found)
        return len(self.begin) - 1

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's ids begin and the end)."""
        if len(self.place) > self.most_words:
            self._forget_words()
        words: list[str | int] = []
        bounds = [0]
        for text in texts:
            for piece in split(text or "", self.automaton.special, self.special):
                words += piece
            bounds.append(len(words))
        place = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        count = np.frombuffer(self.count, np.int32)[place] if words else np.zeros(0, np.int32)
        offsets = np.r_[0, np.cumsum(count, dtype=np.int64)]
        if words:
            where = np.repeat(np.frombuffer(self.begin, np.int64)[place] - offsets[:-1], count) + np.arange(offsets[-1])
            ids = np.frombuffer(self.ids, np.int32)[where]
        else:
            ids = np.zeros(0, np.int32)
        return ids, offsets[bounds]


def _pieces(text: str) -> Iterator[str]:
    """A long text cut before blanks, where neither normalising nor splitting looks across."""
    at = 0
    while len(text) - at > PIECE:
        to = text.find(" ", at + PIECE)
        if to < 0:
            break
        yield text[at:to]
        at = to
    yield text[at:] if at else text


def _words(text: str) -> list[str]:
    if not text.isascii():
        if not _known(text):
            return _library_words(text)
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no look at what follows a sigma
    return _WORD.findall(text.lower())  # white space ends words, however much of it


def _known(text: str) -> bool:
    """Whether Python's tables hold every character."""
    new = set(text) - _assigned
    if any(unicodedata.category(sign) == "Cn" for sign in new):
        return False
    _assigned.update(new)
    return True


# Characters that were met and are in Python's tables.
_assigned: set[str] = set()


def _library_words(text: str) -> list[str]:
    from tokenizers import Regex, normalizers, pre_tokenizers

    plain = normalizers.Sequence([normalizers.NFC(), normalizers.Replace(Regex("\\s+"), " "), normalizers.Lowercase()])
    splitter = pre_tokenizers.Split(Regex(_SPLIT), "removed", invert=True)
    return [word for word, _ in splitter.pre_tokenize_str(plain.normalize_str(text))]


def split(text: str, special: dict[str, int], strings: re.Pattern | None) -> Iterator[list[str | int]]:
    """The words of a text, and the ids of special tokens that stand in it."""
    for i, part in enumerate(strings.split(text) if strings else [text]):
        if i % 2:
            yield [special[part]]
        else:
            for piece in _pieces(part):
                yield _words(piece)


_encoders: dict[int, Encoder] = {}


def _encoder(shared) -> Encoder:
    """This worker's encoder of a broadcast automaton."""
    if shared.value is not None and id(shared.value) not in _encoders:
        _encoders.clear()
        _encoders[id(shared.value)] = Encoder(shared.value)
    return _encoders[id(shared.value)]


def _with(batch: pa.RecordBatch, kept: list[str], new: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *new.values()], names=[*kept, *new])


def _schema(docs: DataFrame, kept: list[str], new: str) -> str:
    return ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept), new])


def encode(docs: DataFrame, automaton: Automaton, column: str = "text") -> DataFrame:
    """``docs`` without the text, with ``ids`` (array of int) and ``n_tokens``."""
    kept = [c for c in docs.columns if c not in (column, "ids", "n_tokens")]
    shared = docs.sparkSession.sparkContext.broadcast(automaton)

    def run(batches: Iterator[pa.RecordBatch]):
        encoder = _encoder(shared)
        for batch in blocks(batches, column, 2 << 20):
            ids, at = encoder.encode(batch.column(column).to_pylist())
            row = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
            yield _with(batch, kept, {"ids": row, "n_tokens": pa.array(np.diff(at), pa.int64())})

    return docs.select(*kept, column).mapInArrow(run, _schema(docs, kept, "ids array<int>, n_tokens bigint"))


def decode(rows: DataFrame, automaton: Automaton, column: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``: the labels of the ids, joined by one space (null ids: none); looked up in the JVM, without a second Python worker."""
    label = position_lookup(automaton.labels)
    kept = [F.col(f"`{c}`") for c in rows.columns if c != "decoded"]
    labels = F.transform(F.coalesce(column, F.array().cast("array<int>")), label)
    return rows.select(*kept, F.array_join(labels, " ").alias("decoded"))

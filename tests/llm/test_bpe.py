"""The merge automaton against plain merging and against the tokenizers library."""

import hashlib
import json
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyrow.llm import bpe
from tallyrow.llm.queries import op13_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "\n\t\x0b", "a", "A" * 5000, "aaaa aaa aa", "ΑΣ ΣΣ", "I'S it's 'ſ'S don't'll", "café café ȩ́ 각", "한글 \U0001F600‍",
    "x <|startoftext|> y<|endoftext|>z<|STARTOFTEXT|> <|startoftext|", "Ᲊ \U00010d50 ՘՘!", "12 3½ ²", "İstanbul \x1c\x85​", "ab " * 100_000,
    "́", " ́a", "<|endoftext|><|endoftext|>",
]


@pytest.fixture(scope="module")
def automaton():
    return bpe.read(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def merged(row, merges):
    """Earliest merge first, leftmost first."""
    for u, v, w in merges:
        at = 0
        while at < len(row) - 1:
            if row[at] == u and row[at + 1] == v:
                row[at : at + 2] = [w]
            at += 1
    return row


def random_merges(rng, labels, letters, count):
    spelled = {labels[t]: t for t in letters}
    merges = []
    for _ in range(count * 3):
        u, v = rng.choice(sorted(spelled)), rng.choice(sorted(spelled))
        if not u.endswith("$") and u + v not in spelled and len(merges) < count and len(u + v) < 9:
            spelled[u + v] = len(labels)
            merges.append((spelled[u], spelled[v], len(labels)))
            labels.append(u + v)
    return merges


@pytest.mark.parametrize("seed", range(25))
def test_any_merges_equal_plain_merging(seed):
    rng = random.Random(seed)
    labels = [chr(b) for b in range(256)] + [chr(b) + "$" for b in range(256)]
    merges = random_merges(rng, labels, [ord(c) + e for c in "ab"[: 1 + seed % 2] + "c" for e in (0, 256)], 30)
    encoder = bpe.Encoder(bpe.compiled(list(range(512)), merges, labels, {}), most_words=20, most_steps=50)
    for _ in range(300):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 25)))
        assert encoder.word(word) == merged([*map(ord, word[:-1]), 256 + ord(word[-1])], merges)


def test_only_what_merging_gives_is_accepted():
    """A row of two tokens has its arc exactly where merging leaves the two alone."""
    rng = random.Random(5)
    labels = [chr(b) for b in range(256)] + [chr(b) + "$" for b in range(256)]
    merges = random_merges(rng, labels, [97, 98, 97 + 256, 98 + 256], 40)
    a = bpe.compiled(list(range(512)), merges, labels, {})
    spelled = {t: [t] for t in (97, 98, 97 + 256, 98 + 256)}
    for u, v, w in merges:
        spelled[w] = spelled[u] + spelled[v]
    whole = {t for t, s in spelled.items() if merged(list(s), merges) == [t]}
    assert whole == {97, 98, 97 + 256, 98 + 256, *(w for _, _, w in a.parts)}
    for u in whole:
        if labels[u].endswith("$"):
            continue
        for v in whole:
            assert a.follows(a.target[u], v) == (merged(spelled[u] + spelled[v], merges) == [u, v])


@pytest.mark.parametrize("merges", [[(97, 600, 512)], [(97, 98, 99)], [(97, 98, 512), (97, 98, 512)]])
def test_merges_out_of_order_are_refused(merges):
    with pytest.raises(ValueError):
        bpe.compiled(list(range(512)), merges, [str(i) for i in range(700)], {})


def test_other_files_are_refused(tmp_path):
    said = json.load(open(PATH))
    for change in ({"decoder": {"type": "BPEDecoder"}}, {"normalizer": None}):
        path = tmp_path / "t.json"
        path.write_text(json.dumps(said | change))
        with pytest.raises(ValueError):
            bpe.read(str(path))


def test_texts_equal_the_library(automaton, library):
    rng = random.Random(3)
    signs = [*"abcdeginorst'ABZ019 .,!-é日한글Σσİı́\n\t😀ﬁ", "the", "ing", "aaaa", "<|startoftext|>", "Ᲊ", "\x85"]
    texts = [t or "" for t in ODD] + ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    ids, at = bpe.Encoder(automaton, most_words=500, most_steps=2000).encode(texts)
    for i, found in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert ids[at[i] : at[i + 1]].tolist() == found.ids


def test_every_character_equals_the_library(automaton, library):
    encoder = bpe.Encoder(automaton)
    texts = ["".join(f"{chr(c)}a{chr(c)} " for c in range(b, b + 64) if not 0xD800 <= c < 0xE000) for b in range(0, 0x30000, 64)]
    ids, at = encoder.encode(texts)
    for i, found in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert ids[at[i] : at[i + 1]].tolist() == found.ids


def expected(library, rows):
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    out = []
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        out.append((key, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    return sorted(out, key=str)


def test_operator_keeps_rows_and_columns(spark, automaton, library):
    rows = [(i if i % 5 else None, t) for i, t in enumerate(ODD)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "'x' as ids", "text", "1.5D as n_tokens", "text as decoded", "map('k', doc_id) as m")
    coded = bpe.decode(bpe.encode(docs.repartition(3), automaton), automaton)
    assert coded.columns == ["doc_id", "m", "ids", "n_tokens", "decoded"]
    got = sorted(((r.doc_id, r.n_tokens, r.ids, r.decoded) for r in coded.collect()), key=str)
    want = []
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((key, len(ids), ids, library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want, key=str)


def test_empty_table_and_null_ids(spark, automaton):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(empty, automaton), automaton).collect() == []
    rows = spark.createDataFrame([(1, None), (2, [343, 49406])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in bpe.decode(rows, automaton).collect()} == {1: "", 2: "x</w> <|startoftext|>"}


def test_query_equals_the_library(spark, sf_dir, library):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in op13_bpe(spark, sf_dir).collect()), key=str) == expected(library, rows)

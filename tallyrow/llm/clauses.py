"""Toxicity by a weighted finite-state grammar over clauses.

Words are tagged by small lexicons (insult, threat, target, negation, report).
The tags of each clause that holds an insult or a threat run through five small
transducers, composed into one machine: reported speech, negation and target
mark what lies in their scope; insult and threat turn marked tags into events.
Each event has a weight; a text's log-odds are a bias plus, per kind of event
and per lexicon word that took part, a weight times the log of one plus its count.

The insult lexicon grows by stems: beginnings of words (or whole words) that stand
in toxic labelled texts and hardly in others, taken one by one, each time the stem
that explains most toxic texts which nothing has explained yet. A stem accepts any
ending. The weights start from the grammar's own (``PRIOR``) and are fitted to
labels by penalised logistic regression, so that events no label speaks about keep
the grammar's judgement. Both read at most ``sample`` labelled texts.

A clause ends at . ! ? ; : | or a line break. Words are runs of letters; A-Z count
as a-z. Null and empty texts hold no clause and score by the bias alone. Whole
texts are read. Repeated rows are scored each; one text of a document is learned. An
empty table gives no rows; without labels the grammar's own weights stand. A column of
the table that is named like the score gives way to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrow.llm.subwords import labelled
from tallyrow.llm.words import LETTER, blocks, byte_value, mix64, others, text_buffer, word_hashes
from tallyrow.session import written

SAMPLE = 20_000

LEXICON = {
    "insult": """
        idiot idiots idiotic moron morons moronic stupid dumb dumbass fool fools foolish imbecile imbeciles cretin
        scum scumbag trash garbage filth filthy vermin parasite pathetic worthless useless loser losers disgusting
        disgrace ugly coward cowards liar liars pervert jerk bastard bastards asshole assholes bitch bitches whore slut
        shit shitty crap damn fuck fucking fucker motherfucker bullshit retard retarded lunatic degenerate
        idiote imbécile crétin connard connasse salope salaud ordure merde putain abruti débile
        arschloch dummkopf trottel schwachkopf vollidiot abschaum scheiße scheisse hurensohn wichser
        idiota imbécil estúpido estúpida gilipollas cabrón mierda puta pendejo basura
    """.split(),
    "threat": """
        kill murder strangle stab slaughter butcher destroy hurt punish beat burn hang shoot smash
        tuer tuerai töten umbringen matar mataré matarte
    """.split(),
    "target": """
        you your yours yourself u they them their he him she her these those
        tu toi vous votre du dich dir ihr tú usted ustedes
    """.split(),
    "negation": """
        not no never neither nor none hardly without don doesn didn isn aren wasn weren won cannot
        jamais pas nicht kein keine nunca jamás
    """.split(),
    "report": """
        said says say told tells wrote writes quoted quotes claimed claims alleged allegedly reported called calls
        dit écrit sagte schrieb dijo escribió
    """.split(),
}

TAGS = ("insult", "threat", "target", "negation", "report", "gap")

# Tags further apart than this many words have a gap between them, which ends a negation's scope.
REACH = 3

# The grammar's own weights: of an event, of its marks, of the bias.
PRIOR = {"insult": 4.0, "threat": 1.5, "target": 2.0, "negation": -2.0, "report": -1.5, "after": 1.5, "again": 0.5, "bias": -4.0}

_MARKS = ("target", "negation", "report")
EVENTS = [
    *(
        kind + "".join(f"+{m}" for m, on in zip(_MARKS, (mask & 1, mask & 2, mask & 4)) if on)
        for kind in ("insult", "threat")
        for mask in range(8)
    ),
    "after",
    "again",
]
WORDS = [*LEXICON["insult"], *LEXICON["threat"]]
FEATURES = [*EVENTS, *WORDS]

Symbol = str  # a tag, with the marks it has got: "insult+target"
Machine = tuple[str, dict[str, dict[str, tuple[str, Symbol]]]]


def _scope(opens: str, closes: tuple[str, ...] = ()) -> Machine:
    """Marks insults and threats after ``opens``, until one of ``closes``. Other tags pass."""
    return "off", {
        "off": {opens: ("on", "")},
        "on": {opens: ("on", ""), **{c: ("off", c) for c in closes}, "insult": ("on", f"insult+{opens}"), "threat": ("on", f"threat+{opens}")},
    }


# A target after an unaimed insult or threat aims it afterwards.
_TARGET: Machine = (
    "off",
    {
        "off": {"target": ("on", ""), "insult": ("open", "insult"), "threat": ("open", "threat")},
        "open": {"target": ("on", "after"), "insult": ("open", "insult"), "threat": ("open", "threat")},
        "on": {"target": ("on", ""), "insult": ("on", "insult+target"), "threat": ("on", "threat+target")},
    },
)
# The first insult (threat) of a clause is an event of its marks, further ones are "again" besides.
_INSULT: Machine = ("first", {"first": {"insult": ("more", "insult")}, "more": {"insult": ("more", "insult again")}})
_THREAT: Machine = ("first", {"first": {"threat": ("more", "threat")}, "more": {"threat": ("more", "threat again")}})

GRAMMAR = (_TARGET, _scope("negation", ("gap",)), _scope("report"), _INSULT, _THREAT)


def _step(machine: Machine, state: str, symbol: Symbol) -> tuple[str, Symbol]:
    """Marks already set travel along: a machine reads the bare tag and its marks are kept in order."""
    tag, plus, marks = symbol.partition("+")
    found = machine[1].get(state, {}).get(tag)
    if found is None:
        return state, symbol
    to, out = found
    if not plus or out.partition("+")[0].split(" ")[0] != tag:
        return to, out
    head, _, new = out.partition("+")
    kept = "+".join(x for x in (marks, new) if x)
    head, space, again = head.partition(" ")
    return to, f"{head}+{kept}{space}{again}"


def composed(machines: tuple[Machine, ...]) -> list[dict[str, tuple[int, tuple[str, ...]]]]:
    """One machine whose states are the reachable tuples of states; per tag the next state and the events."""
    start = tuple(m[0] for m in machines)
    number, table, waiting = {start: 0}, [{}], [start]
    while waiting:
        state = waiting.pop()
        for tag in TAGS:
            symbol, to = tag, []
            for machine, at in zip(machines, state):
                after, symbol = _step(machine, at, symbol) if symbol else (at, "")
                to.append(after)
            after = tuple(to)
            if after not in number:
                number[after] = len(table)
                table.append({})
                waiting.append(after)
            body, _, again = symbol.partition(" ")
            events = tuple(e for e in (body, again) if e in EVENTS)
            table[number[state]][tag] = (number[after], events)
    return table


@cache
def _machine() -> list[list[tuple[int, tuple[int, ...]]]]:
    place = {e: i for i, e in enumerate(EVENTS)}
    return [[(row[t][0], tuple(place[e] for e in row[t][1])) for t in TAGS] for row in composed(GRAMMAR)]


@cache
def _lexicon() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ascending word hashes with their tags and features (-1 for words that are no feature)."""
    entries = [(w, tag) for tag in TAGS[:5] for w in LEXICON[tag]]
    texts = pa.array([w for w, _ in entries], pa.large_string())
    hashes, _, _ = word_hashes(*text_buffer(texts), LETTER)
    feature = {w: len(EVENTS) + i for i, w in enumerate(WORDS)}
    order = np.argsort(hashes)
    tags = np.array([TAGS.index(t) for _, t in entries], np.int8)
    places = np.array([feature.get(w, -1) for w, _ in entries], np.int32)
    return hashes[order], tags[order], places[order]


# Bytes of a learned beginning of a word; 0 is the whole word.
STEM_BYTES = (4, 5, 6, 7, 8, 10, 12)
WHOLE = 0
# A stem explains at least so many toxic texts, and of the texts that hold it this share is toxic.
STEM_TEXTS = 3
STEM_SHARE = 0.97

Stems = tuple[tuple[int, int], ...]  # (bytes, hash)


def beginnings(raw: np.ndarray, start: np.ndarray, row_end: np.ndarray, lengths: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per length (which words have as many letters' bytes, the hashes of their beginnings)."""
    which, total, done = np.arange(len(start)), np.zeros(len(start), np.uint64), 0
    for n in sorted(lengths):
        for k in range(done, n):
            at = start[which] + k
            ok = at < row_end[which]
            ok[ok] = LETTER[raw[at[ok]]]
            which, total = which[ok], total[ok]
            with np.errstate(over="ignore"):
                total = total + byte_value(raw[start[which] + k], k)
        done = n
        yield n, which, mix64(total + np.uint64(n))


def _found(hashes: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which hashes are wanted, the place of each in the ascending wanted ones)."""
    door = np.zeros(1 << 16, bool)
    door[(wanted >> np.uint64(48)).astype(np.int64)] = True
    near = np.flatnonzero(door[(hashes >> np.uint64(48)).astype(np.int64)])
    at = np.searchsorted(wanted, hashes[near])
    at[at == len(wanted)] = 0
    same = wanted[at] == hashes[near]
    return near[same], at[same]


def _tagged(raw: np.ndarray, offsets: np.ndarray, stems: Stems) -> tuple[np.ndarray, ...]:
    """(place, first byte, row, tag, feature) of the words that a lexicon or a stem accepts, in text order."""
    hashes, start, row = word_hashes(raw, offsets, LETTER)
    known, tags, places = _lexicon()
    word, at = _found(hashes, known)
    words, tag, feature = [word], [tags[at]], [places[at]]
    for n, which, found in _stem_hashes(raw, offsets, hashes, start, row, tuple({n for n, _ in stems})):
        mine = sorted((h, i) for i, (m, h) in enumerate(stems) if m == n)
        inside, at = _found(found, np.array([h for h, _ in mine], np.uint64))
        words.append(which[inside])
        tag.append(np.full(len(inside), TAGS.index("insult"), np.int8))
        feature.append(len(FEATURES) + np.array([i for _, i in mine], np.int32)[at])
    # A word that several accept counts as the first of them has it.
    word, first = np.unique(np.concatenate(words), return_index=True)
    return word, start[word], row[word], np.concatenate(tag)[first], np.concatenate(feature)[first]


def _stem_hashes(raw, offsets, hashes, start, row, lengths):
    if WHOLE in lengths:
        yield WHOLE, np.arange(len(hashes)), hashes
    some = tuple(n for n in lengths if n != WHOLE)
    if some:
        yield from beginnings(raw, start, offsets[1:][row], some)


_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?;:|\n"]] = True


def counts(texts: pa.Array, stems: Stems = ()) -> tuple[np.ndarray, np.ndarray]:
    """(rows that hold an insult or a threat, their feature counts)."""
    raw, offsets = text_buffer(texts)
    found, start, row, tag, place = _tagged(raw, offsets, stems)
    if not len(found):
        return np.zeros(0, np.int64), np.zeros((0, len(FEATURES) + len(stems)), np.int64)
    # Clauses never reach over a row's end.
    clause = np.cumsum(_ENDS[raw], dtype=np.int64)[start] + row
    new = np.flatnonzero(np.r_[True, (clause[1:] != clause[:-1]) | (row[1:] != row[:-1])])
    hit = np.add.reduceat((tag < 2).astype(np.int64), new) > 0
    rows = np.unique(row[tag < 2])
    out = np.zeros((len(rows), len(FEATURES) + len(stems)), np.int64)
    np.add.at(out, (np.searchsorted(rows, row[tag < 2]), place[tag < 2]), 1)
    machine, gap = _machine(), TAGS.index("gap")
    ends = np.append(new[1:], len(tag))
    into = np.searchsorted(rows, row[new])
    tag, found = tag.tolist(), found.tolist()
    for clause_row, a, b in zip(into[hit].tolist(), new[hit].tolist(), ends[hit].tolist()):
        state, last, counted = 0, found[a], out[clause_row]
        for i in range(a, b):
            if found[i] - last > REACH:
                state = machine[state][gap][0]
            last = found[i]
            state, events = machine[state][tag[i]]
            for event in events:
                counted[event] += 1
    return rows, out


@dataclass(frozen=True)
class Weights:
    bias: float
    features: np.ndarray
    stems: Stems = ()

    def scores(self, texts: pa.Array) -> np.ndarray:
        logit = np.full(len(texts), self.bias)
        rows, found = counts(texts, self.stems)
        logit[rows] += np.log1p(found) @ self.features
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def prior(stems: Stems = ()) -> Weights:
    weights = np.zeros(len(FEATURES) + len(stems))
    for i, event in enumerate(EVENTS):
        weights[i] = sum(PRIOR[part] for part in event.split("+"))
    return Weights(PRIOR["bias"], weights / np.log(2), stems)


def regress(x: np.ndarray, y: np.ndarray, start: Weights, penalty: float = 0.1, steps: int = 30) -> Weights:
    """Logistic regression by Newton's method, drawn towards ``start``."""
    # Equal rows count together: most texts hold no event.
    both, times = np.unique(np.c_[x, y], axis=0, return_counts=True)
    x, y = both[:, :-1], both[:, -1]
    design = np.c_[np.ones(len(x)), np.log1p(x)]
    origin = np.r_[start.bias, start.features]
    w = origin.copy()
    ridge = np.full(len(w), penalty)

    def loss(v: np.ndarray) -> float:
        z = design @ v
        return float(times @ (np.logaddexp(0, z) - z * y) + (ridge * (v - origin) ** 2).sum() / 2)

    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -40, 40)))
        gradient = design.T @ (times * (p - y)) + ridge * (w - origin)
        hessian = (design * (times * p * (1 - p))[:, None]).T @ design + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return Weights(float(w[0]), w[1:], start.stems)


def explain(toxic: list[np.ndarray], clean: dict[int, int], length: dict[int, int]) -> list[int]:
    """Pattern hashes, chosen one by one by how many toxic texts they newly explain.

    ``toxic`` has each text's distinct patterns, ``clean`` in how many other texts a
    pattern stands, ``length`` its bytes. Of patterns that explain equally much the
    narrowest is chosen: a whole word before a beginning, a longer one before a shorter.
    """
    if not toxic:
        return []
    text = np.repeat(np.arange(len(toxic)), [len(t) for t in toxic])
    patterns, place = np.unique(np.concatenate(toxic), return_inverse=True)
    total = np.bincount(place, minlength=len(patterns))
    other = np.fromiter((clean.get(int(p), 0) for p in patterns), np.int64, len(patterns))
    narrow = np.fromiter((length[int(p)] or 1 << 30 for p in patterns), np.int64, len(patterns))
    open_, chosen = np.ones(len(toxic), bool), []
    fit_ = total >= STEM_SHARE * (total + other)
    while True:
        gain = np.where(fit_, np.bincount(place[open_[text]], minlength=len(patterns)), 0)
        if not len(gain) or gain.max() < STEM_TEXTS:
            return chosen
        best = min(np.flatnonzero(gain == gain.max()), key=lambda i: (-total[i], -narrow[i], patterns[i]))
        chosen.append(int(patterns[best]))
        open_[text[place == best]] = False


def _patterns(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, hash, row) of every whole word and beginning."""
    raw, offsets = text_buffer(texts)
    hashes, start, row = word_hashes(raw, offsets, LETTER)
    parts = [(np.full(len(which), n), found, row[which]) for n, which, found in _stem_hashes(raw, offsets, hashes, start, row, (WHOLE, *STEM_BYTES))]
    return tuple(np.concatenate([p[i] for p in parts]) for i in range(3))


def learn_stems(chosen: DataFrame) -> Stems:
    """Stems that tell toxic texts (label 1) the grammar's own words miss from the others.

    Equal texts count once. Patterns are counted in Spark; the driver gets those that at least
    STEM_TEXTS missed texts hold, then which of these texts holds which of those that
    other texts hardly hold: never the patterns of whole texts.
    """
    spark = chosen.sparkSession
    unlike = chosen.where("text is not null").groupBy(F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"), F.max("label").alias("label"))

    def missed(batches):
        for batch in blocks(batches):
            rows, _ = counts(batch.column("text"))
            n, hashes, row = _patterns(batch.column("text"))
            open_ = ~np.isin(row, rows)
            n, hashes, row = n[open_], hashes[open_], row[open_]
            order = np.lexsort((hashes, row))
            n, hashes, row = n[order], hashes[order], row[order]
            first = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])]) if len(row) else order
            yield pa.RecordBatch.from_arrays(
                [batch.column("h").take(pa.array(row[first])), pa.array(hashes[first].view(np.int64)), pa.array(n[first], pa.int32())], names=["h", "pattern", "size"]
            )

    held = written(unlike.where("label > 0").select("h", "text").mapInArrow(missed, "h bigint, pattern bigint, size int"), "toxicity-patterns")
    often = held.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), F.min("size").alias("size")).where(F.col("n") >= STEM_TEXTS).collect()
    if not often:
        return ()
    wanted, total, sizes = (np.array([r[name] for r in often], np.int64) for name in ("pattern", "n", "size"))
    order = np.argsort(wanted.view(np.uint64))
    wanted, total, sizes = wanted[order].view(np.uint64), total[order], sizes[order]

    def elsewhere(batches):
        found = np.zeros(len(wanted), np.int64)
        for batch in blocks(batches):
            _, hashes, row = _patterns(batch.column("text"))
            which, at = _found(hashes, wanted)
            pairs = np.unique(row[which] * len(wanted) + at)
            found += np.bincount(pairs % len(wanted), minlength=len(wanted))
        yield pa.RecordBatch.from_pydict({"counts": pa.array([found], pa.list_(pa.int64()))})

    clean = np.zeros(len(wanted), np.int64)
    for r in unlike.where("label = 0").select("text").mapInArrow(elsewhere, "counts array<bigint>").collect():
        clean += np.array(r["counts"])
    telling = total >= STEM_SHARE * (total + clean)
    wanted, clean, sizes = wanted[telling], clean[telling], sizes[telling]
    asked = spark.createDataFrame([(int(p),) for p in wanted.view(np.int64)], "pattern bigint")
    texts = held.join(F.broadcast(asked), "pattern").groupBy("h").agg(F.collect_list("pattern").alias("patterns")).collect()
    lengths = dict(zip(wanted.tolist(), sizes.tolist()))
    picked = explain([np.array(r["patterns"], np.int64).view(np.uint64) for r in texts], dict(zip(wanted.tolist(), clean.tolist())), lengths)
    return tuple((lengths[h], h) for h in picked)


def fit(docs: DataFrame, labels: DataFrame, label: str, learn: Column, sample: int = SAMPLE) -> Weights:
    """Stems and weights from the labelled documents for whose key ``learn`` holds; the grammar's own if there are none."""
    chosen = written(labelled(docs, labels, label, learn, sample), "toxicity-sample")
    stems = learn_stems(chosen)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in blocks(batches):
            rows, found = counts(batch.column("text"), stems)
            every = np.zeros((batch.num_rows, found.shape[1]), np.int64)
            every[rows] = found
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array([r[r > 0] for r in every], lists), pa.array([np.flatnonzero(r) for r in every], lists)],
                names=["doc_id", "label", "counts", "places"],
            )

    key_type = docs.schema["doc_id"].dataType.simpleString()
    rows = (
        chosen.select("doc_id", "label", "text")
        .mapInArrow(run, f"doc_id {key_type}, label int, counts array<bigint>, places array<bigint>")
        .collect()
    )
    if not rows:
        return prior()
    rows.sort(key=lambda r: r["doc_id"])
    x = np.zeros((len(rows), len(FEATURES) + len(stems)), np.float32)
    for i, r in enumerate(rows):
        x[i, r["places"]] = r["counts"]
    return regress(x, np.array([float(r["label"] > 0) for r in rows]), prior(stems))


def score(docs: DataFrame, weights: Weights, name: str = "score", keep: bool = False) -> DataFrame:
    """``docs`` with the probability of toxicity as ``name``; the text goes unless ``keep``."""
    kept = others(docs, "text", name)
    fields = [*kept, "text"] if keep else kept
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in fields), f"`{name}` double"])

    def run(batches):
        for batch in blocks(batches):
            scores = pa.array(weights.scores(batch.column("text")), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in fields), scores], names=[*fields, name])

    return docs.select(*kept, "text").mapInArrow(run, schema)

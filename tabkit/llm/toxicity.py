"""Toxicity by a grammar of weighted finite-state transducers over clauses.

A lexical machine (Aho-Corasick) reads the characters and marks insults, threats, targets, negations
and reporting words; insults carry a weight. Three small transducers are composed over the marks of a
clause: negation turns the hits in its scope into negated ones, reported speech turns what follows
it into reported ones, and the target machine says at the end of the clause whether somebody is meant. What the
composition puts out for the clauses of a text are the features of a logistic score.

Insults are a short list of words and what labelled texts add to it: words and word beginnings that
toxic texts have and others do not. Weights and score are fitted on all labelled rows that are not held out.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.llm.common import append, extended, fresh, make_room, map_arrow
from tabkit.runtime import fits_broadcast, materialize

# Entries a task counts before it sends them on.
COUNT_ENTRIES = 500_000
THRESHOLD = 0.3
# A learned word or beginning: share of toxic texts among those that have it, and how many of the toxic ones do.
# Both halves of the texts must say so: what is pure by chance in one is not in the other.
PURITY, SUPPORT, LEAST = 0.9, 0.01, 4
# Letters of a learned beginning. Shorter ones are those of many harmless words.
BEGINNINGS = range(6, 9)
SCOPE = 3  # words a negation reaches

WORDS = {
    "insult": "idiot stupid moron loser scum trash clown pathetic worthless disgusting dumb imbecile jerk"
    " imbécile crétin ordure minable dummkopf abschaum trottel versager idiota estúpido imbécil basura",
    "threat": "kill hurt destroy murder beat smash tuer frapper détruire töten umbringen vernichten matar golpear destruir",
    "target": "you your yourself they them he him she her tu toi vous du dich ihr euch usted ustedes",
    "negation": "not no never nobody isn't aren't don't pas jamais nicht kein keine nie nunca jamás",
    "report": "said says called quoted according dit selon sagte laut dijo según",
}
_MARK = {"insult": "I", "threat": "T", "target": "Y", "negation": "N", "report": "R"}
_CLAUSE = re.compile(r"[.!?;:\n]+")
_WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?")
FEATURES = ("insult", "insult_targeted", "insult_negated", "insult_reported", "threat", "threat_targeted", "strongest", "density", "kinds")


class Transducer:
    """A deterministic transducer: (state, symbol) to (state, output). Symbols without a step pass unchanged."""

    def __init__(self, start, steps: dict):
        self.start, self.steps = start, steps

    def step(self, state, symbol: str):
        return self.steps.get((state, symbol), (state, symbol))

    def run(self, symbols) -> list[str]:
        state, out = self.start, []
        for s in symbols:
            state, o = self.step(state, s)
            out.append(o)
        return out


def compose(first: Transducer, second: Transducer, alphabet: str) -> Transducer:
    """The machine that feeds the output of ``first`` to ``second``, over the reachable pairs of states."""
    start = (first.start, second.start)
    steps, todo, seen = {}, [start], {start}
    while todo:
        a, b = state = todo.pop()
        for symbol in alphabet:
            a2, middle = first.step(a, symbol)
            b2, out = second.step(b, middle)
            steps[state, symbol] = ((a2, b2), out)
            if (a2, b2) not in seen:
                seen.add((a2, b2))
                todo.append((a2, b2))
    return Transducer(start, steps)


# O is any other word, E the end of a clause. i and t are negated hits, J and U reported ones.
ALPHABET = "ITYNROE"


def negation(scope: int = SCOPE) -> Transducer:
    steps = {}
    for left in range(scope + 1):
        steps[left, "N"] = (scope, "N")
        steps[left, "E"] = (0, "E")
        for symbol in "ITYRO":
            negated = {"I": "i", "T": "t"}.get(symbol, symbol) if left else symbol
            steps[left, symbol] = (max(left - 1, 0), negated)
    return Transducer(0, steps)


def reported() -> Transducer:
    steps = {("plain", "R"): ("reported", "R"), ("reported", "E"): ("plain", "E")}
    steps |= {("reported", s): ("reported", {"I": "J", "T": "U"}[s]) for s in "IT"}
    return Transducer("plain", steps)


def targets() -> Transducer:
    """At the end of a clause puts out whether it had a target: ``+`` or ``-``."""
    return Transducer("nobody", {("nobody", "Y"): ("somebody", "Y"), ("somebody", "E"): ("nobody", "+"), ("nobody", "E"): ("nobody", "-")})


GRAMMAR = compose(compose(negation(), reported(), ALPHABET), targets(), ALPHABET)


@dataclass
class Model:
    #: beginning or word -> (class, weight, whether it must be a whole word)
    lexicon: dict[str, tuple[str, float, bool]] = field(default_factory=dict)
    bias: float = -3.0
    weights: list[float] = field(default_factory=lambda: [1.0, 1.5, 0.3, 0.3, 0.5, 1.0, 0.5, 0.0, 0.5])

    def scorer(self) -> Scorer:
        return Scorer(self)


def clauses(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of each clause, one pass from left to right."""
    start = 0
    for m in _CLAUSE.finditer(text):
        yield start, m.start()
        start = m.end()
    yield start, len(text)


def seed_lexicon() -> dict[str, tuple[str, float, bool]]:
    return {w: (kind, 2.0 if kind == "insult" else 1.0, True) for kind, words in WORDS.items() for w in words.split()}


class Scorer:
    """The machines of a model, ready to read texts."""

    def __init__(self, model: Model):
        self.model = model
        self.machine = ahocorasick.Automaton()
        for key, (kind, weight, whole) in model.lexicon.items():
            if kind in ("insult", "threat"):
                self.machine.add_word(key, (key, kind, weight, whole))
        self.machine.make_automaton()
        self.words = {w: _MARK[k] for w, (k, _, _) in model.lexicon.items() if k not in ("insult", "threat")}

    def hits(self, text: str) -> dict[int, tuple[str, float, str]]:
        """Start of each marked word: its mark, its weight and the entry; the longest entry counts."""
        out: dict[int, tuple[str, float, str]] = {}
        if not len(self.machine):
            return out
        for end, (key, kind, weight, whole) in self.machine.iter(text):
            start = end - len(key) + 1
            if start and (text[start - 1].isalnum() or text[start - 1] == "_"):
                continue
            if whole and end + 1 < len(text) and (text[end + 1].isalnum() or text[end + 1] == "_"):
                continue
            if start not in out or len(key) > len(out[start][2]):
                out[start] = (_MARK[kind], weight, key)
        return out

    def features(self, text: str | None) -> list[float]:
        text = (text or "").lower()
        hits = self.hits(text)
        if not hits:
            return [0.0] * len(FEATURES)
        sums: dict[str, float] = defaultdict(float)
        order = sorted(hits)
        at = 0
        for begin, end in clauses(text):
            if at == len(order):
                break
            if order[at] >= end:
                continue
            symbols, weights = [], []
            for m in _WORD.finditer(text, begin, end):
                hit = hits.get(m.start())
                symbols.append(hit[0] if hit else self.words.get(m[0], "O"))
                weights.append(hit[1] if hit else 0.0)
            out = GRAMMAR.run([*symbols, "E"])
            somebody = out[-1] == "+"
            for o, w in zip(out, weights, strict=False):
                if o in "IT":
                    sums[o + ("+" if somebody else "")] += w
                elif o in "itJU":
                    sums["negated" if o in "it" else "reported"] += w
            while at < len(order) and order[at] < end:
                at += 1
        n_words = max(len(text) / 6, 1.0)
        return [
            math.log1p(sums["I"]),
            math.log1p(sums["I+"]),
            math.log1p(sums["negated"]),
            math.log1p(sums["reported"]),
            math.log1p(sums["T"]),
            math.log1p(sums["T+"]),
            max(w for _, w, _ in hits.values()),
            math.log1p(100 * len(hits) / n_words),
            math.log1p(len({k for _, _, k in hits.values()})),
        ]

    def score(self, texts: list[str | None]) -> np.ndarray:
        x = np.array([self.features(t) for t in texts]).reshape(len(texts), len(FEATURES))
        return 1 / (1 + np.exp(-np.clip(self.model.bias + x @ np.array(self.model.weights), -30, 30)))


def held_out(row_id: Column) -> Column:
    """Rows no label is learned from: the CRC-32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.pmod(F.crc32(row_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, row_id: str, text: str, label: str) -> DataFrame:
    """All labelled rows that are not held out, as (text, label), copies of a text once."""
    known = labels.filter(F.col(label).isNotNull() & F.col(row_id).isNotNull() & ~held_out(F.col(row_id)))
    known = materialize(known.groupBy(F.col(row_id).alias("id")).agg(F.max(label).cast("int").alias("label")), "labels")
    rows = docs.select(F.col(row_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    known = F.broadcast(known) if fits_broadcast(known) else known
    return rows.join(known, "id").groupBy("text").agg(F.max("label").alias("label"))


def _entries(text: str) -> set[tuple[str, bool]]:
    """Words (true) and word beginnings (false) of a text."""
    words = set(_WORD.findall(text.lower()))
    return {(w, True) for w in words if len(w) > 2} | {(w[:n], False) for w in words for n in BEGINNINGS if len(w) > n}


def _counts(rows: DataFrame, only: set[tuple[str, bool]] | None = None) -> DataFrame:
    """(entry, whole, n_0, n_1): how many texts of either half have each entry, or each of ``only``."""
    shared = rows.sparkSession.sparkContext.broadcast(only)
    names, kinds = ["entry", "whole", "n_0", "n_1"], (pa.string(), pa.bool_(), pa.int64(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = shared.value
        seen: dict[tuple[str, bool], list[int]] = defaultdict(lambda: [0, 0])

        def out() -> pa.RecordBatch:
            columns = [[e for e, _ in seen], [w for _, w in seen], *([n[i] for n in seen.values()] for i in (0, 1))]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for t in batch.column(0).to_pylist():
                half = zlib.crc32(t.encode()) & 1
                for entry in _entries(t) if only is None else _entries(t) & only:
                    seen[entry][half] += 1
                if len(seen) >= COUNT_ENTRIES:
                    yield out()
                    seen.clear()
        yield out()

    counts = map_arrow(rows.select("text"), run, "entry string, whole boolean, n_0 long, n_1 long")
    return counts.groupBy("entry", "whole").agg(F.sum("n_0").alias("n_0"), F.sum("n_1").alias("n_1"))


def learn_lexicon(rows: DataFrame) -> dict[str, tuple[str, float, bool]]:
    """Insults that the labelled texts add to the list, with their log odds as weights.

    Only entries that enough toxic texts have are counted in the others.
    """
    n = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_other = n.get(1, 0), n.get(0, 0)
    known = (F.col("n_0") > 0) & (F.col("n_1") > 0) & (F.col("n_0") + F.col("n_1") >= max(LEAST, SUPPORT * n_toxic))
    # entries that one in a hundred toxic texts has: at most a hundred times as many as such a text has
    toxic = {(r["entry"], r["whole"]): (r["n_0"], r["n_1"]) for r in _counts(rows.filter("label = 1")).filter(known).collect()}
    other = {(r["entry"], r["whole"]): (r["n_0"], r["n_1"]) for r in _counts(rows.filter("label <> 1"), set(toxic)).collect()}
    found = []
    for (entry, whole), yes in toxic.items():
        no = other.get((entry, whole), (0, 0))
        if all(y >= PURITY * (y + o) for y, o in ((sum(yes), sum(no)), *zip(yes, no, strict=True))):
            found.append({"entry": entry, "whole": whole, "toxic": sum(yes), "other": sum(no)})
    out: dict[str, tuple[str, float, bool]] = {}
    for r in sorted(found, key=lambda r: (len(r["entry"]), r["whole"], r["entry"])):
        entry = r["entry"]
        shorter = [out.get(entry[:k]) for k in range(1, len(entry))]
        if any(s and not s[2] for s in shorter) or entry in out:
            continue  # a beginning of it is marked already
        weight = math.log((r["toxic"] + 0.5) / (n_toxic + 1)) - math.log((r["other"] + 0.5) / (n_other + 1))
        out[entry] = ("insult", max(weight, 0.1), r["whole"])
    return out


def logistic(points: DataFrame, ridge: float = 1.0, rounds: int = 50) -> tuple[float, list[float]]:
    """Ridge logistic regression of (x, y, n) by Newton's method: bias and weights. A round adds up gradients in the tasks."""
    width = len(FEATURES) + 1
    w = np.zeros(width)
    penalty = np.full(width, ridge)
    penalty[0] = 1e-6

    def sums(w: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, task = np.zeros((width, width + 1)), TaskContext.get().partitionId()
            for batch in batches:
                x, y, n = (batch.column(i).to_pylist() for i in range(3))
                a = np.column_stack((np.ones(len(x)), np.array(x, float).reshape(len(x), width - 1)))
                n, y = np.array(n, float), np.array(y, float)
                p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
                total[:, 0] += a.T @ (n * (p - y))
                total[:, 1:] += (a * (n * p * (1 - p))[:, None]).T @ a
            yield pa.RecordBatch.from_arrays([pa.array([task], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["task", "sums"])

        return run

    for _ in range(rounds):
        # a hundred numbers a task, added up in the order of the tasks
        found = sorted(map_arrow(points, sums(w), "task int, sums binary").collect())
        total = np.sum([np.frombuffer(r["sums"]).reshape(width, width + 1) for r in found], axis=0)
        step = np.linalg.solve(total[:, 1:] + np.diag(penalty + 1e-9), total[:, 0] + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), w[1:].tolist()


def fit(
    docs: DataFrame, labels: DataFrame, row_id: str = "doc_id", text: str = "text", label: str = "toxic"
) -> Model:
    """Learn lexicon and score from the labels of rows that are not held out.

    Without labelled rows of both classes the listed words and fixed weights are used.
    """
    rows = materialize(training_rows(docs, labels, row_id, text, label), "labelled")
    seen = {r["label"] for r in rows.select("label").distinct().collect()}
    if seen != {0, 1}:
        return Model(seed_lexicon())
    model = Model(seed_lexicon() | learn_lexicon(rows))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = [T.StructField("x", T.ArrayType(T.DoubleType())), T.StructField("y", T.IntegerType())]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value.scorer()
        for batch in batches:
            x = [scorer.features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1)], names=["x", "y"])

    points = map_arrow(rows.select("text", "label"), read, T.StructType(kinds)).groupBy("x", "y").agg(F.count("*").alias("n"))
    model.bias, model.weights = logistic(materialize(points.sortWithinPartitions("x", "y"), "toxic-points"))
    return model


def with_score(df: DataFrame, model: Model, text: str = "text", name: str = "toxicity") -> DataFrame:
    """Add the score of the whole text, 0 to 1. Null and empty texts get that of a text without hits.

    The text alone decides, so copies have one score; all other columns stay, and one called ``name`` already
    is replaced.
    """
    df = make_room(df, name)
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema, arrow = extended(df, (name, T.DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value.scorer()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            yield append(batch, arrow, pa.array(scorer.score(texts), pa.float64()))

    return map_arrow(df, run, schema)


def drop_toxic(df: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score is below the threshold, with their columns as they are."""
    name = fresh(df, "toxicity")
    return with_score(df, model, text, name).filter(F.col(name) < threshold).select(*df.columns)

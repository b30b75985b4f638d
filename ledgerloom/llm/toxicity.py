"""Toxicity by a weighted finite-state grammar over clauses.

Words become classes: insults (with weights learned from labels: whole words, and stems for languages that inflect them),
modifiers, threats, targets, negations, reports, and the ends of clauses. Five transducers rewrite the sequence of classes,
one after the other, and are composed into one machine:

    threat      target ... threat verb becomes a match; a threat verb without a target is an ordinary verb
    insult      target ... insult, modifier ... insult and insult ... insult (a second word strengthens) become matches; an
                insult that stands alone becomes a match of lower weight
    negation    weakens the next match within a few words
    report      weakens all matches of a clause that says who said it
    target      strengthens matches that are aimed at somebody

Each clause with a match has a score, the weights of its matches times the factors on their paths; a document's features are
its largest clause score, the sum, the number of clauses and the part of words, and a logistic function fitted on labelled
documents gives its score. The classes other than insults are fixed lists; the weight of a threat is that of the heaviest
insult.

The fit uses a bounded sample (SAMPLE_DOCS per label, chosen by a hash of the id, equal texts once). Entries are found by
covering: the word or stem that explains most toxic documents not yet explained is taken, until no further one explains
several. Then all whole texts are scored; neither label, language, source nor id is read.

A null or empty text has no match and gets the score of a document without matches, as do all if no label could be
learned from. Rows are scored one by one, so repeated rows get equal scores. An empty table gives an empty result."""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm import text as tx
from ledgerloom.llm.store import durable, held_out

#: Bounds of the fit: documents per label, entries considered, entries kept.
SAMPLE_DOCS, CANDIDATES, ENTRIES = 4_000, 4_000, 500
STEMS, SCOPE = (4, 5, 6, 7), 4
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_MEMO_WORDS = 200_000

#: Fixed word classes of the grammar, in the languages of the texts.
THREATS = "kill hurt destroy beat shoot burn töte töten schlagen vernichten tuer tuerai frapper détruire matar mataré golpear destruir".split()
TARGETS = "you your he him she her they them du dich dein er ihn sie ihr tu te toi vous il elle ils tú usted él ella ellos".split()
NEGATIONS = "not no never nobody isn't aren't wasn't don't doesn't nicht kein keine nie ne pas jamais aucun nunca ningún tampoco".split()
MODIFIERS = "such total utter complete absolute damn dirty solch solcher völliger verdammter dreckiger espèce gros sale pauvre pedazo maldito completo sucio".split()
REPORTS = "said says wrote writes called quote quoted quoting allegedly sagte schrieb nannte dit écrit appelé dijo escribió llamó".split()

SYMBOLS = range(10)
OTHER, END, GAP, INSULT, THREAT, TARGET, NEGATION, REPORT, MODIFIER, MATCH = SYMBOLS
#: Factors of the grammar on a match.
NEGATED, REPORTED, DIRECTED, ALONE, AGAIN = 0.25, 0.4, 1.25, 0.8, 1.25


@dataclass(frozen=True)
class Transducer:
    """Deterministic: (state, symbol) -> (next state, symbol written, factor). What has no arc passes unchanged."""

    start: str
    arcs: dict

    def step(self, state, symbol):
        return self.arcs.get((state, symbol), (state, symbol, 1.0))

    def states(self):
        return {self.start} | {s for s, _ in self.arcs} | {a[0] for a in self.arcs.values()}


def composed(machines: list[Transducer], symbols: range) -> Transducer:
    """One machine over tuples of states that does what the machines do one after another; only reachable states."""
    start = tuple(m.start for m in machines)
    arcs, todo, seen = {}, [start], {start}
    while todo:
        at = todo.pop()
        for symbol in symbols:
            to, out, factor = [], symbol, 1.0
            for m, s in zip(machines, at):
                nxt, out, f = m.step(s, out)
                to.append(nxt)
                factor *= f
            arcs[at, symbol] = (tuple(to), out, factor)
            if tuple(to) not in seen:
                seen.add(tuple(to))
                todo.append(tuple(to))
    return Transducer(start, arcs)


def _machines() -> list[Transducer]:
    """The transducers in their order. A gap symbol stands for more than SCOPE words."""
    threat = Transducer("calm", {("calm", TARGET): ("met", TARGET, 1.0), ("calm", THREAT): ("calm", OTHER, 1.0), ("met", THREAT): ("met", MATCH, 1.0), ("met", END): ("calm", END, 1.0)})
    insult = Transducer(
        "alone",
        {
            ("alone", TARGET): ("led", TARGET, 1.0), ("alone", MODIFIER): ("led", OTHER, 1.0), ("led", MODIFIER): ("led", OTHER, 1.0), ("again", MODIFIER): ("again", OTHER, 1.0),
            ("alone", INSULT): ("again", MATCH, ALONE), ("led", INSULT): ("again", MATCH, 1.0), ("again", INSULT): ("again", MATCH, AGAIN),
            **{(s, x): ("alone", x, 1.0) for s in ("led", "again") for x in (GAP, END)},
        },
    )
    negation = Transducer("plain", {("plain", NEGATION): ("negated", OTHER, 1.0), ("negated", MATCH): ("plain", MATCH, NEGATED), ("negated", NEGATION): ("plain", OTHER, 1.0), ("negated", GAP): ("plain", GAP, 1.0), ("negated", END): ("plain", END, 1.0)})
    report = Transducer("direct", {("direct", REPORT): ("reported", OTHER, 1.0), ("reported", MATCH): ("reported", MATCH, REPORTED), ("reported", END): ("direct", END, 1.0)})
    target = Transducer("none", {("none", TARGET): ("aimed", OTHER, 1.0), ("aimed", MATCH): ("aimed", MATCH, DIRECTED), ("aimed", GAP): ("none", GAP, 1.0), ("aimed", END): ("none", END, 1.0)})
    return [threat, insult, negation, report, target]


MACHINES = _machines()
MACHINE = composed(MACHINES, SYMBOLS)


def clause_scores(classes: list[int], weights: list[float], gaps: list[int], ends: list[int]) -> list[float]:
    """Scores of the clauses with a match, from a text's classed words: ``gaps`` are the words left out before each,
    ``ends`` the clause ends before it."""
    state, clause, out = MACHINE.start, 0.0, []
    for symbol, weight, gap, end in zip(classes, weights, gaps, ends):
        if end:
            state = MACHINE.arcs[state, END][0]
            if clause:
                out.append(clause)
            clause = 0.0
        if gap > SCOPE:
            state = MACHINE.arcs[state, GAP][0]
        state, written, factor = MACHINE.arcs[state, symbol]
        if written == MATCH:
            clause += weight * factor
    return [*out, clause] if clause else out


class Lexicon:
    """Class and weight of a word; remembers the words it has met, up to a bound."""

    def __init__(self, entries: dict[str, float]):
        self.entries = entries
        heaviest = max(entries.values(), default=1.0)
        self.fixed = {w: (c, heaviest if c == THREAT else 0.0) for c, ws in ((MODIFIER, MODIFIERS), (THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in ws}
        self.seen = tx.Numbers(_MEMO_WORDS)
        self.classes, self.weights, self.closes = (np.zeros(1 << 12, k) for k in (np.int8, float, bool))

    @classmethod
    def of(cls, name: str, shared) -> Lexicon:
        return tx.kept(("lexicon", name), lambda: cls(shared.value))

    def word(self, token: str) -> tuple[int, float, bool]:
        """(class, weight, whether a clause ends with it) of one white-space token."""
        bare = _EDGE.sub("", token.lower())
        weight = self.entries.get(bare)
        if weight is None:
            weight = next((w for n in STEMS if len(bare) > n and (w := self.entries.get(f"{bare[:n]}*")) is not None), None)
        kind, weight = (INSULT, weight) if weight is not None else self.fixed.get(bare, (OTHER, 0.0))
        return kind, weight, token[-1] in ".!?;:"

    def texts(self, column: pa.Array) -> np.ndarray:
        """Features of each text."""
        w = tx.words(column)
        out = np.zeros((len(w.first) - 1, 4))
        if not len(w.starts):
            return out
        distinct, where, back = np.unique(tx.hashes(w), return_index=True, return_inverse=True)
        if self.seen.full(distinct):
            self.seen = tx.Numbers(_MEMO_WORDS)
        known, new = self.seen.of(distinct)
        if len(new):
            self.classes, self.weights, self.closes = (tx.room(x, int(known[new[-1]]) + 1) for x in (self.classes, self.weights, self.closes))
            raw, s, e = w.data.tobytes(), w.starts[where[new]].tolist(), w.ends[where[new]].tolist()
            for k, a, b in zip(known[new].tolist(), s, e):
                self.classes[k], self.weights[k], self.closes[k] = self.word(raw[a:b].decode("utf-8", "replace"))
        place = known[back]
        kinds = self.classes[place]
        closed = np.concatenate([np.zeros(1, np.int64), np.cumsum(self.closes[place])])
        events = np.flatnonzero(kinds)
        cut = np.searchsorted(events, w.first)
        for i in np.flatnonzero(np.diff(cut)).tolist():
            e = events[cut[i] : cut[i + 1]]
            c = kinds[e]
            if not ((c == INSULT) | (c == THREAT)).any():
                continue
            before = np.concatenate([w.first[i : i + 1] - 1, e[:-1]])
            ends = closed[e] - closed[np.maximum(before, w.first[i])]
            scores = clause_scores(c.tolist(), self.weights[place[e]].tolist(), (e - before - 1).tolist(), ends.tolist())
            if scores:
                n = w.first[i + 1] - w.first[i]
                out[i] = max(scores), math.log1p(sum(scores)), math.log1p(len(scores)), math.sqrt(len(scores) / n)
        return out


def _keys(text: str) -> set[str]:
    """The words of a text and their stems."""
    words = {_EDGE.sub("", t) for t in text.lower().split()} - {""}
    return words | {f"{w[:n]}*" for w in words for n in STEMS if len(w) > n}


def entries_of(sample: DataFrame) -> dict[str, float]:
    """Insults and their weights from a bounded sample (text, label)."""
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return {}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list[int]] = {}
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                for key in _keys(text):
                    found.setdefault(key, [0, 0])[label] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array([v[1] for v in found.values()], pa.int64()), pa.array([v[0] for v in found.values()], pa.int64())], ["key", "n1", "n0"])

    counts = sample.mapInArrow(count, "key string, n1 bigint, n0 bigint").groupBy("key").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    weight = F.log((F.col("n1") + 0.5) / (n1 + 1.0)) - F.log((F.col("n0") + 0.5) / (n0 + 1.0))
    best = counts.withColumn("weight", weight).filter("n1 >= 2 and weight >= 2").orderBy(F.col("n1").desc(), F.endswith("key", F.lit("*")), F.length("key").desc(), "key").limit(CANDIDATES).collect()
    place = {r["key"]: i for i, r in enumerate(best)}

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [sorted(place[k] for k in _keys(t) if k in place) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32()))], ["keys"])

    toxic = [set(r["keys"]) for r in sample.filter("label = 1").mapInArrow(present, "keys array<int>").collect()]
    holders: dict[int, set[int]] = {}
    for d, keys in enumerate(toxic):
        for k in keys:
            holders.setdefault(k, set()).add(d)
    chosen: list[int] = []
    left = {k: set(v) for k, v in holders.items()}
    cost = 4 * min(1.0, n1 / n0)  # of a document without the label, in documents with it
    while left and len(chosen) < ENTRIES:
        k = min(left, key=lambda k: (cost * best[k]["n0"] - len(left[k]), k))
        gain = left.pop(k)
        if len(gain) < 2:
            break
        chosen.append(k)
        for d in gain:
            for other in toxic[d]:
                if other in left:
                    left[other].discard(d)
    usual = float(np.median([best[k]["n1"] for k in chosen])) if chosen else math.inf
    names = {best[k]["key"]: k for k in chosen}
    for k in sorted(holders):
        if best[k]["n0"] == 0 and best[k]["n1"] >= max(5, 0.3 * usual):
            stem = best[k]["key"].rstrip("*")
            # a stem that stands for no more than an entry it is the beginning of says nothing new
            if not any(key.startswith(stem) and best[j]["n1"] >= 0.9 * best[k]["n1"] for key, j in names.items()):
                names[best[k]["key"]] = k
    names = {key: float(best[k]["weight"]) for key, k in names.items()}
    # a whole word whose stem is an entry needs none of its own
    return {key: w for key, w in names.items() if key.endswith("*") or not any(f"{key[:n]}*" in names for n in STEMS if len(key) > n)}


def _logistic(x: np.ndarray, y: np.ndarray, sizes: dict[int, int], steps: int = 60, ridge: float = 1e-2) -> np.ndarray:
    """Weights (bias first) by Newton's method; ``sizes`` are the labels' numbers before sampling."""
    x = np.concatenate([np.ones((len(x), 1)), x], 1)
    balance = np.where(y == 1, sizes[1] / max(1, (y == 1).sum()), sizes[0] / max(1, (y == 0).sum())) * len(y) / (sizes[0] + sizes[1])
    b = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        hessian = (x * (balance * p * (1 - p))[:, None]).T @ x + ridge * len(y) / 100 * np.eye(len(b))
        move = np.linalg.solve(hessian, x.T @ (balance * (y - p)) - ridge * len(y) / 100 * b)
        b = b + move
        if np.abs(move).max() < 1e-9:
            break
    return b


def featured(docs: DataFrame, entries: dict[str, float]) -> DataFrame:
    """``docs`` with the four features appended as an array ``_features``; texts are in ``text``."""
    shared, name = docs.sparkSession.sparkContext.broadcast(entries), uuid.uuid4().hex  # at most ENTRIES entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon.of(name, shared)
        for batch in batches:
            for part in tx.slices(batch, "text"):
                x = pa.array(list(lexicon.texts(part.column("text"))), pa.list_(pa.float64()))
                rest = [c for c in part.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), x], [*rest, "_features"])

    return docs.mapInArrow(run, docs.drop("text").schema.add("_features", T.ArrayType(T.DoubleType())))


def fit(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, float], list[float]]:
    """Entries and calibration from documents (doc_id, text) and labels (doc_id, label), 0 or 1; others are not used.

    The sample is drawn from the labels; at most about 2 * SAMPLE_DOCS texts are read for it."""
    rows = labels.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("label").cast("int").alias("label")).distinct()
    sizes = durable(rows.groupBy("label").agg(F.count("*").alias("n")))
    mark = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("toxicity sample")), F.lit(1 << 40))
    chosen = durable(rows.join(sizes, "label").filter(mark * F.col("n") < F.lit(SAMPLE_DOCS * float(1 << 40))).select("doc_id", "label"))
    sample = durable(docs.join(chosen, "doc_id").filter(F.col("text").isNotNull()).select("text", "label").distinct())
    entries = entries_of(sample)
    if not entries:
        return {}, [-3.0, 0.0, 0.0, 0.0, 0.0]
    found = featured(sample, entries).collect()
    x, y = np.array([r["_features"] for r in found]), np.array([r["label"] for r in found])
    return entries, _logistic(x, y, {r["label"]: r["n"] for r in sizes.collect()}).tolist()


def scored(docs: DataFrame, model: tuple[dict[str, float], list[float]]) -> DataFrame:
    """``docs`` without its text, with a score from 0 to 1."""
    entries, (bias, *weights) = model
    z: Column = F.lit(bias)
    for i, b in enumerate(weights):
        z = z + F.lit(b) * F.get("_features", F.lit(i))
    return featured(docs, entries).withColumn("score", 1 / (1 + F.exp(-z))).drop("_features")


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    out = held_out("doc_id", 5, 0)
    model = fit(docs, labels.filter(~out))
    result = scored(docs, model)
    return result.select("doc_id", out.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


QUERIES = {"op8_toxicity": op8_toxicity}
ORACLE_SQL: dict[str, str] = {}

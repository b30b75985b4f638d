import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import toxicity as tox

LABELS = "doc_id bigint, label int"
LEX = {"idiot": 4.0, "grob*": 3.0}


def clauses(text):
    found = []
    original = tox.clause_scores

    def record(*a):
        found.append(original(*a))
        return found[-1]

    tox.clause_scores = record
    try:
        tox.Lexicon(LEX).texts(pa.array([text], pa.string()))
    finally:
        tox.clause_scores = original
    return found[0] if found else []


def test_grammar_scores_clauses_not_words():
    assert clauses("the idiot sat") == [4.0 * tox.ALONE]
    assert clauses("such an idiot") == [4.0] and clauses("total grober idiot") == [3.0 + 4.0 * tox.AGAIN]
    assert clauses("idiot a b c d e f idiot") == [8.0 * tox.ALONE]  # too far apart to be one insult
    assert clauses("such a. idiot") == [4.0 * tox.ALONE]
    assert clauses("you idiot") == [4.0 * tox.DIRECTED]
    assert clauses("he is not an idiot") == [4.0 * tox.NEGATED * tox.DIRECTED]
    assert clauses("not that it mattered very much idiot") == [4.0 * tox.ALONE]  # beyond the negation's scope
    assert clauses("not. idiot") == [4.0 * tox.ALONE]
    assert clauses("never not idiot") == [4.0 * tox.ALONE]
    assert clauses("she said idiot and idiot; idiot") == [4.0 * tox.REPORTED * tox.DIRECTED * (1 + tox.AGAIN), 4.0 * tox.ALONE]
    assert clauses("Grobian! GROBER.") == [3.0 * tox.ALONE] * 2
    assert clauses("grob") == []  # a stem needs an ending
    assert clauses("kill it") == [] and clauses("we kill you") == [] and clauses("you we kill") == [4.0 * tox.DIRECTED]
    assert clauses("nothing at all") == [] and clauses(None) == []


def test_composition_does_what_the_machines_do_in_turn():
    r = random.Random(1)
    a = tox.Transducer("0", {("0", 3): ("1", 4, 2.0), ("1", 3): ("0", 3, 1.0)})
    b = tox.Transducer("x", {("x", 4): ("y", 5, 3.0), ("y", 4): ("x", 4, 0.5)})
    both = tox.composed([a, b], range(8))
    s, t, st = "0", "x", both.start
    for symbol in r.choices(range(8), k=200):
        s, mid, f = a.step(s, symbol)
        t, out, g = b.step(t, mid)
        st, got, h = both.arcs[st, symbol]
        assert (got, h, st) == (out, f * g, (s, t))


def brute(text, entries):
    """Features from the machines run one after another over the whole text, without composing them."""
    fixed = {w: c for c, ws in ((tox.MODIFIER, tox.MODIFIERS), (tox.THREAT, tox.THREATS), (tox.TARGET, tox.TARGETS), (tox.NEGATION, tox.NEGATIONS), (tox.REPORT, tox.REPORTS)) for w in ws}
    words, symbols, last, ended = re.findall(r"[^\x20\x09-\x0D]+", text or ""), [], -1, False
    for i, word in enumerate(words):
        bare = re.sub(r"^[\W_]+|[\W_]+$", "", word.lower())
        weight = entries.get(bare) or next((entries[f"{bare[:n]}*"] for n in tox.STEMS if len(bare) > n and f"{bare[:n]}*" in entries), None)
        kind = tox.INSULT if weight else fixed.get(bare, tox.OTHER)
        if kind != tox.OTHER:
            symbols += [(tox.END, 0.0)] * (ended and last >= 0) + [(tox.GAP, 0.0)] * (i - last - 1 > tox.SCOPE)
            symbols.append((kind, weight or (max(entries.values()) if kind == tox.THREAT else 0.0)))
            last, ended = i, False
        ended |= word[-1] in ".!?;:"
    for machine in tox.MACHINES:
        state, out = machine.start, []
        for symbol, weight in symbols:
            state, written, factor = machine.step(state, symbol)
            out.append((written, weight * factor))
        symbols = out
    scores = [0.0]
    for symbol, weight in symbols:
        if symbol == tox.END:
            scores.append(0.0)
        elif symbol == tox.MATCH:
            scores[-1] += weight
    scores = [s for s in scores if s]
    return [max(scores), math.log1p(sum(scores)), math.log1p(len(scores)), math.sqrt(len(scores) / len(words))] if scores else [0.0] * 4


def test_equals_the_machines_one_after_another(spark):
    """Whole texts, real and made: the composed machine over remembered words against plain loops."""
    r = random.Random(5)
    vocab = ["idiot", "grober", "w1", "w2", "w3", "kill", "you", "not", "said", "such", "x.", "y!", "idiot.", "du", "nie", "Kill;", "total", "GROBIAN?", "—", "w4"]
    texts = [" ".join(r.choices(vocab, k=r.randint(0, 60))) for _ in range(400)] + [None, "", "...", "idiot", "you " * 3000 + "idiot"]
    texts += [x.text for x in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    entries = {**LEX, "the": 1.5, "und": 0.5, "tion*": 2.0}
    got = tox.Lexicon(entries).texts(pa.array(texts, pa.string()))
    want = [brute(t, entries) for t in texts]
    assert np.allclose(got, want, atol=1e-12) and sum(any(w) for w in want) > 300


def test_words_of_one_pattern_are_told_apart():
    pair = ["".join("ab"[(bin(i).count("1") + k) & 1] for i in range(1024)) for k in (0, 1)]
    x = tox.Lexicon({pair[0]: 4.0}).texts(pa.array([pair[0], pair[1], " ".join(pair)]))
    assert (x[:, 0] > 0).tolist() == [True, False, True]


def corpus(n=900):
    r = random.Random(4)
    vocab = [f"w{i}" for i in range(500)]
    rows, labels = [], []
    for i in range(n):
        body, bad = r.choices(vocab, k=r.randint(5, 80)), i % 6 == 0
        for _ in range(r.randint(1, 4) if bad else 0):
            body.insert(r.randrange(len(body) + 1), r.choice(["blorp", "zaggy", "krutz" + r.choice("abcdefghij") * 2]))
        rows.append((i, " ".join(body)))
        labels.append((i, int(bad)))
    # copies of one text with the label do not make its words insults
    return rows + [(n + i, rows[0][1]) for i in range(300)], labels + [(n + i, 1) for i in range(300)]


@pytest.fixture(scope="module")
def model(spark):
    rows, labels = corpus()
    return tox.fit(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, LABELS))


def test_lexicon_is_learned_with_stems(model):
    assert set(model[0]) == {"blorp", "zaggy", "krutz*"}


def test_unseen_documents(spark, docs, model):
    rows = [(1, "w1 w2 blorp w3"), (2, "w5 krutzzz w9"), (3, "w1 w2 w3"), (4, None), (5, ""), (6, "w1 w2 " * 60_000 + "blorp"), (None, "zaggy"), (7, "w7"), (7, "w7")]
    extra = docs(rows).withColumns({"score": F.lit("x"), "_features": F.lit(1), "entries": F.lit(2)})
    got = sorted(((r.doc_id, r.score >= 0.5) for r in tox.scored(extra.select("doc_id", "text"), model).collect()), key=str)
    assert got == sorted([(1, True), (2, True), (3, False), (4, False), (5, False), (6, True), (None, True), (7, False), (7, False)], key=str)
    assert tox.scored(docs([]).select("doc_id", "text"), model).count() == 0


def test_nothing_to_learn(spark, docs):
    labels = spark.createDataFrame([(1, 0), (2, None)], LABELS)
    model = tox.fit(docs([(1, "a"), (2, "b")]).select("doc_id", "text"), labels)
    assert [round(r.score, 3) for r in tox.scored(docs([(1, "a")]).select("doc_id", "text"), model).collect()] == [0.047]

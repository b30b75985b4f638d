import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerloom.llm import quality as q

LABELS = "doc_id bigint, label int"


def corpus(n=600):
    """Good texts are varied and mostly from good sources; bad ones repeat a word and mostly come from others."""
    r = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        good = i % 3 > 0
        words = [f"w{r.randrange(400)}" for _ in range(r.randint(20, 60))] if good else [f"x{r.randrange(4)}"] * 10 + [f"w{r.randrange(400)}" for _ in range(10)] + ["|", "!!", "##"] * 4
        source = r.choice("ab" if good == (r.random() < 0.8) else "yz")
        rows.append((i, " ".join(words), "en", source))
        if i % 2 == 0:
            labels.append((i, int(good)))
    return rows, labels


def test_cotraining_scores_unseen_documents(spark, docs):
    rows, labels = corpus()
    model = q.fit(docs(rows), spark.createDataFrame(labels, LABELS))
    out = {r.doc_id: r for r in q.scored(docs(rows), model).collect()}
    unseen = [i for i, *_ in rows if i % 2]
    right = sum((out[i].score >= 0.5) == (i % 3 > 0) for i in unseen) / len(unseen)
    assert right > 0.97
    assert all(0 <= x <= 1 for r in out.values() for x in (r.score, r.text_score, r.metadata_score))
    # the metadata view learns from labels the text view gave
    assert np.mean([(out[i].metadata_score >= 0.5) == (i % 3 > 0) for i in unseen]) > 0.6


def test_each_view_gets_the_other_ones_confident_answers():
    r = np.random.default_rng(3)
    y = r.integers(0, 2, 60)
    pool_y = r.integers(0, 2, 2000)
    strong = lambda y: y[:, None] * 6.0 - 3 + r.standard_normal((len(y), 2))
    weak = lambda y: y[:, None] * 0.8 + r.standard_normal((len(y), 6))
    views, pool = (strong(y), weak(y)), (strong(pool_y), weak(pool_y))
    test_y = r.integers(0, 2, 3000)
    rows = weak(test_y)
    alone, taught = q.cotrain(views, y, pool, rounds=0)[1], q.cotrain(views, y, pool)[1]
    score = lambda m: ((m.sure(rows) >= 0.5) == test_y).mean()
    assert score(taught) > score(alone)


def test_features_of_a_batch_are_those_of_its_rows():
    texts = ["A b b b. 12 | x\ny!", None, "", "word", "a b c a b c a b c", "É ß ##" * 500]
    together = q.text_features(pa.array(texts))
    for i, t in enumerate(texts):
        assert np.allclose(together[i], q.text_features(pa.array([t], pa.string()))[0])
    assert not together[1].any() and not together[2].any()
    assert together[0][2] == 1 / 8 and together[0][4] == 2 / 8


def test_odd_rows(spark, docs):
    rows, labels = corpus(300)
    odd = [(None, "w1 w2", None, None), (900, None, "en", "a"), (901, "", None, "a"), (902, "w1 w2 " * 60_000, "en", "a"), (903, "w1", "en", "a"), (903, "w1", "en", "a")]
    extra = docs(rows + odd).withColumns({"label": F.lit("x"), "score": F.lit(1), "a": F.lit(2)})
    out = q.scored(extra, q.fit(extra.drop("label"), spark.createDataFrame(labels + [(7, None), (None, 1)], LABELS)))
    assert out.count() == len(rows) + len(odd)
    assert len({r.score for r in out.filter("doc_id = 903").collect()}) == 1


def test_nothing_to_learn_and_empty_table(spark, docs):
    model = q.fit(docs([(1, "a")]), spark.createDataFrame([(1, 1)], LABELS))
    assert model is None
    assert [r.score for r in q.scored(docs([(1, "a"), (2, None)]), model).collect()] == [0.5, 0.5]
    assert q.scored(docs([]), model).count() == 0


def test_an_id_with_very_many_rows_is_one_row_of_the_fit(spark, docs, monkeypatch):
    """The fit collects at most one row per id and label, whatever the table repeats."""
    seen = []
    real = q.cotrain
    monkeypatch.setattr(q, "cotrain", lambda views, y, pool, **k: seen.append((len(y), len(pool[0]))) or real(views, y, pool, **k))
    rows = [(i, ("good words here " if i % 2 else "spam ! ") * (5 + i % 7), "en", "s") for i in range(300)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id bigint, label int")
    hot = [(5, f"other text {j}", "en", "s") for j in range(4000)] + [(250, "pool text", "en", "s")] * 3000
    model = q.fit(q.prepared(docs(rows + hot)), labels)
    assert model is not None and seen and seen[0][0] <= 200 and seen[0][1] <= 100


def plain_text(text):
    data = (text or "").encode()
    if not data:
        return [0.0] * q.TEXT_FEATURES
    words = re.findall(rb"[^\x20\x09-\x0d]+", data)
    n, triples = len(words), list(zip(words, words[1:], words[2:]))
    out = [math.log1p(n), len(data) / max(n, 1), sum(a == b for a, b in zip(words, words[1:])) / max(n, 1)]
    out += [len(set(words)) / math.sqrt(n), max(Counter(words).values()) / n, len(set(triples)) / len(triples) if triples else 1.0] if n else [0.0] * 3
    marks = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".", ",", "!?", "|", "#$%&*@^~<>{}[]\\_+=", "\n"]
    return out + [math.sqrt(sum(data.count(c.encode()) for c in kind) / len(data)) for kind in marks]


def plain_metadata(source, lang, n_chars):
    out = [0.0] * (q.METADATA_CELLS + 1)
    for kind, value in ((0, source), (1, lang)):
        out[zlib.crc32(f"{kind}:{value!r}".encode()) % q.METADATA_CELLS] += 1
    out[-1] = math.log1p(max(0, n_chars or 0))
    return out


class PlainLogistic:
    """The least penalized loss, row by row."""

    def __init__(self, rows, y):
        columns = list(zip(*rows))
        self.mean = [sum(c) / len(c) for c in columns]
        self.scale = [math.sqrt(sum((v - m) ** 2 for v in c) / len(c)) or 1.0 for c, m in zip(columns, self.mean)]
        z, pull = [self.row(r) for r in rows], np.array([1e-6] + [1.0] * len(columns))
        self.b = np.zeros(len(pull))
        for _ in range(40):
            slope, curve = -pull * self.b, np.diag(pull)
            for x, label in zip(z, y):
                p = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(x @ self.b)))))
                slope = slope + x * (label - p)
                curve = curve + np.outer(x, x) * (p * (1 - p))
            move = np.linalg.solve(curve, slope)
            self.b = self.b + move
            if max(abs(move)) < 1e-8:
                break

    def row(self, r):
        return np.array([1.0] + [max(-8.0, min(8.0, (v - m) / s)) for v, m, s in zip(r, self.mean, self.scale)])

    def odds(self, r):
        return max(-30.0, min(30.0, float(self.row(r) @ self.b)))

    def sure(self, r):
        return 1 / (1 + math.exp(-self.odds(r)))


def plain_scores(rows, labels):
    """Co-training as the module text tells it, document by document."""
    views = {i: (plain_text(text), plain_metadata(source, lang, n)) for i, text, lang, source, n in rows}
    known = sorted(labels)
    aside = [i for i in known if zlib.crc32(f"aside {i}".encode()) % 10 == 0]
    taught, pool = [i for i in known if i not in aside], sorted(set(views) - set(known))
    ones = sum(labels[i] for i in taught) / len(taught)
    given = [{}, {}]
    for turn in range(q.ROUNDS + 1):
        models = [PlainLogistic([views[i][v] for i in [*taught, *given[v]]], [labels[i] for i in taught] + list(given[v].values())) for v in (0, 1)]
        answers = []
        for v in (0, 1):
            p, most = {i: models[v].sure(views[i][v]) for i in pool}, len(pool) * (turn + 1) // (2 * q.ROUNDS)
            best, worst = sorted(pool, key=lambda i: -p[i]), sorted(pool, key=lambda i: p[i])
            answer = {i: 1 for i in best[: round(most * ones)] if p[i] >= q.CONFIDENT}
            answers.append(answer | {i: 0 for i in worst[: round(most * (1 - ones))] if p[i] <= 1 - q.CONFIDENT})
        given = answers[::-1]
    odds = {i: [models[v].odds(x[v]) for v in (0, 1)] for i, x in views.items()}
    calibrated = [PlainLogistic([[odds[i][v]] for i in aside], [labels[i] for i in aside]) for v in (0, 1)]
    steps = {i: [calibrated[v].odds([o[v]]) for v in (0, 1)] for i, o in odds.items()}
    both = PlainLogistic([steps[i] for i in aside], [labels[i] for i in aside])
    return {i: (*(1 / (1 + math.exp(-o)) for o in steps[i]), both.sure(steps[i])) for i in views}


def test_all_scores_are_those_of_a_plain_cotraining_loop(spark):
    rows, labels = corpus(420)
    r = random.Random(8)
    rows = [(*row, len(row[1]) + r.randrange(10**6)) for row in rows]  # stated lengths, no two alike
    rows += [(1000, None, None, None, None), (1001, "", "en", "a", -3), (1002, " \n\t", "de", "z", 7), (1003, "É É ß, A|B\n#1 9.", "fr", "q", 11)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    found = q.scored(docs, q.fit(q.prepared(docs), spark.createDataFrame(labels, LABELS))).collect()
    want = plain_scores(rows, dict(labels))
    assert len(found) == len(rows)
    for f in found:
        assert np.allclose((f.text_score, f.metadata_score, f.score), want[f.doc_id], atol=1e-6), f

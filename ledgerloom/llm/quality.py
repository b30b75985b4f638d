"""Document quality by co-training: a classifier of text content and one of page metadata teach each other.

Both views start from the same labelled sample. In each of ROUNDS rounds, each classifier labels the unlabelled pool, and
its most confident answers (at least CONFIDENT sure, the same part of both labels as in the sample) are given to the
other one as if they were labels. At the end each view is calibrated on labelled documents that neither was fitted on, a
last logistic function combines the calibrated views, and all documents are scored with it.

Text view: sizes, shares of repeated and distinct words and word triples, of capitals, digits, marks and line ends in the
whole text. Metadata view: source and language (hashed to METADATA_CELLS columns) and the stated length. Labels and ids are
inputs of neither. The fit uses a bounded sample (SAMPLE_DOCS labelled per label and POOL_DOCS unlabelled, chosen by a hash
of the id, one row for each id and label; a tenth of the labelled ones calibrates), and the classifiers are trained on the driver on its small feature
rows. Scoring reads every whole text once.

Null or empty texts have a feature row of zeros, null metadata a value of its own. Without labels of both kinds all scores
are 0.5. Repeated rows get equal scores. An empty table gives an empty result; other columns are not read."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import text as tx
from ledgerloom.llm.store import durable, held_out

SAMPLE_DOCS, POOL_DOCS, ROUNDS, CONFIDENT, METADATA_CELLS = 4_000, 8_000, 4, 0.95, 64
_MARKS = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "stop": b".", "pause": b",", "shout": b"!?", "table": b"|", "symbol": b"#$%&*@^~<>{}[]\\_+=", "line": b"\n"}
_CLASS = np.zeros((len(_MARKS), 256), bool)
for _i, _bytes in enumerate(_MARKS.values()):
    _CLASS[_i, list(_bytes)] = True
TEXT_FEATURES = 6 + len(_MARKS)


def text_features(column: pa.Array) -> np.ndarray:
    data, places = tx.text_bytes(column)
    w = tx.words(column)
    h = tx.hashes(w)
    n_bytes, n_words = np.diff(places), np.diff(w.first)
    out = np.zeros((len(n_bytes), TEXT_FEATURES))
    some, size = np.maximum(n_words, 1), np.maximum(n_bytes, 1)
    out[:, 0], out[:, 1] = np.log1p(n_words), n_bytes / some
    if len(h):
        twice = np.zeros(len(h) + 1, np.int64)
        np.cumsum(np.concatenate([[False], h[1:] == h[:-1]]), out=twice[1:])
        out[:, 2] = (twice[w.first[1:]] - twice[np.minimum(w.first[:-1] + 1, w.first[1:])]) / some
        rolled = tx.mix(tx.mix(h[:-2] * np.uint64(3) + h[1:-1]) * np.uint64(5) + h[2:]) if len(h) > 2 else h[:0]
        for i, (a, b) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist())):
            if b > a:
                _, counts = np.unique(h[a:b], return_counts=True)
                out[i, 3], out[i, 4] = len(counts) / np.sqrt(b - a), counts.max() / (b - a)
                out[i, 5] = len(np.unique(rolled[a : b - 2])) / (b - a - 2) if b - a > 2 else 1.0
    for j in range(len(_MARKS)):
        upto = np.zeros(len(data) + 1, np.int64)
        np.cumsum(_CLASS[j][data], out=upto[1:])
        out[:, 6 + j] = np.sqrt((upto[places[1:]] - upto[places[:-1]]) / size)
    out[n_bytes == 0] = 0
    return out


def metadata_features(sources: list, langs: list, lengths: list) -> np.ndarray:
    out = np.zeros((len(sources), METADATA_CELLS + 1))
    cells: dict = {}
    for i, pair in enumerate(zip(sources, langs)):
        for kind, value in enumerate(pair):
            key = (kind, value)
            if key not in cells:
                cells[key] = zlib.crc32(f"{kind}:{value!r}".encode()) % METADATA_CELLS
            out[i, cells[key]] += 1
    out[:, -1] = np.log1p([max(0, x or 0) for x in lengths])
    return out


class Logistic:
    """Logistic regression on standardized features, by Newton's method."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0):
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0)
        self.scale[self.scale == 0] = 1
        z = self._rows(x)
        self.b = np.zeros(z.shape[1])
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(z @ self.b, -30, 30)))
            pull = ridge * np.concatenate([[1e-6], np.ones(len(self.b) - 1)])
            move = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(pull), z.T @ (y - p) - pull * self.b)
            self.b += move
            if np.abs(move).max() < 1e-8:
                break

    def _rows(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([np.ones((len(x), 1)), np.clip((x - self.mean) / self.scale, -8, 8)], 1)

    def odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self._rows(x) @ self.b, -30, 30)

    def sure(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.odds(x)))


def cotrain(views: tuple[np.ndarray, np.ndarray], y: np.ndarray, pool: tuple[np.ndarray, np.ndarray], rounds: int = ROUNDS) -> list[Logistic]:
    """One classifier per view after the exchange of confident labels."""
    given: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, int), np.zeros(0, int))] * 2
    ones = y.mean()
    models = [Logistic(v, y) for v in views]
    for turn in range(rounds):
        answers = []
        for m, rows in zip(models, pool):
            p = m.sure(rows)
            most = len(p) * (turn + 1) // (2 * rounds)
            one, zero = np.argsort(-p, kind="stable")[: round(most * ones)], np.argsort(p, kind="stable")[: round(most * (1 - ones))]
            one, zero = one[p[one] >= CONFIDENT], zero[p[zero] <= 1 - CONFIDENT]
            answers.append((np.concatenate([one, zero]), np.concatenate([np.ones(len(one), int), np.zeros(len(zero), int)])))
        given = answers[::-1]
        models = [Logistic(np.concatenate([v, rows[i]]), np.concatenate([y, a])) for v, rows, (i, a) in zip(views, pool, given)]
    return models


class Model:
    """Two co-trained views, their calibration, and the function that combines them."""

    def __init__(self, views: tuple[np.ndarray, np.ndarray], y: np.ndarray, pool: tuple[np.ndarray, np.ndarray], aside: np.ndarray):
        self.views = cotrain(tuple(v[~aside] for v in views), y[~aside], pool)
        odds = [m.odds(v)[:, None] for m, v in zip(self.views, views)]
        self.calibrated = [Logistic(o[aside], y[aside]) for o in odds]
        self.both = Logistic(np.concatenate([c.odds(o[aside])[:, None] for c, o in zip(self.calibrated, odds)], 1), y[aside])

    def scores(self, views: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        odds = [c.odds(m.odds(v)[:, None]) for c, m, v in zip(self.calibrated, self.views, views)]
        return (*(1 / (1 + np.exp(-o)) for o in odds), self.both.sure(np.stack(odds, 1)))


def _views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return text_features(batch.column("text")), metadata_features(*(batch.column(c).to_pylist() for c in ("source", "lang", "n_chars")))


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Model from documents and labels (doc_id, label), 0 or 1; None if one of them is missing."""
    rows = labels.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("label").cast("int").alias("label")).distinct()
    sizes = durable(rows.groupBy("label").agg(F.count("*").alias("n")))
    mark = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("quality sample")), F.lit(1 << 40))
    chosen = rows.join(sizes, "label").filter(mark * F.col("n") < F.lit(SAMPLE_DOCS * float(1 << 40))).select("doc_id", "label")
    pool = docs.filter(F.col("doc_id").isNotNull()).select("doc_id")
    pool = pool.filter(mark < F.lit(int((1 << 40) * min(1.0, POOL_DOCS / max(1, pool.count())))))
    # a labelled document is in the sample and not in the pool; both are bounded, so their ids are few
    picked = durable(pool.join(rows, "doc_id", "left_anti").distinct().select("doc_id", F.lit(None).cast("int").alias("label")).unionByName(chosen))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for part in tx.slices(batch, "text"):
                    views = [pa.array(list(v), pa.list_(pa.float64())) for v in _views(part)]
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), *views], ["doc_id", "label", "a", "b"])

    # one row per id and label, however many rows an id has: that with the least hash of its columns
    columns = ["text", "source", "lang", "n_chars"]
    once = docs.join(picked, "doc_id").groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64(*columns).alias("h"), *columns)).alias("r"))
    found = once.select("doc_id", "label", *[f"r.{c}" for c in columns]).mapInArrow(run, "doc_id bigint, label int, a array<double>, b array<double>").collect()
    found.sort(key=lambda r: (r["doc_id"], r["label"] or 0))
    known = [r for r in found if r["label"] is not None]
    y = np.array([r["label"] for r in known], int)
    aside = np.array([zlib.crc32(f"aside {r['doc_id']}".encode()) % 10 == 0 for r in known], bool)
    if any(len(set(y[m].tolist())) < 2 for m in (aside, ~aside)):
        return None
    rest = [r for r in found if r["label"] is None]
    stack = lambda rows, c, width: np.array([r[c] for r in rows], float).reshape(len(rows), width)
    widths = {"a": TEXT_FEATURES, "b": METADATA_CELLS + 1}
    return Model(tuple(stack(known, c, w) for c, w in widths.items()), y, tuple(stack(rest, c, w) for c, w in widths.items()), aside)


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, text_score, metadata_score, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for part in tx.slices(batch, "text"):
                    m = shared.value
                    s = m.scores(_views(part)) if m is not None else [np.full(part.num_rows, 0.5)] * 3
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), *map(pa.array, s)], ["doc_id", "text_score", "metadata_score", "score"])

    return prepared(docs).mapInArrow(run, "doc_id bigint, text_score double, metadata_score double, score double")


def prepared(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("bigint").alias("n_chars")
    )


def op4_quality(spark, sf_dir: str) -> DataFrame:
    docs = prepared(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    out = held_out("doc_id", 5, 0)
    result = scored(docs, fit(docs, labels.filter(~out)))
    return result.select("doc_id", out.alias("held_out"), "text_score", "metadata_score", "score", (F.col("score") >= 0.5).alias("kept"))


QUERIES = {"op4_quality": op4_quality}
ORACLE_SQL: dict[str, str] = {}

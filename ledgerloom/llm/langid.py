"""Language identification by words, falling back to character n-grams.

The model holds, per language, the log frequency of the words met in labelled texts and of the character n-grams of those
words. A word of a text that any language knows is scored by its word frequencies. An unknown word is scored by the mean
over its n-grams of the longest length at which any of them is known, starting at 5 letters and getting shorter down to
1. A language that does not know a word or n-gram gets a penalty a little under its rarest entry. A text's score per
language is the mean over its words; the score returned is the part of the best language in the sum of exp(at most 40 words'
worth of that mean) over all languages, from 0 to 1.

Words are maximal runs of letters (Unicode category L, so neither digits nor fractions, superscripts or Roman numerals),
lower-cased. A text that is null, empty or without letters gets ``und`` and 0, as does
every text if nothing could be learned. Ties go to the language that is first by code point. The model is fitted on a
bounded sample of labelled rows (SAMPLE_DOCS per language, chosen by a hash of the id) and keeps, of each language, the QUOTA
most frequent words and as many n-grams of each length, so that a language has its entries whatever the others have; it is
then applied to all whole texts. Only text and label are read."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ledgerloom.llm import text as tx
from ledgerloom.llm.store import durable, held_out

#: Bounds of the fit: documents per language, and entries of a language's words and of its n-grams of one length.
SAMPLE_DOCS, QUOTA = 2_000, 2_500
LONGEST, PENALTY, FULL_WORDS = 5, 1.0, 40
UNKNOWN = "und"
_LETTERS = regex.compile(r"\p{L}+")
_MEMO_WORDS = 200_000


def _grams(word: str, n: int) -> list[str]:
    padded = f" {word} "
    return [padded[i : i + n] for i in range(len(padded) - n + 1)] if n > 1 else list(word)


def fit(labelled: DataFrame, docs_per_language: int = SAMPLE_DOCS, quota: int = QUOTA) -> dict[str, dict[str, tuple]]:
    """Model from (doc_id, text, lang): {"languages": names, "w": {word: scores}, "1".."5": {n-gram: scores}}.

    Counting runs in Spark; what comes to the driver is the table of each language's most frequent entries."""
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = durable(rows.groupBy("lang").agg(F.count("*").alias("n")))  # stored: Spark knows that it is small
    mark = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("language sample")), F.lit(1 << 40))
    sample = rows.join(sizes, "lang").filter(mark * F.col("n") < F.lit(docs_per_language * float(1 << 40)))
    found = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))
    counts = sample.select("lang", F.explode(found).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))

    def entries_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[tuple, int] = {}
            for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n"))):
                out[lang, "w", word] = out.get((lang, "w", word), 0) + n
                for k in range(1, LONGEST + 1):
                    for g in _grams(word, k):
                        out[lang, str(k), g] = out.get((lang, str(k), g), 0) + n
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in out], pa.string()), pa.array([k[1] for k in out], pa.string()), pa.array([k[2] for k in out], pa.string()), pa.array(list(out.values()), pa.int64())],
                ["lang", "kind", "entry", "n"],
            )

    table = counts.mapInArrow(entries_of, "lang string, kind string, entry string, n bigint").groupBy("lang", "kind", "entry").agg(F.sum("n").alias("n"))
    table = durable(table.filter("n > 1 or kind <> 'w'"))
    totals = {(r["lang"], r["kind"]): r["n"] for r in table.groupBy("lang", "kind").agg(F.sum("n").alias("n")).collect()}
    rank = F.row_number().over(W.partitionBy("lang", "kind").orderBy(F.col("n").desc(), "entry"))
    kept = table.withColumn("rank", rank).filter(F.col("rank") <= quota).drop("rank").toArrow().to_pydict()
    languages = sorted({lang for lang, _ in totals})
    place = {lang: i for i, lang in enumerate(languages)}
    model: dict = {"languages": languages, "w": {}, **{str(k): {} for k in range(1, LONGEST + 1)}}
    rarest: dict[tuple, float] = {}
    for lang, kind, entry, n in zip(*(kept[c] for c in ("lang", "kind", "entry", "n"))):
        score = math.log(n / totals[lang, kind])
        model[kind].setdefault(entry, {})[place[lang]] = score
        rarest[lang, kind] = min(score, rarest.get((lang, kind), 0.0))
    for kind in ("w", *map(str, range(1, LONGEST + 1))):
        miss = [rarest.get((lang, kind), -math.log(1 + quota)) - PENALTY for lang in languages]
        # one miss value for all languages: a small language's rarest entry is no evidence for it
        miss = [min(miss, default=0.0)] * len(languages)
        model[kind] = {e: tuple(s.get(i, miss[i]) for i in range(len(languages))) for e, s in model[kind].items()}
    return model


class Scorer:
    """Scores of words and texts under a model; remembers the words it has met, up to a bound."""

    @classmethod
    def of(cls, name: str, shared) -> Scorer:
        """The worker's scorer for a shared model; tasks of one job follow each other in one worker."""
        return tx.kept(("scorer", name), lambda: cls(shared.value))

    def __init__(self, model: dict):
        self.model, self.languages = model, model["languages"]
        self.kinds = [model[str(k)] for k in range(LONGEST, 0, -1)]
        self.seen = tx.Numbers(_MEMO_WORDS)
        self.table = np.zeros((1 << 12, len(self.languages) + 1))

    def word(self, token: str) -> np.ndarray:
        """Sums over the letter runs of one white-space token, and their number."""
        out = np.zeros(len(self.languages) + 1)
        for word in _LETTERS.findall(token.lower()):
            out[:-1] += self.run(word)
            out[-1] += 1
        return out

    def run(self, word: str):
        known = self.model["w"].get(word)
        if known is not None:
            return known
        for n, table in zip(range(LONGEST, 0, -1), self.kinds):
            found = [s for g in _grams(word, n) if (s := table.get(g)) is not None]
            if found:
                return found[0] if len(found) == 1 else [sum(x) / len(found) for x in zip(*found)]
        return [0.0] * len(self.languages)

    def texts(self, column: pa.Array) -> np.ndarray:
        """Per row: the sums over its words per language, and the number of words."""
        w = tx.words(column)
        sums = np.zeros((len(w.first) - 1, len(self.languages) + 1))
        if not len(w.starts):
            return sums
        distinct, where, back = np.unique(tx.hashes(w), return_index=True, return_inverse=True)
        if self.seen.full(distinct):
            self.seen = tx.Numbers(_MEMO_WORDS)
        known, new = self.seen.of(distinct)
        if len(new):
            self.table = tx.room(self.table, int(known[new[-1]]) + 1)
            raw, s, e = w.data.tobytes(), w.starts[where[new]].tolist(), w.ends[where[new]].tolist()
            for k, a, b in zip(known[new].tolist(), s, e):
                self.table[k] = self.word(raw[a:b].decode("utf-8", "replace"))
        place, running = known[back], np.zeros(len(back) + 1)
        for j in range(self.table.shape[1]):
            np.cumsum(self.table[place, j], out=running[1:])
            sums[:, j] = running[w.first[1:]] - running[w.first[:-1]]
        return sums


def decide(sums: np.ndarray, languages: list[str]) -> tuple[list[str], np.ndarray]:
    n = np.round(sums[:, -1])
    if not languages:
        return [UNKNOWN] * len(sums), np.zeros(len(sums))
    mean = sums[:, :-1] / np.maximum(n, 1)[:, None]
    # round: sums taken in another order must not decide ties
    best = np.round(mean, 9).argmax(axis=1)
    weight = np.exp((mean - mean.max(axis=1, keepdims=True)) * np.minimum(n, FULL_WORDS)[:, None])
    score = weight[np.arange(len(best)), best] / weight.sum(axis=1)
    return [languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), n.tolist())], np.where(n > 0, score, 0.0)


def predicted(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with lang_pred and score appended (they replace columns of these names)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most 6 * QUOTA entries per language
    name = uuid.uuid4().hex
    keep = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer.of(name, shared)
        for batch in batches:
            for part in tx.slices(batch, "text"):
                names, scores = decide(scorer.texts(part.column("text")), scorer.languages)
                columns = [*part.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "lang_pred", "score"])

    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")
    return docs.select(*keep).mapInArrow(run, schema)


def op1_language(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = held_out("doc_id", 4, 2)
    model = fit(docs.filter(~out).select("doc_id", "text", "lang"))
    scored = predicted(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", out.alias("held_out"), "lang_pred", "score")


def recognized(docs: DataFrame, min_score: float = 0.4) -> DataFrame:
    """The documents whose language is recognized with at least ``min_score``; columns stay as they are.

    The model is fitted on the labelled documents of the input itself."""
    model = fit(docs.select("doc_id", "text", "lang"))
    # columns by place, so that no name of the table can clash and no text is sent twice
    flat = docs.toDF(*["text" if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)])
    kept = predicted(flat, model).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score))
    return kept.drop("lang_pred", "score").toDF(*docs.columns)


QUERIES = {"op1_language": op1_language}
ORACLE_SQL: dict[str, str] = {}

"""Benchmark decontamination: every training passage queries a BM25 index of the test items by block-max WAND.

Items are cut into segments of SEGMENT words; a rest of fewer than TAIL words stays with the segment before. A document is a
sequence of overlapping passages, each at least as long as two segments less a word, so that a segment's words stand
together in one of them. A passage retrieves all
segments whose BM25 score reaches THRESHOLD of the segment's own score (the score of its own text). A retrieved segment is a
leak if word triples of the passage cover OVERLAP of the question's and OVERLAP of the answer's triples, or WHOLE of
all; the answer is a segment's last sentence or line, the rest is the question. A part of one or two words is covered if
the passage has just this word or pair, at most as many words as the segment has from a word triple (word, pair) that the
passage has in common with the other part. An item of one or two words is a leak wherever the passage has them.

Posting lists are in the order of segments and in blocks of BLOCK, with the largest impact of each list and block. First a
bound over a batch of passages: per passage and segment, the sum of the impacts of rarer terms, plus the largest sum of
all frequent terms in the segment's block. Passages that reach the threshold nowhere are done; the others go through WAND
one by one: the lists' maxima give a pivot, the blocks' maxima decide whether it is scored or skipped.

Words are lower-cased (A-Z) and stripped of ASCII punctuation at their edges. Segments and their statistics (number, mean and
greatest length, document frequency of each word) are made in Spark over all items, equal segments once. Segments are then
indexed in shards of at most about SHARD_BYTES, each broadcast with the frequencies of its own words and matched in a pass
of its own; a large benchmark needs more passes, and its scores and passages are the same for any number of shards. Which
items have a segment is joined to what was found.

Null or empty texts and items without words match nothing; rows with a null id are searched and returned with a null id.
Repeated rows are each searched; repeated items are each found. Empty tables give an empty result. Other columns are not
read."""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import text as tx
from ledgerloom.llm.store import durable

THRESHOLD, OVERLAP, WHOLE = 0.5, 0.5, 0.7
SEGMENT, TAIL, BLOCK, SHARD_BYTES = 256, 8, 16, 8 << 20
K1, B = 1.2, 0.75
#: A term in at most this part of the segments (or in one) is a rarer one.
RARE = 0.3
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_MEMO_WORDS = 200_000


def terms_of(text: str | None) -> list[bytes]:
    return [t for w in (text or "").encode().lower().split() if (t := w.strip(_PUNCTUATION))]


def _triples(ids: list[int]) -> set[tuple]:
    return {tuple(ids[i : i + 3]) for i in range(len(ids) - 2)} if len(ids) > 2 else ({tuple(ids)} if ids else set())


def _places(part: set[tuple], ids: list[int]) -> list[int]:
    """Where the word groups of a part, all of one length, stand."""
    n = len(next(iter(part)))
    return [i for i in range(len(ids) - n + 1) if tuple(ids[i : i + n]) in part]


def covered(parts: tuple[set, set, set], ids: list[int], triples: set[tuple]) -> list[float]:
    """The shares of a segment's question, answer and whole in a passage of these words and triples."""
    shares, reach = [], len(parts[2]) + 2
    for part, other in zip(parts, (parts[1], parts[0], set())):
        if not part or len(next(iter(part))) > 2:
            shares.append(len(part & triples) / len(part) if part else 1.0)
            continue
        found = _places(part, ids)
        if found and other:
            beside = _places(other, ids)
            found = [i for i in found if any(abs(i - j) <= reach for j in beside)]
        shares.append(float(bool(found)))
    return shares


def question_and_answer(text: str) -> tuple[str, str]:
    """An item's answer is what follows its last line or sentence end; a text of one sentence is a question only."""
    body = text.rstrip()
    cut = max((m.end() for m in re.finditer(r"[\n.!?]\s*(?=\S)", body)), default=len(body))
    return body[:cut], body[cut:]


def segments_of(text: str | None) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """The segments of an item: the words of its question and of its answer that fall into each."""
    question, answer = map(terms_of, question_and_answer(text or ""))
    n, words = len(question), question + answer
    for at in range(0, max(len(words) - TAIL + 1, min(1, len(words))), SEGMENT):
        end = at + SEGMENT if len(words) - at - SEGMENT >= TAIL else len(words)
        yield words[at : min(end, n)], words[max(at, n) : end]


@dataclass
class Statistics:
    """Of all segments: number, mean and greatest number of words, and in how many segments a word is (for the words that a
    shard has)."""

    n: int
    mean: float
    longest: int
    df: dict[bytes, int]

    @classmethod
    def of(cls, segments: list[tuple[list[bytes], list[bytes]]]) -> Statistics:
        lengths = [len(q) + len(a) for q, a in segments]
        return cls(len(segments), sum(lengths) / max(1, len(segments)), max(lengths, default=1), Counter(t for q, a in segments for t in {*q, *a}))


class Index:
    """BM25 index of a shard's segments, with impacts as parts of each segment's own score; ``items`` are names of segments."""

    @classmethod
    def of(cls, name: str, shared) -> Index:
        return tx.kept(("index", name), lambda: cls(*shared.value))

    @classmethod
    def alone(cls, items: list[tuple[int, str]]) -> Index:
        """An index of items that are the whole benchmark."""
        named = [(i, s) for i, text in items for s in segments_of(text)]
        return cls([i for i, _ in named], [s for _, s in named], Statistics.of([s for _, s in named]))

    def __init__(self, items: list, segments: list[tuple[list[bytes], list[bytes]]], known: Statistics):
        self.terms: dict[bytes, int] = {}
        self.items, self.parts, bags = items, [], []
        for question, answer in segments:
            q, a = ([self.terms.setdefault(t, len(self.terms)) for t in words] for words in (question, answer))
            self.parts.append((_triples(q), _triples(a), _triples(q + a)))
            bags.append(Counter(q + a))
        n, self.longest, lengths = len(bags), known.longest, [sum(b.values()) for b in bags]
        df = [known.df[t] for t in self.terms]
        idf = [math.log(1 + (known.n - c + 0.5) / (c + 0.5)) for c in df]
        lists: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        for s, bag in enumerate(bags):
            impact = {t: idf[t] * f * (K1 + 1) / (f + K1 * (1 - B + B * lengths[s] / known.mean)) for t, f in sorted(bag.items())}
            own = math.fsum(impact.values())
            for t, x in impact.items():
                lists[t].append((s, x / own))
        self.at = np.cumsum([0, *map(len, lists)])
        self.segments = np.array([s for p in lists for s, _ in p], np.int64)
        self.impacts = np.array([x for p in lists for _, x in p])
        self.most = np.array([max(x for _, x in p) for p in lists])
        # per list: the last segment and the largest impact of each block
        self.blocks = [[(p[min(i + BLOCK, len(p)) - 1][0], max(x for _, x in p[i : i + BLOCK])) for i in range(0, len(p), BLOCK)] for p in lists]
        self.rare = np.array([c <= max(1, RARE * known.n) for c in df], bool)
        frequent = np.zeros(n + BLOCK)
        for t in np.flatnonzero(~self.rare):
            frequent[self.segments[self.at[t] : self.at[t + 1]]] += self.impacts[self.at[t] : self.at[t + 1]]
        self.frequent = np.repeat(frequent[: n + BLOCK - 1 - (n - 1) % BLOCK if n else 0].reshape(-1, BLOCK).max(axis=1), BLOCK) if n else frequent
        self.seen, self.term_of = tx.Numbers(_MEMO_WORDS), np.zeros(1 << 12, np.int64)

    def search(self, terms: list[int]) -> list[tuple[int, float]]:
        """All segments whose score for these distinct terms reaches the threshold, by block-max WAND."""
        found = []
        cursors = [[int(self.segments[self.at[t]]), t, 0] for t in terms]  # next segment, term, place in its list
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, None
            for i, (_, t, _) in enumerate(cursors):
                bound += self.most[t]
                if bound >= THRESHOLD - 1e-9:
                    pivot = i
                    break
            if pivot is None:
                return found
            segment = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == segment:
                pivot += 1
            near, limit, until = cursors[: pivot + 1], 0.0, None
            for _, t, place in near:
                last, most = self._block(t, place, segment)
                limit += most
                until = last if until is None else min(until, last)
            if limit < THRESHOLD - 1e-9:
                # no segment up to the end of the nearest block, or before the next list's, can reach it
                to = until + 1
                if pivot + 1 < len(cursors):
                    to = min(to, cursors[pivot + 1][0])
                to = max(to, segment + 1)
            elif near[0][0] == segment:
                score = math.fsum(float(self.impacts[self.at[t] + place]) for _, t, place in near)
                if score >= THRESHOLD - 1e-9:
                    found.append((segment, score))
                to = segment + 1
            else:
                to = segment
            for c in near:
                if c[0] < to:
                    own = self.segments[self.at[c[1]] : self.at[c[1] + 1]]
                    c[2] = int(np.searchsorted(own, to))
                    c[0] = int(own[c[2]]) if c[2] < len(own) else -1
            cursors = [c for c in cursors if c[0] >= 0]
        return found

    def _block(self, t: int, place: int, segment: int) -> tuple[int, float]:
        blocks = self.blocks[t]
        i = place // BLOCK
        while i < len(blocks) and blocks[i][0] < segment:
            i += 1
        return blocks[i] if i < len(blocks) else (1 << 60, 0.0)

    def texts(self, column: pa.Array) -> Iterator[tuple[int, int, float, float, float]]:
        """(row, item id, score, question overlap, answer overlap) of the leaks in a column of texts."""
        w = tx.words(column, lower=True)
        if not len(w.starts) or not self.items:
            return
        distinct, where, back = np.unique(tx.hashes(w), return_index=True, return_inverse=True)
        if self.seen.full(distinct):
            self.seen = tx.Numbers(_MEMO_WORDS)
        known, new = self.seen.of(distinct)
        if len(new):
            self.term_of = tx.room(self.term_of, int(known[new[-1]]) + 1)
            raw, s, e = w.data.tobytes(), w.starts[where[new]].tolist(), w.ends[where[new]].tolist()
            # -2: only punctuation, no word; -1: not in the index
            self.term_of[known[new]] = [self.terms.get(t, -1) if (t := raw[a:b].strip(_PUNCTUATION)) else -2 for a, b in zip(s, e)]
        term = self.term_of[known[back]]
        row = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
        real = term != -2
        term, row = term[real], row[real]
        first = np.searchsorted(row, np.arange(len(w.first)))
        step = self.longest
        passages = np.maximum(1, -(-np.diff(first) // step) - 1)
        base = np.cumsum(passages) - passages
        inside = (np.arange(len(row)) - first[row]) // step
        hit = np.flatnonzero(term >= 0)
        # a word stands in the passage that begins at its step and in the one before
        pairs = []
        for back_by in (0, 1):
            k = inside[hit] - back_by
            ok = (k >= 0) & (k < passages[row[hit]])
            pairs.append((base[row[hit[ok]]] + k[ok]) * len(self.terms) + term[hit[ok]])
        pairs = np.unique(np.concatenate(pairs))
        passage, word = pairs // len(self.terms), pairs % len(self.terms)
        rare = self.rare[word]
        p, t = passage[rare], word[rare]
        n = self.at[t + 1] - self.at[t]
        ends = np.cumsum(n)
        place = np.repeat(self.at[t] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
        cell, part = np.unique(np.repeat(p, n) * len(self.items) + self.segments[place], return_inverse=True)
        mass = np.bincount(part, self.impacts[place], len(cell)) if len(cell) else np.zeros(0)
        near = np.unique(cell[mass + self.frequent[cell % len(self.items)] >= THRESHOLD - 1e-9] // len(self.items))
        if (self.frequent >= THRESHOLD).any():
            near = np.unique(passage)  # a segment of frequent terms alone can be found: no passage is left out
        seen = set()
        for q in near.tolist():
            a, b = np.searchsorted(passage, [q, q + 1])
            found = self.search(word[a:b].tolist())
            if not found:
                continue
            r = int(np.searchsorted(base, q, "right")) - 1
            start = int(first[r] + (q - base[r]) * step)
            ids = term[start : min(start + 2 * step, int(first[r + 1]))].tolist()
            triples = _triples(ids)
            for segment, score in found:
                question, answer, whole = covered(self.parts[segment], ids, triples)
                if ((question >= OVERLAP and answer >= OVERLAP) or whole >= WHOLE) and (r, segment) not in seen:
                    seen.add((r, segment))
                    yield r, self.items[segment], score, question, answer


@dataclass
class Benchmark:
    """A benchmark's segments (key, question, answer), which items have them (key, item_id), and their statistics (with
    the table ``df`` of words in place of a dictionary). All tables are stored."""

    segments: DataFrame
    members: DataFrame
    df: DataFrame
    n: int
    mean: float
    longest: int
    size: int

    @classmethod
    def of(cls, items: DataFrame) -> Benchmark:
        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out: dict[str, list] = {"item_id": [], "question": [], "answer": []}
                for item_id, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                    for q, a in segments_of(text):
                        out["item_id"].append(item_id)
                        out["question"].append(b" ".join(q).decode())
                        out["answer"].append(b" ".join(a).decode())
                yield pa.RecordBatch.from_arrays([pa.array(out["item_id"], pa.int64()), pa.array(out["question"], pa.string()), pa.array(out["answer"], pa.string())], list(out))

        rows = items.filter(F.col("text").isNotNull()).select(F.col("item_id").cast("bigint").alias("item_id"), "text")
        # no word holds a space, so the two parts and their border tell segments apart
        key = F.sha2(F.concat("question", F.lit("\n"), "answer").cast("binary"), 256)
        found = durable(rows.mapInArrow(cut, "item_id bigint, question string, answer string").withColumn("key", key))
        segments = durable(found.groupBy("key").agg(F.min("question").alias("question"), F.min("answer").alias("answer")))
        members = durable(found.select("key", "item_id").distinct())
        words = F.filter(F.concat(F.split("question", " "), F.split("answer", " ")), lambda w: w != "")
        df = durable(segments.select(F.explode(F.array_distinct(words)).alias("word")).groupBy("word").agg(F.count("*").alias("n")))
        sums = segments.agg(F.count("*"), F.avg(F.size(words)), F.max(F.size(words)), F.sum(F.octet_length("question") + F.octet_length("answer"))).first()
        return cls(segments, members, df, sums[0], sums[1] or 0.0, sums[2] or 1, sums[3] or 0)

    def shards(self, shard_bytes: int) -> Iterator[tuple[list[str], list, Statistics]]:
        """What an index is made of, for a bounded number of bytes of segments at a time."""
        n = -(-self.size // shard_bytes)
        for i in range(n):
            part = self.segments.filter(F.pmod(F.xxhash64("key"), F.lit(n)) == i)
            rows = sorted((r["key"], r["question"].encode().split(b" "), r["answer"].encode().split(b" ")) for r in part.collect())
            segments = [([w for w in q if w], [w for w in a if w]) for _, q, a in rows]
            words = part.select(F.explode(F.split(F.concat_ws(" ", "question", "answer"), " ")).alias("word")).distinct()
            df = {r["word"].encode(): r["n"] for r in self.df.join(words, "word").collect()}  # of the words in this shard
            yield [k for k, _, _ in rows], segments, Statistics(self.n, self.mean, self.longest, df)


def leaks(docs: DataFrame, items: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap) of every leak of an item in a document."""
    spark = docs.sparkSession
    schema = "doc_id bigint, key string, score double, question_overlap double, answer_overlap double"
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    bench, result = Benchmark.of(items), None
    for shard in bench.shards(shard_bytes):
        shared, name = spark.sparkContext.broadcast(shard), uuid.uuid4().hex  # about shard_bytes

        def run(batches: Iterator[pa.RecordBatch], shared=shared, name=name) -> Iterator[pa.RecordBatch]:
            index = Index.of(name, shared)
            for batch in batches:
                for part in tx.slices(batch, "text"):
                    found = list(index.texts(part.column("text")))
                    columns = list(zip(*found)) if found else [()] * 5
                    ids = part.column("doc_id").take(pa.array(columns[0], pa.int64()))
                    yield pa.RecordBatch.from_arrays([ids, pa.array(columns[1], pa.string()), *(pa.array(c, pa.float64()) for c in columns[2:])], ["doc_id", "key", "score", "question_overlap", "answer_overlap"])

        # a shard's pass is stored and its broadcast let go before the next shard is collected
        found = durable(rows.mapInArrow(run, schema))
        shared.destroy()
        result = found if result is None else result.unionByName(found)
    if result is None:
        result = spark.createDataFrame([], schema)
    best = [F.max(c).alias(c) for c in ("score", "question_overlap", "answer_overlap")]
    return result.join(bench.members, "key").groupBy("doc_id", "item_id").agg(*best)


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without a leak; columns stay as they are, and no row is moved."""
    # columns by place, so that no name of the table can clash
    kept = docs.toDF(*["text" if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)])
    schema = kept.schema
    for shard in Benchmark.of(items).shards(SHARD_BYTES):
        shared, name = docs.sparkSession.sparkContext.broadcast(shard), uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch], shared=shared, name=name) -> Iterator[pa.RecordBatch]:
            index = Index.of(name, shared)
            for batch in batches:
                for part in tx.slices(batch, "text"):
                    clean = np.ones(part.num_rows, bool)
                    clean[[r for r, *_ in index.texts(part.column("text"))]] = False
                    yield part.filter(pa.array(clean))

        kept = kept.mapInArrow(run, schema)
    return kept.toDF(*docs.columns)


def op6_decontamination(spark, sf_dir: str) -> DataFrame:
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {"op6_decontamination": op6_decontamination}
ORACLE_SQL: dict[str, str] = {}

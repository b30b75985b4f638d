"""Approximate nearest neighbours with randomly rotated one-bit codes.

A unit vector is taken relative to the centre of its cell, rotated by one random rotation, and stored as the signs of its
coordinates, packed into bits, with four numbers: its distance from the centre, the inner product of the code with the
rotated direction, and the inner products of code and offset with the centre. From the bits and these numbers the inner
product with a query is estimated, with an error of at most BOUND standard deviations (proportional to both distances
from the centre). A block of candidates reranks, on the original vectors in double precision, every candidate whose upper
bound reaches the k-th largest lower bound of the block; the k best of all blocks are the result. So only a candidate
outside its bound can be missed.

Every row is indexed, in blocks of BLOCK rows; queries come in blocks of QUERY_BLOCK and meet every block of candidates once.
Centres are fitted on a bounded sample (SAMPLE rows chosen by a hash). Work is divided by rows, so equal vectors or a
crowded cell load no task more than others. The blocks of queries are shuffled to LANES lanes of rows (or one for each
core, if those are more) and never broadcast: the driver holds the sample and counts, whatever the number of queries.

Vectors that are null, zero or hold null or non-finite components take no part, and neither do vectors of another length
than the most frequent one (the shortest of those equally frequent). A query id on several rows is asked once, with the
smallest of its vectors; candidates on several rows each take part. Null ids take no part. Ties go to the smaller id. An
empty table gives an empty result. Other columns are not read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from ledgerloom.llm.store import durable

BLOCK, QUERY_BLOCK, SAMPLE, CELLS, BOUND, LANES = 4096, 512, 8192, 32, 4.0, 64
_BLOCK_COLUMNS = ("ids", "vectors", "codes", "cells", "numbers")


def usable(rows: DataFrame) -> DataFrame:
    """(id, v) of the vectors that take part; v holds doubles."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = rows.filter(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0))
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.col("count").desc(), "n").first()
    return rows.filter(F.size("v") == (length["n"] if length else 0))


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


class Coder:
    """Rotation, centres and codes for vectors of one length."""

    def __init__(self, sample: np.ndarray, width: int, seed: int = 5):
        random = np.random.default_rng(seed)
        self.width, self.bits = width, max(64, -(-width // 64) * 64)
        self.rotation = np.linalg.qr(random.standard_normal((self.bits, self.bits)))[0][:width]
        unit = _unit(sample)
        centres = unit[random.permutation(len(unit))[:CELLS]]
        for _ in range(8):
            cell = (unit @ centres.T).argmax(axis=1)
            sums = np.zeros_like(centres)
            np.add.at(sums, cell, unit)
            count = np.bincount(cell, minlength=len(centres))[:, None]
            centres = np.where(count > 0, sums / np.maximum(count, 1), centres)
        self.centres = centres

    def encode(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Packed codes, cells, and per row: distance r, <code, direction>, <code, centre>, <offset, centre>."""
        unit = _unit(v)
        cell = (unit @ self.centres.T - 0.5 * (self.centres**2).sum(axis=1)).argmax(axis=1)
        centre = self.centres[cell]
        offset = unit - centre
        r = np.sqrt((offset * offset).sum(axis=1))
        turned = offset @ self.rotation
        bits = turned >= 0
        code = np.where(bits, 1.0, -1.0) / np.sqrt(self.bits)
        along = np.where(r > 0, (code * turned).sum(axis=1) / np.where(r > 0, r, 1), 1.0)
        numbers = np.stack([r, along, (code * (centre @ self.rotation)).sum(axis=1), (offset * centre).sum(axis=1)], 1)
        return np.packbits(bits, axis=1), cell.astype(np.int32), numbers

    def bounds(self, codes: np.ndarray, cell: np.ndarray, numbers: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated cosines of all rows with all queries (unit vectors), and the bounds of their errors."""
        r, along, code_centre, offset_centre = numbers.T[:, :, None]
        code = (np.unpackbits(codes, axis=1).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(self.bits))
        with_code = code @ (unit @ self.rotation).T.astype(np.float32)
        away = np.sqrt(((unit[None] - self.centres[:, None]) ** 2).sum(axis=2))[cell]
        estimate = (self.centres @ unit.T)[cell] + offset_centre + r * (with_code - code_centre) / along
        spread = np.sqrt(np.maximum(0, 1 - along**2)) / along / np.sqrt(self.bits - 1)
        return estimate, BOUND * r * away * spread + 1e-4


def cosines(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosines in double precision, each sum taken from the first component to the last. Vectors are first scaled by powers
    of two, which changes no digit and keeps squares in range."""
    rows, query = (np.ldexp(x, -np.frexp(np.abs(x).max(axis=-1, keepdims=True))[1]) for x in (rows, query))
    dot, one, two = rows[:, 0] * query[0], rows[:, 0] * rows[:, 0], query[0] * query[0]
    for d in range(1, len(query)):
        dot = dot + rows[:, d] * query[d]
        one = one + rows[:, d] * rows[:, d]
        two = two + query[d] * query[d]
    return dot / (np.sqrt(one) * np.sqrt(two))


def fit(rows: DataFrame) -> Coder | None:
    """A coder from at most about SAMPLE rows; None for an empty table."""
    n = rows.count()
    if not n:
        return None
    mark = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 40))
    sample = [r["v"] for r in rows.filter(mark < F.lit(int((1 << 40) * min(1.0, SAMPLE / n)))).limit(2 * SAMPLE).collect()] or [rows.first()["v"]]
    return Coder(np.array(sample, float), len(sample[0]))


def _blocks(rows: DataFrame, size: int, coder: Coder | None, kind: str) -> DataFrame:
    """One row per block of ``size`` vectors: ids, vectors (numbers of ``kind``) and, with a coder, their codes, as bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                v = _vectors(part.column("v"))
                out = [part.column("id").to_numpy().tobytes(), v.astype(kind).tobytes()]
                if coder is not None:
                    codes, cell, numbers = coder.encode(v)
                    out += [codes.tobytes(), cell.tobytes(), numbers.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in out], names)

    names = list(_BLOCK_COLUMNS if coder is not None else _BLOCK_COLUMNS[:2])
    packed = rows.mapInArrow(pack, ", ".join(f"{n} binary" for n in names))
    return durable(packed.withColumn("block", F.monotonically_increasing_id()))


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of all rows by cosine, for each row where ``is_query`` holds."""
    named = vectors.select(F.col(vec_id).cast("bigint").alias("id"), F.col(embedding).cast("array<double>").alias("v"), is_query.alias("q"))
    rows = usable(named)
    coder = fit(rows.select("id", "v"))
    if coder is None:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    # single precision holds what was given in it
    kind = "float32" if isinstance(vectors.schema[embedding].dataType.elementType, T.FloatType) else "float64"
    index = _blocks(rows.select("id", "v"), BLOCK, coder, kind)
    asked = _blocks(rows.filter("q").groupBy("id").agg(F.min("v").alias("v")), QUERY_BLOCK, None, kind)
    blocks = index.count()
    # an index block is in one lane and a block of queries in all: each pair meets once, in an ordinary equi-join
    lanes = max(1, min(blocks, max(LANES, vectors.sparkSession.sparkContext.defaultParallelism)))
    index = index.withColumn("lane", F.pmod(F.xxhash64("block"), F.lit(lanes)))
    asked = asked.select(
        F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(lanes - 1).cast("bigint"))).alias("lane")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda name, kind: np.frombuffer(batch.column(name)[row].as_buffer(), kind)
                ids, qids = get("ids", np.int64), get("q_ids", np.int64)
                v, q = get("vectors", kind).reshape(len(ids), -1).astype(float), get("q_vectors", kind).reshape(len(qids), -1).astype(float)
                codes, numbers = get("codes", np.uint8).reshape(len(ids), -1), get("numbers", float).reshape(len(ids), 4)
                estimate, error = coder.bounds(codes, get("cells", np.int32), numbers, _unit(q))
                own = ids[:, None] == qids[None, :]
                lower, upper = np.where(own, -np.inf, estimate - error), np.where(own, -np.inf, estimate + error)
                if len(ids) > k:
                    floor = np.partition(lower, len(ids) - k, axis=0)[len(ids) - k]
                else:
                    floor = np.full(len(qids), -np.inf)
                found = []
                unit, asked = _unit(v), _unit(q)
                for j in range(len(qids)):
                    again = np.flatnonzero((upper[:, j] >= floor[j]) & ~own[:, j])
                    if len(again) > k:
                        # the product decides all but what lies within its rounding of the k-th; ties stay together
                        near = unit[again] @ asked[j]
                        again = again[near >= np.partition(near, len(near) - k)[len(near) - k] - 1e-9]
                    score = cosines(v[again], q[j])
                    best = np.lexsort((ids[again], -score))[:k]
                    found += [(int(qids[j]), int(ids[again[b]]), float(score[b])) for b in best]
                columns = list(zip(*found)) if found else [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())], ["query_id", "vec_id", "score"])

    # Spark takes the queries for as small as they are before they are in all lanes and would broadcast them
    found = asked.hint("merge").join(index, "lane").mapInArrow(search, "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_nearest(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


NEAREST_SQL = """
WITH e AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), n AS (
  SELECT vec_id, v, sqrt(list_reduce(list_transform(v, lambda x: x * x), lambda x, y: x + y)) AS len FROM e
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(list_zip(c.v, q.v), lambda z: z[1] * z[2]), lambda x, y: x + y) / (c.len * q.len) AS score
  FROM n q JOIN n c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

QUERIES = {"op7_nearest": op7_nearest}
ORACLE_SQL = {"op7_nearest": NEAREST_SQL}

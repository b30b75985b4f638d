"""Whitening by the leading components of a covariance, found by contour integration.

Entries become whole numbers, x = floor(256 * c). The fit list is each distinct x once; its covariance V (divisor n, rows
centred before they are multiplied) is summed in Spark: every task adds up its rows, and sums per pair of dimensions are
grouped. What comes to the driver is one number per pair of dimensions, never rows.

The leading COMPONENTS eigenpairs of V are found in intervals of the line:

1. Inertia counts (signs of the pivots of V - a) tell how many eigenvalues lie above a. A bisection looks for a cut below
   the wanted ones with a few more above it at most; what is above is divided into intervals of at most PER_INTERVAL.
2. Per interval, the spectral projector onto it is a contour integral of (z - V)^-1. Gauss-Legendre nodes on the half
   circle through the interval's ends give shifted complex systems that do not depend on each other; each (interval, node)
   is a row of a Spark job that solves its system for the interval's block of vectors.
3. The weighted sum of the solutions spans the interval's eigenspace; Rayleigh-Ritz on it gives Ritz pairs. Steps 2 and 3
   repeat with the new vectors until the pairs inside stand still to rounding.
4. The number of Ritz pairs inside must be the inertia count of the interval, otherwise the block gets larger and the
   interval is done again; so none is missed.

Rows whose vector is null or holds a null or non-finite entry take no part, neither do empty vectors nor vectors of another
length than the most frequent one (the shortest of those equally frequent). Components whose eigenvalue is zero to rounding
cannot be whitened and are left out; a fit list of one vector gives no rows. Equal eigenvalues give any basis of their space.
Rows with one id, or a null id, are each returned. An empty table gives an empty result. Other columns are not read. Entries
so large that the exact deviation does not fit a long raise an overflow error."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.store import durable

SCALE, COMPONENTS = 256, 4
NODES, PER_INTERVAL, SPARE, ROUNDS, MORE_AFTER = 8, 8, 4, 60, 12
#: An eigenvalue of at most this part of the trace is zero to rounding.
RANK_TOLERANCE = 1e-13
#: Ends of intervals are not moved by less, as parts of the trace.
LEAST_GAP = 1e-9


def scaled(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows that take part."""
    v = F.col("v")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    rows = rows.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    rows = rows.filter(v.isNotNull() & (F.size(v) > 0) & finite)
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.col("count").desc(), "n").first()
    return rows.filter(F.size("v") == (length["n"] if length else 0)).select(
        "vec_id", F.transform(v, lambda c: F.floor(c * F.lit(float(SCALE))).cast("bigint")).alias("x")
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def moments(fit_list: DataFrame) -> tuple[int, np.ndarray]:
    """(n, S): the number of vectors and the exact sum of each dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = None, 0
        for batch in batches:
            x = _matrix(batch.column("x"))
            if len(x) and np.abs(x).max() > (1 << 62) // max(len(x), 1):
                raise OverflowError("entries too large for an exact sum")
            total = x.sum(axis=0) if total is None else total + x.sum(axis=0)
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total) + 1)), pa.array(np.append(total, n))], ["place", "part"])

    sums = fit_list.select("x").mapInArrow(add, "place bigint, part bigint").groupBy("place").agg(F.sum("part").alias("s"))
    found = np.array([r["s"] for r in sums.orderBy("place").collect()], np.int64)
    return (int(found[-1]), found[:-1]) if len(found) else (0, found)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n from the exact whole numbers n * x - S."""
    return (n * x - sums) / n


def covariance(vectors: DataFrame, n: int, width: int, centre) -> np.ndarray:
    """Mean product of each pair of ``centre(x)``'s columns over all vectors; ``width`` * ``width`` sums are collected."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                y = centre(_matrix(batch.column("x").slice(at, 4096)))
                total += y.T @ y
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(total.ravel())], ["place", "part"])

    sums = vectors.select("x").mapInArrow(add, "place bigint, part double").groupBy("place").agg(F.sum("part").alias("s"))
    out = np.zeros(width * width)
    for r in sums.collect():
        out[r["place"]] = r["s"]
    return (out.reshape(width, width) + out.reshape(width, width).T) / (2 * n)


# --- eigenvalues in intervals ---------------------------------------------------------------


def inertia(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues lie above ``shift``: positive pivots of a symmetric elimination with 1 x 1 and 2 x 2 pivots,
    the largest remaining entry always being one (Sylvester's law of inertia)."""
    a = matrix - shift * np.eye(len(matrix))
    above = 0
    while len(a):
        size = np.abs(a)
        on, off = int(np.argmax(size.diagonal())), divmod(int(np.argmax(size - np.diag(size.diagonal()))), len(a))
        if size[on, on] >= 0.6404 * size[off]:  # (1 + sqrt(17)) / 8 bounds the growth of entries
            pivot, signs = [on], int(a[on, on] > 0)
        else:
            pivot, signs = list(off), 1  # the determinant is negative: one eigenvalue of each sign
        block, rest = a[np.ix_(pivot, pivot)], [i for i in range(len(a)) if i not in pivot]
        if not np.abs(block).max():
            break  # nothing is left but zeros
        side = a[np.ix_(rest, pivot)]
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(block, side.T)
        a = (a + a.T) / 2
        above += signs
    return above


@dataclass
class Interval:
    """An interval, the number of eigenvalues in it, and the block of vectors that is projected onto it."""

    low: float
    high: float
    count: int
    block: np.ndarray
    settled: int = 0


def _block(width: int, n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((width, min(width, n)))


def intervals(matrix: np.ndarray, wanted: int) -> list[Interval]:
    """Disjoint intervals that hold the ``wanted`` largest eigenvalues of a matrix of trace 1 and few others. None has more
    than PER_INTERVAL unless they lie closer than LEAST_GAP."""
    width = len(matrix)
    low, high, n_low = -LEAST_GAP, float(np.abs(matrix).sum(axis=1).max()) + LEAST_GAP, width
    top = high
    while high - low > LEAST_GAP and n_low > wanted + SPARE:
        middle = (low + high) / 2
        n = inertia(matrix, middle)
        low, high, n_low = (low, middle, n_low) if n < wanted else (middle, high, n)
    found, todo = [], [(low, top, n_low, 0)]
    while todo:
        low, high, n_low, n_high = todo.pop()
        n = n_low - n_high
        if n > PER_INTERVAL and high - low > LEAST_GAP:
            middle = (low + high) / 2
            n_middle = inertia(matrix, middle)
            todo += [(low, middle, n_low, n_middle), (middle, high, n_middle, n_high)]
        elif n:
            found.append(Interval(low, high, n, _block(width, 2 * n + SPARE, len(found))))
    return found


def _node(k: int) -> tuple[complex, complex]:
    """Place and weight of a node on the upper unit half circle; the lower half is its conjugate."""
    x, w = np.polynomial.legendre.leggauss(NODES)
    angle = np.pi / 2 * (1 - x[k])
    return np.exp(1j * angle), w[k] / 2 * np.exp(1j * angle)


def filtered(spark: SparkSession, shared, open_: list[Interval]) -> list[np.ndarray]:
    """Each interval's block under the quadrature of its contour integral; one task per (interval, node)."""
    blocks = [(x.low, x.high, x.block) for x in open_]
    width = len(blocks[0][2])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, k in zip(batch.column("interval").to_pylist(), batch.column("node").to_pylist()):
                low, high, block = blocks[i]
                place, weight = _node(k)
                radius = (high - low) / 2
                z = (low + high) / 2 + radius * place
                part = (radius * weight * np.linalg.solve(z * np.eye(width) - shared.value, block.astype(complex))).real
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["interval", "part"])

    systems = spark.createDataFrame([(i, k) for i in range(len(blocks)) for k in range(NODES)], "interval int, node int")
    out = [np.zeros_like(b) for _, _, b in blocks]
    for r in systems.repartition(len(blocks) * NODES).mapInArrow(solve, "interval int, part binary").collect():
        out[r["interval"]] += np.frombuffer(r["part"]).reshape(width, -1)
    return out


def leading(spark: SparkSession, matrix: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues (falling) and their unit vectors as columns; fewer if others are zero to rounding."""
    trace = float(np.trace(matrix))
    if not trace > 0:
        return np.zeros(0), np.zeros((len(matrix), 0))
    unit, width = matrix / trace, len(matrix)
    found, pairs = intervals(unit, min(wanted, width)), []
    shared = spark.sparkContext.broadcast(unit)  # as many numbers as pairs of dimensions
    rounding = 8 * np.finfo(float).eps * width
    for round_ in range(1, ROUNDS + 1):
        open_ = [x for x in found if x.settled < 2]
        if not open_:
            break
        for x, projected in zip(open_, filtered(spark, shared, open_)):
            basis = np.linalg.qr(projected)[0]
            values, turn = np.linalg.eigh(basis.T @ unit @ basis)
            x.block = basis @ turn
            left = np.linalg.norm(unit @ x.block - x.block * values, axis=0)
            true = (values > x.low) & (values <= x.high) & (left < rounding)
            # once more after the first time, for the last digits
            x.settled = x.settled + 1 if true.sum() == x.count else 0
            if x.settled == 2:
                pairs += [(v, x.block[:, i]) for i, v in enumerate(values) if true[i] and v > RANK_TOLERANCE]
            elif round_ % MORE_AFTER == 0:  # something of the interval is missed: more vectors
                x.block = np.hstack([x.block, _block(width, min(x.block.shape[1], width - x.block.shape[1]), round_)])
    shared.destroy()
    if any(x.settled < 2 for x in found):
        raise ArithmeticError("contour integration and inertia counts find different numbers of eigenvalues")
    pairs = sorted(pairs, key=lambda p: -p[0])[:wanted]
    return np.array([v for v, _ in pairs]) * trace, np.array([v for _, v in pairs]).reshape(len(pairs), width).T


def whitened(embeddings: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per remaining row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = embeddings.sparkSession
    rows = scaled(embeddings, vec_id, embedding)
    fit_list = durable(rows.select("x").distinct())
    n, sums = moments(fit_list)
    width = len(sums)
    values, vectors, trace, error = np.zeros(0), np.zeros((width, 0)), 0.0, 0.0
    if n:
        matrix = covariance(fit_list, n, width, lambda x: _centred(x, n, sums))
        trace = float(np.trace(matrix))
        values, vectors = leading(spark, matrix, components)
    to_white = vectors / np.sqrt(values)
    found = len(values)
    if found:
        # the rows are centred exactly, so their projections are too
        projected = covariance(fit_list, n, found, lambda x: _centred(x, n, sums) @ to_white)
        error = float(np.abs(projected - np.eye(found)).max())
    schema = T.StructType([rows.schema["vec_id"], T.StructField("white", T.ArrayType(T.DoubleType())), T.StructField("deviation", T.LongType())])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not found:
                continue
            white = _centred(_matrix(batch.column("x")), n, sums) @ to_white
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, white.size + 1, found, dtype=np.int32)), pa.array(white.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), lists, batch.column("deviation")], ["vec_id", "white", "deviation"])

    # whole-number arithmetic raises on overflow
    off = F.zip_with("x", F.array(*[F.lit(int(s)) for s in sums]).cast("array<bigint>"), lambda x, s: F.lit(n).cast("bigint") * x - s)
    exact = F.aggregate(off, F.lit(0).cast("bigint"), lambda a, b: a + b * b)
    out = rows.select("vec_id", "x", exact.alias("deviation")).mapInArrow(project, schema)
    explained = F.array(*[F.lit(float(v / trace)) for v in values]).cast("array<double>")
    return out.select("vec_id", "deviation", F.posexplode("white").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {"op13_whitening": op13_whitening}
ORACLE_SQL: dict[str, str] = {}

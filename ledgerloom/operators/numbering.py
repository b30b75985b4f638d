"""Global sequence numbers without a single-partition window."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.durable import durable

_ROW_BITS = 33  # monotonically_increasing_id keeps the row position in the lower 33 bits


def global_row_number(
    df: DataFrame,
    order: Sequence[str | Column],
    out: str = "seq",
    start: int | Column | Callable[[int], int] = 1,
    partitions: int | None = None,
) -> DataFrame:
    """Number all rows 1..n in ``order``.

    Range partitioning on the full order spreads the rows, each partition is sorted by itself, and
    the start of each partition is the sum of the counts before it (one count per partition goes to
    the driver, never rows). ``order`` should be total: equal rows fall into one range. The ranged
    data is written durably first, because range bounds come from a sample and a recomputation could
    draw other bounds. ``start`` may be a function that gets the number of rows, say to reserve a range for them."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    placed = durable(
        df.repartitionByRange(n, *cols).sortWithinPartitions(*cols).withColumn("_slot", F.monotonically_increasing_id())
    )
    part = F.shiftrightunsigned("_slot", _ROW_BITS).cast("int")
    sizes = {r["p"]: r["n"] for r in placed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    width = max(sizes, default=0) + 1
    before = [0, *accumulate(sizes.get(i, 0) for i in range(width - 1))]
    offset = F.get(F.array(*[F.lit(b).cast("bigint") for b in before]), part)
    position = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1).cast("bigint"))
    first = start if isinstance(start, Column) else F.lit(start(sum(sizes.values())) if callable(start) else start)
    return placed.withColumn(out, (offset + position + first).cast("bigint")).drop("_slot")


def assign_surrogate_keys(new_rows: DataFrame, target: DataFrame | Callable[[int], int], key: str, order: Sequence[str]) -> DataFrame:
    """Give rows the numbers after the target's greatest key, in ``order``; or, without a look at the target, from the number
    on that a function (``NumberRange.reserve``) gives for their count."""
    if not isinstance(target, DataFrame):
        return global_row_number(new_rows.drop(key), order, out=key, start=target)
    highest = target.agg(F.coalesce(F.max(key), F.lit(0)).alias("m")).scalar()
    return global_row_number(new_rows.drop(key), order, out=key, start=highest + F.lit(1))

"""Mixing sources to target weights with hash-threshold histograms.

Every document has a 60-bit hash. Per source, sizes are summed by the leading hash bits (a histogram of at most 2^12
buckets), the bucket in which the budget is used up is found from running sums, and only that bucket is split by the next
12 bits, until it holds one hash value. The documents below the threshold are taken; nothing is sorted, and a smaller
budget takes a subset of what a larger one takes.

A source is taken 0, 1 or 2 times in whole (the whole part of target / size); the threshold chooses the documents taken
once more. The document on the threshold is taken if that comes nearer to the target, so a source misses its target by
at most half a document (or half a set of rows with one id and text, which have one hash).

Null text is of size 0, a null source is a source of its own and the last one, an empty table gives an empty result.
Other columns of the input, whatever their names, are kept by ``mixed`` and not looked at."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from ledgerloom.llm.store import durable
from ledgerloom.operators.numbering import global_row_number

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS, STEP_BITS = 60, 12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def document_hash(*parts: Column) -> Column:
    """The first 60 bits of the MD5 of the parts' texts; the same for rows with the same parts."""
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, hash) of all documents, stored: later passes read only these narrow rows."""
    return durable(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).cast("string").alias("source"),
            word_count(F.col(text)).alias("size"),
            document_hash(F.col(doc_id), F.col(text)).alias("hash"),
        )
    )


def targets(rows: DataFrame, weights: Sequence[float], portion: float, most: float) -> DataFrame:
    """(source, source_size, target): ``portion`` of all sizes split by weight, none above ``most`` times its size.

    The level (target per unit of weight) rises until no source that is not full wants more than its limit. Each step
    is one sum over the sources' table; it ends when no further source becomes full."""
    sized = rows.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    placed = global_row_number(sized, [F.col("source").asc_nulls_last()], out="seq", start=0)
    n = F.array(*[F.lit(float(w)) for w in weights])
    table = durable(
        placed.select(
            "source", "source_size", F.get(n, (F.col("seq") % len(weights)).cast("int")).alias("weight"),
            (F.col("source_size") * F.lit(float(most))).alias("most"),
        )
    )
    total = table.agg(F.sum("source_size"), F.sum("weight")).first()
    if total[0] is None:
        return table.select("source", "source_size", F.lit(0.0).alias("target"))
    wanted = float(portion) * total[0]
    level, full_before = wanted / total[1], -1
    while True:
        full = F.col("most") <= F.col("weight") * F.lit(level)
        n_full, filled, open_weight = table.agg(
            F.count_if(full), F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))
        ).first()
        if n_full == full_before or not open_weight:
            return table.select("source", "source_size", F.when(full, F.col("most")).otherwise(F.col("weight") * F.lit(level)).alias("target"))
        full_before, level = n_full, (wanted - filled) / open_weight


def thresholds(rows: DataFrame, goal: DataFrame) -> DataFrame:
    """(source, source_size, target, whole, below): documents with a hash under ``below`` are taken ``whole`` + 1 times."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    goal = durable(goal.withColumn("whole", whole).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")))
    state = goal.select(F.col("source").alias("s"), F.lit(0).cast("bigint").alias("prefix"), F.lit(0).cast("bigint").alias("before"), "budget")
    left, shift, done = rows, HASH_BITS, None
    while shift > 0:
        here = F.shiftrightunsigned("hash", shift)
        left = left.join(state, F.col("source").eqNullSafe(F.col("s")) & (here == F.col("prefix")))
        shift -= STEP_BITS
        left = left.withColumn("bucket", F.shiftrightunsigned("hash", shift))
        histogram = left.groupBy("s", "bucket").agg(
            F.sum("size").alias("size"), F.min("hash").alias("low"), F.max("hash").alias("high"), F.first("before").alias("before"), F.first("budget").alias("budget")
        )
        # at most 2^12 buckets per source
        running = F.sum("size").over(W.partitionBy("s").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0))
        first = W.partitionBy("s").orderBy("bucket")
        boundary = durable(
            histogram.withColumn("upto", F.col("before") + running)
            .filter(F.col("upto") > F.col("budget"))
            .withColumn("nth", F.row_number().over(first))
            .filter("nth = 1")
            .select("s", F.col("bucket").alias("prefix"), (F.col("upto") - F.col("size")).cast("bigint").alias("before"), "budget", "size", "low", "high")
        )
        single = F.col("low") == F.col("high")
        over = F.col("upto") - F.col("budget")
        found = boundary.filter(single).select(
            "s", (F.col("low") + F.when((F.col("before") + F.col("size") - F.col("budget")) <= F.col("budget") - F.col("before"), 1).otherwise(0)).alias("below")
        )
        done = found if done is None else done.unionByName(found)
        state = boundary.filter(~single).select("s", "prefix", "before", "budget")
        if state.isEmpty():
            break
        left = rows
    every = F.lit(1 << HASH_BITS).cast("bigint")
    result = goal.join(done, F.col("source").eqNullSafe(F.col("s")), "left")
    # no boundary: the budget is not used up by all of the source (a budget of 0 ends in the first bucket)
    below = F.coalesce("below", F.when(F.col("budget") > 0, every).otherwise(F.lit(0)).cast("bigint"))
    return durable(result.select("source", "source_size", "target", "whole", below.alias("below")))


def plan(rows: DataFrame, weights: Sequence[float] = (5, 2, 1), portion: float = 1.5, most: float = 2) -> DataFrame:
    """Thresholds of each source for the measured rows; a stored table with one row per source."""
    return thresholds(rows, targets(rows, weights, portion, most))


def applied(rows: DataFrame, limits: DataFrame, source: str | Column = "source", key: str = "hash") -> DataFrame:
    """Add source_size, target and copies to rows. The limits are a stored table, so Spark knows its size: it is
    broadcast if small, and a hot source of a shuffled join is split by adaptive execution."""
    limits = limits.withColumnRenamed("source", "_source")
    source = F.col(source) if isinstance(source, str) else source
    joined = rows.join(limits, source.eqNullSafe(F.col("_source")), "left")
    copies = F.col("whole") + F.when(F.col(key) < F.col("below"), 1).otherwise(0)
    return joined.withColumn("copies", copies.cast("bigint")).drop("_source", "whole", "below")


def mixed(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), portion: float = 1.5, most: float = 2) -> DataFrame:
    """The documents of the mix: a document taken twice is there twice. Columns stay as they are."""
    limits = plan(measured(docs), weights, portion, most).select(
        F.col("source").alias("source"), F.col("source_size").alias("_a"), F.col("target").alias("_b"), "whole", "below"
    )
    hashed = docs.select(F.struct(*docs.columns).alias("_row"), F.col("source").cast("string").alias("_from"), document_hash(F.col("doc_id"), F.col("text")).alias("_hash"))
    out = applied(hashed, limits, "_from", "_hash").filter("copies > 0")
    out = out.select("_row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("_nth"))
    return out.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    rows = measured(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    out = applied(rows, plan(rows))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("bigint").alias("taken"))


MIX_SQL = r"""
WITH RECURSIVE m AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(concat_ws(':', doc_id::VARCHAR, text)), 1, 15))::BIGINT AS h
  FROM documents
), src AS (
  SELECT source, source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS w,
         2.0::DOUBLE * source_size AS most
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM m GROUP BY source)
), lvl AS (
  SELECT -1::BIGINT AS n_before, 0::BIGINT AS n_full, 0.0::DOUBLE AS prev, (SELECT 1.5::DOUBLE * sum(source_size) / sum(w) FROM src) AS level
  UNION ALL
  SELECT n_full, f.n, level, CASE WHEN f.open > 0 THEN (f.goal - f.filled) / f.open ELSE level END
  FROM lvl, LATERAL (SELECT count(*) FILTER (most <= w * lvl.level) AS n, coalesce(sum(most) FILTER (most <= w * lvl.level), 0) AS filled,
                            coalesce(sum(w) FILTER (most > w * lvl.level), 0) AS open, 1.5::DOUBLE * sum(source_size) AS goal FROM src) f
  WHERE lvl.n_before < lvl.n_full OR lvl.n_before = -1
), goal AS (
  SELECT source, source_size, least(most, w * (SELECT max(level) FROM lvl)) AS target FROM src
), part AS (
  SELECT m.*, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole
  FROM m JOIN goal ON m.source IS NOT DISTINCT FROM goal.source
), run AS (
  SELECT *, target - whole * source_size AS budget, sum(size) OVER (PARTITION BY source ORDER BY h RANGE UNBOUNDED PRECEDING) AS upto,
         sum(size) OVER (PARTITION BY source, h) AS own
  FROM part
)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN budget > 0 AND (upto <= budget OR (upto - own <= budget AND upto - budget <= budget - (upto - own))) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM run
"""

QUERIES = {"op10_mixing": op10_mixing}
ORACLE_SQL = {"op10_mixing": MIX_SQL}

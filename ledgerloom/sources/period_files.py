"""Period files as users hand them in: found by prefix, read as text, broken rows set aside, one status per file."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.scalar import period_date
from ledgerloom.sources.durable import durable
from ledgerloom.sources.files import PLACE, normalised_header, period_candidates, stacked_files

RECORD = "_record"
REPORT = "file string, path string, candidates int, status string, n_rows bigint, n_rejected bigint"


@dataclass(frozen=True)
class PeriodFiles:
    """``rows`` of all files, later files on top in ``seq`` (None if no file could be read); ``rejected`` records with their
    file and place; ``report`` with the status of each file that was asked for.

    LOADED: every record has a cell for each header. PARTIAL: some do not and are rejected. EMPTY: a header only.
    MISSING: no file has the prefix. UNREADABLE: no header, two headers that become one name, or a wanted column is absent."""

    rows: DataFrame | None
    rejected: DataFrame
    report: DataFrame


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _read(spark: SparkSession, path: str, place: int, columns: Sequence[str] | None) -> DataFrame | None:
    """All records of a CSV file or folder by normalised header; a broken one has its text in ``_record``."""
    try:
        headers = spark.read.option("header", True).csv(path).columns
    except AnalysisException:
        return None
    names = [normalised_header(h) for h in headers]
    wanted = names if columns is None else [normalised_header(c) for c in columns]
    if not names or len(set(names)) < len(names) or RECORD in headers or not set(wanted) <= set(names):
        return None
    schema = T.StructType([T.StructField(h, T.StringType()) for h in [*headers, RECORD]])
    # without pruning a record is judged by all its cells, whatever is read of it later; the parts of a folder must agree in
    # their headers, otherwise the load fails rather than mix columns
    reader = spark.read.schema(schema).options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=RECORD, columnPruning=False, enforceSchema=False)
    at = F.struct(
        F.lit(place).alias("file"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"),
    )
    cells = [F.coalesce(F.col(_quoted(h)), F.lit("")).alias(n) for h, n in zip(headers, names) if n in wanted]
    return reader.csv(path).select(*cells, F.col(RECORD), at.cast(PLACE).alias("seq"))


def read_period_files(
    spark: SparkSession, base: str, year: int, month: int, names: Sequence[str], suffix: str = ".csv", columns: Sequence[str] | None = None
) -> PeriodFiles:
    """The period's file of each of ``names`` (``folder/prefix``, the first candidate in name order), lowest priority first.

    Cells are text, blank ones empty text. The records are parsed and stored once; rows, rejects and counts come from there."""
    frames, asked = [], []
    for i, name in enumerate(names):
        found = period_candidates(spark, base, year, month, name, suffix)
        frame = _read(spark, found[0], i, columns) if found else None
        frames.append(frame)
        state = "MISSING" if not found else "UNREADABLE" if frame is None else "LOADED"
        asked.append((i, name, found[0].rsplit("/", 1)[-1] if found else None, len(found), state))
    status = spark.createDataFrame(asked, "_file int, file string, path string, candidates int, status string")
    # the stacking numbers the files that are there; their place among the names stays
    stacked = stacked_files([None if f is None else f.withColumn("_file", F.lit(i)) for i, f in enumerate(frames)])
    if stacked is None:
        none = F.lit(0).cast("bigint")
        report = status.withColumns({"n_rows": none, "n_rejected": none}).select(*[f.name for f in T._parse_datatype_string(REPORT)])
        return PeriodFiles(None, spark.createDataFrame([], f"file string, seq {PLACE}, record string"), report)
    stored = durable(stacked)
    counts = stored.groupBy("_file").agg(F.count_if(F.col(RECORD).isNull()).alias("n_rows"), F.count(RECORD).alias("n_rejected"))
    joined = status.join(counts, "_file", "left").fillna(0, ["n_rows", "n_rejected"])
    state = F.when(F.col("status") != "LOADED", F.col("status")).when(F.col("n_rejected") > 0, "PARTIAL").when(F.col("n_rows") == 0, "EMPTY").otherwise("LOADED")
    report = joined.withColumn("status", state).select(*[f.name for f in T._parse_datatype_string(REPORT)])
    rows = stored.filter(F.col(RECORD).isNull()).drop(RECORD, "_file").withColumn("date_key", period_date(F.lit(year), F.lit(month)))
    broken = stored.filter(F.col(RECORD).isNotNull()).join(status.select("_file", "file"), "_file")
    return PeriodFiles(rows, broken.select("file", "seq", F.col(RECORD).alias("record")), report)

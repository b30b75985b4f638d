"""Writing current snapshots and versioned history."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.errors.exceptions.base import PySparkException as SparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.scalar import MEASURE_TYPE
from ledgerloom.sources.commits import Commits
from ledgerloom.sources.durable import CODEC

MEASURE = T.DecimalType(36, 12)


def write_current(df: DataFrame, path: str, partition_by: Sequence[str] = (), append: bool = False) -> None:
    """Replace (or extend) a parquet table; a replacement may have another schema.

    Spark refuses to overwrite a path the plan reads; a ``KeptTable`` can be replaced by what is made of its own rows."""
    df.write.mode("append" if append else "overwrite").partitionBy(*partition_by).parquet(path)


def save_table(df: DataFrame, name: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").format("parquet").saveAsTable(name)


def with_next_version(
    history: DataFrame | None, new: DataFrame, period: str = "date_key", version: str = "version_id", value: str = "value"
) -> DataFrame:
    """New rows numbered one above their period's greatest version in the history (1 if there is none).

    The versions are one row per period, so they are broadcast: joined by period, the rows would be shuffled and a month with
    many of them would be one task."""
    typed = new.withColumn(value, F.col(value).cast(MEASURE_TYPE))
    if history is None:
        return typed.withColumn(version, F.lit(1))
    newest = history.groupBy(period).agg(F.max(version).alias("_top"))
    return (
        typed.join(F.broadcast(newest), period, "left")
        .withColumn(version, (F.coalesce("_top", F.lit(0)) + 1).cast("int"))
        .select(*typed.columns, version)
    )


def append_version(history: DataFrame | None, new: DataFrame, period: str = "date_key", version: str = "version_id", value: str = "value") -> DataFrame:
    """History with the new version added: values widened, columns matched by name."""
    added = with_next_version(history, new, period, version, value)
    if history is None:
        return added
    widened = history.withColumn(value, F.col(value).cast(MEASURE_TYPE))
    return widened.unionByName(added, allowMissingColumns=True)


def read_history(spark: SparkSession, path: str, columns: T.StructType | None = None, value: str = "value") -> DataFrame | None:
    """The history folder; None before the first write.

    Files are read by one declared layout, so older files may hold the value as a narrower decimal or lack a column, and no
    footers are compared. ``columns`` names the layout; without it, the footers of all files give the columns, or, where
    they disagree, those of one file do."""
    try:
        if columns is None:
            try:
                columns = spark.read.option("mergeSchema", True).parquet(path).schema
            except SparkException as e:
                if "MERGE_SCHEMA" not in (e.getCondition() or ""):
                    raise
                columns = spark.read.parquet(path).schema
        wide = T.StructType([T.StructField(f.name, MEASURE if f.name == value else f.dataType) for f in columns.fields])
        return spark.read.schema(wide).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def write_version(spark: SparkSession, new: DataFrame, path: str, period: str = "date_key", version: str = "version_id", value: str = "value") -> None:
    """Append the next version to a plain history folder, for one writer at a time (see ``VersionedHistory``).

    Earlier versions are not rewritten: rows go to new files under their period, and the version
    lookup reads one column of the periods that the new rows touch."""
    lookup = T.StructType([T.StructField(version, T.IntegerType()), new.schema[period]])
    try:
        history = spark.read.schema(lookup).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        history = None
    if history is not None:
        history = history.join(new.select(period).distinct(), period, "left_semi")
    with_next_version(history, new, period, version, value).hint("rebalance", period).write.mode("append").option("compression", CODEC).partitionBy(period).parquet(path)


class VersionedHistory:
    """A history of versions per period that become visible whole.

    A run stages its rows under a name of its own; the commit of a small marker gives them their version numbers, one above
    the greatest committed one of each period. Of two runs at once the second to commit gets the next numbers, without
    writing its rows again; rows of a run that ended before its commit are in no version."""

    def __init__(self, spark: SparkSession, path: str, period: str = "date_key", version: str = "version_id", value: str = "value") -> None:
        self.spark, self.path, self.period, self.version, self.value = spark, path.rstrip("/"), period, version, value
        self.commits = Commits(spark, f"{self.path}/commits")

    def stage(self, new: DataFrame) -> str:
        """Write rows that nobody sees yet; returns the name under which they can be committed."""
        run = str(uuid.uuid4())
        wide = new.withColumn(self.value, F.col(self.value).cast(MEASURE_TYPE)).hint("rebalance", self.period)  # few files per period
        wide.write.option("compression", CODEC).partitionBy(self.period).parquet(f"{self.path}/rows/_run={run}")
        return run

    def commit(self, run: str) -> dict[str, int]:
        """Make a staged run visible; returns the version that each of its periods got."""
        rows = self._rows([run])
        periods = [] if rows is None else [r[0] for r in rows.select(F.col(self.period).cast("string")).distinct().collect()]  # months, not rows
        while True:
            n = self.commits.newest()
            tops = self.commits.read(n).get("tops", {})
            versions = {_period_key(p): tops.get(_period_key(p), 0) + 1 for p in periods}
            if self.commits.take(n + 1, {"run": run, "versions": versions, "tops": {**tops, **versions}}):
                return versions

    def append(self, new: DataFrame) -> dict[str, int]:
        return self.commit(self.stage(new))

    def _rows(self, runs: list[str], columns: T.StructType | None = None) -> DataFrame | None:
        try:
            reader = self.spark.read.option("basePath", f"{self.path}/rows")
            rows = (reader.schema(T.StructType([*columns.fields, T.StructField("_run", T.StringType())])) if columns else reader.option("mergeSchema", True)).parquet(*[f"{self.path}/rows/_run={r}" for r in runs])
            return rows
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None  # a run without rows
            raise

    def read(self, columns: T.StructType | None = None) -> DataFrame | None:
        """All committed versions; None before the first. ``columns`` is the layout of the rows, without the version; else
        the footers of the runs' files give it."""
        if not self.commits.newest():
            return None
        marks = self.spark.read.schema("run string, versions map<string, int>").json(f"{self.path}/commits")
        runs = [r["run"] for r in marks.filter(F.size("versions") > 0).select("run").collect()]  # one name per run
        rows = self._rows(runs, columns) if runs else None
        if rows is None:
            return None
        numbers = marks.select(F.col("run").alias("_run"), F.explode("versions").alias("_period", self.version))
        key = F.coalesce(F.col(self.period).cast("string"), F.lit(""))
        return rows.withColumn("_period", key).join(numbers, ["_run", "_period"]).drop("_run", "_period")


def _period_key(period: str | None) -> str:
    return period or ""


def trial_balance_snapshot(tb: DataFrame, year: int, month: int, site: str) -> DataFrame:
    """One site's month of the trial balance with exact measures, ready to be written as a snapshot."""
    measures = ("movement", "adjustment", "current_movement")
    return tb.filter((F.col("month") == month) & (F.col("year") == year) & (F.col("site_code") == site)).select(
        "account_number", *[F.col(m).cast(MEASURE_TYPE).alias(m) for m in measures], "site_code", "month", "year"
    )

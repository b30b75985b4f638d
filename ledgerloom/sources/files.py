"""Reading tables and period files as DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.scalar import clean_ref, fiscal_month, fiscal_year, period_date
from ledgerloom.sources.schemas import empty
from ledgerloom.sources.snapshots import save_table, write_current

# The tags of rows that come from files.
HISTORIC_SOURCE = "manual precalculated historic values"
ADJUSTMENT_SOURCE = "manual adjustments"
#: A row's place among stacked files: file number, path, start of the split, position in it.
PLACE = "struct<file:int,path:string,block:bigint,position:bigint>"
INPUT_SCHEMA = f"input_ref string, source string, fin_period int, fin_year int, value string, seq {PLACE}"


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by qualified name, or a parquet folder by path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def active_rows(master: DataFrame) -> DataFrame:
    return master.filter(F.col("active_ind") == 1)


def period_rows(df: DataFrame, fy: int, fm: int, site: str | None = None) -> DataFrame:
    """Rows of one fiscal period (and site): plain comparisons that reach the parquet scan."""
    rows = df.filter((F.col("fiscal_year") == fy) & (F.col("fiscal_month") == fm))
    return rows if site is None else rows.filter(F.col("site_code") == site)


def unified_inputs(df: DataFrame, fy: int | None = None, fm: int | None = None, site: str | None = None) -> DataFrame:
    """Working inputs from the unified table; with a period, only that period and site."""
    rows = df if fy is None else period_rows(df, fy, fm, site)
    return rows.select(
        clean_ref("input_ref").alias("input_ref"),
        F.col("source_name").alias("source"),
        F.col("fiscal_month").cast("int").alias("fin_period"),
        F.col("fiscal_year").cast("int").alias("fin_year"),
        F.col("measure_value").cast("string").alias("value"),
        *[c for c in ("seq",) if c in df.columns],
    )


def normalised_header(name: str) -> str:
    return name.strip().replace(" ", "_").lower()


def period_candidates(spark: SparkSession, base: str, year: int, month: int, file_path: str, suffix: str) -> list[str]:
    """All ``{base}/{year}/{MM}/{folder}/{prefix}*{suffix}`` in name order; a folder of part files counts as one file.

    Only the folder is listed, on the driver; hidden names do not count."""
    folder, _, prefix = file_path.partition("/")
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{year}/{month:02d}/{folder}/{prefix}*{suffix}")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    paths = [s.getPath() for s in found]
    return [p.toString() for p in sorted(paths, key=lambda p: p.getName()) if not p.getName().startswith(("_", "."))]


def find_period_file(spark: SparkSession, base: str, year: int, month: int, file_path: str, suffix: str) -> str | None:
    """The first of ``period_candidates``; None if there is none."""
    return next(iter(period_candidates(spark, base, year, month, file_path, suffix)), None)


def read_period_file(
    spark: SparkSession, path: str | None, year: int, month: int, columns: Sequence[str] | None = None, fmt: str = "csv"
) -> DataFrame | None:
    """A period file with normalised headers, the period's ``date_key`` and its row order in ``seq``.

    CSV cells are text and blank cells stay empty text. A missing or unreadable file gives None: the
    caller skips it, as a missing overlay is no error."""
    if path is None:
        return None
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    try:
        raw = reader.load(path)
        if columns is not None:
            raw = raw.select(*columns)
        names = raw.columns
        # parquet knows the row's number; in a text file it follows from the split and the order within it
        position = F.col("_metadata.row_index") if fmt == "parquet" else F.monotonically_increasing_id()
        block = F.lit(0).cast("bigint") if fmt == "parquet" else F.col("_metadata.file_block_start")
        place = F.struct(F.lit(0).alias("file"), F.col("_metadata.file_path").alias("path"), block.alias("block"), position.alias("position"))
        placed = raw.select(*names, place.cast(PLACE).alias("_place"))
        if fmt == "csv":
            placed = placed.fillna("", subset=names)
    except AnalysisException:
        return None
    return (
        placed.toDF(*[normalised_header(n) for n in names], "_place")
        .withColumns({"date_key": period_date(F.lit(year), F.lit(month)), "seq": F.col("_place")})
        .drop("_place")
    )


def ingest_period_file(
    spark: SparkSession, path: str | None, store: str, year: int, month: int, columns: Sequence[str] | None = None, fmt: str = "csv"
) -> DataFrame | None:
    """Read a period file, replace the stored table (name or folder) with it, and return the stored rows."""
    df = read_period_file(spark, path, year, month, columns, fmt)
    if df is None:
        return None
    if "/" in store:
        write_current(df, store)
    else:
        save_table(df, store)
    return read_table(spark, store)


def input_rows(df: DataFrame | None, year: int, month: int, source: str | None = None, spark: SparkSession | None = None) -> DataFrame:
    """File rows in the working-input layout, stamped with the fiscal period of (year, month)."""
    if df is None:
        return empty(spark, INPUT_SCHEMA)
    day = period_date(F.lit(year), F.lit(month))
    # fixed values: two headers that period files use for reference and value
    renamed = df.withColumnsRenamed({"i_ref_values": "input_ref", "scr_value": "value"})
    tag: Column = F.lit(source) if source is not None else F.col("source") if "source" in renamed.columns else F.lit(None)
    return renamed.select(
        clean_ref("input_ref").alias("input_ref"),
        tag.cast("string").alias("source"),
        fiscal_month(day).alias("fin_period"),
        fiscal_year(day).alias("fin_year"),
        F.col("value").cast("string").alias("value"),
        F.col("seq").cast(PLACE).alias("seq"),
    )


def stacked_files(frames: Sequence[DataFrame | None]) -> DataFrame | None:
    """Rows of several files by lower-cased column name; later files rank after earlier ones in ``seq``."""
    present = [f for f in frames if f is not None]
    if not present:
        return None
    lowered = [f.toDF(*[c.lower() for c in f.columns]) for f in present]
    ranked = [f.withColumn("seq", F.col("seq").withField("file", F.lit(i))) for i, f in enumerate(lowered)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)


def historical_rows(df: DataFrame | None, year: int, month: int, spark: SparkSession) -> DataFrame:
    return input_rows(df, year, month, HISTORIC_SOURCE, spark)


def adjustment_rows(df: DataFrame | None, year: int, month: int, spark: SparkSession) -> DataFrame:
    return input_rows(df, year, month, ADJUSTMENT_SOURCE, spark)


def tables_missing(spark: SparkSession, tables: Sequence[str]) -> list[str]:
    return [t for t in tables if not spark.catalog.tableExists(t)]


def require_tables(spark: SparkSession, tables: Sequence[str]) -> None:
    missing = tables_missing(spark, tables)
    if missing:
        raise LookupError(f"tables not found: {', '.join(missing)}")


def register_views(views: dict[str, Callable[[], DataFrame]]) -> list[dict[str, str]]:
    """Create every view, in name order; a failing one is reported and does not stop the others."""
    report = []
    for name in sorted(views):
        try:
            views[name]().createOrReplaceTempView(name)
            report.append({"view": name, "status": "SUCCESS", "error": ""})
        except Exception as e:  # noqa: BLE001 - any failure is reported with its view
            report.append({"view": name, "status": "FAILED", "error": str(e)})
    return report

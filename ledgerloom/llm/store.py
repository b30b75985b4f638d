"""Steps and files in the folder that all executors reach (``spark.checkpoint.dir``)."""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources import durable as steps
from ledgerloom.sources.durable import checkpoint_dir

__all__ = ["durable", "held_out", "new_folder", "on_workers", "read_files", "write_files"]


BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def durable(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """A stored step in the session's codec: frames of tokens are compressed already, a slower codec would only cost time."""
    return steps.durable(df, partition_by, codec=None)


def on_workers(spark: SparkSession) -> None:
    """Prepare the session for operators on whole texts: Python workers find this package where the driver has it (on a
    cluster that has it installed, this is only one more place to look in), and get texts in smaller Arrow batches, as
    a batch of Spark's default 10,000 long texts takes a worker's memory several times over."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (paths, root) if x)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path for one run's files; nothing is there yet."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4()}"


def write_files(chunks: DataFrame, path: str) -> None:
    """Write each row's one binary column to a file of its own, through Spark's file commit.

    The text writer copies the bytes of a string as they are, and one row goes to one file; a NUL, its row end, follows
    the bytes. Readers of these formats take the length from the format and skip it."""
    (name,) = chunks.columns
    text = chunks.filter(F.col(name).isNotNull()).select(F.col(name).cast("string").alias("value"))
    text.write.option("maxRecordsPerFile", 1).option("lineSep", "\0").text(path)


def read_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The files of ``write_files``, or a list of them, as rows (path, content)."""
    return spark.read.format("binaryFile").load(path).select("path", "content").filter(F.length("content") > 1)


def held_out(doc_id: str | Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id's text modulo ``parts`` is ``part``; an id that is null counts as the empty text."""
    text = F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % parts == part


def partitions_for(df: DataFrame) -> int:
    """Partitions for a shuffle of whole rows: as many as the session sets, or as the input has splits if those are more."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions())

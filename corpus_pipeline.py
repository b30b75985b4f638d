"""A training corpus from the documents table, in five stages.

Each stage is given what the one before kept, as a written table, and works on all of it: documents whose language is not
recognized go, of each group of near-duplicates one stays, documents with benchmark items go, sources are mixed to their
target weights (a document taken twice is there twice), and the rest is written as token ids. The result has one row per
document of the files: doc_id, start, n_tokens, ids_crc32.

Every stage passes columns on as they are, handles null ids and texts as its operator says, and gives an empty result for an
empty table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import decontam, langid, mixing, neardup, store, tokens


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.recognized(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.deduplicated(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokens.tokenized(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _prepared(stage: Stage) -> Stage:
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        store.on_workers(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    (stage.__name__, _prepared(stage)) for stage in (language, near_duplicates, decontamination, mix, token_ids)
]

#: The language model and the tokenizer can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written before the next one reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = store.new_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

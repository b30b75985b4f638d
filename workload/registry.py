"""All registered queries by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload import formulas, functions_and_inputs, kept, loads, marts, run_options, run_path
from workload.fixtures import Tables, portable

_ALL = {**functions_and_inputs.QUERIES, **marts.QUERIES, **formulas.QUERIES, **loads.QUERIES, **run_path.QUERIES, **kept.QUERIES, **run_options.QUERIES}


def _bound(fn: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: portable(fn(Tables(spark, folder)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bound(fn) for name, (fn, _) in _ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _ALL.items() if sql}

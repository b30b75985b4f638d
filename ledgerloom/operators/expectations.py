"""Data tests and completeness metrics."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.schemas import ColumnSpec


class ExpectationFailed(AssertionError):
    pass


@dataclass(frozen=True)
class Expectation:
    """A node test: ``bad_rows`` gives the rows that violate it."""

    name: str
    bad_rows: Callable[[], DataFrame]
    when: str = "After"
    continue_on_failure: bool = False


def run_expectations(tests: Sequence[Expectation], when: str, enabled: bool = True) -> list[dict[str, str]]:
    """Run the tests of one moment ("Before" or "After"); each stops at its first bad row."""
    report = []
    for test in tests if enabled else ():
        if test.when != when:
            continue
        ok = test.bad_rows().limit(1).isEmpty()
        report.append({"test": test.name, "status": "PASSED" if ok else "FAILED"})
        if not ok and not test.continue_on_failure:
            raise ExpectationFailed(test.name)
    return report


def column_test_counts(df: DataFrame, tests: dict[str, str]) -> DataFrame:
    """Rows violating each condition, all conditions in one pass: (test, failed_rows, total_rows).

    A condition that is NULL for a row counts as violated."""
    counts = [F.count_if(~F.coalesce(F.expr(cond), F.lit(False))).alias(f"_{i}") for i, cond in enumerate(tests.values())]
    once = df.agg(F.count("*").alias("_all"), *counts)
    rows = [F.struct(F.lit(n).alias("test"), F.col(f"_{i}").alias("failed_rows")) for i, n in enumerate(tests)]
    return once.select(F.explode(F.array(*rows)).alias("r"), "_all").select(
        "r.test", "r.failed_rows", F.col("_all").alias("total_rows")
    )


def column_tests(columns: Sequence[ColumnSpec]) -> dict[str, str]:
    """The tests declared on columns, named ``<column>: <test>``."""
    return {f"{c.name}: {name}": cond for c in columns for name, cond in c.tests.items()}


def completeness(tables: dict[str, DataFrame], column: str) -> DataFrame:
    """Filled and total rows of a column per table: one small aggregate each."""
    parts = [
        df.agg(F.count(column).alias("filled_rows"), F.count("*").alias("total_rows")).select(
            F.lit(name).alias("table_name"), "filled_rows", "total_rows"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)

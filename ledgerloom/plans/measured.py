"""Loads whose tests are measured by their own writes.

The rows of a source are stored once; that write counts the failures of every column test (observed metrics) and keeps rows
that fail one apart, so neither the report nor setting rows aside needs a second pass over the source."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerloom.functions.scalar import any_of
from ledgerloom.operators.expectations import ExpectationFailed, column_tests
from ledgerloom.plans.loads import Load, data_columns, load_kept
from ledgerloom.sources.durable import durable
from ledgerloom.sources.kept import KeptTable, NumberRange
from ledgerloom.sources.schemas import mapped

_ASIDE = "_aside"


@dataclass(frozen=True)
class Measured:
    """A stored source: the rows that pass all column tests, the others, and how many rows fail each test."""

    passed: DataFrame
    aside: DataFrame
    rows: int
    failed: dict[str, int]


@dataclass(frozen=True)
class Outcome:
    """What a load reports: one entry (moment, test, status, failed_rows) per test, and the rows that it did not load."""

    report: list[dict]
    aside: DataFrame


class LoadFailed(ExpectationFailed):
    """A test failed that must not; ``report`` has what was measured until then."""

    def __init__(self, test: str, report: list[dict]) -> None:
        super().__init__(test)
        self.report = report


def measured_source(source: DataFrame, load: Load) -> Measured:
    """Store the mapped rows of a source and measure the column tests of the load while they are written. A condition that
    is NULL for a row counts as failed."""
    own = data_columns(load)
    checks = column_tests(own) if load.tests_enabled else {}
    failing = {name: ~F.coalesce(F.expr(condition), F.lit(False)) for name, condition in checks.items()}
    seen = Observation()
    counts = [F.count_if(c).alias(f"_{i}") for i, c in enumerate(failing.values())]
    rows = mapped(source, own).withColumn(_ASIDE, any_of(failing.values()))
    stored = durable(rows.observe(seen, F.count(F.lit(1)).alias("_rows"), *counts), [_ASIDE])
    found = seen.get
    return Measured(
        stored.filter(~F.col(_ASIDE)).drop(_ASIDE), stored.filter(_ASIDE).drop(_ASIDE), found["_rows"],
        {name: found[f"_{i}"] for i, name in enumerate(failing)},
    )


def load_measured(
    load: Load, table: KeptTable, sources: Sequence[DataFrame], run_ts: Column, numbers: NumberRange | None = None, set_aside: bool = True
) -> Outcome:
    """Tests before, a measured load into a kept table, tests after.

    A node test that fails ends the load (before: nothing is stored in the table) unless it is declared to go on. Rows that
    fail a column test are set aside and not loaded; without ``set_aside`` the first of them ends the load."""
    report: list[dict] = []

    def entry(moment: str, test: str, failed: int) -> None:
        report.append({"moment": moment, "test": test, "status": "FAILED" if failed else "PASSED", "failed_rows": failed})

    def node_tests(moment: str) -> None:
        for test in load.tests if load.tests_enabled else ():
            if test.when == moment:
                entry(moment, test.name, test.bad_rows().count())
                if report[-1]["failed_rows"] and not test.continue_on_failure:
                    raise LoadFailed(test.name, report)

    node_tests("Before")
    ready = [measured_source(s, load) for s in sources]
    for name in ready[0].failed if ready else ():
        entry("Load", name, sum(m.failed[name] for m in ready))
        if report[-1]["failed_rows"] and not set_aside:
            raise LoadFailed(name, report)
    # the columns are computed already
    plain = replace(load, columns=[replace(c, expr=None) for c in load.columns])
    load_kept(plain, table, [m.passed for m in ready], run_ts, numbers)
    node_tests("After")
    return Outcome(report, reduce(DataFrame.unionByName, [m.aside for m in ready]))

"""Warehouse loads composed from the merge and union operators.

A load is declared once (columns, roles, options) and applied to a target and its sources; the
result is a DataFrame that the caller writes as the table's next state."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import merge as m
from ledgerloom.operators.expectations import Expectation, ExpectationFailed, column_test_counts, column_tests, run_expectations
from ledgerloom.operators.setops import union_sources
from ledgerloom.sources.durable import durable
from ledgerloom.sources.kept import KeptTable, NumberRange
from ledgerloom.sources.schemas import ColumnSpec, create_table, empty, mapped, table_schema

KINDS = ("stage", "persistent_stage", "dimension", "fact", "view")


@dataclass(frozen=True)
class Load:
    """Declaration of a loaded table or view."""

    name: str
    kind: str
    columns: Sequence[ColumnSpec]
    roles: m.Columns = field(default_factory=m.Columns)
    strategy: str = "INSERT"
    truncate_before: bool = True
    distinct: bool = False
    pre_sql: Sequence[str] = ()
    post_sql: Sequence[str] = ()
    tests: Sequence[Expectation] = ()
    tests_enabled: bool = True
    override: Callable[[SparkSession], DataFrame] | None = None
    compat: bool = False

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown load kind {self.kind!r}; expected one of {KINDS}")


def data_columns(load: Load) -> list[ColumnSpec]:
    """Declared columns that come from the sources (all but the system columns)."""
    return [c for c in load.columns if c.name not in load.roles.system]


def create(spark: SparkSession, load: Load) -> DataFrame:
    """The empty table of a load, or what its override gives instead."""
    return load.override(spark) if load.override else create_table(spark, load.columns)


def view(load: Load, sources: Sequence[DataFrame], spark: SparkSession | None = None) -> DataFrame:
    """View form of a load: the mapped sources stacked; keys and load times do not exist yet, so they are NULL.

    Stage and view nodes stack by their strategy (UNION unless told otherwise), the others keep all rows."""
    if load.override:
        return load.override(spark)
    if load.kind in ("stage", "view"):
        strategy = load.strategy if load.strategy in ("UNION", "UNION ALL") else "UNION"
    else:
        strategy = "UNION ALL"
    roles = load.roles
    empty_columns = {roles.surrogate_key, roles.created, roles.updated}
    if load.kind == "persistent_stage":
        empty_columns |= {roles.start, roles.end}
    stacked = union_sources([mapped(s, data_columns(load)) for s in sources], strategy, load.distinct)
    defaults = {
        roles.version: F.lit(1),
        roles.current_flag: F.lit("Y"),
        roles.start: F.current_timestamp(),
        roles.end: F.lit(m.END_OF_TIME),
    }
    out = []
    for c in load.columns:
        if c.name in empty_columns:
            out.append(F.lit(None).cast(c.data_type).alias(c.name))
        elif c.name in roles.system:
            out.append(defaults[c.name].cast(c.data_type).alias(c.name))
        else:
            out.append(F.col(c.name))
    return stacked.select(*out)


def next_state(load: Load, target: DataFrame | None, sources: Sequence[DataFrame], run_ts: Column, numbers: m.Numbered = None) -> DataFrame:
    """State of the table after loading ``sources`` one after another.

    A later source sees the rows an earlier one added, as when each is merged by its own statement. With several keyed
    sources, only target rows with a key of any of them go through the merges; the others are read and passed on once.
    ``numbers`` reserves surrogate keys, if the target is a part of a table or should not be looked through for them."""
    ready = [mapped(s, data_columns(load)) for s in sources]
    if load.kind == "stage":
        loaded = union_sources(ready, load.strategy)
        return loaded if load.truncate_before or target is None else m.insert_only(target, loaded)
    if target is None:
        raise ValueError("this kind of load needs the current target (create() gives an empty one)")
    roles = load.roles
    state, rest, keys = target, None, list(roles.business_key)
    if keys:
        # a merge reads its source several times (rows, repeated keys, matches): compute it once
        ready = [durable(source) for source in ready]
    if keys and len(ready) > 1:
        touched = durable(reduce(DataFrame.union, [source.select(*keys) for source in ready]).distinct())
        rest = target.join(touched, keys, "left_anti").select(*target.columns)
        state = target.join(touched, keys, "left_semi").select(*target.columns)
    for i, source in enumerate(ready):
        if i:
            state = durable(state)
        numbered = numbers
        if numbers is None and rest is not None and roles.surrogate_key:
            numbered = state.select(roles.surrogate_key).union(rest.select(roles.surrogate_key))
        if not roles.business_key:
            state = m.insert_only(state, m.appended(state, source, roles, run_ts, numbered))
        elif load.kind == "fact":
            state = m.upsert_changed(state, source, roles, run_ts, load.compat)
        elif roles.tracked:
            state = m.scd2(state, source, roles, run_ts, touch_unchanged=load.kind == "persistent_stage", compat=load.compat, numbered=numbered)
        else:
            state = m.scd1(state, source, roles, run_ts, load.compat, numbered)
    return state if rest is None else state.unionByName(rest)


def load_kept(load: Load, table: KeptTable, sources: Sequence[DataFrame], run_ts: Column, numbers: NumberRange | None = None) -> int:
    """Load ``sources`` into a kept table: only buckets with a key of a source are read and rewritten; a load without keys
    is appended, a stage replaces or extends its rows. Returns the number of the new state."""
    roles, keys = load.roles, list(load.roles.business_key)
    if roles.surrogate_key and numbers is None:
        raise ValueError("a table with surrogate keys needs their NumberRange: a load does not read all of its target")
    if load.kind == "stage":
        rows = next_state(load, None, sources, run_ts)
        return table.replace(rows) if load.truncate_before else table.append(rows)
    reserve = numbers.reserve if numbers else None
    if not keys:
        shape = empty(table.spark, table_schema(load.columns))
        added = [m.appended(shape, mapped(s, data_columns(load)), roles, run_ts, reserve) for s in sources]
        return table.append(reduce(DataFrame.union, added))
    ready = [durable(s) for s in sources]  # read for the touched buckets and for the merge
    touched = reduce(DataFrame.union, [mapped(s, [c for c in load.columns if c.name in keys]).select(*keys) for s in ready])
    return table.merge(touched, lambda rows: next_state(load, rows, ready, run_ts, reserve))


def kept_table(spark: SparkSession, load: Load, path: str, buckets: int = 64) -> KeptTable:
    """The kept table of a load, empty if nothing has been loaded yet."""
    return KeptTable(spark, path, table_schema(load.columns), load.roles.business_key, buckets)


def run(
    spark: SparkSession,
    load: Load,
    target: DataFrame | None,
    sources: Sequence[DataFrame],
    run_ts: Column,
    write: Callable[[DataFrame], DataFrame | None],
) -> list[dict[str, str]]:
    """Before-tests, pre-SQL, load, post-SQL, after-tests and column tests; returns the test report.

    ``write`` stores the next state. It must not overwrite the files the target is read from: write
    a new folder and switch to it. If it returns the stored table, the column tests read that; otherwise the state is
    stored once more for them."""
    report = run_expectations(load.tests, "Before", load.tests_enabled)
    for statement in load.pre_sql:
        spark.sql(statement)
    checks = column_tests(load.columns) if load.tests_enabled else {}
    state = next_state(load, target, sources, run_ts)
    written = write(state)
    for statement in load.post_sql:
        spark.sql(statement)
    report += run_expectations(load.tests, "After", load.tests_enabled)
    if checks:
        state = written if written is not None else durable(state)
        failed = [r["test"] for r in column_test_counts(state, checks).filter("failed_rows > 0").collect()]
        report += [{"test": n, "status": "FAILED" if n in failed else "PASSED"} for n in checks]
        if failed:
            raise ExpectationFailed(", ".join(failed))
    return report

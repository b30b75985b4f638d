"""Table merges as DataFrame operators: upserts, protected columns, SCD type 1 and type 2.

A merge reads the target once in full (left join to the source) and once for its key columns only
(to find the source rows without a match). When the source is small, Spark broadcasts it by its
measured size and the target is never shuffled; when it is large, both joins use the same key
partitioning. No join is forced by a hint."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.scalar import any_of, just_before, value_changed
from ledgerloom.operators.numbering import assign_surrogate_keys

END_OF_TIME = "2999-12-31 00:00:00"
#: Where surrogate keys go on: after the greatest of a table, or in ranges that a function reserves.
Numbered = DataFrame | Callable[[int], int] | None


@dataclass(frozen=True)
class Columns:
    """Roles of the columns of a loaded table. Names left out mean the table has no such column."""

    business_key: Sequence[str] = ()
    tracked: Sequence[str] = ()
    surrogate_key: str | None = None
    version: str | None = None
    current_flag: str | None = None
    start: str | None = None
    end: str | None = None
    created: str | None = None
    updated: str | None = None

    @property
    def system(self) -> set[str]:
        names = (self.surrogate_key, self.version, self.current_flag, self.start, self.end, self.created, self.updated)
        return {n for n in names if n}

    def payload(self, columns: Sequence[str]) -> list[str]:
        """Columns that are neither keys nor system columns."""
        return [c for c in columns if c not in self.system and c not in self.business_key]

    def type1(self, columns: Sequence[str]) -> list[str]:
        """Payload columns without change tracking."""
        return [c for c in self.payload(columns) if c not in self.tracked]


@dataclass(frozen=True)
class MergeRule:
    """What a matched row becomes: ``when`` guards the update, ``values`` are the new columns."""

    when: Column
    values: dict[str, Column] = field(default_factory=dict)


def t(name: str) -> Column:
    return F.col(f"t.`{name}`")


def s(name: str) -> Column:
    return F.col(f"s.`{name}`")


def with_system_columns(source: DataFrame, roles: Columns, run_ts: Column) -> DataFrame:
    """System columns of a freshly inserted row: version 1, current, valid from now on."""
    values = {
        roles.version: F.lit(1).cast("bigint"),
        roles.current_flag: F.lit("Y"),
        roles.start: run_ts,
        roles.end: F.lit(END_OF_TIME).cast("timestamp"),
        roles.created: run_ts,
        roles.updated: run_ts,
    }
    return source.withColumns({n: v for n, v in values.items() if n})


def _flag_repeats(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mark source rows whose key is repeated; matching such a row is an error, as in SQL MERGE."""
    repeated = source.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1")
    return source.join(repeated.select(*keys, F.lit(True).alias("_repeated")), list(keys), "left")


def _unmatched(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key is not in the target. NULL keys never match, so they stay.

    The keys common to both are found first (target keys semi-joined to the source), so that the
    anti join meets only those of the target. They are not made distinct: that would hold nearly every key in memory."""
    common = target.select(*keys).join(source.select(*keys), list(keys), "left_semi")
    return source.join(common, list(keys), "left_anti").select(*source.columns)


def _pair(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows with their source row, if any. A repeated source key that matches raises, whichever columns are used
    afterwards: the check is a filter, so it is not pruned with an unused column."""
    flagged = _flag_repeats(source, keys).withColumn("_matched", F.lit(True))
    condition = F.lit(True)
    for k in keys:
        condition = condition & (t(k) == s(k))
    error = F.raise_error(F.lit("merge: more than one source row matches a target row")).cast("boolean")
    once = F.when(F.coalesce(s("_matched") & s("_repeated"), F.lit(False)), error).otherwise(F.lit(True))
    return target.alias("t").join(flagged.alias("s"), condition, "left").filter(once)


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    rule: Callable[[DataFrame, DataFrame], MergeRule],
    insert: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Update matched rows by ``rule`` and insert the unmatched source rows."""
    r = rule(target, source)
    hit = F.coalesce(s("_matched"), F.lit(False)) & F.coalesce(r.when, F.lit(False))
    out = []
    for c in target.columns:
        new = r.values.get(c)
        typed = None if new is None else new.cast(target.schema[c].dataType)
        out.append((t(c) if typed is None else F.when(hit, typed).otherwise(t(c))).alias(c))
    merged = _pair(target, source, keys).select(*out)
    fresh = _unmatched(source, target, keys)
    if insert is not None:
        fresh = insert(fresh)
    return merged.unionByName(conform(fresh, target), allowMissingColumns=False)


def conform(rows: DataFrame, target: DataFrame) -> DataFrame:
    """Rows in the target's columns and types; columns they lack become NULL."""
    return rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    )


def insert_only(target: DataFrame, source: DataFrame) -> DataFrame:
    """Append without a key: columns by name."""
    return target.unionByName(conform(source, target))


def upsert_columns(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str], identity: str | None = None
) -> DataFrame:
    """Upsert that overwrites only the listed columns of a matched row; ``identity`` numbers inserted rows on."""
    rule = MergeRule(F.lit(True), {c: s(c) for c in update})
    return merge(target, source, keys, lambda *_: rule, _numbered(target, identity, keys))


def upsert_protected(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    protected: str = "original_value",
    guard: str = "adjusted_value",
    identity: str | None = None,
) -> DataFrame:
    """Upsert whose ``protected`` column is refreshed only while the row's ``guard`` is NULL."""
    values = {c: s(c) for c in update}
    values[protected] = F.when(t(guard).isNull(), s(protected)).otherwise(t(protected))
    return merge(target, source, keys, lambda *_: MergeRule(F.lit(True), values), _numbered(target, identity, keys))


def upsert_changed(target: DataFrame, source: DataFrame, roles: Columns, run_ts: Column, compat: bool = False) -> DataFrame:
    """Fact upsert: a matched row is rewritten only if any of its measures changed; the create time stays."""
    stamped = with_system_columns(source, roles, run_ts)

    def rule(target: DataFrame, source: DataFrame) -> MergeRule:
        compared = [c for c in source.columns if c not in roles.business_key and c not in (roles.updated, roles.created)]
        written = [c for c in source.columns if c not in roles.business_key and c != roles.created]
        return MergeRule(any_of((value_changed(s(c), t(c), compat) for c in compared), True), {c: s(c) for c in written})

    return merge(target, stamped, roles.business_key, rule)


def append_load(target: DataFrame, source: DataFrame, roles: Columns, run_ts: Column) -> DataFrame:
    """Load without a business key: every row is added as version 1."""
    return insert_only(target, appended(target, source, roles, run_ts))


def appended(target: DataFrame, source: DataFrame, roles: Columns, run_ts: Column, numbered: Numbered = None) -> DataFrame:
    """The rows that a load without a business key adds, in the target's columns."""
    stamped = with_system_columns(source, roles, run_ts)
    if roles.surrogate_key:
        stamped = assign_surrogate_keys(stamped, numbered or target, roles.surrogate_key, roles.payload(stamped.columns))
    return conform(stamped, target)


def scd1(
    target: DataFrame,
    source: DataFrame,
    roles: Columns,
    run_ts: Column,
    compat: bool = False,
    numbered: Numbered = None,
) -> DataFrame:
    """Type 1: overwrite changed payload columns in place; a table without payload always updates."""
    stamped = with_system_columns(source, roles, run_ts)
    payload = roles.payload(source.columns)

    def rule(*_) -> MergeRule:
        written = [*payload, *([roles.updated] if roles.updated else [])]
        return MergeRule(any_of((value_changed(s(c), t(c), compat) for c in payload), True), {c: s(c) for c in written})

    return merge(target, stamped, roles.business_key, rule, _numbered(numbered or target, roles.surrogate_key, roles.business_key))


def _numbered(target: DataFrame | Callable[[int], int], identity: str | None, keys: Sequence[str]) -> Callable[[DataFrame], DataFrame] | None:
    if not identity:
        return None
    return lambda rows: assign_surrogate_keys(
        rows, target, identity, [*keys, *[c for c in rows.columns if c not in keys and c != identity]]
    )


def scd2(
    target: DataFrame,
    source: DataFrame,
    roles: Columns,
    run_ts: Column,
    touch_unchanged: bool = False,
    compat: bool = False,
    numbered: Numbered = None,
) -> DataFrame:
    """Type 2 merge of one source into a versioned dimension.

    * a key the target has in no version is inserted as version 1;
    * a changed tracked column expires the current row (flag N, valid until just before the run,
      update time untouched) and adds the next version;
    * otherwise, a changed other column updates the current row in place. This needs every tracked
      column to be *equal*: a NULL tracked value blocks it;
    * a key with expired rows only is neither new nor current, so nothing happens to it.

    ``touch_unchanged`` gives the persistent-stage behaviour: without other columns the in-place
    branch still runs and refreshes the update time of every unchanged current row; the dimension
    skips it. Expired and new rows come out of the same pass over the target. Surrogate keys go on after those of
    ``numbered``, if the target is only a part of the table."""
    keys = list(roles.business_key)
    stamped = with_system_columns(source, roles, run_ts)
    columns = [c for c in target.columns if c != roles.surrogate_key]
    type1 = roles.type1(source.columns)
    # expired versions meet no source row and go around the join
    is_current = F.coalesce(F.col(roles.current_flag) == "Y", F.lit(False))
    current, earlier = target.filter(is_current), target.filter(~is_current)

    tracked_changed = any_of(value_changed(s(c), t(c), compat) for c in roles.tracked)
    tracked_equal = F.lit(True)
    for c in roles.tracked:
        tracked_equal = tracked_equal & F.coalesce(s(c) == t(c), F.lit(False))
    other_changed = any_of((value_changed(s(c), t(c), compat) for c in type1), empty=touch_unchanged)
    matched = F.coalesce(s("_matched"), F.lit(False))

    def typed(c: str, value: Column) -> Column:
        return value.cast(target.schema[c].dataType).alias(c)

    def old_row(changes: dict[str | None, Column]) -> Column:
        fields = [typed(c, changes.get(c, t(c))) for c in target.columns]
        return F.struct(*fields)

    kept_system = {roles.version, roles.start, roles.end, roles.created, roles.surrogate_key}
    expired = old_row({roles.current_flag: F.lit("N"), roles.end: just_before(run_ts)})
    updated = old_row(
        {c: (F.lit("Y") if c == roles.current_flag else s(c)) for c in columns if c in stamped.columns and c not in kept_system}
    )
    next_row = F.struct(
        *[
            typed(c, F.lit(None) if c == roles.surrogate_key else t(c) + 1 if c == roles.version else s(c) if c in stamped.columns else F.lit(None))
            for c in target.columns
        ]
    )
    outcome = (
        F.when(matched & tracked_changed, F.array(_with_new(expired, False), _with_new(next_row, True)))
        .when(matched & tracked_equal & other_changed, F.array(_with_new(updated, False)))
        .otherwise(F.array(_with_new(old_row({}), False)))
    )
    walked = _pair(current, stamped, keys).select(F.explode(outcome).alias("o"))
    initial = conform(_unmatched(stamped, target, keys), target)
    if not roles.surrogate_key:
        return walked.select("o.row.*").unionByName(initial).unionByName(earlier)
    kept = walked.filter(~F.col("o.new")).select("o.row.*").unionByName(earlier)
    added = walked.filter(F.col("o.new")).select("o.row.*").unionByName(initial)
    order = [*keys, roles.version, *[c for c in columns if c not in keys and c != roles.version]]
    return kept.unionByName(conform(assign_surrogate_keys(added, numbered or target, roles.surrogate_key, order), target))


def _with_new(row: Column, new: bool) -> Column:
    return F.struct(row.alias("row"), F.lit(new).alias("new"))

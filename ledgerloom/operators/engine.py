"""Level-by-level KPI evaluation for many scopes (say site x month) in one job.

A *scope* is one run of the formulas: one site in one month. The definition table belongs to the
site, the inputs to the scope. A value goes to the formulas that use it as soon as it is known: outside
values once, the results of a level after it. So each use of a value crosses the network once, however
many levels there are. Nothing is gathered per scope, so a scope, site or KPI with a large part of the
rows is spread like any other. The largest thing one task builds for one row is the operand map of one
formula."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.scalar import (
    engine_key,
    fiscal_month,
    fiscal_year,
    float_text,
    key_text,
    let,
    matrix_id,
    signed_fixed,
    sort_key,
    to_measure,
    trim_ws,
)
from ledgerloom.operators import formula as fx
from ledgerloom.operators.latest import keep_last
from ledgerloom.sources.durable import durable

# The log's reason and the columns of a result table.
MISSING_REASON = "Missing KPI dependency → 0"

# The place of a correction among a formula's values, and how many values are gathered at a time.
CORRECTION = -1
SLOTS = 16

RESULT_COLUMNS = (
    "kpi_engine_key", "matrix_id", "date_key", "fiscal_year", "fiscal_month", "kpi_id", "kpi_dim_id",
    "dim_name", "sort_key", "execution_level", "category", "subcategory", "kpi_name", "python_formula",
    "uom", "value", "resolved_formula", "source", "resolved_formula_names", "created_date", "created_by",
)


class EngineRun:
    """A run: ``results`` are evaluated when they are first asked for; the missing log, the skipped and unsupported
    definitions and ``rows`` (the keys of all results) need no evaluation."""

    def __init__(self, evaluate: Callable[[], DataFrame], rows: DataFrame, missing: DataFrame, skipped: DataFrame, unsupported: DataFrame) -> None:
        self._evaluate, self.rows, self.missing, self.skipped, self.unsupported = evaluate, rows, missing, skipped, unsupported

    @cached_property
    def results(self) -> DataFrame:
        return self._evaluate()


def prepare_definitions(master: DataFrame, site: Sequence[str] = ()) -> DataFrame:
    """Usable definitions: numeric level, active if the table says so, trimmed text, compiled formula."""
    level = F.col("execution_level").try_cast("double")
    rows = master.withColumn("execution_level", level).filter(level.isNotNull() & ~F.isnan(level))
    if "active" in master.columns:
        rows = rows.filter(F.col("active").try_cast("double") == 1)
    texts = [f.name for f in rows.schema.fields if f.dataType.simpleString() == "string" and f.name not in site]
    rows = rows.withColumns({c: trim_ws(c) for c in texts})
    return rows.withColumns(
        {
            "matrix_id": matrix_id("kpi_id", F.col("kpi_dim_id").cast("bigint")),
            "_key": matrix_id(key_text("kpi_id"), F.col("kpi_dim_id").cast("bigint")),
            "_code": fx.compiled("python_formula"),
        }
    )


def skipped_definitions(master: DataFrame) -> DataFrame:
    """Definitions without a usable execution level."""
    return master.filter(F.col("execution_level").try_cast("double").isNull())


def unsupported_definitions(master: DataFrame) -> DataFrame:
    """Definitions whose formula, or a part of it, counts as an error where a value is needed, with the reason in ``problem``.

    Blank formulas are not among them: they stand for inputs that are filled in from outside."""
    text = F.coalesce(trim_ws("python_formula"), F.lit(""))
    return master.filter(text != "").withColumn("problem", fx.problems(text)).filter("problem is not null")


def formula_with_names(definitions: DataFrame, names: DataFrame, site: Sequence[str] = (), order: str | None = None) -> DataFrame:
    """Add ``resolved_formula_names``: each KPI reference shown as its name in backticks.

    ``names`` has (site, kpi_id, kpi_name); the last name per id counts, unknown ids stay as they are."""
    last = keep_last(names.select(*site, "kpi_id", "kpi_name", *([order] if order else [])), [*site, "kpi_id"], [order or "kpi_name"])
    last = last.select(*site, F.col("kpi_id").alias("_id"), F.col("kpi_name").alias("_name"))
    keys = [*site, "_key"]
    ids = definitions.select(
        *keys, F.explode(F.array_distinct(F.transform(fx.references("python_formula", fx.KPI_REF), fx.kpi_of))).alias("_id")
    ).distinct()
    found = (
        ids.join(last, [*site, "_id"])
        .groupBy(*keys)
        .agg(F.map_from_entries(F.collect_list(F.struct("_id", "_name"))).alias("_names"))
    )

    def shown(ref: Column) -> Column:
        kpi = fx.kpi_of(ref)
        name = F.coalesce(F.try_element_at(F.col("_names"), kpi), kpi)
        return F.when(ref.startswith("K"), F.concat(F.lit("`"), name, F.lit("`"))).otherwise(ref)

    text = F.coalesce(fx.substituted(F.col("python_formula"), shown), F.lit(""))
    return definitions.join(found, keys, "left").withColumn("resolved_formula_names", text).drop("_names")


def run_levels(
    master: DataFrame,
    scopes: DataFrame,
    inputs: DataFrame,
    site: Sequence[str] = ("site_code",),
    period: str = "date_key",
    adjustments: DataFrame | None = None,
    base: DataFrame | None = None,
    dim_names: DataFrame | None = None,
    run_ts: Column | None = None,
    run_user: str = "",
    order: str | None = None,
    input_order: str | None = None,
    texts: bool = True,
) -> EngineRun:
    """Evaluate all formulas of ``master`` in every scope.

    ``master``  (site, kpi_id, kpi_dim_id, execution_level, category, subcategory, kpi_name, uom,
    python_formula, source); ``scopes`` (site, period); ``inputs`` (site, period, input_ref, value);
    ``adjustments`` (site, period, matrix_id, adjustment); ``base`` (site, period, kpi_id, kpi_dim_id,
    value) seeds KPIs the master does not define. ``order``/``input_order`` name a sequence column
    that decides between repeated definitions or inputs (the last one counts). Without ``texts``, the
    evaluated formula texts (``resolved_formula``) are not built and NULL.

    A reference sees the value of an earlier level; a KPI of the same or a later level reads 0.0. A
    KPI that is not in the master falls back to ``base``, then to an input of that name, then to 0
    with a row in the missing log. A missing input is 0.0 and not logged."""
    site = list(site)
    if not site:
        raise ValueError("formulas belong to a site: name at least one column that both master and scopes have")
    scope = [*site, period]
    run_ts = run_ts if run_ts is not None else F.current_timestamp()
    definitions, refs = _static_part(master, site, order)
    scopes = durable(scopes.select(*scope).distinct())
    outside = durable(_outside_values(inputs, base, scope, input_order))
    if adjustments is not None:
        # corrections of one key add up
        adjustments = adjustments.select(*scope, "matrix_id", F.col("adjustment").cast("double").alias("_adj")).groupBy(*scope, "matrix_id").agg(F.sum("_adj").alias("_adj"))

    def evaluate() -> DataFrame:
        results = _evaluated(definitions, refs, scopes, outside, adjustments, site, scope, texts)
        return _stamped(results, dim_names, site, period, run_ts, run_user)

    rows = definitions.select(*site, "matrix_id").join(scopes, site)
    missing = _missing_log(definitions, scopes, outside, site, scope)
    return EngineRun(evaluate, rows, missing, skipped_definitions(master), unsupported_definitions(master))


def _evaluated(
    definitions: DataFrame, refs: DataFrame, scopes: DataFrame, outside: DataFrame, adjustments: DataFrame | None, site: list[str], scope: list[str], texts: bool
) -> DataFrame:
    """All levels, each stored. ``uses`` are the stored (scope, consumer, place of the operand, value) rows of one source of
    values, in a folder per level of the consumer, so that a level reads its own only. The consumer's corrections are among
    them, in the place ``CORRECTION``."""
    widths = definitions.groupBy("execution_level").agg(F.max(F.size("_lookups"))).orderBy("execution_level").collect()
    if not widths:
        raise ValueError("no definition has a usable execution level")
    period = scope[-1]
    own = [F.col(c).cast((scopes if c == period else definitions).schema[c].dataType).alias(c) for c in scope]

    def stored(uses: DataFrame, *more: str) -> DataFrame:
        # a value without a period belongs to no scope
        return durable(uses.filter(F.col(period).isNotNull()).select(*own, "matrix_id", "_pos", *more, "_value", "_level"), partition_by=["_level"])

    def used(values: DataFrame, defined: bool, after: float | None = None) -> DataFrame:
        # a KPI of the master takes its value from the formulas only, anything else from outside only
        by = refs.filter(F.col("_defined") == defined)
        by = (by if after is None else by.filter(F.col("_level") > after)).drop("_defined")
        # a value that is NULL is an error like NaN, and no value at all is 0.0
        return stored(values.join(by, [*site, "_ref"]).withColumn("_value", F.coalesce("_value", F.lit(float("nan")))), "_ref")

    uses = [used(outside, False)]
    if adjustments is not None:
        known = definitions.select(*site, "matrix_id", F.col("execution_level").alias("_level")).distinct()
        given = adjustments.filter("_adj is not null").select(*scope, "matrix_id", F.lit(CORRECTION).alias("_pos"), F.col("_adj").alias("_value"))
        uses.append(stored(given.join(known, [*site, "matrix_id"])))
    result_columns = _result_columns(adjustments is not None, texts)
    working = ("_adj", "_bound", "_operands", "_code", "_outside", "_between", "_refs", "_shown", "_lookups")
    done: list[DataFrame] = []
    for level, width in widths:
        at_level = definitions.filter(F.col("execution_level") == level)
        every = at_level.select(*site, "matrix_id").distinct().join(scopes, site)
        rows = every.select(*scope, "matrix_id", F.lit(None).cast("int").alias("_pos"), F.lit(None).cast("double").alias("_value"), F.lit(True).alias("_here"))
        for u in uses:
            rows = rows.unionByName(u.filter(F.col("_level") == level).drop("_level", "_ref").withColumn("_here", F.lit(False)))
        bound = _gathered(rows, site, scope, width).join(at_level, [*site, "matrix_id"])
        done.append(durable(bound.withColumns(result_columns).drop(*working)))
        if level != widths[-1][0]:
            values = done[-1].filter("_last").select(*scope, F.col("_key").alias("_ref"), F.col("value").alias("_value"))
            uses.append(used(values, True, level))
    return reduce(DataFrame.unionByName, done)


def _gathered(rows: DataFrame, site: list[str], scope: list[str], width: int) -> DataFrame:
    """One row per scope and formula with its values: ``_bound`` has NULL where there is none, ``_operands`` 0.0 there and NULL
    for what is no number; ``_adj`` is the correction.

    Rows go to their site and formula, so that the definitions can meet them there without another shuffle. Values are
    gathered by hash, ``SLOTS`` at a time; only formulas with more need lists."""
    keys = [*scope, "matrix_id"]
    chunks = -(-width // SLOTS)
    slots = [F.max(F.when(F.col("_pos") == F.lit(i), F.col("_value"))).alias(f"_{i}") for i in range(width)]
    fixed = [F.max("_here").alias("_here"), F.max(F.when(F.col("_pos") == CORRECTION, F.col("_value"))).alias("_adj")]
    rows = rows.repartition(*site, "matrix_id")

    def usable(v: Column) -> Column:
        return F.when(v.isNull(), 0.0).when(~F.isnan(v) & (F.abs(v) != float("inf")), v)

    def array_of(values: list[Column]) -> Column:
        return F.array(*values).cast("array<double>")

    if chunks <= 1:
        found = rows.groupBy(*keys).agg(*fixed, *slots).filter("_here")
        names = [F.col(f"_{i}") for i in range(width)]
        return found.select(*keys, "_adj", array_of(names).alias("_bound"), array_of([usable(v) for v in names]).alias("_operands"))
    chunk = F.when(F.col("_pos") >= 0, F.floor(F.col("_pos") / SLOTS)).otherwise(0).cast("int")
    slots = [F.max(F.when(F.col("_pos") % SLOTS == i, F.when(F.col("_pos") >= 0, F.col("_value")))) for i in range(SLOTS)]
    parts = rows.groupBy(*keys, chunk.alias("_chunk")).agg(*fixed, array_of(slots).alias("_part"))
    found = (
        parts.groupBy(*keys)
        .agg(F.max("_here").alias("_here"), F.max("_adj").alias("_adj"), F.map_from_entries(F.collect_list(F.struct("_chunk", "_part"))).alias("_parts"))
        .filter("_here")
    )
    empty = array_of([F.lit(None)] * SLOTS)
    joined = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(chunks - 1)), lambda i: F.coalesce(F.try_element_at("_parts", i), empty)))
    return found.select(*keys, "_adj", joined.alias("_bound")).withColumn("_operands", F.transform("_bound", usable))


def _static_part(master: DataFrame, site: list[str], order: str | None) -> tuple[DataFrame, DataFrame]:
    """Definitions and their lookups, neither of which depends on the period: written once, read per level.

    ``_lookups`` are the references that a formula looks up; their places in it stand for them in ``_code``, ``_shown`` and
    the rows of lookups (site, consumer, level, place, reference).
    ``_last`` marks the definition that counts when a key is defined twice; ``_outside`` lists the
    KPI references that the master does not define. A reference to the same or a later level is
    0.0 in every scope and gets no lookup."""
    payload = ["category", "subcategory", "kpi_name", "uom", "python_formula", "source"]
    named = formula_with_names(prepare_definitions(master, site), master, site, order)
    rank = F.struct(*([order] if order else ["execution_level", "python_formula"]))
    keys = [*site, "_key"]
    newest = named.groupBy(*keys).agg(F.max(rank).alias("_top"), F.max_by("execution_level", rank).alias("_ref_level"))
    used = (
        named.select(*keys, "matrix_id", "execution_level", F.explode(F.transform(fx.references("python_formula"), fx.ref_key)).alias("_ref"))
        .distinct()
        .join(newest.select(*site, F.col("_key").alias("_ref"), "_ref_level"), [*site, "_ref"], "left")
    )
    undefined = F.col("_ref_level").isNull()
    used = used.filter(undefined | (F.col("_ref_level") < F.col("execution_level")))
    used = used.withColumn("_defined", ~undefined)
    consumer = [*site, "matrix_id", "execution_level"]
    # a reference is defined or not for the whole site, so it has one place
    places = durable(used.groupBy(*consumer).agg(F.sort_array(F.collect_set(F.struct("_ref", "_defined"))).alias("_places")))
    refs = places.select(*site, "matrix_id", F.col("execution_level").alias("_level"), F.posexplode("_places").alias("_pos", "_place"))
    refs = refs.select(*site, "matrix_id", "_level", "_pos", "_place._ref", "_place._defined")
    strange = (
        used.filter(~F.col("_defined") & F.col("_ref").startswith("K")).groupBy(*keys).agg(F.collect_set("_ref").alias("_outside"))
    )
    at = lambda ref: (F.array_position("_lookups", ref) - 1).cast("int")
    definitions = (
        named.join(newest.select(*keys, "_top"), keys)
        .withColumn("_last", rank.eqNullSafe(F.col("_top")))
        .withColumn("_between", fx.text_between("python_formula"))
        .withColumn("_refs", F.transform(fx.references("python_formula"), fx.ref_key))
        .join(strange, keys, "left")
        .join(places, consumer, "left")
        .withColumn("_lookups", F.coalesce(F.col("_places._ref"), F.array().cast("array<string>")))
        .withColumn("_code", fx.placed("_code", at))
        .withColumn("_shown", F.transform("_refs", lambda r: F.struct(at(r).alias("at"), F.when(F.array_contains("_outside", r), "0").otherwise("0.0").alias("zero"))))
        .select(
            *keys, "kpi_id", "kpi_dim_id", "matrix_id", "execution_level", *payload, "resolved_formula_names",
            "_code", "_last", "_outside", "_between", "_refs", "_shown", "_lookups",
        )
    )
    return durable(definitions), refs


def _outside_values(inputs: DataFrame, base: DataFrame | None, scope: list[str], order: str | None) -> DataFrame:
    """Values that do not come from formulas: inputs by upper-cased key, seeded KPIs before them."""
    value = F.col("value").try_cast("double").alias("_value")
    stacked = inputs.select(*scope, key_text("input_ref").alias("_ref"), value, F.lit(False).alias("_seed"), (F.col(order) if order else F.lit(0)).cast("bigint").alias("_order"))
    if base is not None:
        ref = matrix_id(key_text("kpi_id"), F.col("kpi_dim_id").cast("bigint")).alias("_ref")
        stacked = stacked.unionByName(base.select(*scope, ref, value, F.lit(True).alias("_seed"), F.lit(0).cast("bigint").alias("_order")))
    grouped = stacked.groupBy(*scope, "_ref")
    if order:
        return grouped.agg(F.max_by(F.struct("_value"), F.struct("_seed", "_order", "_value")).alias("_v")).select(*scope, "_ref", F.col("_v._value").alias("_value"))
    # plain numbers are aggregated by hash, structs by sorting
    if base is None:
        return grouped.agg(F.max("_value").alias("_value"))
    given, seeded = (F.max(F.when(F.col("_seed") == seed, F.col("_value"))) for seed in (False, True))
    return grouped.agg(F.when(F.max("_seed"), seeded).otherwise(given).alias("_value"))


def _operand_text(ref: Column) -> Column:
    return let(F.get("_bound", ref["at"]), lambda v: F.when(v.isNull(), ref["zero"]).otherwise(float_text(v)))


def _result_columns(adjusted: bool, texts: bool = True) -> dict[str, Column]:
    """``value`` and ``resolved_formula`` of a bound row. Built once per run: the trees are large."""
    if not texts:
        plain = F.when(F.coalesce(F.trim("python_formula") != "", F.lit(False)), fx.evaluate(F.col("_code"), lambda at: F.get("_operands", at), by_place=True)).otherwise(F.lit(0.0))
        return {"value": plain + F.coalesce("_adj", F.lit(0.0)) if adjusted else plain, "resolved_formula": F.lit(None).cast("string")}
    has_text = F.coalesce(F.trim("python_formula") != "", F.lit(False))
    computed = F.when(has_text, fx.evaluate(F.col("_code"), lambda at: F.get("_operands", at), by_place=True)).otherwise(F.lit(0.0))
    text = F.when(has_text, fx.rejoined(F.col("_between"), F.col("_shown"), _operand_text)).otherwise("")
    if not adjusted:
        return {"value": computed, "resolved_formula": text}
    mark = F.concat(signed_fixed("_adj"), F.lit(" [ADJ]"))
    marked = let(
        text,
        lambda shown: F.when(F.col("_adj").isNull(), shown)
        .when(shown == "", mark)
        .otherwise(F.concat(F.lit("("), shown, F.lit(") "), mark)),
    )
    return {"value": computed + F.coalesce("_adj", F.lit(0.0)), "resolved_formula": marked}


def _missing_log(definitions: DataFrame, scopes: DataFrame, outside: DataFrame, site: list[str], scope: list[str]) -> DataFrame:
    """One row per occurrence of a KPI reference that neither the master nor any outside value defines."""
    undefined = F.filter("_refs", lambda r: F.array_contains(F.col("_outside"), r))
    occurrences = definitions.filter("_outside is not null").select(*site, F.explode(undefined).alias("_ref"))
    return (
        occurrences.join(scopes, site)
        .join(outside.select(*scope, "_ref"), [*scope, "_ref"], "left_anti")
        .select(
            *scope,
            fx.kpi_of(F.col("_ref")).alias("kpi_id"),
            F.substring_index("_ref", "_", -1).cast("bigint").alias("kpi_dim_id"),
            F.lit(MISSING_REASON).alias("reason"),
        )
    )


def _stamped(results: DataFrame, dim_names: DataFrame | None, site: list[str], period: str, run_ts: Column, run_user: str) -> DataFrame:
    day = F.trunc(F.col(period).cast("date"), "MM")
    if dim_names is not None:
        # an id with several names has one of them: the greatest, as no sequence is given
        named = dim_names.groupBy(F.col("kpi_dim_id").cast("bigint").alias("_d")).agg(F.max(F.col("kpi_dim_name").cast("string")).alias("dim_name"))
        results = results.join(named, F.col("kpi_dim_id").cast("bigint") == F.col("_d"), "left").drop("_d")
    elif "dim_name" not in results.columns:
        results = results.withColumn("dim_name", F.lit(None).cast("string"))
    results = results.withColumns(
        {
            "kpi_engine_key": engine_key("matrix_id", day),
            "date_key": day,
            "fiscal_year": fiscal_year(day),
            "fiscal_month": fiscal_month(day),
            "sort_key": sort_key("kpi_id"),
            "value": to_measure("value"),
            "created_date": run_ts,
            "created_by": F.lit(run_user),
        }
    )
    return results.select(*site, *RESULT_COLUMNS)


def first_missing(run: EngineRun, n: int = 20) -> DataFrame:
    """The first missing references in key order, for display."""
    return run.missing.orderBy(*run.missing.columns).limit(n)


def run_summary(run: EngineRun) -> DataFrame:
    """Counts of calculated KPIs, missing references and skipped definitions."""
    parts = {"calculated": run.rows, "missing": run.missing, "skipped": run.skipped}
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(k).alias("metric"), "n") for k, df in parts.items()]
    return reduce(DataFrame.unionByName, counts)

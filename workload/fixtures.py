"""The provided tables re-skinned as KPI, ledger and warehouse tables, for Spark and for DuckDB.

Every fixture reads its table whole and grows with it: a supplier is a site, a month of ship dates a
period. In the plan table the return flag is the scenario (A actual, N budget, R forecast)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.scalar import engine_key, fiscal_month, fiscal_year, matrix_id, month_start
from ledgerloom.sources.durable import durable

REPORTING_MONTH = "1998-06-01"
AS_OF = "1998-06-30"
RUN_1 = "2024-01-01 00:00:00"
RUN_2 = "2024-02-01 00:00:00"
FIRST_LOAD = "1998-01-01"

# Fixed value: places for the lines of one split of the table (at most 128 MB unless the session says otherwise).
PLACES_PER_SPLIT = 8

MONEY = "decimal(18,2)"
KPIS = (
    # id, name, category, subcategory, uom, source, level
    ("K1", "Revenue", "Sales", "Gross", "USD", "ledger", 1.0),
    ("K2", "Quantity", "Volume", "Units", "EA", None, 1.0),
    ("K3", "Discount", "Sales", "Discount", "UOM", "Calculated from other KPIs", 2.0),
)


def money(c: str) -> Column:
    return F.col(c).cast(MONEY)


def as_date(text: str) -> Column:
    return F.lit(text).cast("date")


def as_ts(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def portable(df: DataFrame) -> DataFrame:
    """Plain result types: decimals as double, dates and times as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS")
        elif isinstance(f.dataType, T.NullType):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


class Tables:
    """Provided tables of one folder and the fixtures derived from them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        self.__dict__[name] = table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return table

    def stored(self, *names: str) -> Tables:
        """Write the named fixtures once; for queries that read them several times, as stored tables would be."""
        for name in names:
            self.__dict__[name] = durable(getattr(self, name))
        return self

    def _kpi_values(self, dim: Column, together: bool = False, **extra: Column) -> DataFrame:
        """``together`` brings all lines of a dim and month to one place before they are summed by the ``extra`` columns too:
        where few lines are equal in all of them, sums before the shuffle would save little and hold a task's lines in
        memory; and what groups the result by dim and month again needs no shuffle. The places are as many as the session's
        shuffles have, or more if the table has many splits, and are not merged: a place's sums are held in memory."""
        month = month_start("l_shipdate").alias("date_key")
        named = [c.alias(n) for n, c in extra.items()]
        sides = {"K1": "l_extendedprice", "K2": "l_quantity", "K3": "l_discount"}
        lines = self.lineitem.select(dim.alias("kpi_dim_id"), month, *named, *sides.values())
        if together:
            places = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), PLACES_PER_SPLIT * self.lineitem.rdd.getNumPartitions())
            lines = lines.repartition(places, "kpi_dim_id", "date_key")
        cells = lines.groupBy("kpi_dim_id", "date_key", *extra).agg(*[F.sum(money(c)).alias(k) for k, c in sides.items()])
        # a column of its own for each of a KPI's, picked by its place: what a query does not read is not summed or shuffled
        names = ("kpi_id", "kpi_name", "category", "subcategory", "uom", "source", "execution_level")
        kinds = {"execution_level": "double"}
        given = {n: F.array(*[F.lit(v).cast(kinds.get(n, "string")) for v in column]) for n, column in zip(names, zip(*KPIS))}
        given["value"] = F.array(*[F.col(k).cast("decimal(28,2)") for k in sides])
        flat = cells.select("*", F.explode(F.array(*[F.lit(i) for i in range(len(KPIS))])).alias("_kpi"))
        return flat.select("kpi_dim_id", "date_key", *extra, *[F.get(v, F.col("_kpi")).alias(n) for n, v in given.items()]).withColumns(
            {
                "matrix_id": matrix_id("kpi_id", "kpi_dim_id"),
                "kpi_engine_key": engine_key(matrix_id("kpi_id", "kpi_dim_id"), "date_key"),
                "fiscal_year": fiscal_year("date_key"),
                "fiscal_month": fiscal_month("date_key"),
                "dim_name": F.concat(F.lit("Site "), F.col("kpi_dim_id").cast("string")),
            }
        )

    @cached_property
    def engine_history(self) -> DataFrame:
        version = F.when(F.col("l_linestatus") == "F", 1).otherwise(2)
        return self._kpi_values(F.col("l_suppkey"), version_id=version)

    @cached_property
    def engine_output(self) -> DataFrame:
        return self._kpi_values(F.col("l_suppkey"))

    @staticmethod
    def _dim_text() -> Column:
        text = F.col("l_suppkey").cast("string")
        return F.when(F.col("l_discount") == 0, F.concat(F.lit("S"), text)).otherwise(text)

    @cached_property
    def actuals_historic(self) -> DataFrame:
        rows = self._kpi_values(self._dim_text())
        return rows.withColumnRenamed("matrix_id", "metric_id").withColumnRenamed("kpi_engine_key", "kpi_unique_id")

    @cached_property
    def budget_forecast(self) -> DataFrame:
        q = F.col("l_quantity")
        rows = self._kpi_values(
            self._dim_text(),
            together=True,
            scenario=F.when(F.col("l_returnflag") == "A", "Actual").when(F.col("l_returnflag") == "N", "Budgets").otherwise("Forecast"),
            version_id=F.when(q < 17, 1).when(q < 34, 2).otherwise(3),
        )
        return rows.withColumnRenamed("matrix_id", "metric_id").withColumnRenamed("kpi_engine_key", "kpi_unique_id")

    @cached_property
    def locations(self) -> DataFrame:
        place = self.nation.join(self.region, F.col("n_regionkey") == F.col("r_regionkey"))
        level = (
            F.when(F.col("r_name") == "AFRICA", "Location")
            .when(F.col("r_name") == "AMERICA", "Company")
            .when(F.col("r_name") == "ASIA", "Site")
            .when(F.col("r_name") == "EUROPE", "Zone")
        )
        return self.supplier.join(place, F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.col("s_suppkey").alias("kpi_dim_id"),
            F.col("s_name").alias("kpi_dim_name"),
            level.alias("Level"),
            F.concat(F.lit("C"), F.col("n_regionkey").cast("string")).alias("Company_Code"),
            F.col("r_name").alias("Company_Name"),
            F.col("n_name").alias("company_split"),
            F.col("n_name").alias("site_code"),
            F.col("s_name").alias("site_name"),
            F.when(F.col("s_acctbal") < 0, "Closed").otherwise("Open").alias("Type"),
        )

    @cached_property
    def calendar(self) -> DataFrame:
        day = month_start("o_orderdate")
        month = fiscal_month(day)
        return self.orders.select(
            day.alias("date"),
            fiscal_year(day).alias("fiscal_year"),
            month.alias("fiscal_month"),
            F.ceil(month / F.lit(3.0)).cast("int").alias("fiscal_quarter"),
            F.date_format(day, "MMMM").alias("month_name"),
        )

    @cached_property
    def value_adjustments(self) -> DataFrame:
        v = F.col("value")
        return self.engine_output.select(
            "kpi_engine_key",
            F.col("kpi_id").alias("kpi_reference"),
            F.col("kpi_dim_id").alias("location_column_id"),
            F.col("date_key").alias("month_date"),
            F.lit("ACTUAL").alias("scenario"),
            v.alias("original_value"),
            F.when(v > 50000, v + 100).when(v > 20000, F.lit(0)).cast("decimal(28,2)").alias("adjusted_value"),
            F.when(v > 50000, "late invoice").alias("adjustment_reason"),
        )

    @cached_property
    def variance_comments(self) -> DataFrame:
        return self.engine_output.select(
            "kpi_engine_key",
            F.col("date_key").alias("month_date"),
            F.when(F.col("value") > 20000, "above plan").otherwise("on plan").alias("variance_commentary"),
        )

    @cached_property
    def teams(self) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(t).alias("team_name")) for k, t in (("K1", "Finance"), ("K2", "Operations"))])
        return self.supplier.select("s_suppkey", F.explode(pairs).alias("p")).select(
            matrix_id("p.k", "s_suppkey").alias("kpi_matrix_id"), "p.team_name"
        )

    @cached_property
    def naming(self) -> DataFrame:
        return self.supplier.select(
            matrix_id(F.lit("K2"), "s_suppkey").alias("matrix_id"),
            F.lit("Volumes").alias("scr_category"),
            F.lit("").alias("scr_subcategory"),
            F.lit(None).cast("string").alias("scr_kpi_name"),
        )

    # --- formulas: one set of definitions per site, inputs per site and month ---------------

    @cached_property
    def definitions(self) -> DataFrame:
        rows = F.array(*[_literal_struct(d) for d in DEFINITIONS])
        return self.supplier.select(F.col("s_suppkey").alias("site_code"), F.explode(rows).alias("d")).select("site_code", "d.*")

    @cached_property
    def scopes(self) -> DataFrame:
        return self.lineitem.select(F.col("l_suppkey").alias("site_code"), month_start("l_shipdate").alias("date_key")).distinct()

    @cached_property
    def formula_inputs(self) -> DataFrame:
        """I1 price, I2 quantity, I3 discounts, I4 returned lines (absent where there are none); refs as typed by hand."""
        sums = self.lineitem.groupBy(F.col("l_suppkey").alias("site_code"), month_start("l_shipdate").alias("date_key")).agg(
            F.sum(money("l_extendedprice")).cast("double").alias("I1"),
            F.sum(money("l_quantity")).cast("double").alias("I2"),
            F.sum(money("l_discount")).cast("double").alias("I3"),
            F.sum(F.when(F.col("l_returnflag") == "R", 1)).cast("double").alias("I4"),
        )
        pairs = F.array(*[F.struct(F.lit(r).alias("input_ref"), F.col(c).alias("value")) for r, c in (("I1", "I1"), (" i2", "I2"), ("I3 ", "I3"), ("i4", "I4"))])
        return sums.select("site_code", "date_key", F.explode(pairs).alias("p")).select("site_code", "date_key", "p.*").filter(
            (F.col("input_ref") != "i4") | F.col("value").isNotNull()
        )

    # --- warehouse states -------------------------------------------------------------------

    def customer_state(self, before: str | None = None) -> DataFrame:
        """Per customer: latest order's priority (tracked) and number of orders, as known before a date."""
        rows = self.orders if before is None else self.orders.filter(F.col("o_orderdate") < F.lit(before).cast("timestamp_ntz"))
        return rows.groupBy(F.col("o_custkey").alias("cust_key")).agg(
            F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("last_priority"),
            F.count("*").alias("n_orders"),
        )

    def order_totals(self, status: str | None = None) -> DataFrame:
        rows = self.lineitem if status is None else self.lineitem.filter(F.col("l_linestatus") == status)
        return rows.groupBy(F.col("l_orderkey").alias("order_key")).agg(
            F.sum(money("l_extendedprice")).cast("decimal(28,2)").alias("amount"), F.count("*").alias("n_lines")
        )


# Definitions used by the formula queries: id, dim, level, name, formula.
DEFINITIONS = (
    ("K1", 1, "1", "Net", "I1 - I3"),
    ("K1", 2, "1", "Unit price", "I1 / I2"),
    ("K2", 1, "2", "Per return", "K1_1 / I4"),
    ("K2", 2, "2", "Forward", "K3_1 + K1_2 + 1"),
    ("K3", 1, "3", "Mix", "(K2_1 + K1_2) * 2 if K2_1 > 1000 else K9_9 + 5"),
    ("K3", 2, "3", "Spread", "max(K1_1, K2_1, 0) - min(K1_2, 3)"),
    ("K3", 3, "3", "Empty", " "),
    ("K4", 1, "n/a", "Unused", "K1_1 * 2"),
)


def _literal_struct(d: tuple) -> Column:
    kpi, dim, level, name, text = d
    return F.struct(
        F.lit(kpi).alias("kpi_id"), F.lit(dim).alias("kpi_dim_id"), F.lit(level).alias("execution_level"),
        F.lit("cat").alias("category"), F.lit("sub").alias("subcategory"), F.lit(name).alias("kpi_name"),
        F.lit("USD").alias("uom"), F.lit(text).alias("python_formula"), F.lit("model").alias("source"),
    )


# --- the same fixtures as SQL ---------------------------------------------------------------

_MONTH = "CAST(date_trunc('month', l_shipdate) AS DATE)"
_DIM_TEXT = "CASE WHEN l_discount = 0 THEN 'S' || CAST(l_suppkey AS VARCHAR) ELSE CAST(l_suppkey AS VARCHAR) END"


def _kpi_sql(dim: str, extra: str = "", names: str = "") -> str:
    def null_or_text(v):
        return "CAST(NULL AS VARCHAR)" if v is None else f"'{v}'"

    cells = (
        f"SELECT {dim} AS kpi_dim_id, {_MONTH} AS date_key{extra}, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS K1, "
        "SUM(CAST(l_quantity AS DECIMAL(18,2))) AS K2, SUM(CAST(l_discount AS DECIMAL(18,2))) AS K3 "
        "FROM lineitem GROUP BY ALL"
    )
    parts = [
        f"SELECT kpi_dim_id, date_key{names}, '{k}' AS kpi_id, '{n}' AS kpi_name, '{c}' AS category, '{s}' AS subcategory, "
        f"'{u}' AS uom, {null_or_text(src)} AS source, CAST({lv} AS DOUBLE) AS execution_level, CAST({k} AS DECIMAL(18,2)) AS value FROM cells"
        for k, n, c, s, u, src, lv in KPIS
    ]
    return f"""
      WITH cells AS ({cells}), flat AS ({' UNION ALL '.join(parts)}),
      keyed AS (SELECT *, kpi_id || '_' || CAST(kpi_dim_id AS VARCHAR) AS matrix_id FROM flat)
      SELECT *, sha256(matrix_id || '||' || CAST(date_key AS VARCHAR)) AS kpi_engine_key,
        CAST(year(date_key + INTERVAL 6 MONTH) AS INTEGER) AS fiscal_year,
        CAST(month(date_key + INTERVAL 6 MONTH) AS INTEGER) AS fiscal_month,
        'Site ' || CAST(kpi_dim_id AS VARCHAR) AS dim_name FROM keyed"""


_RENAMED = "SELECT * RENAME (matrix_id AS metric_id, kpi_engine_key AS kpi_unique_id) FROM"

CTES = {
    "engine_history": _kpi_sql("l_suppkey", ", CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS version_id", ", version_id"),
    "engine_output": _kpi_sql("l_suppkey"),
    "actuals_historic": f"{_RENAMED} ({_kpi_sql(_DIM_TEXT)})",
    "budget_forecast": f"{_RENAMED} ("
    + _kpi_sql(
        _DIM_TEXT,
        ", CASE l_returnflag WHEN 'A' THEN 'Actual' WHEN 'N' THEN 'Budgets' ELSE 'Forecast' END AS scenario"
        ", CASE WHEN l_quantity < 17 THEN 1 WHEN l_quantity < 34 THEN 2 ELSE 3 END AS version_id",
        ", scenario, version_id",
    )
    + ")",
    "locations": """
      SELECT s_suppkey AS kpi_dim_id, s_name AS kpi_dim_name,
        CASE r_name WHEN 'AFRICA' THEN 'Location' WHEN 'AMERICA' THEN 'Company' WHEN 'ASIA' THEN 'Site' WHEN 'EUROPE' THEN 'Zone' END AS loc_level,
        'C' || CAST(n_regionkey AS VARCHAR) AS company_code, r_name AS company_name, n_name AS company_split,
        n_name AS site_code, s_name AS site_name, CASE WHEN s_acctbal < 0 THEN 'Closed' ELSE 'Open' END AS loc_type
      FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "calendar": """
      SELECT d AS date, CAST(year(d + INTERVAL 6 MONTH) AS INTEGER) AS fiscal_year, CAST(month(d + INTERVAL 6 MONTH) AS INTEGER) AS fiscal_month,
        CAST(ceil(month(d + INTERVAL 6 MONTH) / 3.0) AS INTEGER) AS fiscal_quarter, monthname(d) AS month_name
      FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS d FROM orders)""",
    "value_adjustments": """
      SELECT kpi_engine_key, kpi_id AS kpi_reference, kpi_dim_id AS location_column_id, date_key AS month_date, 'ACTUAL' AS scenario,
        value AS original_value, CAST(CASE WHEN value > 50000 THEN value + 100 WHEN value > 20000 THEN 0 END AS DECIMAL(18,2)) AS adjusted_value,
        CASE WHEN value > 50000 THEN 'late invoice' END AS adjustment_reason FROM engine_output""",
    "variance_comments": """
      SELECT kpi_engine_key, date_key AS month_date, CASE WHEN value > 20000 THEN 'above plan' ELSE 'on plan' END AS variance_commentary
      FROM engine_output""",
    "teams": """
      SELECT 'K1_' || CAST(s_suppkey AS VARCHAR) AS kpi_matrix_id, 'Finance' AS team_name FROM supplier
      UNION ALL SELECT 'K2_' || CAST(s_suppkey AS VARCHAR), 'Operations' FROM supplier""",
    "naming": "SELECT 'K2_' || CAST(s_suppkey AS VARCHAR) AS matrix_id, 'Volumes' AS scr_category FROM supplier",
    "enriched": """
      SELECT o.*, l.loc_level AS location_level, l.company_code, l.company_split, l.site_code, l.site_name, l.loc_type AS mine_site_type
      FROM engine_output o LEFT JOIN locations l ON o.kpi_dim_id = l.kpi_dim_id""",
    "uoms": """
      SELECT kpi_id, MIN(uom) AS uom FROM (SELECT kpi_id, uom FROM engine_output UNION SELECT kpi_id, uom FROM actuals_historic
        UNION SELECT kpi_id, uom FROM budget_forecast) WHERE uom IS NOT NULL AND uom NOT IN ('UOM', 'UoM', '0') GROUP BY kpi_id""",
    "formula_values": f"""
      SELECT l_suppkey AS site_code, {_MONTH} AS date_key,
        CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS I1, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS I2,
        CAST(SUM(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS I3, CAST(COUNT(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) AS I4
      FROM lineitem GROUP BY ALL""",
    "state_1": f"""
      SELECT o_custkey AS cust_key, max_by(o_orderpriority, (o_orderdate, o_orderkey)) AS last_priority, COUNT(*) AS n_orders
      FROM orders WHERE o_orderdate < TIMESTAMP '{FIRST_LOAD}' GROUP BY 1""",
    "state_2": """
      SELECT o_custkey AS cust_key, max_by(o_orderpriority, (o_orderdate, o_orderkey)) AS last_priority, COUNT(*) AS n_orders
      FROM orders GROUP BY 1""",
    "totals_f": """
      SELECT l_orderkey AS order_key, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS amount, COUNT(*) AS n_lines
      FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1""",
    "totals_all": """
      SELECT l_orderkey AS order_key, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS amount, COUNT(*) AS n_lines
      FROM lineitem GROUP BY 1""",
}
_NEEDS = {
    "value_adjustments": ["engine_output"],
    "variance_comments": ["engine_output"],
    "enriched": ["engine_output", "locations"],
    "uoms": ["engine_output", "actuals_historic", "budget_forecast"],
}


def with_ctes(names: list[str], body: str, more: dict[str, str] | None = None) -> str:
    """``body`` with the named fixtures (and what they need), then further CTEs, in front."""
    wanted: list[str] = []
    for n in names:
        for need in [*_NEEDS.get(n, []), n]:
            if need not in wanted:
                wanted.append(need)
    parts = [f"{n} AS MATERIALIZED ({CTES[n]})" for n in wanted] + [f"{n} AS MATERIALIZED ({q})" for n, q in (more or {}).items()]
    return (f"WITH {', '.join(parts)} " if parts else "") + body


def typed(sql: str, double: str = "", text: str = "", ts: str = "", integer: str = "", bigint: str = "") -> str:
    """Wrap a query so that its columns have the portable result types."""
    casts = [f"CAST({c} AS DOUBLE) AS {c}" for c in double.split()]
    casts += [f"CAST({c} AS VARCHAR) AS {c}" for c in text.split()]
    casts += [f"CAST({c} AS INTEGER) AS {c}" for c in integer.split()]
    casts += [f"CAST({c} AS BIGINT) AS {c}" for c in bigint.split()]
    casts += [f"strftime({c}, '%Y-%m-%d %H:%M:%S.%g') AS {c}" for c in ts.split()]
    return f"SELECT * REPLACE ({', '.join(casts)}) FROM ({sql})" if casts else sql

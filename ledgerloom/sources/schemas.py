"""Declared schemas and column metadata."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.numbering import assign_surrogate_keys

if TYPE_CHECKING:
    from ledgerloom.sources.kept import NumberRange

INPUT_COLUMNS = ("input_ref", "source", "fin_period", "fin_year", "value")

# Columns and types of the two companion tables that a run creates empty.
AUDIT_TRAIL = (
    "audit_id string, event_type string, event_source string, kpi_reference string, location_column_id int, "
    "month_date string, scenario string, old_value double, new_value double, performed_by string, "
    "performed_at timestamp, details string, modify timestamp, status string, variance_commentary string, "
    "rationale string, location string, change_id int, metric string, modified_by string, comments string"
)
ANNOTATION = (
    "annotation_id string, kpi_reference string, location_column_id int, month_date string, scenario string, "
    "commentary string, team string, created_by string, created_at timestamp, is_deleted string, role string, "
    "modified timestamp, ann_id int, modified_by string"
)


def empty(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    """A typed frame without rows."""
    return spark.createDataFrame([], schema)


@dataclass(frozen=True)
class ColumnSpec:
    """One column of a loaded table: expression, type, constraints and its data tests.

    ``default`` replaces NULL in a NOT NULL column; ``tests`` maps a test name to a condition that
    must hold for every row."""

    name: str
    data_type: str
    expr: str | None = None
    nullable: bool = True
    default: str | None = None
    comment: str = ""
    tests: dict[str, str] = field(default_factory=dict)

    def struct_field(self) -> T.StructField:
        kind = T._parse_datatype_string(self.data_type)
        return T.StructField(self.name, kind, self.nullable, {"comment": self.comment} if self.comment else {})


def table_schema(columns: Sequence[ColumnSpec]) -> T.StructType:
    return T.StructType([c.struct_field() for c in columns])


def create_table(spark: SparkSession, columns: Sequence[ColumnSpec]) -> DataFrame:
    """An empty table with the declared types, nullability and comments."""
    return empty(spark, table_schema(columns))


def mapped(df: DataFrame, columns: Sequence[ColumnSpec]) -> DataFrame:
    """Project ``df`` on the declared columns: expression, type, default for NOT NULL, comment."""
    out = []
    for c in columns:
        value = F.expr(c.expr if c.expr is not None else f"`{c.name}`").cast(c.data_type)
        if not c.nullable and c.default is not None:
            value = F.coalesce(value, F.expr(c.default).cast(c.data_type))
        out.append(value.alias(c.name, metadata={"comment": c.comment}) if c.comment else value.alias(c.name))
    return df.select(*out)


def enforced(
    df: DataFrame, columns: Sequence[ColumnSpec], identity: str | None = None, numbers: NumberRange | None = None, order: Sequence[str] = ()
) -> DataFrame:
    """Rows as a table with these columns takes them: types, defaults, constraints, identity and comments.

    A missing column takes its DEFAULT, or NULL. NULL in a NOT NULL column becomes its DEFAULT; without one the row raises
    when it is written. The ``identity`` column is generated, in a range that ``numbers`` reserves and in ``order`` (of all
    other columns if none is given); values for it may not come with the rows."""
    if identity is not None:
        if numbers is None or identity in df.columns:
            raise ValueError(f"the identity column {identity} is generated from a NumberRange and cannot be given")
        names = list(order) or [c.name for c in columns if c.name in df.columns]
        df = assign_surrogate_keys(df, numbers.reserve, identity, names)
    out = []
    for c in columns:
        default = None if c.default is None else F.expr(c.default).cast(c.data_type)
        value = F.col(f"`{c.name}`").cast(c.data_type) if c.name in df.columns else F.lit(None).cast(c.data_type) if default is None else default
        if not c.nullable:
            last = default if default is not None else F.raise_error(F.lit(f"{c.name} must not be NULL")).cast(c.data_type)
            value = F.coalesce(value, last)
        out.append(value.alias(c.name, metadata={"comment": c.comment}) if c.comment else value.alias(c.name))
    return df.select(*out)

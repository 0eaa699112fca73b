"""Contract checks: catalog types, single-valued fields, frame schemas.

The value checks are DataFrames (one row per violation or per group) so they
run distributed; the schema check compares two ``StructType``s on the driver,
which is metadata only.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from keelson.functions.conform import CATALOG_TYPES


def type_violations(catalog: DataFrame, type_col: str = "data_type") -> DataFrame:
    """Catalog rows whose data type the pipeline does not accept (NULL included)."""
    ok = F.col(type_col).isin(*CATALOG_TYPES)
    return catalog.where(~F.coalesce(ok, F.lit(False)))


def single_value(df: DataFrame, group_cols: Sequence[str], value_col: str, normalise: bool = False) -> DataFrame:
    """Per group: how many distinct values ``value_col`` has and the value when it is the only one."""
    v = F.col(value_col)
    if normalise:
        v = F.upper(F.trim(v))
    n = F.count_distinct(v)
    return df.groupBy(*group_cols).agg(
        n.alias(f"n_{value_col}"),
        F.when(n == 1, F.min(v)).alias(value_col),
        (n == 1).alias(f"{value_col}_unique"),
    )


def schema_violations(df_schema: StructType, expected: StructType) -> list[tuple[str, str, str | None]]:
    """(column, expected type, actual type or None) for every missing or differently typed column."""
    actual = {f.name: f.dataType for f in df_schema.fields}
    out = []
    for f in expected.fields:
        got = actual.get(f.name)
        if got != f.dataType:
            out.append((f.name, f.dataType.simpleString(), None if got is None else got.simpleString()))
    return out


def assert_schema(df: DataFrame, expected: StructType) -> DataFrame:
    bad = schema_violations(df.schema, expected)
    if bad:
        raise ValueError(f"schema contract broken: {bad}")
    return df


def enforce_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Select exactly ``schema``'s columns, in order, cast to its types; a missing column is an error."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"frame lacks declared columns {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def schema_report(df: DataFrame, declared: StructType) -> DataFrame:
    """One row per declared column: declared type, the frame's type (NULL when missing), rows holding a value.

    The counts are one global aggregate (partial per task, merged once), unpivoted
    to one row per column, so nothing but the per-task partial counts is shuffled.
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    names = [f.name for f in declared.fields]
    counts = df.agg(*[(F.count(F.col(n)) if n in actual else F.lit(0).cast("bigint")).alias(n) for n in names])
    long = counts.unpivot([], names, "column_name", "non_null_rows")
    declared_type = F.create_map(*[x for f in declared.fields for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))])
    actual_type = F.create_map(*[x for n in names for x in (F.lit(n), F.lit(actual.get(n)).cast("string"))])
    return long.select(
        "column_name",
        declared_type[F.col("column_name")].alias("declared_type"),
        actual_type[F.col("column_name")].alias("actual_type"),
        "non_null_rows",
    )

"""The tag catalog: which raw tag of which source table becomes which typed column.

A catalog row is eight texts (CSV header order below). The catalog is plan
metadata -- a few hundred rows per hull -- so plan building reads it on the
driver (``catalog_rows``), validates it *before* any data plan is built, and
derives from it the per-source projections and the wide table schema. The
same derivations also exist as DataFrames (``source_priority``,
``wide_schema_frame``) for fleet-wide catalogs.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from keelson.functions.conform import CATALOG_TYPES, spark_type
from keelson.functions.derive import HULL_RULES, declared_columns

# Catalog CSV columns in header order.
CATALOG_COLUMNS = ("hnum", "col_name", "db_name", "table_name", "tag", "description", "unit", "data_type")
CATALOG_SCHEMA = StructType([StructField(c, StringType(), True) for c in CATALOG_COLUMNS])

# Keywords ranking source tables, highest priority first; ties by table name.
SOURCE_KEYWORDS = ("cams", "ias", "ams", "vdr")


@dataclass(frozen=True)
class Tag:
    hnum: str
    col_name: str
    db_name: str
    table_name: str
    tag: str
    description: str | None
    unit: str | None
    data_type: str


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Read catalog CSV file(s) (UTF-8, optional BOM, header). A malformed row fails the read."""
    return (
        spark.read.schema(CATALOG_SCHEMA)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .option("encoding", "UTF-8")
        .csv(path)
    )


def catalog_rows(catalog: DataFrame) -> list[Tag]:
    """Collect a (small, per-hull) catalog for plan building."""
    return [Tag(**{c: r[c] for c in CATALOG_COLUMNS}) for r in catalog.select(*CATALOG_COLUMNS).collect()]


def validate(tags: Sequence[Tag]) -> str:
    """Check one catalog file: one hull, one database, accepted types, unique names. Returns the hull."""
    if not tags:
        raise ValueError("empty tag catalog")
    incomplete = [t.col_name for t in tags
                  if not all((t.hnum, t.col_name, t.db_name, t.table_name, t.tag, t.data_type))]
    if incomplete:
        raise ValueError(f"catalog rows lack a hull, name, database, table, tag or type: {incomplete[:10]}")
    hulls = {t.hnum.strip().upper() for t in tags}
    if len(hulls) != 1:
        raise ValueError(f"a catalog must describe exactly one hull, found {sorted(hulls)}")
    dbs = {t.db_name for t in tags}
    if len(dbs) != 1:
        raise ValueError(f"all sources of a hull must live in one database, found {sorted(map(str, dbs))}")
    bad = [(t.col_name, t.data_type) for t in tags if t.data_type not in CATALOG_TYPES]
    if bad:
        raise ValueError(f"unsupported data types {bad}")
    counts = Counter(t.col_name for t in tags)
    dup = sorted(n for n, k in counts.items() if k > 1)
    if dup:
        raise ValueError(f"duplicate column names {dup}")
    return hulls.pop()


def priority_key(table_name: str) -> tuple:
    return tuple(k not in table_name for k in SOURCE_KEYWORDS) + (table_name,)


def ordered_sources(tags: Sequence[Tag]) -> list[tuple[str, list[Tag]]]:
    """Source tables in priority order with their tags (catalog order kept within a table)."""
    tables = sorted({t.table_name for t in tags}, key=priority_key)
    return [(name, [t for t in tags if t.table_name == name]) for name in tables]


def priority_order(col: Column) -> list[Column]:
    return [col.contains(k).desc() for k in SOURCE_KEYWORDS] + [col.asc()]


def source_priority(catalog: DataFrame, keys: Iterable[str] = ("hnum",), table_col: str = "table_name") -> DataFrame:
    """Distinct source tables per hull with their 1-based priority."""
    keys = list(keys)
    tables = catalog.select(*keys, table_col).distinct()
    w = Window.partitionBy(*keys).orderBy(*priority_order(F.col(table_col)))
    return tables.withColumn("priority", F.row_number().over(w))


def wide_schema(tags: Sequence[Tag], hull: str | None = None, derived: bool = True) -> StructType:
    """Raw table schema: ds_timestamp, then catalog + derived columns by name, then id_<source> in priority order."""
    hull = hull or validate(tags)
    body = [(t.col_name, t.data_type) for t in tags] + (declared_columns(hull) if derived else [])
    clash = sorted(n for n, k in Counter(n for n, _ in body).items() if k > 1)
    if clash:
        raise ValueError(f"catalog columns {clash} collide with columns the hull derives")
    fields = [StructField("ds_timestamp", TimestampNTZType(), True)]
    fields += [StructField(n, spark_type(d), True) for n, d in sorted(body)]
    fields += [StructField(f"id_{name}", LongType(), True) for name, _ in ordered_sources(tags)]
    return StructType(fields)


def wide_schema_frame(catalog: DataFrame, hull_col: str = "hnum") -> DataFrame:
    """Per hull, the raw table's column list: (hnum, position, column_name, data_type).

    Position 0 is the time column, then catalog and derived columns by name, then
    one lineage id per source in priority order -- numbered by a single window
    per hull over all three groups. A hull's rows are its table's columns, so
    each window group is bounded by the table width.
    """
    spark = catalog.sparkSession
    hulls = catalog.select(hull_col).distinct()
    derived_rows = [(h, n, d) for h in HULL_RULES for n, d in declared_columns(h)]
    derived = spark.createDataFrame(derived_rows, f"{hull_col} string, column_name string, data_type string")
    no_flags = [F.lit(False).alias(f"__k{i}") for i in range(len(SOURCE_KEYWORDS))]
    ts = hulls.select(hull_col, F.lit(0).alias("__grp"), *no_flags, F.lit("ds_timestamp").alias("column_name"),
                      F.lit("TIMESTAMP").alias("data_type"))
    body = (catalog.select(hull_col, F.col("col_name").alias("column_name"), "data_type")
            .unionByName(derived.join(hulls, hull_col, "left_semi"))
            .select(hull_col, F.lit(1).alias("__grp"), *no_flags, "column_name", "data_type"))
    tables = catalog.select(hull_col, "table_name").distinct()
    ids = tables.select(
        hull_col, F.lit(2).alias("__grp"),
        *[F.col("table_name").contains(k).alias(f"__k{i}") for i, k in enumerate(SOURCE_KEYWORDS)],
        F.concat(F.lit("id_"), F.col("table_name")).alias("column_name"), F.lit("BIGINT").alias("data_type"))
    order = [F.col("__grp").asc(), *[F.col(f"__k{i}").desc() for i in range(len(SOURCE_KEYWORDS))],
             F.col("column_name").asc(), F.col("data_type").asc()]
    w = Window.partitionBy(hull_col).orderBy(*order)
    rows = ts.unionByName(body).unionByName(ids)
    return rows.select(hull_col, (F.row_number().over(w) - 1).alias("position"), "column_name", "data_type")

"""Table and database helpers (DDL) over the session catalog."""

from __future__ import annotations

import logging
from typing import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

log = logging.getLogger(__name__)


def _columns_ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)


def database_exists(spark: SparkSession, name: str) -> bool:
    """Case-insensitive, surrounding blanks ignored."""
    return spark.catalog.databaseExists(name.strip())


def create_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    partition_cols: Sequence[str] = (),
    location: str | None = None,
    properties: dict[str, str] | None = None,
) -> None:
    """CREATE TABLE IF NOT EXISTS ... USING parquet (partition columns must be part of ``schema``)."""
    sql = f"CREATE TABLE IF NOT EXISTS {name} ({_columns_ddl(schema)}) USING parquet"
    if partition_cols:
        sql += f" PARTITIONED BY ({', '.join(partition_cols)})"
    if location:
        sql += f" LOCATION '{location}'"
    if properties:
        sql += " TBLPROPERTIES (" + ", ".join(f"'{k}' = '{v}'" for k, v in properties.items()) + ")"
    spark.sql(sql)


# Writer settings of the curated tables (Parquet, Snappy, 256 MiB target files).
CURATED_PROPERTIES = {
    "parquet.compression": "SNAPPY",
    "write.sort.order": "ds_timestamp",
    "write.target-file-size-bytes": "268435456",
}


# Table properties of curated tables in a table format that supports MERGE.
TABLE_FORMAT_PROPERTIES = {
    "format-version": "2",
    "write.format.default": "parquet",
    "write.parquet.compression-codec": "snappy",
    "write.target-file-size-bytes": "268435456",
}


def _create_format_table(spark: SparkSession, name: str, schema: StructType, provider: str) -> None:
    """Empty table in a MERGE-capable format with hidden yearly partitioning on ds_timestamp.

    Needs the format's catalog on the session (not available in this repository's
    test environment, so this branch is untested here).
    """
    from pyspark.sql.functions import partitioning

    if spark.catalog.tableExists(name):
        return
    writer = spark.createDataFrame([], schema).writeTo(name).using(provider)
    writer = writer.partitionedBy(partitioning.years("ds_timestamp"))
    for k, v in (TABLE_FORMAT_PROPERTIES if provider == "iceberg" else {}).items():
        writer = writer.tableProperty(k, v)
    writer.create()


def create_raw_table(spark: SparkSession, name: str, tags, location: str | None = None, hull: str | None = None,
                     partition_col: str = "ds_month", provider: str = "parquet") -> StructType:
    """Wide raw table of a hull from its tag catalog. Returns its schema.

    ``parquet``: plus the monthly partition column (copy-on-write upserts);
    ``iceberg`` / ``delta``: hidden yearly partitioning, upserted with MERGE.
    """
    from pyspark.sql.types import IntegerType, StructField

    from keelson.sources.tagcatalog import wide_schema

    schema = wide_schema(tags, hull)
    if provider != "parquet":
        _create_format_table(spark, name, schema, provider)
        return schema
    full = StructType([*schema.fields, StructField(partition_col, IntegerType(), True)])
    create_table(spark, name, full, [partition_col], location, CURATED_PROPERTIES)
    return schema


def create_calc_table(spark: SparkSession, name: str, location: str | None = None,
                      partition_col: str = "ds_month", provider: str = "parquet") -> StructType:
    from pyspark.sql.types import IntegerType, StructField

    from keelson.plans.jobs import CALC_SCHEMA

    if provider != "parquet":
        _create_format_table(spark, name, CALC_SCHEMA, provider)
        return CALC_SCHEMA
    full = StructType([*CALC_SCHEMA.fields, StructField(partition_col, IntegerType(), True)])
    create_table(spark, name, full, [partition_col], location, CURATED_PROPERTIES)
    return CALC_SCHEMA


def list_tables(spark: SparkSession, db: str, prefix: str) -> list[str]:
    """Tables of ``db`` named ``<prefix>_...`` (the separator keeps hull H1 from matching H10's tables)."""
    return [t.name for t in spark.catalog.listTables(db, f"{prefix.strip().lower()}_*")]


def drop_with_storage(spark: SparkSession, table: str) -> bool:
    """Drop a table and the files at its location (DROP alone keeps those of a LOCATION table)."""
    from keelson.sources.storage import delete_path, table_location

    if not spark.catalog.tableExists(table):
        return False
    location = table_location(spark, table)
    spark.sql(f"DROP TABLE {table}")
    delete_path(spark, location)
    return True


def clear_hull(spark: SparkSession, db: str, hull: str) -> list[str]:
    """Drop every table of ``db`` named ``<hull>_...`` with its files. Returns the dropped names."""
    names = list_tables(spark, db, hull)
    for n in names:
        drop_with_storage(spark, f"{db}.{n}")
    return names


def drop_tables(spark: SparkSession, db: str, names: Sequence[str]) -> list[str]:
    """DROP TABLE ... PURGE per table; a failure is logged and the next table is tried."""
    failed = []
    for n in names:
        try:
            spark.sql(f"DROP TABLE IF EXISTS {db}.{n} PURGE")
        except Exception as exc:  # keep going, report at the end
            log.error("dropping %s.%s failed: %s", db, n, exc)
            failed.append(n)
    return failed


# Column types an external table over frame output may declare.
EXTERNAL_TYPES = ("float", "double", "tinyint", "smallint", "int", "bigint", "boolean", "timestamp_ntz", "string")


def create_external_table(
    spark: SparkSession, db: str, name: str, schema: StructType, location: str, partition: str = "dt INT"
) -> None:
    """External Parquet table over ``location`` with one partition column.

    Column types are kept as they are (64-bit integers stay BIGINT); a type outside
    ``EXTERNAL_TYPES`` is an error rather than a silently missing column.
    """
    bad = [(f.name, f.dataType.simpleString()) for f in schema.fields if f.dataType.simpleString() not in EXTERNAL_TYPES]
    if bad:
        raise ValueError(f"unsupported column types for an external table: {bad}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {db}.{name} ({_columns_ddl(schema)}, {partition}) USING parquet "
        f"PARTITIONED BY ({partition.split()[0]}) LOCATION '{location}'"
    )


def add_partition(spark: SparkSession, table: str, spec: dict, location: str) -> None:
    """Register one partition folder and refresh the table's file listing."""
    spec_sql = ", ".join(f"{k} = {v!r}" if isinstance(v, str) else f"{k} = {v}" for k, v in spec.items())
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec_sql}) LOCATION '{location}'")
    spark.catalog.refreshTable(table)


def add_partitions(
    spark: SparkSession, table: str, partitions: Sequence[tuple[dict, str]], layout: StructType | None = None
) -> None:
    """Register partition folders, (values, location) each, in one statement.

    ``layout``: the physical columns of their files, noted beside the table for readers by position, who then open no
    footer to learn them (``sources.scans.read_table_by_position``).
    """
    from keelson.sources.storage import declare_layout, spec_key, table_location

    if not partitions:
        return
    cols = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if layout is not None:
        if set(layout.names) & set(cols):
            raise ValueError(f"partition columns {sorted(set(layout.names) & set(cols))} are not columns of files")
        declare_layout(spark, table_location(spark, table), [spec_key(cols, values) for values, _ in partitions], layout)
    quoted = lambda v: "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(v, str) else str(v)
    added = " ".join(
        f"PARTITION ({', '.join(f'`{c}` = {quoted(values[c])}' for c in cols)}) LOCATION '{location}'" for values, location in partitions
    )
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {added}")
    spark.catalog.refreshTable(table)


def create_or_replace_view(spark: SparkSession, name: str, select_sql: str) -> None:
    """Persistent view over catalog tables (``select_sql`` must reference catalog tables only)."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {select_sql}")


def add_columns(spark: SparkSession, table: str, schema: StructType) -> None:
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({_columns_ddl(schema)})")


def drop_columns(spark: SparkSession, table: str, names: Sequence[str]) -> None:
    """Declare an external Parquet table anew without some columns.

    The files stay as they are; read by name, what is no longer declared is not read.
    """
    from keelson.sources.storage import table_location

    schema = spark.table(table).schema
    unknown = [n for n in names if n not in schema.names]
    if unknown:
        raise ValueError(f"table {table} has no columns {unknown}")
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    if not any(r["col_name"] == "Type" and r["data_type"] == "EXTERNAL" for r in details):
        raise ValueError(f"table {table} owns its files: dropping it would delete them")
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if set(parts) & set(names):
        raise ValueError(f"partition columns {sorted(set(parts) & set(names))} cannot be dropped")
    location = table_location(spark, table)
    left = StructType([f for f in schema.fields if f.name not in set(names)])
    spark.sql(f"DROP TABLE {table}")
    create_table(spark, table, left, parts, location)
    if parts:
        spark.sql(f"MSCK REPAIR TABLE {table}")

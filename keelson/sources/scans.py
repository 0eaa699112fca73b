"""Source scans: date-range reads, typed per-source projections, column resolution.

Sources are ordinary tables (or any DataFrame); a ``ds_date`` partition column
makes the inclusive date-range predicate a partition filter, and the typed
projection selects only catalogued tags, so Parquet reads just those columns.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampNTZType, TimestampType

from keelson.functions.conform import epoch_ms, typed_tag
from keelson.sources.storage import declared_layouts, partition_locations, table_location
from keelson.sources.tagcatalog import Tag

TableReader = Callable[[str], DataFrame]


def table_reader(spark: SparkSession, db_name: str | None = None) -> TableReader:
    """Resolve a source table name through the session catalog."""
    return lambda name: spark.table(f"{db_name}.{name}" if db_name else name)


def date_range(df: DataFrame, start: str | None, end: str | None, date_col: str = "ds_date") -> DataFrame:
    """Rows whose 'yyyyMMdd' text date lies in [start, end], both ends included (None: no bound)."""
    if start is not None:
        df = df.where(F.col(date_col) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(date_col) <= F.lit(end))
    return df


def day_bounds(start: str | None, end: str | None) -> tuple[Column | None, Column | None]:
    """'yyyyMMdd' start / end days -> [start 00:00, day after end 00:00) as zone-less timestamps."""
    def midnight(day: str, after: int) -> Column:
        at = dt.datetime.strptime(day, "%Y%m%d") + dt.timedelta(days=after)
        return F.lit(at.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return (None if start is None else midnight(start, 0)), (None if end is None else midnight(end, 1))


def half_open(df: DataFrame, start: str | None, end: str | None, ts_col: str = "ds_timestamp") -> DataFrame:
    """Rows with start 00:00 <= ts < (end + 1 day) 00:00 (None: no bound)."""
    lo, hi = day_bounds(start, end)
    if lo is not None:
        df = df.where(F.col(ts_col) >= lo)
    if hi is not None:
        df = df.where(F.col(ts_col) < hi)
    return df


def project_source(
    raw: DataFrame,
    tags: Sequence[Tag],
    id_col: str,
    time_col: str = "ds_timestamp",
    keep: Iterable[str] = (),
    typed: bool = True,
) -> DataFrame:
    """Renamed projection of one source: epoch-ms id, kept columns, one column per catalog tag.

    Tags are cast to their catalog types, or left as they are stored with ``typed=False`` (``cast_tags``
    then casts what a later step keeps).

    Raw column names are quoted, so a tag holding a dot or a blank is read as one column.
    """
    time_type = raw.schema[time_col].dataType if time_col in raw.columns else None
    if isinstance(time_type, (TimestampType, TimestampNTZType)):  # a real timestamp, not epoch-ms text
        raw_ms = F.unix_millis(_raw_col(time_col).cast("timestamp"))
    else:
        raw_ms = epoch_ms(_raw_col(time_col))
    cols = [raw_ms.alias(id_col), *[_raw_col(c) for c in keep]]
    cols += [(typed_tag(_raw_col(t.tag), t.data_type) if typed else _raw_col(t.tag)).alias(t.col_name) for t in tags]
    return raw.select(*cols)


def cast_tags(df: DataFrame, tags: Sequence[Tag]) -> DataFrame:
    """Cast the catalog columns of an untyped projection."""
    kinds = {t.col_name: t.data_type for t in tags}
    return df.select(*[typed_tag(F.col(c), kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns])


def _raw_col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def scan_source(
    read: TableReader,
    table_name: str,
    tags: Sequence[Tag],
    start: str | None,
    end: str | None,
    keep: Iterable[str] = (),
    date_col: str = "ds_date",
    typed: bool = True,
) -> DataFrame | None:
    """Catalog-driven range scan of one source; ``None`` when the catalog lists no tag for it.

    A reader with a ``between(table, start, end)`` of its own may leave out rows it knows to lie
    outside the days (its date column is computed, say, so the filter on it cannot reach the files).
    """
    if not tags:
        return None
    between = getattr(read, "between", None)
    raw = date_range(between(table_name, start, end) if between else read(table_name), start, end, date_col)
    return project_source(raw, tags, id_col=f"id_{table_name}", keep=keep, typed=typed)


def jdbc_source(
    spark: SparkSession,
    url: str,
    query: str,
    fetchsize: int = 50_000,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A SQL result from an external database as a partitioned DataFrame.

    Rows arrive ``fetchsize`` at a time per task; with a numeric
    ``partition_column`` and bounds the query is split into ``num_partitions``
    parallel range reads instead of one connection.
    """
    if partition_column and (lower_bound is None or upper_bound is None):
        raise ValueError(f"partition column {partition_column} needs a lower and an upper bound")
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", fetchsize)
    if partition_column:
        reader = (reader.option("dbtable", f"({query}) q").option("partitionColumn", partition_column)
                  .option("lowerBound", lower_bound).option("upperBound", upper_bound)
                  .option("numPartitions", num_partitions or spark.sparkContext.defaultParallelism))
    else:
        reader = reader.option("query", query)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def read_by_name(spark: SparkSession, paths: Sequence[str], schema: StructType) -> DataFrame:
    """Parquet files resolved by column name: declared columns a file lacks read as NULL,
    file columns that are not declared are ignored."""
    return spark.read.schema(schema).parquet(*paths)


def read_by_position(
    spark: SparkSession,
    folders: Sequence[str],
    schema: StructType,
    base_path: str | None = None,
    layouts: Mapping[str, StructType] | None = None,
    partition_fields: Sequence[StructField] = (),
) -> DataFrame:
    """Parquet partition folders resolved by column *position* against ``schema``.

    The i-th declared column takes the i-th physical column of a folder's files
    (positions a layout lacks read as NULL). Folders are grouped by physical
    layout and each layout is read with one multi-path scan, so the plan has one
    scan per distinct layout, not one per partition. ``layouts`` names the
    physical columns of folders; of a folder it lacks, a footer is read. With
    ``base_path`` the partition columns (e.g. ``dt=2``) are discovered from the
    folder names, of the types of ``partition_fields`` where given.
    """
    known = layouts or {}
    groups: dict[str, tuple[StructType, list[str]]] = {}
    for folder in folders:
        layout = known.get(folder)
        if layout is None:
            layout = spark.read.parquet(folder).schema
        groups.setdefault(layout.json(), (layout, []))[1].append(folder)
    frames = []
    for layout, group in groups.values():
        reader = spark.read.option("basePath", base_path) if base_path else spark.read
        df = reader.schema(StructType([*layout.fields, *partition_fields])).parquet(*group)
        physical = layout.names
        partition_cols = [c for c in df.columns if c not in physical]
        cols = [
            (_raw_col(physical[i]) if i < len(physical) else F.lit(None)).cast(f.dataType).alias(f.name)
            for i, f in enumerate(schema.fields)
        ]
        frames.append(df.select(*cols, *partition_cols))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def read_table_by_position(spark: SparkSession, table: str) -> DataFrame:
    """A partitioned Parquet table of the catalog, its declared columns resolved by position in every partition.

    The catalog says where the partitions are (their folders named as partitions are, ``dt=2``), the layouts noted
    when they were added which physical columns their files have: one scan per distinct layout, and no footer is read
    on the driver but of partitions added without a layout. A filter on the partition columns prunes each scan.
    """
    declared = spark.table(table).schema
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    known = declared_layouts(spark, table_location(spark, table))
    folders: dict[str, list[str]] = {}
    layouts = {}
    for key, location in partition_locations(spark, table, parts).items():
        base, *named = location.rstrip("/").rsplit("/", len(parts))
        if [n.partition("=")[0] for n in named] != parts:
            raise ValueError(f"partition {key} of {table} is at {location}, which does not name it")
        folders.setdefault(base, []).append(location)
        if key in known:
            layouts[location] = known[key]
    if not folders:
        return spark.table(table).limit(0)
    plain = StructType([f for f in declared.fields if f.name not in parts])
    fields = [declared[c] for c in parts]
    frames = [read_by_position(spark, group, plain, base, layouts, fields) for base, group in folders.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out

"""Hulls with unlike catalogs in one job: the catalog is data, joined to the readings.

A hull's tags, their types, its source tables and their priority differ from hull to hull, and a source table may
serve one hull or many (it then has a hull column). Per source table one scan keeps its catalogued tags as one array
of texts and cuts it to the first reading of each (hull, bucket). Only then the catalog is joined, as one row per
hull and table that says where in that array each canonical column stands; columns are picked by place, cast by type.

The hulls' base sources differ too, so alignment is no chain of joins: all tables' first readings are united, and one
grouped aggregation by (hull, bucket) puts them side by side. A column comes from one table of a hull, so its maximum
is its value; a group holds at most one row per table of the hull, and is combined before the shuffle.

The driver sees the catalog's distinct (table, tag, column, type), which are the plan's columns, and no hull by hull
list but for hulls that derive columns (``HULL_RULES``).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from keelson.functions.conform import CATALOG_TYPES, spark_type, typed_tag
from keelson.functions.derive import HULL_RULES, declared_columns, rules_for
from keelson.operators.catalog_sync import normalise_hull
from keelson.operators.resample import first_per_bucket
from keelson.operators.upsert import upsert_table
from keelson.plans.jobs import PARTITION_COL, calc, with_partition
from keelson.session import prepare
from keelson.sources.scans import TableReader, date_range, project_source
from keelson.sources.storage import read_stored
from keelson.sources.tagcatalog import CATALOG_COLUMNS, priority_key, source_priority

#: A table's layout (one row per hull, eight bytes a column) is broadcast up to this size. Beyond it the planner joins
#: by hull, and a hot hull relies on AQE's split of skewed partitions.
LAYOUT_BYTES = 16 << 20

_REQUIRED = tuple(c for c in CATALOG_COLUMNS if c not in ("description", "unit"))


def validate_fleet(catalog: DataFrame) -> None:
    """Raise if a hull's catalog is incomplete, repeats a column, mixes databases or clashes with what the hull
    derives, or if hulls give one column different types (one table holds them all). Aggregations over the catalog."""
    def refuse(rows: DataFrame, why: str) -> None:
        bad = rows.limit(5).collect()
        if bad:
            raise ValueError(f"{why}: {[tuple(r) for r in bad]}")

    empty = F.lit(False)
    for c in _REQUIRED:
        empty = empty | F.coalesce(F.trim(c) == "", F.lit(True))
    refuse(catalog.where(empty).select("hnum", "col_name"), "catalog rows lack a hull, name, database, table, tag or type")
    refuse(catalog.where(~F.col("data_type").isin(*CATALOG_TYPES)).select("col_name", "data_type").distinct(),
           "unsupported data types")
    refuse(catalog.groupBy("hnum", "col_name").count().where("count > 1").select("hnum", "col_name"),
           "duplicate column names")
    refuse(catalog.groupBy("hnum").agg(F.count_distinct("db_name").alias("n")).where("n > 1"),
           "all sources of a hull must live in one database")
    own: dict[str, set[str]] = {}
    for r in catalog.where(F.col("hnum").isin(*HULL_RULES)).select("hnum", "col_name").collect():
        own.setdefault(r["hnum"], set()).add(r["col_name"])
    for hull, names in own.items():
        clash = sorted(names & {n for n, _ in declared_columns(hull)})
        if clash:
            raise ValueError(f"catalog columns {clash} collide with columns hull {hull} derives")
        missing = sorted({n for rule in rules_for(hull) for n in rule.inputs} - names)
        if missing:
            raise ValueError(f"derived columns of {hull} need missing columns {missing}")


def _columns(plan: Sequence, hulls: Sequence[str]) -> dict[str, str]:
    """The fleet table's columns with their types: the catalogs', and what the hulls that have rules derive."""
    pairs = {(r["col_name"], r["data_type"]) for r in plan}
    pairs |= {pair for hull in hulls for pair in declared_columns(hull)}
    kinds: dict[str, str] = {}
    for name, kind in sorted(pairs):
        if kinds.setdefault(name, kind) != kind:
            raise ValueError(f"hulls give column {name!r} different types: {kinds[name]} and {kind}")
    return kinds


def _layout(catalog: DataFrame, priority: DataFrame, table: str, tags: list[str], names: list[str]) -> DataFrame:
    """Per hull of a table: its priority, the hull's number of tables, and where each of names stands in tags (from 1)."""
    listed = F.array(*[F.lit(t) for t in tags])
    place = [F.array_position(listed, F.try_element_at("__tag_of", F.lit(n))).cast("int") for n in names]
    of = catalog.where(F.col("table_name") == table).groupBy("hnum").agg(
        F.map_from_entries(F.collect_list(F.struct("col_name", "tag"))).alias("__tag_of"))
    rank = priority.where(F.col("table_name") == table).select("hnum", "priority", "n_sources")
    return of.join(rank, "hnum").select(F.col("hnum").alias("__hull"), "priority", "n_sources", F.array(*place).alias("__places"))


def _first_readings(
    read: TableReader, catalog: DataFrame, priority: DataFrame, table: str, plan: Sequence, kinds: dict[str, str],
    n_hulls: int, start: str | None, end: str | None, every: int | str, tiebreak: Sequence[str], hull_col: str,
) -> DataFrame:
    """One table's first reading per (hull, bucket): hnum, ds_timestamp, priority, n_sources, id and all of kinds."""
    tags = sorted({r["tag"] for r in plan if r["table_name"] == table})
    names = sorted({r["col_name"] for r in plan if r["table_name"] == table})
    between = getattr(read, "between", None)
    raw = date_range(between(table, start, end) if between else read(table), start, end)
    missing = sorted(set(tags) - set(raw.columns))
    if missing:
        raise ValueError(f"source {table} lacks catalogued tags {missing[:10]}")
    shared = hull_col in raw.columns
    if not shared and n_hulls != 1:
        raise ValueError(f"source {table} has no hull column, but {n_hulls} hulls list it")
    layout = _layout(catalog, priority, table, tags, names)
    only = None if shared else layout.first()  # one row, as wide as the table
    hull = F.upper(F.trim(hull_col)) if shared else F.lit(only["__hull"])
    raw = raw.withColumn("__hnum", hull).withColumn(
        "__texts", F.array(*[F.col("`" + t.replace("`", "``") + "`").cast("string") for t in tags]))
    src = project_source(raw, [], id_col="id", keep=["__hnum", "__texts", *tiebreak])
    first = first_per_bucket(src, every, time_col="id", keys=["__hnum"], tiebreak=tiebreak or None,
                             drop_tiebreak=bool(tiebreak))
    if shared:
        small = n_hulls * (8 * len(names) + 64) <= LAYOUT_BYTES
        placed = first.join(F.broadcast(layout) if small else layout, F.col("__hnum") == F.col("__hull"))
    else:
        placed = first.withColumns({"priority": F.lit(only["priority"]), "n_sources": F.lit(only["n_sources"])})

    def value(name: str) -> Column:
        if name not in names:
            return F.lit(None).cast(spark_type(kinds[name]))
        place = names.index(name)
        at = F.get(F.col("__places"), F.lit(place)) if shared else F.lit(only["__places"][place])
        return typed_tag(F.get(F.col("__texts"), at - 1), kinds[name])

    return placed.select(F.col("__hnum").alias("hnum"), "ds_timestamp", "priority", "n_sources", "id",
                         *[value(n).alias(n) for n in kinds])


def fleet_raw(
    read: TableReader,
    catalog: DataFrame,
    start: str | None = None,
    end: str | None = None,
    every: int | str = "15 seconds",
    tiebreak: Sequence[str] = (),
    how: str = "left",
    derive: bool = True,
    hull_col: str = "hnum",
) -> DataFrame:
    """The raw wide frame of every hull of a catalog, for days [start, end] ('yyyyMMdd', inclusive; None: no bound).

    Columns: hnum, ds_timestamp, the union of the hulls' catalog and derived columns by name (NULL where a hull has no
    such column), id_source_1.. with the reading time of the hull's first, second, ... source by priority.

    ``how="left"`` keeps every bucket of a hull's own base source, ``how="inner"`` those that all its sources have.
    Readings without a readable time form a NULL bucket of the base source alone, and none under "inner". Hull ids are
    compared trimmed and in upper case; readings of hulls (or of no hull) that do not list the table are left out.
    A value that is stored as another type than text is read as its text. Readings tied on time are ordered by
    ``tiebreak``, else by all tagged texts. An invalid catalog is an error before any reading is touched.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, not {how!r}")
    prepare(catalog.sparkSession)
    catalog = normalise_hull(catalog.select(*CATALOG_COLUMNS))
    validate_fleet(catalog)
    plan = catalog.select("table_name", "tag", "col_name", "data_type").distinct().collect()  # the plan's columns
    if not plan:
        raise ValueError("empty tag catalog")
    ruled = sorted(r["hnum"] for r in catalog.where(F.col("hnum").isin(*HULL_RULES)).select("hnum").distinct().collect())
    kinds = _columns(plan, ruled if derive else [])
    priority = source_priority(catalog)
    priority = priority.join(priority.groupBy("hnum").agg(F.max("priority").alias("n_sources")), "hnum")
    most = priority.agg(F.max("priority")).first()[0]
    n_hulls = {r["table_name"]: r["n_hulls"]
               for r in priority.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_hulls")).collect()}
    tables = sorted({r["table_name"] for r in plan}, key=priority_key)
    united = None
    for table in tables:
        one = _first_readings(read, catalog, priority, table, plan, kinds, n_hulls[table], start, end, every,
                              tiebreak, hull_col)
        united = one if united is None else united.unionByName(one)
    # A NULL time equals no other: only the base source keeps its NULL bucket, and only in a left alignment.
    timed = F.col("ds_timestamp").isNotNull()
    united = united.where(timed if how == "inner" else timed | (F.col("priority") == 1))
    ids = [f"id_source_{i}" for i in range(1, most + 1)]
    aligned = united.groupBy("hnum", "ds_timestamp").agg(
        F.min("priority").alias("__base"), F.count(F.lit(1)).alias("__found"), F.max("n_sources").alias("__all"),
        *[F.max(c).alias(c) for c in kinds],
        *[F.max(F.when(F.col("priority") == i, F.col("id"))).alias(name) for i, name in enumerate(ids, 1)],
    )
    kept = aligned.where(F.col("__base") == 1 if how == "left" else F.col("__found") == F.col("__all"))
    return (_derived(kept, ruled) if derive else kept).select("hnum", "ds_timestamp", *kinds, *ids)


def _derived(df: DataFrame, hulls: Sequence[str]) -> DataFrame:
    """Each hull's own rules on its own rows; the rows of other hulls keep what they have in that column."""
    made: dict[str, Column] = {}
    for hull in hulls:
        for rule in rules_for(hull):
            value = rule.expr().cast(spark_type(rule.data_type))
            made[rule.name] = F.when(F.col("hnum") == hull, value).otherwise(made.get(rule.name, F.col(rule.name)))
    return df.withColumns(made) if made else df


def load_fleet(
    spark: SparkSession,
    read: TableReader,
    catalog: DataFrame,
    raw_path: str,
    calc_path: str,
    start: str | None = None,
    end: str | None = None,
    every: int | str = "15 seconds",
    tiebreak: Sequence[str] = (),
) -> None:
    """Load the fleet's days into its raw table, then their calc rows, both stored by hull and month.

    The stored raw table gains the columns of hulls that are new to it. Rows without a time are not loaded. Like
    ``run_hull`` a load may be repeated: rows are matched by hull and time.
    """
    keys, part = ["hnum", "ds_timestamp"], ["hnum", PARTITION_COL]
    raw = fleet_raw(read, catalog, start, end, every, tiebreak).where(F.col("ds_timestamp").isNotNull())
    upsert_table(spark, with_partition(raw), keys, path=raw_path, partition_cols=part, evolve=True)
    types = StructType([StructField("hnum", StringType()), StructField(PARTITION_COL, IntegerType())])
    stored = read_stored(spark, raw_path, types)
    if stored is None:  # nothing was ever loaded
        return
    if start is not None:
        stored = stored.where(F.col(PARTITION_COL) >= int(start[:6]))
    if end is not None:
        stored = stored.where(F.col(PARTITION_COL) <= int(end[:6]))
    upsert_table(spark, with_partition(calc(stored, start, end, keys=["hnum"])), keys, path=calc_path, partition_cols=part)

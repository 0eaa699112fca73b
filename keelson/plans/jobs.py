"""Jobs: the raw wide table, the calc table, and one hull's end-to-end run.

``build_raw`` is one lazy plan: per source a catalog-driven range scan and
typed projection, first row per bucket, then the left-join chain in source
priority, schema enforcement and the hull's derived columns. ``calc`` turns a
raw table into true wind, Beaufort class and fuel totals for a day window.
``run_hull`` writes both through the key-based upsert.
"""

from __future__ import annotations

import logging
from typing import Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, IntegerType, StructField, StructType, TimestampNTZType

from keelson.functions.derive import add_derived
from keelson.functions.wind import beaufort, fuel_total, true_wind_angle_raw, true_wind_speed_raw, true_wind_vector
from keelson.operators.align import align_left
from keelson.operators.contract import enforce_schema
from keelson.operators.resample import first_per_bucket
from keelson.operators.upsert import upsert_table
from keelson.session import prepare
from keelson.sources.scans import TableReader, cast_tags, half_open, scan_source
from keelson.sources.storage import read_stored
from keelson.sources.tagcatalog import Tag, ordered_sources, validate, wide_schema

# Raw-table columns the calc table reads.
CALC_INPUTS = {
    "rel_speed": "vdr_relative_wind_speed",
    "rel_angle": "vdr_relative_wind_angle",
    "sog": "vdr_aivdo_sog",
    "me_fo": "me_fo_flow",
    "ge_fo": "ge_fo_flow",
    "auxb_fo": "auxb_fo_flow",
    "me_fg": "me_fg_flow",
    "ge_fg": "ge_fg_flow",
}

CALC_SCHEMA = StructType([
    StructField("ds_timestamp", TimestampNTZType(), True),
    StructField("true_wind_speed", FloatType(), True),
    StructField("true_wind_angle", FloatType(), True),
    StructField("beaufort_number", IntegerType(), True),
    StructField("foc", FloatType(), True),
    StructField("fgc", FloatType(), True),
])

PARTITION_COL = "ds_month"

log = logging.getLogger(__name__)


def resampled_sources(
    read: TableReader,
    tags: Sequence[Tag],
    start: str | None = None,
    end: str | None = None,
    every: int | str = "15 seconds",
    keys: Iterable[str] = (),
    tiebreak: Sequence[str] = (),
    warn_empty: bool = False,
    counts: dict[str, Observation] | None = None,
) -> list[DataFrame]:
    """Per source in priority order: range scan, typed projection, first row per bucket.

    A source without catalogued tags is skipped at plan time. ``warn_empty`` logs a
    warning for every source with no rows in the window (one small job per source);
    an empty source still flows through the plan. ``counts`` gets an observation per
    source: its readings in the window, and those without a readable time, counted by
    the job that runs the plan while it reads them.
    """
    keys, tiebreak = list(keys), list(tiebreak)
    frames = []
    for table, table_tags in ordered_sources(tags):
        # With tie-break columns the pick needs no values: only the rows it keeps are cast.
        src = scan_source(read, table, table_tags, start, end, keep=[*keys, *tiebreak], typed=not tiebreak)
        if src is None:
            log.warning("source %s has no catalogued tags; skipped", table)
            continue
        prepare(src.sparkSession)  # epoch -> timestamp conversions assume a UTC session
        if warn_empty and src.isEmpty():
            log.warning("source %s has no rows between %s and %s", table, start, end)
        if counts is not None:
            counts[table] = Observation(f"readings of {table}")
            src = src.observe(counts[table], *_reading_counts(table))
        # Without explicit tie-break columns, readings tied on the millisecond are
        # ordered by all their values (deterministic whole-row pick).
        first = first_per_bucket(src, every, time_col=f"id_{table}", keys=keys, tiebreak=tiebreak or None,
                                 drop_tiebreak=bool(tiebreak))
        frames.append(cast_tags(first, table_tags) if tiebreak else first)
    return frames


def _reading_counts(table: str) -> list:
    return [F.count(F.lit(1)).alias("readings"), F.count_if(F.col(f"id_{table}").isNull()).alias("no_time")]


def _observed(counts: Observation) -> dict | None:
    """What the job counted; None if Spark left the source out of the plan while it ran (nothing of it was joined)."""
    try:
        return counts.get
    except Py4JJavaError:
        return None


def build_raw(
    read: TableReader,
    tags: Sequence[Tag],
    start: str | None = None,
    end: str | None = None,
    every: int | str = "15 seconds",
    keys: Iterable[str] = (),
    tiebreak: Sequence[str] = (),
    derive: bool = True,
    how: str = "left",
    warn_empty: bool = False,
    counts: dict[str, Observation] | None = None,
) -> DataFrame:
    """The hull's raw wide frame for days [start, end] ('yyyyMMdd', inclusive; None: no bound).

    ``how="left"`` keeps every bucket of the base (highest-priority) source;
    ``how="inner"`` keeps only buckets that every source has.
    """
    keys = list(keys)
    hull = validate(tags)
    frames = resampled_sources(read, tags, start, end, every, keys, tiebreak, warn_empty, counts)
    aligned = align_left(frames, on=[*keys, "ds_timestamp"], how=how)
    full = wide_schema(tags, hull, derived=derive)
    base = StructType([f for f in full.fields if f.name in aligned.columns])
    typed = enforce_schema(aligned, StructType([*_key_fields(aligned, keys), *base.fields]))
    if not derive:
        return typed
    derived = add_derived(typed, hull)
    return enforce_schema(derived, StructType([*_key_fields(aligned, keys), *full.fields]))


def _key_fields(df: DataFrame, keys: Sequence[str]) -> list[StructField]:
    return [df.schema[k] for k in keys]


def calc(raw: DataFrame, start: str | None = None, end: str | None = None, keys: Iterable[str] = (), inputs: dict[str, str] | None = None) -> DataFrame:
    """Calc rows for raw rows with start 00:00 <= ds_timestamp < (end + 1 day) 00:00 (None: no bound)."""
    keys = list(keys)
    names = {**CALC_INPUTS, **(inputs or {})}
    missing = sorted(set(names.values()) - set(raw.columns))
    if missing:
        raise ValueError(f"calc needs raw columns {missing} (unknown hull or incomplete catalog?)")
    window = half_open(raw, start, end)
    v_x, v_y = true_wind_vector(names["rel_speed"], names["rel_angle"], names["sog"])
    speed = true_wind_speed_raw(v_x, v_y)
    return window.select(
        *keys,
        "ds_timestamp",
        speed.cast("float").alias("true_wind_speed"),
        true_wind_angle_raw(v_x, v_y).cast("float").alias("true_wind_angle"),
        beaufort(speed).alias("beaufort_number"),
        fuel_total(names["me_fo"], names["ge_fo"], names["auxb_fo"]).alias("foc"),
        fuel_total(names["me_fg"], names["ge_fg"]).alias("fgc"),
    )


def with_partition(df: DataFrame, ts_col: str = "ds_timestamp") -> DataFrame:
    """Monthly partition value (yyyyMM) of the time key: a month of one hull is one
    right-sized file group, and an upsert rewrites only the months it touches."""
    return df.withColumn(PARTITION_COL, F.date_format(F.col(ts_col), "yyyyMM").cast("int"))


def run_hull(
    spark: SparkSession,
    read: TableReader,
    tags: Sequence[Tag],
    start: str | None = None,
    end: str | None = None,
    raw_path: str | None = None,
    calc_path: str | None = None,
    every: int | str = "15 seconds",
    tiebreak: Sequence[str] = (),
    *,
    raw_table: str | None = None,
    calc_table: str | None = None,
    clear: bool = False,
    keys: Iterable[str] = (),
    table_format: str = "parquet",
    evolve: bool = False,
) -> dict[str, int]:
    """Load days [start, end] ('yyyyMMdd', inclusive; None: no bound) of one hull -- or, with
    ``keys=("hnum",)``, of every hull sharing the tag list, in one job.

    Upserts the raw table, then rebuilds the calc rows of the window from the
    stored raw table. Targets are Parquet folders (``raw_path`` / ``calc_path``)
    or catalog tables (``raw_table`` / ``calc_table``), partitioned by the keys
    and the month. ``clear`` first drops both targets -- off by default, it
    deletes stored history. ``table_format="iceberg"`` (or ``"delta"``) declares the
    catalog tables in that format -- hidden yearly partitioning, loaded with MERGE --
    when the session has that format's catalog.

    ``evolve`` adds columns that the catalog gained to the stored raw table (a catalog that
    lost some leaves them as stored). Partitions of Parquet catalog tables are swapped by
    location, so readers see a month's old or new rows at any moment.

    Returns, per source table, the readings of the window without a readable time: they
    are not loaded, are counted before the resample folds them, by the load's own scan,
    and are logged. A source without any reading in the window is logged too.
    """
    keys = list(keys)
    part = [*keys, PARTITION_COL]
    upsert_keys = [*keys, "ds_timestamp"]
    if (raw_path is None) == (raw_table is None) or (calc_path is None) == (calc_table is None):
        raise ValueError("give a path or a table for both the raw and the calc target")
    prepare(spark)
    validate(tags)  # an invalid catalog fails before any plan is built or anything is written
    if clear:
        _clear_target(spark, raw_path, raw_table)
        _clear_target(spark, calc_path, calc_table)
    if not keys:  # single-hull catalog tables are declared from the catalog up front (IF NOT EXISTS)
        from keelson.plans.tables import create_calc_table, create_raw_table
        if raw_table is not None:
            create_raw_table(spark, raw_table, tags, provider=table_format)
        if calc_table is not None:
            create_calc_table(spark, calc_table, provider=table_format)
    counts: dict[str, Observation] = {}
    raw = build_raw(read, tags, start, end, every, keys=keys, tiebreak=tiebreak, counts=counts)
    raw = raw.where(F.col("ds_timestamp").isNotNull())
    in_place = table_format == "parquet"  # other formats commit by themselves
    upsert_table(spark, with_partition(raw), upsert_keys, path=raw_path, table=raw_table, partition_cols=part,
                 evolve=evolve, by_location=raw_table is not None and in_place)
    lost = {}
    for source, observed in counts.items():
        found = _observed(observed) or unloaded_readings(read, [t for t in tags if t.table_name == source], start, end).first()
        lost[source] = found["no_time"]
        if not found["readings"]:
            log.warning("source %s has no rows between %s and %s", source, start, end)
        if found["no_time"]:
            log.warning("source %s: %d readings without a readable time are not loaded", source, found["no_time"])
    if raw_path:
        types = StructType([*_key_fields(raw, keys), StructField(PARTITION_COL, IntegerType(), True)])
        stored = read_stored(spark, raw_path, types)
        if stored is None:  # nothing was ever loaded
            return lost
    else:
        stored = spark.table(raw_table)
    if PARTITION_COL in stored.columns:  # Parquet targets: prune to the window's months (table formats prune by ts)
        if start is not None:
            stored = stored.where(F.col(PARTITION_COL) >= int(start[:6]))
        if end is not None:
            stored = stored.where(F.col(PARTITION_COL) <= int(end[:6]))
    upsert_table(spark, with_partition(calc(stored, start, end, keys=keys)), upsert_keys, path=calc_path,
                 table=calc_table, partition_cols=part, by_location=calc_table is not None and in_place)
    return lost


def unloaded_readings(
    read: TableReader, tags: Sequence[Tag], start: str | None = None, end: str | None = None
) -> DataFrame:
    """Per source table of the catalog: its readings in the window, and those without a readable time."""
    rows = None
    for table, table_tags in ordered_sources(tags):
        src = scan_source(read, table, table_tags, start, end)
        if src is None:
            continue
        prepare(src.sparkSession)
        one = src.agg(F.lit(table).alias("table_name"), *_reading_counts(table))
        rows = one if rows is None else rows.unionByName(one)
    if rows is None:
        raise ValueError("the catalog lists no source with tags")
    return rows


def _clear_target(spark: SparkSession, path: str | None, table: str | None) -> None:
    """Drop a target with its stored files. What cannot be removed is an error: half-cleared history would be kept."""
    from keelson.plans.tables import drop_with_storage
    from keelson.sources.storage import delete_path

    if table is not None:
        drop_with_storage(spark, table)
    else:
        delete_path(spark, path)


def sync_catalog_file(spark: SparkSession, csv_path: str, catalog_path: str) -> str | list[str]:
    """Bring the stored catalog (Parquet, partitioned by hull) in line with catalog CSV file(s).

    ``csv_path`` is one file or a folder of files. Every file must describe exactly
    one hull (compared trimmed and upper-cased) -- checked by one aggregation over
    the files' rows, per source file. Each hull's stored rows are replaced by its
    file's rows (absent keys deleted, the rest upserted with their ids kept) and
    every other hull is untouched. Returns the hull id (one file) or the sorted
    hull ids (several files).
    """
    from keelson.operators.catalog_sync import normalise_hull, sync_catalog_path
    from keelson.sources.tagcatalog import CATALOG_COLUMNS, read_catalog

    prepare(spark)
    raw = read_catalog(spark, csv_path)
    with_file = normalise_hull(raw.select(*CATALOG_COLUMNS, F.col("_metadata.file_path").alias("__file")))
    per_file = with_file.groupBy("__file").agg(F.count_distinct("hnum").alias("n"), F.min("hnum").alias("hull"))
    bad = per_file.where(F.col("n") != 1).limit(5).collect()
    if bad:
        raise ValueError(f"a catalog file must describe exactly one hull: {[(r['__file'], r['n']) for r in bad]}")
    hulls = sorted(r["hull"] for r in per_file.select("hull").distinct().collect())  # one per file: bounded
    if not hulls:
        raise ValueError("no catalog rows found")
    sync_catalog_path(spark, with_file.drop("__file"), catalog_path)
    return hulls[0] if len(hulls) == 1 else hulls

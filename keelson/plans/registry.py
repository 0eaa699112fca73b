"""Registered queries over the driver tables, and their DuckDB oracle SQL.

Every query reads whole driver tables (``events`` or ``customer``) through the
adapter in ``keelson.sources.testbed`` and runs one library operator or job.
The oracle SQL computes the same result independently in DuckDB; column names
and types are kept identical on both sides.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.functions.derive import add_derived
from keelson.functions.timebucket import bucket_text, floor_ms, text_to_ms
from keelson.functions.wind import beaufort, true_wind_angle_raw, true_wind_speed_raw, true_wind_vector
from keelson.operators.align import align_first_inner, align_left
from keelson.operators.catalog_sync import absent_keys, sync_catalog
from keelson.operators.contract import single_value, type_violations
from keelson.operators.resample import first_per_bucket, first_row
from keelson.operators.upsert import merge_frames, upsert_table
from keelson.plans.jobs import build_raw, calc, unloaded_readings
from keelson.sources import testbed as tb
from keelson.sources.scans import date_range, half_open, project_source
from keelson.sources.tagcatalog import Tag, source_priority, wide_schema, wide_schema_frame

QueryFn = Callable[[SparkSession, str], DataFrame]

EVENT_TYPES = list(tb.EVENT_SOURCES)  # base first
HOUR_MS, MINUTE_MS, QUARTER_MIN_MS = 3_600_000, 60_000, 15_000
RANGE_START, RANGE_END = "20240105", "20240112"
TARGET_END, SOURCE_START = "20240120", "20240115"
CALC_START, CALC_END = "20240110", "20240120"


def _tag(tag: str, name: str, dtype: str) -> Tag:
    return Tag("H0000", name, "ev", "events", tag, None, None, dtype)


GENERIC_TAGS = [_tag("value_txt", "value", "FLOAT"), _tag("flag_txt", "flag", "BOOLEAN")]
PROJECTION_TAGS = [
    _tag("value_txt", "value", "FLOAT"),
    _tag("value_txt", "value_d", "DOUBLE"),
    _tag("user_txt", "user_i", "INTEGER"),
    _tag("angle_txt", "angle", "FLOAT"),
    _tag("sog_txt", "sog", "FLOAT"),
]


# ----------------------------------------------------------------------------------------------
# Spark side
# ----------------------------------------------------------------------------------------------

def _conformed(spark: SparkSession, sf: str, tags=GENERIC_TAGS, start=None, end=None) -> DataFrame:
    raw = tb.raw_readings(spark, sf, start, end)
    return project_source(raw, tags, id_col="id_source", keep=["source", "seq", "ds_date"])


def _resampled(spark: SparkSession, sf: str, every_ms: int, start=None, end=None) -> DataFrame:
    conf = _conformed(spark, sf, start=start, end=end).drop("ds_date")
    return first_per_bucket(conf, every_ms, time_col="id_source", keys=["source"], tiebreak=["seq"], drop_tiebreak=True)


def q_resample_first_15s(spark, sf):
    """First reading per (event type, 15 s bucket), whole row, ties by event id."""
    return _resampled(spark, sf, QUARTER_MIN_MS)


def q_resample_first_1h(spark, sf):
    """First reading per (event type, 1 h bucket) -- most buckets hold several readings."""
    return _resampled(spark, sf, HOUR_MS)


def q_first_in_minute(spark, sf):
    """row_number() first-in-minute per (source, ds_date, minute) with the minute text and its epoch ms."""
    conf = _conformed(spark, sf).withColumn("__b", floor_ms("id_source", MINUTE_MS))
    first = first_row(conf, ["source", "ds_date", "__b"], ["id_source", "seq"])
    minute = bucket_text(F.col("__b"))
    return first.select("source", "ds_date", minute.alias("minute"), text_to_ms(minute).alias("ds_timestamp"),
                        "id_source", "value", "flag")


def q_range_scan(spark, sf):
    """Typed readings of an inclusive 'yyyyMMdd' day range."""
    conf = date_range(_conformed(spark, sf, start=RANGE_START, end=RANGE_END), RANGE_START, RANGE_END)
    return conf.select("source", "ds_date", "id_source", "value", "flag")


def q_half_open_scan(spark, sf):
    """15 s buckets in [start 00:00, end + 1 day 00:00)."""
    # a day holds whole buckets, so readings of other days are in none of them
    return half_open(_resampled(spark, sf, QUARTER_MIN_MS, RANGE_START, RANGE_END), RANGE_START, RANGE_END)


def q_tag_projection(spark, sf):
    """Catalog casts of raw texts to FLOAT / DOUBLE / INTEGER; unparsable text becomes NULL."""
    return _conformed(spark, sf, PROJECTION_TAGS).drop("ds_date")


def q_bool_normalise(spark, sf):
    """Raw flag texts next to their boolean reading ('yes', ' true' and NULL read as NULL)."""
    raw = tb.raw_readings(spark, sf)
    return project_source(raw, [_tag("flag_txt", "flag", "BOOLEAN")], id_col="id_source",
                          keep=["source", "seq", "flag_txt"]).drop("id_source")


def q_epoch_convert(spark, sf):
    """Raw time text ('<ms>.0') -> epoch ms -> zone-less timestamp."""
    from keelson.functions.conform import epoch_ms, ms_to_timestamp
    raw = tb.raw_readings(spark, sf)
    ms = epoch_ms("ds_timestamp")
    return raw.select("source", "seq", F.col("ds_timestamp").alias("raw_time"), ms.alias("id_source"),
                      ms_to_timestamp(ms).alias("event_time"))


def _hourly_frames(spark, sf) -> list[DataFrame]:
    """Per event type: first reading per hour, columns id_<type>, <type>_value, <type>_flag."""
    conf = _conformed(spark, sf).drop("ds_date")
    frames = []
    for et in EVENT_TYPES:
        one = conf.where(F.col("source") == et).select(
            F.col("id_source").alias(f"id_{et}"), "seq",
            F.col("value").alias(f"{et}_value"), F.col("flag").alias(f"{et}_flag"))
        frames.append(first_per_bucket(one, HOUR_MS, time_col=f"id_{et}", tiebreak=["seq"], drop_tiebreak=True))
    return frames


def q_align_left_chain(spark, sf):
    """Hourly first readings of five sources, left-joined onto the base source (view)."""
    return align_left(_hourly_frames(spark, sf))


def q_align_first_inner(spark, sf):
    """Hourly first readings per (date, bucket), kept where all five sources have one."""
    conf = _conformed(spark, sf)
    frames = [
        conf.where(F.col("source") == et).select(
            F.col("id_source").alias("id"), "ds_date", "seq",
            F.col("value").alias(f"{et}_value"), F.col("flag").alias(f"{et}_flag"))
        for et in EVENT_TYPES
    ]
    return align_first_inner(frames, HOUR_MS, time_col="id", tiebreak=["seq"])


# Aliases of the hourly aligned frame used by the derived-column queries.
LOAD_INPUTS = {"ge1_power": "view_value", "ge2_power": "click_value", "ge3_power": "error_value",
               "ge4_power": "purchase_value"}
SUM_INPUTS = {
    "ge1_fg_flow": "view_value", "ge2_fg_flow": "click_value", "ge3_fg_flow": "error_value",
    "ge4_fg_flow": "purchase_value", "me1_fo_flow": "view_value", "me2_fo_flow": "click_value",
    "me1_fg_flow": "error_value", "me2_fg_flow": "purchase_value", "auxb_fo_lsmgo_flow": "click_value",
    "auxb_fo_vlsfo_flow": "error_value",
}
SUM_OUTPUTS = ("ge_fg_flow", "me_fo_flow", "me_fg_flow", "auxb_fo_flow")
FUEL_INPUTS = {"me_fo_flow": "view_value", "ge_fo_flow": "click_value", "auxb_fo_flow": "error_value",
               "me_fg_flow": "purchase_value", "ge_fg_flow": "view_value"}


def _renamed_hourly(spark, sf, mapping: dict[str, str]) -> DataFrame:
    aligned = align_left(_hourly_frames(spark, sf))
    return aligned.select("ds_timestamp", *[F.col(src).alias(dst) for dst, src in mapping.items()])


def q_derive_load(spark, sf):
    """H2508 generator load percentages in FLOAT arithmetic from the aligned frame."""
    loads = ("ge1_load", "ge2_load", "ge3_load", "ge4_load")
    df = add_derived(_renamed_hourly(spark, sf, LOAD_INPUTS), "H2508", only=loads)
    return df.select("ds_timestamp", *loads)


def q_derive_sums(spark, sf):
    """H2508 fuel / gas flow sums (NULL when a term is missing) from the aligned frame."""
    df = add_derived(_renamed_hourly(spark, sf, SUM_INPUTS), "H2508", only=SUM_OUTPUTS)
    return df.select("ds_timestamp", *SUM_OUTPUTS)


# Flags of hull H2508 that reach the rules as 0 / 1 numbers.
FLAG_INPUTS = {
    "me1_fg_use": "view_flag", "me2_fg_use": "click_flag", "me1_fo_vlsfo_use": "error_flag",
    "me2_fo_vlsfo_use": "purchase_flag", "me1_fo_lsmgo_use": "signup_flag", "me2_fo_lsmgo_use": "view_flag",
    "ge1_fg_use": "click_flag", "ge2_fg_use": "error_flag", "ge3_fg_use": "purchase_flag", "ge4_fg_use": "signup_flag",
}


def q_derive_flags(spark, sf):
    """H2508 on/off flags re-cast from numbers to BOOLEAN."""
    numbers = _renamed_hourly(spark, sf, FLAG_INPUTS)
    numbers = numbers.withColumns({name: F.col(name).cast("int") for name in FLAG_INPUTS})
    return add_derived(numbers, "H2508", only=tuple(FLAG_INPUTS))


def q_true_wind(spark, sf):
    """True wind speed and angle of every reading (DOUBLE maths, FLOAT results)."""
    conf = _conformed(spark, sf, PROJECTION_TAGS)
    v_x, v_y = true_wind_vector("value", "angle", "sog")
    return conf.select("source", "seq", true_wind_speed_raw(v_x, v_y).cast("float").alias("true_wind_speed"),
                       true_wind_angle_raw(v_x, v_y).cast("float").alias("true_wind_angle"))


def q_beaufort(spark, sf):
    """Beaufort class of every reading's true wind speed (NULL speed -> NULL class)."""
    conf = _conformed(spark, sf, PROJECTION_TAGS)
    speed = true_wind_speed_raw(*true_wind_vector("value", "angle", "sog"))
    return conf.select("source", "seq", speed.cast("float").alias("true_wind_speed"),
                       beaufort(speed).alias("beaufort_number"))


def q_beaufort_capped(spark, sf):
    """The older nine-class scale: classes 0-8 by the first nine bounds, everything else (NULL too) 9."""
    conf = _conformed(spark, sf, PROJECTION_TAGS)
    speed = true_wind_speed_raw(*true_wind_vector("value", "angle", "sog"))
    return conf.select("source", "seq", beaufort(speed, cap=9, null_guard=False).alias("beaufort_number"))


def q_fuel_totals(spark, sf):
    """Fuel totals widened to DOUBLE and narrowed to FLOAT; NULL when a term is NULL."""
    from keelson.functions.wind import fuel_total
    df = _renamed_hourly(spark, sf, FUEL_INPUTS)
    return df.select("ds_timestamp", fuel_total("me_fo_flow", "ge_fo_flow", "auxb_fo_flow").alias("foc"),
                     fuel_total("me_fg_flow", "ge_fg_flow").alias("fgc"))


def _raw(spark, sf, start=None, end=None, derive=True, keys=()) -> DataFrame:
    return build_raw(tb.source_reader(spark, sf), tb.TESTBED_TAGS, start, end, "15 seconds",
                     keys=keys, tiebreak=["seq"], derive=derive)


def q_schema_enforce(spark, sf):
    """The aligned raw frame cast to the catalog's schema, before derived columns."""
    return _raw(spark, sf, derive=False)


def q_schema_contract(spark, sf):
    """Per declared raw-table column: declared type, the frame's type and how many rows hold a value.

    The frame breaks the contract in two places: one column is missing, one has another type.
    """
    from keelson.operators.contract import schema_report
    broken = _raw(spark, sf).drop("cargo_load").withColumn("me1_fo_flow", F.col("me1_fo_flow").cast("double"))
    return schema_report(broken, wide_schema(tb.TESTBED_TAGS))


def q_unloaded_readings(spark, sf):
    """Per source: all readings and those without a readable time, counted before any resample."""
    return unloaded_readings(tb.unclocked_reader(spark, sf), tb.TESTBED_TAGS)


def q_pipeline_raw(spark, sf):
    """End to end: the hull's raw wide frame over all readings (15 s buckets, derived columns)."""
    return _raw(spark, sf)


def q_pipeline_raw_fleet(spark, sf):
    """All hulls of the fleet in one job: buckets and joins are per (hnum, ds_timestamp)."""
    return _raw(spark, sf, keys=["hnum"])


def q_pipeline_calc_fleet(spark, sf):
    """End to end for every hull of the fleet: the calc frame keyed by (hnum, ds_timestamp)."""
    return calc(_raw(spark, sf, keys=["hnum"]), keys=["hnum"])


def q_fleet_unlike_raw(spark, sf):
    """Three hulls with unlike tag lists, sources and rules in one job: the fleet's raw wide frame."""
    from keelson.plans.fleet import fleet_raw
    return fleet_raw(tb.unlike_reader(spark, sf), tb.unlike_catalog(spark), tiebreak=["seq"])


def q_stored_fleet(spark, sf):
    """The calc table of the same fleet as stored after two overlapping loads."""
    import uuid
    from keelson.plans.fleet import load_fleet
    from keelson.plans.jobs import PARTITION_COL
    from keelson.session import checkpoint_dir
    base = f"{checkpoint_dir(spark)}/keelson-stored-fleet-{uuid.uuid4().hex}"
    for window in ({"end": TARGET_END}, {"start": SOURCE_START}):
        load_fleet(spark, tb.unlike_reader(spark, sf), tb.unlike_catalog(spark), f"{base}/raw", f"{base}/calc",
                   tiebreak=["seq"], **window)
    return spark.read.parquet(f"{base}/calc").drop(PARTITION_COL)


def q_minute_view_1h(spark, sf):
    """The aligned view over the testbed catalog, one-hour buckets (1 minute leaves no bucket shared by all sources)."""
    from keelson.plans.view import minute_view
    return minute_view(tb.source_reader(spark, sf), tb.TESTBED_TAGS, "1 hour", tiebreak=["seq"])


def q_minute_view_sql(spark, sf):
    """The generated view text over two sources that share minutes; raw columns pass unchanged."""
    from keelson.plans.view import view_sql
    tags = [t for t in tb.TESTBED_TAGS if t.table_name in ("ev_ias_view_pivot", "ev_vdr_click_pivot")]
    read = tb.source_reader(spark, sf)
    for table in {t.table_name for t in tags}:
        read(table).createOrReplaceTempView(table)
    return spark.sql(view_sql(tags, "1 minute", tiebreak=["seq"]))


def q_calc_table(spark, sf):
    """Calc rows of a ten-day window of the raw frame."""
    return calc(_raw(spark, sf, CALC_START, CALC_END), CALC_START, CALC_END)


def q_pipeline_calc(spark, sf):
    """End to end: the calc frame over all readings."""
    return calc(_raw(spark, sf))


def revise(df: DataFrame) -> DataFrame:
    """The re-loaded source of the upsert queries: wind speed lost (NULL), ME1 flow corrected by +1."""
    return df.withColumns({
        "vdr_relative_wind_speed": F.lit(None).cast("float"),
        "me1_fo_flow": F.col("me1_fo_flow") + F.lit(1.0).cast("float"),
    })


def _upsert_pair(spark, sf):
    target = _raw(spark, sf, None, TARGET_END)
    source = revise(_raw(spark, sf, SOURCE_START, None))
    return target, source


def q_upsert_raw(spark, sf):
    """MERGE of a re-loaded, revised second half-month into the first load of the raw frame."""
    target, source = _upsert_pair(spark, sf)
    return merge_frames(target, source, ["ds_timestamp"])


def q_upsert_idempotent(spark, sf):
    """The same MERGE applied twice: equals applying it once."""
    target, source = _upsert_pair(spark, sf)
    return merge_frames(merge_frames(target, source, ["ds_timestamp"]), source, ["ds_timestamp"])


def q_upsert_calc(spark, sf):
    """MERGE of the calc rows of two overlapping windows, the second from revised readings."""
    target, source = _upsert_pair(spark, sf)
    return merge_frames(calc(target), calc(source), ["ds_timestamp"])


def _stored(spark, sf):
    """Load up to day 20, then from day 15 on with revised readings, through run_hull into fresh folders."""
    import uuid
    from keelson.plans.jobs import run_hull
    from keelson.session import checkpoint_dir
    base = f"{checkpoint_dir(spark)}/keelson-stored-{uuid.uuid4().hex}"
    for read, start, end in ((tb.source_reader(spark, sf), None, TARGET_END), (tb.revised_reader(spark, sf), SOURCE_START, None)):
        run_hull(spark, read, tb.TESTBED_TAGS, start, end, f"{base}/raw", f"{base}/calc", tiebreak=["seq"])
    return f"{base}/raw", f"{base}/calc"


def q_stored_raw(spark, sf):
    """The raw table as stored after two overlapping loads (staged upsert, month partitions swapped in)."""
    from keelson.plans.jobs import PARTITION_COL
    raw_path, _ = _stored(spark, sf)
    return spark.read.parquet(raw_path).drop(PARTITION_COL)


def q_stored_calc(spark, sf):
    """The calc table as stored after two overlapping loads."""
    from keelson.plans.jobs import PARTITION_COL
    _, calc_path = _stored(spark, sf)
    return spark.read.parquet(calc_path).drop(PARTITION_COL)


def q_stored_evolved(spark, sf):
    """A stored table through three loads: without the flag, then days of even number with it (the column is added),
    then every fourth day sent again by an old catalog that lacks it. The flags stay, the values are the newer ones."""
    import uuid
    from pyspark.sql.types import IntegerType, StructField, StructType
    from keelson.session import checkpoint_dir
    from keelson.sources.storage import read_stored
    path = f"{checkpoint_dir(spark)}/keelson-stored-evolved-{uuid.uuid4().hex}"
    day = F.dayofmonth("ds_timestamp")
    first = _resampled(spark, sf, HOUR_MS).where("ds_timestamp is not null").withColumn("ds_day", day)
    keys, by_day = ["source", "ds_timestamp"], {"path": path, "partition_cols": ["ds_day"]}
    upsert_table(spark, first.drop("flag"), keys, **by_day)
    upsert_table(spark, first.where(day % 2 == 0), keys, evolve=True, **by_day)
    again = first.where(day % 4 == 0).withColumn("value", (F.col("value") + F.lit(1.0).cast("float")).cast("float"))
    upsert_table(spark, again.drop("flag"), keys, **by_day)
    return read_stored(spark, path, StructType([StructField("ds_day", IntegerType())]))


def q_stored_appended(spark, sf):
    """A stored table through three loads: up to the 10th of each month, the rest (appended where no stored row lies
    within the load's range of a month), then the 8th to the 12th with newer values (their months are rewritten)."""
    import uuid
    from pyspark.sql.types import IntegerType, StructField, StructType
    from keelson.session import checkpoint_dir
    from keelson.sources.storage import read_stored
    path = f"{checkpoint_dir(spark)}/keelson-stored-appended-{uuid.uuid4().hex}"
    day = F.dayofmonth("ds_timestamp")
    every = _resampled(spark, sf, HOUR_MS).where("ds_timestamp is not null").withColumn("ds_month", F.month("ds_timestamp"))
    newer = every.withColumn("value", (F.col("value") + F.lit(1.0).cast("float")).cast("float"))
    for rows in (every.where(day <= 10), every.where(day > 10), newer.where(day.between(8, 12))):
        upsert_table(spark, rows, ["source", "ds_timestamp"], path=path, partition_cols=["ds_month"])
    return read_stored(spark, path, StructType([StructField("ds_month", IntegerType())]))


def q_catalog_absent_keys(spark, sf):
    """Stored catalog rows of the hulls with new files whose key the new files no longer have."""
    return absent_keys(tb.customer_catalog(spark, sf), tb.incoming_catalog(spark, sf))


def q_catalog_sync(spark, sf):
    """The fleet catalog after delete-absent + upsert of the new files (other hulls untouched)."""
    return sync_catalog(tb.customer_catalog(spark, sf), tb.incoming_catalog(spark, sf))


def q_stored_catalog(spark, sf):
    """The catalog folder after a first load and a sync with the new files: ids kept, new keys numbered on."""
    import uuid
    from pyspark.sql.types import StringType, StructField, StructType
    from keelson.operators.catalog_sync import sync_catalog_path
    from keelson.session import checkpoint_dir
    from keelson.sources.storage import read_stored
    path = f"{checkpoint_dir(spark)}/keelson-stored-catalog-{uuid.uuid4().hex}"
    sync_catalog_path(spark, tb.customer_catalog(spark, sf).drop("id"), path)
    sync_catalog_path(spark, tb.incoming_catalog(spark, sf), path)
    return read_stored(spark, path, StructType([StructField("hnum", StringType())]))


def q_single_value_check(spark, sf):
    """Per database: how many hulls it holds, and the hull when there is exactly one.

    Every sixth hull has a database of its own; half of the rows write the hull in lower case.
    """
    cat = tb.customer_catalog(spark, sf)
    number = F.substring("hnum", 2, 4).cast("int")
    cat = cat.withColumn("db_name", F.when(number % 6 == 0, F.concat(F.lit("solo_"), F.col("hnum"))).otherwise(F.col("db_name")))
    cat = cat.withColumn("hnum", F.when(F.col("id") % 2 == 0, F.concat(F.lit(" "), F.lower("hnum"))).otherwise(F.col("hnum")))
    return single_value(cat, ["db_name"], "hnum", normalise=True)


def q_hull_database_check(spark, sf):
    """Per hull: how many databases its sources are in, and the database when there is exactly one.

    Every seventh tag of every fourth hull was entered under another database.
    """
    cat = tb.customer_catalog(spark, sf)
    number = F.substring("hnum", 2, 4).cast("int")
    strayed = (number % 4 == 0) & (F.col("id") % 7 == 0)
    cat = cat.withColumn("db_name", F.when(strayed, F.lit("elsewhere")).otherwise(F.col("db_name")))
    return single_value(cat, ["hnum"], "db_name")


def q_source_priority(spark, sf):
    """Distinct source tables per hull with their priority (cams > ias > ams > vdr, then name)."""
    return source_priority(tb.customer_catalog(spark, sf))


def q_type_whitelist(spark, sf):
    """Catalog rows whose data type the pipeline does not accept."""
    return type_violations(tb.customer_catalog(spark, sf))


# Fleet hulls that stand for hulls with derived columns.
RULED_HULLS = {"H0000": "H2508", "H0001": "H2521"}


def q_wide_schema(spark, sf):
    """Per hull, the raw table's column list: time, catalog + derived columns by name, lineage ids."""
    cat = tb.customer_catalog(spark, sf)
    hull = F.col("hnum")
    for fleet, ruled in RULED_HULLS.items():
        hull = F.when(F.col("hnum") == fleet, F.lit(ruled)).otherwise(hull)
    return wide_schema_frame(cat.withColumn("hnum", hull))


def q_tag_catalog(spark, sf):
    """The fleet catalog written as CSV files and read back through the catalog reader."""
    from keelson.sources.tagcatalog import read_catalog
    return read_catalog(spark, tb.write_catalog_csv(spark, sf))


_LAYOUT_SCHEMA = "cola double, colb double"


def q_schema_evolution_by_name(spark, sf):
    """Two physical layouts read by column name against (cola, colb, colc): colc is NULL where a file lacks it."""
    from pyspark.sql.types import StructType
    from keelson.sources.scans import read_by_name
    schema = StructType.fromDDL(_LAYOUT_SCHEMA + ", colc double")
    return read_by_name(spark, [tb.write_layouts(spark, sf)], schema)


def q_read_by_position(spark, sf):
    """The same folders read by position against (cola, colb): dt=2 files shift by one column."""
    from pyspark.sql.types import StructType
    from keelson.sources.scans import read_by_position
    base = tb.write_layouts(spark, sf)
    return read_by_position(spark, [f"{base}/dt=1", f"{base}/dt=2"], StructType.fromDDL(_LAYOUT_SCHEMA), base_path=base)


def q_table_by_position(spark, sf):
    """The same folders as partitions of an external table, added with their layouts; a column is added to the table,
    which is then read by position: (cola, colb, colc) are a file's first, second and third column."""
    import uuid
    from pyspark.sql.types import StructType
    from keelson.plans import tables
    from keelson.sources.scans import read_table_by_position
    base, name = tb.write_layouts(spark, sf), f"by_position_{uuid.uuid4().hex}"
    two = StructType.fromDDL(_LAYOUT_SCHEMA)
    tables.create_external_table(spark, "default", name, two, base)
    try:
        tables.add_partitions(spark, f"default.{name}", [({"dt": 1}, f"{base}/dt=1")], two)
        shifted = StructType.fromDDL("colc double, " + _LAYOUT_SCHEMA)
        tables.add_partitions(spark, f"default.{name}", [({"dt": 2}, f"{base}/dt=2")], shifted)
        tables.add_columns(spark, f"default.{name}", StructType.fromDDL("colc double"))
        return read_table_by_position(spark, f"default.{name}")
    finally:  # an external table: its files stay
        spark.sql(f"DROP TABLE default.{name}")


QUERIES: dict[str, QueryFn] = {
    "resample_first_15s": q_resample_first_15s,
    "resample_first_1h": q_resample_first_1h,
    "first_in_minute": q_first_in_minute,
    "range_scan": q_range_scan,
    "half_open_scan": q_half_open_scan,
    "tag_projection": q_tag_projection,
    "bool_normalise": q_bool_normalise,
    "epoch_convert": q_epoch_convert,
    "align_left_chain": q_align_left_chain,
    "align_first_inner": q_align_first_inner,
    "schema_enforce": q_schema_enforce,
    "schema_contract": q_schema_contract,
    "derive_load": q_derive_load,
    "derive_sums": q_derive_sums,
    "derive_flags": q_derive_flags,
    "unloaded_readings": q_unloaded_readings,
    "true_wind": q_true_wind,
    "beaufort": q_beaufort,
    "beaufort_capped": q_beaufort_capped,
    "fuel_totals": q_fuel_totals,
    "calc_table": q_calc_table,
    "upsert_raw": q_upsert_raw,
    "upsert_calc": q_upsert_calc,
    "upsert_idempotent": q_upsert_idempotent,
    "stored_raw": q_stored_raw,
    "stored_calc": q_stored_calc,
    "catalog_absent_keys": q_catalog_absent_keys,
    "catalog_sync": q_catalog_sync,
    "stored_catalog": q_stored_catalog,
    "stored_evolved": q_stored_evolved,
    "stored_appended": q_stored_appended,
    "single_value_check": q_single_value_check,
    "hull_database_check": q_hull_database_check,
    "source_priority": q_source_priority,
    "type_whitelist": q_type_whitelist,
    "wide_schema": q_wide_schema,
    "pipeline_raw": q_pipeline_raw,
    "pipeline_calc": q_pipeline_calc,
    "minute_view_1h": q_minute_view_1h,
    "minute_view_sql": q_minute_view_sql,
    "tag_catalog": q_tag_catalog,
    "schema_evolution_by_name": q_schema_evolution_by_name,
    "read_by_position": q_read_by_position,
    "table_by_position": q_table_by_position,
    "pipeline_raw_fleet": q_pipeline_raw_fleet,
    "pipeline_calc_fleet": q_pipeline_calc_fleet,
    "fleet_unlike_raw": q_fleet_unlike_raw,
    "stored_fleet": q_stored_fleet,
}


# ----------------------------------------------------------------------------------------------
# DuckDB oracle: nothing below uses a constant or a function of the library; expected values are literals
# ----------------------------------------------------------------------------------------------

# The testbed's sources in priority order, each with (column, raw text, type).
_SOURCES = [
    ("view", "ev_ias_view_pivot", [
        ("vdr_relative_wind_speed", "value_txt", "FLOAT"), ("vdr_relative_wind_angle", "angle_txt", "FLOAT"),
        ("vdr_aivdo_sog", "sog_txt", "FLOAT"), ("me1_fg_use", "flag_txt", "BOOLEAN"), ("ge2_1_power", "user_txt", "FLOAT")]),
    ("click", "ev_vdr_click_pivot", [
        ("me1_fo_flow", "value_txt", "FLOAT"), ("me2_fo_flow", "sog_txt", "FLOAT"), ("ge2_2_power", "user_txt", "FLOAT"),
        ("me2_fg_use", "flag_txt", "BOOLEAN")]),
    ("error", "ev_vdr_error_pivot", [
        ("me1_fg_flow", "value_txt", "FLOAT"), ("ge_fo_flow", "angle_txt", "FLOAT"), ("ge_running_hours", "user_txt", "INTEGER")]),
    ("purchase", "ev_vdr_purchase_pivot", [
        ("me2_fg_flow", "value_txt", "FLOAT"), ("auxb_fo_flow", "sog_txt", "FLOAT"), ("ge_fg_flow", "angle_txt", "FLOAT"),
        ("cargo_load", "user_txt", "DOUBLE")]),
    ("signup", "ev_vdr_signup_pivot", [
        ("shaft_power", "value_txt", "DOUBLE"), ("shaft_speed", "sog_txt", "FLOAT"), ("gcu_use", "flag_txt", "BOOLEAN")]),
]
_EVENTS = ["view", "click", "error", "purchase", "signup"]

# The raw table's columns in order (d: derived), with Spark's type names.
_RAW_COLUMNS = [
    ("ds_timestamp", "timestamp_ntz"), ("auxb_fo_flow", "float"), ("cargo_load", "double"), ("gcu_use", "boolean"),
    ("ge2_1_power", "float"), ("ge2_2_power", "float"), ("ge2_power", "float"), ("ge_fg_flow", "float"),
    ("ge_fo_flow", "float"), ("ge_running_hours", "int"), ("me1_fg_flow", "float"), ("me1_fg_use", "boolean"),
    ("me1_fo_flow", "float"), ("me2_fg_flow", "float"), ("me2_fg_use", "boolean"), ("me2_fo_flow", "float"),
    ("me_fg_flow", "float"), ("me_fo_flow", "float"), ("shaft_power", "double"), ("shaft_speed", "float"),
    ("vdr_aivdo_sog", "float"), ("vdr_relative_wind_angle", "float"), ("vdr_relative_wind_speed", "float"),
    ("id_ev_ias_view_pivot", "bigint"), ("id_ev_vdr_click_pivot", "bigint"), ("id_ev_vdr_error_pivot", "bigint"),
    ("id_ev_vdr_purchase_pivot", "bigint"), ("id_ev_vdr_signup_pivot", "bigint"),
]
_DERIVED = {
    "ge2_power": "ge2_1_power + ge2_2_power",
    "me_fo_flow": "me1_fo_flow + me2_fo_flow",
    "me_fg_flow": "me1_fg_flow + me2_fg_flow",
}

_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
_FLAG_CASE = "WHEN 0 THEN 'TRUE' WHEN 1 THEN '1' WHEN 2 THEN 'false' WHEN 3 THEN '0' WHEN 4 THEN 'yes' WHEN 6 THEN ' true'"

RAW_SQL = f"""raw AS (
  SELECT event_type AS source, event_id AS seq,
         CAST(epoch_us(ts) // 1000 AS VARCHAR) || '.0' AS ds_timestamp,
         strftime(ts, '%Y%m%d') AS ds_date,
         CASE WHEN event_id % 97 = 0 THEN 'abc' ELSE CAST(value AS VARCHAR) END AS value_txt,
         CASE {_K} % 7 {_FLAG_CASE} END AS flag_txt,
         CAST({_K} * 3.6 AS VARCHAR) AS angle_txt,
         CAST(user_id % 25 AS VARCHAR) AS sog_txt,
         CAST(user_id AS VARCHAR) AS user_txt,
         'H' || lpad(CAST(user_id % 5 AS VARCHAR), 4, '0') AS hnum
  FROM events)"""

_ID = "CAST(trunc(TRY_CAST(ds_timestamp AS DOUBLE)) AS BIGINT)"


def _typed(tag: str, dtype: str) -> str:
    if dtype == "BOOLEAN":
        return (f"CASE WHEN lower({tag}) IN ('true', '1') THEN TRUE "
                f"WHEN lower({tag}) IN ('false', '0') THEN FALSE END")
    return f"TRY_CAST({tag} AS {dtype})"


def _floor(col: str, every_ms: int) -> str:
    return f"({col} - (({col} % {every_ms}) + {every_ms}) % {every_ms})"


def _conf_sql(tags=GENERIC_TAGS) -> str:
    cols = ", ".join(f"{_typed(t.tag, t.data_type)} AS {t.col_name}" for t in tags)
    return f"conf AS (SELECT source, seq, ds_date, {_ID} AS id_source, {cols} FROM raw)"


def _resampled_sql(every_ms: int) -> str:
    return f"""SELECT source, ds_timestamp, id_source, value, flag FROM (
  SELECT *, epoch_ms({_floor('id_source', every_ms)}) AS ds_timestamp FROM conf)
QUALIFY row_number() OVER (PARTITION BY source, ds_timestamp ORDER BY id_source, seq) = 1"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_MINUTE_FMT = "'%Y-%m-%d %H:%M'"


def _text_ms(bucket_col: str) -> str:
    return f"epoch_ms(strptime(strftime(epoch_ms({bucket_col}), {_MINUTE_FMT}), {_MINUTE_FMT}))"


def _hourly_cte(et: str) -> str:
    return f"""h_{et} AS (
  SELECT ds_timestamp, id_source AS id_{et}, value AS {et}_value, flag AS {et}_flag FROM (
    SELECT *, epoch_ms({_floor('id_source', HOUR_MS)}) AS ds_timestamp FROM conf WHERE source = '{et}')
  QUALIFY row_number() OVER (PARTITION BY ds_timestamp ORDER BY id_source, seq) = 1)"""


def _aligned_sql() -> str:
    ctes = [RAW_SQL, _conf_sql(), *[_hourly_cte(et) for et in _EVENTS]]
    cols = ["h_view.ds_timestamp"] + [f"{c}" for et in _EVENTS for c in (f"id_{et}", f"{et}_value", f"{et}_flag")]
    joins = " ".join(f"LEFT JOIN h_{et} ON h_{et}.ds_timestamp = h_view.ds_timestamp" for et in _EVENTS[1:])
    return ",\n".join(ctes) + f",\naligned AS (SELECT {', '.join(cols)} FROM h_view {joins})"


def _inner_sql() -> str:
    ctes = [RAW_SQL, _conf_sql()]
    for et in _EVENTS:
        ctes.append(f"""m_{et} AS (
  SELECT ds_date, b, value AS {et}_value, flag AS {et}_flag FROM (
    SELECT *, {_floor('id_source', HOUR_MS)} AS b FROM conf WHERE source = '{et}')
  QUALIFY row_number() OVER (PARTITION BY ds_date, b ORDER BY id_source, seq) = 1)""")
    vals = ", ".join(f"{et}_value, {et}_flag" for et in _EVENTS)
    joins = " ".join(f"JOIN m_{et} ON m_{et}.ds_date = m_view.ds_date AND m_{et}.b = m_view.b" for et in _EVENTS[1:])
    return _with(*ctes) + f"SELECT {_text_ms('m_view.b')} AS ds_timestamp, {vals}, m_view.ds_date FROM m_view {joins}"


def _days(start: str | None, end: str | None) -> str:
    bounds = ([f"ds_date >= '{start}'"] if start else []) + ([f"ds_date <= '{end}'"] if end else [])
    return " AND ".join(bounds) or "TRUE"


def _raw_table_ctes(
    name: str, start: str | None = None, end: str | None = None, derive: bool = True, keys: tuple[str, ...] = (),
    readings: str = "raw",
) -> list[str]:
    """CTEs ending in ``name``: the testbed hull's raw wide frame for days [start, end] (per ``keys``)."""
    ctes = []
    kc = "".join(f"{k}, " for k in keys)
    for i, (event, table, columns) in enumerate(_SOURCES):
        cols = ", ".join(f"{_typed(text, kind)} AS {column}" for column, text, kind in columns)
        names = ", ".join(column for column, _, _ in columns)
        ctes.append(f"""{name}_s{i} AS (
  SELECT {kc}ds_timestamp, id_{table}, {names} FROM (
    SELECT {kc}epoch_ms({_floor('id', QUARTER_MIN_MS)}) AS ds_timestamp, id AS id_{table}, seq, {names} FROM (
      SELECT {kc}{_ID} AS id, seq, {cols} FROM {readings} WHERE source = '{event}' AND {_days(start, end)}))
  QUALIFY row_number() OVER (PARTITION BY {kc}ds_timestamp ORDER BY id_{table}, seq) = 1)""")
    select = [f"{name}_s0.{k}" for k in keys]
    for column, _ in _RAW_COLUMNS:
        if column == "ds_timestamp":
            select.append(f"{name}_s0.ds_timestamp")
        elif column not in _DERIVED:
            select.append(column)
        elif derive:
            select.append(f"CAST({_DERIVED[column]} AS FLOAT) AS {column}")
    on = lambda i: " AND ".join(f"{name}_s{i}.{c} = {name}_s0.{c}" for c in (*keys, "ds_timestamp"))
    joins = " ".join(f"LEFT JOIN {name}_s{i} ON {on(i)}" for i in range(1, len(_SOURCES)))
    ctes.append(f"{name} AS (SELECT {', '.join(select)} FROM {name}_s0 {joins})")
    return ctes


# Sources of the fleet's two other hulls by priority, as (event, [(raw text, type, columns)]), and their sums.
_SHIP_A = [
    ("view", [("value_txt", "FLOAT", "ge1_power ge1_fg_flow vdr_relative_wind_speed"),
              ("angle_txt", "FLOAT", "ge2_power vdr_relative_wind_angle"), ("sog_txt", "FLOAT", "vdr_aivdo_sog ge2_fg_flow"),
              ("flag_txt", "BOOLEAN", "me1_fg_use me2_fg_use me1_fo_vlsfo_use me2_fo_vlsfo_use me1_fo_lsmgo_use")]),
    ("error", [("value_txt", "FLOAT", "ge3_power me1_fo_flow ge3_fg_flow"),
               ("user_txt", "FLOAT", "ge4_power me2_fo_flow auxb_fo_lsmgo_flow"),
               ("flag_txt", "BOOLEAN", "me2_fo_lsmgo_use ge1_fg_use ge2_fg_use ge3_fg_use ge4_fg_use")]),
    ("signup", [("value_txt", "FLOAT", "me1_fg_flow ge4_fg_flow ge_fo_flow"),
                ("user_txt", "FLOAT", "me2_fg_flow auxb_fo_vlsfo_flow")]),
]
_SHIP_C = [
    ("click", [("value_txt", "FLOAT", "me1_fo_flow ge_fo_flow"), ("user_txt", "FLOAT", "me2_fo_flow"),
               ("sog_txt", "FLOAT", "ge2_1_power"), ("angle_txt", "FLOAT", "vdr_relative_wind_speed")]),
    ("purchase", [("value_txt", "FLOAT", "vdr_relative_wind_angle ge2_2_power"), ("sog_txt", "FLOAT", "vdr_aivdo_sog"),
                  ("user_txt", "FLOAT", "me1_fg_flow"), ("user_txt", "INTEGER", "ge_running_hours"),
                  ("angle_txt", "FLOAT", "me2_fg_flow"), ("flag_txt", "BOOLEAN", "hatch_open")]),
]
_SUMS_A = {
    "ge_fg_flow": "ge1_fg_flow + ge2_fg_flow + ge3_fg_flow + ge4_fg_flow", "auxb_fo_flow": "auxb_fo_lsmgo_flow + auxb_fo_vlsfo_flow",
    "me_fo_flow": "me1_fo_flow + me2_fo_flow", "me_fg_flow": "me1_fg_flow + me2_fg_flow",
    **{f"ge{i}_load": f"CAST(100.0 AS FLOAT) * ge{i}_power / CAST({kw} AS FLOAT)" for i, kw in enumerate((2750, 3670, 3670, 2750), 1)},
}


def _fleet_ctes() -> list[str]:
    """CTEs ending in ``fleet``: each hull's own chain of left joins, their rows united by column name."""
    ship_b = [(event, [(text, kind, column) for column, text, kind in columns]) for event, _, columns in _SOURCES]
    ctes, parts = [RAW_SQL], []
    for rest, hull, sources, sums in ((0, "H2508", _SHIP_A, _SUMS_A), (1, "H2521", ship_b, _DERIVED), (2, "H2532", _SHIP_C, _DERIVED)):
        names = []
        for i, (event, tags) in enumerate(sources):
            typed = [(f"{_typed(text, kind)} AS {c}", c) for text, kind, columns in tags for c in columns.split()]
            own = ", ".join(c for _, c in typed)
            names.append(own)
            ctes.append(f"""{hull}_{i} AS (
  SELECT ds_timestamp, id AS id_source_{i + 1}, {own} FROM (
    SELECT epoch_ms({_floor('id', QUARTER_MIN_MS)}) AS ds_timestamp, id, seq, {own} FROM (
      SELECT {_ID} AS id, seq, {', '.join(t for t, _ in typed)} FROM raw
      WHERE source = '{event}' AND CAST(user_txt AS BIGINT) % 4 = {rest}))
  QUALIFY row_number() OVER (PARTITION BY ds_timestamp ORDER BY id, seq) = 1)""")
        joins = " ".join(f"LEFT JOIN {hull}_{i} ON {hull}_{i}.ds_timestamp = {hull}_0.ds_timestamp" for i in range(1, len(sources)))
        ids = ", ".join(f"id_source_{i + 1}" for i in range(len(sources)))
        made = ", ".join(f"CAST({e} AS FLOAT) AS {c}" for c, e in sums.items())
        parts.append(f"SELECT '{hull}' AS hnum, {hull}_0.ds_timestamp, {', '.join(names)}, {made}, {ids} FROM {hull}_0 {joins}")
    return [*ctes, "fleet AS (" + "\nUNION ALL BY NAME\n".join(parts) + ")"]


def _view_sql(every_ms: int) -> str:
    ctes = [RAW_SQL]
    names_all = []
    for i, (event, _, columns) in enumerate(_SOURCES):
        cols = ", ".join(f"{_typed(text, kind)} AS {column}" for column, text, kind in columns)
        names = ", ".join(column for column, _, _ in columns)
        names_all.append(names)
        ctes.append(f"""v{i} AS (
  SELECT ds_date, b, {names} FROM (
    SELECT ds_date, {_floor('id', every_ms)} AS b, id, seq, {names} FROM (
      SELECT {_ID} AS id, ds_date, seq, {cols} FROM raw WHERE source = '{event}'))
  QUALIFY row_number() OVER (PARTITION BY ds_date, b ORDER BY id, seq) = 1)""")
    joins = " ".join(f"JOIN v{i} ON v{i}.ds_date = v0.ds_date AND v{i}.b = v0.b" for i in range(1, len(_SOURCES)))
    return _with(*ctes) + f"SELECT {_text_ms('v0.b')} AS ds_timestamp, {', '.join(names_all)}, v0.ds_date FROM v0 {joins}"


# The lower ends, in knots, of Beaufort classes 1 to 12.
_SCALE = "(VALUES (1.0), (4.0), (7.0), (11.0), (17.0), (22.0), (28.0), (34.0), (41.0), (48.0), (56.0), (64.0)) AS scale(low)"


def _force(speed: str) -> str:
    """Beaufort class: how many of the scale's lower ends the speed has reached."""
    return f"CASE WHEN {speed} IS NOT NULL THEN (SELECT CAST(count(*) AS INTEGER) FROM {_SCALE} WHERE low <= {speed}) END"


def _wind(blow: str, off_bow: str, ship: str) -> tuple[str, str]:
    """(speed, direction) of the true wind: the third side of the triangle of apparent wind and ship's way, and
    the angle that side makes with the bow, from its tangent and its quadrant."""
    turn = f"({off_bow} * (pi() / 180))"
    speed = f"sqrt(abs({blow} * {blow} + {ship} * {ship} - 2 * {blow} * {ship} * cos({turn})))"
    side, ahead = f"(0 - {blow} * sin({turn}))", f"({ship} - {blow} * cos({turn}))"
    slope = f"(atan({side} / {ahead}) * (180 / pi()))"
    direction = (
        f"CASE WHEN {ahead} > 0 THEN {slope} + CASE WHEN {side} < 0 THEN 360 ELSE 0 END "
        f"WHEN {ahead} < 0 THEN {slope} + 180 WHEN {side} > 0 THEN 90 WHEN {side} < 0 THEN 270 WHEN {side} = 0 THEN 0 END"
    )
    return speed, f"(CASE WHEN {direction} >= 360 THEN 0 ELSE {direction} END)"


def _calc_select(src: str, start: str | None = None, end: str | None = None, keys: tuple[str, ...] = ()) -> str:
    speed, direction = _wind(*(f"CAST({c} AS DOUBLE)" for c in
                               ("vdr_relative_wind_speed", "vdr_relative_wind_angle", "vdr_aivdo_sog")))
    total = lambda *terms: "CAST(" + " + ".join(f"{t}::DOUBLE" for t in terms) + " AS FLOAT)"
    first = [f"ds_timestamp >= strptime('{start}', '%Y%m%d')"] if start else []
    last = [f"ds_timestamp < strptime('{end}', '%Y%m%d') + INTERVAL 1 DAY"] if end else []
    kc = "".join(f"{k}, " for k in keys)
    return f"""SELECT {kc}ds_timestamp, CAST(knots AS FLOAT) AS true_wind_speed, CAST(heading AS FLOAT) AS true_wind_angle,
  {_force('knots')} AS beaufort_number, foc, fgc
FROM (SELECT {kc}ds_timestamp, {speed} AS knots, {direction} AS heading,
        {total('me_fo_flow', 'ge_fo_flow', 'auxb_fo_flow')} AS foc, {total('me_fg_flow', 'ge_fg_flow')} AS fgc
      FROM {src} WHERE {' AND '.join([*first, *last, 'TRUE'])})"""


def _merge_sql(target: str, source: str) -> str:
    return (f"SELECT * FROM {target} t WHERE NOT EXISTS (SELECT 1 FROM {source} s WHERE s.ds_timestamp = t.ds_timestamp)\n"
            f"UNION ALL SELECT * FROM {source} WHERE ds_timestamp IS NOT NULL")


_REVISE = "SELECT * REPLACE (CAST(NULL AS FLOAT) AS vdr_relative_wind_speed, me1_fo_flow + CAST(1.0 AS FLOAT) AS me1_fo_flow)"


def _catalog_ctes() -> list[str]:
    key = "c_custkey"
    nk = "lpad(CAST(c_nationkey AS VARCHAR), 4, '0')"
    family = ("CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'cams' WHEN 'FURNITURE' THEN 'ams' WHEN 'HOUSEHOLD' THEN 'vdr' "
              "WHEN 'BUILDING' THEN 'ias' WHEN 'MACHINERY' THEN 'ias' ELSE 'vdr' END")
    dtype = (f"CASE WHEN {key} % 53 = 0 THEN 'VARCHAR' WHEN {key} % 10 < 6 THEN 'FLOAT' "
             f"WHEN {key} % 10 < 8 THEN 'BOOLEAN' WHEN {key} % 10 = 8 THEN 'DOUBLE' ELSE 'INTEGER' END")
    existing = f"""existing AS (
  SELECT {key} AS id, 'H' || {nk} AS hnum, lower(c_name) AS col_name,
         'fleet' || CAST(n_regionkey AS VARCHAR) AS db_name,
         'h' || {nk} || '_' || {family} || '_' || lower(c_mktsegment) || '_pivot' AS table_name,
         't' || CAST({key} AS VARCHAR) AS tag, c_mktsegment AS description,
         CASE WHEN c_acctbal < 0 THEN 'kn' ELSE 'kg/h' END AS unit, {dtype} AS data_type
  FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey)"""
    quiet = "'fleet4'"
    incoming = f"""incoming AS (
  SELECT hnum, col_name, db_name, table_name, tag,
         CASE WHEN description = 'HOUSEHOLD' THEN lower(description) ELSE description END AS description,
         unit, data_type
  FROM existing WHERE db_name <> {quiet} AND description <> 'AUTOMOBILE'
  UNION ALL
  SELECT hnum, col_name || '_b', db_name, table_name, tag, description, unit, data_type
  FROM existing WHERE db_name <> {quiet} AND description = 'MACHINERY')"""
    return [existing, incoming]


def _priority_sql(src: str = "existing") -> str:
    order = ", ".join(f"contains(table_name, '{k}') DESC" for k in ("cams", "ias", "ams", "vdr"))
    return (f"SELECT hnum, table_name, CAST(row_number() OVER (PARTITION BY hnum ORDER BY {order}, table_name) AS INTEGER)"
            f" AS priority FROM (SELECT DISTINCT hnum, table_name FROM {src})")


def oracle() -> dict[str, str]:
    conf = [RAW_SQL, _conf_sql()]
    resample_15 = _with(*conf) + _resampled_sql(QUARTER_MIN_MS)
    sql: dict[str, str] = {
        "resample_first_15s": resample_15,
        "resample_first_1h": _with(*conf) + _resampled_sql(HOUR_MS),
        "first_in_minute": _with(*conf) + f"""SELECT source, ds_date, strftime(epoch_ms(b), {_MINUTE_FMT}) AS minute,
  {_text_ms('b')} AS ds_timestamp, id_source, value, flag
FROM (SELECT *, {_floor('id_source', MINUTE_MS)} AS b FROM conf)
QUALIFY row_number() OVER (PARTITION BY source, ds_date, b ORDER BY id_source, seq) = 1""",
        "range_scan": _with(*conf) + f"SELECT source, ds_date, id_source, value, flag FROM conf "
                                      f"WHERE ds_date BETWEEN '{RANGE_START}' AND '{RANGE_END}'",
        "half_open_scan": _with(*conf, f"r AS ({_resampled_sql(QUARTER_MIN_MS)})")
        + "SELECT * FROM r WHERE ds_timestamp >= TIMESTAMP '2024-01-05 00:00:00' AND ds_timestamp < TIMESTAMP '2024-01-13 00:00:00'",
        "tag_projection": _with(RAW_SQL, _conf_sql(PROJECTION_TAGS))
        + "SELECT source, seq, id_source, value, value_d, user_i, angle, sog FROM conf",
        "bool_normalise": _with(RAW_SQL) + f"SELECT source, seq, flag_txt, {_typed('flag_txt', 'BOOLEAN')} AS flag FROM raw",
        "epoch_convert": _with(RAW_SQL) + f"SELECT source, seq, ds_timestamp AS raw_time, {_ID} AS id_source, "
                                          f"epoch_ms({_ID}) AS event_time FROM raw",
        "align_left_chain": "WITH " + _aligned_sql() + "\nSELECT * FROM aligned",
        "align_first_inner": _inner_sql(),
    }

    # Rated power of the generator engines in kW.
    loads = ", ".join(
        f"CAST(CAST(100.0 AS FLOAT) * {column} / CAST({kw} AS FLOAT) AS FLOAT) AS {ge}_load"
        for ge, column, kw in (("ge1", "view_value", 2750), ("ge2", "click_value", 3670), ("ge3", "error_value", 3670),
                               ("ge4", "purchase_value", 2750)))
    sql["derive_load"] = "WITH " + _aligned_sql() + f"\nSELECT ds_timestamp, {loads} FROM aligned"
    flags = ", ".join(f"{column} AS {name}" for name, column in FLAG_INPUTS.items())
    sql["derive_flags"] = "WITH " + _aligned_sql() + f"\nSELECT ds_timestamp, {flags} FROM aligned"
    s = SUM_INPUTS
    sums = (f"{s['ge1_fg_flow']} + {s['ge2_fg_flow']} + {s['ge3_fg_flow']} + {s['ge4_fg_flow']} AS ge_fg_flow, "
            f"{s['me1_fo_flow']} + {s['me2_fo_flow']} AS me_fo_flow, {s['me1_fg_flow']} + {s['me2_fg_flow']} AS me_fg_flow, "
            f"{s['auxb_fo_lsmgo_flow']} + {s['auxb_fo_vlsfo_flow']} AS auxb_fo_flow")
    sql["derive_sums"] = "WITH " + _aligned_sql() + f"\nSELECT ds_timestamp, {sums} FROM aligned"

    speed, direction = _wind(*(f"CAST({c} AS DOUBLE)" for c in ("value", "angle", "sog")))
    wind = f"w AS (SELECT source, seq, {speed} AS knots, {direction} AS heading FROM conf)"
    blown = _with(RAW_SQL, _conf_sql(PROJECTION_TAGS), wind)
    sql["true_wind"] = blown + ("SELECT source, seq, CAST(knots AS FLOAT) AS true_wind_speed, "
                                "CAST(heading AS FLOAT) AS true_wind_angle FROM w")
    sql["beaufort"] = blown + (f"SELECT source, seq, CAST(knots AS FLOAT) AS true_wind_speed, {_force('knots')} "
                               "AS beaufort_number FROM w")
    sql["beaufort_capped"] = blown + (f"SELECT source, seq, least(coalesce({_force('knots')}, 9), 9) AS beaufort_number FROM w")
    f_ = FUEL_INPUTS
    sql["fuel_totals"] = "WITH " + _aligned_sql() + (
        f"\nSELECT ds_timestamp, CAST(CAST({f_['me_fo_flow']} AS DOUBLE) + CAST({f_['ge_fo_flow']} AS DOUBLE) + "
        f"CAST({f_['auxb_fo_flow']} AS DOUBLE) AS FLOAT) AS foc, CAST(CAST({f_['me_fg_flow']} AS DOUBLE) + "
        f"CAST({f_['ge_fg_flow']} AS DOUBLE) AS FLOAT) AS fgc FROM aligned")

    full = _raw_table_ctes("rawt")
    sql["schema_enforce"] = _with(RAW_SQL, *_raw_table_ctes("rawb", derive=False)) + "SELECT * FROM rawb"
    sql["pipeline_raw"] = _with(RAW_SQL, *full) + "SELECT * FROM rawt"
    found = {"cargo_load": ("CAST(NULL AS VARCHAR)", "0 * count(*)"), "me1_fo_flow": ("'double'", "count(me1_fo_flow)")}
    sql["schema_contract"] = _with(RAW_SQL, *full) + "\nUNION ALL\n".join(
        f"SELECT '{column}' AS column_name, '{kind}' AS declared_type, {actual} AS actual_type, "
        f"CAST({n} AS BIGINT) AS non_null_rows FROM rawt"
        for column, kind in _RAW_COLUMNS
        for actual, n in [found.get(column, (f"'{kind}'", f"count({column})"))])
    sql["unloaded_readings"] = _with(RAW_SQL) + "\nUNION ALL\n".join(
        f"SELECT '{table}' AS table_name, count(*) AS readings, count(*) FILTER (seq % 89 = 0) AS no_time "
        f"FROM raw WHERE source = '{event}'" for event, table, _ in _SOURCES)
    sql["calc_table"] = _with(RAW_SQL, *full) + _calc_select("rawt", CALC_START, CALC_END)
    sql["pipeline_calc"] = _with(RAW_SQL, *full) + _calc_select("rawt")
    again = f"""again AS (SELECT * REPLACE (CASE source WHEN 'view' THEN NULL WHEN 'click' THEN user_txt ELSE value_txt END
                                            AS value_txt) FROM raw)"""
    loads_twice = [RAW_SQL, again, *_raw_table_ctes("one", None, TARGET_END),
                   *_raw_table_ctes("two", SOURCE_START, None, readings="again")]
    sql["stored_evolved"] = _with(*conf, f"r AS ({_resampled_sql(HOUR_MS)})") + """
SELECT source, ds_timestamp, id_source, CASE WHEN day(ds_timestamp) % 4 = 0 THEN value + CAST(1.0 AS FLOAT) ELSE value END AS value,
       CASE WHEN day(ds_timestamp) % 2 = 0 THEN flag END AS flag, CAST(day(ds_timestamp) AS INTEGER) AS ds_day
FROM r WHERE ds_timestamp IS NOT NULL"""
    sql["stored_appended"] = _with(*conf, f"r AS ({_resampled_sql(HOUR_MS)})") + """
SELECT source, ds_timestamp, id_source, CASE WHEN day(ds_timestamp) BETWEEN 8 AND 12 THEN value + CAST(1.0 AS FLOAT) ELSE value END AS value,
       flag, CAST(month(ds_timestamp) AS INTEGER) AS ds_month
FROM r WHERE ds_timestamp IS NOT NULL"""
    sql["stored_raw"] = _with(*loads_twice) + _merge_sql("one", "two")
    sql["stored_calc"] = _with(*loads_twice, f"both_loads AS ({_merge_sql('one', 'two')})") + _calc_select("both_loads")
    sql["minute_view_1h"] = _view_sql(HOUR_MS)
    minute = lambda event: f"""SELECT * FROM (SELECT *, {_floor(_ID, MINUTE_MS)} AS b FROM raw WHERE source = '{event}')
QUALIFY row_number() OVER (PARTITION BY ds_date, b ORDER BY {_ID}, seq) = 1"""  # noqa: E731
    sql["minute_view_sql"] = _with(RAW_SQL, f"v AS ({minute('view')})", f"c AS ({minute('click')})") + """SELECT v.b AS ds_timestamp,
  v.value_txt AS vdr_relative_wind_speed, v.angle_txt AS vdr_relative_wind_angle, v.sog_txt AS vdr_aivdo_sog,
  v.flag_txt AS me1_fg_use, v.user_txt AS ge2_1_power, c.value_txt AS me1_fo_flow, c.sog_txt AS me2_fo_flow,
  c.user_txt AS ge2_2_power, c.flag_txt AS me2_fg_use, v.ds_date
FROM v JOIN c ON c.ds_date = v.ds_date AND c.b = v.b"""
    sql["tag_catalog"] = _with(*_catalog_ctes()) + "SELECT hnum, col_name, db_name, table_name, tag, description, unit, data_type FROM existing"
    first = "'view', 'click'"
    k = f"CAST({_K} AS DOUBLE)"
    sql["schema_evolution_by_name"] = (
        f"SELECT value AS cola, CAST(user_id AS DOUBLE) AS colb, CAST(NULL AS DOUBLE) AS colc, 1 AS dt "
        f"FROM events WHERE event_type IN ({first})\nUNION ALL\n"
        f"SELECT value, CAST(user_id AS DOUBLE), {k}, 2 FROM events WHERE event_type NOT IN ({first})")
    sql["read_by_position"] = (
        f"SELECT value AS cola, CAST(user_id AS DOUBLE) AS colb, 1 AS dt FROM events WHERE event_type IN ({first})\n"
        f"UNION ALL\nSELECT {k}, value, 2 FROM events WHERE event_type NOT IN ({first})")
    sql["table_by_position"] = (
        f"SELECT value AS cola, CAST(user_id AS DOUBLE) AS colb, CAST(NULL AS DOUBLE) AS colc, 1 AS dt FROM events WHERE event_type IN ({first})\n"
        f"UNION ALL\nSELECT {k}, value, CAST(user_id AS DOUBLE), 2 FROM events WHERE event_type NOT IN ({first})")
    fleet = _raw_table_ctes("fleet", keys=("hnum",))
    sql["pipeline_raw_fleet"] = _with(RAW_SQL, *fleet) + "SELECT * FROM fleet"
    sql["pipeline_calc_fleet"] = _with(RAW_SQL, *fleet) + _calc_select("fleet", keys=("hnum",))

    sql["fleet_unlike_raw"] = _with(*_fleet_ctes()) + "SELECT * FROM fleet"
    sql["stored_fleet"] = _with(*_fleet_ctes()) + _calc_select("fleet", keys=("hnum",))

    pair = [RAW_SQL, *_raw_table_ctes("tgt", None, TARGET_END), *_raw_table_ctes("src0", SOURCE_START, None),
            f"src AS ({_REVISE} FROM src0)"]
    sql["upsert_raw"] = _with(*pair) + _merge_sql("tgt", "src")
    sql["upsert_idempotent"] = _with(*pair, f"once AS ({_merge_sql('tgt', 'src')})") + _merge_sql("once", "src")
    calc_pair = [*pair, f"ct AS ({_calc_select('tgt')})", f"cs AS ({_calc_select('src')})"]
    sql["upsert_calc"] = _with(*calc_pair) + _merge_sql("ct", "cs")

    cat = _catalog_ctes()
    sql["catalog_absent_keys"] = _with(*cat) + """SELECT e.* FROM existing e
WHERE e.hnum IN (SELECT DISTINCT hnum FROM incoming)
  AND NOT EXISTS (SELECT 1 FROM incoming i WHERE i.hnum = e.hnum AND i.col_name = e.col_name)"""
    sql["catalog_sync"] = _with(*cat) + """SELECT * FROM existing WHERE hnum NOT IN (SELECT DISTINCT hnum FROM incoming)
UNION ALL
SELECT e.id, i.hnum, i.col_name, i.db_name, i.table_name, i.tag, i.description, i.unit, i.data_type
FROM incoming i LEFT JOIN existing e ON e.hnum = i.hnum AND e.col_name = i.col_name"""
    sql["stored_catalog"] = _with(*cat) + """SELECT e.* FROM (
  SELECT * REPLACE (row_number() OVER (ORDER BY hnum, col_name) AS id) FROM existing) e
WHERE hnum NOT IN (SELECT hnum FROM incoming)
UNION ALL
SELECT coalesce(e.id, (SELECT count(*) FROM existing)
                      + row_number() OVER (PARTITION BY e.id IS NULL ORDER BY i.hnum, i.col_name)) AS id, i.*
FROM incoming i LEFT JOIN (
  SELECT hnum, col_name, row_number() OVER (ORDER BY hnum, col_name) AS id FROM existing) e
  ON e.hnum = i.hnum AND e.col_name = i.col_name"""
    sql["single_value_check"] = _with(*cat) + """SELECT db, count(DISTINCT hnum) AS n_hnum,
  CASE WHEN count(DISTINCT hnum) = 1 THEN min(hnum) END AS hnum, count(DISTINCT hnum) = 1 AS hnum_unique
FROM (SELECT hnum, CASE WHEN CAST(substr(hnum, 2) AS INTEGER) % 6 = 0 THEN 'solo_' || hnum ELSE db_name END AS db FROM existing)
GROUP BY db""".replace("SELECT db,", "SELECT db AS db_name,")
    sql["hull_database_check"] = _with(*cat) + """SELECT hnum, count(DISTINCT db) AS n_db_name,
  CASE WHEN count(DISTINCT db) = 1 THEN min(db) END AS db_name, count(DISTINCT db) = 1 AS db_name_unique
FROM (SELECT hnum, CASE WHEN CAST(substr(hnum, 2) AS INTEGER) % 4 = 0 AND id % 7 = 0 THEN 'elsewhere' ELSE db_name END AS db
      FROM existing) GROUP BY hnum"""
    sql["source_priority"] = _with(*cat) + _priority_sql()
    accepted = "'FLOAT', 'BOOLEAN', 'DOUBLE', 'INTEGER'"
    sql["type_whitelist"] = _with(*cat) + f"SELECT * FROM existing WHERE data_type IS NULL OR data_type NOT IN ({accepted})"
    sql["wide_schema"] = _with(*cat, """ruled AS (
  SELECT * REPLACE (CASE hnum WHEN 'H0000' THEN 'H2508' WHEN 'H0001' THEN 'H2521' ELSE hnum END AS hnum) FROM existing),
body AS (
  SELECT hnum, col_name, data_type FROM ruled
  UNION ALL SELECT hnum, col_name, 'FLOAT' FROM (VALUES
    ('H2508', 'ge_fg_flow'), ('H2508', 'ge1_load'), ('H2508', 'ge2_load'), ('H2508', 'ge3_load'), ('H2508', 'ge4_load'),
    ('H2508', 'me_fo_flow'), ('H2508', 'me_fg_flow'), ('H2508', 'auxb_fo_flow'),
    ('H2521', 'ge2_power'), ('H2521', 'me_fo_flow'), ('H2521', 'me_fg_flow')) AS more(hnum, col_name)
  WHERE hnum IN (SELECT hnum FROM ruled))""", f"prio AS ({_priority_sql('ruled')})") + """SELECT hnum, 0 AS position, 'ds_timestamp' AS column_name, 'TIMESTAMP' AS data_type
FROM (SELECT DISTINCT hnum FROM ruled)
UNION ALL
SELECT hnum, CAST(row_number() OVER (PARTITION BY hnum ORDER BY col_name, data_type) AS INTEGER), col_name, data_type FROM body
UNION ALL
SELECT p.hnum, CAST(w.n + p.priority AS INTEGER), 'id_' || p.table_name, 'BIGINT'
FROM prio p JOIN (SELECT hnum, count(*) AS n FROM body GROUP BY hnum) w ON w.hnum = p.hnum"""
    return sql

"""Driver tables seen through the pipeline's data model.

``events`` stands in for the raw pivot sources: each ``event_type`` is one
source table, and each row becomes one raw reading written the way raw tables
store it (texts). ``customer`` (with ``nation`` for the region) stands in for a
fleet-wide tag catalog: one hull per nation, its region as the database, one tag
per customer. Everything here is a lazy projection of the given parquet tables,
so its work grows with them.

Raw reading built from an ``events`` row
    ds_timestamp  epoch ms of ``ts`` as text with a '.0' suffix
    ds_date       'yyyyMMdd' of ``ts``
    value_txt     ``value`` as text; 'abc' (unparsable) when event_id % 97 = 0
    flag_txt      by k % 7 (k = props.k): 'TRUE', '1', 'false', '0', 'yes', NULL, ' true'
    angle_txt     k * 3.6 as text (degrees)
    sog_txt       user_id % 25 as text
    user_txt      user_id as text
    seq           event_id (tie-break between readings with the same millisecond)
    hnum          'H' + user_id % 5 as four digits: the hull of the reading in fleet runs
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.session import prepare
from keelson.sources.scans import day_bounds
from keelson.sources.tagcatalog import CATALOG_COLUMNS, CATALOG_SCHEMA, Tag

# Events.event_type -> source table name (base source first).
EVENT_SOURCES = {
    "view": "ev_ias_view_pivot",
    "click": "ev_vdr_click_pivot",
    "error": "ev_vdr_error_pivot",
    "purchase": "ev_vdr_purchase_pivot",
    "signup": "ev_vdr_signup_pivot",
}
TABLE_EVENT = {t: e for e, t in EVENT_SOURCES.items()}

# Flag texts chosen by k % 7.
FLAG_TEXTS = ("TRUE", "1", "false", "0", "yes", None, " true")

TESTBED_HULL = "H2521"
TESTBED_DB = "ev"

# The tag catalog of the events hull, as (col_name, source table, raw tag, unit, data_type).
_TESTBED_TAGS = [
    ("vdr_relative_wind_speed", "ev_ias_view_pivot", "value_txt", "kn", "FLOAT"),
    ("vdr_relative_wind_angle", "ev_ias_view_pivot", "angle_txt", "deg", "FLOAT"),
    ("vdr_aivdo_sog", "ev_ias_view_pivot", "sog_txt", "kn", "FLOAT"),
    ("me1_fg_use", "ev_ias_view_pivot", "flag_txt", "-", "BOOLEAN"),
    ("ge2_1_power", "ev_ias_view_pivot", "user_txt", "kW", "FLOAT"),
    ("me1_fo_flow", "ev_vdr_click_pivot", "value_txt", "kg/h", "FLOAT"),
    ("me2_fo_flow", "ev_vdr_click_pivot", "sog_txt", "kg/h", "FLOAT"),
    ("ge2_2_power", "ev_vdr_click_pivot", "user_txt", "kW", "FLOAT"),
    ("me2_fg_use", "ev_vdr_click_pivot", "flag_txt", "-", "BOOLEAN"),
    ("me1_fg_flow", "ev_vdr_error_pivot", "value_txt", "kg/h", "FLOAT"),
    ("ge_fo_flow", "ev_vdr_error_pivot", "angle_txt", "kg/h", "FLOAT"),
    ("ge_running_hours", "ev_vdr_error_pivot", "user_txt", "h", "INTEGER"),
    ("me2_fg_flow", "ev_vdr_purchase_pivot", "value_txt", "kg/h", "FLOAT"),
    ("auxb_fo_flow", "ev_vdr_purchase_pivot", "sog_txt", "kg/h", "FLOAT"),
    ("ge_fg_flow", "ev_vdr_purchase_pivot", "angle_txt", "kg/h", "FLOAT"),
    ("cargo_load", "ev_vdr_purchase_pivot", "user_txt", "t", "DOUBLE"),
    ("shaft_power", "ev_vdr_signup_pivot", "value_txt", "kW", "DOUBLE"),
    ("shaft_speed", "ev_vdr_signup_pivot", "sog_txt", "rpm", "FLOAT"),
    ("gcu_use", "ev_vdr_signup_pivot", "flag_txt", "-", "BOOLEAN"),
]

TESTBED_TAGS = [
    Tag(TESTBED_HULL, name, TESTBED_DB, table, tag, name.replace("_", " "), unit, dtype)
    for name, table, tag, unit, dtype in _TESTBED_TAGS
]

# Catalogs of two hulls unlike the testbed's, as (raw tag, data_type, col_names) by source table.
_UNLIKE_TAGS = {
    "H2508": {
        "ev_ias_view_pivot": [
            ("value_txt", "FLOAT", "ge1_power ge1_fg_flow vdr_relative_wind_speed"),
            ("angle_txt", "FLOAT", "ge2_power vdr_relative_wind_angle"),
            ("sog_txt", "FLOAT", "vdr_aivdo_sog ge2_fg_flow"),
            ("flag_txt", "BOOLEAN", "me1_fg_use me2_fg_use me1_fo_vlsfo_use me2_fo_vlsfo_use me1_fo_lsmgo_use"),
        ],
        "ev_vdr_error_pivot": [
            ("value_txt", "FLOAT", "ge3_power me1_fo_flow ge3_fg_flow"),
            ("user_txt", "FLOAT", "ge4_power me2_fo_flow auxb_fo_lsmgo_flow"),
            ("flag_txt", "BOOLEAN", "me2_fo_lsmgo_use ge1_fg_use ge2_fg_use ge3_fg_use ge4_fg_use"),
        ],
        "ev_vdr_signup_pivot": [
            ("value_txt", "FLOAT", "me1_fg_flow ge4_fg_flow ge_fo_flow"),
            ("user_txt", "FLOAT", "me2_fg_flow auxb_fo_vlsfo_flow"),
        ],
    },
    "H2532": {
        "ev_vdr_click_pivot": [
            ("value_txt", "FLOAT", "me1_fo_flow ge_fo_flow"), ("user_txt", "FLOAT", "me2_fo_flow"),
            ("sog_txt", "FLOAT", "ge2_1_power"), ("angle_txt", "FLOAT", "vdr_relative_wind_speed"),
        ],
        "ev_vdr_purchase_pivot": [
            ("value_txt", "FLOAT", "vdr_relative_wind_angle ge2_2_power"), ("sog_txt", "FLOAT", "vdr_aivdo_sog"),
            ("user_txt", "FLOAT", "me1_fg_flow"), ("user_txt", "INTEGER", "ge_running_hours"),
            ("angle_txt", "FLOAT", "me2_fg_flow"), ("flag_txt", "BOOLEAN", "hatch_open"),
        ],
    },
}

UNLIKE_TAGS = TESTBED_TAGS + [
    Tag(hull, name, TESTBED_DB, table, tag, None, None, dtype)
    for hull, tables in _UNLIKE_TAGS.items() for table, tags in tables.items()
    for tag, dtype, names in tags for name in names.split()
]

# Hull of a reading by user_id % 4, written as ships do; the last one has no catalog.
UNLIKE_HULLS = ("H2508", "H2521", " h2532", "H9999")

# Fleet runs: readings belong to hull user_id % FLEET_SIZE; all hulls share the testbed catalog.
FLEET_SIZE = 5


def _k() -> Column:
    return F.get_json_object(F.col("props"), "$.k").cast("int")


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table resolved through the session catalog, like any source table.

    The parquet file is registered once per session as a temporary view; later
    plans resolve the view instead of listing the file and reading its footer again.
    """
    import hashlib

    view = f"keelson_{name}_{hashlib.sha1(sf_dir.rstrip('/').encode()).hexdigest()[:12]}"
    if not spark.catalog.tableExists(view):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(view)
    return spark.table(view)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return driver_table(spark, sf_dir, "events")


def raw_readings(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """All events as raw readings, with ``source`` = event_type.

    ``start`` / ``end`` ('yyyyMMdd') leave out events of other days by a predicate on ``ts`` that
    reaches the Parquet scan: ``ds_date`` is computed from ``ts``, so a filter on it cannot.
    """
    e = events(spark, sf_dir)
    lo, hi = day_bounds(start, end)
    kind = e.schema["ts"].dataType
    if lo is not None:
        e = e.where(F.col("ts") >= lo.cast(kind))
    if hi is not None:
        e = e.where(F.col("ts") < hi.cast(kind))
    k = _k()
    flag = F.lit(None).cast("string")
    for i, text in reversed(list(enumerate(FLAG_TEXTS))):
        flag = F.when(k % 7 == i, F.lit(text).cast("string")).otherwise(flag)
    return e.select(
        F.col("event_type").alias("source"),
        F.col("event_id").alias("seq"),
        F.concat(F.unix_millis(F.col("ts").cast("timestamp")).cast("string"), F.lit(".0")).alias("ds_timestamp"),
        F.date_format(F.col("ts"), "yyyyMMdd").alias("ds_date"),
        F.when(F.col("event_id") % 97 == 0, F.lit("abc")).otherwise(F.col("value").cast("string")).alias("value_txt"),
        flag.alias("flag_txt"),
        (k * F.expr("3.6")).cast("string").alias("angle_txt"),
        (F.col("user_id") % 25).cast("string").alias("sog_txt"),
        F.col("user_id").cast("string").alias("user_txt"),
        _hull(F.col("user_id") % FLEET_SIZE).alias("hnum"),
    )


class SourceReader:
    """Table reader over the events sources (the filters on event_type and on days reach the Parquet scan)."""

    def __init__(self, spark: SparkSession, sf_dir: str, change=None):
        self.spark, self.sf_dir, self.change = spark, sf_dir, change

    def __call__(self, table_name: str) -> DataFrame:
        return self.between(table_name, None, None)

    def between(self, table_name: str, start: str | None, end: str | None) -> DataFrame:
        readings = raw_readings(self.spark, self.sf_dir, start, end).where(F.col("source") == TABLE_EVENT[table_name])
        return self.change(readings) if self.change else readings


def source_reader(spark: SparkSession, sf_dir: str) -> SourceReader:
    return SourceReader(spark, sf_dir)


def revised_reader(spark: SparkSession, sf_dir: str) -> SourceReader:
    """The same readings sent again: the values of ``view`` are lost, those of ``click`` are other ones."""
    def change(readings: DataFrame) -> DataFrame:
        source = F.col("source")
        return readings.withColumn(
            "value_txt", F.when(source == "view", F.lit(None).cast("string")).when(source == "click", F.col("user_txt"))
            .otherwise(F.col("value_txt")))
    return SourceReader(spark, sf_dir, change)


def unclocked_reader(spark: SparkSession, sf_dir: str) -> SourceReader:
    """The same readings, every 89th without a readable time."""
    return SourceReader(spark, sf_dir, lambda r: r.withColumn(
        "ds_timestamp", F.when(F.col("seq") % 89 == 0, F.lit("n/a")).otherwise(F.col("ds_timestamp"))))


def unlike_reader(spark: SparkSession, sf_dir: str) -> SourceReader:
    """The same readings, sent by hulls whose catalogs differ."""
    hulls = F.array(*[F.lit(h) for h in UNLIKE_HULLS])
    at = F.pmod(F.col("user_txt").cast("long"), F.lit(len(UNLIKE_HULLS))).cast("int")
    return SourceReader(spark, sf_dir, lambda r: r.withColumn("hnum", F.get(hulls, at)))


def unlike_catalog(spark: SparkSession) -> DataFrame:
    """The three hulls' catalogs as one table."""
    return spark.createDataFrame([tuple(getattr(t, c) for c in CATALOG_COLUMNS) for t in UNLIKE_TAGS], CATALOG_SCHEMA)


def _hull(nationkey: Column) -> Column:
    return F.concat(F.lit("H"), F.lpad(nationkey.cast("string"), 4, "0"))


# Source family of each market segment (it decides the priority of the segment's tables).
SEGMENT_FAMILY = {"AUTOMOBILE": "cams", "BUILDING": "ias", "FURNITURE": "ams", "HOUSEHOLD": "vdr", "MACHINERY": "ias"}

# How the incoming catalog files differ from the stored catalog. Hulls of the quiet
# region send no new files; the dropped segment's tags are gone, the changed segment's descriptions
# are rewritten (lower case) and the added segment's tags come with a second key ('<name>_b').
QUIET_REGION = 4
DROPPED_SEGMENT, CHANGED_SEGMENT, ADDED_SEGMENT = "AUTOMOBILE", "HOUSEHOLD", "MACHINERY"


def customer_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored fleet catalog from ``customer``: hull = nation, database = the nation's region,
    source table = hull + segment, one catalog row (tag) per customer, id = c_custkey."""
    prepare(spark)
    c = driver_table(spark, sf_dir, "customer")
    regions = driver_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    c = c.join(F.broadcast(regions), "c_nationkey", "left")  # nation has 25 rows at every scale factor
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    family = F.lit("vdr")
    for seg, fam in reversed(list(SEGMENT_FAMILY.items())):
        family = F.when(segment == seg, F.lit(fam)).otherwise(family)
    dtype = (F.when(key % 53 == 0, "VARCHAR").when(key % 10 < 6, "FLOAT").when(key % 10 < 8, "BOOLEAN")
             .when(key % 10 == 8, "DOUBLE").otherwise("INTEGER"))
    nk = F.lpad(F.col("c_nationkey").cast("string"), 4, "0")
    return c.select(
        key.alias("id"),
        _hull(F.col("c_nationkey")).alias("hnum"),
        F.lower(F.col("c_name")).alias("col_name"),
        F.concat(F.lit("fleet"), F.col("n_regionkey").cast("string")).alias("db_name"),
        F.concat(F.lit("h"), nk, F.lit("_"), family, F.lit("_"), F.lower(segment), F.lit("_pivot")).alias("table_name"),
        F.concat(F.lit("t"), key.cast("string")).alias("tag"),
        segment.alias("description"),
        F.when(F.col("c_acctbal") < 0, "kn").otherwise("kg/h").alias("unit"),
        dtype.alias("data_type"),
    )


def incoming_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New catalog files for every hull outside the quiet region (see the fixed values above)."""
    cat = customer_catalog(spark, sf_dir).where(F.col("db_name") != F.lit(f"fleet{QUIET_REGION}"))
    desc, name = F.col("description"), F.col("col_name")
    # one pass: every stored row yields its kept (possibly changed) version and, for the added
    # segment, a second key; dropped rows yield nothing
    kept = F.when(desc != DROPPED_SEGMENT, F.struct(
        name.alias("col_name"), F.when(desc == CHANGED_SEGMENT, F.lower(desc)).otherwise(desc).alias("description")))
    added = F.when(desc == ADDED_SEGMENT, F.struct(
        F.concat(name, F.lit("_b")).alias("col_name"), desc.alias("description")))
    rows = cat.select("*", F.explode(F.array(kept, added)).alias("__v")).where(F.col("__v").isNotNull())
    rows = rows.withColumns({"col_name": F.col("__v.col_name"), "description": F.col("__v.description")})
    return rows.select(*CATALOG_COLUMNS)


# Which event types land in each physical layout of the layout folders.
LAYOUT_1_EVENTS = ("view", "click")


def write_layouts(spark: SparkSession, sf_dir: str) -> str:
    """Write ``events`` as one table whose two partition folders have different physical layouts.

    ``dt=1`` (view, click rows) holds (cola, colb) = (value, user_id); ``dt=2`` (all other
    rows) holds (colc, cola, colb) = (k, value, user_id) -- a column added in front, the
    case where reading by position and reading by name disagree. Written under the
    shared checkpoint folder; returns the table folder.
    """
    import uuid

    from keelson.session import checkpoint_dir

    e = events(spark, sf_dir)
    base = f"{checkpoint_dir(spark)}/keelson-layouts-{uuid.uuid4().hex}"
    first = F.col("event_type").isin(*LAYOUT_1_EVENTS)
    value, user = F.col("value").alias("cola"), F.col("user_id").cast("double").alias("colb")
    e.where(first).select(value, user).write.parquet(f"{base}/dt=1")
    e.where(~first).select(_k().cast("double").alias("colc"), value, user).write.parquet(f"{base}/dt=2")
    return base


def write_catalog_csv(spark: SparkSession, sf_dir: str) -> str:
    """Write the customer fleet catalog as catalog CSV files (header, catalog column order)."""
    import uuid

    from keelson.session import checkpoint_dir

    path = f"{checkpoint_dir(spark)}/keelson-catalog-csv-{uuid.uuid4().hex}"
    customer_catalog(spark, sf_dir).select(*CATALOG_COLUMNS).write.option("header", True).csv(path)
    return path

import os

import pytest

from pyspark.sql import functions as F

from conftest import SF001
from keelson.plans.jobs import CALC_SCHEMA, build_raw, calc, run_hull
from keelson.plans.view import minute_view
from keelson.sources import testbed as tb
from keelson.sources.tagcatalog import wide_schema


def test_build_raw_shape(spark):
    raw = build_raw(tb.source_reader(spark, SF001), tb.TESTBED_TAGS, "20240101", "20240130", tiebreak=["seq"])
    assert raw.schema == wide_schema(tb.TESTBED_TAGS)
    n = raw.count()
    assert n == raw.select("ds_timestamp").distinct().count()  # one row per bucket
    base = tb.source_reader(spark, SF001)("ev_ias_view_pivot")
    buckets = base.select((F.col("ds_timestamp").try_cast("double").try_cast("bigint") / 15000).cast("long")).distinct().count()
    assert n == buckets  # left chain: as many rows as base buckets


def test_run_hull_is_idempotent(spark, scratch):
    raw_p, calc_p = os.path.join(scratch, "raw"), os.path.join(scratch, "calc")
    read = tb.source_reader(spark, SF001)
    run_hull(spark, read, tb.TESTBED_TAGS, "20240101", "20240115", raw_p, calc_p, tiebreak=["seq"])
    run_hull(spark, read, tb.TESTBED_TAGS, "20240110", "20240130", raw_p, calc_p, tiebreak=["seq"])
    first = sorted(spark.read.parquet(raw_p).drop("ds_month").collect())
    run_hull(spark, read, tb.TESTBED_TAGS, "20240110", "20240130", raw_p, calc_p, tiebreak=["seq"])
    assert sorted(spark.read.parquet(raw_p).drop("ds_month").collect()) == first
    full = build_raw(read, tb.TESTBED_TAGS, "20240101", "20240130", tiebreak=["seq"])
    assert sorted(full.collect()) == sorted(spark.read.parquet(raw_p).select(*full.columns).collect())
    stored_calc = spark.read.parquet(calc_p).select(*CALC_SCHEMA.names)
    assert sorted(stored_calc.collect()) == sorted(calc(full, "20240101", "20240130").collect())


def test_minute_view(spark):
    v = minute_view(tb.source_reader(spark, SF001), tb.TESTBED_TAGS, "1 hour", tiebreak=["seq"])
    assert v.columns[0] == "ds_timestamp" and v.columns[-1] == "ds_date"
    assert v.count() >= 0


def test_partitioned_sources_are_pruned(spark, scratch):
    """Sources stored as separate tables partitioned by ds_date: the day range becomes a partition filter."""
    readings = tb.raw_readings(spark, SF001)
    for event, table in tb.EVENT_SOURCES.items():
        (readings.where(F.col("source") == event).drop("source")
         .write.partitionBy("ds_date").parquet(os.path.join(scratch, table)))

    def read(name):
        return spark.read.parquet(os.path.join(scratch, name))

    raw = build_raw(read, tb.TESTBED_TAGS, "20240105", "20240112", tiebreak=["seq"])
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(ds_date") == 5
    read_schemas = [line for line in plan.split("\n") if "ReadSchema" in line or "FileScan" in line]
    assert read_schemas and not any("hnum" in line for line in read_schemas)  # unused columns are never read
    expect = build_raw(tb.source_reader(spark, SF001), tb.TESTBED_TAGS, "20240105", "20240112", tiebreak=["seq"])
    assert sorted(raw.collect()) == sorted(expect.collect())


def test_fleet_mode_matches_per_hull_runs(spark):
    read = tb.source_reader(spark, SF001)
    fleet = build_raw(read, tb.TESTBED_TAGS, "20240101", "20240130", keys=["hnum"], tiebreak=["seq"])
    one = "H0002"

    def read_one(name):
        return read(name).where(F.col("hnum") == one)

    single = build_raw(read_one, tb.TESTBED_TAGS, "20240101", "20240130", tiebreak=["seq"])
    assert sorted(fleet.where(F.col("hnum") == one).drop("hnum").collect()) == sorted(single.collect())


def test_date_label_and_utc_day_disagree(spark):
    """T12: a reading filed under ds_date 20240101 but taken 2024-01-02 00:00:05 UTC is loaded for day
    20240101 (raw follows ds_date) but not calculated for it (calc follows the UTC day)."""
    from keelson.sources.tagcatalog import Tag
    tags = [Tag("H0000", name, "db", "h0_ias_pivot", name, None, None, "FLOAT") for name in (
        "vdr_relative_wind_speed", "vdr_relative_wind_angle", "vdr_aivdo_sog", "me_fo_flow", "ge_fo_flow",
        "auxb_fo_flow", "me_fg_flow", "ge_fg_flow")]
    day1, day2 = 1_704_067_200_000, 1_704_153_605_000
    rows = [(f"{day1 + 1000}.0", "20240101"), (f"{day2}.0", "20240101"), (f"{day2 + 20_000}.0", "20240102")]
    cols = {t.col_name: "1.5" for t in tags}
    df = spark.createDataFrame([(ts, d, *cols.values()) for ts, d in rows],
                               "ds_timestamp string, ds_date string, " + ", ".join(f"{c} string" for c in cols))
    raw = build_raw(lambda name: df, tags, "20240101", "20240101")
    assert raw.count() == 2  # both rows labelled 20240101
    assert calc(raw, "20240101", "20240101").count() == 1  # only the one taken on 2024-01-01 UTC


def test_run_hull_into_catalog_tables_and_clear(spark):
    read = tb.source_reader(spark, SF001)
    spark.sql("DROP TABLE IF EXISTS h2521_raw_t")
    spark.sql("DROP TABLE IF EXISTS h2521_calc_t")
    run_hull(spark, read, tb.TESTBED_TAGS, "20240101", "20240110", raw_table="h2521_raw_t", calc_table="h2521_calc_t",
             tiebreak=["seq"])
    n = spark.table("h2521_raw_t").count()
    run_hull(spark, read, tb.TESTBED_TAGS, "20240105", "20240106", raw_table="h2521_raw_t", calc_table="h2521_calc_t",
             tiebreak=["seq"], clear=True)
    m = spark.table("h2521_raw_t").count()
    assert 0 < m < n  # cleared, then only the two days loaded
    assert spark.table("h2521_calc_t").count() == m
    expect = build_raw(read, tb.TESTBED_TAGS, "20240105", "20240106", tiebreak=["seq"])
    assert sorted(spark.table("h2521_raw_t").select(*expect.columns).collect()) == sorted(expect.collect())
    assert spark.table("h2521_raw_t").columns == wide_schema(tb.TESTBED_TAGS).names + ["ds_month"]


def test_sync_catalog_file(spark, scratch):
    import pytest
    from keelson.plans.jobs import sync_catalog_file
    header = "hnum,col_name,db_name,table_name,tag,description,unit,data_type"
    stored = os.path.join(scratch, "catalog")
    spark.createDataFrame([(7, "H1", "a", "db", "t", "x", "old", "kn", "FLOAT"), (8, "H1", "gone", "db", "t", "y", "d", "kn", "FLOAT"),
                           (9, "H2", "a", "db", "t", "x", "keep", "kn", "FLOAT")],
                          "id long, hnum string, col_name string, db_name string, table_name string, tag string, "
                          "description string, unit string, data_type string").write.partitionBy("hnum").parquet(stored)
    good = os.path.join(scratch, "h1.csv")
    with open(good, "w", encoding="utf-8-sig") as f:
        f.write(header + "\nh1 ,a,db,t,x,new,kn,FLOAT\nH1,b,db,t,z,added,kn,BOOLEAN\n")
    assert sync_catalog_file(spark, good, stored) == "H1"
    got = {(r.hnum, r.col_name): (r.id, r.description) for r in spark.read.parquet(stored).collect()}
    assert got == {("H1", "a"): (7, "new"), ("H1", "b"): (10, "added"), ("H2", "a"): (9, "keep")}
    bad = os.path.join(scratch, "two.csv")
    with open(bad, "w", encoding="utf-8") as f:
        f.write(header + "\nH1,a,db,t,x,d,kn,FLOAT\nH3,a,db,t,x,d,kn,FLOAT\n")
    with pytest.raises(ValueError, match="exactly one hull"):
        sync_catalog_file(spark, bad, stored)


def test_empty_source_warns_and_flows_through(spark, caplog):
    import logging
    from keelson.plans.jobs import resampled_sources
    read = tb.source_reader(spark, SF001)
    with caplog.at_level(logging.WARNING, logger="keelson.plans.jobs"):
        frames = resampled_sources(read, tb.TESTBED_TAGS, "20300101", "20300102", tiebreak=["seq"], warn_empty=True)
    assert len(frames) == 5 and all(f.count() == 0 for f in frames)
    assert sum("has no rows" in r.message for r in caplog.records) == 5


def test_fleet_run_stores_every_hull(spark, scratch):
    raw_p, calc_p = os.path.join(scratch, "fraw"), os.path.join(scratch, "fcalc")
    read = tb.source_reader(spark, SF001)
    run_hull(spark, read, tb.TESTBED_TAGS, "20240101", "20240130", raw_p, calc_p, tiebreak=["seq"], keys=["hnum"])
    expect = build_raw(read, tb.TESTBED_TAGS, "20240101", "20240130", keys=["hnum"], tiebreak=["seq"])
    stored = spark.read.parquet(raw_p).select(*expect.columns)
    assert sorted(stored.collect()) == sorted(expect.collect())
    assert {d for d in os.listdir(raw_p) if d.startswith("hnum=")} == {f"hnum=H000{i}" for i in range(tb.FLEET_SIZE)}
    assert spark.read.parquet(calc_p).count() == expect.count()


def test_library_entry_points_pin_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Seoul")
    try:
        raw = build_raw(tb.source_reader(spark, SF001), tb.TESTBED_TAGS, "20240101", "20240130", tiebreak=["seq"])
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        first = raw.orderBy("ds_timestamp").first()
        assert first.ds_timestamp.second % 15 == 0 and first.ds_timestamp.hour < 24
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_calc_invariants_on_the_pipeline(spark):
    from conftest import SF01
    from pyspark.sql import Window
    out = calc(build_raw(tb.source_reader(spark, SF01), tb.TESTBED_TAGS, "20240101", "20240130", tiebreak=["seq"]),
               "20240101", "20240130")
    bad_angle = out.where(F.col("true_wind_angle").isNotNull()
                          & ~((F.col("true_wind_angle") >= 0) & (F.col("true_wind_angle") < 360))).count()
    assert bad_angle == 0
    w = Window.orderBy("true_wind_speed", "ds_timestamp")
    drops = (out.where(F.col("true_wind_speed").isNotNull())
             .withColumn("prev", F.lag("beaufort_number").over(w))
             .where(F.col("beaufort_number") < F.col("prev")).count())
    assert drops == 0  # Beaufort class never decreases as speed grows
    assert out.select("ds_timestamp").distinct().count() == out.count()  # key unique


def test_view_date_predicate_reaches_every_source_partition(spark, scratch):
    readings = tb.raw_readings(spark, SF001)
    for event, table in tb.EVENT_SOURCES.items():
        (readings.where(F.col("source") == event).drop("source")
         .write.partitionBy("ds_date").parquet(os.path.join(scratch, table)))
    view = minute_view(lambda name: spark.read.parquet(os.path.join(scratch, name)), tb.TESTBED_TAGS, "1 hour",
                       tiebreak=["seq"])
    one_day = view.where(F.col("ds_date") == "20240105")
    import re
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"PartitionFilters: \[[^\]]*ds_date#\d+ = 20240105", plan)) == 5  # one per source scan
    assert sorted(one_day.collect()) == sorted(r for r in view.collect() if r.ds_date == "20240105")


def test_one_day_matches_the_catalog_schema(spark):
    """Schema from the catalog, one fixed day queried, every declared column present with its declared type."""
    import pytest
    from keelson.operators.contract import schema_violations
    schema = wide_schema(tb.TESTBED_TAGS)
    day = build_raw(tb.source_reader(spark, SF001), tb.TESTBED_TAGS, "20240105", "20240105", tiebreak=["seq"])
    if day.isEmpty():
        pytest.skip("no readings on the test day")
    assert set(schema.names) <= set(day.columns)
    assert schema_violations(day.schema, schema) == []


def test_inner_alignment_keeps_buckets_every_source_has(spark):
    read = tb.source_reader(spark, SF001)
    left = build_raw(read, tb.TESTBED_TAGS, "20240101", "20240130", every="1 hour", tiebreak=["seq"])
    inner = build_raw(read, tb.TESTBED_TAGS, "20240101", "20240130", every="1 hour", tiebreak=["seq"], how="inner")
    ids = [c for c in left.columns if c.startswith("id_")]
    complete = left.where(" AND ".join(f"{c} IS NOT NULL" for c in ids))
    assert sorted(inner.collect()) == sorted(complete.collect())


def test_fleet_minute_view_matches_per_hull_views(spark):
    read = tb.source_reader(spark, SF001)
    fleet = minute_view(read, tb.TESTBED_TAGS, "1 hour", keys=["hnum"], tiebreak=["seq"])
    for hull in ("H0000", "H0003"):
        one = minute_view(lambda name, h=hull: read(name).where(F.col("hnum") == h), tb.TESTBED_TAGS, "1 hour",
                          tiebreak=["seq"])
        assert sorted(fleet.where(F.col("hnum") == hull).drop("hnum").collect()) == sorted(one.collect())


def test_sync_catalog_folder_in_one_job(spark, scratch):
    import pytest
    from keelson.plans.jobs import sync_catalog_file
    header = "hnum,col_name,db_name,table_name,tag,description,unit,data_type"
    folder = os.path.join(scratch, "catalogs")
    os.makedirs(folder)
    for hull, cols in (("H1", "ab"), ("H2", "abc")):
        with open(os.path.join(folder, f"{hull}_metadata.csv"), "w", encoding="utf-8-sig") as f:
            f.write(header + "\n" + "".join(f"{hull},{c},db,t,{c},d,u,FLOAT\n" for c in cols))
    stored = os.path.join(scratch, "stored")
    assert sync_catalog_file(spark, folder, stored) == ["H1", "H2"]
    got = sorted((r.hnum, r.col_name) for r in spark.read.parquet(stored).collect())
    assert got == [("H1", "a"), ("H1", "b"), ("H2", "a"), ("H2", "b"), ("H2", "c")]
    with open(os.path.join(folder, "mixed.csv"), "w", encoding="utf-8") as f:
        f.write(header + "\nH3,a,db,t,a,d,u,FLOAT\nH4,a,db,t,a,d,u,FLOAT\n")
    with pytest.raises(ValueError, match="exactly one hull"):
        sync_catalog_file(spark, folder, stored)


def test_fleet_exchanges_are_keyed_on_hull_and_bucket(spark):
    import re
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        raw = build_raw(tb.source_reader(spark, SF001), tb.TESTBED_TAGS, "20240101", "20240130", keys=["hnum"],
                        tiebreak=["seq"])
        plan = raw._jdf.queryExecution().executedPlan().toString()
        keys = re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", plan)
        assert len(keys) == 5
        assert all(k.startswith("hnum#") and "ds_timestamp#" in k for k in keys)  # never the hull alone
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_readings_without_a_time_are_counted_before_the_resample(spark, scratch, caplog):
    import logging
    read = tb.unclocked_reader(spark, SF001)
    with caplog.at_level(logging.WARNING, logger="keelson.plans.jobs"):
        lost = run_hull(spark, read, tb.TESTBED_TAGS, raw_path=os.path.join(scratch, "r"), calc_path=os.path.join(scratch, "c"),
                        tiebreak=["seq"])
    bad = tb.events(spark, SF001).where("event_id % 89 = 0").count()
    assert bad > 5 and sum(lost.values()) == bad
    assert sum("without a readable time" in r.message for r in caplog.records) == sum(n > 0 for n in lost.values())
    assert spark.read.parquet(os.path.join(scratch, "r")).where("ds_timestamp IS NULL").count() == 0


def test_run_hull_warns_about_empty_sources(spark, scratch, caplog):
    import logging
    with caplog.at_level(logging.WARNING, logger="keelson.plans.jobs"):
        run_hull(spark, tb.source_reader(spark, SF001), tb.TESTBED_TAGS, "20300101", "20300102",
                 os.path.join(scratch, "r"), os.path.join(scratch, "c"), tiebreak=["seq"])
    assert sum("has no rows" in r.message for r in caplog.records) == 5


def test_clear_removes_the_files_of_a_location_table(spark, scratch):
    from keelson.plans.tables import clear_hull, create_table
    from pyspark.sql.types import LongType, StructField, StructType
    spark.sql("CREATE DATABASE IF NOT EXISTS clearing")
    folder = os.path.join(scratch, "h9_raw")
    create_table(spark, "clearing.h9_raw", StructType([StructField("a", LongType())]), location=folder)
    spark.sql("INSERT INTO clearing.h9_raw VALUES (1)")
    assert os.path.exists(folder)
    assert clear_hull(spark, "clearing", "H9") == ["h9_raw"]
    assert not os.path.exists(folder)


def test_dropped_columns_are_not_read(spark, scratch):
    from keelson.plans.tables import create_external_table, drop_columns
    from pyspark.sql.types import DoubleType, LongType, StructField, StructType
    spark.sql("CREATE DATABASE IF NOT EXISTS evolving")
    folder = os.path.join(scratch, "t")
    spark.createDataFrame([(1, 2.0, 1), (3, 4.0, 2)], "a long, b double, dt int").write.partitionBy("dt").parquet(folder)
    create_external_table(spark, "evolving", "t", StructType([StructField("a", LongType()), StructField("b", DoubleType())]), folder)
    spark.sql("MSCK REPAIR TABLE evolving.t")
    assert spark.table("evolving.t").columns == ["a", "b", "dt"]
    drop_columns(spark, "evolving.t", ["b"])
    assert sorted(map(tuple, spark.table("evolving.t").collect())) == [(1, 1), (3, 2)]
    with pytest.raises(ValueError, match="no columns"):
        drop_columns(spark, "evolving.t", ["b"])
    spark.sql("DROP TABLE evolving.t")


def test_time_predicates_reach_the_scan(spark):
    from keelson.plans.registry import QUERIES
    for name in ("range_scan", "half_open_scan", "calc_table"):
        plan = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.split("\n") if "PushedFilters" in line]
        assert scans and all("GreaterThanOrEqual(ts," in line and "LessThan(ts," in line for line in scans), name


@pytest.mark.parametrize("name", ["upsert_raw", "upsert_calc"])
def test_a_merge_that_keeps_target_rows_would_be_seen(spark, monkeypatch, name):
    from keelson.plans import registry
    right = sorted(map(repr, registry.QUERIES[name](spark, SF001).collect()))

    def keeps_target(target, source, keys):
        fresh = source.where(F.col(keys[0]).isNotNull()).join(target, list(keys), "left_anti").select(*target.columns)
        return target.unionByName(fresh)

    monkeypatch.setattr(registry, "merge_frames", keeps_target)
    assert sorted(map(repr, registry.QUERIES[name](spark, SF001).collect())) != right


def test_a_stored_merge_that_keeps_target_rows_would_be_seen(spark, monkeypatch):
    from keelson.operators import upsert
    from keelson.plans import registry
    right = sorted(map(repr, registry.QUERIES["stored_raw"](spark, SF001).collect()))
    monkeypatch.setattr(upsert, "merge_frames", lambda target, source, keys: target.unionByName(
        source.join(target, list(keys), "left_anti").select(*target.columns)))
    assert sorted(map(repr, registry.QUERIES["stored_raw"](spark, SF001).collect())) != right


def test_counts_come_from_the_loads_own_scan(spark, scratch, monkeypatch):
    """No second scan of the sources counts their readings; the numbers are those of one."""
    from keelson.plans import jobs
    want = {r["table_name"]: r["no_time"] for r in jobs.unloaded_readings(tb.unclocked_reader(spark, SF001), tb.TESTBED_TAGS).collect()}

    def never(*args, **kwargs):
        raise AssertionError("a second scan")

    monkeypatch.setattr(jobs, "unloaded_readings", never)
    got = run_hull(spark, tb.unclocked_reader(spark, SF001), tb.TESTBED_TAGS, None, None,
                   os.path.join(scratch, "raw"), os.path.join(scratch, "calc"), tiebreak=["seq"])
    assert got == want and sum(got.values()) > 0

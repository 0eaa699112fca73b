import os

from pyspark.sql import functions as F

from conftest import SF001
from keelson.__main__ import main
from keelson.plans.jobs import build_raw
from keelson.sources import testbed as tb
from keelson.sources.tagcatalog import CATALOG_COLUMNS


def _catalog_dir(scratch):
    d = os.path.join(scratch, "csv")
    os.makedirs(d)
    with open(os.path.join(d, f"{tb.TESTBED_HULL}_metadata.csv"), "w", encoding="utf-8-sig") as f:
        f.write(",".join(CATALOG_COLUMNS) + "\n")
        for t in tb.TESTBED_TAGS:
            f.write(",".join(getattr(t, c) or "" for c in CATALOG_COLUMNS) + "\n")
    return d


def test_load_command_against_catalog_source_tables(spark, scratch):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {tb.TESTBED_DB}")
    readings = tb.raw_readings(spark, SF001)
    for event, table in tb.EVENT_SOURCES.items():
        (readings.where(F.col("source") == event).drop("source").write.mode("overwrite")
         .partitionBy("ds_date").saveAsTable(f"{tb.TESTBED_DB}.{table}"))
    spark.sql("CREATE DATABASE IF NOT EXISTS dv")
    csv_dir = _catalog_dir(scratch)
    args = ["load", "--hull", "h2521", "--start", "2024-01-01", "--end", "2024-01-20", "--catalog-dir", csv_dir, "-c"]
    assert main(args, spark) == 0
    assert main(["load", "--hull", "H2521", "--start", "2024-01-15", "--end", "2024-01-30", "--catalog-dir", csv_dir],
                spark) == 0
    expect = build_raw(tb.source_reader(spark, SF001), tb.TESTBED_TAGS, "20240101", "20240130")
    stored = spark.table("dv.h2521_raw").select(*expect.columns)
    # catalog source tables carry no tie-break column; at this size no two readings of a source share a millisecond
    assert sorted(stored.collect()) == sorted(expect.collect())
    assert spark.table("dv.h2521_calc").count() == expect.count()


def test_sync_catalog_command(spark, scratch):
    stored = os.path.join(scratch, "catalog")
    csv_dir = _catalog_dir(scratch)
    assert main(["sync-catalog", "--path", f"{csv_dir}/{tb.TESTBED_HULL}_metadata.csv", "--catalog", stored], spark) == 0
    assert spark.read.parquet(stored).count() == len(tb.TESTBED_TAGS)


def test_load_command_into_parquet_folders(spark, scratch):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {tb.TESTBED_DB}")
    readings = tb.raw_readings(spark, SF001)
    for event, table in tb.EVENT_SOURCES.items():
        (readings.where(F.col("source") == event).drop("source").write.mode("overwrite")
         .partitionBy("ds_date").saveAsTable(f"{tb.TESTBED_DB}.{table}"))
    storage = os.path.join(scratch, "hulls")
    args = ["load", "--hull", "H2521", "--start", "2024-01-01", "--end", "2024-01-30", "--catalog-dir",
            _catalog_dir(scratch), "--storage", storage]
    assert main(args, spark) == 0
    expect = build_raw(tb.source_reader(spark, SF001), tb.TESTBED_TAGS, "20240101", "20240130")
    stored = spark.read.parquet(os.path.join(storage, "H2521", "raw")).select(*expect.columns)
    assert sorted(stored.collect()) == sorted(expect.collect())
    assert spark.read.parquet(os.path.join(storage, "H2521", "calc")).count() == expect.count()

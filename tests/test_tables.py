import os

from pyspark.sql.types import DoubleType, StructField, StructType

from keelson.plans import tables as T


def test_ddl_helpers(spark, scratch):
    spark.sql("CREATE DATABASE IF NOT EXISTS dvtest")
    assert T.database_exists(spark, "  DVTEST ")
    schema = StructType([StructField("ds_timestamp", DoubleType()), StructField("v", DoubleType()),
                         StructField("ds_month", DoubleType())])
    T.create_table(spark, "dvtest.h9_raw", schema, partition_cols=["ds_month"])
    T.create_table(spark, "dvtest.h9_calc", schema)
    T.create_table(spark, "dvtest.h10_raw", schema)
    T.create_table(spark, "dvtest.h1_raw", schema)
    assert T.list_tables(spark, "dvtest", "H1") == ["h1_raw"]  # not h10_raw
    T.clear_hull(spark, "dvtest", "H1")
    assert sorted(T.list_tables(spark, "dvtest", "H9")) == ["h9_calc", "h9_raw"]
    assert sorted(T.clear_hull(spark, "dvtest", "H9")) == ["h9_calc", "h9_raw"]
    assert T.list_tables(spark, "dvtest", "h10") == ["h10_raw"]
    assert T.drop_tables(spark, "dvtest", ["h10_raw"]) == []


def test_external_table_partitions_and_columns(spark, scratch):
    spark.sql("CREATE DATABASE IF NOT EXISTS dvtest")
    base = os.path.join(scratch, "ext")
    spark.createDataFrame([(1.0, 2.0)] * 3, "cola double, colb double").write.parquet(os.path.join(base, "dt=1"))
    spark.createDataFrame([(1.0, 2.0)] * 2, "cola double, colb double").write.parquet(os.path.join(base, "dt=2"))
    two = StructType([StructField("cola", DoubleType()), StructField("colb", DoubleType())])
    T.create_external_table(spark, "dvtest", "col_case", two, base)
    T.add_partition(spark, "dvtest.col_case", {"dt": 1}, os.path.join(base, "dt=1"))
    assert spark.table("dvtest.col_case").count() == 3
    T.add_partition(spark, "dvtest.col_case", {"dt": 2}, os.path.join(base, "dt=2"))
    assert spark.table("dvtest.col_case").count() == 5
    T.add_columns(spark, "dvtest.col_case", StructType([StructField("colc", DoubleType())]))
    rows = spark.table("dvtest.col_case").collect()
    assert all(r.colc is None for r in rows)
    spark.sql("DROP TABLE dvtest.col_case")


def test_create_curated_tables(spark):
    from keelson.sources import testbed as tb
    spark.sql("CREATE DATABASE IF NOT EXISTS dvtest")
    schema = T.create_raw_table(spark, "dvtest.h2521_raw", tb.TESTBED_TAGS)
    stored = spark.table("dvtest.h2521_raw")
    assert stored.columns == schema.names + ["ds_month"]
    calc_schema = T.create_calc_table(spark, "dvtest.h2521_calc")
    assert spark.table("dvtest.h2521_calc").columns == calc_schema.names + ["ds_month"]
    T.clear_hull(spark, "dvtest", "H2521")


def test_external_table_rejects_unsupported_types(spark, scratch):
    import pytest
    from pyspark.sql.types import ArrayType
    bad = StructType([StructField("cola", DoubleType()), StructField("tags", ArrayType(DoubleType()))])
    with pytest.raises(ValueError, match="unsupported column types"):
        T.create_external_table(spark, "default", "bad_ext", bad, os.path.join(scratch, "bad"))


def test_persistent_view(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS dvtest")
    spark.createDataFrame([(1, "20240101"), (2, "20240102")], "v int, ds_date string").write.mode("overwrite") \
        .saveAsTable("dvtest.view_src")
    T.create_or_replace_view(spark, "dvtest.one_day", "SELECT v FROM dvtest.view_src WHERE ds_date = '20240101'")
    T.create_or_replace_view(spark, "dvtest.one_day", "SELECT v FROM dvtest.view_src WHERE ds_date = '20240102'")
    assert [r.v for r in spark.table("dvtest.one_day").collect()] == [2]
    spark.sql("DROP VIEW dvtest.one_day")
    spark.sql("DROP TABLE dvtest.view_src")


def test_persistent_minute_view(spark):
    """Recreated in place, readable through the catalog, pruned by date."""
    from conftest import SF001
    from keelson.plans.view import create_minute_view, view_sql
    from keelson.sources import testbed as tb
    spark.sql("CREATE DATABASE IF NOT EXISTS views")
    tags = [t for t in tb.TESTBED_TAGS if t.table_name in ("ev_ias_view_pivot", "ev_vdr_click_pivot")]
    read = tb.source_reader(spark, SF001)
    for table in sorted({t.table_name for t in tags}):
        spark.sql(f"DROP TABLE IF EXISTS views.{table}")
        read(table).write.partitionBy("ds_date").saveAsTable(f"views.{table}")
    create_minute_view(spark, "views.aligned", tags, "1 day", db="views", tiebreak=["seq"])
    create_minute_view(spark, "views.aligned", tags, "1 hour", db="views", tiebreak=["seq"])
    rows = spark.table("views.aligned")
    assert rows.columns == ["ds_timestamp", *[t.col_name for t in tags], "ds_date"]
    assert rows.count() == spark.sql(view_sql(tags, "1 hour", db="views", tiebreak=["seq"])).count() > 10
    plan = rows.where("ds_date = '20240105'")._jdf.queryExecution().executedPlan().toString()
    assert len([line for line in plan.split("\n") if "PartitionFilters" in line and "= 20240105" in line]) == 2
    spark.sql("DROP VIEW views.aligned")

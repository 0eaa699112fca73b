import os

from pyspark.sql.types import DoubleType, StructField, StructType

from keelson.sources.scans import date_range, half_open, read_by_name, read_by_position


def _frames(spark, scratch):
    p1, p2 = os.path.join(scratch, "t", "dt=1"), os.path.join(scratch, "t", "dt=2")
    spark.createDataFrame([(1.0, 2.0)] * 3, "cola double, colb double").write.parquet(p1)
    spark.createDataFrame([(0.0, 1.0, 2.0)] * 3, "colc double, cola double, colb double").write.parquet(p2)
    return p1, p2


def test_by_name_and_evolution(spark, scratch):
    p1, p2 = _frames(spark, scratch)
    two = StructType([StructField("cola", DoubleType()), StructField("colb", DoubleType())])
    rows = read_by_name(spark, [p1, p2], two).collect()
    assert {(r.cola, r.colb) for r in rows} == {(1.0, 2.0)} and len(rows) == 6
    three = StructType([*two.fields, StructField("colc", DoubleType())])
    rows = read_by_name(spark, [p1, p2], three).collect()
    assert sorted((r.colc is None) for r in rows) == [False] * 3 + [True] * 3  # added column reads NULL from old files
    dropped = read_by_name(spark, [p1, p2], StructType([two.fields[0]]))
    assert dropped.columns == ["cola"]


def test_by_position(spark, scratch):
    p1, p2 = _frames(spark, scratch)
    two = StructType([StructField("cola", DoubleType()), StructField("colb", DoubleType())])
    rows = read_by_position(spark, [p1, p2], two, base_path=os.path.dirname(p1)).collect()
    got = {(r.dt, r.cola, r.colb) for r in rows}
    assert got == {(1, 1.0, 2.0), (2, 0.0, 1.0)}


def test_by_position_one_scan_per_layout(spark, scratch):
    base = os.path.join(scratch, "days")
    for day in (1, 2, 3):
        spark.createDataFrame([(float(day), 2.0)], "cola double, colb double").write.parquet(f"{base}/dt={day}")
    spark.createDataFrame([(0.0, 4.0, 5.0)], "colc double, cola double, colb double").write.parquet(f"{base}/dt=4")
    two = StructType([StructField("cola", DoubleType()), StructField("colb", DoubleType())])
    df = read_by_position(spark, [f"{base}/dt={d}" for d in (1, 2, 3, 4)], two, base_path=base)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2  # two layouts, two scans
    assert {(r.dt, r.cola, r.colb) for r in df.collect()} == {(1, 1.0, 2.0), (2, 2.0, 2.0), (3, 3.0, 2.0), (4, 0.0, 4.0)}


def test_date_filters(spark):
    import datetime as dt
    df = spark.createDataFrame([("20240104", dt.datetime(2024, 1, 4, 23, 59)), ("20240105", dt.datetime(2024, 1, 5)),
                                ("20240112", dt.datetime(2024, 1, 12, 23, 59, 59)), ("20240113", dt.datetime(2024, 1, 13))],
                               "ds_date string, ds_timestamp timestamp_ntz")
    assert [r.ds_date for r in date_range(df, "20240105", "20240112").orderBy("ds_date").collect()] == ["20240105", "20240112"]
    assert [r.ds_date for r in half_open(df, "20240105", "20240112").orderBy("ds_date").collect()] == ["20240105", "20240112"]


def test_projection_quotes_raw_names(spark):
    from keelson.sources.scans import project_source
    from keelson.sources.tagcatalog import Tag
    raw = spark.createDataFrame([("1704067200000.0", "2.5", "1")], "ds_timestamp string, `wind.speed` string, `flag a` string")
    tags = [Tag("H1", "w", "db", "t", "wind.speed", None, None, "FLOAT"), Tag("H1", "f", "db", "t", "flag a", None, None, "BOOLEAN")]
    row = project_source(raw, tags, id_col="id_t").first()
    assert (row.id_t, row.w, row.f) == (1704067200000, 2.5, True)


def test_projection_accepts_timestamp_typed_time(spark):
    import datetime as dt
    from keelson.sources.scans import project_source
    from keelson.sources.tagcatalog import Tag
    tags = [Tag("H1", "w", "db", "t", "w", None, None, "FLOAT")]
    as_ts = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7, 179000), "1.5")], "ds_timestamp timestamp_ntz, w string")
    as_text = spark.createDataFrame([("1704067207179.0", "1.5")], "ds_timestamp string, w string")
    assert project_source(as_ts, tags, "id").first().id == project_source(as_text, tags, "id").first().id == 1704067207179

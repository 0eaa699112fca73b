import math

from pyspark.sql import functions as F

from keelson.functions.conform import epoch_ms, ms_to_timestamp, normalise_bool, typed_tag


def test_boolean_texts(spark):
    texts = ["TRUE", "1", "0", "False", "yes", "t", " true", "1.0", None, "false"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = dict(df.select("x", normalise_bool("x").alias("b")).collect())
    assert got == {"TRUE": True, "1": True, "0": False, "False": False, "yes": None, "t": None,
                   " true": None, "1.0": None, None: None, "false": False}


def test_bad_numbers_become_null(spark):
    df = spark.createDataFrame([("abc",), ("",), ("1e40",), ("NaN",), ("2.5",)], "x string")
    rows = [r[0] for r in df.select(typed_tag("x", "FLOAT")).collect()]
    assert rows[0] is None and rows[1] is None
    assert math.isinf(rows[2])  # Spark reads an out-of-range FLOAT text as Infinity
    assert math.isnan(rows[3])
    assert rows[4] == 2.5
    ints = [r[0] for r in spark.createDataFrame([("8",), ("x",)], "x string").select(typed_tag("x", "INTEGER")).collect()]
    assert ints == [8, None]


def test_epoch_double_hop(spark):
    df = spark.createDataFrame([("1767225659123.0",), ("1767225659123",), ("bad",), (None,)], "x string")
    rows = df.select(epoch_ms("x").alias("ms"), F.col("x").try_cast("bigint").alias("direct")).collect()
    assert [r.ms for r in rows] == [1767225659123, 1767225659123, None, None]
    assert rows[0].direct is None  # why the double hop exists


def test_ms_to_timestamp_is_utc_wall_clock(spark):
    import datetime as dt
    row = spark.range(1).select(ms_to_timestamp(F.lit(1767225659123)).alias("t")).first()
    assert row.t == dt.datetime(2026, 1, 1, 0, 0, 59, 123000)

import datetime as dt

import pytest
from pyspark.sql import functions as F

from keelson.functions.wind import BEAUFORT_BOUNDS, beaufort, fuel_total, true_wind_angle, true_wind_speed
from keelson.plans.jobs import CALC_SCHEMA, calc


def test_hand_checked_true_wind(spark):
    rows = [(0.0, 0.0, 10.0), (10.0, 0.0, 0.0), (10.0, 90.0, 0.0), (10.0, 270.0, 0.0), (10.0, 0.0, 10.0)]
    df = spark.createDataFrame(rows, "w float, a float, s float")
    got = df.select(true_wind_speed("w", "a", "s").alias("v"), true_wind_angle("w", "a", "s").alias("d")).collect()
    expect = [(10, 0), (10, 180), (10, 270), (10, 90), (0, 0)]
    for r, (v, d) in zip(got, expect):
        assert r.v == pytest.approx(v, abs=1e-4) and r.d == pytest.approx(d, abs=1e-4)


def test_beaufort_bounds_belong_to_higher_class(spark):
    speeds = [0.0, 0.999, *BEAUFORT_BOUNDS, 100.0, None, float("nan")]
    df = spark.createDataFrame([(s,) for s in speeds], "s double")
    got = [r[0] for r in df.select(beaufort("s")).collect()]
    assert got == [0, 0, *range(1, 13), 12, None, 12]


def test_beaufort_monotone(spark):
    df = spark.range(0, 800).select((F.col("id") / 10.0).alias("s"))
    got = [r[0] for r in df.orderBy("s").select(beaufort("s")).collect()]
    assert got == sorted(got) and got[0] == 0 and got[-1] == 12


def test_fuel_total_null_and_widening(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (0.1, 0.2, 0.3)], "a float, b float, c float")
    got = [r[0] for r in df.select(fuel_total("a", "b", "c")).collect()]
    assert got[0] is None
    import numpy as np
    exp = np.float32(float(np.float32(0.1)) + float(np.float32(0.2)) + float(np.float32(0.3)))
    assert got[1] == float(exp)


def _raw(spark):
    names = ["vdr_relative_wind_speed", "vdr_relative_wind_angle", "vdr_aivdo_sog", "me_fo_flow", "ge_fo_flow",
             "auxb_fo_flow", "me_fg_flow", "ge_fg_flow"]
    rows = [
        (dt.datetime(2024, 1, 1, 0, 0, 0), 10.0, 90.0, 0.0, 1.0, 2.0, 3.0, 4.0, 5.0),
        (dt.datetime(2024, 1, 2, 23, 59, 45), 3.0, 0.0, 0.0, 1.0, None, 3.0, 4.0, 5.0),
        (dt.datetime(2024, 1, 3, 0, 0, 0), 3.0, 0.0, 0.0, 1.0, 2.0, 3.0, 4.0, 5.0),
    ]
    schema = "ds_timestamp timestamp_ntz, " + ", ".join(f"{n} float" for n in names)
    return spark.createDataFrame(rows, schema)


def test_calc_window_is_half_open_and_typed(spark):
    out = calc(_raw(spark), "20240101", "20240102")
    assert out.schema == CALC_SCHEMA
    rows = out.orderBy("ds_timestamp").collect()
    assert len(rows) == 2  # 2024-01-03 00:00 is outside [01-01 00:00, 01-03 00:00)
    assert rows[0].beaufort_number == 3 and rows[0].foc == 6.0 and rows[0].fgc == 9.0
    assert rows[1].foc is None and rows[1].beaufort_number == 1
    assert all(0 <= r.true_wind_angle < 360 for r in rows)


def test_calc_requires_inputs(spark):
    with pytest.raises(ValueError, match="calc needs"):
        calc(_raw(spark).drop("ge_fg_flow"), "20240101", "20240102")


def test_capped_scale_without_null_guard(spark):
    df = spark.createDataFrame([(0.5,), (40.9,), (41.0,), (70.0,), (None,)], "s double")
    got = [r[0] for r in df.select(beaufort("s", cap=9, null_guard=False)).collect()]
    assert got == [0, 8, 9, 9, 9]
    with pytest.raises(ValueError):
        beaufort("s", cap=13)

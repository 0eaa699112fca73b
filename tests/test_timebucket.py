import pytest

from keelson.functions.timebucket import bucket_text, floor_ms, parse_every, text_to_ms
from keelson.sources.scans import day_bounds


@pytest.mark.parametrize("text, ms", [("15s", 15_000), ("15 seconds", 15_000), ("1 minute", 60_000), ("1h", 3_600_000),
                                      ("2 days", 172_800_000), (250, 250)])
def test_parse_every(text, ms):
    assert parse_every(text) == ms


@pytest.mark.parametrize("bad", ["", "15", "fifteen seconds", "3 fortnights", 0, -5])
def test_parse_every_rejects(bad):
    with pytest.raises(ValueError):
        parse_every(bad)


def test_bucket_text_round_trip(spark):
    rows = spark.createDataFrame([(1_704_067_259_999,), (1_704_067_260_000,), (-1,)], "ms long").select(
        floor_ms("ms", 60_000).alias("b")).select("b", bucket_text("b").alias("t")).select(
        "b", "t", text_to_ms("t").alias("back")).collect()
    assert [r.t for r in rows] == ["2024-01-01 00:00", "2024-01-01 00:01", "1969-12-31 23:59"]
    assert all(r.back == r.b for r in rows)


def test_day_bounds_cross_month(spark):
    lo, hi = day_bounds("20240130", "20240131")
    got = spark.range(1).select(lo.alias("lo"), hi.alias("hi")).first()
    assert (got.lo.isoformat(), got.hi.isoformat()) == ("2024-01-30T00:00:00", "2024-02-01T00:00:00")

import pytest

from keelson.operators.align import align_first_inner, align_left
from keelson.operators.resample import first_per_bucket

T0 = 1_704_067_200_000


def _src(spark, name, times):
    rows = [(t, i, float(i)) for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, f"id_{name} long, seq long, {name}_v float")
    return first_per_bucket(df, "15s", time_col=f"id_{name}", tiebreak=["seq"]).drop("seq")


def test_left_chain_base_drives_rows(spark):
    base = _src(spark, "a", [T0, T0 + 15_000, T0 + 30_000])
    other = _src(spark, "b", [T0 + 1, T0 + 45_000])  # one match, one bucket missing from base
    empty = spark.createDataFrame([], "id_c long, seq long, c_v float").drop("seq")
    empty = first_per_bucket(empty.withColumn("seq", empty.id_c), "15s", time_col="id_c", tiebreak=["seq"]).drop("seq")
    out = align_left([base, other, None, empty]).orderBy("ds_timestamp").collect()
    assert len(out) == 3  # the base has 3 buckets; b's extra bucket is lost
    assert out[0].b_v == 0.0 and out[1].b_v is None and out[2].c_v is None


def test_left_chain_rejects_duplicate_columns(spark):
    a = _src(spark, "a", [T0])
    with pytest.raises(ValueError):
        align_left([a, a])


def test_inner_chain_drops_incomplete_minutes(spark):
    def frame(name, times):
        rows = [(t, "20240101", i, float(i)) for i, t in enumerate(times)]
        return spark.createDataFrame(rows, f"id long, ds_date string, seq long, {name} float")
    a = frame("a", [T0 + 5, T0 + 1, T0 + 60_000])
    b = frame("b", [T0 + 30_000])
    out = align_first_inner([a, b], "1 minute", tiebreak=["seq"]).collect()
    assert len(out) == 1
    assert out[0].ds_timestamp == T0 and out[0].a == 1.0 and out[0].b == 0.0 and out[0].ds_date == "20240101"


def test_joins_reuse_first_row_partitioning(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frames = [_src(spark, n, [T0, T0 + 15_000]) for n in ("a", "b", "c")]
        df = align_left(frames)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("Exchange hashpartitioning") == 3  # one per source, none for the joins
        assert plan.count("SortMergeJoin") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_documented_sf001_counts(spark):
    """Counts stated for the sf0.01 events fixture: buckets per width, left / inner chain sizes, matches."""
    from pyspark.sql import functions as F
    from conftest import SF01
    from keelson.plans.registry import QUERIES, _conformed
    conf = _conformed(spark, SF01).drop("ds_date")
    counts = {w: first_per_bucket(conf, w, time_col="id_source", keys=["source"], tiebreak=["seq"]).count()
              for w in ("15 seconds", "15 minutes", "1 hour")}
    assert counts == {"15 seconds": 9959, "15 minutes": 7206, "1 hour": 3385}
    left = QUERIES["align_left_chain"](spark, SF01)
    assert left.count() == 667
    assert [left.where(F.col(f"id_{e}").isNotNull()).count() for e in ("click", "error", "purchase")] == [628, 629, 624]
    assert QUERIES["align_first_inner"](spark, SF01).count() == 524  # five sources
    four = [_conformed(spark, SF01).where(F.col("source") == e).select(F.col("id_source").alias("id"), "ds_date", "seq", F.col("value").alias(e))
            for e in ("view", "click", "error", "purchase")]
    assert align_first_inner(four, 3_600_000, time_col="id", tiebreak=["seq"]).count() == 554


def test_inner_chain_ties_are_deterministic_without_tiebreak(spark):
    t = T0 + 5
    a = spark.createDataFrame([(t, "20240101", 3.0), (t, "20240101", 1.0), (t, "20240101", 2.0)], "id long, ds_date string, a double")
    b = spark.createDataFrame([(t, "20240101", 7.0)], "id long, ds_date string, b double")
    rows = align_first_inner([a.repartition(3), b], "1 minute").collect()
    assert [(r.a, r.b) for r in rows] == [(1.0, 7.0)]

import datetime as dt

from pyspark.sql import functions as F

from keelson.operators.resample import first_per_bucket

T0 = 1_704_067_200_000  # 2024-01-01 00:00:00 UTC


def _df(spark, rows):
    return spark.createDataFrame(rows, "id long, seq long, v float, f boolean")


def test_whole_row_pick_keeps_nulls(spark):
    rows = [(T0 + 1000, 1, None, True), (T0 + 2000, 2, 5.0, False), (T0 + 14_999, 3, 7.0, None)]
    out = first_per_bucket(_df(spark, rows), "15 seconds", tiebreak=["seq"]).collect()
    assert len(out) == 1
    assert out[0].id == T0 + 1000 and out[0].v is None and out[0].f is True  # no coalescing across rows


def test_bucket_edges(spark):
    rows = [(T0 + 14_999, 1, 1.0, None), (T0 + 15_000, 2, 2.0, None)]
    out = first_per_bucket(_df(spark, rows), "15s", tiebreak=["seq"]).orderBy("ds_timestamp").collect()
    assert [r.ds_timestamp for r in out] == [dt.datetime(2024, 1, 1, 0, 0, 0), dt.datetime(2024, 1, 1, 0, 0, 15)]


def test_equal_times_tiebreak_and_shuffle_invariance(spark):
    rows = [(T0 + 5, s, float(s), None) for s in (9, 3, 7)] + [(T0 + 20_000, 1, 1.0, None)]
    df = _df(spark, rows)
    a = first_per_bucket(df, "15s", tiebreak=["seq"]).orderBy("ds_timestamp").collect()
    b = first_per_bucket(df.repartition(3).orderBy(F.rand(7)), "15s", tiebreak=["seq"]).orderBy("ds_timestamp").collect()
    assert a == b
    assert a[0].seq == 3


def test_null_time_forms_own_bucket_and_pre_epoch_floors(spark):
    rows = [(None, 1, 1.0, None), (-1, 2, 2.0, None)]
    out = first_per_bucket(_df(spark, rows), "15s", tiebreak=["seq"]).collect()
    by_seq = {r.seq: r for r in out}
    assert by_seq[1].ds_timestamp is None
    assert by_seq[2].ds_timestamp == dt.datetime(1969, 12, 31, 23, 59, 45)


def test_keys_partition_the_buckets(spark):
    rows = [("a", T0, 1), ("b", T0 + 1, 2), ("a", T0 + 2, 3)]
    df = spark.createDataFrame(rows, "k string, id long, seq long")
    out = first_per_bucket(df, "1 minute", keys=["k"], tiebreak=["seq"]).orderBy("k").collect()
    assert [(r.k, r.seq) for r in out] == [("a", 1), ("b", 2)]


def test_plan_has_map_side_top1(spark):
    df = _df(spark, [(T0, 1, 1.0, None)])
    plan = first_per_bucket(df, "15s", tiebreak=["seq"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def _exchanges(plan):
    """(description, shuffled records) of every hash exchange in an executed (adaptive) plan."""
    out, seen = [], set()
    stack = [plan.executedPlan() if plan.nodeName().startswith("AdaptiveSparkPlan") else plan]
    while stack:
        node = stack.pop()
        if node.id() in seen:
            continue
        seen.add(node.id())
        for attr in ("plan", "shuffle"):
            try:
                sub = getattr(node, attr)()
                if hasattr(sub, "children"):
                    stack.append(sub)
            except Exception:
                pass
        children = node.children()
        stack.extend(children.apply(i) for i in range(children.size()))
        if node.nodeName() == "Exchange" and "hashpartitioning" in node.toString():
            out.append(node.metrics().apply("shuffleRecordsWritten").value())
    return out


def test_hot_bucket_is_cut_before_the_shuffle(spark):
    """A third of all readings share one instant: each map task sends at most one of them."""
    from conftest import SF01
    e = spark.read.parquet(f"{SF01}/events.parquet")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(T0)).otherwise(ms)
    maps = 8
    df = e.select(hot.alias("id"), F.col("event_id").alias("seq"), "value").repartition(maps)
    n_hot = df.where(F.col("id") == T0).count()
    n_cold = df.count() - n_hot
    out = first_per_bucket(df, "15s", tiebreak=["seq"])
    rows = out.collect()
    shuffled = _exchanges(out._jdf.queryExecution().executedPlan())
    assert len(shuffled) == 1 and shuffled[0] <= n_cold + maps
    hot_row = [r for r in rows if r.id == T0]
    assert len(hot_row) == 1 and hot_row[0].seq == 0  # whole result kept, smallest tie-break wins

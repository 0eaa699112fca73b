"""Hulls with unlike catalogs in one job, against a row-by-row version."""

import random

import pytest
from pyspark.sql import functions as F

from keelson.plans import fleet
from keelson.plans.fleet import fleet_raw, load_fleet
from keelson.plans.jobs import PARTITION_COL
from keelson.sources.tagcatalog import CATALOG_SCHEMA

# (hull, column, table, tag, type): hull B's base is another table than hull A's, and C has a table of its own.
TAGS = [
    ("A", "speed", "x_ias", "t1", "FLOAT"), ("A", "open", "x_ias", "t2", "BOOLEAN"), ("A", "draft", "x_vdr", "t1", "DOUBLE"),
    ("b ", "speed", "x_vdr", "t2", "FLOAT"), ("B", "draft", "x_ams", "t.9", "DOUBLE"), ("B", "turns", "x_vdr", "t1", "INTEGER"),
    ("C", "open", "c_own", "t1", "BOOLEAN"), ("C", "speed", "c_own", "t2", "FLOAT"),
]
TAG_COLUMNS = {"x_ias": ["t1", "t2"], "x_vdr": ["t1", "t2"], "x_ams": ["t.9"], "c_own": ["t1", "t2"]}
BUCKET = 15_000
DAY0 = 1_767_225_600_000  # 2026-01-01


def catalog(spark, tags=TAGS):
    return spark.createDataFrame([(h, c, "db", t, g, None, None, k) for h, c, t, g, k in tags], CATALOG_SCHEMA)


def readings(seed=1, n=160):
    rng = random.Random(seed)
    tables = {}
    for table, tags in TAG_COLUMNS.items():
        rows = []
        for seq in range(n):
            when = rng.choice([None, "n/a"]) if rng.random() < 0.05 else f"{DAY0 + rng.randint(0, 20) * 5000}.0"
            hull = rng.choice(["A", " a", "B", "B", "Z", None])
            rows.append((hull, when, "20260101", seq, *[rng.choice(["1", "0", "2.5", "7", "x", None]) for _ in tags]))
        tables[table] = rows
    return tables


def reader(spark, tables):
    def read(name):
        tags = ", ".join(f"`{t}` string" for t in TAG_COLUMNS[name])
        df = spark.createDataFrame(tables[name], f"hnum string, ds_timestamp string, ds_date string, seq long, {tags}")
        return df.drop("hnum") if name == "c_own" else df
    return read


def typed(text, kind):
    if text is None or text == "x":
        return None
    if kind == "BOOLEAN":
        return {"1": True, "0": False}.get(text)
    if kind == "INTEGER":
        return None if "." in text else int(text)
    return float(text)


def slow_fleet(tables, how):
    out = []
    order = ["x_ias", "x_ams", "x_vdr", "c_own"]  # by keyword, then name
    for hull in "ABC":
        tags = [t for t in TAGS if t[0].strip().upper() == hull]
        sources = [t for t in order if any(x[2] == t for x in tags)]
        first = []
        for table in sources:
            found = {}
            for own, when, _, seq, *texts in tables[table]:
                if table != "c_own" and (own is None or own.strip().upper() != hull):
                    continue
                ms = int(float(when)) if when and when != "n/a" else None
                bucket = None if ms is None else ms // BUCKET * BUCKET
                key = (ms is not None, ms or 0, seq)
                if bucket not in found or key < found[bucket][0]:
                    found[bucket] = (key, ms, dict(zip(TAG_COLUMNS[table], texts, strict=True)))
            first.append(found)
        for bucket in first[0]:
            if how == "inner" and (bucket is None or any(bucket not in f for f in first)):
                continue
            row = dict.fromkeys(["draft", "open", "speed", "turns", "id_source_1", "id_source_2"])
            for i, (table, found) in enumerate(zip(sources, first, strict=True)):
                if bucket not in found or (i and bucket is None):
                    continue
                row[f"id_source_{i + 1}"] = found[bucket][1]
                for _, column, t, tag, kind in tags:
                    if t == table:
                        row[column] = typed(found[bucket][2][tag], kind)
            out.append((hull, bucket, *row.values()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_row_by_row(spark, how, seed):
    tables = readings(seed)
    got = fleet_raw(reader(spark, tables), catalog(spark), tiebreak=["seq"], how=how)
    assert got.columns == ["hnum", "ds_timestamp", "draft", "open", "speed", "turns", "id_source_1", "id_source_2"]
    rows = got.withColumn("ds_timestamp", F.unix_millis(F.col("ds_timestamp").cast("timestamp"))).collect()
    assert sorted((tuple(r) for r in rows), key=repr) == slow_fleet(tables, how)
    assert len(rows) > 10


def test_same_rows_without_broadcasts_and_an_empty_source(spark, monkeypatch):
    monkeypatch.setattr(fleet, "LAYOUT_BYTES", 0)
    tables = {**readings(3), "x_vdr": []}
    want = slow_fleet(tables, "left")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = fleet_raw(reader(spark, tables), catalog(spark), tiebreak=["seq"])
        rows = got.withColumn("ds_timestamp", F.unix_millis(F.col("ds_timestamp").cast("timestamp"))).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted((tuple(r) for r in rows), key=repr) == want


@pytest.mark.parametrize("tags, why", [
    (TAGS + [("B", "open", "x_ams", "t.9", "FLOAT")], "different types"),
    (TAGS + [("B", "speed", "x_ams", "t.9", "FLOAT")], "duplicate column"),
    (TAGS + [("B", "note", "x_ams", "t.9", "VARCHAR")], "unsupported data types"),
    (TAGS + [("B", "", "x_ams", "t.9", "FLOAT")], "lack a hull"),
    (TAGS + [("A", "more", "c_own", "t1", "FLOAT")], "no hull column"),
    (TAGS + [("A", "more", "x_ams", "t7", "FLOAT")], "lacks catalogued tags"),
    (TAGS + [("H2521", "speed", "x_ias", "t1", "FLOAT")], "need missing columns"),
    ([], "empty tag catalog"),
])
def test_invalid_catalogs_are_refused(spark, tags, why):
    with pytest.raises(ValueError, match=why):
        fleet_raw(reader(spark, readings()), catalog(spark, tags))


def test_hot_hull_reaches_the_union_as_first_readings_only(spark):
    """The plan cuts each table to one reading per bucket in its map tasks, before any exchange."""
    plan = fleet_raw(reader(spark, readings()), catalog(spark), tiebreak=["seq"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 * len(TAG_COLUMNS)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # Where each column stands is sent to the readings, never the readings to their hull.
    assert plan.count("BroadcastHashJoin [__hnum") == 3 and "SortMergeJoin [__hnum" not in plan


def test_loads_gain_the_columns_of_new_hulls(spark, scratch):
    calc_tags = [("A", c, "x_ias", "t1", "FLOAT") for c in (
        "vdr_relative_wind_speed", "vdr_relative_wind_angle", "vdr_aivdo_sog", "me_fo_flow", "ge_fo_flow",
        "auxb_fo_flow", "me_fg_flow", "ge_fg_flow")]
    tables = readings(4)
    read = reader(spark, tables)
    raw, calc = f"{scratch}/raw", f"{scratch}/calc"
    load_fleet(spark, read, catalog(spark, calc_tags), raw, calc, tiebreak=["seq"])
    once = spark.read.parquet(raw).count()
    more = calc_tags + [("B", "turns", "x_vdr", "t1", "INTEGER")]
    load_fleet(spark, read, catalog(spark, more), raw, calc, tiebreak=["seq"])
    load_fleet(spark, read, catalog(spark, more), raw, calc, tiebreak=["seq"])
    stored = spark.read.option("mergeSchema", True).parquet(raw)
    assert {"turns", PARTITION_COL} <= set(stored.columns)
    assert stored.where("hnum = 'A'").count() == once > 0
    assert stored.where("hnum = 'B' and turns is not null").count() > 0
    assert spark.read.parquet(calc).count() == stored.count()

"""Loads without a stored key are appended; files of a partition do not overlap in time."""

import datetime
import os

import pyarrow.parquet as pq
import pytest
from conftest import files
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from keelson.operators import upsert as up
from keelson.operators.upsert import upsert_table
from keelson.sources import storage
from keelson.sources.storage import read_stored, table_location

MONTH = StructType([StructField("m", IntegerType(), True)])
KEYS = ["hnum", "ds_timestamp"]
NAMES = "hnum string, ds_timestamp timestamp_ntz, a double, m int"


def at(day, month=1, hour=0):
    return datetime.datetime(2024, month, day, hour)


@pytest.fixture(params=["path", "table"])
def target(request, spark, scratch):
    if request.param == "path":
        yield {"path": os.path.join(scratch, "t")}
        return
    spark.sql("DROP TABLE IF EXISTS appended")
    yield {"table": "appended"}
    spark.sql("DROP TABLE IF EXISTS appended")


def load(spark, target, values, names=NAMES, keys=KEYS, parts=("m",), **more):
    return upsert_table(spark, spark.createDataFrame(values, names), keys, partition_cols=list(parts), **target, **more)


def folder_of(spark, target):
    return target.get("path") or table_location(spark, target["table"]).removeprefix("file:")


def held(spark, target):
    df = spark.table(target["table"]) if "table" in target else read_stored(spark, target["path"], MONTH)
    return sorted((r.m, r.ds_timestamp, r.a) for r in df.collect())


def test_a_load_apart_rewrites_no_file(spark, target):
    load(spark, target, [("H1", at(3), 1.0, 1), ("H1", at(5), 2.0, 1), ("H1", at(20), 3.0, 1)])
    folder = folder_of(spark, target)
    before = files(folder)
    load(spark, target, [("H1", at(7), 4.0, 1), ("H2", at(9), 5.0, 1), ("H1", at(1, 2), 6.0, 2)])
    after = files(folder)
    assert before.items() < after.items() and len(after) == len(before) + 2
    want = [(1, at(3), 1.0), (1, at(5), 2.0), (1, at(7), 4.0), (1, at(9), 5.0), (1, at(20), 3.0), (2, at(1, 2), 6.0)]
    assert held(spark, target) == want
    load(spark, target, [("H1", at(7), 4.0, 1), ("H2", at(9), 5.0, 1), ("H1", at(1, 2), 6.0, 2)])  # again: nothing changes
    assert held(spark, target) == want


def test_a_month_apart_is_appended_beside_one_that_is_not(spark, target):
    load(spark, target, [("H1", at(3), 1.0, 1), ("H1", at(3, 2), 2.0, 2)])
    folder = folder_of(spark, target)
    kept = files(os.path.join(folder, "m=2"))
    load(spark, target, [("H1", at(3), 7.0, 1), ("H1", at(5, 2), 8.0, 2)])
    assert kept.items() < files(os.path.join(folder, "m=2")).items() and len(files(os.path.join(folder, "m=1"))) == 1
    assert held(spark, target) == [(1, at(3), 7.0), (2, at(3, 2), 2.0), (2, at(5, 2), 8.0)]


def test_a_key_stored_in_another_touched_partition_moves(spark, target):
    load(spark, target, [("H1", at(3), 1.0, 1), ("H1", at(9), 2.0, 2)])
    load(spark, target, [("H1", at(3), 5.0, 2), ("H1", at(1), 6.0, 1)])
    assert held(spark, target) == [(1, at(1), 6.0), (2, at(3), 5.0), (2, at(9), 2.0)]


def test_hulls_are_told_apart_by_their_partitions(spark, scratch):
    path = os.path.join(scratch, "t")
    parts = {"names": NAMES, "parts": ("hnum", "m")}
    load(spark, {"path": path}, [("H1", at(3), 1.0, 1), ("H2", at(3), 2.0, 1)], **parts)
    kept = files(os.path.join(path, "hnum=H1"))
    load(spark, {"path": path}, [("H1", at(5), 3.0, 1), ("H2", at(3), 4.0, 1), ("H2", at(6), 5.0, 1)], **parts)
    assert kept.items() < files(os.path.join(path, "hnum=H1")).items()
    assert sorted(r.a for r in spark.read.parquet(path).collect()) == [1.0, 3.0, 4.0, 5.0]


def test_an_old_column_list_is_appended_too(spark, target):
    load(spark, target, [("H1", at(3), 1.0, 2.0, 1)], "hnum string, ds_timestamp timestamp_ntz, a double, b double, m int")
    load(spark, target, [("H1", at(5), 3.0, 1)])
    df = spark.table(target["table"]) if "table" in target else read_stored(spark, target["path"], MONTH)
    assert sorted((r.a, r.b or 0.0) for r in df.collect()) == [(1.0, 2.0), (3.0, 0.0)]


def test_tables_without_partitions_and_without_a_time_key(spark, scratch):
    path = os.path.join(scratch, "t")
    for day in (3, 5):
        load(spark, {"path": path}, [("H1", at(day), 1.0, 1)], parts=())
    assert len(files(path)) == 2 and spark.read.parquet(path).count() == 2
    load(spark, {"path": path}, [("H1", at(5), 9.0, 1)], parts=())
    assert sorted(r.a for r in spark.read.parquet(path).collect()) == [1.0, 9.0]
    other = os.path.join(scratch, "u")
    for hull in ("H1", "H2"):
        load(spark, {"path": other}, [(hull, at(3), 1.0, 1)], keys=["hnum"])
    assert len(files(other)) == 1 and spark.read.parquet(other).count() == 2


def test_many_small_files_are_rewritten(spark, scratch, monkeypatch):
    monkeypatch.setattr(up, "MOST_SMALL", 3)
    path = os.path.join(scratch, "t")
    counts = []
    for day in range(1, 7):
        load(spark, {"path": path}, [("H1", at(day), float(day), 1)])
        counts.append(len(files(path)))
    assert counts == [1, 2, 3, 1, 2, 3]
    assert sorted(r.a for r in spark.read.parquet(path).collect()) == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]


def test_an_append_that_ended_midway_is_finished(spark, target, monkeypatch):
    load(spark, target, [("H1", at(3), 1.0, 1)])
    real = up.move_files

    def torn(spark, staged, folder):  # one month's file is moved, the other's is not
        first = sorted(name for name, _ in storage.files_below(spark, staged))[0]
        to = first.replace(staged if first.startswith(staged) else "file:" + staged, folder)
        fs, p = storage._resolve(spark, to)
        fs.mkdirs(p.getParent())
        fs.rename(storage._resolve(spark, first)[1], p)
        raise RuntimeError("lost")

    monkeypatch.setattr(up, "move_files", torn)
    with pytest.raises(RuntimeError, match="lost"):
        load(spark, target, [("H1", at(5), 2.0, 1), ("H1", at(5, 2), 3.0, 2)])
    monkeypatch.setattr(up, "move_files", real)
    load(spark, target, [("H1", at(9, 3), 4.0, 3)])
    assert held(spark, target) == [(1, at(3), 1.0), (1, at(5), 2.0), (2, at(5, 2), 3.0), (3, at(9, 3), 4.0)]
    folder = folder_of(spark, target)
    assert not os.path.exists(storage._note(folder)) and not files(os.path.join(folder, up.ADDED))


def test_a_table_swapped_by_location_is_never_appended_to_below_its_folder(spark):
    spark.sql("DROP TABLE IF EXISTS moved_parts")
    target = {"table": "moved_parts"}
    load(spark, target, [("H1", at(3), 1.0, 1)], by_location=True)
    load(spark, target, [("H1", at(3), 2.0, 1)], by_location=True)
    load(spark, target, [("H1", at(9), 3.0, 1)])
    assert held(spark, target) == [(1, at(3), 2.0), (1, at(9), 3.0)]
    spark.sql("DROP TABLE moved_parts")


def spans(folder):
    """(first, last) ds_timestamp of every file."""
    out = []
    for name in files(folder):
        times = pq.read_table(name, columns=["ds_timestamp"]).column(0).to_pylist()
        assert times == sorted(times)
        out.append((times[0], times[-1]))
    return sorted(out)


@pytest.mark.parametrize("how", ["path", "location"])
def test_files_of_a_month_do_not_overlap(spark, scratch, how):
    spark.sql("DROP TABLE IF EXISTS ranged")
    target = {"path": os.path.join(scratch, "t")} if how == "path" else {"table": "ranged", "by_location": True}
    month = spark.range(120_000).select(
        F.lit("H1").alias("hnum"),
        F.timestamp_millis(F.pmod(F.xxhash64("id"), F.lit(31 * 86_400_000)) + 1704067200000).cast("timestamp_ntz").alias("ds_timestamp"),
        F.rand(1).alias("a"), F.lit(1).alias("m")).dropDuplicates(KEYS)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        upsert_table(spark, month, KEYS, partition_cols=["m"], **target)
        first = folder_of(spark, target)
        created = spans(os.path.join(first, "m=1"))
        part = month.where("day(ds_timestamp) between 3 and 20").withColumn("a", F.lit(2.0))
        upsert_table(spark, part, KEYS, partition_cols=["m"], **target)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    if how == "path":
        merged, df = spans(os.path.join(first, "m=1")), read_stored(spark, target["path"], MONTH)
    else:
        merged, df = spans(next(iter(up._locations(spark, "ranged", ["m"]).values())).removeprefix("file:")), spark.table("ranged")
    for found in (created, merged):
        assert len(found) > 3
        assert all(a[1] < b[0] for a, b in zip(found, found[1:]))
        assert sum(a < at(12) and b >= at(11) for a, b in found) <= 2
    assert df.count() == month.count() and df.where("a = 2.0").count() == part.count()
    spark.sql("DROP TABLE IF EXISTS ranged")

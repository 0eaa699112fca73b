"""Stored tables: declared schemas that evolve, several writers, readers during a swap."""

import datetime
import json
import os
import time

import pytest
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from keelson.operators import upsert as up
from keelson.operators.catalog_sync import sync_catalog_path
from keelson.operators.upsert import upsert_table
from keelson.sources import storage
from keelson.sources.storage import TableBusy, add_stored_columns, declared_schema, read_stored, table_location

MONTH = StructType([StructField("m", IntegerType(), True)])


def at(day, month=1):
    return datetime.datetime(2024, month, day)


def rows(spark, values, names="ds_timestamp timestamp_ntz, a double, b double, m int"):
    return spark.createDataFrame(values, names)


OLD = "ds_timestamp timestamp_ntz, a double, m int"


@pytest.fixture(params=["path", "table", "location"])
def target(request, spark, scratch):
    if request.param == "path":
        yield {"path": os.path.join(scratch, "t")}
        return
    name = f"stored_{request.param}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    yield {"table": name} | ({"by_location": True} if request.param == "location" else {})
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def load(spark, target, df, **options):
    return upsert_table(spark, df, partition_cols=["m"], **target, **options)


def held(spark, target):
    df = spark.table(target["table"]) if "table" in target else read_stored(spark, target["path"], MONTH)
    return df


def test_an_old_catalog_reloaded_keeps_the_newer_column(spark, target):
    load(spark, target, rows(spark, [(at(1), 1.0, 1)], OLD))
    with pytest.raises(ValueError, match="lacks columns"):
        load(spark, target, rows(spark, [(at(1, 2), 2.0, 20.0, 2)]))
    load(spark, target, rows(spark, [(at(1, 2), 2.0, 20.0, 2), (at(2, 2), 3.0, 30.0, 2)]), evolve=True)
    assert set(held(spark, target).columns) == {"ds_timestamp", "a", "b", "m"}
    load(spark, target, rows(spark, [(at(1, 2), 5.0, 2), (at(3, 2), 6.0, 2), (at(2), 7.0, 1)], OLD))
    got = sorted((r.ds_timestamp, r.a, r.b) for r in held(spark, target).collect())
    assert got == [(at(1), 1.0, None), (at(2), 7.0, None), (at(1, 2), 5.0, 20.0), (at(2, 2), 3.0, 30.0), (at(3, 2), 6.0, None)]


def test_a_table_without_a_declared_schema_has_the_columns_of_all_its_files(spark, scratch):
    path = os.path.join(scratch, "t")
    rows(spark, [(at(1), 1.0, 1)], OLD).write.partitionBy("m").parquet(path)
    rows(spark, [(at(1, 2), 2.0, 20.0, 2)]).write.mode("append").partitionBy("m").parquet(path)
    upsert_table(spark, rows(spark, [(at(1, 2), 9.0, 2)], OLD), path=path, partition_cols=["m"])
    assert sorted((r.a, r.b) for r in read_stored(spark, path, MONTH).collect()) == [(1.0, None), (9.0, 20.0)]
    assert set(declared_schema(spark, path)[1].names) == {"ds_timestamp", "a", "b", "m"}


def test_added_columns_and_other_types(spark, scratch):
    path = os.path.join(scratch, "t")
    upsert_table(spark, rows(spark, [(at(1), 1.0, 1)], OLD), path=path, partition_cols=["m"])
    add_stored_columns(spark, path, StructType([StructField("c", DoubleType())]), MONTH)
    assert read_stored(spark, path, MONTH).columns == ["ds_timestamp", "a", "c", "m"]
    with pytest.raises(ValueError, match="already"):
        add_stored_columns(spark, path, StructType([StructField("c", DoubleType())]), MONTH)
    with pytest.raises(ValueError, match="another type"):
        upsert_table(spark, rows(spark, [(at(1), "x", 1)], OLD.replace("double", "string")), path=path, partition_cols=["m"])
    assert [r.a for r in read_stored(spark, path, MONTH).collect()] == [1.0]


def interleaved(monkeypatch, between):
    """Run ``between`` once, after the first load has merged and before it takes the table."""
    real, done = up._claimed.__enter__, []

    def enter(self):
        if not done:
            done.append(1)
            between()
        return real(self)

    monkeypatch.setattr(up._claimed, "__enter__", enter)


def test_two_loads_of_one_partition_keep_the_rows_of_both(spark, target, monkeypatch):
    load(spark, target, rows(spark, [(at(1), 1.0, 1), (at(1, 2), 1.0, 2)], OLD))
    interleaved(monkeypatch, lambda: load(spark, target, rows(spark, [(at(3), 3.0, 1), (at(2), 0.0, 1)], OLD)))
    load(spark, target, rows(spark, [(at(2), 2.0, 1)], OLD))
    assert sorted((r.ds_timestamp, r.a) for r in held(spark, target).collect()) == [
        (at(1), 1.0), (at(2), 2.0), (at(3), 3.0), (at(1, 2), 1.0)]


def test_two_first_loads_keep_the_rows_of_both(spark, scratch, monkeypatch):
    path = os.path.join(scratch, "t")
    interleaved(monkeypatch, lambda: upsert_table(spark, rows(spark, [(at(3), 3.0, 1)], OLD), path=path, partition_cols=["m"]))
    upsert_table(spark, rows(spark, [(at(2), 2.0, 1)], OLD), path=path, partition_cols=["m"])
    assert sorted(r.a for r in read_stored(spark, path, MONTH).collect()) == [2.0, 3.0]


def test_two_syncs_of_one_hull_number_their_keys_apart(spark, scratch, monkeypatch):
    path = os.path.join(scratch, "catalog")
    one = lambda hull, *names: spark.createDataFrame([(hull, n, "x") for n in names], "hnum string, col_name string, v string")
    sync_catalog_path(spark, one("H1", "a"), path)
    interleaved(monkeypatch, lambda: sync_catalog_path(spark, one("H2", "a", "b"), path))
    sync_catalog_path(spark, one("H1", "a", "c"), path)
    got = read_stored(spark, path, StructType([StructField("hnum", StringType())])).collect()
    assert sorted((r.hnum, r.col_name) for r in got) == [("H1", "a"), ("H1", "c"), ("H2", "a"), ("H2", "b")]
    assert len({r.id for r in got}) == 4


def test_a_running_swap_is_waited_for_and_left_alone(spark, scratch):
    path = os.path.join(scratch, "t")
    upsert_table(spark, rows(spark, [(at(1), 1.0, 1)], OLD), path=path, partition_cols=["m"])
    other = storage.Claim(spark, path, os.path.join(scratch, "not there"))
    assert other.take() and not storage.Claim(spark, path, None).take()
    with pytest.raises(TableBusy):
        upsert_table(spark, rows(spark, [(at(2), 2.0, 1)], OLD), path=path, partition_cols=["m"], wait=0.5)
    other.give_up()
    upsert_table(spark, rows(spark, [(at(2), 2.0, 1)], OLD), path=path, partition_cols=["m"])
    assert read_stored(spark, path, MONTH).count() == 2


def test_a_dead_writers_swap_is_finished(spark, scratch, monkeypatch):
    """A killed driver leaves its note as it was; once it is no longer renewed, the next load repeats the swap."""
    path, staged = os.path.join(scratch, "t"), os.path.join(scratch, "copy")
    upsert_table(spark, rows(spark, [(at(1), 1.0, 1)], OLD), path=path, partition_cols=["m"])
    rows(spark, [(at(1), 1.0, 1), (at(5), 5.0, 1)], OLD).write.partitionBy("m").parquet(staged)
    note = storage._note(path)
    with open(note, "w") as f:
        json.dump({"owner": "gone", "staged": staged, "state": "running"}, f)
    os.utime(note, (time.time() - 2 * storage.LEASE,) * 2)
    upsert_table(spark, rows(spark, [(at(2), 2.0, 1)], OLD), path=path, partition_cols=["m"])
    assert sorted(r.a for r in read_stored(spark, path, MONTH).collect()) == [1.0, 2.0, 5.0]
    assert not os.path.exists(note) and not os.path.exists(note + "_next") and not os.path.exists(staged)


def test_nothing_is_left_behind(spark, scratch, target, monkeypatch):
    from keelson.session import checkpoint_dir

    before = set(os.listdir(checkpoint_dir(spark)))
    load(spark, target, rows(spark, [(at(1), 1.0, 1)], OLD))
    load(spark, target, rows(spark, [(at(2), 1.0, 1)], OLD))
    with monkeypatch.context() as m:
        m.setattr(up, "merge_frames", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load(spark, target, rows(spark, [(at(1), 1.0, 1)], OLD))
    assert set(os.listdir(checkpoint_dir(spark))) == before
    folder = target.get("path") or table_location(spark, target["table"]).removeprefix("file:")
    assert not os.path.exists(storage._note(folder))


def test_readers_see_old_or_new_rows_at_every_step_of_a_swap_by_location(spark, monkeypatch):
    spark.sql("DROP TABLE IF EXISTS read_while")
    target = {"table": "read_while", "by_location": True}
    load(spark, target, rows(spark, [(at(1), 1.0, 1), (at(1, 2), 1.0, 2)], OLD))
    seen, real = [], type(spark).sql

    def look():
        seen.append(sorted((r.m, r.a) for r in spark.newSession().table("read_while").collect()))

    def sql(self, text, *a, **k):
        if text.startswith("ALTER TABLE"):
            look()
        out = real(self, text, *a, **k)
        if text.startswith("ALTER TABLE"):
            look()
        return out

    began = spark.table("read_while")  # a reader that has listed the old files already
    began.count()
    with monkeypatch.context() as m:
        m.setattr(type(spark), "sql", sql)
        load(spark, target, rows(spark, [(at(1), 2.0, 1), (at(1, 2), 2.0, 2), (at(1, 3), 2.0, 3)], OLD))
    assert len(seen) == 6
    for rows_seen in seen:
        months = dict(rows_seen)
        assert len(months) == len(rows_seen) and {1, 2} <= set(months) and set(months.values()) <= {1.0, 2.0}
    assert sorted((r.m, r.a) for r in spark.table("read_while").collect()) == [(1, 2.0), (2, 2.0), (3, 2.0)]
    folder = table_location(spark, "read_while")
    old = os.path.join(folder.removeprefix("file:"), "m=1")
    assert up.delete_retired(spark, folder, after=3600) == 0 and os.path.exists(old)
    assert up.delete_retired(spark, folder, after=0) == 2 and not os.path.exists(old)
    assert spark.table("read_while").count() == 3
    spark.sql("DROP TABLE read_while")


def test_swap_by_location_keeps_text_partitions(spark):
    spark.sql("DROP TABLE IF EXISTS text_parts")
    make = lambda v: spark.createDataFrame(
        [("0012", at(1), v), ("a b'=/c", at(1), v), (None, at(1), v)], "hnum string, ds_timestamp timestamp_ntz, a double")
    for v in (1.0, 2.0, 3.0):
        upsert_table(spark, make(v), ["hnum", "ds_timestamp"], table="text_parts", partition_cols=["hnum"], by_location=True)
    got = {(r.hnum, r.a) for r in spark.table("text_parts").collect()}
    assert got == {("0012", 3.0), ("a b'=/c", 3.0)}
    spark.sql("DROP TABLE text_parts")

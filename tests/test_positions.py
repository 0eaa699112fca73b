"""Tables read by position, by layouts noted when their partitions were added."""

import os
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql.types import DoubleType, StructField, StructType

from keelson.plans import tables as T
from keelson.sources.scans import read_by_position, read_table_by_position



def doubles(*names):
    return StructType([StructField(n, DoubleType()) for n in names])


TWO, THREE = doubles("a", "b"), doubles("c", "a", "b")


@pytest.fixture()
def table(spark):
    name = f"default.positions_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def write(base, dt, layout):
    folder = os.path.join(base, f"dt={dt}")
    os.makedirs(folder)
    pq.write_table(pa.table({c: [float(dt) + i] for i, c in enumerate(layout.names)}), os.path.join(folder, "f.parquet"))
    return folder


def jobs(spark, run):
    sc, group = spark.sparkContext, uuid.uuid4().hex
    sc.setJobGroup(group, "")
    out = run()
    sc.setLocalProperty("spark.jobGroup.id", None)
    return out, len(sc.statusTracker().getJobIdsForGroup(group))


def test_a_thousand_folders_one_scan_per_layout_and_no_footer_job(spark, scratch, table):
    base = os.path.join(scratch, "days")
    folders = {n: write(base, n, THREE if n % 3 == 0 else TWO) for n in range(1000)}
    rest = []
    T.create_external_table(spark, "default", table.split(".")[1], TWO, base)
    for layout, mine in ((TWO, [n for n in folders if n % 3]), (THREE, [n for n in folders if n % 3 == 0])):
        T.add_partitions(spark, table, [({"dt": n}, folders[n]) for n in mine if n < 200], layout)
        rest.append(([({"dt": n}, folders[n]) for n in mine if n >= 200], layout))
    few = jobs(spark, lambda: read_table_by_position(spark, table))[1]
    for partitions, layout in rest:
        T.add_partitions(spark, table, partitions, layout)
    df, n_jobs = jobs(spark, lambda: read_table_by_position(spark, table))
    assert n_jobs == few < 10  # of the catalog, and one that lists the folders of each scan
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2
    got = {(r.dt, r.a, r.b) for r in df.collect()}
    assert got == {(n, float(n), n + 1.0) for n in folders}
    one = df.where("dt = 6")
    assert one.collect()[0].a == 6.0 and len(one.inputFiles()) >= 1
    assert "PartitionFilters: [isnotnull(dt" in one._jdf.queryExecution().executedPlan().toString()


def test_partitions_without_a_layout_are_asked_for_theirs(spark, scratch, table):
    base = os.path.join(scratch, "t")
    T.create_external_table(spark, "default", table.split(".")[1], TWO, base)
    assert read_table_by_position(spark, table).count() == 0
    T.add_partition(spark, table, {"dt": 1}, write(base, 1, THREE))
    T.add_partitions(spark, table, [({"dt": 2}, write(base, 2, TWO))], TWO)
    T.add_partitions(spark, table, [])
    assert sorted((r.dt, r.a, r.b) for r in read_table_by_position(spark, table).collect()) == [(1, 1.0, 2.0), (2, 2.0, 3.0)]
    T.add_columns(spark, table, doubles("d"))
    assert sorted((r.dt, r.d) for r in read_table_by_position(spark, table).collect() if r.d) == [(1, 3.0)]


def test_text_partitions_and_columns_with_dots(spark, scratch, table):
    base, layout = os.path.join(scratch, "t"), doubles("x.y", "q a")
    T.create_external_table(spark, "default", table.split(".")[1], TWO, base, "dt STRING")
    T.add_partitions(spark, table, [({"dt": "007"}, write(base, "007", layout))], layout)
    assert [(r.dt, r.a, r.b) for r in read_table_by_position(spark, table).collect()] == [("007", 7.0, 8.0)]


def test_what_cannot_be_told_is_refused(spark, scratch, table):
    base = os.path.join(scratch, "t")
    T.create_external_table(spark, "default", table.split(".")[1], TWO, base)
    with pytest.raises(ValueError, match="not columns of files"):
        T.add_partitions(spark, table, [({"dt": 1}, base)], doubles("a", "dt"))
    T.add_partitions(spark, table, [({"dt": 1}, write(base, 1, TWO))], TWO)
    T.add_partitions(spark, table, [({"dt": 1}, os.path.join(base, "dt=1"))], TWO)  # the same again
    T.add_partitions(spark, table, [({"dt": 1}, os.path.join(base, "dt=1"))], THREE)
    with pytest.raises(ValueError, match="two layouts"):
        read_table_by_position(spark, table)


def test_folders_with_given_layouts(spark, scratch):
    base = os.path.join(scratch, "t")
    folders = [write(base, 1, TWO), write(base, 2, THREE)]
    df, n_jobs = jobs(spark, lambda: read_by_position(spark, folders, TWO, base, dict(zip(folders, (TWO, THREE)))))
    assert n_jobs == 0 and sorted((r.dt, r.a, r.b) for r in df.collect()) == [(1, 1.0, 2.0), (2, 2.0, 3.0)]

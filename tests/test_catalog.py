import os

import pytest
from pyspark.sql import functions as F

from conftest import damage, files
from keelson.operators.catalog_sync import absent_keys, sync_catalog
from keelson.operators.contract import single_value, type_violations
from keelson.sources import testbed as tb
from keelson.sources.tagcatalog import (
    CATALOG_COLUMNS, Tag, catalog_rows, ordered_sources, read_catalog, source_priority, validate, wide_schema,
    wide_schema_frame,
)

HEADER = ",".join(CATALOG_COLUMNS)


def _csv(path, lines, bom=True):
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8") as f:
        f.write("\n".join([HEADER, *lines]) + "\n")
    return path


def test_read_catalog_with_bom_and_blank_unit(spark, scratch):
    p = _csv(os.path.join(scratch, "c.csv"), [
        "H9,vdr_aivdo_lat,db,h9_vdr_aivdo1_pivot,latitude,latitude,deg,FLOAT",
        "H9,me1_fg_use,db,h9_ias_pivot,gm016,ME1 gas ,,BOOLEAN",
    ])
    rows = catalog_rows(read_catalog(spark, p))
    assert rows[0].hnum == "H9" and rows[1].unit is None and rows[1].description == "ME1 gas "
    assert validate(rows) == "H9"


def test_malformed_catalog_fails(spark, scratch):
    p = _csv(os.path.join(scratch, "bad.csv"), ["H9,a,db,t,tag,d,u,FLOAT,extra"])
    with pytest.raises(Exception):
        read_catalog(spark, p).collect()


def _tag(name, table="h_ias_pivot", dtype="FLOAT", hull="H1", db="db"):
    return Tag(hull, name, db, table, name, None, None, dtype)


@pytest.mark.parametrize("tags, msg", [
    ([], "empty"),
    ([_tag("a"), _tag("b", hull="H2")], "one hull"),
    ([_tag("a"), _tag("b", db="other")], "one database"),
    ([_tag("a", dtype="VARCHAR")], "unsupported"),
    ([_tag("a"), _tag("a", table="x")], "duplicate"),
    ([_tag("a"), _tag("b", hull=None)], "lack"),
])
def test_validate_rejects(tags, msg):
    with pytest.raises(ValueError, match=msg):
        validate(tags)


def test_priority_and_wide_schema_order():
    tags = [_tag("z1", "h_vdr_yxmwv_pivot"), _tag("b2", "h_ias_no2_pivot", "BOOLEAN"), _tag("a1", "h_cams_pivot"),
            _tag("m1", "h_ias_no1_pivot", "DOUBLE"), _tag("q", "h_ams_pivot", "INTEGER")]
    assert [t for t, _ in ordered_sources(tags)] == [
        "h_cams_pivot", "h_ias_no1_pivot", "h_ias_no2_pivot", "h_ams_pivot", "h_vdr_yxmwv_pivot"]
    schema = wide_schema(tags)
    assert schema.names == ["ds_timestamp", "a1", "b2", "m1", "q", "z1", "id_h_cams_pivot", "id_h_ias_no1_pivot",
                            "id_h_ias_no2_pivot", "id_h_ams_pivot", "id_h_vdr_yxmwv_pivot"]
    h2521 = wide_schema([_tag("me1_fo_flow", hull="H2521")])
    assert h2521.names == ["ds_timestamp", "ge2_power", "me1_fo_flow", "me_fg_flow", "me_fo_flow", "id_h_ias_pivot"]


def test_wide_schema_frame_matches_plan_time_schema(spark):
    rows = [(t.hnum, t.col_name, t.db_name, t.table_name, t.tag, t.description, t.unit, t.data_type) for t in tb.TESTBED_TAGS]
    cat = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in CATALOG_COLUMNS))
    got = [r.column_name for r in wide_schema_frame(cat).orderBy("position").collect()]
    assert got == wide_schema(tb.TESTBED_TAGS).names


def _cat(spark, rows):
    return spark.createDataFrame(rows, "id long, hnum string, col_name string, description string")


def test_catalog_sync_cases(spark):
    existing = _cat(spark, [(1, "H1", "a", "old"), (2, "H1", "b", "keep"), (3, "H1", "gone", "x"), (4, "H2", "a", "other")])
    incoming = spark.createDataFrame([("H1", "a", "new"), ("H1", "b", "keep"), ("H1", "c", "added")],
                                     "hnum string, col_name string, description string")
    assert [r.id for r in absent_keys(existing, incoming).collect()] == [3]
    synced = {(r.hnum, r.col_name): (r.id, r.description) for r in sync_catalog(existing, incoming).collect()}
    assert synced == {("H1", "a"): (1, "new"), ("H1", "b"): (2, "keep"), ("H1", "c"): (None, "added"),
                      ("H2", "a"): (4, "other")}
    again = sync_catalog(sync_catalog(existing, incoming).withColumn("id", F.coalesce("id", F.lit(5))), incoming)
    assert {(r.hnum, r.col_name) for r in again.collect()} == set(synced)


def test_checks(spark):
    df = spark.createDataFrame([("f1", " h1", "FLOAT"), ("f1", "H1", "VARCHAR"), ("f2", "H2", "BOOLEAN"), ("f2", "H3", None)],
                               "file string, hnum string, data_type string")
    got = {r.file: (r.n_hnum, r.hnum) for r in single_value(df, ["file"], "hnum", normalise=True).collect()}
    assert got == {"f1": (1, "H1"), "f2": (2, None)}
    assert sorted(r.data_type or "-" for r in type_violations(df).collect()) == ["-", "VARCHAR"]


def test_source_priority_frame(spark):
    df = spark.createDataFrame([("H1", "x_vdr_a"), ("H1", "x_ias_b"), ("H1", "x_cams_c"), ("H1", "x_vdr_a")],
                               "hnum string, table_name string")
    got = [r.table_name for r in source_priority(df).orderBy("priority").collect()]
    assert got == ["x_cams_c", "x_ias_b", "x_vdr_a"]


def test_sync_catalog_path_rewrites_only_incoming_hulls(spark, scratch):
    from keelson.operators.catalog_sync import sync_catalog_path
    path = os.path.join(scratch, "catalog")
    existing = _cat(spark, [(1, "H1", "a", "old"), (3, "H1", "gone", "x"), (4, "H2", "a", "other")])
    existing.write.partitionBy("hnum").parquet(path)
    incoming = spark.createDataFrame([(" h1", "a", "new"), ("H1", "c", "added")],
                                     "hnum string, col_name string, description string")
    sync_catalog_path(spark, incoming, path)
    sync_catalog_path(spark, incoming, path)  # re-run: same result
    got = {(r.hnum, r.col_name): (r.id, r.description) for r in spark.read.parquet(path).collect()}
    assert got == {("H1", "a"): (1, "new"), ("H1", "c"): (5, "added"), ("H2", "a"): (4, "other")}


def test_sync_reads_each_side_once_per_join(spark):
    """One full outer join on the whole key; no join is forced to broadcast."""
    existing = _cat(spark, [(i, "H1" if i % 3 else "H2", f"c{i}", "d") for i in range(300)])
    incoming = spark.createDataFrame([("H1", "c1", "x")], "hnum string, col_name string, description string")
    out = sync_catalog(existing, incoming)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") == 1 and plan.count("Join LeftOuter") == 1 and "strategy=broadcast" not in plan
    assert out.count() == 100 + 1


def test_sync_refuses_what_it_would_lose(spark, scratch):
    from keelson.operators.catalog_sync import sync_catalog_path
    path = os.path.join(scratch, "cat")
    columns = "hnum string, col_name string, description string"
    first = spark.createDataFrame([("0012", "b", "x"), ("0012", "a", "y"), ("H2", "a", "z")], columns)
    sync_catalog_path(spark, first, path)
    before = sorted(map(tuple, spark.read.schema("id long, hnum string, col_name string").parquet(path).select("id", "hnum", "col_name").collect()))
    assert before == [(1, "0012", "a"), (2, "0012", "b"), (3, "H2", "a")]  # texts stay texts
    twice = spark.createDataFrame([("0012", "a", "1"), ("0012 ", "a", "2")], columns)
    with pytest.raises(ValueError, match="missing or repeated"):
        sync_catalog_path(spark, twice, path)
    with pytest.raises(ValueError, match="no columns"):
        sync_catalog_path(spark, first.withColumn("extra", F.lit(1)), path)
    with pytest.raises(ValueError, match="no columns"):
        sync_catalog(first.withColumn("id", F.lit(1)), first.withColumn("extra", F.lit(1)))
    after = sorted(map(tuple, spark.read.schema("id long, hnum string, col_name string").parquet(path).select("id", "hnum", "col_name").collect()))
    assert after == before
    sync_catalog_path(spark, spark.createDataFrame([("0012", "c", "n"), ("0012", "b", "m")], columns), path)
    sync_catalog_path(spark, spark.createDataFrame([("0012", "c", "n"), ("0012", "b", "m")], columns), path)  # again: no change
    after = sorted(map(tuple, spark.read.schema("id long, hnum string, col_name string").parquet(path).select("id", "hnum", "col_name").collect()))
    assert after == [(2, "0012", "b"), (3, "H2", "a"), (4, "0012", "c")]


def test_unreadable_catalog_is_not_replaced(spark, scratch):
    from keelson.operators.catalog_sync import sync_catalog_path
    path = os.path.join(scratch, "cat")
    columns = "hnum string, col_name string, description string"
    sync_catalog_path(spark, spark.createDataFrame([("H1", "a", "x")], columns), path)
    damage(path)
    kept = files(path)
    with pytest.raises(Exception):
        sync_catalog_path(spark, spark.createDataFrame([("H3", "a", "x")], columns), path)
    assert files(path) == kept


def test_schema_contract(spark):
    from pyspark.sql.types import FloatType, LongType, StructField, StructType
    from keelson.operators.contract import assert_schema, enforce_schema, schema_violations
    df = spark.createDataFrame([(1, 2.0, "x")], "id_a bigint, v double, extra string")
    declared = StructType([StructField("id_a", LongType()), StructField("v", FloatType()), StructField("w", FloatType())])
    assert schema_violations(df.schema, declared) == [("v", "float", "double"), ("w", "float", None)]
    with pytest.raises(ValueError, match="schema contract"):
        assert_schema(df, declared)
    with pytest.raises(ValueError, match="lacks declared columns"):
        enforce_schema(df, declared)
    fixed = enforce_schema(df.withColumn("w", F.lit(None)), declared)
    assert fixed.schema == declared and schema_violations(fixed.schema, declared) == []


def test_row_with_missing_column_is_rejected(spark, scratch):
    p = _csv(os.path.join(scratch, "short.csv"), ["H9,a,db,t,tag,d,u,FLOAT", "H9,b,db,t,tag2,d,u"])
    with pytest.raises(Exception):
        validate(catalog_rows(read_catalog(spark, p)))


def test_catalog_column_named_like_a_derived_one_is_refused():
    with pytest.raises(ValueError, match="collide"):
        wide_schema([_tag("me_fo_flow", hull="H2521"), _tag("me1_fo_flow", hull="H2521")])


def test_schema_report(spark):
    from pyspark.sql.types import FloatType, LongType, StructField, StructType
    from keelson.operators.contract import schema_report
    df = spark.createDataFrame([(1, 2.0), (2, None)], "id_a bigint, v double")
    declared = StructType([StructField("id_a", LongType()), StructField("v", FloatType()), StructField("w", FloatType())])
    got = {r.column_name: (r.declared_type, r.actual_type, r.non_null_rows) for r in schema_report(df, declared).collect()}
    assert got == {"id_a": ("bigint", "bigint", 2), "v": ("float", "double", 1), "w": ("float", None, 0)}

"""Keeping the stored tag catalog in step with incoming catalog files.

For every hull present in ``incoming``: its stored rows whose key is absent
from ``incoming`` are deleted, every incoming row is inserted or replaces the
stored row with the same key (all non-key columns updated, surrogate id kept).
Hulls absent from ``incoming`` are untouched. The whole change is computed as
one DataFrame, so writing it once is the atomic step.

Both sides are joined once on the composite key (hull, column name), which is
checked to be unique, so no single hull -- however large -- lands in one join
group; which hulls the files cover comes from a join with their distinct ids,
whose strategy is left to the planner.

Hull ids are compared trimmed and upper-cased on both sides.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

DEFAULT_KEYS = ("hnum", "col_name")
DEFAULT_SCOPE = ("hnum",)


def normalise_hull(df: DataFrame, col: str = "hnum") -> DataFrame:
    """Hull ids compare upper-cased and trimmed on both sides."""
    return df.withColumn(col, F.upper(F.trim(F.col(col))))


def _same(left: Sequence[str], right_prefix: str) -> Column:
    cond = F.lit(True)
    for c in left:
        cond = cond & (F.col(c) == F.col(right_prefix + c))
    return cond


def absent_keys(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str] = DEFAULT_KEYS,
    scope: Sequence[str] = DEFAULT_SCOPE,
) -> DataFrame:
    """Stored rows of the hulls ``incoming`` covers whose key ``incoming`` no longer has."""
    keys, scope = list(keys), list(scope)
    in_scope = existing.join(incoming.select(*scope).distinct(), scope, "left_semi")
    return in_scope.join(incoming.select(*keys), keys, "left_anti")


def require_unique(rows: DataFrame, keys: Sequence[str], what: str) -> None:
    """Every key must be whole and occur once, as ON CONFLICT would have it."""
    twice = rows.groupBy(*keys).count()
    bad = twice.where((F.col("count") > 1) | F.greatest(*[F.col(k).isNull().cast("int") for k in keys], F.lit(0)).cast("boolean"))
    found = bad.orderBy(*keys).limit(5).collect()  # an error text shows five
    if found:
        raise ValueError(f"{what}: keys missing or repeated: {[tuple(r[k] for k in keys) for r in found]}")


def require_known_columns(existing: Sequence[str], incoming: Sequence[str]) -> None:
    unknown = [c for c in incoming if c not in existing]
    if unknown:
        raise ValueError(f"the stored catalog has no columns {unknown}; add them first")


def numbered(new: DataFrame, keys: Sequence[str], scope: Sequence[str], id_col: str, top: Column) -> DataFrame:
    """``new`` with ids that go on from ``top`` in key order.

    Each hull is numbered by itself and shifted by the sizes of the hulls before it: the window over all
    hulls sees one row per hull.
    """
    before = Window.orderBy(*scope).rowsBetween(Window.unboundedPreceding, -1)
    shifts = new.groupBy(*scope).agg(F.count(F.lit(1)).alias("__n")).select(
        *[F.col(c).alias(f"__s_{c}") for c in scope], F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift"))
    place = F.row_number().over(Window.partitionBy(*scope).orderBy(*keys))
    ranked = new.withColumn("__place", place).join(shifts, _same(scope, "__s_"))
    return ranked.withColumn(id_col, (top + F.col("__shift") + F.col("__place")).cast("long")).drop(
        "__shift", "__place", *[f"__s_{c}" for c in scope])


def sync_catalog(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str] = DEFAULT_KEYS,
    scope: Sequence[str] = DEFAULT_SCOPE,
    id_col: str | None = "id",
    top_id: int | None = None,
) -> DataFrame:
    """Catalog after delete-absent + upsert.

    Stored keys keep their ``id_col``. New keys get ids above ``top_id`` in key order, or NULL
    without it (a sink that assigns ids itself).
    """
    keys, scope = list(keys), list(scope)
    require_known_columns(existing.columns, incoming.columns)
    columns = existing.columns
    if len(scope) == 1:
        existing, incoming = normalise_hull(existing, scope[0]), normalise_hull(incoming, scope[0])
    has_id = id_col is not None and id_col in columns
    values = [c for c in columns if not (has_id and c == id_col)]
    missing = [c for c in values if c not in incoming.columns]
    if missing:
        raise ValueError(f"the incoming catalog lacks columns {missing}")
    new = incoming.select(*[F.col(c).alias(f"__i_{c}") for c in values], F.lit(True).alias("__hit"))
    covered = incoming.select(*[F.col(c).alias(f"__c_{c}") for c in scope]).distinct().withColumn("__covered", F.lit(True))
    both = existing.withColumn("__had", F.lit(True)).join(new, _same(keys, "__i_"), "full_outer")
    both = both.join(covered, _same(scope, "__c_"), "left")
    hit = F.col("__hit").isNotNull()
    kept = both.where(hit | F.col("__covered").isNull()).select(
        *[F.when(hit, F.col(f"__i_{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in columns],
        F.col("__had"))
    if not has_id or top_id is None:
        return kept.drop("__had")
    fresh = numbered(kept.where("__had is null").drop("__had"), keys, scope, id_col, F.lit(top_id))
    return kept.where("__had is not null").drop("__had").unionByName(fresh.select(*columns))


def sync_catalog_path(
    spark,
    incoming: DataFrame,
    path: str,
    keys: Sequence[str] = DEFAULT_KEYS,
    scope: Sequence[str] = DEFAULT_SCOPE,
    id_col: str | None = "id",
    wait: float = 600.0,
) -> None:
    """Apply ``sync_catalog`` to a catalog stored as Parquet partitioned by hull.

    Only the hull partitions present in ``incoming`` are read and rewritten (a swap that the next sync
    finishes if it is interrupted), other hulls are never touched. Keys must be unique: a file that
    repeats one is refused before anything is written, as is a column the stored catalog lacks. New keys
    get the next ids; stored keys keep theirs. Only a folder that is not there is a new catalog. A sync that
    finds the catalog changed by another one when it wants to swap computes its change anew.
    """
    from keelson.operators.upsert import ATTEMPTS, _claimed, _partition_path, finish_swap, swap_in
    from keelson.session import checkpoint_dir
    from keelson.sources.storage import (
        TableBusy, data_files, declare_schema, declared_schema, delete_path, holds_data, path_exists, read_note, read_stored,
    )

    keys, scope = list(keys), list(scope)
    if len(scope) == 1:
        incoming = normalise_hull(incoming, scope[0])
    incoming = incoming.drop(id_col) if id_col else incoming
    types = StructType([StructField(c, StringType(), True) for c in scope])
    run = f"{checkpoint_dir(spark)}/keelson-catalog-{uuid.uuid4().hex}"
    by_hull = [F.col(c) for c in scope]

    def create(rows: DataFrame) -> bool:
        out = rows if id_col is None else numbered(rows, keys, scope, id_col, F.lit(0))
        with _claimed(spark, path, None, wait):
            if holds_data(spark, path):
                return False
            declare_schema(spark, path, out.schema)
            mode = "append" if path_exists(spark, path) else "errorifexists"
            out.hint("rebalance", *by_hull).write.mode(mode).partitionBy(*scope).parquet(path)
        return True

    def change(rows: DataFrame, existing: DataFrame, hulls: list, merged: str) -> bool:
        require_known_columns(existing.columns, rows.columns)
        # Ids go on from the largest of all hulls, so any other sync in between counts as a change.
        has_id = id_col is not None and id_col in existing.columns
        files = lambda: sorted(existing_folders(hulls)) + ([top()] if has_id else [])
        top = lambda: int(read_stored(spark, path, types).agg(F.max(id_col)).first()[0] or 0)
        existing_folders = lambda hs: [
            (str(f), data_files(spark, f)) for f in (f"{path}/{_partition_path(spark, scope, h)}" for h in hs)
        ]
        base = files()
        touched = existing.join(rows.select(*scope).distinct(), scope, "left_semi")
        after = sync_catalog(touched, rows, keys, scope, id_col if has_id else None, base[-1] if has_id else None)
        after.hint("rebalance", *by_hull).write.partitionBy(*scope).parquet(merged)
        declare_schema(spark, merged, after.schema)
        if declared_schema(spark, path)[1] is None:
            declare_schema(spark, path, existing.schema)
        return swap_in(spark, merged, path, None, scope, wait=wait, unchanged=lambda: files() == base)

    try:
        incoming.write.parquet(f"{run}/incoming")
        rows = spark.read.schema(incoming.schema).parquet(f"{run}/incoming")
        require_unique(rows, keys, "incoming catalog")
        hulls = rows.select(*scope).distinct().collect()  # one row per hull of the files
        for attempt in range(ATTEMPTS):
            finish_swap(spark, path, None, scope)
            existing = read_stored(spark, path, types)
            if existing is None and create(rows):
                return
            if existing is not None and change(rows, existing, hulls, f"{run}/merged-{attempt}"):
                return
        raise TableBusy(f"{path} changed during each of {ATTEMPTS} syncs")
    finally:
        # An interrupted swap still needs its staged copy: the note beside the catalog's folder names it.
        note = read_note(spark, path)
        if not (note and (note["staged"] or "").startswith(run)):
            delete_path(spark, run)

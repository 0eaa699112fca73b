"""Key-based upsert (MERGE: matched -> update every column, unmatched -> insert).

``merge_frames`` is the pure DataFrame form: target rows whose key appears in
the source are replaced by the source row (NULLs overwrite), the rest stay.
Because every non-key column is updated, one full outer join on the key that
takes the source row wherever there is one is exactly MERGE.

``upsert_table`` applies it to a stored table. When the table format supports
MERGE (``DataFrame.mergeInto``) that is used; for plain Parquet the source is
staged once under ``spark.checkpoint.dir``, only the partitions it touches are
read from the table and merged, the merged rows are staged too, and exactly
those partitions are swapped in.

Appends: where the keys hold ``sort_col``, a touched partition without any stored
row between the load's first and last row of it can share no key with the load.
Its new rows are written as files of their own and moved in; no stored file is
read but for its statistics, or rewritten. A partition with MOST_SMALL small files
is rewritten instead.

Files: a partition that needs several files gets them by ranges of ``sort_col``,
so they do not overlap and a filter on a day opens the one or two that hold it.

Columns: a stored table has a declared schema (``sources.storage``). What the
source lacks stays as stored (NULL in inserted rows), as in a MERGE whose update
list does not name it; what the table lacks is refused, or added with ``evolve``.

Several writers: nobody waits while merging. To swap, a writer creates a note
beside the table's folder, which only one can; it then compares the files of the
partitions it touches with those it merged from. If another load replaced them
meanwhile, it gives the note up and merges again, so no load's rows are lost.

A swap replaces partitions one after another, so a crash can leave the table
between two states. The note names the staged copy and goes when the swap is
done. The next load of the table that finds the note of a swap that failed, or of
a writer that no longer renews it, repeats that swap first. Catalog tables can
be swapped by location (``by_location``): the merged partition is written to a
folder of its own and the catalog then points to it, so a reader at any moment
sees the partition's old or its new rows, never none; the old files are deleted
by a later load.
"""

from __future__ import annotations

import logging
import time
import uuid
from collections import defaultdict
from typing import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from keelson.session import checkpoint_dir
from keelson.sources.storage import (
    Claim, TableBusy, data_files, declare_schema, delete_path, drop_note, files_below, holds_data, move_files,
    partition_locations as _locations, path_exists, read_note, read_stored, spec_key as _spec_key, table_location, take_over,
)

log = logging.getLogger(__name__)

#: How often a load merges again when others change the same partitions meanwhile.
ATTEMPTS = 5
#: Seconds to wait for another writer's swap.
WAIT = 600.0
#: Below a catalog table's folder, hidden: the folders of partitions swapped in by location.
LOADS = "_loads"
#: Below a target's folder, hidden: files about to be appended.
ADDED = "_added"
#: A partition with so many files below a quarter of the advisory size is rewritten, not appended to.
MOST_SMALL = 32
#: Old partition folders are deleted by the first load that starts this many seconds after their swap.
RETIRE_AFTER = 3600.0


def _not_null(keys: Sequence[str]):
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def merge_frames(
    target: DataFrame, source: DataFrame, keys: Iterable[str] = ("ds_timestamp",), partial: bool = False
) -> DataFrame:
    """Result of MERGE source INTO target ON keys (update all / insert all).

    One full outer join on the keys: a matched target row takes the source row
    (NULLs overwrite), an unmatched source row is inserted, other target rows
    stay. Each side is read once, and a side that is already hash-partitioned
    on the keys (e.g. straight out of the first-row step) is not shuffled again.
    Source rows with a NULL key are dropped: they could never match and would
    pile up as duplicates on every re-run. Target columns the source lacks are an
    error, or with ``partial`` stay as they are (NULL in inserted rows).
    """
    keys = list(keys)
    missing = [c for c in target.columns if c not in source.columns]
    if [c for c in missing if not partial or c in keys]:
        raise ValueError(f"source lacks target columns {missing}")
    src = source.where(_not_null(keys)).select(
        *[F.col(c).alias(_SRC + c) for c in target.columns if c not in missing], F.lit(True).alias(_HIT))
    cond = None
    for k in keys:
        eq = F.col(k) == F.col(_SRC + k)
        cond = eq if cond is None else cond & eq
    joined = target.join(src, cond, "full_outer")
    hit = F.col(_HIT).isNotNull()
    return joined.select(*[
        F.col(c) if c in missing else F.when(hit, F.col(_SRC + c)).otherwise(F.col(c)).alias(c) for c in target.columns
    ])


_SRC = "__src_"
_HIT = "__src_hit"


def _supports_merge(spark: SparkSession, table: str) -> bool:
    if not spark.catalog.tableExists(table):
        return False
    provider = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == "Provider").collect()
    return bool(provider) and provider[0]["data_type"].lower() in {"iceberg", "delta"}


def _range(order: Column) -> list[Column]:
    lo, hi = F.min(order), F.max(order)
    return [lo.alias("__lo"), hi.alias("__hi"), lo.cast("string").alias("__lo_text"), hi.cast("string").alias("__hi_text")]


def checked_source(
    source: DataFrame, keys: Sequence[str], partition_cols: Sequence[str] = (), order: str | None = None
) -> tuple[int, list]:
    """(source rows with a NULL key, partition values of the others) in one job; a repeated key is an error.

    With ``order``, one of the keys, each partition comes with its range of it (__lo, __hi; also as texts).
    """
    whole = _not_null(keys)
    per_key = source.groupBy(*dict.fromkeys([*partition_cols, *keys])).agg(F.count(F.lit(1)).alias("__n"))
    repeated = F.when(whole & (F.col("__n") > 1), F.struct(*[F.col(k).cast("string").alias(k) for k in keys]))
    parts = per_key.groupBy(*partition_cols).agg(
        F.sum(F.when(~whole, F.col("__n")).otherwise(0)).alias("__null"),
        F.max(F.when(whole, 1).otherwise(0)).alias("__any"),
        F.max(repeated).alias("__twice"),
        *(_range(F.when(whole, F.col(order))) if order else []),
    ).collect()  # one row per partition the load touches
    for p in parts:
        if p["__twice"] is not None:
            raise ValueError(f"source key {list(p['__twice'])} occurs more than once")
    return sum(p["__null"] or 0 for p in parts), [p for p in parts if p["__any"]]


def upsert_table(
    spark: SparkSession,
    source: DataFrame,
    keys: Sequence[str] = ("ds_timestamp",),
    *,
    table: str | None = None,
    path: str | None = None,
    partition_cols: Sequence[str] = (),
    sort_col: str | None = "ds_timestamp",
    evolve: bool = False,
    by_location: bool = False,
    wait: float = WAIT,
) -> int:
    """Upsert ``source`` into a catalog ``table`` or a Parquet folder ``path``.

    Returns the number of source rows with a NULL key, which are not loaded (they
    could never match, so every re-run would add them again). A key that occurs
    twice in the source is an error, raised before the target is touched -- as a
    SQL MERGE would refuse it.

    A target is new only if its folder (or table) is not there; any error of
    reading it is raised, and nothing that exists is overwritten as a whole.
    Partitions are rebalanced by size before a write: a large one becomes several
    files of the advisory partition size, each sorted by ``sort_col``.

    ``evolve`` adds source columns the target lacks to it (otherwise they are
    refused). ``by_location`` swaps the partitions of a catalog table by their
    location. ``TableBusy`` is raised when another writer's swap does not end
    within ``wait`` seconds, or others change the same partitions ATTEMPTS times
    while this load merges.
    """
    keys, partition_cols = list(keys), list(partition_cols)
    if (table is None) == (path is None):
        raise ValueError("give exactly one of table / path")
    if by_location and (table is None or not partition_cols):
        raise ValueError("by_location needs a partitioned catalog table")
    if table is not None and _supports_merge(spark, table):
        return _merge_into(spark, source, keys, table, partition_cols)
    target = _Target(spark, table, path, partition_cols, sort_col, by_location)
    run = f"{checkpoint_dir(spark)}/keelson-upsert-{uuid.uuid4().hex}"
    try:
        target.recover()
        existing = target.read(source.schema)
        if existing is not None:
            _check_types(source, existing, partition_cols)
            if not evolve:
                _check_no_new_columns(source, existing.columns)
        # 1. The source is computed exactly once: staged in the shared folder (this also
        #    cuts its lineage, so a lost executor never re-runs the whole load).
        source.write.parquet(f"{run}/source")
        staged_all = spark.read.schema(source.schema).parquet(f"{run}/source")
        target.size = sum(n for _, n in files_below(spark, f"{run}/source"))
        null_keys, touched = checked_source(staged_all, keys, partition_cols, sort_col if sort_col in keys else None)
        if null_keys:
            log.warning("%d source rows have a NULL key and are not loaded", null_keys)
        rows = staged_all.where(_not_null(keys))
        for attempt in range(ATTEMPTS):
            if target.load(rows, keys, touched, f"{run}/merged-{attempt}", wait):
                return null_keys
            log.warning("%s changed while this load merged; merging again", table or path)
        raise TableBusy(f"{table or path} changed during each of {ATTEMPTS} merges")
    finally:
        note = read_note(spark, target.folder()) if target.folder() else None
        if not (note and (note["staged"] or "").startswith(run)):  # else the next load needs the copy
            delete_path(spark, run)


class _Target:
    """A stored Parquet table: a folder, or a table of the session catalog."""

    def __init__(self, spark, table, path, partition_cols, sort_col, by_location):
        self.spark, self.table, self.path = spark, table, path
        self.parts, self.sort_col, self.by_location = list(partition_cols), sort_col, by_location
        self.size = 0  # bytes of the load, once it is staged
        folder = self.folder() if table is not None and partition_cols else None
        if folder is not None and path_exists(spark, f"{folder}/{LOADS}"):
            self.by_location = True  # its partitions are where the catalog says, not below the folder

    def folder(self) -> str | None:
        if self.path is not None:
            return self.path
        return table_location(self.spark, self.table) if self.spark.catalog.tableExists(self.table) else None

    def recover(self) -> None:
        folder = self.folder()
        if folder is not None:
            finish_swap(self.spark, folder, self.table, self.parts, self.sort_col)
            if self.by_location:
                delete_retired(self.spark, folder)

    def read(self, source: StructType) -> DataFrame | None:
        if self.table is not None:
            if not self.spark.catalog.tableExists(self.table):
                return None
            self.spark.catalog.refreshTable(self.table)
            return self.spark.table(self.table)
        return read_stored(self.spark, self.path, StructType([source[c] for c in self.parts]))

    def version(self, touched) -> list:
        """The files of each touched partition: a swap or an append always changes them."""
        if not self.parts:
            return [data_files(self.spark, self.folder())]
        folders = _locations(self.spark, self.table, self.parts) if self.by_location else {}
        at = lambda r: f"{self.folder()}/{_partition_path(self.spark, self.parts, r)}"
        where = [folders.get(_spec_key(self.parts, r), at(r)) for r in touched]
        return [data_files(self.spark, f) for f in where]

    def apart(self, existing: DataFrame, touched, keys: Sequence[str], base: list) -> list:
        """The touched partitions that can share no key with the load: no stored row lies within its range of them.

        One job that reads the order column alone, and by its statistics only where files reach into the load's range;
        it returns a row per touched partition at most.
        """
        order, parts = self.sort_col, self.parts
        if self.by_location or order not in keys:
            return []
        small = _file_bytes(self.spark) / 4
        few = [sum(size < small for _, size in files) < MOST_SMALL for files in base]
        if not any(few):
            return []
        joined = set()
        if any(base):
            kind = existing.schema[order].dataType
            # As texts, which Spark reads as it wrote them, in whatever time zone Python runs.
            lo = min(touched, key=lambda r: r["__lo"])["__lo_text"]
            hi = max(touched, key=lambda r: r["__hi"])["__hi_text"]
            within = F.col(order).between(F.lit(lo).cast(kind), F.lit(hi).cast(kind))
            # Whatever partition a key is stored in, a load that gives it another one moves it: all touched ones are
            # asked, and where two can share a key both are rewritten.
            stored = existing.where(_partition_filter(parts, touched) & within if parts else within)
            held = stored.groupBy(*parts).agg(F.min(order).alias("__lo"), F.max(order).alias("__hi"))
            fixed = [c for c in parts if c in keys]  # rows that differ here have different keys
            values = lambda r, columns: tuple(r[c] for c in columns)
            spans = defaultdict(list)
            for h in held.collect():
                if h["__lo"] is not None:
                    spans[values(h, fixed)].append(h)
            for r in touched:
                for h in spans[values(r, fixed)]:
                    if h["__lo"] <= r["__hi"] and r["__lo"] <= h["__hi"]:
                        joined |= {values(r, parts), values(h, parts)}
        return [r for r, ok in zip(touched, few, strict=True) if ok and tuple(r[c] for c in parts) not in joined]

    def add_columns(self, source: StructType, existing: DataFrame) -> DataFrame:
        new = StructType([f for f in source.fields if f.name not in existing.columns])
        if not new.fields:
            return existing
        if self.table is not None:
            from keelson.plans.tables import add_columns

            add_columns(self.spark, self.table, new)
        else:
            from keelson.sources.storage import add_stored_columns

            add_stored_columns(self.spark, self.path, new, StructType([source[c] for c in self.parts]))
        return self.read(source)

    def load(self, rows: DataFrame, keys: Sequence[str], touched, staged: str, wait: float) -> bool:
        """Merge and swap in. False if the touched partitions changed in between."""
        spark, parts, sort_col = self.spark, self.parts, self.sort_col
        existing = self.read(rows.schema)
        if existing is None:
            return self.create(rows, wait)
        if not touched:
            return True
        existing = self.add_columns(rows.schema, existing)
        base = self.version(touched)
        # 2. Partitions that share no key with the load are appended to. Of the others, only those the source touches
        #    are read and rewritten. Their values are few (one per month of the load window); as a literal filter they
        #    prune the scan.
        folder = self.folder()
        apart = self.apart(existing, touched, keys, base)
        appended = {id(r) for r in apart}
        joined = [r for r in touched if id(r) not in appended]
        added = f"{folder}/{ADDED}/{uuid.uuid4().hex}" if apart else None
        left = False
        try:
            if apart:
                new = rows.where(_partition_filter(parts, apart)) if parts and joined else rows
                _arranged(new, parts, sort_col, self.size).write.partitionBy(*parts).parquet(added)
            # 3. Merge, stage the result, then swap the touched partitions in: the final write never reads the
            #    partitions it replaces.
            if joined:
                given = rows.where(_partition_filter(parts, joined)) if apart else rows
                target = existing.where(_partition_filter(parts, joined)) if parts else existing
                partial = {"partial": True} if set(target.columns) - set(rows.columns) else {}
                merged = merge_frames(target, given, keys, **partial)
                if self.by_location:
                    staged = f"{folder}/{LOADS}/{uuid.uuid4().hex}"
                _arranged(merged, parts, sort_col if self.by_location else None).write.partitionBy(*parts).parquet(staged)
                declare_schema(spark, staged, merged.schema)
                if self.by_location:
                    staged = self.in_ranges(staged)
            with _claimed(spark, folder, staged if joined else None, wait, added) as claim:
                if self.version(touched) != base:
                    if self.by_location:
                        delete_path(spark, staged)
                    return False
                if self.path is not None:
                    declare_schema(spark, folder, existing.schema)
                try:
                    _install(spark, staged if joined else None, added, folder, self.table, parts, sort_col)
                except BaseException:
                    left = True
                    claim.leave()
                    raise
        except TableBusy as busy:
            if self.by_location:
                delete_path(spark, staged)
            if isinstance(busy, Unfinished):
                self.recover()
                return False
            raise
        finally:
            if added and not left:
                delete_path(spark, added)
        return True

    def in_ranges(self, staged: str) -> str:
        """A copy of staged partitions of several files each, cut by ranges; the same folder if there is none."""
        text = StructType([StructField(c, StringType(), True) for c in self.parts])
        n = _ranges(self.spark, staged)
        if not n or self.sort_col is None:
            return staged
        rows = read_stored(self.spark, staged, text)
        again = f"{staged}-ranges"
        _ranged(rows, self.parts, self.sort_col, n).write.partitionBy(*self.parts).parquet(again)
        declare_schema(self.spark, again, rows.schema)
        delete_path(self.spark, staged)
        return again

    def create(self, rows: DataFrame, wait: float) -> bool:
        """The first load. False if another writer created the target meanwhile."""
        arranged = _arranged(rows, self.parts, self.sort_col, self.size)
        if self.table is not None:
            if self.spark.catalog.tableExists(self.table):
                return False
            try:
                _create(arranged, self.table, None, self.parts)
            except AnalysisException:
                if self.spark.catalog.tableExists(self.table):  # another writer was faster
                    return False
                raise
            return True
        with _claimed(self.spark, self.path, None, wait):
            if holds_data(self.spark, self.path):
                return False
            declare_schema(self.spark, self.path, rows.schema)
            _create(arranged, None, self.path, self.parts)
        return True


class Unfinished(TableBusy):
    """A writer died in the middle of its swap."""


class _claimed:
    """Hold the table's note while its partitions are replaced; wait for another writer, finish a dead one's swap."""

    def __init__(self, spark, folder, staged, wait, added=None):
        self.spark, self.folder, self.wait = spark, folder, wait
        self.claim = Claim(spark, folder, staged, added)
        self.left = False

    def __enter__(self):
        until = time.monotonic() + self.wait
        while not self.claim.take():
            note = read_note(self.spark, self.folder)
            if note is not None and note["dead"]:  # its partitions may be half replaced: not to be merged into
                raise Unfinished(f"{self.folder}: an earlier swap did not end; load again to finish it")
            if time.monotonic() > until:
                raise TableBusy(f"{self.folder} is held by {note and note['owner']}")
            time.sleep(0.2)
        return self

    def leave(self):
        self.left = True
        self.claim.leave()

    def __exit__(self, *exc):
        if not self.left:
            self.claim.give_up()


def _merge_into(spark, source, keys, table, partition_cols) -> int:
    # project onto the target's columns: helper columns such as the Parquet month partition are not
    # part of a table that partitions by hidden transforms
    target_cols = spark.table(table).columns
    _check_no_new_columns(source, target_cols, ignore=partition_cols)
    run = f"{checkpoint_dir(spark)}/keelson-upsert-{uuid.uuid4().hex}"
    given = [c for c in target_cols if c in source.columns]
    try:
        source.select(*given).write.parquet(run)
        rows = spark.read.schema(source.select(*given).schema).parquet(run)
        null_keys = checked_source(rows, keys)[0]
        cond = None
        for k in keys:
            eq = F.col(f"{table}.{k}") == F.col(f"s.{k}")
            cond = eq if cond is None else cond & eq
        values = {c: F.col(f"s.{c}") for c in given}
        merge = rows.where(_not_null(keys)).alias("s").mergeInto(table, cond)
        merge.whenMatched().update(values).whenNotMatched().insert(values).merge()
    finally:
        delete_path(spark, run)
    return null_keys


def swap_in(spark: SparkSession, staged: str, folder: str, table: str | None, partition_cols: Sequence[str],
            sort_col: str | None = None, wait: float = WAIT, unchanged=None) -> bool:
    """Replace the partitions the staged copy holds (the whole table without partitions), recoverably.

    ``unchanged`` is asked once the table is held; False gives it up again.
    """
    with _claimed(spark, folder, staged, wait) as claim:
        if unchanged is not None and not unchanged():
            return False
        try:
            _replace(spark, staged, folder, table, partition_cols, sort_col)
        except BaseException:
            claim.leave()
            raise
    return True


def finish_swap(spark: SparkSession, folder: str, table: str | None, partition_cols: Sequence[str],
                sort_col: str | None = None) -> bool:
    """Repeat a swap that did not end. The staged copy is whole, so repeating it is safe at any point.

    The swap of a writer that is still at it is left alone.
    """
    note = read_note(spark, folder)
    if note is None or not note["dead"] or not take_over(spark, folder):
        return False
    added = note.get("added")
    if note["staged"] or added:
        log.warning("finishing an interrupted load of %s from %s", folder, note["staged"] or added)
        _install(spark, note["staged"], added, folder, table, partition_cols, sort_col)
    drop_note(spark, folder)
    if added:
        delete_path(spark, added)
    if note["staged"] and f"/{LOADS}/" not in note["staged"]:
        delete_path(spark, note["staged"])
    return True


def _install(spark, staged, added, folder, table, partition_cols, sort_col) -> None:
    """Replace the partitions of ``staged`` and append the files of ``added``; repeating it is harmless."""
    if staged:
        _replace(spark, staged, folder, table, partition_cols, sort_col)
    if added:
        move_files(spark, added, folder)
        if table is not None:
            if partition_cols:
                spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
            spark.catalog.refreshTable(table)


def _replace(spark, staged, folder, table, partition_cols, sort_col) -> None:
    if not path_exists(spark, staged):
        raise OSError(f"{folder} was left in the middle of a swap and its staged copy {staged} is gone")
    if table is not None and f"/{LOADS}/" in staged:
        switch_locations(spark, staged, folder, table, partition_cols)
        return
    # Text values keep their leading zeros: folder names are not to be read as numbers.
    types = StructType([StructField(c, StringType(), True) for c in partition_cols])
    if table is not None:
        # The files are written to the table's folder: the mode of replacing is then this write's own, not the session's.
        target = spark.table(table)
        rows = spark.read.schema(target.schema).parquet(staged).select(*target.columns)
    else:
        rows = read_stored(spark, staged, types)
        if rows is None:  # nothing to swap in
            return
    writer = _ranged(rows, partition_cols, sort_col, _ranges(spark, staged)).write.mode("overwrite")
    if partition_cols:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols)
    else:
        declared = rows.schema
    writer.parquet(folder)
    if table is None and not partition_cols:
        declare_schema(spark, folder, declared)  # replacing the whole folder took its note along
    if table is not None:
        if partition_cols:
            spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
        spark.catalog.refreshTable(table)


def _partition_path(spark, partition_cols: Sequence[str], row) -> str:
    """A partition's folder as Spark's writers name it."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    text = lambda v: "__HIVE_DEFAULT_PARTITION__" if v is None or v == "" else escape(str(v))
    return "/".join(f"{escape(c)}={text(row[c])}" for c in partition_cols)


def switch_locations(spark, staged: str, folder: str, table: str, partition_cols: Sequence[str]) -> None:
    """Point the catalog's partitions at the folders of ``staged``, one atomic change each; repeating it is harmless."""
    before = _locations(spark, table, partition_cols)
    text = StructType([StructField(c, StringType(), True) for c in partition_cols])
    rows = read_stored(spark, staged, text)
    old = []
    for r in rows.select(*partition_cols).distinct().collect() if rows is not None else []:  # a row per touched partition
        quoted = lambda v: "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        spec = ", ".join(f"`{c}` = {'NULL' if r[c] is None else quoted(r[c])}" for c in partition_cols)
        now = f"{staged}/{_partition_path(spark, partition_cols, r)}"
        known = before.get(_spec_key(partition_cols, r))
        if known is None:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{now}'")
        else:
            spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{now}'")
            if known.rstrip("/") != now:
                old.append(known)
    retire(spark, folder, old)
    spark.catalog.refreshTable(table)


def retire(spark, folder: str, locations: Sequence[str]) -> None:
    """Note folders no longer in the catalog; readers that started earlier may still be at them."""
    from keelson.sources.storage import _write_new

    if locations:
        _write_new(spark, f"{folder}/{LOADS}/_retired_{uuid.uuid4().hex}", "\n".join(locations))


def delete_retired(spark, folder: str, after: float | None = None) -> int:
    """Delete retired partition folders whose swap is ``after`` seconds old (RETIRE_AFTER). Returns how many."""
    from keelson.sources.storage import _age, _read_small, _resolve

    fs, p = _resolve(spark, f"{folder}/{LOADS}")
    if not fs.exists(p):
        return 0
    n = 0
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        note = f"{folder}/{LOADS}/{name}"
        if name.startswith("_retired_") and _age(spark, note) >= (RETIRE_AFTER if after is None else after):
            for location in (_read_small(spark, note) or "").split("\n"):
                n += delete_path(spark, location)
            delete_path(spark, note)
    return n


def _check_types(source: DataFrame, existing: DataFrame, partition_cols: Sequence[str]) -> None:
    stored = {f.name: f.dataType for f in existing.schema.fields}
    bad = [
        (f.name, f.dataType.simpleString(), stored[f.name].simpleString()) for f in source.schema.fields
        if f.name in stored and f.name not in partition_cols and f.dataType != stored[f.name]
    ]
    if bad:
        raise ValueError(f"columns of another type than stored (name, given, stored): {bad}")


def _check_no_new_columns(source: DataFrame, target_cols: Sequence[str], ignore: Sequence[str] = ()) -> None:
    """A source column the target lacks would be dropped silently: refuse instead (the catalog gained a tag)."""
    new = [c for c in source.columns if c not in set(target_cols) | set(ignore)]
    if new:
        raise ValueError(f"target lacks columns {new}; add them first (keelson.plans.tables.add_columns)")


def _partition_filter(partition_cols: Sequence[str], touched) -> Column:
    """Predicate selecting exactly the ``touched`` partition values.

    One flat ``struct(cols) IN (...)`` list (a hash lookup once it is long), not a
    chain of ORs whose depth would grow with the number of touched partitions;
    only value tuples holding a NULL get a null-safe term of their own.
    """
    cols = list(partition_cols)
    plain = [r for r in touched if all(r[c] is not None for c in cols)]
    with_null = [r for r in touched if any(r[c] is None for c in cols)]
    key = F.struct(*[F.col(c) for c in cols])
    cond = key.isin([F.struct(*[F.lit(r[c]).alias(c) for c in cols]) for r in plain]) if plain else F.lit(False)
    for r in with_null:
        one = F.lit(True)
        for c in cols:
            one = one & F.col(c).eqNullSafe(F.lit(r[c]))
        cond = cond | one
    return cond


def _file_bytes(spark: SparkSession) -> int:
    """The size a file should have: AQE's advisory size."""
    text = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


def _ranges(spark: SparkSession, folder: str) -> int:
    """Into how many ranges staged rows are cut: as many as their files' sizes ask for, 0 if no partition has two files."""
    files = files_below(spark, folder)
    folders = [name.rpartition("/")[0] for name, _ in files]
    if len(set(folders)) == len(folders):
        return 0
    return max(1, -(-sum(n for _, n in files) // _file_bytes(spark)))


def _ranged(df: DataFrame, partition_cols: Sequence[str], sort_col: str | None, n: int) -> DataFrame:
    """Rows dealt to n tasks by ranges of (partition, sort_col), so that no two files of a partition overlap."""
    if n and sort_col and sort_col in df.columns:
        df = df.repartitionByRange(n, *partition_cols, sort_col)
    return _sorted(df, partition_cols, sort_col)


def _arranged(df: DataFrame, partition_cols: Sequence[str], sort_col: str | None, size: int = 0) -> DataFrame:
    """Rows of a partition together, in parts of the advisory size; each part sorted.

    Rows known to have more than the advisory size (``size``, in bytes as stored) are dealt by ranges.
    """
    n = -(-size // _file_bytes(df.sparkSession))
    if n > 1 and sort_col and sort_col in df.columns:
        return _ranged(df, partition_cols, sort_col, n)
    if partition_cols:
        df = df.hint("rebalance", *[F.col(c) for c in partition_cols])
    return _sorted(df, partition_cols, sort_col)


def _sorted(df: DataFrame, partition_cols: Sequence[str], sort_col: str | None) -> DataFrame:
    if sort_col and sort_col in df.columns:
        return df.sortWithinPartitions(*partition_cols, sort_col)
    return df


def _create(df: DataFrame, table: str | None, path: str | None, partition_cols: Sequence[str]) -> None:
    """The first load. An existing target is an error, but for a folder that holds hidden files alone."""
    if path is not None:
        mode = "append" if path_exists(df.sparkSession, path) else "errorifexists"
        df.write.mode(mode).partitionBy(*partition_cols).parquet(path)
        return
    df.write.mode("errorifexists").partitionBy(*partition_cols).format("parquet").saveAsTable(table)

"""The aligned minute view: first reading per minute of every source, minutes all sources share."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from keelson.functions.timebucket import parse_every
from keelson.operators.align import align_first_inner
from keelson.plans.tables import create_or_replace_view
from keelson.session import prepare
from keelson.sources.scans import TableReader, project_source
from keelson.sources.tagcatalog import Tag, ordered_sources


def minute_view(
    read: TableReader,
    tags: Sequence[Tag],
    every: int | str = "1 minute",
    keys: Iterable[str] = (),
    tiebreak: Sequence[str] = (),
    date_col: str = "ds_date",
) -> DataFrame:
    """(ds_timestamp ms, every catalogued tag, ds_date) for each bucket present in all sources."""
    keys, tiebreak = list(keys), list(tiebreak)
    frames = [
        project_source(read(table), table_tags, id_col="id", keep=[*keys, date_col, *tiebreak])
        for table, table_tags in ordered_sources(tags)
        if table_tags
    ]
    if not frames:
        raise ValueError("the catalog lists no source with tags")
    prepare(frames[0].sparkSession)  # bucket texts are UTC wall-clock times
    return align_first_inner(frames, every, time_col="id", date_col=date_col, keys=keys, tiebreak=tiebreak)


def view_sql(
    tags: Sequence[Tag],
    every: int | str = "1 minute",
    db: str | None = None,
    tiebreak: Sequence[str] = (),
    date_col: str = "ds_date",
    time_col: str = "ds_timestamp",
) -> str:
    """The aligned view as SELECT text over catalog tables, for a view that outlives the session.

    Generated from the tag catalog, tables in priority order. Raw columns pass unchanged under their
    catalog names; the time column becomes the bucket in epoch ms. A predicate on the date column
    reaches every source, since it is part of each join and window key.
    """
    ms = parse_every(every)
    quoted = lambda name: "`" + name.replace("`", "``") + "`"
    parts, names = [], []
    for i, (table, table_tags) in enumerate(ordered_sources(tags)):
        columns = ", ".join(f"{quoted(t.tag)} AS {quoted(t.col_name)}" for t in table_tags)
        kept = ", ".join(quoted(t.col_name) for t in table_tags)
        order = ", ".join(["__ms", *map(quoted, tiebreak)])
        extra = "".join(f", {quoted(c)}" for c in tiebreak)
        where = ".".join(quoted(p) for p in ([db] if db else []) + [table])
        parts.append(
            f"(SELECT {quoted(date_col)}, __at, {kept} FROM (SELECT *, row_number() OVER (PARTITION BY {quoted(date_col)}, __at "
            f"ORDER BY {order}) AS __n FROM (SELECT *, __ms - pmod(__ms, {ms}) AS __at FROM (SELECT {quoted(date_col)}, "
            f"CAST(try_cast({quoted(time_col)} AS DOUBLE) AS BIGINT) AS __ms{extra}, {columns} FROM {where}))) WHERE __n = 1) AS s{i}"
        )
        names.append(kept)
    if not parts:
        raise ValueError("the catalog lists no source with tags")
    joined = parts[0] + "".join(f" JOIN {p} USING ({quoted(date_col)}, __at)" for p in parts[1:])
    return f"SELECT __at AS {quoted(time_col)}, {', '.join(names)}, {quoted(date_col)} FROM {joined}"


def create_minute_view(spark: SparkSession, name: str, tags: Sequence[Tag], every: int | str = "1 minute", **options) -> None:
    """(Re)create the aligned view persistently in the session catalog."""
    create_or_replace_view(spark, name, view_sql(tags, every, **options))


def create_view(spark: SparkSession, name: str, df: DataFrame) -> None:
    """(Re)create the view for SQL users of this session."""
    df.createOrReplaceTempView(name)

"""First row per time bucket.

Whole-row pick: the earliest raw reading of each (keys, bucket) is kept with
all its values, NULLs included -- values are never merged across rows.

Plan shape: ``row_number() = 1`` becomes a WindowGroupLimit that Spark runs
twice, a partial top-1 inside every map task before the shuffle and the final
top-1 after it, so a bucket holding a huge share of the rows is already cut to
one row per map task before anything is exchanged. The exchange is a hash
partitioning on (keys, bucket column); joins on the same columns reuse it.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.functions.conform import ms_to_timestamp
from keelson.functions.timebucket import floor_ms, parse_every

_RN = "__keelson_rn"


def first_row(
    df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str | Column], drop: Sequence[str] = ()
) -> DataFrame:
    """Keep the first row of every group under ``order_cols`` (ascending, NULLs first); ``drop`` columns are removed."""
    order = [F.col(c).asc() if isinstance(c, str) else c for c in order_cols]
    w = Window.partitionBy(*group_cols).orderBy(*order)
    keep = [c for c in df.columns if c not in set(drop)]
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).select(*keep)


def first_per_bucket(
    df: DataFrame,
    every: int | str = "15 seconds",
    time_col: str = "id",
    bucket_col: str = "ds_timestamp",
    keys: Iterable[str] = (),
    tiebreak: Sequence[str] | None = None,
    drop_tiebreak: bool = False,
) -> DataFrame:
    """Floor epoch-ms ``time_col`` to ``every`` and keep the first row per (keys, bucket).

    ``bucket_col`` becomes a zone-less timestamp. Rows tied on ``time_col`` are
    ordered by ``tiebreak`` (default: every other column, by name) so the pick is
    deterministic; ``drop_tiebreak`` removes those columns from the result. A NULL
    time forms its own NULL bucket. Output columns: keys, bucket, the rest.
    """
    keys = list(keys)
    every_ms = parse_every(every)
    if tiebreak is None:
        tiebreak = sorted(c for c in df.columns if c not in {time_col, bucket_col, *keys})
    rest = [c for c in df.columns if c not in {bucket_col, *keys}]
    bucket = ms_to_timestamp(floor_ms(F.col(time_col), every_ms)).alias(bucket_col)
    out = df.select(*keys, bucket, *rest)
    return first_row(out, [*keys, bucket_col], [time_col, *tiebreak], drop=list(tiebreak) if drop_tiebreak else ())

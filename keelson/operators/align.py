"""Aligning several sources on a shared time key.

``align_left``     fold of LEFT joins in source-priority order: the first frame
                   (the base) decides which buckets exist; others attach or are NULL.
``align_first_inner``  first reading per (date, bucket) of every source, kept only
                   where all sources have one (the minute view).

Every side arrives hash-partitioned on the join key by its own first-row step,
so the joins add no exchange of their own and nothing is broadcast.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.functions.timebucket import bucket_text, floor_ms, parse_every, text_to_ms
from keelson.operators.resample import first_row


def align_left(frames: Sequence[DataFrame | None], on: Iterable[str] = ("ds_timestamp",), how: str = "left") -> DataFrame:
    """Join ``frames`` left to right on ``on``. ``None`` entries (sources without tags) are skipped."""
    on = list(on)
    present = [f for f in frames if f is not None]
    if not present:
        raise ValueError("no source to align")
    for f in present:
        missing = [c for c in on if c not in f.columns]
        if missing:
            raise ValueError(f"source lacks join columns {missing}")
    _check_disjoint([[c for c in f.columns if c not in on] for f in present])
    return reduce(lambda left, right: left.join(right, on, how), present)


def _check_disjoint(column_lists: Sequence[Sequence[str]]) -> None:
    seen: set[str] = set()
    for cols in column_lists:
        overlap = set(cols) & seen
        if overlap:
            raise ValueError(f"columns {sorted(overlap)} come from more than one source")
        seen |= set(cols)


def align_first_inner(
    frames: Sequence[DataFrame],
    every: int | str = "1 minute",
    time_col: str = "id",
    date_col: str = "ds_date",
    keys: Iterable[str] = (),
    tiebreak: Sequence[str] = (),
    out_time_col: str = "ds_timestamp",
) -> DataFrame:
    """First reading per (keys, date, bucket) of each frame, inner-joined across frames.

    Each frame holds ``time_col`` (epoch ms), ``date_col``, optional tie-break
    columns and its own value columns. The result carries ``out_time_col`` --
    the bucket start as epoch ms, read back from its 'yyyy-MM-dd HH:mm' text --
    then every frame's value columns, then ``date_col``.
    """
    keys = list(keys)
    every_ms = parse_every(every)
    if every_ms % 60_000:
        raise ValueError("the minute view needs a bucket width in whole minutes")
    bucket = "__bucket_ms"
    join_cols = [*keys, date_col, bucket]
    per_frame = [[c for c in f.columns if c not in {time_col, date_col, *keys, *tiebreak}] for f in frames]
    _check_disjoint(per_frame)
    firsts, values = [], []
    for f, vals in zip(frames, per_frame):
        values.extend(vals)
        g = f.select(*keys, F.col(date_col), floor_ms(F.col(time_col), every_ms).alias(bucket), time_col, *tiebreak, *vals)
        # without tie-break columns, readings tied on the millisecond are ordered by their values (deterministic)
        order = [time_col, *(tiebreak or sorted(vals))]
        firsts.append(first_row(g, join_cols, order, drop=[time_col, *tiebreak]))
    joined = reduce(lambda left, right: left.join(right, join_cols, "inner"), firsts)
    return joined.select(*keys, text_to_ms(bucket_text(F.col(bucket))).alias(out_time_col), *values, date_col)

"""Fixed-width time buckets on epoch milliseconds."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS_MS = {
    "ms": 1, "millisecond": 1, "milliseconds": 1,
    "s": 1_000, "sec": 1_000, "second": 1_000, "seconds": 1_000,
    "m": 60_000, "min": 60_000, "minute": 60_000, "minutes": 60_000,
    "h": 3_600_000, "hour": 3_600_000, "hours": 3_600_000,
    "d": 86_400_000, "day": 86_400_000, "days": 86_400_000,
}

# Fixed value: text form of a bucket start in the minute view.
BUCKET_TEXT_FORMAT = "yyyy-MM-dd HH:mm"


def parse_every(every: int | str) -> int:
    """'15s', '15 seconds', '1 minute', '1h' or an int (ms) -> bucket width in ms."""
    if isinstance(every, int):
        ms = every
    else:
        m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+)\s*", every)
        if not m or m.group(2).lower() not in _UNITS_MS:
            raise ValueError(f"cannot read bucket width {every!r}")
        ms = int(m.group(1)) * _UNITS_MS[m.group(2).lower()]
    if ms <= 0:
        raise ValueError("bucket width must be positive")
    return ms


def floor_ms(ms: Column | str, every_ms: int) -> Column:
    """Floor epoch ms to the bucket start; floors (not truncates) before 1970."""
    col = F.col(ms) if isinstance(ms, str) else ms
    return col - F.pmod(col, F.lit(every_ms))


def bucket_text(bucket_ms: Column | str) -> Column:
    """Bucket start (epoch ms) -> 'yyyy-MM-dd HH:mm' in UTC."""
    col = F.col(bucket_ms) if isinstance(bucket_ms, str) else bucket_ms
    return F.from_unixtime(F.floor(col / 1000), BUCKET_TEXT_FORMAT)


def text_to_ms(text: Column | str) -> Column:
    """'yyyy-MM-dd HH:mm' -> epoch ms (BIGINT)."""
    col = F.col(text) if isinstance(text, str) else text
    return F.unix_timestamp(col, BUCKET_TEXT_FORMAT) * F.lit(1000)

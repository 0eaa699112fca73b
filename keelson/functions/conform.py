"""Typed projection of raw sensor text: catalog casts, booleans, epochs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DoubleType, FloatType, IntegerType

# Catalog data types the pipeline accepts and the column type each becomes.
CATALOG_TYPES: dict[str, DataType] = {
    "DOUBLE": DoubleType(),
    "INTEGER": IntegerType(),
    "BOOLEAN": BooleanType(),
    "FLOAT": FloatType(),
}

# Raw texts read as true / as false (compared after lower-casing, no trimming).
TRUE_TEXTS = ("true", "1")
FALSE_TEXTS = ("false", "0")


def spark_type(data_type: str) -> DataType:
    try:
        return CATALOG_TYPES[data_type]
    except KeyError:
        raise ValueError(f"unsupported catalog data_type {data_type!r}") from None


def normalise_bool(c: Column | str) -> Column:
    """TRUE for 'true'/'1', FALSE for 'false'/'0' (any case), NULL otherwise.

    Deliberately not ``try_cast(boolean)``: that would also accept 'yes', 't' and ' true'.
    """
    low = F.lower(F.col(c) if isinstance(c, str) else c)
    return F.when(low.isin(*TRUE_TEXTS), F.lit(True)).when(low.isin(*FALSE_TEXTS), F.lit(False))


def typed_tag(c: Column | str, data_type: str) -> Column:
    """Raw tag -> catalog type. Unparsable text becomes NULL instead of failing the job."""
    col = F.col(c) if isinstance(c, str) else c
    if data_type == "BOOLEAN":
        return normalise_bool(col)
    return col.try_cast(spark_type(data_type))


def epoch_ms(c: Column | str) -> Column:
    """Raw time value (epoch milliseconds, possibly written as '1767225659123.0') -> BIGINT.

    Goes through DOUBLE because a direct BIGINT cast rejects the fractional form.
    """
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast("double").try_cast("bigint")


def ms_to_timestamp(c: Column | str) -> Column:
    """Epoch milliseconds -> zone-less timestamp (session time zone is UTC)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.timestamp_millis(col).cast("timestamp_ntz")

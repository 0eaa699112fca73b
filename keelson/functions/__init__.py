"""Column expressions (all built-in Spark functions, no UDFs)."""

from keelson.functions.conform import (  # noqa: F401
    CATALOG_TYPES,
    epoch_ms,
    ms_to_timestamp,
    normalise_bool,
    spark_type,
    typed_tag,
)
from keelson.functions.timebucket import floor_ms, parse_every, bucket_text, text_to_ms  # noqa: F401
from keelson.functions.wind import beaufort, fuel_total, true_wind_angle, true_wind_speed  # noqa: F401

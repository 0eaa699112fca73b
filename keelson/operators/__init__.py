"""DataFrame -> DataFrame operators."""

from keelson.operators.align import align_first_inner, align_left  # noqa: F401
from keelson.operators.catalog_sync import absent_keys, sync_catalog  # noqa: F401
from keelson.operators.contract import enforce_schema, schema_violations, single_value, type_violations  # noqa: F401
from keelson.operators.resample import first_per_bucket, first_row  # noqa: F401
from keelson.operators.upsert import merge_frames, upsert_table  # noqa: F401

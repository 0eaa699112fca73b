"""keelson: catalog-driven vessel telemetry on Spark DataFrames.

Layers
------
sources    table scans, tag-catalog reading, by-name / by-position reads
functions  column expressions (typed casts, booleans, epochs, buckets, wind, derived columns)
operators  DataFrame -> DataFrame steps (first row per bucket, alignment, upsert, catalog sync, checks)
plans      jobs that chain the steps (raw table, calc table, minute view, catalog sync) and DDL helpers
llm        training-data operators (optional; nothing else imports them)
"""

from keelson.session import build_session, checkpoint_dir, prepare  # noqa: F401
from keelson.plans.jobs import build_raw, calc, run_hull, sync_catalog_file  # noqa: F401, E402
from keelson.plans.view import minute_view  # noqa: F401, E402
from keelson.sources.tagcatalog import catalog_rows, read_catalog  # noqa: F401, E402
from keelson.sources.scans import table_reader  # noqa: F401, E402

__all__ = [
    "build_session", "prepare", "checkpoint_dir",
    "read_catalog", "catalog_rows", "table_reader",
    "build_raw", "calc", "minute_view", "run_hull", "sync_catalog_file",
]

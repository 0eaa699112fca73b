"""Jobs and DDL helpers."""

from keelson.plans.jobs import CALC_SCHEMA, build_raw, calc, resampled_sources, run_hull, sync_catalog_file  # noqa: F401
from keelson.plans.view import minute_view  # noqa: F401

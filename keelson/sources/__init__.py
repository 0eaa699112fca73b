"""Sources: tag catalog, catalog-driven scans, column resolution, driver-table adapter."""

from keelson.sources.scans import (  # noqa: F401
    date_range,
    half_open,
    project_source,
    read_by_name,
    read_by_position,
    read_table_by_position,
    scan_source,
    table_reader,
)
from keelson.sources.tagcatalog import (  # noqa: F401
    CATALOG_SCHEMA,
    Tag,
    catalog_rows,
    ordered_sources,
    read_catalog,
    source_priority,
    validate,
    wide_schema,
    wide_schema_frame,
)

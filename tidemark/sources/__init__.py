"""Readers: file scans, partitioned table scans, catalog tables."""

from tidemark.sources.files import (
    bucketing,
    catalog_scan,
    create_table,
    overwrite_mode,
    partition_subset_scan,
    read_table,
    register_table,
    require_format,
    scan,
    stored_schema,
)

__all__ = ["bucketing", "catalog_scan", "create_table", "overwrite_mode", "partition_subset_scan", "read_table",
           "register_table", "require_format", "scan", "stored_schema"]

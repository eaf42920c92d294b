"""Column-level helpers: projections, title-casing, load time, version increment."""

from tidemark.functions.columns import (
    align_to_schema,
    drop_columns,
    load_ts_literal,
    prefixed_projection,
    rename_column,
    rename_positional,
    reorder_columns,
    with_load_ts,
    with_partition_copy,
)
from tidemark.functions.text import title_case
from tidemark.functions.versions import next_version

__all__ = [
    "align_to_schema",
    "drop_columns",
    "load_ts_literal",
    "next_version",
    "prefixed_projection",
    "rename_column",
    "rename_positional",
    "reorder_columns",
    "title_case",
    "with_load_ts",
    "with_partition_copy",
]

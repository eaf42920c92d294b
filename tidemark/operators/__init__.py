"""Row-level operators of the versioned-table jobs (all DataFrame -> DataFrame)."""

from tidemark.operators.join import version_increment, version_join
from tidemark.operators.latest import latest_per_key, rank_versions
from tidemark.operators.merge import (
    blank_partition_to_null,
    collect_touched,
    existing_in_touched,
    merge_union,
    merged_partitions,
    partition_values,
    survivors,
    touched_predicate,
)

__all__ = [
    "blank_partition_to_null",
    "collect_touched",
    "existing_in_touched",
    "latest_per_key",
    "merge_union",
    "merged_partitions",
    "partition_values",
    "rank_versions",
    "survivors",
    "touched_predicate",
    "version_increment",
    "version_join",
]

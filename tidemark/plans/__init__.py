"""Composite jobs (initial load, incremental merge, version increment)."""

from tidemark.plans.jobs import (
    incremental_merge,
    incremental_merge_table,
    initial_load,
    initial_load_table,
    version_job,
)
from tidemark.plans.runs import archive_as_of, finish_swap, initial_load_run, merge_run, read_current

__all__ = ["archive_as_of", "finish_swap", "initial_load_run", "merge_run", "read_current", "incremental_merge", "incremental_merge_table", "initial_load", "initial_load_table", "version_job"]

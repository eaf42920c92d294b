"""tidemark: versioned tables (current + archive) as plain Spark DataFrame jobs.

A *current* table holds the newest row per primary key, partitioned by one
column; an *archive* table holds every version.  The three jobs are

* :func:`tidemark.plans.jobs.initial_load`      history feed -> current + archive
* :func:`tidemark.plans.jobs.incremental_merge` daily delta -> touched partitions of
  current rewritten (delta wins), merged partitions appended to archive
  (``archive_once``: a re-run with the same load time appends them once)
* :func:`tidemark.plans.jobs.version_job`       daily LEFT JOIN archive -> inc_version

``initial_load_table`` / ``incremental_merge_table`` run the first two on catalog
tables whose partitions the catalog tracks (a merge lists only the partitions it
touches); :mod:`tidemark.streaming` triggers the merge per arriving delta file and
:mod:`tidemark.cli` runs the jobs from ``spark-submit``.

Every building block is a ``DataFrame -> DataFrame`` function so Catalyst and
adaptive execution plan the work; the only actions are inside sinks, the
bounded collect of touched partition values, the bounded hot-key lists, the
bounded row counts that prove a broadcast small, the checkpoint of split ranks
and the footer read that finds the stored columns of a path table.
"""

from tidemark.spec import TableSpec

__all__ = ["TableSpec"]

"""G1 initial load, G2+G3 incremental merge with archive snapshot, G4 version job."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.columns import align_to_schema, load_ts_literal, refuse_lossy, rename_column
from tidemark.operators.join import version_increment
from tidemark.operators.latest import latest_per_key
from tidemark.operators.keys import any_null
from tidemark.operators.merge import (
    blank_partition_to_null,
    collect_touched,
    merged_partitions,
    partition_values,
    stored_spellings,
    touched_predicate,
)
from tidemark.sinks.files import empty_partitions, insert_partitions, swap_partitions, write_json, write_partitioned
from tidemark.sources.files import catalog_scan, create_table, described, overwrite_mode, read_table, stored_schema
from tidemark.spec import TableSpec


def _stamp(df: DataFrame, spec: TableSpec, load_ts: datetime | str | Column | None) -> DataFrame:
    """Incoming rows as stored: normalized partition value ('' is null) and the run's load time."""
    value = load_ts if isinstance(load_ts, Column) else load_ts_literal(load_ts)
    key = spec.partition_key
    if spec.partition_normalizer is not None:
        df = df.withColumn(key, spec.partition_normalizer(F.col(key)))
    return blank_partition_to_null(df, key).withColumn(spec.load_ts_col, value)


def initial_load(history: DataFrame, spec: TableSpec, current_path: str, archive_path: str | None = None,
                 load_ts: datetime | str | Column | None = None, fmt: str = "parquet",
                 rebalance: bool = True) -> None:
    """History feed -> *current* (newest row per key) and *archive* (every row).

    Both tables are partitioned by ``spec.partition_key`` and carry the run's
    single load time.  The feed is scanned once per output rather than cached:
    at the target size a cache would not fit and a second scan is cheap.
    ``rebalance=False`` skips the layout shuffle of the archive write, for a
    feed whose files are already grouped by partition value.
    """
    stamped = _stamp(history, spec, load_ts)
    write_partitioned(latest_per_key(stamped, spec), current_path, spec.partition_key, "overwrite", fmt)
    if archive_path is not None:
        write_partitioned(stamped, archive_path, spec.partition_key, "overwrite", fmt, rebalance=rebalance)


def incremental_merge(spark: SparkSession, delta: DataFrame, spec: TableSpec, current_path: str,
                      archive_path: str | None = None, load_ts: datetime | str | Column | None = None,
                      fmt: str = "parquet",
                      cache_merged: bool = True, cache_delta: bool = True,
                      current_schema: StructType | None = None, archive_once: bool = False) -> None:
    """Merge a daily delta into *current* and snapshot the result into *archive*.

    For every partition value the delta touches, the new content is the delta
    rows plus the existing rows whose key the delta lacks; untouched partitions
    are neither read nor rewritten.  Columns *current* stores beyond the
    delta's (e.g. the history feed's version columns) keep their values on
    surviving rows and are null on delta rows.  The stamped delta is used three times
    (touched values, its keys, its rows), so it is persisted (memory, then
    disk) unless ``cache_delta=False``; the three uses then also agree for a
    source that is not repeatable.  The merged rows feed two sinks, so they
    are persisted too (laid out by partition value once for both writes where
    the session allows, see :func:`_merge`): first the archive append, then
    the dynamic-overwrite swap of *current*.  If cached blocks are lost they are
    recomputed from the delta and *current*, which stays intact until the swap
    commits.  ``cache_merged=False`` recomputes the merge for the second write
    instead (for touched partitions too large for executor disks).
    ``current_schema``, the schema *current* is stored with (load-time column
    included), saves the listing that otherwise finds its columns
    (:func:`tidemark.sources.stored_schema`).

    The archive append is not undone if the job fails later, so a plain
    re-run appends the snapshot again.  With ``archive_once`` (which needs an
    explicit ``load_ts``: the load time then names the run) re-running the
    last job with the same load time and delta completes its snapshot: rows that reached
    *archive* stay, missing ones are added (see :func:`_append_once`).

    With ``spec.partition_normalizer`` partitions of *current* that are other
    spellings of a touched value lose the delta's keys too, so a key is in one of them only.
    """
    _check_archive_once(archive_once, load_ts)
    stamped = _stamp(delta, spec, load_ts)
    stored = current_schema or stored_schema(spark, current_path, stamped.schema, fmt, spec.partition_key)
    refuse_lossy(stamped, stored)
    current = read_table(spark, current_path, stored, fmt)

    def archive(rows: DataFrame, rebalance: bool) -> None:
        write_partitioned(rows, archive_path, spec.partition_key, "append", fmt, rebalance=rebalance)

    def write(merged: DataFrame, rebalance: bool, emptied: list) -> None:
        if archive_once and archive_path is not None:
            _append_once(read_table(spark, archive_path, stored, fmt), archive_path, merged, spec, load_ts, rebalance, archive)
        elif archive_path is not None:
            archive(merged, rebalance)
        swap_partitions(merged, current_path, spec.partition_key, fmt, rebalance=rebalance)
        empty_partitions(current, spec.partition_key, emptied, fmt)

    _merge(current, align_to_schema(stamped, stored), spec, cache_delta,
           cache_merged and archive_path is not None, write, load_ts if archive_once else None)


def _merge(current: DataFrame, stamped: DataFrame, spec: TableSpec, cache_delta: bool,
           cache_merged: bool, write, rerun_of: datetime | str | None = None) -> None:
    """Build the merged partitions of ``current`` and hand them to ``write`` with the
    spellings of touched values they leave empty; the stamped delta and the merged
    rows are persisted as asked.

    ``rerun_of`` is the load time of a run that may have swapped *current*
    before: its rows without a key, which no key can match, are then left out.

    Where the session lets adaptive execution reshape cached plans
    (``spark.sql.optimizer.canChangeCachedPlanOutputPartitioning``, among the
    recommended settings), persisted merged rows are laid out for the
    partitioned writes first (``REBALANCE`` by the partition column, hot
    values split): both writes read the same shuffled blocks and neither
    shuffles again.  Otherwise a layout inside the cache could not split a hot
    partition value, so each write lays the rows out itself.
    """
    if cache_delta:
        stamped = stamped.persist(StorageLevel.MEMORY_AND_DISK)
    merged = None
    layout_in_cache = cache_merged and _adaptive_cached_plans(current.sparkSession)
    try:
        spellings = stored_spellings(current, spec, collect_touched(stamped, spec.partition_key))
        existing = current
        if rerun_of is not None:
            before = any_null(spec.primary_key) & F.col(spec.load_ts_col).eqNullSafe(load_ts_literal(rerun_of))
            existing = current.where(~before)
        merged = merged_partitions(existing, stamped, spec, spellings)
        if layout_in_cache:
            merged = merged.hint("rebalance", spec.partition_key)
        if cache_merged:
            merged = merged.persist(StorageLevel.MEMORY_AND_DISK)
        filled = spellings and merged.where(F.col(spec.partition_key).isin(spellings)).select(spec.partition_key).distinct().collect()
        write(merged, not layout_in_cache, sorted(set(spellings) - {r[0] for r in filled}))
    finally:
        if merged is not None:
            merged.unpersist()
        stamped.unpersist()


def _check_archive_once(archive_once: bool, load_ts) -> None:
    if archive_once and (load_ts is None or isinstance(load_ts, Column)):
        raise ValueError("archive_once needs the run's load time as a value (load_ts)")


def _append_once(archive: DataFrame, place: str, merged: DataFrame, spec: TableSpec, load_ts, rebalance: bool, append) -> None:
    """Append ``merged`` to the archive at ``place``, or only what an earlier attempt of this run left out.

    Survivors keep their load times, so rows alone do not tell which snapshot
    they belong to.  The first attempt therefore writes down the archive's files
    in the touched partitions (``_runs`` beside the partitions, which readers
    skip) before it appends anything; rows in other files are this run's, and what
    ``merged`` has beyond them, copies counted, is appended.  Only the last run
    can be repeated, with the same delta; the format must return values as they were written
    (Parquet, ORC).  Columns of type map are not comparable and refused by Spark.
    """
    spark = archive.sparkSession
    notes = f"{place.rstrip('/')}/_runs/{re.sub('[^0-9A-Za-z]', '-', str(load_ts))}"
    values = [r[0] for r in partition_values(merged, spec.partition_key).collect()]
    touched = archive.where(touched_predicate(F.col(spec.partition_key), values))
    has_files = _has_files(archive)
    try:
        earlier = spark.read.parquet(notes)
    except AnalysisException as exc:
        if (exc.getCondition() or "") not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        files = touched.select("_metadata.file_name") if has_files else spark.createDataFrame([], "file_name string")
        files.distinct().repartition(1).write.mode("overwrite").parquet(notes)  # one file: all of the list or nothing
        append(merged, rebalance)
        return
    if not has_files:  # the archive has no file at all
        append(merged, rebalance)
        return
    run = touched.select("*", F.col("_metadata.file_name").alias("_file")).join(earlier.toDF("_file"), "_file", "left_anti")
    missing = merged.exceptAll(run.select(*merged.columns)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if not missing.isEmpty():
            append(missing, True)
    finally:
        missing.unpersist()


def _has_files(df: DataFrame) -> bool:
    """Whether ``df`` reads files (a table not there yet reads as rows in memory)."""
    try:
        df.select("_metadata.file_name").schema
    except AnalysisException:
        return False
    return True


def _adaptive_cached_plans(spark: SparkSession) -> bool:
    conf = spark.conf.get("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "false")
    return str(conf).lower() == "true"


def initial_load_table(spark: SparkSession, history: DataFrame, spec: TableSpec, current_table: str,
                       current_path: str, archive_table: str | None = None, archive_path: str | None = None,
                       load_ts: datetime | str | Column | None = None, fmt: str = "parquet",
                       rebalance: bool = True) -> None:
    """:func:`initial_load` into catalog tables.

    Both folders are overwritten whole, then (re)defined as external tables
    whose partitions the catalog tracks and whose overwriting inserts are
    dynamic, ready for :func:`incremental_merge_table`.
    """
    if (archive_table is None) != (archive_path is None):
        raise ValueError("give both archive_table and archive_path, or neither")
    ts = load_ts if isinstance(load_ts, Column) else load_ts_literal(load_ts)
    initial_load(history, spec, current_path, archive_path, ts, fmt, rebalance)
    stored = _stamp(history, spec, ts).schema
    create_table(spark, current_table, current_path, stored, spec.partition_key, fmt, replace=True)
    if archive_table is not None:
        create_table(spark, archive_table, archive_path, stored, spec.partition_key, fmt, replace=True)


def incremental_merge_table(spark: SparkSession, delta: DataFrame, spec: TableSpec, current_table: str,
                            archive_table: str | None = None, load_ts: datetime | str | Column | None = None,
                            cache_merged: bool = True,
                            cache_delta: bool = True, archive_once: bool = False) -> None:
    """:func:`incremental_merge` on catalog tables (see :func:`initial_load_table`).

    The touched values become a predicate on the partition column, which the
    catalog answers with the matching partitions: only their directories are
    listed and read, however many partitions *current* has.  The merged rows
    are inserted into *archive*, then overwrite their partitions of *current*
    (dynamic overwrite, checked before anything is written); new partition
    values are registered by the inserts.  ``archive_once`` as in
    :func:`incremental_merge`.
    """
    _check_archive_once(archive_once, load_ts)
    current = catalog_scan(spark, current_table)
    stamped = _stamp(delta, spec, load_ts)
    refuse_lossy(stamped, current.schema)
    stamped = align_to_schema(stamped, current.schema)
    if overwrite_mode(spark, current_table) != "dynamic":
        raise ValueError(f"{current_table} does not overwrite partitions dynamically; create it with create_table")

    def archive(rows: DataFrame, rebalance: bool) -> None:
        insert_partitions(rows, archive_table, spec.partition_key, rebalance=rebalance)

    def write(merged: DataFrame, rebalance: bool, emptied: list) -> None:
        if archive_once and archive_table is not None:
            _append_once(catalog_scan(spark, archive_table), described(spark, archive_table, "Location"), merged, spec, load_ts, rebalance, archive)
        elif archive_table is not None:
            archive(merged, rebalance)
        insert_partitions(merged, current_table, spec.partition_key, overwrite=True, rebalance=rebalance)
        if emptied:
            fmt = described(spark, current_table, "Provider")
            empty_partitions(current, spec.partition_key, emptied, fmt)
            spark.catalog.refreshTable(current_table)

    _merge(current, stamped, spec, cache_delta, cache_merged and archive_table is not None, write,
           load_ts if archive_once else None)


# Fixed names of the version tables: the archive's key and date, renamed before the join and dropped after it.
VERSION_RENAMES = {"id": "s_id", "date": "s_date"}


def version_job(spark: SparkSession, daily_table: str, archive_table: str, out_path: str,
                daily_key: str = "id", archive_renames: Mapping[str, str] | None = None,
                archive_key: str = VERSION_RENAMES["id"], version_col: str = "version",
                drop: Sequence[str] = tuple(VERSION_RENAMES.values()), **join_options) -> DataFrame:
    """Catalog daily table LEFT JOIN catalog archive table -> ``inc_version`` -> JSON.

    Returns the joined frame that was written.
    """
    renames = VERSION_RENAMES if archive_renames is None else dict(archive_renames)
    archive = rename_column(catalog_scan(spark, archive_table), renames)
    daily = catalog_scan(spark, daily_table)
    out = version_increment(daily, archive, daily_key, archive_key, version_col, "inc_version", drop, **join_options)
    write_json(out, out_path)
    return out

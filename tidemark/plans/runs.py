"""Merges as runs: staged partition swaps that commit in one step, and archive snapshots that name their run.

The table *current* keeps three things under its location: the partition folders of its initial load,
``_runs/<attempt>`` with the partitions an attempt of a run has staged, and ``_log``, a small table with one
row for each partition a run replaces.  A run

1. writes the merged partitions once, into its own folder;
2. copies them from those files into *archive*, partition (key, run), by dynamic overwrite;
3. appends its rows to ``_log`` as one file: the commit;
4. points the catalog at the staged folders, partition by partition, and drops emptied ones in one statement.

Until 3 every reader sees the old rows.  From then on :func:`read_current` sees the new rows of all partitions, also
while 4 is under way or after it broke off; the next run (or :func:`finish_swap`) completes it.  A reader of the plain
table sees every single partition old or new.  Nothing is cached for two sinks: what is lost is read
again from files.  A run is named by its load time and can be repeated at any time: see :func:`merge_run`.
Two runs on one table must not overlap.  Folders that no partition points at any more stay (readers may still be
in them); their names are in ``_log``.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from tidemark.functions.columns import align_to_schema, load_ts_literal, refuse_lossy
from tidemark.operators.keys import DEFAULT_BROADCAST_KEYS_BYTES, broadcast_if_small
from tidemark.operators.latest import latest_per_key
from tidemark.operators.merge import collect_touched, stored_spellings, survivors, touched_predicate
from tidemark.plans.jobs import _has_files, _stamp
from tidemark.sinks.files import insert_partitions, write_partitioned
from tidemark.sources.files import bucketing, catalog_scan, create_table, described, read_table
from tidemark.spec import TableSpec

#: Column of *archive* that names the run of a row's snapshot.
RUN_COL = "run_id"


def run_id(load_ts: datetime | str | None = None) -> str:
    """A run's name: its load time (UTC wall clock, now by default) in a form whose order is the order in time."""
    when = datetime.now(timezone.utc) if load_ts is None else load_ts if isinstance(load_ts, datetime) else datetime.fromisoformat(load_ts)
    if when.tzinfo is not None:
        when = when.astimezone(timezone.utc).replace(tzinfo=None)
    return when.isoformat(sep=" ", timespec="microseconds")


def initial_load_run(spark: SparkSession, history: DataFrame, spec: TableSpec, current_table: str, current_path: str,
                     archive_table: str, archive_path: str, load_ts: datetime | str | None = None, fmt: str = "parquet",
                     buckets: int | None = None) -> str:
    """History feed -> *current* (newest row per key) and *archive* (every row, as the first run); returns the run's name.

    Both folders are overwritten whole.  With ``buckets`` *current* is bucketed by the primary key, so a
    merge whose delta is too large to broadcast need not shuffle *current* (:func:`merge_run`)."""
    run = run_id(load_ts)
    stamped = _stamp(history, spec, load_ts_literal(run))
    stored = StructType(stamped.schema.fields)
    archived = StructType([*stored.fields, StructField(RUN_COL, StringType())])
    with_run = stamped.withColumn(RUN_COL, F.lit(run))
    with_run.hint("rebalance", spec.partition_key).write.format(fmt).mode("overwrite") \
        .partitionBy(spec.partition_key, RUN_COL).save(archive_path)
    create_table(spark, archive_table, archive_path, archived, [spec.partition_key, RUN_COL], fmt, replace=True)

    newest = latest_per_key(stamped, spec)
    if buckets is None:
        write_partitioned(newest, current_path, spec.partition_key, "overwrite", fmt)
        create_table(spark, current_table, current_path, stored, spec.partition_key, fmt, replace=True)
    else:
        write_partitioned(newest.limit(0), current_path, spec.partition_key, "overwrite", fmt)  # empties the folder
        create_table(spark, current_table, current_path, stored, spec.partition_key, fmt, replace=True,
                     bucket_by=spec.primary_key, buckets=buckets)
        _insert(newest.repartition(buckets, *spec.primary_key), current_table)
    values = _folders(catalog_scan(spark, current_table), spec.partition_key)
    _commit(spark, current_table, spec.partition_key, run, "load", "load", [(v, f, True) for v, f in values])
    return run


def merge_run(spark: SparkSession, delta: DataFrame, spec: TableSpec, current_table: str, archive_table: str,
              load_ts: datetime | str | None = None, broadcast_bytes: int = DEFAULT_BROADCAST_KEYS_BYTES) -> str:
    """Merge a delta as the run named by ``load_ts`` (now by default); returns its name.

    The result is that of :func:`tidemark.plans.incremental_merge_table`: delta rows plus the existing rows whose key the delta
    lacks, in every partition the delta touches.  A run that *archive* already has is repeated: the same delta is
    merged with the state before that run (:func:`archive_as_of`), its snapshot is replaced by itself, and only
    partitions no later run has replaced are swapped.  So a failed run of any age can be run again and
    leaves one snapshot.  Where *current* is bucketed by the primary key and the delta's keys are too many to
    broadcast, only the delta is shuffled, to the buckets; survivors are written from the tasks that read them."""
    key, run = spec.partition_key, run_id(load_ts)
    attempts = _attempts(spark, current_table, key)
    if any(not a["shown"] for a in attempts):
        finish_swap(spark, current_table)
    current = catalog_scan(spark, current_table)
    stored, fmt, place = current.schema, described(spark, current_table, "Provider"), _place(spark, current_table)
    first = min((a["run"] for a in attempts), default=None)
    if first is None or run <= first:
        raise ValueError(f"{run} is not after the initial load {first} of {current_table}")
    repeated = run <= max(a["run"] for a in attempts)
    existing = archive_as_of(spark, spec, current_table, archive_table, before=run) if repeated else current
    layout = bucketing(spark, current_table)
    buckets = layout[0] if layout and layout[1] == list(spec.primary_key) and not repeated else 0

    stamped = _stamp(delta, spec, load_ts_literal(run))
    refuse_lossy(stamped, stored)
    stamped = align_to_schema(stamped, stored).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        touched = collect_touched(stamped, key)
        spellings = stored_spellings(existing, spec, touched)
        there = existing.where(touched_predicate(F.col(key), touched + spellings))
        kept = survivors(there, stamped, spec.primary_key, broadcast_bytes, buckets)
        attempt = f"{run.replace(' ', 'T').replace(':', '')}-{uuid.uuid4().hex[:8]}"
        staged = f"{place}/_runs/{attempt}"
        if layout is None:
            write_partitioned(stamped.unionByName(kept), staged, key, "overwrite", fmt)
        else:
            _stage_buckets(spark, stored, key, fmt, layout, staged, stamped, kept, buckets > 0)
    finally:
        stamped.unpersist()
    rows = read_table(spark, staged, stored, fmt)
    filled = _folders(rows, key)
    insert_partitions(rows.withColumn(RUN_COL, F.lit(run)), archive_table, key, overwrite=True)
    emptied = set(spellings) - {v for v, _ in filled}
    entries = [(v, f, True) for v, f in filled] + [(v, None, False) for v in sorted(emptied)]
    _commit(spark, current_table, key, run, attempt, "swap", entries)
    if repeated:  # later runs may have replaced some of these partitions
        finish_swap(spark, current_table)
    else:
        _publish(spark, current_table, key, entries, [(run, attempt)])
    return run


def archive_as_of(spark: SparkSession, spec: TableSpec, current_table: str, archive_table: str,
                  run: datetime | str | None = None, before: str | None = None) -> DataFrame:
    """The rows of *current* right after ``run`` (or before the run ``before``; by default after the last), from *archive*.

    The last run per partition value, an aggregate over the log, picks the snapshot of each partition.  A value whose last run
    is the initial load has every version there; its newest rows per key are taken."""
    key = spec.partition_key
    log = _log(spark, current_table, key).where("kind != 'published'")
    if run is not None:
        log = log.where(F.col("run") <= run_id(run))
    if before is not None:
        log = log.where(F.col("run") < run_id(before))
    last = log.groupBy("value").agg(F.max_by(F.struct("run", "kind", "live"), F.struct("run", "seq")).alias("r")) \
        .select("value", "r.*").where("live")
    archive, stored = catalog_scan(spark, archive_table), catalog_scan(spark, current_table).columns
    kinds = {r["kind"]: r["run"] for r in last.groupBy("kind").agg(F.max("run").alias("run")).collect()}

    def of(rows: DataFrame, kind: str) -> DataFrame:
        own = broadcast_if_small(last.where(F.col("kind") == kind).select("value", "run"))
        same = rows[key].eqNullSafe(own["value"]) & (rows[RUN_COL] == own["run"])
        return rows.join(own, same, "left_semi").select(*stored)

    out = of(archive, "swap")
    if "load" in kinds:  # the load is one run; a key's newest row may lie in a partition replaced since
        out = out.unionByName(of(latest_per_key(archive.where(F.col(RUN_COL) == kinds["load"]), spec), "load"))
    return out


def read_current(spark: SparkSession, table: str) -> DataFrame:
    """The rows of *current* as of its last committed run, whether or not the catalog has caught up with it."""
    rows, key = catalog_scan(spark, table), _partition_column(spark, table)
    targets = _unpublished(spark, table, key)[0]
    if not targets:
        return rows
    out = rows.where(~F.coalesce(touched_predicate(F.col(key), [t["value"] for t in targets]), F.lit(False)))
    fmt = described(spark, table, "Provider")
    for attempt in sorted({t["attempt"] for t in targets if t["live"]}):
        values = [t["value"] for t in targets if t["live"] and t["attempt"] == attempt]
        staged = read_table(spark, f"{_place(spark, table)}/_runs/{attempt}", rows.schema, fmt)
        out = out.unionByName(staged.where(touched_predicate(F.col(key), values)))
    return out


def finish_swap(spark: SparkSession, table: str) -> int:
    """Point the catalog at the folders of committed runs it has not caught up with; returns the partitions changed.

    Every step may be repeated, so a swap that broke off is simply done again."""
    key = _partition_column(spark, table)
    targets, attempts = _unpublished(spark, table, key)
    if attempts:
        _publish(spark, table, key, [(t["value"], t["folder"], t["live"]) for t in targets], attempts)
    return len(targets)


def _publish(spark: SparkSession, table: str, key: str, entries: Sequence[tuple], attempts: Sequence[tuple]) -> None:
    live = [(value, folder) for value, folder, there in entries if there]
    if live:
        added = " ".join(f"PARTITION ({_equals(key, value)}) LOCATION {_literal(folder)}" for value, folder in live)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {added}")
        for value, folder in live:
            _set_location(spark, table, key, value, folder)
    drop_partitions(spark, table, key, [value for value, _, there in entries if not there])
    spark.catalog.refreshTable(table)
    for run, attempt in attempts:
        _commit(spark, table, key, run, attempt, "published", [(None, None, False)])


def drop_partitions(spark: SparkSession, table: str, key: str, values: Sequence) -> None:
    """Take the partitions ``values`` out of an external table, all in one statement; their files stay."""
    if values:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(f"PARTITION ({_equals(key, v)})" for v in values))


def _set_location(spark: SparkSession, table: str, key: str, value, folder: str) -> None:
    spark.sql(f"ALTER TABLE {table} PARTITION ({_equals(key, value)}) SET LOCATION {_literal(folder)}")


def _insert(rows: DataFrame, table: str) -> None:
    rows.select(*rows.sparkSession.table(table).columns).write.insertInto(table)


def _stage_buckets(spark: SparkSession, schema: StructType, key: str, fmt: str, layout: tuple[int, list[str]], staged: str,
                   delta: DataFrame, kept: DataFrame, co_located: bool) -> None:
    """Write delta and survivors into ``staged`` in a bucket layout.

    Both are appended on their own: survivors of a co-located join already lie in bucket order, so they are
    written without a shuffle, and only the delta is dealt to the buckets."""
    count, columns = layout
    name = f"tidemark_staged_{uuid.uuid4().hex[:12]}"
    create_table(spark, name, staged, schema, key, fmt, bucket_by=columns, buckets=count)
    try:
        _insert(delta.repartition(count, *columns), name)
        _insert(kept if co_located else kept.repartition(count, *columns), name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def _place(spark: SparkSession, table: str) -> str:
    return described(spark, table, "Location").rstrip("/")


def _partition_column(spark: SparkSession, table: str) -> str:
    return next(c.name for c in spark.catalog.listColumns(table) if c.isPartition)


def _folders(rows: DataFrame, key: str) -> list[tuple]:
    """Partition values of the table that ``rows`` reads and their folders, named by the files in them (one row per partition)."""
    if not _has_files(rows):
        return []
    found = rows.select(key, F.col("_metadata.file_path").alias("_f")).groupBy(key).agg(F.max("_f"))
    return [(value, unquote(file.rpartition("/")[0])) for value, file in found.collect()]


def _log_schema(spark: SparkSession, table: str, key: str) -> StructType:
    text = StringType()
    return StructType([StructField("run", text), StructField("attempt", text), StructField("seq", LongType()), StructField("kind", text),
                       StructField("value", spark.table(table).schema[key].dataType), StructField("folder", text),
                       StructField("live", BooleanType())])


def _log(spark: SparkSession, table: str, key: str) -> DataFrame:
    """One row per partition and committed attempt (``load``, ``swap``), and one per attempt the catalog shows (``published``)."""
    return read_table(spark, f"{_place(spark, table)}/_log", _log_schema(spark, table, key))


def _commit(spark: SparkSession, table: str, key: str, run: str, attempt: str, kind: str, entries: Sequence[tuple]) -> None:
    """Append the attempt's rows as a single file, which appears whole or not at all."""
    now = time.time_ns()
    rows = [(run, attempt, now, kind, value, folder, live) for value, folder, live in entries]
    spark.createDataFrame(rows, _log_schema(spark, table, key)).coalesce(1).write.mode("append").parquet(f"{_place(spark, table)}/_log")


def _attempts(spark: SparkSession, table: str, key: str) -> list:
    """Committed attempts in order, and whether the catalog shows them: one row each, however many partitions they have."""
    return _log(spark, table, key).groupBy("run", "attempt") \
        .agg(F.bool_or(F.col("kind") != "swap").alias("shown")).orderBy("run", "attempt").collect()


def _unpublished(spark: SparkSession, table: str, key: str) -> tuple[list, list]:
    """What the catalog has yet to show: the newest entry of each value that such attempts touch, and these attempts."""
    attempts = [(a["run"], a["attempt"]) for a in _attempts(spark, table, key) if not a["shown"]]
    if not attempts:
        return [], []
    waits = [a for _, a in attempts]
    newest = _log(spark, table, key).where("kind != 'published'").groupBy("value") \
        .agg(F.max_by(F.struct("attempt", "folder", "live"), F.struct("run", "seq")).alias("r")).select("value", "r.*")
    return newest.where(F.col("attempt").isin(waits)).collect(), attempts  # other values are shown already, by a later run


def _equals(key: str, value) -> str:
    return f"`{key}` = {_literal(value)}"


def _literal(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, (bool, int)):
        return str(value).lower()
    if hasattr(value, "isoformat"):
        return ("TIMESTAMP_NTZ" if hasattr(value, "hour") else "DATE") + f"'{value}'"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"

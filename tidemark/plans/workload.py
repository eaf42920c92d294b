"""The operator inventory exercised on the shared test tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame; :data:`SQL`
holds an independent DuckDB statement with the same result for each.

Workload (orders as a history feed): key ``o_custkey``, newest first by
``o_orderdate`` then ``o_orderkey``, partitioned by ``o_orderpriority``.
The *delta* feed is every order from 2000-01-01 on in two priorities, loaded
2024-01-31 (newest per customer); all other orders are the *existing* feed, loaded
2024-01-01, so each order is on one side.  ``events`` is a second feed (key ``user_id``, newest by
``ts`` then ``event_id``, partitioned by ``event_type``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import (
    drop_columns,
    prefixed_projection,
    rename_column,
    rename_positional,
    reorder_columns,
    title_case,
    with_load_ts,
    with_partition_copy,
)
from tidemark.operators import (
    existing_in_touched,
    latest_per_key,
    merged_partitions,
    partition_values,
    rank_versions,
    survivors,
    version_increment,
    version_join,
)
from tidemark.operators.merge import collect_touched
from tidemark.plans.jobs import (
    incremental_merge,
    incremental_merge_table,
    initial_load,
    initial_load_table,
    version_job,
)
from tidemark.plans.runs import archive_as_of, initial_load_run, merge_run, read_current
from tidemark.session import scratch_path
from tidemark.sinks import swap_partitions, write_json, write_partitioned
from tidemark.sources import catalog_scan, partition_subset_scan, read_table, register_table, scan
from tidemark.spec import TableSpec

# Fixed values of the workload (ours, not the reference's).
CUTOFF = "2000-01-01 00:00:00"
EXISTING_TS = "2024-01-01 00:00:00"
DELTA_TS = "2024-01-31 00:00:00"
DELTA_PRIORITIES = ["1-URGENT", "5-LOW"]
SECOND_TS = "2024-02-29 00:00:00"
SECOND_PRIORITY = "2-HIGH"

ORDERS = TableSpec(("o_custkey",), ("o_orderdate", "o_orderkey"), "o_orderpriority")
EVENTS = TableSpec(("user_id",), ("ts", "event_id"), "event_type")
# A composite key that repeats; every other column breaks ties, so the newest row is well defined.
LINEITEM = TableSpec(("l_orderkey", "l_linenumber"),
                     ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                      "l_returnflag", "l_linestatus"), "l_returnflag")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _in_delta():
    return (F.col("o_orderdate") >= _ntz(CUTOFF)) & F.col("o_orderpriority").isin(DELTA_PRIORITIES)


def existing_feed(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").where(~F.coalesce(_in_delta(), F.lit(False)))


def delta_rows(spark, sf_dir) -> DataFrame:
    """The daily delta, newest order per customer (no load time yet)."""
    return latest_per_key(table(spark, sf_dir, "orders").where(_in_delta()), ORDERS)


def existing_rows(spark, sf_dir) -> DataFrame:
    return with_load_ts(latest_per_key(existing_feed(spark, sf_dir), ORDERS), ORDERS.load_ts_col, EXISTING_TS)


def stamped_delta(spark, sf_dir) -> DataFrame:
    return with_load_ts(delta_rows(spark, sf_dir), ORDERS.load_ts_col, DELTA_TS)


def _table_schema(spark, sf_dir) -> StructType:
    return existing_rows(spark, sf_dir).schema


def _stage_tables(spark, sf_dir, name: str, with_archive: bool) -> tuple[str, str | None]:
    """Initial load of the existing feed into fresh current (+ archive) tables."""
    cur = scratch_path(spark, f"{name}-current")
    arc = scratch_path(spark, f"{name}-archive") if with_archive else None
    initial_load(existing_feed(spark, sf_dir), ORDERS, cur, arc, load_ts=EXISTING_TS)
    return cur, arc


def archive_frame(spark, sf_dir) -> DataFrame:
    """Archive of versions: every order of a customer, version 1, 2, ... by date."""
    orders = table(spark, sf_dir, "orders")
    oldest_first = TableSpec(("o_custkey",), (F.asc_nulls_first("o_orderdate"), F.asc_nulls_first("o_orderkey")),
                             "o_orderpriority")
    ranked = rank_versions(orders, oldest_first, name="version")
    return ranked.select(F.col("o_custkey").alias("id"), F.col("o_orderdate").alias("date"), "version")


# ---------------------------------------------------------------- sources
def q_scan_parquet(spark, sf_dir):
    return scan(spark, f"{sf_dir.rstrip('/')}/orders.parquet", "parquet")


def q_catalog_scan(spark, sf_dir):
    register_table(spark, "tidemark_orders", f"{sf_dir.rstrip('/')}/orders.parquet")
    return catalog_scan(spark, "tidemark_orders")


def q_partition_subset_scan(spark, sf_dir):
    cur, _ = _stage_tables(spark, sf_dir, "subset", with_archive=False)
    touched = collect_touched(stamped_delta(spark, sf_dir), ORDERS.partition_key)
    return partition_subset_scan(spark, cur, _table_schema(spark, sf_dir), ORDERS.partition_key, touched)


def q_scan_orc(spark, sf_dir):
    """The other columnar format, chosen at run time; written from orders first."""
    path = scratch_path(spark, "orc")
    table(spark, sf_dir, "orders").write.format("orc").save(path)
    return scan(spark, path, "orc")


# ---------------------------------------------------------------- sinks
def q_overwrite_partitioned(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "overwrite")
    write_partitioned(customer, path, "c_mktsegment", "overwrite")
    return read_table(spark, path, customer.schema)


def q_json_sink(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "json")
    write_json(orders, path)
    return spark.read.schema(orders.schema).json(path)


def q_partition_swap(spark, sf_dir):
    cur, _ = _stage_tables(spark, sf_dir, "swap", with_archive=False)
    stored = read_table(spark, cur, _table_schema(spark, sf_dir))
    merged = merged_partitions(stored, stamped_delta(spark, sf_dir), ORDERS)
    swap_partitions(merged, cur, ORDERS.partition_key)
    return read_table(spark, cur, _table_schema(spark, sf_dir))


def q_incremental_merge(spark, sf_dir):
    cur, arc = _stage_tables(spark, sf_dir, "merge", with_archive=True)
    stored = _table_schema(spark, sf_dir)  # known here, so the merge need not list current to find it
    incremental_merge(spark, delta_rows(spark, sf_dir), ORDERS, cur, arc, load_ts=DELTA_TS, current_schema=stored)
    return read_table(spark, cur, stored)


def q_archive_append(spark, sf_dir):
    cur, arc = _stage_tables(spark, sf_dir, "archive", with_archive=True)
    stored = _table_schema(spark, sf_dir)
    incremental_merge(spark, delta_rows(spark, sf_dir), ORDERS, cur, arc, load_ts=DELTA_TS, current_schema=stored)
    return read_table(spark, arc, stored)


def q_catalog_merge(spark, sf_dir):
    """The merge on catalog tables: only the touched partitions are listed."""
    tag = uuid.uuid4().hex[:12]
    cur_t, arc_t = f"tidemark_current_{tag}", f"tidemark_archive_{tag}"
    cur = scratch_path(spark, "cat-current")
    initial_load_table(spark, existing_feed(spark, sf_dir), ORDERS, cur_t, cur, arc_t, scratch_path(spark, "cat-archive"),
                       load_ts=EXISTING_TS)
    incremental_merge_table(spark, delta_rows(spark, sf_dir), ORDERS, cur_t, arc_t, load_ts=DELTA_TS)
    for name in (cur_t, arc_t):  # external: the definitions go, the files stay
        spark.sql(f"DROP TABLE {name}")
    return read_table(spark, cur, _table_schema(spark, sf_dir))


def second_delta(spark, sf_dir) -> DataFrame:
    """A later delta: the newest recent order per customer in one priority the first delta does not touch."""
    recent = (F.col("o_orderdate") >= _ntz(CUTOFF)) & (F.col("o_orderpriority") == SECOND_PRIORITY)
    return latest_per_key(table(spark, sf_dir, "orders").where(recent), ORDERS)


def _two_runs(spark, sf_dir, name: str, **options) -> tuple[str, str]:
    """Initial load and two merges as runs, into fresh tables; the first merge takes ``options``."""
    tag = uuid.uuid4().hex[:12]
    cur_t, arc_t = f"tidemark_{name}_current_{tag}", f"tidemark_{name}_archive_{tag}"
    initial_load_run(spark, existing_feed(spark, sf_dir), ORDERS, cur_t, scratch_path(spark, f"{name}-current"), arc_t,
                     scratch_path(spark, f"{name}-archive"), load_ts=EXISTING_TS, buckets=options.pop("buckets", None))
    merge_run(spark, delta_rows(spark, sf_dir), ORDERS, cur_t, arc_t, load_ts=DELTA_TS, **options)
    merge_run(spark, second_delta(spark, sf_dir), ORDERS, cur_t, arc_t, load_ts=SECOND_TS)
    return cur_t, arc_t


def q_staged_merge(spark, sf_dir):
    """Two merges whose swaps are staged and committed in one step each."""
    return read_current(spark, _two_runs(spark, sf_dir, "staged")[0])


def q_bucketed_merge(spark, sf_dir):
    """The same on a bucketed *current*, the first delta taken as too large to broadcast."""
    return read_current(spark, _two_runs(spark, sf_dir, "bucketed", buckets=8, broadcast_bytes=0)[0])


def q_archive_as_of(spark, sf_dir):
    """*current* as it was after the first of two merges, from the archive's snapshots."""
    cur_t, arc_t = _two_runs(spark, sf_dir, "asof")
    return archive_as_of(spark, ORDERS, cur_t, arc_t, run=DELTA_TS)


def q_repeated_run(spark, sf_dir):
    """The archive after the first of two merges has been run again: every snapshot once."""
    cur_t, arc_t = _two_runs(spark, sf_dir, "repeat")
    merge_run(spark, delta_rows(spark, sf_dir), ORDERS, cur_t, arc_t, load_ts=DELTA_TS)
    return catalog_scan(spark, arc_t)


def q_streaming_merge(spark, sf_dir):
    """The merge triggered by Structured Streaming: the delta lands as files."""
    from tidemark.streaming import start_merge_stream

    cur, arc = _stage_tables(spark, sf_dir, "stream", with_archive=True)
    landing = scratch_path(spark, "stream-landing")
    delta = delta_rows(spark, sf_dir)
    delta.write.parquet(landing)
    query = start_merge_stream(spark, landing, delta.schema, ORDERS, cur, scratch_path(spark, "stream-ckpt"),
                               archive_path=arc, load_ts=DELTA_TS)
    query.awaitTermination()
    return read_table(spark, cur, _table_schema(spark, sf_dir))


def q_initial_load(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    cur = scratch_path(spark, "init-current")
    initial_load(events, EVENTS, cur, None, load_ts=DELTA_TS)
    return read_table(spark, cur, with_load_ts(events, EVENTS.load_ts_col, DELTA_TS).schema)


def q_initial_archive(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    cur, arc = scratch_path(spark, "init2-current"), scratch_path(spark, "init2-archive")
    initial_load(events, EVENTS, cur, arc, load_ts=DELTA_TS)
    return read_table(spark, arc, with_load_ts(events, EVENTS.load_ts_col, DELTA_TS).schema)


def q_version_job(spark, sf_dir):
    daily = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "id")
    daily.createOrReplaceTempView("tidemark_daily")
    archive_frame(spark, sf_dir).createOrReplaceTempView("tidemark_archive")
    path = scratch_path(spark, "version-job")
    out = version_job(spark, "tidemark_daily", "tidemark_archive", path)
    return spark.read.schema(out.schema).json(path)


# ---------------------------------------------------------------- projections
def q_prefixed_projection(spark, sf_dir):
    return prefixed_projection(table(spark, sf_dir, "customer"), "daily_data")


def q_positional_rename(spark, sf_dir):
    return rename_positional(table(spark, sf_dir, "customer"), ["id", "name", "nation_id", "balance", "segment"])


def q_load_timestamp(spark, sf_dir):
    return with_load_ts(table(spark, sf_dir, "customer"), "load_ts", DELTA_TS)


def q_partition_copy_column(spark, sf_dir):
    return with_partition_copy(table(spark, sf_dir, "customer"), "c_mktsegment")


def q_reorder_columns(spark, sf_dir):
    return reorder_columns(table(spark, sf_dir, "customer"), ["c_mktsegment", "c_custkey", "c_name"])


def q_rename_column(spark, sf_dir):
    return rename_column(table(spark, sf_dir, "customer"), {"c_name": "name"})


def q_drop_columns(spark, sf_dir):
    return drop_columns(table(spark, sf_dir, "customer"), ["c_name", "c_acctbal"])


def q_title_case(spark, sf_dir):
    """Title-cased partition values, as the workflow spells partition folders."""
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", "o_orderpriority", title_case("o_orderpriority").alias("o_orderpriority_title"))


# ---------------------------------------------------------------- merge pieces
def q_partition_values(spark, sf_dir):
    return partition_values(stamped_delta(spark, sf_dir), ORDERS.partition_key)


def q_survivors_anti_join(spark, sf_dir):
    delta = stamped_delta(spark, sf_dir)
    existing = existing_in_touched(existing_rows(spark, sf_dir), delta, ORDERS.partition_key)
    return survivors(existing, delta, ORDERS.primary_key)


def q_merge_union(spark, sf_dir):
    return merged_partitions(existing_rows(spark, sf_dir), stamped_delta(spark, sf_dir), ORDERS)


# ---------------------------------------------------------------- windows, joins
def q_row_number_rank(spark, sf_dir):
    return rank_versions(table(spark, sf_dir, "events"), EVENTS, name="row_num")


def q_latest_per_key(spark, sf_dir):
    return latest_per_key(table(spark, sf_dir, "orders"), ORDERS)


def q_latest_per_composite_key(spark, sf_dir):
    return latest_per_key(table(spark, sf_dir, "lineitem"), LINEITEM)


def q_version_join(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return version_join(customer, table(spark, sf_dir, "orders"), "c_custkey", "o_custkey")


def q_version_increment(spark, sf_dir):
    archive = archive_frame(spark, sf_dir).withColumnsRenamed({"id": "s_id", "date": "s_date"})
    return version_increment(table(spark, sf_dir, "customer"), archive, "c_custkey", "s_id",
                             drop=["s_id", "s_date"])


QUERIES = {
    "scan_parquet": q_scan_parquet,
    "scan_orc": q_scan_orc,
    "catalog_scan": q_catalog_scan,
    "partition_subset_scan": q_partition_subset_scan,
    "overwrite_partitioned": q_overwrite_partitioned,
    "archive_append": q_archive_append,
    "json_sink": q_json_sink,
    "partition_swap": q_partition_swap,
    "prefixed_projection": q_prefixed_projection,
    "positional_rename": q_positional_rename,
    "load_timestamp": q_load_timestamp,
    "partition_copy_column": q_partition_copy_column,
    "reorder_columns": q_reorder_columns,
    "rename_column": q_rename_column,
    "drop_columns": q_drop_columns,
    "partition_values": q_partition_values,
    "survivors_anti_join": q_survivors_anti_join,
    "version_join": q_version_join,
    "row_number_rank": q_row_number_rank,
    "latest_per_key": q_latest_per_key,
    "latest_per_composite_key": q_latest_per_composite_key,
    "merge_union": q_merge_union,
    "title_case": q_title_case,
    "version_increment": q_version_increment,
    "initial_load": q_initial_load,
    "initial_archive": q_initial_archive,
    "incremental_merge": q_incremental_merge,
    "catalog_merge": q_catalog_merge,
    "staged_merge": q_staged_merge,
    "bucketed_merge": q_bucketed_merge,
    "archive_as_of": q_archive_as_of,
    "repeated_run": q_repeated_run,
    "streaming_merge": q_streaming_merge,
    "version_job": q_version_job,
}

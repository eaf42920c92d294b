"""W1 ranking of versions per key and W2 latest version per key."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.keys import (
    DEFAULT_HOT_KEY_ROWS,
    DEFAULT_MAX_HOT_KEYS,
    hot_keys,
    null_safe_match,
)
from tidemark.session import checkpoint_root
from tidemark.spec import TableSpec


def _version_window(spec: TableSpec):
    return Window.partitionBy(*spec.primary_key).orderBy(*spec.order_columns())


def latest_per_key(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Newest row per primary key (ties broken by the rest of ``version_order``).

    Written as ``row_number() = 1``; Catalyst turns it into a partial
    ``WindowGroupLimit`` before the shuffle, so each task ships at most one row
    per key: a key holding a third of the input still shuffles a handful of rows.
    """
    rn = "__tidemark_rn"
    return (
        df.withColumn(rn, F.row_number().over(_version_window(spec)))
        .where(F.col(rn) == 1)
        .drop(rn)
    )


def rank_versions(
    df: DataFrame,
    spec: TableSpec,
    name: str = "row_num",
    hot_key_rows: int = DEFAULT_HOT_KEY_ROWS,
    max_hot_keys: int | None = DEFAULT_MAX_HOT_KEYS,
    detect_hot_keys: bool = True,
) -> DataFrame:
    """``row_number()`` per primary key, newest first, for every row.

    Ordinary keys use one window.  Keys with more than ``hot_key_rows`` rows
    would put all of their rows into one task, so they are ranked by a split
    plan instead (see :func:`_split_rank`); both parts are exact.
    """
    plain = df.withColumn(name, F.row_number().over(_version_window(spec)))
    found = hot_keys(df, spec.primary_key, hot_key_rows, max_hot_keys) if detect_hot_keys else None
    if found is None:
        return plain
    hot, hot_list = found
    pk = list(spec.primary_key)
    hot_b = F.broadcast(hot.toDF(*[f"_hot_{c}" for c in pk], "_n"))
    match = null_safe_match(df, pk, hot_b, [f"_hot_{c}" for c in pk])
    cold = df.join(hot_b, match, "left_anti")
    hot_rows = df.join(hot_b, match, "left_semi")
    hot_total = sum(r["_n"] for r in hot_list)
    splits = max(2, math.ceil(hot_total / hot_key_rows))
    cold_ranked = cold.withColumn(name, F.row_number().over(_version_window(spec)))
    return cold_ranked.unionByName(_split_rank(hot_rows, spec, name, splits))


def _split_rank(rows: DataFrame, spec: TableSpec, name: str, splits: int) -> DataFrame:
    """Exact row numbers for a few very large keys without one task per key.

    1. Range-partition by (key, version order) and sort inside each split: a
       large key now spans several consecutive splits, none larger than the
       sampled range size.  Ties in the version order are ordered further by a
       row hash and the input task, so even a key made of exact copies of one
       row spreads over several splits.
    2. Tag each row with its split id and position (``monotonically_increasing_id``
       counts rows in sorted order within a split) and checkpoint, so the tags
       are fixed data in the shared checkpoint folder.
    3. Per (key, split): first position and row count; the running count of
       the earlier splits of the same key is its offset.  This table has at most
       ``#hot keys + #splits`` rows, so broadcasting it is safe.
    4. row number = position - first position + 1 + offset.
    """
    pk = list(spec.primary_key)
    tagged = _tagged_splits(rows, spec, splits)
    firsts = tagged.groupBy(*pk, "_split").agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_cnt")
    )
    before = Window.partitionBy(*pk).orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = firsts.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    offsets = F.broadcast(offsets.toDF(*[f"_o_{c}" for c in offsets.columns]))
    cond = null_safe_match(tagged, pk + ["_split"], offsets, [f"_o_{c}" for c in pk] + ["_o__split"])
    rank = (F.col("_pos") - F.col("_o__first") + F.col("_o__off") + F.lit(1)).cast("int")
    return tagged.join(offsets, cond, "inner").select(*rows.columns, rank.alias(name))


def _tagged_splits(rows: DataFrame, spec: TableSpec, splits: int) -> DataFrame:
    """Rows in ``splits`` sorted ranges with ``_split`` and ``_pos``, checkpointed."""
    checkpoint_root(rows.sparkSession)  # the shared folder the tags are written to
    pk = list(spec.primary_key)
    ties = [F.xxhash64(*rows.columns).alias("_tie_hash"), F.spark_partition_id().alias("_tie_task")]
    order = [*[F.asc_nulls_first(c) for c in pk], *spec.order_columns(), F.col("_tie_hash"), F.col("_tie_task")]
    return (
        rows.select(*rows.columns, *ties)
        .repartitionByRange(splits, *order)
        .sortWithinPartitions(*order)
        .withColumn("_split", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )

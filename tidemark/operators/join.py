"""J1 version join (left outer, fan-out kept) and X1 version increment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.versions import next_version
from tidemark.operators.keys import (
    DEFAULT_BROADCAST_KEYS_BYTES,
    DEFAULT_HOT_KEY_ROWS,
    DEFAULT_MAX_HOT_KEYS,
    all_not_null,
    broadcast_if_small,
    hot_table,
    key_census,
)

def row_salt(columns: Sequence[str], salts: Column) -> Column:
    """A salt in ``[0, salts)`` from a hash of the row and of the task that
    reads it.  Exact copies of one row hash alike, but copies arrive through
    many input tasks, so they spread too; both parts are fixed for a given
    input, so a retried task assigns the same salts."""
    return F.pmod(F.xxhash64(*columns, F.spark_partition_id()), salts.cast("long")).cast("int")


def _eq(left: DataFrame, lk: Sequence[str], right: DataFrame, rk: Sequence[str]):
    cond = F.lit(True)
    for a, b in zip(lk, rk):
        cond = cond & (left[a] == right[b])
    return cond


def version_join(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str] | str,
    right_keys: Sequence[str] | str,
    hot_key_rows: int = DEFAULT_HOT_KEY_ROWS,
    max_hot_keys: int | None = DEFAULT_MAX_HOT_KEYS,
    broadcast_bytes: int = DEFAULT_BROADCAST_KEYS_BYTES,
) -> DataFrame:
    """``left LEFT OUTER JOIN right ON left_keys = right_keys``, every match kept.

    Column names of the two sides must differ (rename first).  Plan:

    * one pass over the key columns of ``right`` counts its rows and finds its hot keys
      (:func:`tidemark.operators.keys.key_census`); nothing else reads it but the join.
    * a ``right`` of at most ``hot_key_rows`` rows is joined as it is.
    * a larger one is first cut to keys that occur in ``left`` by a semi join; the
      distinct left keys are broadcast when counted at most ``broadcast_bytes``,
      so the large side is only filtered, never shuffled whole.
    * right keys with more than ``hot_key_rows`` rows are salted: their right
      rows spread over ``ceil(n / hot_key_rows)`` salts (:func:`row_salt`), the left
      rows of those keys are copied once per salt, and the two meet in an inner
      join (every hot key has a match, so outer == inner there).  All other keys,
      null keys included, take an ordinary left outer join, where adaptive
      skew-join handling splits a skewed left (preserved) side.
    """
    lk = [left_keys] if isinstance(left_keys, str) else list(left_keys)
    rk = [right_keys] if isinstance(right_keys, str) else list(right_keys)
    if len(lk) != len(rk):
        raise ValueError("left_keys and right_keys differ in length")
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"both sides carry {sorted(clash)}; rename one side first")
    out_cols = left.columns + right.columns

    rows, hot_rows = key_census(right, rk, hot_key_rows, max_hot_keys, include_null=False)
    if rows <= hot_key_rows:  # no key can be hot
        return left.join(right, _eq(left, lk, right, rk), "left_outer").select(*out_cols)

    left_keys = left.select(*[F.col(a).alias(b) for a, b in zip(lk, rk)]).where(all_not_null(rk))
    right_m = right.join(broadcast_if_small(left_keys.distinct(), broadcast_bytes, rows_of=left_keys), rk, "left_semi")
    found = hot_table(right, rk, hot_rows)
    if found is None:
        return left.join(right_m, _eq(left, lk, right_m, rk), "left_outer").select(*out_cols)

    hot, _ = found
    hk = [f"_hot_{c}" for c in rk]
    salts = F.ceil(F.col("_n") / F.lit(hot_key_rows)).cast("int")
    hot_b = F.broadcast(hot.toDF(*hk, "_n").withColumn("_salts", salts).drop("_n"))

    cold_left = left.join(hot_b, _eq(left, lk, hot_b, hk), "left_anti")
    cold_right = right_m.join(hot_b, _eq(right_m, rk, hot_b, hk), "left_anti")
    cold = cold_left.join(cold_right, _eq(cold_left, lk, cold_right, rk), "left_outer").select(*out_cols)

    hot_left = (
        left.join(hot_b, _eq(left, lk, hot_b, hk), "inner")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
        .select(*left.columns, "_salt")
    )
    hot_right = (
        right_m.join(hot_b, _eq(right_m, rk, hot_b, hk), "inner")
        .withColumn("_rsalt", row_salt(right.columns, F.col("_salts")))
        .select(*right.columns, "_rsalt")
    )
    cond = _eq(hot_left, lk, hot_right, rk) & (hot_left["_salt"] == hot_right["_rsalt"])
    hot_out = hot_left.join(hot_right, cond, "inner").select(*out_cols)
    return cold.unionByName(hot_out)


def version_increment(
    daily: DataFrame,
    archive: DataFrame,
    daily_key: str,
    archive_key: str,
    version_col: str = "version",
    out_col: str = "inc_version",
    drop: Sequence[str] = (),
    **join_options,
) -> DataFrame:
    """Daily rows joined to their archive versions plus ``coalesce(version,0)+1``.

    A daily row matching several archive rows yields one row each (fan-out
    kept); ``drop`` removes archive-side helper columns afterwards.
    """
    joined = version_join(daily, archive, [daily_key], [archive_key], **join_options)
    return joined.withColumn(out_col, next_version(version_col)).drop(*drop)

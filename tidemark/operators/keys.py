"""Key helpers shared by the operators: null-safe key matching and hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType, VariantType

# Above this many rows a single key is split across tasks (our choice).
DEFAULT_HOT_KEY_ROWS = 2_000_000
# Detection samples rows so that a key of ``hot_key_rows`` rows is seen about
# this many times; a hot key is then missed with negligible probability, and
# a miss or a false hit only changes the plan, never the result.
SAMPLE_HITS = 1000
# All hot keys are split: there are at most rows / hot_key_rows of them.
DEFAULT_MAX_HOT_KEYS = None
# A key set (distinct join keys) is broadcast explicitly, so the large side of its
# join is never shuffled, up to this many counted bytes in memory ...
DEFAULT_BROADCAST_KEYS_BYTES = 256 * 1024 * 1024
# ... and this many counted rows; beyond either the join shuffles both sides (our choice).
DEFAULT_BROADCAST_KEY_ROWS = 2_000_000


def all_not_null(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def any_null(cols: Sequence[str]) -> Column:
    return ~all_not_null(cols)


def null_safe_match(left: DataFrame, left_cols: Sequence[str], right: DataFrame, right_cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for lc, rc in zip(left_cols, right_cols):
        cond = cond & left[lc].eqNullSafe(right[rc])
    return cond


def measured_bytes(df: DataFrame) -> tuple[int, int]:
    """Rows of ``df`` and a bound of their bytes in memory: 32 for each row, 16 for each
    column, and the bytes of strings, binaries and anything nested.

    One aggregate with partial sums: each task sends one row."""
    width = F.lit(32 + 16 * len(df.columns)).cast("long")
    for f in df.schema.fields:
        if isinstance(f.dataType, (StringType, BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        elif isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType)):
            width = width + 16 * F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0))
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return n, size


def fits_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_KEYS_BYTES,
                   max_rows: int = DEFAULT_BROADCAST_KEY_ROWS) -> bool:
    """Whether the counted rows and bytes (:func:`measured_bytes`) stay within the bounds."""
    rows, size = measured_bytes(df)
    return rows <= max_rows and size <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_KEYS_BYTES,
                       max_rows: int = DEFAULT_BROADCAST_KEY_ROWS, rows_of: DataFrame | None = None) -> DataFrame:
    """``df`` marked for broadcast when its counted size is small, else unchanged
    (the planner and adaptive execution decide, normally a shuffle join).

    Rows and bytes are those that would be broadcast (:func:`measured_bytes`),
    not those of the files they come from.  ``rows_of`` is counted
    instead when given: the same columns before the ``distinct`` that made
    ``df``, so the count needs no shuffle and bounds ``df`` from above.
    """
    return F.broadcast(df) if fits_broadcast(df if rows_of is None else rows_of, max_bytes, max_rows) else df


def key_census(
    df: DataFrame,
    keys: Sequence[str],
    hot_key_rows: int = DEFAULT_HOT_KEY_ROWS,
    max_hot_keys: int | None = DEFAULT_MAX_HOT_KEYS,
    include_null: bool = True,
) -> tuple[int, list]:
    """Rows of ``df`` and its keys of more than ``hot_key_rows`` rows (``keys + _n`` with the
    estimated count, largest first), in one pass over the key columns.

    A seeded Bernoulli sample of ``SAMPLE_HITS / hot_key_rows`` of the rows is counted per key (all rows
    for small thresholds); the other rows are counted as one group, one row per task.  So the shuffle
    is a small fraction of the input and the total is exact.  At most rows / ``hot_key_rows`` keys are collected.
    """
    fraction = min(1.0, SAMPLE_HITS / hot_key_rows)
    # a key at the threshold is expected SAMPLE_HITS times; flag it from half that
    floor = hot_key_rows if fraction == 1.0 else fraction * hot_key_rows / 2
    named = [f"_k{i}" for i in range(len(keys))]
    seen = F.col("_seen")
    picked = df.select(*[F.col(c).alias(n) for c, n in zip(keys, named)]) \
        .withColumn("_seen", F.lit(True) if fraction == 1.0 else F.rand(17) < fraction)
    hits = picked.groupBy("_seen", *[F.when(seen, F.col(n)).alias(n) for n in named]).agg(F.count(F.lit(1)).alias("_hits"))
    hot = seen & (F.col("_hits") > F.lit(floor))
    if not include_null:
        hot = hot & all_not_null(named)
    found = hits.groupBy(F.when(hot, F.struct(*named)).alias("_key")).agg(F.sum("_hits").alias("_hits")).collect()
    by_size = sorted((r for r in found if r["_key"] is not None), key=lambda r: -r["_hits"])[:max_hot_keys]
    return sum(r["_hits"] for r in found), [Row(*keys, "_n")(*r["_key"], round(r["_hits"] / fraction)) for r in by_size]


def hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    hot_key_rows: int = DEFAULT_HOT_KEY_ROWS,
    max_hot_keys: int | None = DEFAULT_MAX_HOT_KEYS,
    include_null: bool = True,
) -> tuple[DataFrame, list] | None:
    """The hot keys of :func:`key_census` (at most ``max_hot_keys`` of them if that is given) as a small
    DataFrame (``keys + _n``), plus the collected rows; ``None`` when there is no hot key.

    A missed or a false hot key only changes a plan, never a result.
    """
    return hot_table(df, keys, key_census(df, keys, hot_key_rows, max_hot_keys, include_null)[1])


def hot_table(df: DataFrame, keys: Sequence[str], found: list) -> tuple[DataFrame, list] | None:
    """Hot keys of ``df`` as a small DataFrame, plus their rows; ``None`` without any."""
    if not found:
        return None
    schema = df.select(*keys).schema.add("_n", "long", False)
    return df.sparkSession.createDataFrame(found, schema), found

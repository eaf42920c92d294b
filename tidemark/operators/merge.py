"""Pieces of the incremental merge: touched partitions, survivors, union."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.operators.keys import DEFAULT_BROADCAST_KEYS_BYTES, all_not_null, any_null, fits_broadcast
from tidemark.spec import TableSpec

_SPREAD = "__tidemark_spread"


def blank_partition_to_null(df: DataFrame, key: str) -> DataFrame:
    """A string partition value '' is stored as the null partition; say so up front."""
    if isinstance(df.schema[key].dataType, StringType):
        return df.withColumn(key, F.when(F.col(key) == F.lit(""), F.lit(None)).otherwise(F.col(key)))
    return df


def partition_values(delta: DataFrame, key: str) -> DataFrame:
    """Distinct partition values the delta touches (partial + final aggregate)."""
    return delta.select(F.col(key)).distinct()


def collect_touched(delta: DataFrame, key: str) -> list:
    """The touched values on the driver: one per partition the merge is about to
    write, which the driver lists anyway when it commits the overwrite."""
    return [r[0] for r in partition_values(delta, key).collect()]


def touched_predicate(col: Column, values: Sequence) -> Column:
    """Exact, null-safe membership: ``col IN (...) [OR col IS NULL]``.

    On a partition column this is a static ``PartitionFilters`` entry, so only
    the touched directories are read (and, for a catalog table whose
    partitions the catalog tracks, the only ones listed).
    """
    non_null = [v for v in values if v is not None]
    pred = col.isin(non_null) if non_null else F.lit(False)
    if len(non_null) != len(values):
        pred = pred | col.isNull()
    return pred


def existing_in_touched(current: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """Rows of ``current`` whose partition value the delta touches: a static
    partition predicate, however many values there are."""
    return current.where(touched_predicate(F.col(key), collect_touched(delta, key)))


def stored_spellings(current: DataFrame, spec: TableSpec, touched: Sequence) -> list:
    """Partition values of ``current`` that the normalizer maps to a touched value but that are
    spelled otherwise (none without a normalizer).

    The distinct reads only the partition column, no column of the files."""
    if spec.partition_normalizer is None:
        return []
    key = F.col(spec.partition_key)
    normal = spec.partition_normalizer(key)
    other = partition_values(current, spec.partition_key).where(key != normal)
    return [r[0] for r in other.where(touched_predicate(normal, touched)).collect()]


def survivors(existing: DataFrame, delta: DataFrame, primary_key: Sequence[str],
              broadcast_bytes: int = DEFAULT_BROADCAST_KEYS_BYTES, buckets: int = 0) -> DataFrame:
    """Existing rows whose key the delta does not carry: one left anti join, one scan of ``existing``.

    The side it is joined with is the distinct non-null delta keys.  A key set
    counted small (at most ``broadcast_bytes`` in memory and 2,000,000 rows) is broadcast, so ``existing`` (the
    touched partitions, possibly most of the table) is not shuffled at all, null keys included, which match
    nothing.  With a larger one ``existing`` is shuffled by its keys, and adaptive execution splits skewed
    parts of it.  Rows with a null key would all hash into one task there; they get a number of
    their reading task as a further key, which no delta key has, and so spread.  ``buckets`` says that
    ``existing`` is bucketed by ``primary_key`` into so many: only the delta's keys are shuffled then, to its buckets.
    """
    pk = list(primary_key)
    key_rows = delta.select(*pk).where(all_not_null(pk))
    keys = key_rows.distinct()
    if fits_broadcast(key_rows, broadcast_bytes):
        return existing.join(F.broadcast(keys), pk, "left_anti")
    if buckets:
        return existing.join(key_rows.repartition(buckets, *pk).distinct(), pk, "left_anti")
    spread = F.when(any_null(pk), F.lit(1) + F.spark_partition_id()).otherwise(F.lit(0))
    return existing.withColumn(_SPREAD, spread) \
        .join(keys.withColumn(_SPREAD, F.lit(0)), [*pk, _SPREAD], "left_anti").drop(_SPREAD)


def merge_union(delta: DataFrame, kept: DataFrame) -> DataFrame:
    """Delta rows plus surviving rows, matched by column name."""
    return delta.unionByName(kept)


def merged_partitions(current: DataFrame, delta: DataFrame, spec: TableSpec, spellings: Sequence | None = None) -> DataFrame:
    """New content of every partition the delta touches: delta wins by key.

    The delta is not deduplicated (call ``latest_per_key`` first if needed);
    keys that moved out of an untouched partition keep their old row there.
    With a normalizer, partitions of ``current`` that are other spellings of a
    touched value (``spellings``, looked up if not given) are merged too; their
    survivors stay where they are.
    """
    touched = collect_touched(delta, spec.partition_key)
    others = stored_spellings(current, spec, touched) if spellings is None else list(spellings)
    existing = current.where(touched_predicate(F.col(spec.partition_key), touched + others))
    return merge_union(delta, survivors(existing, delta, spec.primary_key))

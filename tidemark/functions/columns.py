"""Projections: all single ``select``/``withColumn`` steps, resolved by name."""

from __future__ import annotations

from datetime import datetime, timezone
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def prefixed_projection(df: DataFrame, prefix: str, columns: Iterable[str] | None = None) -> DataFrame:
    """``c AS <prefix>_c`` for every listed column (all columns by default).

    Columns not listed drop out; a listed column that is missing fails at analysis.
    """
    cols = list(df.columns if columns is None else columns)
    return df.select(*[F.col(c).alias(f"{prefix}_{c}") for c in cols])


def rename_positional(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Rename every column by position in one step (no clash between steps)."""
    names = list(names)
    if len(names) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns but {len(names)} names")
    return df.toDF(*names)


def load_ts_literal(load_ts: datetime | str | None = None) -> Column:
    """One load instant per run as a ``TIMESTAMP_NTZ`` literal (UTC wall clock).

    ``None`` takes the driver's clock once, so every sink of a run stores the
    same value (unlike ``current_timestamp()`` evaluated per query).
    """
    if load_ts is None:
        load_ts = datetime.now(timezone.utc).replace(tzinfo=None)
    if isinstance(load_ts, datetime):
        if load_ts.tzinfo is not None:
            load_ts = load_ts.astimezone(timezone.utc).replace(tzinfo=None)
        load_ts = load_ts.isoformat(sep=" ")
    return F.lit(load_ts).cast("timestamp_ntz")


def with_load_ts(df: DataFrame, name: str = "load_ts", load_ts: datetime | str | Column | None = None) -> DataFrame:
    value = load_ts if isinstance(load_ts, Column) else load_ts_literal(load_ts)
    return df.withColumn(name, value)


def with_partition_copy(df: DataFrame, key: str, suffix: str = "__temp") -> DataFrame:
    """Copy ``key`` as ``key+suffix`` and place the copy right after it."""
    cols: list[Column] = []
    for c in df.columns:
        cols.append(F.col(c))
        if c == key:
            cols.append(F.col(c).alias(key + suffix))
    return df.select(*cols)


def reorder_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select(*columns)


def rename_column(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*columns)


def align_to_schema(rows: DataFrame, schema: StructType) -> DataFrame:
    """``rows`` in the columns, order and types of ``schema``, matched by name;
    a column it lacks (e.g. a version column only the history feed has) is a
    typed null.  A column ``schema`` has no place for is an error."""
    names = {c.lower() for c in rows.columns}
    extra = sorted(names - {f.name.lower() for f in schema.fields})
    if extra:
        raise ValueError(f"the table has no columns {extra}")
    return rows.select(*[
        (F.col(f.name) if f.name.lower() in names else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def refuse_lossy(rows: DataFrame, schema: StructType) -> None:
    """Raise if a value of ``rows`` would change when cast to the types of ``schema``.

    Looks at the data only where a column's type differs (one aggregate, one row back)."""
    stored = {f.name.lower(): f.dataType for f in schema.fields}
    changed = {}
    for f in rows.schema.fields:
        kind = stored.get(f.name.lower())
        if kind is not None and kind != f.dataType:
            there = F.col(f"`{f.name}`").try_cast(kind)
            changed[f.name] = F.count(F.when(~there.try_cast(f.dataType).eqNullSafe(F.col(f"`{f.name}`")), 1)).alias(f.name)
    if changed:
        lost = {k: n for k, n in rows.agg(*changed.values()).first().asDict().items() if n}
        if lost:
            raise ValueError(f"the stored types cannot hold all values of {sorted(lost)}: {lost} rows would change")

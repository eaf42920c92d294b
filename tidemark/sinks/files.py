"""K1 partitioned overwrite, K2 archive append, K3 JSON sink, K4 partition swap."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import align_to_schema
from tidemark.sources.files import overwrite_mode


def _layout(df: DataFrame, key: str, rebalance: bool) -> DataFrame:
    """Group rows of one partition value into few tasks before writing.

    ``REBALANCE(key)`` hashes by the partition column, and adaptive execution
    then splits a skewed value over several tasks and merges small ones, so a
    hot partition value gets several right-sized files instead of one huge
    task (or, with round-robin, one file per task in every directory).
    """
    return df.hint("rebalance", key) if rebalance else df


def write_partitioned(df: DataFrame, path: str, key: str, mode: str = "overwrite",
                      fmt: str = "parquet", rebalance: bool = True) -> None:
    """Write ``df`` as a Hive-style table partitioned by ``key``.

    ``mode='overwrite'`` replaces the whole target (initial load);
    ``mode='append'`` adds files (archive snapshots).
    """
    _layout(df, key, rebalance).write.format(fmt).mode(mode).partitionBy(key).save(path)


def swap_partitions(df: DataFrame, path: str, key: str, fmt: str = "parquet", rebalance: bool = True) -> None:
    """Replace exactly the partitions ``df`` has rows for; leave the rest untouched.

    Dynamic partition overwrite: files are staged by the output committer and
    each written partition directory is replaced at job commit.  The mode is
    set on the write itself (never rely on the session default: a static
    overwrite of a table that is also being read deletes it first).
    """
    (
        _layout(df, key, rebalance)
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(key)
        .save(path)
    )


def empty_partitions(current: DataFrame, key: str, values: Sequence[str], fmt: str = "parquet") -> None:
    """Leave no row in the partitions ``values`` of the table that ``current`` reads.

    A dynamic overwrite cannot do that: it replaces only partitions it has rows
    for.  Each folder is overwritten by an empty file instead; its name comes from the files
    in it, so Spark's own escaping applies.  One small write per value.
    """
    if not values:
        return
    names = current.where(F.col(key).isin(list(values))).select(F.col("_metadata.file_path").alias("f")).distinct()
    nothing = current.sparkSession.createDataFrame([], current.drop(key).schema)
    for (folder,) in names.select(F.regexp_replace("f", "/[^/]*$", "")).distinct().collect():
        nothing.write.format(fmt).mode("overwrite").save(unquote(folder))


def write_json(df: DataFrame, path: str, mode: str = "append") -> None:
    """Line-delimited JSON files."""
    df.write.mode(mode).json(path)


def insert_partitions(df: DataFrame, table: str, key: str, overwrite: bool = False, rebalance: bool = True) -> None:
    """Write ``df`` into the partitioned catalog table ``table``.

    Columns are matched by name (``insertInto`` itself is positional); a
    table column ``df`` lacks is written as null.  An append adds files and
    registers new partitions; ``overwrite`` replaces exactly the partitions
    ``df`` has rows for and is refused unless the table
    overwrites dynamically (see :func:`tidemark.sources.create_table`) and is
    partitioned by ``key``: otherwise it would delete every other partition,
    or the whole table.
    """
    spark = df.sparkSession
    if overwrite:
        if overwrite_mode(spark, table) != "dynamic":
            raise ValueError(f"{table} does not overwrite partitions dynamically; create it with create_table")
        partitions = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
        if key not in partitions:  # unpartitioned, an overwrite would replace the whole table
            raise ValueError(f"{table} is partitioned by {partitions}, not by {key}")
    ordered = align_to_schema(df, spark.table(table).schema)
    _layout(ordered, key, rebalance).write.insertInto(table, overwrite=overwrite)

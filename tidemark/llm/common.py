"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from tidemark.session import scratch_path

#: A word: a run of anything but ASCII white space (used by several contracts).
WORD = r"[^\x20\x09-\x0D]+"

#: A table is broadcast only if its measured rows stay below this (narrow rows, tens of MB at most).
BROADCAST_ROWS = 200_000

#: A key is frequent from this many rows on, and from a share of all rows that at most ``HOT_KEYS`` keys can have.
HOT_ROWS, HOT_KEYS = 1000, 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: the lineage
    is cut and every later use sees the same rows, also after a lost executor."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the scratch folders of :func:`materialize` tables that nothing reads any more."""
    for df in tables:
        jvm = df.sparkSession._jvm
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a materialized, narrow table) marked for broadcast if it has at most ``rows`` rows."""
    return F.broadcast(df) if df.count() <= rows else df


def join_by_count(left: DataFrame, right: DataFrame, key: str, rows: str, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` on ``key``, which no frequent key can pile up in one task.

    ``right`` is a materialized table of one row per key; its column ``rows``
    counts the key's rows of ``left``.  Frequent keys (at most ``HOT_KEYS``) are
    broadcast and their rows stay where they are; all others are shuffled."""
    total, most = right.agg(F.sum(rows), F.max(rows)).first()
    limit = max(HOT_ROWS, (total or 0) // HOT_KEYS)
    if (most or 0) <= limit:
        return left.join(right, key, how)
    frequent = F.broadcast(right.where(F.col(rows) > limit))
    others = left.join(frequent.select(key), key, "left_anti").join(right.where(F.col(rows) <= limit), key, how)
    return left.join(frequent, key).unionByName(others)


def row_key(*columns: str) -> Column:
    """MD5 over the named columns as text; null differs from every text.

    Equal rows get equal keys: results per key are right for repeated rows."""
    parts = [F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in columns]
    return F.md5(F.concat_ws("\x01", *parts).cast("binary"))


def keep_columns(df: DataFrame, produced: list[str]) -> DataFrame:
    """``df`` without columns that an operator is about to produce (clashing extra columns are replaced)."""
    taken = {c.lower() for c in produced}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def chunks(texts, max_chars: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``max_chars`` characters (at least one row each)."""
    start, total = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t is not None else 0
        if i > start and total + n > max_chars:
            yield start, i
            start, total = i, 0
        total += n
    if len(texts) > start:
        yield start, len(texts)


def add_computed(df: DataFrame, inputs: Sequence[str], fields: Sequence[StructField], make: Callable[[], Callable],
                 drop: Sequence[str] = ()) -> DataFrame:
    """``df`` without ``drop`` plus ``fields``, computed in Python from the ``inputs`` columns.

    ``make`` runs once per task and returns a function from lists of input values
    (a few million characters at a time) to one list per field.  The other columns stay in their Arrow
    batches, so any type passes through unchanged, large integers beside nulls included."""
    at = [df.columns.index(c) for c in inputs]
    stay = [i for i, c in enumerate(df.columns) if c not in drop]
    types = [to_arrow_type(f.dataType) for f in fields]
    out = StructType([df.schema.fields[i] for i in stay] + list(fields))
    schema = StructType([StructField(f"c{i}", f.dataType) for i, f in enumerate(out)])  # mapInArrow takes no dotted names
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            values = [batch.column(i).to_pylist() for i in at]
            for a, b in chunks(values[0]):
                new = compute(*[v[a:b] for v in values])
                kept = [batch.column(i).slice(a, b - a) for i in stay]
                yield pa.RecordBatch.from_arrays(kept + [pa.array(v, type=t) for v, t in zip(new, types)], names=names)

    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(run, schema).toDF(*out.fieldNames())


def packed(docs: DataFrame, *used: str) -> DataFrame:
    """The ``used`` columns and all others in one struct ``_rest``: no name of theirs can clash with a helper column."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in used]
    return docs.select(*used, F.struct(*(others or [F.lit(0).alias("none")])).alias("_rest"))


def unpacked(rows: DataFrame, columns: Sequence[str], **own: Column) -> DataFrame:
    """The ``columns`` of :func:`packed` rows in order, ``own`` expressions in place of those they name."""
    rest = set(rows.schema["_rest"].dataType.fieldNames())
    return rows.select(*[own.get(c, F.col(f"_rest.`{c}`" if c in rest else c)).alias(c) for c in columns])

"""S1 file scan, S2 partition-subset scan, S3 catalog scan."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from tidemark.operators.merge import touched_predicate


def require_format(spark: SparkSession, fmt: str) -> None:
    """Raise a ``ValueError`` that says what to do if the session cannot read ``fmt``.

    Jobs call it before they touch anything: a format whose package is missing (Avro without spark-avro
    on the class path) must not be found out after an overwrite has begun."""
    try:
        spark.read.format(fmt).schema("a int").load([])
    except Exception as exc:  # an AnalysisException or, from a class path look-up, a Py4J error
        text = str(exc)
        if "Failed to find data source" in text or "DATA_SOURCE_NOT_FOUND" in text:
            hint = "start Spark with --packages org.apache.spark:spark-avro_<scala>:<spark version>" if fmt.lower() == "avro" \
                else "put the package that brings it on Spark's class path"
            raise ValueError(f"this session cannot read the format {fmt!r}: {hint}") from exc


def scan(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet",
         schema: StructType | str | None = None, **options) -> DataFrame:
    """Read files of a format chosen at run time (parquet, orc, json, csv, avro
    when the spark-avro package is on the class path)."""
    require_format(spark, fmt)
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_table(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """Read a Hive-style partitioned table from its root with an explicit schema.

    Spark derives the partition column from the directory names and types it
    from ``schema`` (so ``zip=00601`` stays the string ``00601``); columns come
    back in ``schema`` order, resolved by name.  A table that does not exist yet
    reads as empty.
    """
    try:
        df = spark.read.format(fmt).schema(schema).load(path)
    except AnalysisException as exc:
        if not _missing_path(exc):
            raise
        return spark.createDataFrame([], schema)
    return df.select(*schema.fieldNames())


def stored_schema(spark: SparkSession, path: str, incoming: StructType, fmt: str = "parquet",
                  key: str | None = None) -> StructType:
    """Schema of the partitioned table at ``path`` as seen by rows arriving with ``incoming``.

    The ``incoming`` columns, followed by every column any stored file has beyond
    them; all must survive a rewrite of the rows that carry them, so the footers
    of all files are merged (a distributed job), not just one read.  Stored
    types win where files carry types (Parquet, ORC); the partition column
    ``key`` lives in folder names and keeps its incoming type, so ``00601`` stays a
    string.  A table that does not exist yet has just ``incoming``.  Callers that
    know the stored schema pass it instead.
    """
    typed = fmt.lower() in ("parquet", "orc")
    try:
        found = spark.read.format(fmt).options(**({"mergeSchema": "true"} if typed else {})).load(path).schema
    except AnalysisException as exc:
        if not _missing_path(exc):
            raise
        return incoming
    have = {f.name.lower() for f in incoming.fields}
    stored = {f.name.lower(): f.dataType for f in found.fields} if typed else {}
    stored.pop((key or "").lower(), None)
    fields = [StructField(f.name, stored.get(f.name.lower(), f.dataType)) for f in incoming.fields]
    return StructType(fields + [f for f in found.fields if f.name.lower() not in have])


def _missing_path(exc: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in (exc.getCondition() or "") or "Path does not exist" in str(exc)


def partition_subset_scan(spark: SparkSession, path: str, schema: StructType, key: str,
                          values: Sequence, fmt: str = "parquet") -> DataFrame:
    """Only the partitions whose ``key`` value is in ``values`` (null-safe).

    The predicate lands in the scan's ``PartitionFilters``: files of untouched
    directories are not read.  A folder read this way is still listed whole;
    a catalog table (:func:`create_table`) lists only the matching partitions.
    """
    from pyspark.sql import functions as F

    return read_table(spark, path, schema, fmt).where(touched_predicate(F.col(key), values))


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
                   persistent: bool = False, schema: StructType | None = None,
                   partition_key: str | None = None) -> None:
    """Name a file table in the catalog.

    By default a temporary view of this session.  With ``persistent`` an
    external table in the session's catalog (the metastore, where one is
    configured) over ``path``, created by :func:`create_table`.
    """
    if not persistent:
        reader = spark.read.format(fmt)
        if schema is not None:
            reader = reader.schema(schema)
        reader.load(path).createOrReplaceTempView(name)
        return
    if schema is None:
        raise ValueError("a persistent table needs an explicit schema")
    create_table(spark, name, path, schema, partition_key, fmt)


def create_table(spark: SparkSession, name: str, path: str, schema: StructType,
                 partition_key: str | Sequence[str] | None = None, fmt: str = "parquet", replace: bool = False,
                 bucket_by: Sequence[str] = (), buckets: int = 0) -> None:
    """An external table over ``path`` whose partitions the catalog tracks.

    Reads of such a table with a predicate on the partition column ask the
    catalog for the matching partitions and list only their directories.  The
    table stores ``partitionOverwriteMode=dynamic`` as its own option, so an
    overwriting insert replaces only the partitions it writes (``insertInto``
    ignores a writer option; only the table option or the session default
    count).  Partition directories already under ``path`` are registered.
    ``replace`` drops an existing definition first; only an external table at
    the same location may be replaced, so the files stay.
    ``bucket_by`` and ``buckets`` declare the bucket layout of its files; every insert then keeps to it.
    """
    if replace and spark.catalog.tableExists(name):
        if described(spark, name, "Type") != "EXTERNAL" or not _same_place(spark, described(spark, name, "Location"), path):
            raise ValueError(f"{name} exists and is not an external table at {path}; it is not replaced")
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    keys = [partition_key] if isinstance(partition_key, str) else list(partition_key or ())
    partitioned = f" PARTITIONED BY ({', '.join(f'`{k}`' for k in keys)})" if keys else ""
    if buckets:
        partitioned += f" CLUSTERED BY ({', '.join(f'`{c}`' for c in bucket_by)}) INTO {buckets} BUCKETS"
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt} "
              f"OPTIONS ('partitionOverwriteMode' = 'dynamic'){partitioned} LOCATION '{location}'")
    if partition_key:
        try:
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        except Exception as exc:  # a new, still empty table has no folder yet
            if "FileNotFoundException" not in str(exc):
                raise


def bucketing(spark: SparkSession, name: str) -> tuple[int, list[str]] | None:
    """Number of buckets and bucket columns of a catalog table, ``None`` if it has none."""
    count, columns = described(spark, name, "Num Buckets"), described(spark, name, "Bucket Columns")
    if not count or not columns or not int(count):
        return None
    return int(count), re.findall(r"`([^`]+)`", columns)


def _same_place(spark: SparkSession, location: str | None, path: str) -> bool:
    def full(p: str) -> str:
        place = spark._jvm.org.apache.hadoop.fs.Path(p)
        return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString().rstrip("/")

    return location is not None and full(location) == full(path)


def described(spark: SparkSession, name: str, what: str) -> str | None:
    """A property of a catalog table (``Type``, ``Provider``, ``Location``), ``None`` if it has none."""
    lines = [(r[0], r[1]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()]
    start = [i for i, (k, _) in enumerate(lines) if k.startswith("# Detailed Table Information")]
    return dict(lines[start[0]:]).get(what) if start else None


def overwrite_mode(spark: SparkSession, name: str) -> str:
    """``dynamic`` or ``static``: how an overwriting insert into ``name`` treats
    partitions it does not write (the table option, else the session default)."""
    props = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Storage Properties'").collect()
    found = re.search(r"partitionOverwriteMode=(\w+)", props[0][1] if props else "", re.IGNORECASE)
    mode = found.group(1) if found else spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    return mode.lower()


def catalog_scan(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table (or view) as a DataFrame."""
    return spark.table(name)

import os

import pytest

from conftest import SF01, rows
from tidemark.sinks import swap_partitions, write_json, write_partitioned
from tidemark.sources import catalog_scan, partition_subset_scan, read_table, register_table, scan


def test_partitioned_round_trip_keeps_types(spark, path):
    df = spark.createDataFrame([(1, "00601"), (2, "a/b: c"), (3, None)], "id long, zip string")
    p = path("zip")
    write_partitioned(df, p, "zip")
    back = read_table(spark, p, df.schema)
    assert back.columns == ["id", "zip"] and rows(back) == rows(df)


def test_append_and_swap(spark, path):
    schema = "id long, city string"
    p = path("swap")
    write_partitioned(spark.createDataFrame([(1, "A"), (2, "B")], schema), p, "city")
    write_partitioned(spark.createDataFrame([(3, "B")], schema), p, "city", mode="append")
    assert rows(read_table(spark, p, spark.createDataFrame([], schema).schema)) == [(1, "A"), (2, "B"), (3, "B")]
    swap_partitions(spark.createDataFrame([(9, "B")], schema), p, "city")
    assert rows(read_table(spark, p, spark.createDataFrame([], schema).schema)) == [(1, "A"), (9, "B")]


def test_subset_scan_prunes(spark, path):
    customer = spark.read.parquet(f"{SF01}/customer.parquet")
    p = path("seg")
    write_partitioned(customer, p, "c_mktsegment")
    sub = partition_subset_scan(spark, p, customer.schema, "c_mktsegment", ["BUILDING", None])
    text = sub._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "BUILDING" in text
    assert sub.count() == customer.where("c_mktsegment = 'BUILDING'").count()


def test_json_and_catalog(spark, path):
    nation = spark.read.parquet(f"{SF01}/nation.parquet")
    p = path("json")
    write_json(nation, p)
    assert rows(spark.read.schema(nation.schema).json(p)) == rows(nation)
    register_table(spark, "t_nation", f"{SF01}/nation.parquet")
    assert catalog_scan(spark, "t_nation").count() == 25
    assert scan(spark, f"{SF01}/nation.parquet", "parquet").count() == 25


def test_rebalanced_write_file_count(spark, path):
    customer = spark.read.parquet(f"{SF01}/customer.parquet").repartition(8)
    p = path("files")
    write_partitioned(customer, p, "c_mktsegment")
    for d in os.listdir(p.replace("file:", "")):
        if d.startswith("c_mktsegment="):
            files = [f for f in os.listdir(os.path.join(p.replace("file:", ""), d)) if f.endswith(".parquet")]
            assert len(files) <= 2, (d, files)


def test_hot_partition_value_is_split_across_files(spark, path):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    shares = {r[0]: r[1] for r in li.groupBy("l_returnflag").count().collect()}
    hot = max(shares, key=shares.get)
    assert shares[hot] > li.count() / 3
    src = path("hotsrc")
    li.repartition(8).write.parquet(src)  # eight map tasks: skew is split along map-task ranges
    li = spark.read.parquet(src)
    p = path("hotwrite")
    keys = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize"]
    old = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set(keys[0], "256k")
    spark.conf.set(keys[1], "64k")
    try:
        write_partitioned(li, p, "l_returnflag")
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    d = os.path.join(p.replace("file:", ""), f"l_returnflag={hot}")
    files = [f for f in os.listdir(d) if f.endswith(".parquet")]
    assert len(files) > 1, files
    assert read_table(spark, p, li.schema).count() == li.count()


def test_touched_partitions_match_exactly(spark, path):
    # names key1, key2, keyn, keym; touched key1, key2 -> exactly those two (no substring matching)
    df = spark.createDataFrame([(i, k) for i, k in enumerate(["key1", "key2", "keyn", "keym", "key10"])],
                               "id int, part string")
    p = path("match")
    write_partitioned(df, p, "part")
    got = partition_subset_scan(spark, p, df.schema, "part", ["key1", "key2"])
    assert sorted(r.part for r in got.collect()) == ["key1", "key2"]


def test_scan_formats_chosen_at_run_time(spark, path):
    nation = spark.read.parquet(f"{SF01}/nation.parquet")
    for fmt in ("json", "csv", "orc"):
        p = path(fmt)
        nation.write.format(fmt).option("header", "true").save(p)
        back = scan(spark, p, fmt, schema=nation.schema, header="true")
        assert rows(back) == rows(nation), fmt


def test_formats_the_session_cannot_read_are_refused(spark, path):
    from tidemark.sources import require_format

    for fmt in ("parquet", "orc", "json", "csv", "text"):
        require_format(spark, fmt)
    with pytest.raises(ValueError, match="spark-avro"):
        scan(spark, path("feed"), "avro")
    with pytest.raises(ValueError, match="'nonsense'"):
        require_format(spark, "nonsense")


def test_persistent_catalog_table(spark, path):
    customer = spark.read.parquet(f"{SF01}/customer.parquet")
    p = path("ext")
    write_partitioned(customer, p, "c_mktsegment")
    register_table(spark, "tidemark_test_customer", p, persistent=True, schema=customer.schema,
                   partition_key="c_mktsegment")
    got = catalog_scan(spark, "tidemark_test_customer")
    assert rows(got, *customer.columns) == rows(customer)
    pruned = got.where("c_mktsegment = 'BUILDING'")
    assert "PartitionFilters: [" in pruned._jdf.queryExecution().executedPlan().toString()
    spark.sql("DROP TABLE tidemark_test_customer")


@pytest.mark.parametrize("adaptive_cache", ["true", "false"])
def test_merge_splits_hot_partition_value(spark, path, adaptive_cache):
    """Laid out once inside the cache (adaptive cached plans) or by each write: a hot value is split either way."""
    from pyspark.sql import functions as F

    from tidemark.plans import incremental_merge, initial_load
    from tidemark.spec import TableSpec

    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    shares = {r[0]: r[1] for r in li.groupBy("l_returnflag").count().collect()}
    hot = max(shares, key=shares.get)
    src = path("hotsrc")
    li.repartition(8).write.parquet(src)
    li = spark.read.parquet(src)
    spec = TableSpec(("l_orderkey", "l_linenumber"), ("l_shipdate", "l_partkey", "l_suppkey"), "l_returnflag")
    cur, arc = path("hotcur"), path("hotarc")
    keys = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize",
            "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"]
    old = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set(keys[0], "256k")
    spark.conf.set(keys[1], "64k")
    spark.conf.set(keys[2], adaptive_cache)
    try:
        initial_load(li, spec, cur, arc, load_ts="2024-01-01 00:00:00")
        delta = li.where(F.col("l_returnflag") == hot).withColumn("l_quantity", F.col("l_quantity") + 1)
        incremental_merge(spark, delta, spec, cur, arc, load_ts="2024-01-31 00:00:00")
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    for root in (cur, arc):
        d = os.path.join(root.replace("file:", ""), f"l_returnflag={hot}")
        assert len([f for f in os.listdir(d) if f.endswith(".parquet")]) > 2, root
    stored = li.schema.add("load_ts", "timestamp_ntz")
    assert read_table(spark, cur, stored).where(F.col("l_returnflag") == hot).count() == shares[hot]
    assert read_table(spark, arc, stored).count() == li.count() + shares[hot]

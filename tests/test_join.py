import pytest
from pyspark.errors import ArithmeticException

from conftest import SF01, rows
from tidemark.operators import version_increment, version_join


def test_fan_out_nulls_and_unmatched(spark):
    daily = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id int, name string")
    archive = spark.createDataFrame([(1, "d1", 1), (1, "d2", 2), (3, "d3", 7)], "s_id int, s_date string, version int")
    out = version_increment(daily, archive, "id", "s_id", drop=["s_id", "s_date"])
    assert out.columns == ["id", "name", "version", "inc_version"]
    assert rows(out) == sorted([(1, "a", 1, 2), (1, "a", 2, 3), (2, "b", None, 1), (None, "c", None, 1)], key=repr)


def test_overflow_raises(spark):
    daily = spark.createDataFrame([(1,)], "id int")
    archive = spark.createDataFrame([(1, 2147483647)], "s_id int, version int")
    if spark.conf.get("spark.sql.ansi.enabled") == "true":
        with pytest.raises(ArithmeticException):
            version_increment(daily, archive, "id", "s_id").collect()


def test_name_clash_rejected(spark):
    a = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(ValueError):
        version_join(a, a, "id", "id")


def test_salted_hot_keys_equal_plain_join(spark):
    customer = spark.read.parquet(f"{SF01}/customer.parquet")
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    plain = version_join(customer, orders, "c_custkey", "o_custkey", hot_key_rows=10**9)
    salted = version_join(customer, orders, "c_custkey", "o_custkey", hot_key_rows=8, max_hot_keys=300)
    assert salted.count() == plain.count() == 15000 + customer.join(orders, customer.c_custkey == orders.o_custkey,
                                                                     "left_anti").count()
    assert rows(salted) == rows(plain)


def test_salted_with_duplicated_rows_and_left_copies(spark):
    left = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "n")], "k int, tag string")
    right = spark.createDataFrame([(1, 5)] * 40 + [(1, 6)] * 3 + [(2, 1), (None, 9)], "rk int, v int")
    got = version_join(left, right, "k", "rk", hot_key_rows=5)
    expect = [(1, t, 1, v) for t in ("x", "y") for v in [5] * 40 + [6] * 3] + [(2, "z", 2, 1), (None, "n", None, None)]
    assert rows(got) == sorted(expect, key=repr)


def test_archive_prefilter_broadcasts_small_key_set(spark, path):
    from conftest import plan_text

    p = path("daily")
    spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "id bigint, v string").write.parquet(p)
    left = spark.read.parquet(p)
    right = spark.createDataFrame([(1, 10), (1, 11), (3, 30)], "s_id bigint, version int")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # more rows than hot_key_rows: semi-join pre-filter, then hot-key check
        out = version_join(left, right, "id", "s_id", hot_key_rows=2)
        assert "BroadcastHashJoin" in plan_text(out) and "LeftSemi" in plan_text(out)
        assert rows(out) == sorted([(1, "a", 1, 10), (1, "a", 1, 11), (2, "b", None, None), (None, "n", None, None)],
                                   key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_copies_of_one_archive_row_spread_over_salts(spark):
    from pyspark.sql import functions as F

    from tidemark.operators.join import row_salt

    copies = spark.range(0, 400, 1, 4).select(F.lit(1).alias("s_id"), F.lit(7).alias("version"))
    salts = copies.select(row_salt(["s_id", "version"], F.lit(10)).alias("s")).distinct().collect()
    assert len(salts) > 1 and all(0 <= r.s < 10 for r in salts)
    left = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    out = version_join(left, copies, "id", "s_id", hot_key_rows=40)
    assert out.where("id = 1").count() == 400 and out.where("id = 2 and s_id is null").count() == 1


def test_broadcast_by_counted_rows_and_bytes(spark, path):
    from conftest import plan_text
    from pyspark.sql import functions as F

    from tidemark.operators.keys import broadcast_if_small, measured_bytes

    p = path("keys")
    spark.range(100).write.parquet(p)
    keys = spark.read.parquet(p)
    assert measured_bytes(keys) == (100, 100 * 48)
    assert measured_bytes(keys.where("id < 0")) == (0, 0)
    big = spark.range(10**6).select((F.col("id") % 7).alias("id"))
    joined = lambda k: big.join(k, "id", "left_semi")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan_text(joined(broadcast_if_small(keys)))
        assert "BroadcastHashJoin" in plan_text(joined(broadcast_if_small(keys.distinct(), rows_of=keys)))
        assert "BroadcastHashJoin" not in plan_text(joined(broadcast_if_small(keys, max_rows=99)))  # 100 rows
        assert "BroadcastHashJoin" not in plan_text(joined(broadcast_if_small(keys, max_bytes=10)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_long_keys_in_a_small_file_are_not_broadcast(spark, path):
    """Bytes are counted in memory: Parquet stores these keys in a fraction of them."""
    import os

    from conftest import plan_text
    from pyspark.sql import functions as F

    from tidemark.operators.keys import broadcast_if_small, measured_bytes

    p = path("long")
    spark.range(2000).select(F.concat(F.repeat(F.lit("x"), 4000), F.col("id")).alias("k")).coalesce(1).write.parquet(p)
    keys = spark.read.parquet(p)
    stored = sum(os.path.getsize(os.path.join(p.removeprefix("file:"), f)) for f in os.listdir(p.removeprefix("file:")))
    assert measured_bytes(keys)[1] > 8_000_000 > 4 * stored
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        limited = broadcast_if_small(keys, max_bytes=4_000_000)
        assert "BroadcastHashJoin" not in plan_text(keys.join(limited, "k", "left_semi"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_one_key_in_a_small_file_is_split(spark, path):
    """A key repeated in a tiny file is found by its rows, whatever the file's size."""
    from pyspark.sql import functions as F

    from tidemark.operators.keys import hot_keys

    p = path("one")
    spark.range(300_000).select(F.lit(7).alias("k")).write.parquet(p)
    _, found = hot_keys(spark.read.parquet(p), ["k"], hot_key_rows=100_000)
    assert [r["k"] for r in found] == [7] and 250_000 < found[0]["_n"] < 350_000


def _passes(spark, rows, schema, run):
    """How often ``run`` reads the rows of a table of its own."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.createDataFrame(rows, schema).repartition(3)
    run(df.mapInArrow(count, df.schema))
    return seen.value / len(rows)


def test_detection_reads_the_archive_once(spark):
    """Counting, hot keys and their number come from one pass; the rest is what the join itself reads."""
    left = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    right = [(1, i) for i in range(50)] + [(k, 0) for k in range(2, 30)]
    def join(**options):  # noqa: E306
        return lambda r: version_join(left, r, "id", "s_id", **options).write.format("noop").mode("overwrite").save()

    assert _passes(spark, right, "s_id bigint, version int", join()) == 2  # census, join
    assert _passes(spark, right, "s_id bigint, version int", join(hot_key_rows=60)) == 2  # cut to the daily keys, none hot
    assert _passes(spark, right, "s_id bigint, version int", join(hot_key_rows=20)) == 3  # census, cold part, hot part


def test_census_is_exact_in_rows_and_finds_all_hot_keys(spark):
    from pyspark.sql import functions as F

    from tidemark.operators.keys import key_census

    df = spark.range(0, 500_000, 1, 6).select(F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.lit(None))
                                              .otherwise(F.col("id")).alias("k"))
    rows_, found = key_census(df, ["k"], hot_key_rows=100_000)
    assert rows_ == 500_000 and {r["k"] for r in found} == {7, None} and all(150_000 < r["_n"] < 185_000 for r in found)
    assert [r["k"] for r in key_census(df, ["k"], 100_000, include_null=False)[1]] == [7]
    assert key_census(df.where("false"), ["k"]) == (0, [])

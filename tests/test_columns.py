from datetime import datetime

import pytest
from pyspark.errors import ArithmeticException

from tidemark.functions import (
    drop_columns,
    load_ts_literal,
    next_version,
    prefixed_projection,
    rename_column,
    rename_positional,
    reorder_columns,
    title_case,
    with_load_ts,
    with_partition_copy,
)


def test_prefixed_projection_drops_unlisted_and_fails_on_missing(spark):
    df = spark.createDataFrame([(1, 2, 3)], "abc int, xyz int, other int")
    out = prefixed_projection(df, "tbl", ["abc", "xyz"])
    assert out.columns == ["tbl_abc", "tbl_xyz"]
    assert prefixed_projection(df, "p").columns == ["p_abc", "p_xyz", "p_other"]
    with pytest.raises(Exception):
        prefixed_projection(df, "tbl", ["abc", "missing"]).columns


def test_positional_rename_is_atomic(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    # swapping names would collide if done one rename at a time
    out = rename_positional(df, ["b", "a"])
    assert out.columns == ["b", "a"] and out.first() == (1, 2)
    with pytest.raises(ValueError):
        rename_positional(df, ["x"])


def test_partition_copy_sits_after_key(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "id int, city string, v double")
    out = with_partition_copy(df, "city")
    assert out.columns == ["id", "city", "city__temp", "v"]
    assert out.first()["city__temp"] == "x"


def test_reorder_rename_drop(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "id int, city string, v double")
    assert reorder_columns(df, ["v", "id"]).columns == ["v", "id"]
    assert rename_column(df, {"city": "town"}).columns == ["id", "town", "v"]
    assert drop_columns(df, ["city", "v"]).columns == ["id"]


def test_load_ts_is_one_instant(spark):
    df = spark.range(3)
    out = with_load_ts(df, "load_ts", "2024-01-31 00:00:00")
    assert {r.load_ts for r in out.collect()} == {datetime(2024, 1, 31)}
    assert dict(out.dtypes)["load_ts"] == "timestamp_ntz"
    lit = load_ts_literal(None)
    a = spark.range(2).select(lit.alias("t")).collect()
    b = spark.range(2).select(lit.alias("t")).collect()
    assert a == b  # the same literal in two queries


PROBES = ["o'fallon", "SAN JUAN", "san-juan", "a/b: c", "3rd street", "élan vital", "", "two  spaces",
          "mcdonald's", "x.y.z", "ÅNGSTRÖM", "00601"]


def test_title_case_matches_python(spark):
    df = spark.createDataFrame([(s,) for s in PROBES] + [(None,)], "s string")
    got = {r.s: r.t for r in df.select("s", title_case("s").alias("t")).collect()}
    for s in PROBES:
        assert got[s] == s.title(), s
    assert got[None] is None


def test_next_version(spark):
    df = spark.createDataFrame([(None,), (0,), (41,)], "version int")
    assert [r.v for r in df.select(next_version("version").alias("v")).collect()] == [1, 1, 42]
    assert dict(df.select(next_version("version").alias("v")).dtypes)["v"] == "int"


def test_next_version_overflow_raises_under_ansi(spark):
    df = spark.createDataFrame([(2147483647,)], "version int")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    try:
        with pytest.raises(ArithmeticException):
            df.select(next_version("version")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_title_case_of_unusual_cased_characters(spark):
    values = ["Ⅷabc", "ⓐbc", "ʰello", "ᴬa", "İstanbul", "x\u0345y"]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    assert [r.t for r in df.select(title_case("s").alias("t")).collect()] == [v.title() for v in values]


def test_title_case_property(spark):
    from hypothesis import given, settings, strategies as st

    alphabet = st.sampled_from(list("abcXYZ éÉßĳǅ中文 '-.3_,/:") + ["İ"])
    texts = st.lists(st.text(alphabet=alphabet, max_size=12), min_size=1, max_size=40)

    @settings(max_examples=15, deadline=None)
    @given(texts)
    def check(values):
        df = spark.createDataFrame([(v,) for v in values], "s string")
        got = [r.t for r in df.select(title_case("s").alias("t")).collect()]
        assert got == [v.title() for v in values]

    check()

import os
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan_text, rows
from tidemark.operators import merged_partitions, survivors
from tidemark.plans import incremental_merge, initial_load
from tidemark.sources import read_table
from tidemark.spec import TableSpec

SPEC = TableSpec(("id",), ("version",), "city")
SCHEMA = "id bigint, name string, version int, city string"
STORED = SCHEMA + ", load_ts timestamp_ntz"
T0, T1, T2 = "2024-01-01 00:00:00", "2024-01-31 00:00:00", "2024-02-28 00:00:00"


def _load(spark, path, data):
    cur, arc = path("cur"), path("arc")
    initial_load(spark.createDataFrame(data, SCHEMA), SPEC, cur, arc, load_ts=T0)
    return cur, arc


def _current(spark, cur):
    from pyspark.sql.types import _parse_datatype_string

    return read_table(spark, cur, _parse_datatype_string(STORED))


def _files(root):
    out = {}
    for d, _, fs in os.walk(root.replace("file:", "")):
        for f in fs:
            if f.endswith(".parquet"):
                p = os.path.join(d, f)
                out[p] = os.stat(p).st_mtime_ns
    return out


HISTORY = [
    (1, "a1", 1, "Adjuntas"), (1, "a2", 2, "Adjuntas"),
    (2, "b1", 1, "Adjuntas"),
    (3, "c1", 1, "Aguada"),
    (4, "d1", 1, "Ponce"),
    (5, "e1", 1, None),
    (6, "f1", 1, ""),
    (None, "n1", 1, "Aguada"),
]


def test_initial_load(spark, path):
    cur, arc = _load(spark, path, HISTORY)
    got = rows(_current(spark, cur), "id", "name", "city")
    assert got == sorted([(1, "a2", "Adjuntas"), (2, "b1", "Adjuntas"), (3, "c1", "Aguada"), (4, "d1", "Ponce"),
                          (5, "e1", None), (6, "f1", None), (None, "n1", "Aguada")], key=repr)
    assert spark.read.schema(STORED).parquet(arc).count() == len(HISTORY)


def test_merge_replaces_only_touched_partitions(spark, path):
    cur, arc = _load(spark, path, HISTORY)
    before = _files(cur)
    delta = spark.createDataFrame([(2, "b2", 2, "Adjuntas"), (7, "g1", 1, "Mayaguez")], SCHEMA)
    incremental_merge(spark, delta, SPEC, cur, arc, load_ts=T1)
    after = _files(cur)
    got = rows(_current(spark, cur), "id", "name", "city", "load_ts")
    t0, t1 = datetime(2024, 1, 1), datetime(2024, 1, 31)
    assert got == sorted([(1, "a2", "Adjuntas", t0), (2, "b2", "Adjuntas", t1), (3, "c1", "Aguada", t0),
                          (4, "d1", "Ponce", t0), (5, "e1", None, t0), (6, "f1", None, t0),
                          (None, "n1", "Aguada", t0), (7, "g1", "Mayaguez", t1)], key=repr)
    # untouched partitions keep the very same files
    for p, m in before.items():
        if "city=Adjuntas" not in p:
            assert after.get(p) == m, p
    # archive got the full merged content of the touched partitions (2 + 1 rows)
    assert spark.read.schema(STORED).parquet(arc).count() == len(HISTORY) + 3


def test_null_and_blank_partitions_and_null_keys(spark, path):
    cur, arc = _load(spark, path, HISTORY)
    delta = spark.createDataFrame([(5, "e2", 2, ""), (None, "n2", 2, "Aguada")], SCHEMA)
    incremental_merge(spark, delta, SPEC, cur, None, load_ts=T1)
    got = rows(_current(spark, cur), "id", "name", "city")
    # '' and null are one partition; a null key matches nothing on either side
    assert got == sorted([(1, "a2", "Adjuntas"), (2, "b1", "Adjuntas"), (3, "c1", "Aguada"), (4, "d1", "Ponce"),
                          (5, "e2", None), (6, "f1", None), (None, "n1", "Aguada"), (None, "n2", "Aguada")],
                         key=repr)


def test_key_moving_between_partitions(spark, path):
    cur, _ = _load(spark, path, HISTORY)
    # 3 moves Aguada -> Ponce (both touched): old row gone; 4 moves Ponce -> Aguada
    delta = spark.createDataFrame([(3, "c2", 2, "Ponce"), (4, "d2", 2, "Aguada")], SCHEMA)
    incremental_merge(spark, delta, SPEC, cur, None, load_ts=T1)
    got = rows(_current(spark, cur).where("id in (3, 4)"), "id", "name", "city")
    assert got == [(3, "c2", "Ponce"), (4, "d2", "Aguada")]
    # 1 moves Adjuntas -> Ponce while Adjuntas is untouched: old row stays (documented)
    incremental_merge(spark, spark.createDataFrame([(1, "a3", 3, "Ponce")], SCHEMA), SPEC, cur, None, load_ts=T2)
    got = rows(_current(spark, cur).where("id = 1"), "id", "name", "city")
    assert got == [(1, "a2", "Adjuntas"), (1, "a3", "Ponce")]


def test_awkward_partition_values(spark, path):
    data = [(1, "x", 1, "00601"), (2, "y", 1, "a/b: c"), (3, "z", 1, "O'fallon"), (4, "w", 1, "SAN JUAN"),
            (5, "v", 1, "San Juan")]
    cur, _ = _load(spark, path, data)
    delta = spark.createDataFrame([(1, "x2", 2, "00601"), (2, "y2", 2, "a/b: c"), (4, "w2", 2, "SAN JUAN")], SCHEMA)
    incremental_merge(spark, delta, SPEC, cur, None, load_ts=T1)
    got = rows(_current(spark, cur), "id", "name", "city")
    assert got == sorted([(1, "x2", "00601"), (2, "y2", "a/b: c"), (3, "z", "O'fallon"), (4, "w2", "SAN JUAN"),
                          (5, "v", "San Juan")], key=repr)


def test_rerun_same_load_ts_is_stable(spark, path):
    cur, arc = _load(spark, path, HISTORY)
    delta = spark.createDataFrame([(2, "b2", 2, "Adjuntas")], SCHEMA)
    incremental_merge(spark, delta, SPEC, cur, arc, load_ts=T1)
    first = rows(_current(spark, cur))
    incremental_merge(spark, delta, SPEC, cur, arc, load_ts=T1)
    assert rows(_current(spark, cur)) == first
    assert spark.read.schema(STORED).parquet(arc).count() == len(HISTORY) + 2 * 2


def test_first_run_on_missing_table(spark, path):
    cur = path("missing")
    delta = spark.createDataFrame([(1, "a", 1, "X"), (2, "b", 1, None)], SCHEMA)
    incremental_merge(spark, delta, SPEC, cur, None, load_ts=T1)
    assert rows(_current(spark, cur), "id", "city") == sorted([(1, "X"), (2, None)], key=repr)


def test_delta_not_deduplicated(spark, path):
    cur, _ = _load(spark, path, HISTORY)
    delta = spark.createDataFrame([(2, "b2", 2, "Adjuntas"), (2, "b3", 3, "Adjuntas")], SCHEMA)
    incremental_merge(spark, delta, SPEC, cur, None, load_ts=T1)
    assert rows(_current(spark, cur).where("id = 2"), "name") == [("b2",), ("b3",)]


def test_many_touched_values_stay_a_static_predicate(spark, path):
    from tidemark.functions import with_load_ts

    cur, _ = _load(spark, path, HISTORY)
    many = spark.range(100, 10_600).selectExpr("id", "'x' AS name", "1 AS version", "concat('c', id) AS city")
    delta = with_load_ts(many.union(spark.createDataFrame([(9, "q", 1, None)], SCHEMA)), "load_ts", T1)
    merged = merged_partitions(_current(spark, cur), delta, SPEC)
    assert merged.where("city IS NULL").count() == 3  # two stored rows and the new one
    spark.conf.set("spark.sql.maxMetadataStringLength", str(1 << 22))  # printed filters are cut at 100 characters
    try:
        text = plan_text(merged_partitions(_current(spark, cur), delta, SPEC))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "LeftAnti" in text
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", text)
    assert filters and all("isnull(city" in f and len(set(re.findall(r"\bc\d+\b", f))) == 10_500 for f in filters), text[:2000]


def test_stored_columns_survive_deltas_without_them(spark, path):
    """A column that only one partition's files have keeps its values."""
    cur, _ = _load(spark, path, [(1, "a", 1, "Adjuntas"), (2, "b", 1, "Adjuntas"), (3, "c", 1, "Ponce"), (4, "d", 1, "Ponce")])
    wide = spark.createDataFrame([(3, "c2", 2, "Ponce", "KEEP")], SCHEMA + ", x string")
    incremental_merge(spark, wide, SPEC, cur, None, load_ts=T1)
    incremental_merge(spark, spark.createDataFrame([(4, "d2", 2, "Ponce")], SCHEMA), SPEC, cur, None, load_ts=T2)
    got = spark.read.option("mergeSchema", "true").parquet(cur)
    assert rows(got, "id", "name", "x") == sorted(
        [(1, "a", None), (2, "b", None), (3, "c2", "KEEP"), (4, "d2", None)], key=repr)


def test_stored_types_win(spark, path):
    stored = "id bigint, price decimal(18,2), n int, city string"
    cur = path("types")
    spec = TableSpec(("id",), ("n",), "city")
    initial_load(spark.createDataFrame([(1, None, 1, "A"), (2, None, 1, "A")], stored), spec, cur, None, load_ts=T0)
    delta = spark.createDataFrame([(1, 2.5, 7, "A")], "id int, price double, n bigint, city string")
    incremental_merge(spark, delta, spec, cur, None, load_ts=T1)
    schema = spark.createDataFrame([], stored + ", load_ts timestamp_ntz").schema
    got = rows(read_table(spark, cur, schema), "id", "price", "n")
    assert [(r[0], str(r[1]), r[2]) for r in got] == [(1, "2.50", 7), (2, "None", 1)]
    too_big = spark.createDataFrame([(1, 2.5, 2**40, "A")], "id int, price double, n bigint, city string")
    with pytest.raises(ValueError, match="n"):
        incremental_merge(spark, too_big, spec, cur, None, load_ts=T2)


def test_survivors_keep_null_keys(spark):
    existing = spark.createDataFrame([(None, "n", 1, "A"), (1, "a", 1, "A"), (2, "b", 1, "A")], SCHEMA)
    delta = spark.createDataFrame([(None, "m", 2, "A"), (1, "a2", 2, "A")], SCHEMA)
    assert rows(survivors(existing, delta, ["id"]), "id") == sorted([(None,), (2,)], key=repr)


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "buckets": 4}])
def test_survivors_scan_the_touched_rows_once(spark, path, options):
    p, d = path("once"), path("once-delta")
    rows_ = [(None if i % 3 == 0 else i, f"n{i}", 1, "A") for i in range(300)]
    spark.createDataFrame(rows_, SCHEMA).repartition(7).write.parquet(p)
    spark.createDataFrame([(i, "d", 2, "A") for i in range(0, 200)] + [(None, "d", 2, "A")], SCHEMA).write.parquet(d)
    existing, delta = spark.read.parquet(p), spark.read.parquet(d)
    kept = survivors(existing, delta, ["id"], **options)
    assert plan_text(kept).count("FileScan parquet") == 2  # the existing rows and the delta's keys
    assert kept.columns == existing.columns
    assert rows(kept) == sorted((r for r in rows_ if r[0] is None or r[0] >= 200), key=repr)


def test_swap_uses_dynamic_overwrite(spark, path):
    # the session default is static; the write must still replace only touched partitions
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    cur, _ = _load(spark, path, HISTORY)
    incremental_merge(spark, spark.createDataFrame([(4, "d2", 2, "Ponce")], SCHEMA), SPEC, cur, None, load_ts=T1)
    assert _current(spark, cur).count() == 7
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_int_partition_and_composite_key(spark, path):
    spec = TableSpec(("a", "b"), ("v",), "zone")
    schema = "a int, b string, v int, zone int"
    stored = spark.createDataFrame([], schema + ", load_ts timestamp_ntz").schema
    cur = path("composite")
    history = [(1, "x", 1, 10), (1, "y", 1, 10), (2, None, 1, 10), (3, "z", 1, 20), (None, "w", 1, 10)]
    initial_load(spark.createDataFrame(history, schema), spec, cur, None, load_ts=T0)
    delta = [(1, "x", 2, 10), (2, None, 2, 10), (None, "w", 2, 10), (4, "q", 1, 30)]
    incremental_merge(spark, spark.createDataFrame(delta, schema), spec, cur, None, load_ts=T1)
    got = rows(read_table(spark, cur, stored), "a", "b", "v", "zone")
    # (1,'x') replaced; keys with a null part never match, so old and new both stay
    assert got == sorted([(1, "x", 2, 10), (1, "y", 1, 10), (2, None, 1, 10), (2, None, 2, 10), (None, "w", 1, 10),
                          (None, "w", 2, 10), (3, "z", 1, 20), (4, "q", 1, 30)], key=repr)
    assert dict(read_table(spark, cur, stored).dtypes)["zone"] == "int"


def test_merge_without_cache_equals_cached(spark, path):
    delta = spark.createDataFrame([(2, "b2", 2, "Adjuntas"), (7, "g1", 1, "Mayaguez")], SCHEMA)
    results = []
    for cache in (True, False):
        cur, arc = _load(spark, path, HISTORY)
        incremental_merge(spark, delta, SPEC, cur, arc, load_ts=T1, cache_merged=cache)
        results.append((rows(_current(spark, cur)), rows(spark.read.schema(STORED).parquet(arc))))
    assert results[0] == results[1]


def test_partition_normalizer_joins_spellings(spark, path):
    from tidemark.functions import title_case

    spec = TableSpec(("id",), ("version",), "city", partition_normalizer=title_case)
    cur, arc = path("cur"), path("arc")
    initial_load(spark.createDataFrame([(1, "a", 1, "SAN JUAN"), (2, "b", 1, "o'fallon")], SCHEMA), spec, cur, arc,
                 load_ts=T0)
    delta = spark.createDataFrame([(1, "a2", 2, "San Juan"), (3, "c", 1, "san juan")], SCHEMA)
    incremental_merge(spark, delta, spec, cur, arc, load_ts=T1)
    got = rows(_current(spark, cur), "id", "name", "city")
    assert got == sorted([(1, "a2", "San Juan"), (2, "b", "O'Fallon"), (3, "c", "San Juan")], key=repr)


def test_merge_without_delta_cache_equals_cached(spark, path):
    delta = spark.createDataFrame([(2, "b2", 2, "Adjuntas"), (5, "e2", 2, ""), (7, "g1", 1, "Mayaguez")], SCHEMA)
    results = []
    for cache in (True, False):
        cur, arc = _load(spark, path, HISTORY)
        incremental_merge(spark, delta, SPEC, cur, arc, load_ts=T1, cache_delta=cache)
        results.append((rows(_current(spark, cur)), rows(spark.read.schema(STORED).parquet(arc))))
    assert results[0] == results[1]


def test_small_key_set_is_broadcast_behind_size_check(spark, path):
    existing = spark.createDataFrame(HISTORY, SCHEMA)
    p = path("delta")
    spark.createDataFrame([(2, "b2", 2, "Adjuntas")], SCHEMA).write.parquet(p)
    delta = spark.read.parquet(p)  # file statistics give a size estimate (in-memory rows have none)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only our explicit choice can broadcast
    try:
        hinted = survivors(existing, delta, ["id"])
        shuffled = survivors(existing, delta, ["id"], broadcast_bytes=0)
        assert "BroadcastHashJoin" in plan_text(hinted) and "LeftAnti" in plan_text(hinted)
        assert "SortMergeJoin" in plan_text(shuffled) and "BroadcastHashJoin" not in plan_text(shuffled)
        assert rows(hinted) == rows(shuffled)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_delta_without_history_columns_keeps_them_on_survivors(spark, path):
    """A daily feed lacks the history feed's version column: survivors keep theirs, delta rows get null."""
    import uuid

    from tidemark.plans import incremental_merge_table, initial_load_table

    history = spark.createDataFrame([(1, "a", 3, "X"), (2, "b", 4, "X"), (3, "c", 5, "Y")], SCHEMA)
    delta = spark.createDataFrame([(1, "a2", "X"), (9, "z", "Z")], "id bigint, name string, city string")
    want = sorted([(1, "a2", None, "X"), (2, "b", 4, "X"), (3, "c", 5, "Y"), (9, "z", None, "Z")], key=repr)

    cur, arc = path("cur"), path("arc")
    initial_load(history, SPEC, cur, arc, load_ts=T0)
    incremental_merge(spark, delta, SPEC, cur, arc, load_ts=T1)
    assert rows(_current(spark, cur), "id", "name", "version", "city") == want
    archived = rows(spark.read.schema(STORED).parquet(arc), "id", "version", "load_ts")
    # the snapshot of X repeats survivor 2 with its version and its own load time, and adds delta row 1
    assert archived.count((2, 4, datetime(2024, 1, 1))) == 2 and (1, None, datetime(2024, 1, 31)) in archived

    tag = uuid.uuid4().hex[:8]
    initial_load_table(spark, history, SPEC, f"h_cur_{tag}", path("tcur"), f"h_arc_{tag}", path("tarc"), load_ts=T0)
    incremental_merge_table(spark, delta, SPEC, f"h_cur_{tag}", f"h_arc_{tag}", load_ts=T1)
    assert rows(spark.table(f"h_cur_{tag}"), "id", "name", "version", "city") == want

    with pytest.raises(ValueError, match="no columns"):  # a catalog table cannot take an undeclared column
        incremental_merge_table(spark, delta.withColumn("extra", F.lit(1)), SPEC, f"h_cur_{tag}", None, load_ts=T2)


def test_given_current_schema_equals_inferred(spark, path):
    from pyspark.sql.types import _parse_datatype_string

    history = spark.createDataFrame([(1, "a", 3, "X"), (2, "b", 4, "X"), (3, "c", 5, "Y")], SCHEMA)
    delta = spark.createDataFrame([(1, "a2", "X"), (9, "z", None)], "id bigint, name string, city string")
    results = []
    for given in (None, _parse_datatype_string(STORED)):
        cur, arc = path("cur"), path("arc")
        initial_load(history, SPEC, cur, arc, load_ts=T0)
        incremental_merge(spark, delta, SPEC, cur, arc, load_ts=T1, current_schema=given)
        results.append((rows(_current(spark, cur)), rows(spark.read.schema(STORED).parquet(arc))))
    assert results[0] == results[1]


def test_archive_once_on_rerun(spark, path):
    cur, arc = _load(spark, path, HISTORY)
    delta = spark.createDataFrame([(2, "b2", 2, "Adjuntas"), (7, "g1", 1, "Mayaguez")], SCHEMA)
    archive = lambda: spark.read.schema(STORED).parquet(arc)
    incremental_merge(spark, delta, SPEC, cur, arc, load_ts=T1, archive_once=True)
    after_first = rows(archive())
    after_current = rows(_current(spark, cur))
    # the same run again (as after a failure past the archive append): no second snapshot
    incremental_merge(spark, delta, SPEC, cur, arc, load_ts=T1, archive_once=True)
    assert rows(archive()) == after_first and len(after_first) == len(HISTORY) + 3
    assert rows(_current(spark, cur)) == after_current
    # another run (new load time) appends its snapshot
    incremental_merge(spark, delta, SPEC, cur, arc, load_ts=T2, archive_once=True)
    assert archive().count() == len(HISTORY) + 6
    # without the option a re-run appends again
    incremental_merge(spark, delta, SPEC, cur, arc, load_ts=T2)
    assert archive().count() == len(HISTORY) + 9
    with pytest.raises(ValueError, match="archive_once"):
        incremental_merge(spark, delta, SPEC, cur, arc, archive_once=True)


def _drop_new_files(folder, before, partition):
    """Remove what a run added to one partition (as a commit cut short leaves it)."""
    import os

    lost = [f for f in set(_files(folder)) - set(before) if partition in f and f.endswith(".parquet")]
    assert lost
    for f in lost:
        os.remove(f)


def test_archive_once_completes_a_partial_snapshot(spark, path):
    history = HISTORY + [(31, "s1", 1, "Adjuntas"), (32, "s2", 1, "Ponce"), (None, "n", 1, "Ponce")]
    delta = spark.createDataFrame([(2, "b2", 2, "Adjuntas"), (7, "g1", 1, "Ponce"), (None, "m", 1, "Ponce")], SCHEMA)
    cur, arc = _load(spark, path, history)
    before = _files(arc)
    archive = lambda: spark.read.schema(STORED).parquet(arc)
    incremental_merge(spark, delta, SPEC, cur, arc, load_ts=T1, archive_once=True)
    whole, current = rows(archive()), rows(_current(spark, cur))
    for partition in ("city=Ponce", "city=Adjuntas"):
        _drop_new_files(arc, before, partition)
        assert len(rows(archive())) < len(whole)
        incremental_merge(spark, delta, SPEC, cur, arc, load_ts=T1, archive_once=True)
        assert rows(archive()) == whole and rows(_current(spark, cur)) == current  # survivors and null keys included
    fresh = path("fresh")  # an archive that does not exist yet
    for _ in range(2):
        incremental_merge(spark, delta, SPEC, cur, fresh, load_ts=T1, archive_once=True)
    assert spark.read.schema(STORED).parquet(fresh).count() == len(whole) - len(history)


def test_normalizer_reaches_stored_spellings(spark, path):
    """A table stored before the normalizer: a delta's key leaves every spelling of its partition."""
    import dataclasses
    import uuid

    from tidemark.functions import title_case
    from tidemark.plans import incremental_merge_table, initial_load_table

    spec = dataclasses.replace(SPEC, partition_normalizer=title_case)
    history = spark.createDataFrame([(1, "a", 1, "SAN JUAN"), (2, "b", 1, "san juan"), (3, "c", 1, "san juan"),
                                     (4, "d", 1, "RIO: A/B"), (5, "e", 1, "PONCE"), (6, "f", 1, None)], SCHEMA)
    delta = spark.createDataFrame([(1, "a2", 2, "San Juan"), (2, "b2", 2, "SAN juan"), (4, "d2", 2, "rio: a/b")], SCHEMA)
    want = sorted([(1, "a2", "San Juan"), (2, "b2", "San Juan"), (3, "c", "san juan"), (4, "d2", "Rio: A/B"),
                   (5, "e", "PONCE"), (6, "f", None)], key=repr)
    cur, arc = path("cur"), path("arc")
    initial_load(history, SPEC, cur, arc, load_ts=T0)
    for _ in range(2):
        incremental_merge(spark, delta, spec, cur, arc, load_ts=T1, archive_once=True)
        assert rows(_current(spark, cur), "id", "name", "city") == want
    assert spark.read.schema(STORED).parquet(arc).count() == 6 + 4

    tag = uuid.uuid4().hex[:8]
    initial_load_table(spark, history, SPEC, f"n_cur_{tag}", path("tcur"), f"n_arc_{tag}", path("tarc"), load_ts=T0)
    for _ in range(2):
        incremental_merge_table(spark, delta, spec, f"n_cur_{tag}", f"n_arc_{tag}", load_ts=T1, archive_once=True)
        assert rows(spark.table(f"n_cur_{tag}"), "id", "name", "city") == want
    assert spark.table(f"n_arc_{tag}").count() == 6 + 4

"""Merges as runs: atomic commit, snapshots by run, repeats, buckets, emptied partitions."""

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import plan_text, rows
from test_catalog import DELTAS
from test_merge import HISTORY, SCHEMA, SPEC, T0
from tidemark.functions import title_case
from tidemark.operators import survivors
from tidemark.plans import (archive_as_of, finish_swap, incremental_merge_table, initial_load_run, initial_load_table, merge_run,
                            read_current, runs)
from tidemark.sources import create_table
from tidemark.spec import TableSpec

TIMES = ["2024-02-01 00:00:00", "2024-03-01 00:00:00", "2024-04-01 00:00:00"]


def _tables(spark, path, data=HISTORY, spec=SPEC, schema=SCHEMA, **options):
    tag = uuid.uuid4().hex[:8]
    cur, arc = f"r_cur_{tag}", f"r_arc_{tag}"
    initial_load_run(spark, spark.createDataFrame(data, schema), spec, cur, path("rcur"), arc, path("rarc"), load_ts=T0, **options)
    return cur, arc


def _all(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.mark.parametrize("buckets,broadcast_bytes", [(None, 10**9), (4, 0)])
def test_runs_equal_plain_merges_and_the_archive_knows_every_state(spark, path, buckets, broadcast_bytes):
    cur, arc = _tables(spark, path, buckets=buckets)
    tag = uuid.uuid4().hex[:8]
    plain, plain_arc = f"p_cur_{tag}", f"p_arc_{tag}"
    initial_load_table(spark, spark.createDataFrame(HISTORY, SCHEMA), SPEC, plain, path("pcur"), plain_arc, path("parc"), load_ts=T0)
    states = [_all(spark.table(plain))]
    for data, ts in zip(DELTAS, TIMES):
        delta = spark.createDataFrame(data, SCHEMA)
        merge_run(spark, delta, SPEC, cur, arc, load_ts=ts, broadcast_bytes=broadcast_bytes)
        incremental_merge_table(spark, delta, SPEC, plain, plain_arc, load_ts=ts)
        states.append(_all(spark.table(plain)))
        assert _all(spark.table(cur)) == states[-1] == _all(read_current(spark, cur))
    assert _all(spark.table(arc).drop("run_id")) == _all(spark.table(plain_arc))
    for ts, state in zip([T0, *TIMES], states):
        assert _all(archive_as_of(spark, SPEC, cur, arc, run=ts)) == state
    assert _all(archive_as_of(spark, SPEC, cur, arc)) == states[-1]


def test_every_run_can_be_repeated(spark, path):
    cur, arc = _tables(spark, path)
    for data, ts in zip(DELTAS, TIMES):
        merge_run(spark, spark.createDataFrame(data, SCHEMA), SPEC, cur, arc, load_ts=ts)
    current, archive = _all(spark.table(cur)), _all(spark.table(arc))
    for data, ts in zip(DELTAS, TIMES):
        merge_run(spark, spark.createDataFrame(data, SCHEMA), SPEC, cur, arc, load_ts=ts)
        assert _all(spark.table(cur)) == current and _all(spark.table(arc)) == archive
    spark.sql(f"ALTER TABLE {arc} DROP PARTITION (city = 'Adjuntas', run_id = '{runs.run_id(TIMES[0])}')")  # a snapshot gets lost
    assert _all(spark.table(arc)) != archive
    merge_run(spark, spark.createDataFrame(DELTAS[0], SCHEMA), SPEC, cur, arc, load_ts=TIMES[0])
    assert _all(spark.table(cur)) == current and _all(spark.table(arc)) == archive
    with pytest.raises(ValueError, match="initial load"):
        merge_run(spark, spark.createDataFrame(DELTAS[0], SCHEMA), SPEC, cur, arc, load_ts=T0)


def test_a_swap_that_breaks_off_shows_only_new_rows(spark, path, monkeypatch):
    """Between two partitions: readers see the committed run whole, the next run completes it."""
    cur, arc = _tables(spark, path)
    other, other_arc = _tables(spark, path)
    delta = spark.createDataFrame([(1, "a3", 3, "Adjuntas"), (4, "d3", 3, "Ponce"), (8, "h", 1, "New"), (5, "e9", 9, None)], SCHEMA)
    merge_run(spark, delta, SPEC, other, other_arc, load_ts=TIMES[0])
    old, new = _all(spark.table(cur)), _all(spark.table(other))
    real, calls = runs._set_location, []

    def breaks(*args):
        calls.append(args[3])
        if len(calls) == 2:
            raise RuntimeError("lost the catalog")
        real(*args)

    monkeypatch.setattr(runs, "_set_location", breaks)
    with pytest.raises(RuntimeError):
        merge_run(spark, delta, SPEC, cur, arc, load_ts=TIMES[0])
    assert _all(read_current(spark, cur)) == new != old
    city = sorted(spark.table(cur).columns).index("city")
    for value in {r[city] for r in old + new}:  # the plain table: each partition old or new, none mixed or missing
        mine = [[r for r in state if r[city] == value] for state in (_all(spark.table(cur)), old, new)]
        assert mine[0] in mine[1:]
    monkeypatch.setattr(runs, "_set_location", real)
    assert finish_swap(spark, cur) == 4 and finish_swap(spark, cur) == 0
    assert _all(spark.table(cur)) == new == _all(archive_as_of(spark, SPEC, cur, arc))
    merge_run(spark, spark.createDataFrame(DELTAS[2], SCHEMA), SPEC, cur, arc, load_ts=TIMES[1])
    merge_run(spark, spark.createDataFrame(DELTAS[2], SCHEMA), SPEC, other, other_arc, load_ts=TIMES[1])
    assert _all(spark.table(cur)) == _all(spark.table(other)) and _all(spark.table(arc)) == _all(spark.table(other_arc))


@pytest.mark.parametrize("step", ["insert_partitions", "_commit"])
def test_a_run_that_fails_before_its_commit_shows_only_old_rows(spark, path, monkeypatch, step):
    cur, arc = _tables(spark, path)
    merge_run(spark, spark.createDataFrame(DELTAS[0], SCHEMA), SPEC, cur, arc, load_ts=TIMES[0])
    old = _all(spark.table(cur))
    delta = spark.createDataFrame(DELTAS[1], SCHEMA)
    real = getattr(runs, step)

    def breaks(*args, **options):
        if step == "insert_partitions":
            real(*args, **options)  # the archive has its rows, the log has not
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(runs, step, breaks)
    with pytest.raises(RuntimeError):
        merge_run(spark, delta, SPEC, cur, arc, load_ts=TIMES[1])
    monkeypatch.setattr(runs, step, real)
    assert _all(spark.table(cur)) == old == _all(read_current(spark, cur)) == _all(archive_as_of(spark, SPEC, cur, arc))
    merge_run(spark, delta, SPEC, cur, arc, load_ts=TIMES[1])
    assert _all(spark.table(cur)) == _all(archive_as_of(spark, SPEC, cur, arc)) != old
    ran = spark.table(arc).where(F.col("run_id") == runs.run_id(TIMES[1]))
    assert rows(ran, "id", "name") == sorted([(5, "e2"), (6, "f2"), (None, "n1"), (None, "x"), (3, "c1")], key=repr)


def test_bucketed_current_is_not_shuffled(spark, path):
    """A delta too large to broadcast is dealt to the buckets of *current*, which stays where it is."""
    history = [(i, f"n{i}", 1, f"city{i % 5}") for i in range(2000)]
    cur, _ = _tables(spark, path, history, buckets=6)
    delta = spark.createDataFrame([(i, "d", 2, f"city{i % 2}") for i in range(0, 1500)], SCHEMA)
    existing = spark.table(cur).where(F.col("city").isin("city0", "city1"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = survivors(existing, delta, ["id"], broadcast_bytes=0, buckets=6)
        current_side, delta_side = plan_text(kept).split("LeftAnti", 1)[1].split("\n   +- Sort", 1)
        assert "FileScan parquet" in current_side and "Bucketed: true" in current_side and "Exchange" not in current_side
        assert "Exchange hashpartitioning" in delta_side
        assert kept.count() == sum(1 for i in range(1500, 2000) if i % 5 < 2)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_emptied_spellings_go_in_one_statement(spark, path, monkeypatch):
    """All rows of many spellings move to the normalized partition: one DROP names them all."""
    spec = TableSpec(("id",), ("version",), "city", partition_normalizer=title_case)
    word = "abcde"
    spellings = ["".join(c.upper() if n >> i & 1 else c for i, c in enumerate(word)) for n in range(2, 32)]
    cur, arc = _tables(spark, path, [(i, "x", 1, s) for i, s in enumerate(spellings)], SPEC)
    assert len(spark.sql(f"SHOW PARTITIONS {cur}").collect()) == len(spellings)
    statements, real = [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: statements.append(text) or real(self, text, *a, **k))
    delta = spark.createDataFrame([(i, "y", 2, word) for i in range(len(spellings))], SCHEMA)
    merge_run(spark, delta, spec, cur, arc, load_ts=TIMES[0])
    drops = [s for s in statements if "DROP IF EXISTS PARTITION" in s]
    assert len(drops) == 1 and drops[0].count("PARTITION (") == len(spellings)
    assert {r[0] for r in spark.sql(f"SHOW PARTITIONS {cur}").collect()} == {f"city={word.title()}"}
    assert spark.table(cur).count() == len(spellings) and _all(archive_as_of(spark, spec, cur, arc)) == _all(spark.table(cur))


def test_a_thousand_partitions_are_dropped_in_one_step(spark, path):
    name, schema = f"r_many_{uuid.uuid4().hex[:8]}", spark.createDataFrame([], SCHEMA).schema
    create_table(spark, name, path("many"), schema, "city")
    values = [f"it's {i}" for i in range(1000)]
    spark.sql(f"ALTER TABLE {name} ADD " + " ".join(f"PARTITION ({runs._equals('city', v)})" for v in [*values, "kept"]))
    runs.drop_partitions(spark, name, "city", values)
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["city=kept"]


@pytest.mark.parametrize("kind,values", [("int", [1, 2, None]), ("date", ["2024-01-05", "2024-02-06", None]),
                                         ("string", ["O'fallon \\ 1", "a/b: c%20d=+", "00601"])])
def test_typed_and_awkward_partition_values(spark, path, kind, values):
    schema = "id bigint, name string, version int, city string"
    def typed(data):  # noqa: E306
        return spark.createDataFrame(data, schema).withColumn("city", F.col("city").cast(kind))

    history = [(i, "h", 1, None if values[i % 3] is None else str(values[i % 3])) for i in range(9)]
    tag = uuid.uuid4().hex[:8]
    cur, arc = f"r_cur_{tag}", f"r_arc_{tag}"
    initial_load_run(spark, typed(history), SPEC, cur, path("tcur"), arc, path("tarc"), load_ts=T0)
    delta = [(0, "d", 2, history[0][3]), (2, "d", 2, history[2][3]), (20, "d", 2, history[1][3])]
    merge_run(spark, typed(delta), SPEC, cur, arc, load_ts=TIMES[0])
    want = {i: "h" for i in range(9)} | {0: "d", 2: "d", 20: "d"}
    assert {r.id: r.name for r in spark.table(cur).collect()} == want
    assert _all(archive_as_of(spark, SPEC, cur, arc)) == _all(spark.table(cur)) == _all(read_current(spark, cur))
    assert dict(spark.table(cur).dtypes)["city"] == kind


def test_empty_delta_and_names_of_runs(spark, path):
    cur, arc = _tables(spark, path)
    before = _all(spark.table(cur))
    merge_run(spark, spark.createDataFrame([], SCHEMA), SPEC, cur, arc, load_ts=TIMES[0])
    assert _all(spark.table(cur)) == before == _all(archive_as_of(spark, SPEC, cur, arc))
    assert runs.run_id("2024-02-01") == "2024-02-01 00:00:00.000000" == runs.run_id("2024-02-01T01:00:00+01:00")

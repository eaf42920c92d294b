"""Whitening against numpy's float64 solver and exact integers, with hostile vectors and clustered eigenvalues."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import registry, whitening

SF001 = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label string"


def integers(vectors):
    return [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors]


def expected(vectors, components=8):
    """Exact deviations, and what float64 gives for explained and whitened (up to sign)."""
    x = integers(vectors)
    n, sums = len(x), [sum(col) for col in zip(*x)]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    d = np.array([[a - s / n for a, s in zip(row, sums)] for row in x])
    e, q = np.linalg.eigh(d.T @ d / n)
    e, q = e[::-1], q[:, ::-1]
    k = min(components, len(e))
    return deviations, (e / e.sum())[:k], d @ q[:, :k] / np.sqrt(e[:k])


def test_query_against_numpy(spark):
    table = spark.read.parquet(f"{SF001}/embeddings.parquet").orderBy("vec_id").collect()
    got = registry.QUERIES["op12_embedding_whitening"](spark, SF001).orderBy("vec_id", "component").collect()
    deviations, explained, whitened = expected([r.embedding for r in table])
    assert [r.vec_id for r in got] == [r.vec_id for r in table for _ in range(8)]
    assert [r.deviation for r in got] == [d for d in deviations for _ in range(8)]
    assert {r.n for r in got} == {len(table)} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-12
    assert np.allclose([r.explained for r in got[:8]], explained, rtol=1e-12)
    z = np.array([r.whitened for r in got]).reshape(-1, 8)
    assert np.abs(z * np.sign((z * whitened).sum(axis=0)) - whitened).max() < 1e-9


def test_dropped_vectors_and_other_columns(spark):
    good = [[0.5, -1.25, 2.0], [1.5, 0.25, -2.0], [0.5, 0.5, 0.125], [0.5, 0.5, 0.125], [-3.0, 7.0, 1e-3]]
    rows = [(i, v, "mine") for i, v in enumerate(good)] + [(None, [9.0, 0.0, 1.0], None)]
    bad = [None, [], [1.0, 2.0], [1.0, None, 2.0], [float("nan")] * 3, [float("inf"), 0.0, 0.0], [1e30, 0.0, 0.0]]
    rows += [(100 + i, v, "bad") for i, v in enumerate(bad)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("n", F.lit("mine")).withColumn("a.b", F.lit(7)).repartition(4)
    got = whitening.whiten(df)
    assert got.columns == ["vec_id", "label", "a.b", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = got.collect()
    deviations, explained, whitened = expected(good + [[9.0, 0.0, 1.0]])
    assert len(got) == 18 and {r["n"] for r in got} == {6} and {r["a.b"] for r in got} == {7}
    assert {(r["vec_id"], int(r["deviation"])) for r in got} == set(zip([0, 1, 2, 3, 4, None], deviations))
    ids = [0, 1, 2, 3, 4, None]
    for r in got:
        assert abs(abs(r["whitened"]) - abs(whitened[ids.index(r["vec_id"])][r["component"] - 1])) < 1e-9
        assert abs(r["explained"] - explained[r["component"] - 1]) < 1e-12


def test_nothing_to_whiten(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None, "a"), (2, [], "a")], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], "a")] * 3, SCHEMA)).collect() == []
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i], "a") for i in range(5)], SCHEMA)).collect()
    assert {r.component for r in line} == {1} and abs(line[0].explained - 1) < 1e-12  # rank 1: one component


def test_large_entries_and_sums_stay_exact(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(300, 4)) * [1e9, 1.0, 1e-3, 1e4]).astype(np.float32).tolist()
    df = spark.createDataFrame([(i, v, "a") for i, v in enumerate(vectors)], SCHEMA)
    deviations = expected(vectors)[0]
    got = {r.vec_id: int(r.deviation) for r in whitening.whiten(df).collect()}
    assert got == dict(enumerate(deviations))


@pytest.mark.parametrize("values", [
    np.ones(24), np.repeat([3.0, 2.0, 1.0], 8), 1 + 1e-7 * np.arange(24), 1 + 1e-13 * np.arange(24),
    np.concatenate([1e6 + 1e-6 * np.arange(12), np.linspace(0, 1e-6, 12)]), np.exp(-2.0 * np.arange(24)),
    np.concatenate([[5.0] * 3, 1 + 1e-10 * np.arange(9), np.linspace(1e-9, 1e-3, 12)])])
def test_refinement_of_clusters(values):
    q = np.linalg.qr(np.random.default_rng(2).normal(size=(24, 24)))[0].astype(whitening.WIDE)
    a = (q * values.astype(whitening.WIDE)) @ q.T
    a = (a + a.T) / 2
    found, x = whitening.refined_eigen(a)
    eps = float(np.finfo(np.float64).eps)
    assert np.abs(x.T @ x - np.eye(24)).max() < eps / 4
    assert np.abs(a @ x - x * found).max() < eps / 4 * np.abs(a).max()
    assert np.all(np.diff(found) <= 0) and np.abs(found - np.sort(values)[::-1]).max() < 50 * eps * values.max()  # q is a float64 one


def test_float32_alone_is_not_enough():
    """What the refinement adds: the plain float32 vectors miss double precision by far."""
    a = np.cov(np.random.default_rng(3).normal(size=(200, 16)).T).astype(whitening.WIDE)
    start = np.linalg.eigh(a.astype(np.float32))[1].astype(whitening.WIDE)
    assert np.abs(start.T @ start - np.eye(16)).max() > 1e-9
    x = whitening.refined_eigen(a)[1]
    assert np.abs(x.T @ x - np.eye(16)).max() < 1e-16

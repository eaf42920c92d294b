"""Merkle manifest against a plain recursion, with hostile rows."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle

DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, lower=False):
    doc_id, source, lang, n_chars, text = row
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return h(*["-" if v is None else f"{len(v.encode())}:{v}" for v in values])


def level_up(digests):
    return [h(*digests[i:i + 16]) for i in range(0, len(digests), 16)]


def climb(digests, at):
    """Sibling lists (left, right) of one node up to the root, and the root."""
    path = []
    while len(digests) > 1:
        first = at // 16 * 16
        path.append(("".join(digests[first:at]), "".join(digests[at + 1:first + 16])))
        digests, at = level_up(digests), at // 16
    return path, digests[0]


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    subroots = [climb([leaf_of(r) for r in groups[s]], 0)[1] for s in order]
    out = []
    for i, s in enumerate(order):
        leaves = [leaf_of(r) for r in groups[s]]
        upper, root = climb(subroots, i)
        for j, r in enumerate(groups[s]):
            path = climb(leaves, j)[0] + upper
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            acc = leaf_of(r, lower=tampered)
            for left, right in path:
                acc = h(left, acc, right)
            out.append((r[0], leaves[j], subroots[i], root, h(*[a + b for a, b in path]), acc, acc == root))
    return out


def some_rows():
    rows = [(i, "big", "en", i, f"Text {i} ÄÖ") for i in range(-300, 300)]  # three levels
    rows += [(i, f"s{i}", None, None, "A") for i in range(40)]  # forty groups of one: the upper tree has two levels
    rows += [(i, None, "de", 1, None) for i in range(17)]  # a run of one at the end
    rows += [(None, "x", None, None, ""), (None, "x", None, None, "Y"), (7, "x", "en", 1, "same"), (7, "x", "en", 1, "same"),
             (8, "x", "en", 1, "Same"), (8, "x", "en", 2, "same"), (9, "", "en", 0, "n"), (9, "é", "en", 0, "A" * 300_000)]
    return rows


@pytest.mark.parametrize("rows", [some_rows(), [(5, None, None, None, "ABC")], [(i, "s", "en", 1, "Ab") for i in range(16)]])
def test_against_plain_recursion(spark, rows):
    docs = spark.createDataFrame(rows, DOCS)
    for c in ("leaf", "tree", "lo", "path", "k"):  # names of produced and helper columns
        docs = docs.withColumn(c, F.lit("mine"))
    got = merkle.manifest(docs.repartition(5))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, plain(rows)))


def test_empty_table(spark):
    got = merkle.manifest(spark.createDataFrame([], DOCS))
    assert got.collect() == [] and "verified" in got.columns


def test_tampering_is_found_exactly_where_it_changed_something(spark):
    rows = [(i, "s", "en", 1, "Upper" if i % 2 else "lower") for i in range(200)]
    for r in merkle.manifest(spark.createDataFrame(rows, DOCS)).collect():
        assert r.verified == (not (zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.doc_id % 2 == 1))


def test_one_id_on_every_row_spreads_over_tasks(spark):
    """Equal sort keys are split by the reading task, and ranks stay gapless."""
    rows = spark.range(0, 4000, 1, 8).select(F.lit("n").alias("tree"), F.lit(1).alias("id"), F.lit("d").alias("digest"))
    placed = merkle.ranked(rows, "tree", ["id", "digest"], "test")
    assert sorted(r.lo for r in placed.collect()) == list(range(4000))
    assert {r.n for r in placed.collect()} == {4000}

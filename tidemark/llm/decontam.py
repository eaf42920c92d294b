"""Op 8: benchmark decontamination by winnowing, in SQL expressions.

Every 10-word window of an item holds ``WINDOW - GRAM + 1`` word 6-grams; the
smallest gram hash of every such run is a fingerprint.  A document that shares a
10-word window shares its fingerprint, so joining the fingerprints of both
sides finds every document with a long enough shared span, at a fraction of
its positions.  Documents found are extended: their windows are looked up among
the items' windows and the words they cover are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, materialize, packed, row_key, table, unpacked

WINDOW = 10
GRAM = 6
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Benchmark windows broadcast up to this many (24 bytes each).
BROADCAST_WINDOWS = 500_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """Words of the text with A-Z lower-cased (no other letter); null has none."""
    ascii_only = F.octet_length(text) == F.length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))
    return F.coalesce(F.regexp_extract_all(lowered, F.lit(ITEM_WORD), F.lit(0)), F.array().cast("array<string>"))


def _numbers(last: Column) -> Column:
    """1 to ``last``, empty if that is below 1."""
    return F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))


def gram_hashes(w: Column, n: int) -> Column:
    """64-bit hash of the n words from each position."""
    return F.transform(_numbers(F.size(w) - (n - 1)), lambda i: F.xxhash64(F.slice(w, i, n)))


def fingerprints(grams: Column) -> Column:
    """Smallest gram hash of each window, each once (none below ``WINDOW`` words).

    ``grams`` must be a column, not an expression: it is read once per window."""
    run = WINDOW - GRAM + 1
    return F.array_distinct(F.transform(_numbers(F.size(grams) - (run - 1)), lambda i: F.array_min(F.slice(grams, i, run))))


def _windows(w: Column, n: int) -> Column:
    """``struct(pos, n, h1, h2)`` of every n-word window, 96 hash bits each."""
    def one(i: Column) -> Column:
        part = F.slice(w, i, n)
        return F.struct(i.alias("pos"), F.lit(n).alias("n"), F.xxhash64(part).alias("h1"), F.hash(part).alias("h2"))

    return F.transform(_numbers(F.size(w) - (n - 1)), one)


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: ``_key, doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    An item below 10 words, but not empty, is one window of its own length;
    such lengths (at most nine) are looked up at every position.  Null
    texts have no words; an item listed twice counts once; a null item_id reads
    ``null`` in the list; rows equal in id and text get equal results.  Extra
    columns are ignored.
    """
    items = materialize(
        benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), words(F.col("text")).alias("w"))
        .where(F.size("w") > 0), "bench-words")
    lengths = [r["n"] for r in items.select(F.least(F.size("w"), F.lit(WINDOW)).alias("n")).distinct().collect()]  # <= 10 numbers
    short = sorted(n for n in lengths if n < WINDOW)
    item_windows = F.when(F.size("w") >= WINDOW, _windows(F.col("w"), WINDOW))
    for n in short:
        item_windows = F.when(F.size("w") == n, _windows(F.col("w"), n)).otherwise(item_windows)
    item_windows = materialize(
        items.select("item", F.explode(item_windows).alias("x")).select("item", "x.n", "x.h1", "x.h2").distinct(), "bench-windows")
    grams = items.where(F.size("w") >= WINDOW).select(gram_hashes(F.col("w"), GRAM).alias("grams"))
    prints = grams.select(F.lit(WINDOW).alias("n"), F.explode(fingerprints(F.col("grams"))).alias("fp")).union(
        item_windows.where(F.col("n") < WINDOW).select("n", F.col("h1").alias("fp")))
    prints = materialize(prints.distinct(), "bench-prints")

    w = docs.select("doc_id", row_key("doc_id", "text").alias("_key"), words(F.col("text")).alias("w"))
    w = w.withColumn("grams", gram_hashes(F.col("w"), GRAM))
    per_length = {WINDOW: fingerprints(F.col("grams"))} if WINDOW in lengths else {}
    per_length |= {n: F.array_distinct(gram_hashes(F.col("w"), n)) for n in short}
    seen = materialize(w.select("doc_id", "_key", F.size("w").cast("long").alias("n_words"),
                                *[fps.alias(f"fp{n}") for n, fps in per_length.items()]), "doc-prints")
    known = broadcast_if_small(prints, BROADCAST_WINDOWS)
    found = None
    for n in per_length:
        part = seen.select("_key", F.lit(n).alias("n"), F.explode(f"fp{n}").alias("fp")).join(known, ["n", "fp"], "left_semi")
        found = part.select("_key") if found is None else found.union(part.select("_key"))
    if found is None:  # no item has a word
        found = seen.select("_key").where(F.lit(False))
    found = materialize(found.distinct(), "bench-candidates")

    texts = docs.select(row_key("doc_id", "text").alias("_key"), "text") \
        .join(broadcast_if_small(found), "_key", "left_semi").select("_key", words(F.col("text")).alias("w"))
    distinct_windows = broadcast_if_small(item_windows.select("n", "h1", "h2").distinct(), BROADCAST_WINDOWS)
    all_windows = F.concat(F.array().cast("array<struct<pos:int,n:int,h1:bigint,h2:int>>"),
                           *[_windows(F.col("w"), n) for n in lengths])
    hits = materialize(
        texts.select("_key", F.explode(all_windows).alias("x")).select("_key", "x.*")
        .join(distinct_windows, ["n", "h1", "h2"], "left_semi").select("_key", "pos", "n", "h1", "h2"), "bench-hits")
    end = F.col("pos") + F.col("n")
    earlier = Window.partitionBy("_key").orderBy("pos", "n").rowsBetween(Window.unboundedPreceding, -1)
    new = F.greatest(F.lit(0), end - F.greatest(F.col("pos"), F.coalesce(F.max(end).over(earlier), F.lit(0))))
    covered = hits.select("_key", "pos", "n").distinct().withColumn("new", new) \
        .groupBy("_key").agg(F.sum("new").cast("long").alias("n_hit"))
    named = hits.select("_key", "n", "h1", "h2").distinct() \
        .join(broadcast_if_small(item_windows, BROADCAST_WINDOWS), ["n", "h1", "h2"]) \
        .groupBy("_key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    out = seen.select("doc_id", "_key", "n_words").join(covered, "_key", "left").join(named, "_key", "left")
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0).cast("long"))
    listed = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    return out.select(
        "_key", "doc_id", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated documents (same columns)."""
    bad = materialize(find_contamination(docs, benchmark).where("contaminated").select("_key").distinct(), "contaminated")
    rows = packed(docs, "doc_id", "text").withColumn("_key", row_key("doc_id", "text"))
    return unpacked(rows.join(broadcast_if_small(bad), "_key", "left_anti"), docs.columns)


def q_decontaminate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_contamination(docs, table(spark, sf_dir, "benchmark")).drop("_key")


SQL = r"""
WITH items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)),
docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
positions AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS pos FROM docs),
hits AS (
  SELECT r, pos, n, array_to_string(w[pos:pos + n - 1], ' ') AS win
  FROM positions, (SELECT DISTINCT n FROM item_windows) WHERE pos + n - 1 <= len(w)),
found AS (SELECT h.r, h.pos, h.n, i.item_id FROM hits h JOIN item_windows i USING (n, win)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(pos, pos + n)) AS p FROM found) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, coalesce(CAST(item_id AS VARCHAR), 'null') AS id FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

"""Op 10: mixing sources to target weights by hash-random keys and distributed prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, broadcast_if_small, keep_columns, materialize, packed, row_key, table, unpacked

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
#: Rows summed together by one window group.
BLOCK_ROWS = 1000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source (``source, source_size, n_rows``) with its weight and target.

    Sources by code point, null last, take ``weights`` in turn and share the
    whole of all sizes.  A target stops at ``max_epochs`` times its source; the
    excess is shared again by weight.  In order of cap per weight, a source is
    capped exactly if its share of what the capped ones before it leave is above
    its cap, so running sums over the sources settle all rounds at once.
    """
    unit = 1
    for w in weights:
        unit *= w
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    s = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    s = s.withColumn("weight", F.element_at(cycle, (F.pmod(F.col("rank"), F.lit(len(weights))) + 1).cast("int")))
    s = s.withColumn("cap", F.col("source_size") * max_epochs)
    everything = Window.partitionBy()
    earlier = Window.orderBy((F.col("cap") * unit / F.col("weight")).cast("long"), "rank") \
        .rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({
        "all_size": F.sum("source_size").over(everything),
        "all_weight": F.sum("weight").over(everything),
        "cap_before": F.coalesce(F.sum("cap").over(earlier), F.lit(0)),
        "weight_before": F.coalesce(F.sum("weight").over(earlier), F.lit(0)),
    })
    left, rest = F.col("all_size") - F.col("cap_before"), F.col("all_weight") - F.col("weight_before")
    s = s.withColumn("capped", F.col("cap") * rest < F.col("weight") * left)
    s = s.withColumns({
        "left": F.col("all_size") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0)),
        "rest": F.col("all_weight") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("weight"))).over(everything), F.lit(0)),
    })
    share = (F.col("weight") * F.col("left")).cast("double") / F.col("rest").cast("double")
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share)
    return s.select("source", "source_size", "n_rows", "rank", "weight", target.alias("target"))


def mix(docs: DataFrame, block_rows: int = BLOCK_ROWS, carry: bool = False) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken.

    Inside its source a document stands at a hash-random place (MD5 of its id
    and text, so reruns agree).  The target is spent in whole epochs, then up to
    the word where it ends: a document before the cut is taken once more, the
    one on it in part.  Sums run inside blocks (equal ranges of the hash, about
    ``block_rows`` rows each, however large the source) and each block adds
    the sums of the blocks before it.  Null texts have size 0; null is a source
    of its own, the last; rows equal in id and text are interchangeable.
    ``carry`` keeps all columns of ``docs`` beside the produced ones.
    """
    docs = keep_columns(docs, ["size", "source_size", "target", "taken"])
    key = row_key("doc_id", "text")
    small = materialize(docs.select("source", word_count(F.col("text")).alias("size"), key.alias("_key"),
                                    *([] if carry else ["doc_id"])), "mix-sizes")
    sizes = small.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    targets = materialize(source_targets(sizes), "mix-targets")
    place = F.conv(F.substring("_key", 1, 6), 16, 10).cast("long")
    n_blocks = F.ceil(F.col("n_rows") / F.lit(block_rows)).cast("long")
    block = F.shiftright(place * F.least(n_blocks, F.lit(1 << 24)), 24)
    by_source = broadcast_if_small(targets).withColumnRenamed("source", "_source")

    def placed(rows: DataFrame) -> DataFrame:
        return rows.join(by_source, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn("_blk", block)

    sums = placed(small).groupBy("rank", "_blk").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("rank").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(sums.select("rank", "_blk", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before")),
                          "mix-offsets")
    rows = docs.withColumns({"size": word_count(F.col("text")), "_key": key}) if carry else small
    inside = Window.partitionBy("rank", "_blk").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    rows = placed(rows).withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(broadcast_if_small(offsets), ["rank", "_blk"], "left")
    budget = F.floor(F.col("target"))
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rows = rows.withColumn("_epochs", epochs)
    left = budget - F.col("_epochs") * F.col("source_size") - F.col("_before") - F.col("_in")
    part = F.greatest(F.lit(0), F.least(F.col("size"), left))
    rows = rows.withColumn("taken", (F.col("_epochs") * F.col("size") + part).cast("long"))
    return rows.select(*(docs.columns if carry else ["doc_id", "source"]), "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: each document as often as the mix takes it (a part counts as once), columns of ``docs``."""
    times = F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    rows = mix(packed(docs, "doc_id", "text", "source"), carry=True).withColumn("_times", times)
    return unpacked(rows.where("_times > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))), docs.columns)


def q_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), [])) AS size,
         md5(coalesce('v' || CAST(doc_id AS VARCHAR), 'n') || chr(1) || coalesce('v' || text, 'n')) AS place
  FROM documents),
s AS (
  SELECT source, sum(size) AS source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM d GROUP BY source),
r AS (
  SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS all_size, sum(weight) OVER () AS all_weight,
         coalesce(sum(3 * source_size) OVER e, 0) AS cap_before, coalesce(sum(weight) OVER e, 0) AS weight_before
  FROM s WINDOW e AS (ORDER BY source_size * 18 // weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, cap * (all_weight - weight_before) < weight * (all_size - cap_before) AS capped FROM r),
t AS (
  SELECT source, source_size,
         CASE WHEN capped THEN CAST(cap AS DOUBLE)
              ELSE CAST(weight * (all_size - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ()) AS DOUBLE)
                   / CAST(all_weight - sum(CASE WHEN capped THEN weight ELSE 0 END) OVER () AS DOUBLE) END AS target
  FROM c),
p AS (
  SELECT doc_id, source, size,
         coalesce(sum(size) OVER (PARTITION BY source ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d),
b AS (
  SELECT p.*, t.source_size, t.target, CAST(floor(t.target) AS HUGEINT) AS budget,
         CASE WHEN t.source_size > 0 THEN CAST(floor(t.target) AS HUGEINT) // t.source_size ELSE 0 END AS epochs
  FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) AS BIGINT) AS taken, source
FROM b
"""

"""Op 7: jump consistent hashing (Lamping & Veach) in SQL expressions.

Law ``key``: a row's shard follows from its key and the number of shards alone.
With one more shard a row either stays or moves into the new one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, keep_columns, materialize, packed, table, unpacked

#: Fixed value of the published algorithm: multiplier of its 64-bit generator.
JUMP_MULTIPLIER = 2862933555777941757

SHARDS = 40
#: Rows numbered together by one window group.
BLOCK_ROWS = 1000
#: A block of so many times its rows is split by key and CRC.
HOT = 8


def key_bits(key: Column) -> Column:
    """60 uniform bits of a key of any type (null counts as the empty text)."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def jump_pair(bits: Column, shards: int) -> Column:
    """``struct(shard, grown_shard)`` of a 60-bit key for ``shards`` and ``shards + 1`` buckets.

    The algorithm's jumps for ``shards + 1`` buckets pass through its bucket
    for ``shards``, so one pass gives both.  Every step moves on by at least one
    bucket, so ``shards + 1`` steps always suffice.  The 64-bit product is
    built from 16- and 32-bit parts: it must wrap, and Spark's must not.
    """
    mh, ml = JUMP_MULTIPLIER >> 32, JUMP_MULTIPLIER & 0xFFFFFFFF
    mask = 0xFFFFFFFF

    def step(s: Column, _: Column) -> Column:
        hi, lo = s["hi"], s["lo"]
        low_a = F.shiftright(lo, 16) * F.lit(ml)
        low = (low_a.bitwiseAND(F.lit(0xFFFF)) * 65536) + lo.bitwiseAND(F.lit(0xFFFF)) * F.lit(ml) + 1
        high_a = (F.shiftright(hi, 16) * F.lit(ml)).bitwiseAND(F.lit(0xFFFF)) * 65536
        high = F.shiftright(low, 32) + F.shiftright(low_a, 16) + (lo * F.lit(mh)).bitwiseAND(F.lit(mask)) \
            + (high_a + hi.bitwiseAND(F.lit(0xFFFF)) * F.lit(ml)).bitwiseAND(F.lit(mask))
        new_hi = high.bitwiseAND(F.lit(mask))
        b = s["j"]
        ratio = F.lit(float(1 << 31)) / (F.shiftright(new_hi, 1) + 1).cast("double")
        nxt = F.floor((b + 1).cast("double") * ratio).cast("long")
        moved = F.struct(new_hi.alias("hi"), low.bitwiseAND(F.lit(mask)).alias("lo"), nxt.alias("j"),
                         F.when(b < shards, b).otherwise(s["shard"]).alias("shard"), b.alias("grown"))
        return F.when(s["j"] <= shards, moved).otherwise(s)

    zero = F.lit(0).cast("long")
    start = F.struct(F.shiftright(bits, 32).alias("hi"), bits.bitwiseAND(F.lit(mask)).alias("lo"), zero.alias("j"),
                     zero.alias("shard"), zero.alias("grown"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(shards)), start, step,
                       lambda s: F.struct(s["shard"].cast("int").alias("shard"), s["grown"].cast("int").alias("grown")))


def assign_shards(docs: DataFrame, shards: int = SHARDS, key_col: str = "doc_id", text_col: str = "text",
                  block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` plus size, text_crc32, law, shard, slot and grown_shard.

    ``slot`` numbers the rows of a shard from 0 without gaps.  A shard may hold
    any number of rows, so rows are numbered inside blocks of about
    ``block_rows`` (a hash of the key picks the block) and each block adds the
    rows of the blocks before it.  A block that a frequent key makes ``HOT`` times as large
    is split by key, and its frequent keys by equal ranges of the text's CRC.  Null keys share the shard of the empty key;
    null texts count no bytes (size 16, CRC 0).  Rows of one key share a shard; rows
    that are equal in key and text are interchangeable (and stay in one group).  Columns of ``docs``
    that carry a produced name are replaced, all others stay.
    """
    produced = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    docs = keep_columns(docs, produced)
    key, text = F.col(key_col), F.col(text_col)
    crc = F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long")
    blocks = max(1, -(-docs.count() // (shards * block_rows)))

    def placed(rows: DataFrame) -> DataFrame:
        """``rows`` with key bits, jumps and block; ``_k`` is the key as text, null first."""
        rows = rows.withColumn("_bits", key_bits(key)).withColumn("_jump", jump_pair(F.col("_bits"), shards))
        return rows.withColumns({"shard": F.col("_jump.shard"), "_blk": F.pmod(F.col("_bits"), F.lit(blocks).cast("long")),
                                 "_k": F.coalesce(F.concat(F.lit("v"), key.cast("string")), F.lit("n"))})

    keys = placed(docs.select(key_col))
    counts = materialize(keys.groupBy("shard", "_blk").agg(F.count(F.lit(1)).alias("_n")), "shard-blocks")
    hot = counts.where(F.col("_n") > HOT * block_rows).select("shard", "_blk")
    parts = [F.lit(-1).cast("long").alias("_b"), F.lit("").alias("_s"), F.lit(0).cast("long").alias("_p")]
    split = None
    if not hot.isEmpty():  # the same slots, from smaller groups
        hot = broadcast_if_small(hot)
        frequent = keys.join(hot, ["shard", "_blk"], "left_semi").groupBy("shard", "_blk", "_k").agg(F.count(F.lit(1)).alias("_n"))
        split = materialize(frequent.select("shard", "_blk", "_k", F.ceil(F.col("_n") / block_rows).cast("long").alias("_split")), "shard-keys")

    def grouped(rows: DataFrame, crc: Column) -> DataFrame:
        """``rows`` with their group: the block, or in a hot block the key and its range of the CRC."""
        if split is None:
            return rows.select("*", *parts)
        rows = rows.join(broadcast_if_small(split), ["shard", "_blk", "_k"], "left")
        inner = F.col("_split").isNotNull()
        own = [F.col("_bits"), F.col("_k"), F.shiftright(crc * F.col("_split"), 32)]
        return rows.select("*", *[F.when(inner, o).otherwise(p).alias(n) for o, p, n in zip(own, parts, ("_b", "_s", "_p"))])

    group = ["shard", "_blk", "_b", "_s", "_p"]
    if split is not None:
        small = placed(docs.select(key_col, crc.alias("_crc"))).select("shard", "_blk", "_bits", "_k", "_crc")
        counts = grouped(small, F.col("_crc")).groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    else:
        counts = counts.select("*", *parts)
    before = Window.partitionBy("shard").orderBy(*group[1:]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(counts.select(*group, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")), "shard-offsets")
    rows = placed(packed(docs, key_col, text_col)).withColumns({
        "size": (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long"), "text_crc32": crc, "law": F.lit("key")})
    inside = Window.partitionBy(*group).orderBy("_bits", "_k", "text_crc32", "size")
    numbered = grouped(rows, F.col("text_crc32")).withColumn("slot", F.row_number().over(inside).cast("long") - 1)
    out = numbered.join(broadcast_if_small(offsets), group, "left")
    return unpacked(out, [*docs.columns, *produced], slot=F.col("slot") + F.col("_before"), grown_shard=F.col("_jump.grown"))


def q_shard(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return assign_shards(docs).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


#: CRC-32 byte by byte and the jumps as recursions; slots by one window per shard, in the order of the blocks.
SQL = r"""
WITH RECURSIVE
poly AS (
  SELECT b, 0 AS k, CAST(b AS BIGINT) AS c FROM range(256) x(b)
  UNION ALL
  SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM poly WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM poly WHERE k = 8),
d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(octet_length(encode(text)), 0) AS bytes,
         coalesce(hex(encode(text)), '') AS hx,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS bits
  FROM documents),
sums AS (
  SELECT r, xor(list_reduce(list_prepend(4294967295,
              list_transform(range(0, bytes), lambda i: CAST('0x' || substr(hx, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
            lambda acc, x: xor(acc >> 8, t[(xor(acc, x) & 255) + 1])), 4294967295) AS text_crc32
  FROM d, crc),
jumps AS (
  SELECT r, CAST(bits AS HUGEINT) AS k, CAST(0 AS BIGINT) AS j FROM d
  UNION ALL
  SELECT r, k2, CAST(floor((j + 1) * (2147483648.0::DOUBLE / CAST((k2 // 8589934592) + 1 AS DOUBLE))) AS BIGINT)
  FROM (SELECT r, j, ((k % 4294967296) * 2862933555777941757 + ((k // 4294967296) * 2862933555777941757 % 4294967296) * 4294967296 + 1)
                     % 18446744073709551616::HUGEINT AS k2
        FROM jumps WHERE j <= 40)),
placed AS (
  SELECT r, max(j) FILTER (WHERE j < 40) AS shard, max(j) FILTER (WHERE j < 41) AS grown_shard FROM jumps GROUP BY r),
n AS (SELECT greatest(1, CAST(ceil(count(*) / 40000.0) AS BIGINT)) AS blocks FROM documents)
SELECT doc_id, CAST(bytes + 16 AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law,
       CAST(shard AS INTEGER) AS shard,
       CAST(row_number() OVER (PARTITION BY shard ORDER BY bits % blocks, bits, CAST(doc_id AS VARCHAR), text_crc32, bytes) - 1 AS BIGINT) AS slot,
       CAST(grown_shard AS INTEGER) AS grown_shard
FROM d JOIN sums USING (r) JOIN placed USING (r), n
"""

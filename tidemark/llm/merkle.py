"""Op 13: Merkle dataset manifest over nested-interval labels.

Every node of a tree carries the interval ``[lo, hi)`` of leaf ranks it covers; a
node of level k covers at most 16^k of them.  Levels are built upwards, one
shuffle each on a sixteenth of the rows before.  On the way down a node of level
k meets its parent in a join on the bucket ``lo div 16^(k+1)`` and containment of
the intervals, and its siblings are the parent's children left and right of its
own interval.  Paths to the root are carried by runs of 16 leaves, never by
single leaves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, materialize, table

#: Fixed values of the manifest: children of a node, and the fields of a leaf in their order.
FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Every row whose unsigned crc32(decimal id) this divides is checked as if its text had been lower-cased.
TAMPER_MODULUS = 5

_PATH = "array<struct<left:string,right:string>>"


def field_digest_input(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field_digest_input, values)), 256)


def ranked(rows: DataFrame, tree: str, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` plus ``lo`` (rank from 0 inside ``tree`` by ``order``, nulls first) and ``n`` (rows of the tree).

    A range sort spreads one tree over as many tasks as its rows need; rows equal
    in all of ``order`` are split by the task that read them.  Positions are written down
    before they are used, so a lost executor cannot renumber rows."""
    keys = [F.asc_nulls_first(c) for c in [tree, *order]] + [F.asc("_task")]
    placed = materialize(
        rows.withColumn("_task", F.spark_partition_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id()).withColumn("_pos", F.monotonically_increasing_id()), f"{name}-placed")
    pieces = placed.groupBy(tree, "_part").agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy(tree)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(pieces.select(
        tree, "_part", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(whole).alias("n")), f"{name}-offsets")
    return placed.join(broadcast_if_small(offsets), [tree, "_part"]) \
        .withColumn("lo", F.col("_pos") - F.col("_first") + F.col("_before")).drop("_task", "_part", "_pos", "_first", "_before")


def _is_top() -> Column:
    return (F.col("lo") == 0) & (F.col("hi") == F.col("n"))


def build_levels(leaves: DataFrame, name: str, extra: Sequence[str] = ()) -> list[DataFrame]:
    """Level 0 (``leaves``: tree, n, lo, hi, digest and ``extra``), then per level its nodes: tree, n, lo, hi, digest, kids.

    ``kids`` holds the at most 16 children of a node by rank; those of level 1 keep ``extra``."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels, width = [leaves], 1
    while width < most:
        width *= FAN
        kid = F.struct("lo", "hi", "digest", *(extra if len(levels) == 1 else []))
        nodes = (
            levels[-1].where(~_is_top()).groupBy("tree", "n", F.expr(f"lo div {width}").alias("_bucket"))
            .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sort_array(F.collect_list(kid)).alias("kids"))
            .drop("_bucket").withColumn("digest", F.sha2(F.array_join(F.transform("kids", lambda k: k["digest"]), ""), 256))
        )
        levels.append(materialize(nodes, f"{name}-level{len(levels)}"))
    return levels


def tops(levels: Sequence[DataFrame]) -> DataFrame:
    """``(tree, digest)`` of the one node of each tree that covers all its leaves."""
    out = levels[0].where(_is_top()).select("tree", "digest")
    for nodes in levels[1:]:
        out = out.unionByName(nodes.where(_is_top()).select("tree", "digest"))
    return out


def _siblings(kids: Column, lo: Column, hi: Column) -> Column:
    """Digests of the parent's children outside ``[lo, hi)``, left of it and right of it."""
    def joined(keep):
        return F.array_join(F.transform(F.filter(kids, keep), lambda k: k["digest"]), "")
    return F.struct(joined(lambda k: k["hi"] <= lo).alias("left"), joined(lambda k: k["lo"] >= hi).alias("right"))


def attach_paths(levels: Sequence[DataFrame], crown: DataFrame, name: str, extra: Sequence[str] = ()) -> DataFrame:
    """Leaves (tree, digest, ``extra``) with their ``path`` and the other columns of ``crown``.

    ``crown`` has one row per tree: the path above its top node and what its
    leaves are to carry.  ``path`` lists the siblings left and right, leaf first."""
    carried = [c for c in crown.columns if c not in ("tree", "path")]
    above, width = None, FAN ** (len(levels) - 1)
    for k in range(len(levels) - 1, 0, -1):
        own = levels[k].select("tree", "n", "lo", "hi", "kids")
        nodes = own.where(_is_top()).join(crown, "tree")
        if above is not None:
            p = above.select(F.col("tree").alias("p_tree"), F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi"),
                             F.col("kids").alias("p_kids"), F.col("path").alias("p_path"), *carried)
            c = own.where(~_is_top())
            bucket = F.expr(f"lo div {width * FAN}") == F.expr(f"p_lo div {width * FAN}")
            inside = (F.col("p_lo") <= F.col("lo")) & (F.col("hi") <= F.col("p_hi"))
            met = c.join(p, (F.col("tree") == F.col("p_tree")) & bucket & inside)
            path = F.concat(F.array(_siblings(F.col("p_kids"), F.col("lo"), F.col("hi"))), F.col("p_path"))
            nodes = nodes.unionByName(met.withColumn("path", path).select(*nodes.columns))
        above = materialize(nodes, f"{name}-paths{k}") if k > 1 else nodes
        width //= FAN
    out = ["tree", "digest", *extra, "path", *carried]
    lone = levels[0].where(_is_top()).join(crown, "tree").select(*out)
    if above is None:
        return lone
    each = above.select("tree", *carried, F.explode(F.transform("kids", lambda k: F.struct(
        k["digest"].alias("digest"), *[k[c].alias(c) for c in extra],
        F.concat(F.array(_siblings(F.col("kids"), k["lo"], k["hi"])), F.col("path")).alias("path")))).alias("k"))
    return each.select("tree", "k.digest", *[f"k.{c}" for c in extra], "k.path", *carried) \
        .unionByName(lone)


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings on its path."""
    return F.aggregate(path, leaf, lambda acc, p: F.sha2(F.concat(p["left"], acc, p["right"]), 256))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""), 256)


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "source",
             text_col: str = "text", modulus: int = TAMPER_MODULUS) -> DataFrame:
    """One row per document: id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Leaves of a group ascend by id (nulls first, then by digest); groups ascend by
    value, null first, as a group of its own.  Every 16 nodes in a row become one, the last run of
    a level too if it has fewer.  Null fields hash as ``-``, empty texts as
    ``0:``.  Rows equal in all ``fields`` have equal leaves but places, hence proofs, of their own.
    A row is tampered with if ``modulus`` divides crc32 of its id (never a null id); where that changes
    nothing it verifies.  An empty table gives no rows.  Other columns of
    ``docs`` are not carried, so none can clash."""
    flagged = F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")), F.lit(modulus)) == 0
    text = F.col(f"`{text_col}`")
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    group = F.col(f"`{group_col}`").cast("string")
    leaves = materialize(docs.select(
        F.coalesce(F.concat(F.lit("v"), group), F.lit("n")).alias("tree"), F.col(f"`{id_col}`").alias("id"),
        leaf_digest([F.col(f"`{f}`") for f in fields]).alias("digest"),
        F.when(flagged, leaf_digest([lowered if f == text_col else F.col(f"`{f}`") for f in fields])).alias("tampered"),
    ), "merkle-leaves")
    nodes = ranked(leaves, "tree", ["id", "digest"], "merkle").withColumn("hi", F.col("lo") + 1)
    levels = build_levels(nodes, "merkle", ["id", "tampered"])

    subroots = materialize(tops(levels).select(F.lit("").alias("tree"), F.col("tree").alias("id"), "digest"), "merkle-subroots")
    heads = ranked(subroots, "tree", ["id"], "merkle-top").withColumn("hi", F.col("lo") + 1)
    top = build_levels(heads, "merkle-top", ["id"])
    peak = tops(top).select("tree", F.col("digest").alias("root"), F.array().cast(_PATH).alias("path"))
    crown = attach_paths(top, peak, "merkle-top", ["id"]) \
        .select(F.col("id").alias("tree"), F.col("digest").alias("subroot"), "root", "path")
    rows = attach_paths(levels, materialize(crown, "merkle-crown"), "merkle", ["id", "tampered"])
    folded = fold(F.coalesce("tampered", "digest"), F.col("path"))
    return rows.select(F.col("id").alias(id_col), F.col("digest").alias("leaf"), "subroot", "root",
                       proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))


def q_merkle(spark, sf_dir):
    return manifest(table(spark, sf_dir, "documents").select(*FIELDS))


#: Trees by recursion over (level, position); CRC-32 byte by byte.
SQL = r"""
WITH RECURSIVE
poly AS (
  SELECT b, 0 AS k, CAST(b AS BIGINT) AS c FROM range(256) x(b)
  UNION ALL
  SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM poly WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM poly WHERE k = 8),
f AS (
  SELECT doc_id, source, coalesce('v' || source, 'n') AS tree, text,
         coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-')
         || coalesce(octet_length(encode(source)) || ':' || source, '-')
         || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
         || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS head,
         xor(list_reduce(list_prepend(4294967295,
               list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
                              lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(i AS BIGINT), 1)) AS BIGINT))),
             lambda acc, x: xor(acc >> 8, t[(xor(acc, x) & 255) + 1])), 4294967295) % 5 = 0 AS flagged
  FROM documents, crc),
leaves AS (
  SELECT doc_id, tree, coalesce(flagged, false) AS flagged,
         sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(octet_length(encode(text)) || ':'
           || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) AS low
  FROM f),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
         count(*) OVER (PARTITION BY tree) AS m FROM leaves),
nodes AS (
  SELECT tree, CAST(0 AS BIGINT) AS k, CAST(i AS BIGINT) AS i, CAST(m AS BIGINT) AS m, leaf AS h FROM placed
  UNION ALL
  SELECT tree, k + 1, i // 16, (m + 15) // 16, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE m > 1
  GROUP BY tree, k, i // 16, m),
subs AS (
  SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS m FROM nodes WHERE m = 1),
heads AS (
  SELECT CAST(0 AS BIGINT) AS k, CAST(i AS BIGINT) AS i, CAST(m AS BIGINT) AS m, subroot AS h FROM subs
  UNION ALL
  SELECT k + 1, i // 16, (m + 15) // 16, sha256(string_agg(h, '' ORDER BY i)) FROM heads WHERE m > 1
  GROUP BY k, i // 16, m),
steps AS (
  SELECT p.tree, p.i AS leaf_i, 0 AS part, a.k,
         coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (WHERE s.i < a.i), '') AS l,
         coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (WHERE s.i > a.i), '') AS r
  FROM placed p
  JOIN nodes a ON a.tree = p.tree AND a.m > 1 AND a.i = p.i // CAST(pow(16, a.k) AS BIGINT)
  JOIN nodes s ON s.tree = a.tree AND s.k = a.k AND s.i // 16 = a.i // 16
  GROUP BY ALL
  UNION ALL
  SELECT p.tree, p.i, 1, a.k,
         coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (WHERE s.i < a.i), ''),
         coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (WHERE s.i > a.i), '')
  FROM placed p
  JOIN subs b ON b.tree = p.tree
  JOIN heads a ON a.m > 1 AND a.i = b.i // CAST(pow(16, a.k) AS BIGINT)
  JOIN heads s ON s.k = a.k AND s.i // 16 = a.i // 16
  GROUP BY ALL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY tree, leaf_i ORDER BY part, k) AS step FROM steps),
folds AS (
  SELECT tree, i, CAST(0 AS BIGINT) AS step, CASE WHEN flagged THEN low ELSE leaf END AS h FROM placed
  UNION ALL
  SELECT f.tree, f.i, f.step + 1, sha256(n.l || f.h || n.r) FROM folds f
  JOIN numbered n ON n.tree = f.tree AND n.leaf_i = f.i AND n.step = f.step + 1),
ends AS (SELECT tree, i, arg_max(h, step) AS folded_root FROM folds GROUP BY tree, i),
proofs AS (SELECT tree, leaf_i AS i, sha256(string_agg(l || r, '' ORDER BY step)) AS proof FROM numbered GROUP BY tree, leaf_i)
SELECT p.doc_id, p.leaf, b.subroot, t.h AS root, coalesce(q.proof, sha256('')) AS proof_sha256,
       e.folded_root, e.folded_root = t.h AS verified
FROM placed p JOIN subs b USING (tree) JOIN ends e ON e.tree = p.tree AND e.i = p.i
LEFT JOIN proofs q ON q.tree = p.tree AND q.i = p.i, (SELECT h FROM heads WHERE m = 1) t
"""

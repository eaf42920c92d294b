"""Op 6: n-gram Jaccard join by MinHash banding and verification on full n-gram sets.

1. Every text gets a MinHash signature over its word 5-grams, cut into bands.
   Texts with the same word sequence are copies: one class, joined once.
2. Texts sharing a band hash are candidates.  A text lives with its center, the
   text of most candidates that it shares a band hash with; large homes are cut
   into blocks, and two blocks are compared exactly if some band hash has a text
   in each of them.
3. Jaccard distance is a metric: two texts of a home whose distances to the center
   sum up to no more than the threshold's are linked, and are counted without a
   comparison.  Blocks that hold only such pairs are not compared.
4. The others are compared on full n-gram sets: no pair of texts is written out,
   only each text's number of links and a spanning forest of them.
5. Components of the verified links are the classes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField

from tidemark.llm.common import BROADCAST_ROWS, add_computed, discard, join_by_count, materialize, packed, row_key, table, unpacked
from tidemark.llm.graph import connected_components

GRAM = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.999
MAX_HASHES = 128
#: Texts per side of a block of comparisons.
BLOCK = 128
#: Distances to a center are rounded up to this many steps.
LEVELS = 1000
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def band_shape(threshold: float, recall: float, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """``(bands, rows)``: the most rows per band, so the fewest chance candidates, with which a pair at
    ``threshold`` shares a band with probability ``recall`` within ``max_hashes`` hashes."""
    for rows in range(max_hashes, 0, -1):
        p = threshold**rows
        bands = 1 if p >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-p))
        if bands * rows <= max_hashes:
            return bands, rows
    raise ValueError("max_hashes is too small for this recall")


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def gram_hashes(texts: list[str | None], n: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all word n-grams of all texts, where each text's begin (and the end), and its words.

    Words are lower-cased runs between ASCII white space; a text of fewer than
    ``n`` words, but not none, is one gram."""
    words, counts = [], np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        if t:
            found = t.lower().encode("utf-8", "surrogatepass").split()
            counts[i] = len(found)
            words += found
    bounds = np.concatenate([[0], np.cumsum(counts)])
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    if not words:
        return np.zeros(0, np.uint64), starts, counts
    codes, unique = pd.factorize(np.array(words, dtype=object))
    h = pd.util.hash_array(unique, categorize=False)[codes]
    first = np.arange(starts[-1]) - np.repeat(starts[:-1], sizes) + np.repeat(bounds[:-1], sizes)
    last = np.repeat(bounds[1:], sizes)
    grams = np.zeros(len(first), np.uint64)
    for k in range(n):
        at = first + k
        inside = at < last
        grams = (grams + np.where(inside, h[np.minimum(at, len(h) - 1)], np.uint64(k + 1))) * _MULTIPLIER
        grams ^= grams >> np.uint64(32)
    return _mix(grams), starts, counts


def _signatures(texts: list[str | None], bands: int, rows: int) -> list[np.ndarray | None]:
    grams, starts, _ = gram_hashes(texts)
    full = np.flatnonzero(starts[1:] > starts[:-1])
    out: list[np.ndarray | None] = [None] * len(texts)
    if not len(full):
        return out
    rng = np.random.default_rng(20240607)
    xor = rng.integers(0, 2**63, bands * rows, dtype=np.uint64)
    odd = rng.integers(0, 2**62, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    begin = starts[:-1][full]
    hashes = np.empty((bands, len(full)), np.uint64)
    for b in range(bands):
        acc = np.full(len(full), b + 1, np.uint64)
        for r in range(b * rows, (b + 1) * rows):
            acc = _mix(acc ^ np.minimum.reduceat((grams ^ xor[r]) * odd[r], begin))
        hashes[b] = acc
    for column, i in enumerate(full):
        out[i] = hashes[:, column].view(np.int64)
    return out


def _sign(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int) -> DataFrame:
    """``_key, id, copy, bands``: ``copy`` is the same for texts of the same words, bands is null without a word."""
    source = docs.select(row_key(id_col, text_col).alias("_key"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def sign(texts: list[str | None]) -> list[list]:
        copies = [hashlib.blake2b(b" ".join(t.lower().encode("utf-8", "surrogatepass").split()), digest_size=16).digest()
                  if t else None for t in texts]
        return [copies, _signatures(texts, bands, rows)]

    fields = [StructField("copy", BinaryType()), StructField("bands", ArrayType(LongType()))]
    return add_computed(source, ["text"], fields, lambda: sign, drop=["text"])


def jaccard_counts(grams: list[np.ndarray], others: list[np.ndarray] | None = None, threshold: float = THRESHOLD) -> np.ndarray:
    """Boolean matrix of the pairs of gram sets whose Jaccard similarity reaches ``threshold``.

    Sets against themselves, or against ``others``.  Common grams are counted
    by products of 0/1 matrices over a few thousand grams at a time."""
    rows = grams if others is None else grams + others
    sizes = np.array([len(g) for g in rows], np.float64)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(rows)), sizes.astype(np.int64))
    codes, _ = pd.factorize(flat)
    shared = np.bincount(codes, minlength=1)[codes] > 1
    codes, _ = pd.factorize(codes[shared])
    owner = owner[shared]
    order = np.argsort(codes, kind="stable")
    codes, owner = codes[order], owner[order]
    split = len(grams)
    common = np.zeros((split, len(rows) - (0 if others is None else split)), np.float32)
    step = 4096
    for low in range(0, int(codes[-1]) + 1 if len(codes) else 0, step):
        a, b = np.searchsorted(codes, [low, low + step])
        one = np.zeros((len(rows), step), np.float32)
        one[owner[a:b], codes[a:b] - low] = 1
        common += one[:split] @ (one if others is None else one[split:]).T
    right = sizes if others is None else sizes[split:]
    union = sizes[:split, None] + right[None, :] - common
    return common >= threshold * union - 1e-6


def radius(threshold: float) -> int:
    """Two texts of a home are linked for sure if their levels sum up to no more than this."""
    return math.floor((1 - threshold) * LEVELS + 1e-6)


def _verify(part: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """One block pair: per text its links (in documents and in texts) and the least text it is connected with.

    Pairs whose levels make them links for sure are left to :func:`sure_links`."""
    hashes, starts, _ = gram_hashes(part["text"].tolist())
    grams = [np.unique(hashes[starts[i]:starts[i + 1]]) for i in range(len(part))]
    same = part["x"].iloc[0] == part["y"].iloc[0]
    left = np.arange(len(part)) if same else np.flatnonzero((part["block"] == part["x"]).to_numpy())
    right = left if same else np.flatnonzero((part["block"] == part["y"]).to_numpy())
    linked = jaccard_counts([grams[i] for i in left], None if same else [grams[i] for i in right], threshold)
    if same:
        np.fill_diagonal(linked, False)
    home, _ = pd.factorize(part["home"])
    level = part["level"].to_numpy(np.float64, na_value=np.inf)
    linked &= (home[left][:, None] != home[right]) | (level[left][:, None] + level[right] > radius(threshold))
    n_docs = part["n_docs"].to_numpy()
    docs, texts = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
    docs[left] += linked @ n_docs[right]
    texts[left] += linked.sum(axis=1)
    if not same:
        docs[right] += linked.T @ n_docs[left]
        texts[right] += linked.sum(axis=0)
    label = np.arange(len(part))
    a, b = np.nonzero(linked)
    a, b = left[a], right[b]
    while len(a):  # least label over the links, then the label of the label
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            break
        label = new
    copies = part["copy"].tolist()
    found = np.flatnonzero(texts)
    return pd.DataFrame({"copy": [copies[i] for i in found], "docs": docs[found], "texts": texts[found],
                         "to": [copies[label[i]] for i in found]})


def _verified(rows: DataFrame, threshold: float) -> DataFrame:
    """All block pairs ``(x, y)`` of ``rows``, which come sorted by them; one pair is held at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            if not len(pdf):
                continue
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            place = pdf[["x", "y"]].to_numpy()
            starts = np.concatenate([[0], 1 + np.flatnonzero((place[1:] != place[:-1]).any(axis=1))])
            done = [_verify(pdf.iloc[a:b], threshold) for a, b in zip(starts[:-1], starts[1:])]
            if done:
                yield pd.concat(done, ignore_index=True)
            held = pdf.iloc[starts[-1]:]
        if held is not None:
            yield _verify(held, threshold)

    return rows.mapInPandas(run, "copy binary, docs long, texts long, to binary")


def candidate_blocks(texts: DataFrame, block: int = BLOCK, threshold: float = THRESHOLD,
                     levels: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(copy, home, level, block)`` of the texts that share a band hash, and the pairs ``(x, y)`` of blocks to compare, x <= y.

    ``texts`` is a materialized table ``copy, bands``.  A text's score is the
    number of texts in its buckets; its home is the text of the highest score in
    any of its buckets (ties: the greatest hash).  Homes of up to ``block`` texts
    move to the home where theirs lives if that is larger; homes of more than
    ``block`` texts are cut by the distance to the home and by the hash of the text:
    ``levels`` adds ``level``, that distance, to a materialized table ``copy, home``
    (without it, and in smaller homes, it is null).  Blocks are compared if a band
    hash has a text in each and their levels leave any pair undecided, so every
    pair of texts that share a band meets, once, or is decided by its levels.
    """
    reach, one = radius(threshold), F.count(F.lit(1)).alias("n")
    spread = texts.select("copy", F.explode("bands").alias("band"))
    buckets = materialize(spread.groupBy("band").agg(one).where("n > 1"), "minhash-buckets")
    shared = join_by_count(spread, buckets, "band", "n").groupBy("copy").agg(F.sum("n").alias("score"), F.collect_list("band").alias("bands"))
    shared = materialize(shared, "minhash-shared")
    scored = shared.select("copy", "score", F.explode("bands").alias("band"))
    leaders = materialize(scored.groupBy("band").agg(F.max(F.struct("score", "copy")).alias("lead"), one), "minhash-leaders")
    homes = materialize(join_by_count(scored.select("copy", "band"), leaders, "band", "n").groupBy("copy")
                        .agg(F.max("lead").alias("lead")).select("copy", F.col("lead.copy").alias("home")), "minhash-homes")
    sizes = materialize(homes.groupBy("home").agg(one), "minhash-sizes")
    lives = homes.select(F.col("copy").alias("home"), F.col("home").alias("next"))
    to = sizes.where(F.col("n") > block).select(F.col("home").alias("next"))
    moves = sizes.join(sizes.where(F.col("n") <= block).select("home").join(lives, "home").join(to, "next"), "home", "left")
    moves = materialize(moves.select("home", "n", F.coalesce("next", "home").alias("next")), "minhash-moves")
    moved = materialize(join_by_count(homes, moves, "home", "n").select("copy", F.col("next").alias("home")), "minhash-moved")
    ends = materialize(moved.groupBy("home").agg(one), "minhash-ends")
    sized = materialize(join_by_count(moved, ends, "home", "n"), "minhash-sized")
    large = sized.where(F.col("n") > block).select("copy", "home")
    large = levels(large) if levels else large.withColumn("level", F.lit(None).cast("long"))
    large = materialize(large.withColumn("step", F.concat_ws(":", F.hex("home"), "level")), "minhash-large")
    steps = large.groupBy("home", "level", "step").agg(one)
    before = F.sum("n").over(Window.partitionBy("home").orderBy("level")) - F.col("n")
    steps = materialize(steps.select("step", "n", F.floor(before / block).alias("run"), F.ceil(F.col("n") / block).alias("pieces")), "minhash-steps")
    piece = F.pmod(F.xxhash64("copy"), F.col("pieces").cast("long"))
    sure = F.coalesce(2 * F.col("level") <= reach, F.lit(False))
    members = join_by_count(large, steps, "step", "n").select("copy", "home", "level", F.xxhash64("home", sure, "run", piece).alias("block"))
    members = materialize(members.union(sized.where(F.col("n") <= block).select(
        "copy", "home", F.lit(None).cast("long").alias("level"), F.xxhash64("home").alias("block"))), "minhash-members")
    blocks = members.groupBy("block").agg(F.first("home").alias("home"), F.min("level").alias("lo"), F.max("level").alias("hi"), one) \
        .withColumn("sure", F.coalesce(2 * F.col("hi") <= reach, F.lit(False)))
    blocks = materialize(blocks, "minhash-blocks")
    places = shared.select("copy", F.explode("bands").alias("band")).join(members.select("copy", "block"), "copy").select("band", "block").distinct()
    places = materialize(places.join(blocks.drop("n"), "block"), "minhash-places")
    side = {e: places.select("band", *[F.col(c).alias(f"{e}_{c}") for c in ("block", "home", "lo", "hi", "sure")]) for e in "xy"}
    decided = F.expr(f"x_home = y_home AND coalesce(x_hi + y_hi <= {reach} OR x_lo - y_hi > {reach + 1} OR y_lo - x_hi > {reach + 1}, false)")
    some = side["x"].where("NOT x_sure").join(side["y"], "band").where("x_block < y_block OR x_block > y_block AND y_sure").where(~decided)
    # blocks of sure links meet those of other homes only: homes meet first, so blocks of one home make no pairs
    sure = places.where("sure").select("band", "home").distinct()
    apart = sure.withColumnRenamed("home", "x_home").join(sure.withColumnRenamed("home", "y_home"), "band").where("x_home < y_home")
    apart = apart.join(side["x"].where("x_sure"), ["band", "x_home"]).join(side["y"].where("y_sure"), ["band", "y_home"])
    meet = some.select("x_block", "y_block").union(apart.select("x_block", "y_block"))
    meet = meet.select(F.least("x_block", "y_block").alias("x"), F.greatest("x_block", "y_block").alias("y")).distinct()
    alone = blocks.where("n > 1 AND NOT sure").select(F.col("block").alias("x"), F.col("block").alias("y"))
    pairs = materialize(meet.union(alone), "minhash-pairs")
    discard(buckets, shared, leaders, homes, sizes, moves, moved, ends, sized, large, steps, blocks, places)
    return members, pairs


def _bodies(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``wanted`` (a materialized table with the row key ``at``) with the text of each key."""
    bodies = docs.select(row_key(id_col, text_col).alias("at"), F.col(text_col).alias("text"))
    if wanted.count() <= BROADCAST_ROWS:
        bodies = bodies.join(F.broadcast(wanted.select("at")), "at", "left_semi")
    return wanted.join(bodies.groupBy("at").agg(F.first("text").alias("text")), "at")  # a repeated row gives its text once


def _levels(near: DataFrame, docs: DataFrame, texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``copy, home`` with ``level``: the Jaccard distance of text and home in steps of 1 / ``LEVELS``, rounded up."""
    if near.isEmpty():
        return near.withColumn("level", F.lit(None).cast("long"))
    wanted = near.select("copy").union(near.select("home")).distinct().join(texts.select("copy", "at"), "copy")
    found = materialize(_bodies(docs, materialize(wanted, "jaccard-wanted"), id_col, text_col).select("copy", "text"), "jaccard-near")
    centers = near.groupBy("home").agg(F.count(F.lit(1)).alias("n")).join(found.toDF("home", "center"), "home")
    centers = materialize(centers, "jaccard-centers")
    rows = near.join(found, "copy")

    def measure(found: list[str], centers: list[str]) -> list[list]:
        at = {t: i for i, t in enumerate(dict.fromkeys(centers))}
        grams, starts, _ = gram_hashes([*at, *found])
        sets = [np.unique(grams[a:b]) for a, b in zip(starts[:-1], starts[1:])]
        out = []
        for text, center in zip(sets[len(at):], centers):
            other = sets[at[center]]
            common = len(np.intersect1d(text, other, assume_unique=True))
            out.append(math.ceil((1 - common / (len(text) + len(other) - common)) * LEVELS))
        return [out]

    rows = join_by_count(rows, centers, "home", "n").drop("n")
    return add_computed(rows, ["text", "center"], [StructField("level", LongType())], lambda: measure, drop=["text", "center"])


def sure_links(members: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``copy, docs, texts, to``: the links that levels decide, counted from sums per level, and the home, which is a link too."""
    reach = radius(threshold)
    near = members.where(F.col("level") <= reach).withColumn("step", F.concat_ws(":", F.hex("home"), "level"))
    steps = near.groupBy("home", "level", "step").agg(F.sum("n_docs").alias("docs"), F.count(F.lit(1)).alias("texts"))
    zero, asked = F.lit(0).cast("long"), F.lit(reach) - F.col("level")
    sums = steps.select("home", F.col("level").alias("place"), "docs", "texts", F.lit(None).cast("string").alias("step"), zero.alias("n")) \
        .union(steps.select("home", asked, zero, zero, "step", "texts"))
    upto = Window.partitionBy("home").orderBy("place").rangeBetween(Window.unboundedPreceding, 0)
    sums = sums.select("step", "n", F.sum("docs").over(upto).alias("docs"), F.sum("texts").over(upto).alias("texts")).where("step IS NOT NULL")
    itself = (2 * F.col("level") <= reach).cast("long")
    return join_by_count(near, materialize(sums, "jaccard-sums"), "step", "n").select(
        "copy", (F.col("docs") - itself * F.col("n_docs")).alias("docs"), (F.col("texts") - itself).alias("texts"), F.col("home").alias("to"))


def similarity_classes(docs: DataFrame, threshold: float = THRESHOLD, target_recall: float = TARGET_RECALL, block: int = BLOCK,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``_key, id, class_id, class_key, n_links, n_text_links, copies, copy``.

    ``n_links`` counts the other documents whose n-gram sets reach the
    threshold (copies among them), ``n_text_links`` the different texts;
    ``class_id`` is the least id of the documents connected by links; null and shared
    ids can give different classes one ``class_id``, but ``class_key`` (the least copy
    hash, in hex) is a class's own.  A document without a word (null, empty) has no
    links and is its own class; its ``class_key`` is null.
    Null ids come last in a class; equal rows get equal results.  Extra columns are ignored.
    """
    bands, rows = band_shape(threshold, target_recall)
    signed = materialize(_sign(docs, id_col, text_col, bands, rows), "minhash")
    full = signed.where("bands IS NOT NULL")
    texts = materialize(full.groupBy("copy").agg(
        F.count(F.lit(1)).alias("n_docs"), F.min("id").alias("least"), F.min("_key").alias("at"),
        F.first("bands").alias("bands")), "minhash-texts")
    placed, pairs = candidate_blocks(texts.select("copy", "bands"), block, threshold,
                                     lambda near: _levels(near, docs, texts, id_col, text_col))
    members = materialize(placed.join(texts.select("copy", "n_docs", "at"), "copy"), "jaccard-members")
    sides = pairs.select(F.explode(F.array_distinct(F.array("x", "y"))).alias("block"), "x", "y")
    rows = _bodies(docs, members, id_col, text_col).join(sides, "block")
    rows = rows.select("x", "y", "block", "copy", "home", "level", "n_docs", "text")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(partitions, "x", "y").sortWithinPartitions("x", "y", "copy")
    checked = materialize(_verified(rows, threshold).union(sure_links(members, threshold)), "jaccard-checked")
    links = checked.groupBy("copy").agg(F.sum("docs").alias("docs"), F.sum("texts").alias("texts"))
    classes = connected_components(checked.where("copy <> to").select(F.col("copy").alias("a"), F.col("to").alias("b")).distinct())
    member_of = materialize(texts.select("copy", "n_docs", "least").join(classes.withColumnRenamed("node", "copy"), "copy", "left")
                            .join(links, "copy", "left").withColumn("label", F.coalesce("label", "copy")), "jaccard-labels")
    least = materialize(member_of.groupBy("label").agg(F.min("least").alias("class_id"), F.count(F.lit(1)).alias("n")), "jaccard-least")
    by_text = materialize(join_by_count(member_of, least, "label", "n").select(
        "copy", "class_id", F.lower(F.hex("label")).alias("class_key"), (F.coalesce("docs", F.lit(0)) + F.col("n_docs") - 1).alias("n_links"),
        F.coalesce("texts", F.lit(0)).alias("n_text_links"), F.col("n_docs").alias("copies")), "jaccard-by-text")
    discard(texts, placed, pairs, members, checked, classes, member_of, least)
    worded = join_by_count(signed.where("bands IS NOT NULL").select("_key", "id", "copy"), by_text, "copy", "copies")
    columns = ["_key", "id", "class_id", "class_key", "n_links", "n_text_links", "copies", "copy"]
    zero = F.lit(0).cast("long")
    alone = signed.where("bands IS NULL").select(
        "_key", "id", F.col("id").alias("class_id"), F.lit(None).cast("string").alias("class_key"), zero.alias("n_links"),
        zero.alias("n_text_links"), F.lit(1).cast("long").alias("copies"), F.lit(None).cast("binary").alias("copy"))
    return worded.select(columns).union(alone)


def one_per_class(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each class: the one with the least id (then the least row key).

    Documents without a word are classes of their own and stay."""
    found = materialize(similarity_classes(docs, **options), "jaccard-classes")
    first = F.struct(F.col("id").isNull().alias("n"), F.col("id").alias("id"), F.col("_key").alias("k"))
    worded = found.where("copy IS NOT NULL")
    kept = worded.groupBy("class_key").agg(F.min(first).alias("f")).select(F.col("f.k").alias("_key"))
    keep = kept.withColumn("_worded", F.lit(True)).union(found.where("copy IS NULL").select("_key", F.lit(False)).distinct())
    rows = found.groupBy("_key").agg(F.count(F.lit(1)).alias("_rows"))
    keep = materialize(keep.join(rows, "_key").withColumn("_repeated", F.col("_worded") & (F.col("_rows") > 1)), "jaccard-keep")
    out = packed(docs, "doc_id", "text").withColumn("_key", row_key("doc_id", "text"))
    if keep.count() <= BROADCAST_ROWS:
        out = out.join(F.broadcast(keep.select("_key", "_repeated")), "_key")
    else:
        out = join_by_count(out, keep, "_key", "_rows")
    if not keep.where("_repeated").isEmpty():  # whole rows repeat: one of them stays
        out = out.where("NOT _repeated").union(out.where("_repeated").dropDuplicates(["_key"]))
    return unpacked(out, docs.columns)


def q_jaccard(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return similarity_classes(docs).select(F.col("id").alias("doc_id"), "class_id", "class_key", "n_links", "n_text_links", "copies")

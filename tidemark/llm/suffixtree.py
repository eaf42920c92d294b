"""Op 11: language-model scoring with a probabilistic suffix tree over words.

Symbols are words and one end per text.  A state is a context of up to
``MAX_CONTEXT`` symbols.  Candidates are the contexts and transitions whose share
of the training symbols is at least ``MIN_SHARE`` (the method's own least
probability, so a level of the tree never has more than 1 / MIN_SHARE of
them, whatever the corpus).  A context becomes a state where its next-symbol
distribution diverges from that of its longest shorter state by more than its
transitions cost.  Distributions are smoothed: every seen transition gives up ``DISCOUNT`` counts, and what
is given up or unlisted follows the shorter state.  A text is scored from the longest state at each position.

Word counts are exact and unbounded: texts are cut into blocks, a
block ships each of its words once, and gets its corpus count back.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DoubleType, LongType, StructField,
                               StructType)

from tidemark.llm.common import chunks, discard, keep_columns, materialize, table

MAX_CONTEXT = 3
MIN_SHARE = 1e-6
MIN_COUNT = 2
DISCOUNT = 0.5
#: Bytes of text whose words are counted together before they are shuffled.
BLOCK_BYTES = 8_000_000
#: Symbols whose n-grams are counted or scored together.
SYMBOLS_AT_ONCE = 1_000_000
#: The end of a text; no word is empty.
END = b""
_SHIFT = 31


def tokens(text: bytes | None) -> list[bytes]:
    """Words of the text, A-Z lower-cased, and the end (``bytes.split`` parts at the six ASCII white-space characters)."""
    return [*(text or b"").lower().split(), END]


def _planes(values: np.ndarray) -> bytes:
    """Small unsigned numbers byte by byte of their place, which compresses well."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _encode(docs: DataFrame, text_col: str) -> DataFrame:
    """One row per document: its other columns, block and codes; a block's first row lists its words and their training counts."""
    others = [c for c in docs.columns if c not in (text_col, "_held")]
    fields = [docs.schema[c] for c in others] + [
        StructField("_held", BooleanType()), StructField("_block", LongType()), StructField("_codes", BinaryType()),
        StructField("_words", ArrayType(BinaryType())), StructField("_counts", ArrayType(LongType()))]
    inner = StructType([StructField(f"c{i}", f.dataType) for i, f in enumerate(fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts, held = batch.column(batch.num_columns - 1).to_pylist(), batch.column(batch.num_columns - 2)
            for a, b in chunks(texts, BLOCK_BYTES):
                codes: dict[bytes, int] = {}
                by_doc = [np.array([codes.setdefault(t, len(codes)) for t in tokens(x)], np.uint32) for x in texts[a:b]]
                trained = [d for d, h in zip(by_doc, held.slice(a, b - a).to_pylist()) if not h]
                counts = np.bincount(np.concatenate(trained) if trained else np.zeros(0, np.int64), minlength=len(codes))
                rest = [None] * (b - a - 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(a, b - a) for i in range(batch.num_columns - 1)]
                    + [pa.array([block] * (b - a), pa.int64()), pa.array([_planes(d) for d in by_doc], pa.binary()),
                       pa.array([list(codes), *rest], pa.list_(pa.binary())), pa.array([counts.tolist(), *rest], pa.list_(pa.int64()))],
                    names=inner.fieldNames())
                block += 1

    rows = docs.select(*[F.col(f"`{c}`") for c in others], "_held", F.col(f"`{text_col}`").cast("binary"))
    return rows.toDF(*[f"c{i}" for i in range(len(rows.columns))]).mapInArrow(run, inner).toDF(*[f.name for f in fields])


@dataclass
class Tree:
    """The model.  Level d holds the d-grams of frequent symbols; ids are positions in sorted arrays."""

    total: int  # training tokens N
    distinct: int  # V
    least: int  # training count from which symbols, contexts and transitions are listed
    symbols: np.ndarray  # counts of the listed symbols, falling
    keys: list[np.ndarray] = field(default_factory=list)  # level d + 2: id of the first d + 1 symbols << 31 | id of the last d + 1
    counts: list[np.ndarray] = field(default_factory=list)
    own: list[np.ndarray] = field(default_factory=list)  # log10 probability of a gram's last symbol after its context
    states: list[np.ndarray] = field(default_factory=list)  # which contexts of d + 1 symbols are states
    escape: list[np.ndarray] = field(default_factory=list)  # log10 weight of the shorter state

    def root(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.total + 0.5 * (self.distinct + 1)))

    def grams(self, symbols: np.ndarray, doc: np.ndarray, upto: int) -> list[np.ndarray]:
        """Ids of the 1-, 2-, ... ``upto``-grams that start at each position (-1: not listed, or past the text's end)."""
        ids = [symbols]
        for d in range(2, upto + 1):
            left, right = ids[-1][:-1], ids[-1][1:]
            at = np.flatnonzero((left >= 0) & (right >= 0) & (doc[:-1][:len(left)] == doc[d - 1:d - 1 + len(left)]))
            found = np.full(len(left), -1, np.int64)
            keys = self.keys[d - 2]
            if len(keys) and len(at):
                k = (left[at] << _SHIFT) | right[at]
                place = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
                found[at] = np.where(keys[place] == k, place, -1)
            ids.append(found)
        return ids

    def learn(self) -> None:
        """States, transition probabilities and escape weights from the counted levels, shortest contexts first."""
        lower = self.root(self.symbols)  # log10 probability of a gram's last symbol after the states below its full context
        context = self.symbols
        for keys, n in zip(self.keys, self.counts):
            first, last, size = keys >> _SHIFT, keys & ((1 << _SHIFT) - 1), len(context)
            p = (n - DISCOUNT) / context[first]
            below = lower[last]
            listed, p_below = np.bincount(first, p, size), np.bincount(first, 10.0 ** below, size)
            branches = np.bincount(first, minlength=size)
            left, left_below = np.maximum(1 - listed, 1e-12), np.maximum(1 - p_below, 1e-12)
            escape = np.log10(left) - np.log10(left_below)
            gain = context * (np.bincount(first, p * (np.log10(p) - below), size) + left * escape) * math.log(10)
            state = (branches > 0) & (gain > 0.5 * branches * math.log(max(self.total, 2)))
            self.own.append(np.log10(p))
            self.states.append(state)
            self.escape.append(np.where(state, escape, 0.0))
            lower = np.where(state[first], np.log10(p), below)
            context = n

    def score(self, symbols: np.ndarray, counts: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """log10 probability of each symbol after the longest state before it."""
        now = self.root(counts)
        ids = self.grams(symbols, doc, len(self.own) + 1)
        for d, (own, state, escape) in enumerate(zip(self.own, self.states, self.escape), 1):
            size = len(now) - d
            if size <= 0 or not len(state):
                break
            context, gram = ids[d - 1][:size], ids[d][:size]
            # a gram id is -1 at a text's end, so the text of the context's start must be that of the symbol
            inside = (context >= 0) & (doc[:size] == doc[d:])
            at = np.flatnonzero(inside)
            at = at[state[context[at]]]
            listed = gram[at] >= 0
            now[at[~listed] + d] += escape[context[at[~listed]]]
            now[at[listed] + d] = own[gram[at[listed]]]
        return now


def _pieces(planes: list[bytes], at_once: int = SYMBOLS_AT_ONCE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of documents (from, to), their symbols in a row and the document of each."""
    for a, b in chunks(planes, 4 * at_once):
        parts = [_numbers(p) for p in planes[a:b]]
        yield a, b, np.concatenate(parts).astype(np.int64), np.repeat(np.arange(b - a), [len(p) for p in parts])


def _split(coded: np.ndarray, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """Listed symbols (else -1) and training counts from the stored numbers: 2 * symbol, or 2 * count + 1."""
    symbols = np.where(coded & 1, -1, coded >> 1)
    counts = coded >> 1
    at = symbols >= 0
    counts[at] = tree.symbols[symbols[at]]
    return symbols, counts


def _levels(texts: DataFrame, tree: Tree, max_context: int) -> None:
    """Count the 2-, 3-, ... grams of listed symbols in the training texts, keeping the frequent ones level by level."""
    for d in range(2, max_context + 2):
        shared = texts.sparkSession.sparkContext.broadcast(tree)

        def run(batches: Iterator[pa.RecordBatch], d=d) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in batches:
                for _, _, coded, doc in _pieces(batch.column(0).to_pylist()):
                    ids = own.grams(_split(coded, own)[0], doc, d - 1)[-1]
                    left, right, size = ids[:-1], ids[1:], len(ids) - 1
                    if size > 0:
                        at = np.flatnonzero((left >= 0) & (right >= 0) & (doc[:size] == doc[d - 1:d - 1 + size]))
                        k, n = np.unique((left[at] << _SHIFT) | right[at], return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(n)], names=["k", "n"])

        counted = texts.where(~F.col("_held")).select("_symbols").mapInArrow(run, "k long, n long") \
            .groupBy("k").agg(F.sum("n").alias("n")).where(F.col("n") >= tree.least)
        found = counted.toArrow()  # at most N / least <= 1 / MIN_SHARE rows
        k, n = found.column("k").to_numpy(), found.column("n").to_numpy()
        order = np.argsort(k)
        tree.keys.append(k[order])
        tree.counts.append(n[order])
        shared.unpersist()
        if not len(k):
            break


def _symbols(encoded: DataFrame, words: DataFrame, tree: Tree, frequent: np.ndarray) -> DataFrame:
    """The encoded texts with symbols in place of block codes, their token counts and base scores."""
    others = [c for c in encoded.columns if c not in ("_codes", "_words", "_counts")]
    fields = [encoded.schema[c] for c in others] + [
        StructField("_symbols", BinaryType()), StructField("_n", LongType()), StructField("_known", LongType()),
        StructField("_base", DoubleType())]
    inner = StructType([StructField(f"c{i}", f.dataType) for i, f in enumerate(fields)])
    order = np.argsort(frequent)
    shared = encoded.sparkSession.sparkContext.broadcast((frequent[order], order, tree))

    def run(docs: pa.Table, counts: pa.Table) -> pa.Table:
        keys, ids, own = shared.value
        code, c = counts.column("_code").to_numpy(), np.zeros(counts.num_rows, np.int64)
        c[code] = counts.column("_c").to_numpy()
        number = 2 * c + 1
        if len(keys):
            key = np.zeros(len(c), np.int64)
            key[code] = counts.column("_key").fill_null(0).to_numpy()
            listed = np.flatnonzero(c >= own.least)
            number[listed] = 2 * ids[np.searchsorted(keys, key[listed])]
        root, known = own.root(c), c > 0
        at = [_numbers(p) for p in docs.column(docs.num_columns - 1).to_pylist()]
        return pa.Table.from_arrays(docs.columns[:-1] + [
            pa.array([_planes(number[x]) for x in at], pa.binary()), pa.array([len(x) for x in at], pa.int64()),
            pa.array([int(known[x].sum()) for x in at], pa.int64()), pa.array([float(root[x].sum()) for x in at])],
            names=inner.fieldNames())

    left = encoded.select(*[F.col(f"`{c}`") for c in others], "_codes")
    left = left.toDF(*[f"c{i}" for i in range(len(left.columns))])
    met = left.groupBy(f"c{others.index('_block')}").cogroup(words.groupBy("_block"))
    return met.applyInArrow(run, inner).toDF(*[f.name for f in fields])


PRODUCED = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def fit_and_score(docs: DataFrame, held_out: Column, text_col: str = "text", max_context: int = MAX_CONTEXT,
                  min_share: float = MIN_SHARE) -> tuple[DataFrame, Tree]:
    """``docs`` without its text plus held_out, n_tokens, n_known, train_tokens, base_score and score; and the tree.

    Learns from the rows where ``held_out`` is false or null and scores all.  A null text
    is empty and consists of its end; repeated rows count and score as often as
    they occur.  Ties (equal counts) only order symbol numbers.  Nothing to learn from: all scores are those
    of unknown tokens in an empty corpus, log10 1 = 0.  Columns of ``docs`` with a produced name are replaced."""
    docs = keep_columns(docs, list(PRODUCED))
    rename = {c: f"_x{i}" for i, c in enumerate(docs.columns) if c != text_col}
    held = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in rename.items()], F.coalesce(held_out, F.lit(False)).alias("_held"),
                       F.col(f"`{text_col}`").alias("_text"))
    encoded = materialize(_encode(held, "_text"), "lm-encoded")
    # token counts stand in the length of the codes: four bytes each
    total = encoded.where(~F.col("_held")).agg(F.sum(F.octet_length("_codes"))).first()[0] or 0
    total //= 4
    least = max(MIN_COUNT, math.ceil(min_share * total))

    parts = encoded.where(F.col("_words").isNotNull()).select("_block", F.posexplode(F.arrays_zip("_words", "_counts")).alias("_code", "_w")) \
        .select("_block", "_code", F.col("_w._words").alias("_word"), F.col("_w._counts").alias("_n"))
    same = Window.partitionBy("_word")
    words = materialize(
        parts.withColumns({"_c": F.sum("_n").over(same), "_first": F.min("_block").over(same)}).select(
            "_block", "_code", "_c", F.when(F.col("_c") >= least, F.xxhash64("_word")).alias("_key"),
            (F.col("_first") == F.col("_block")).alias("_first")), "lm-words")
    own = words.where(F.col("_first") & (F.col("_c") > 0))
    distinct = own.count()
    top = own.where(F.col("_key").isNotNull()).select("_key", "_c").toArrow()  # at most N / least <= 1 / MIN_SHARE rows
    keys, counts = top.column("_key").to_numpy(), top.column("_c").to_numpy()
    order = np.lexsort((keys, -counts))
    tree = Tree(total, distinct, least, counts[order])

    texts = materialize(_symbols(encoded, words, tree, keys[order]), "lm-symbols")
    discard(encoded, words)
    _levels(texts, tree, max_context)
    tree.learn()
    return _scored(texts, tree, {n: c for c, n in rename.items()}), tree


def _scored(texts: DataFrame, tree: Tree, names: dict[str, str]) -> DataFrame:
    columns = [F.col(c).alias(n) for c, n in names.items()] + [
        F.col("_held").alias("held_out"), F.col("_n").alias("n_tokens"), F.col("_known").alias("n_known"),
        F.lit(tree.total).cast("long").alias("train_tokens"), F.col("_base").alias("base_score")]
    plain = texts.select(*columns, "_symbols")
    fields = plain.schema.fields[:-1] + [StructField("score", DoubleType())]
    inner = StructType([StructField(f"c{i}", f.dataType) for i, f in enumerate(fields)])
    shared = texts.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.num_columns - 1
            for a, b, coded, doc in _pieces(batch.column(last).to_pylist()):
                each = shared.value.score(*_split(coded, shared.value), doc)
                yield pa.RecordBatch.from_arrays([batch.column(i).slice(a, b - a) for i in range(last)]
                                                 + [pa.array(np.bincount(doc, each, b - a))], names=inner.fieldNames())

    return plain.toDF(*[f"c{i}" for i in range(len(plain.columns))]).mapInArrow(run, inner).toDF(*[f.name for f in fields])


def q_score(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1
    return fit_and_score(docs, fold)[0].select("doc_id", *PRODUCED)

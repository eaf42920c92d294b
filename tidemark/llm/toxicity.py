"""Op 5: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Training walks over a bounded sample of labelled documents with per-coordinate
learning rates; the L1 term keeps all but a few weights at exactly zero, so
the model is a short list that every executor gets as a broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField

from tidemark.llm.common import add_computed, chunks, keep_columns, materialize, table

BITS = 20
#: Labelled rows used for training (about; a hash of the id picks them, the same on every run).
TRAIN_ROWS = 20_000
EPOCHS = 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 20.0, 0.01
CUT = 0.7
_WORD = re.compile(r"[^\W\d_]+")


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """``(document, coordinate)`` pairs: words, word pairs and pairs that skip one word, hashed.

    Words are lower-cased runs of letters; pairs never cross documents."""
    words, counts = [], np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        if t:
            found = _WORD.findall(t.lower())
            counts[i] = len(found)
            words += found
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes, unique = pd.factorize(np.array(words, dtype=object))
    h = pd.util.hash_array(unique, categorize=False)[codes]
    doc = np.repeat(np.arange(len(texts)), counts)
    parts, docs = [h], [doc]
    for gap, salt in ((1, np.uint64(0x9E3779B97F4A7C15)), (2, np.uint64(0xC2B2AE3D27D4EB4F))):
        same = doc[:-gap] == doc[gap:]
        parts.append(((h[:-gap] * salt) ^ (h[gap:] + salt))[same])
        docs.append(doc[:-gap][same])
    mixed = np.concatenate(parts)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.concatenate(docs), (mixed >> np.uint64(64 - BITS)).astype(np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def train_ftrl(samples: list[tuple[np.ndarray, int]], epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Nonzero ``(coordinate, weight)`` after ``epochs`` passes; the last coordinate (2**BITS) is the bias.

    Both labels weigh the same in total, so the score of a balanced case is 0.5."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    positive = sum(y for _, y in samples)
    if not samples:
        return np.zeros(0, np.int64), np.zeros(0)
    weigh = {1: len(samples) / (2 * max(1, positive)), 0: len(samples) / (2 * max(1, len(samples) - positive))}

    def weights(at: np.ndarray) -> np.ndarray:
        w = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(z[at]) <= L1, 0.0, w)

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for k in order.permutation(len(samples)):
            at, y = samples[k]
            at = np.append(at, size - 1)
            w = weights(at)
            g = (_sigmoid(w.sum()) - y) * weigh[y]
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    at = np.flatnonzero(np.abs(z) > L1)
    return at, weights(at)


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> pd.DataFrame:
    """Nonzero weights (``at, weight``), learned from labelled rows whose crc32(doc_id as text) mod 3 is not 1.

    About ``train_rows`` different pairs of id and text by a hash of both, counted
    after the labels have met the texts (rows labelled toxic and not toxic count alike); a repeated row trains once.
    So the bound holds for the rows of the one task that learns, whatever one id holds.
    Features are made where the rows are; the walk itself runs in order of id and text hash.
    Null ids, null labels and null texts are left out; an id labelled twice
    takes its largest label, an id with several texts trains on each.
    """
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("y"))
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))
    texts = docs.where("text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text", F.xxhash64("text").alias("_text"))
    pairs = materialize(texts.select("doc_id", "_text").distinct().join(marks.where(fold != 1), "doc_id"), "toxic-pairs")
    place = F.pmod(F.xxhash64("doc_id", "_text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = materialize(pairs.where(place < F.lit(train_rows / max(1, pairs.count()))), "toxic-sample")
    # bounded by train_rows, hence the broadcast; equal rows are combined before they are shuffled
    picked = texts.join(F.broadcast(sample), ["doc_id", "_text"]).groupBy("doc_id", "_text").agg(F.first("text").alias("text"), F.first("y").alias("y"))

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            for a, b in chunks(texts):
                doc, at = features(texts[a:b])
                key = np.unique(doc * (1 << BITS) + at)
                cut = np.searchsorted(key >> BITS, np.arange(b - a + 1))
                lists = [(key[cut[i]:cut[i + 1]] & ((1 << BITS) - 1)).astype(np.int32) for i in range(b - a)]
                yield pd.DataFrame({c: pdf[c].iloc[a:b].to_numpy() for c in ("doc_id", "_text", "y")} | {"at": lists})

    samples = materialize(picked.mapInPandas(extract, "doc_id long, _text long, y int, at array<int>"), "toxic-samples")

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "_text"])
        at, w = train_ftrl([(np.asarray(a, np.int64), int(y)) for a, y in zip(pdf["at"], pdf["y"])])
        return pd.DataFrame({"at": at, "weight": w})

    return samples.withColumn("_one", F.lit(1)).groupBy("_one").applyInPandas(learn, "at long, weight double").toPandas()


def score(docs: DataFrame, model: pd.DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``score`` (0 to 1) and ``predicted``; a null or empty text has the score of the bias alone.

    Columns of ``docs`` with these names are replaced."""
    docs = keep_columns(docs, ["score", "predicted"])
    dense = np.zeros((1 << BITS) + 1, np.float32)
    dense[model["at"].to_numpy(np.int64)] = model["weight"].to_numpy()
    at = np.flatnonzero(dense)
    shared = docs.sparkSession.sparkContext.broadcast((at, dense[at]))

    def make():
        w = np.zeros((1 << BITS) + 1)
        w[shared.value[0]] = shared.value[1]

        def scored(texts: list[str | None]) -> list[np.ndarray]:
            doc, at = features(texts)
            used = w[at] != 0
            key = np.unique(doc[used] * (1 << BITS) + at[used])
            total = w[-1] + np.bincount(key >> BITS, weights=w[key & ((1 << BITS) - 1)], minlength=len(texts))
            p = _sigmoid(total)
            return [p, (p >= CUT).astype(np.int32)]

        return scored

    return add_computed(docs, [text_col], [StructField("score", DoubleType()), StructField("predicted", IntegerType())], make)


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    return score(docs, model).select("doc_id", F.coalesce(fold, F.lit(False)).alias("held_out"), "score", "predicted")

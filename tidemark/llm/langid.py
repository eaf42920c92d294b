"""Op 9: word-first language identification with character n-gram backoff.

A word known from training is scored by its log frequency in each language.  A
word no language knows is scored by its characters: from each position the
longest known n-gram, trying shorter ones in turn.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from tidemark.llm.common import add_computed, broadcast_if_small, chunks, keep_columns, materialize, table

#: Labelled documents per language used for training (about; a hash of the id picks them).
TRAIN_ROWS = 4_000
MAX_GRAM = 4
SMOOTHING = 0.5
#: Unknown words remembered by a worker between batches (a cache; it changes no result).
CACHE_WORDS = 200_000
_WORD = re.compile(r"[^\W\d_]+")


def _grams(word: str, n: int) -> list[str]:
    marked = f"^{word}$"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> pa.Table:
    """Counts, as an Arrow table ``(lang, kind, token, n, total)``; kind 0 is words, kind k the character k-grams.

    Learns from documents with a text, a language and an id whose
    crc32(doc_id as text) mod 4 is not 2; about ``train_rows`` per language.
    Every word and n-gram of these documents is in the model, so the sample alone bounds it; repeated rows count as
    often as they occur."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & (fold != 2)) \
        .select("doc_id", "lang", "text")
    per_lang = materialize(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("_all")), "lang-rows")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.join(broadcast_if_small(per_lang), "lang").where(place < F.lit(float(train_rows)) / F.col("_all"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a, b in chunks(pdf["text"].tolist()):
                for lang, part in pdf.iloc[a:b].groupby("lang"):
                    words = Counter(w for t in part["text"] for w in _WORD.findall(t.lower()))
                    found = [Counter() for _ in range(MAX_GRAM + 1)]
                    found[0] = words
                    for w, c in words.items():
                        for k in range(1, MAX_GRAM + 1):
                            for g in _grams(w, k):
                                found[k][g] += c
                    for k, counter in enumerate(found):
                        if counter:
                            yield pd.DataFrame({"lang": lang, "kind": k, "token": list(counter), "n": list(counter.values())})

    counts = sample.mapInPandas(count, "lang string, kind int, token string, n long") \
        .groupBy("lang", "kind", "token").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "lang-counts")
    totals = counts.groupBy("lang", "kind").agg(F.sum("n").alias("total"))
    return counts.join(totals, ["lang", "kind"]).toArrow()


def _tables(model: pa.Table) -> tuple[list[str], list[dict[str, int]], list[np.ndarray]]:
    """Languages, and per kind the row of each token and its log frequency in each language."""
    langs = sorted(pc.unique(model["lang"]).to_pylist())
    rows, logs = [], []
    for k in range(MAX_GRAM + 1):
        part = model.filter(pc.equal(model["kind"], k))
        coded = part["token"].combine_chunks().dictionary_encode()
        n, total = np.zeros((len(coded.dictionary), len(langs))), np.ones(len(langs))
        j = pc.index_in(part["lang"], pa.array(langs, pa.string())).to_numpy()
        n[coded.indices.to_numpy(), j] = part["n"].to_numpy()
        total[j] = part["total"].to_numpy()
        rows.append({t: i for i, t in enumerate(coded.dictionary.to_pylist())})
        logs.append(np.log(n + SMOOTHING) - np.log(total + SMOOTHING * max(1, len(n))))
    return langs, rows, logs


#: The tables of the model that a worker process used last, by the model's name: built once per process, not per task.
_BUILT: dict[str, tuple] = {}


def _built(name: str, shared: Broadcast) -> tuple:
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = _tables(shared.value)
    return _BUILT[name]


class _Scorer:
    def __init__(self, tables):
        self.langs, self.rows, self.logs = tables
        self.cache: dict[str, np.ndarray] = {}

    def backoff(self, word: str) -> np.ndarray:
        """Mean over positions of the longest known n-gram's log frequencies (zeros if nothing is known)."""
        marked, total, used = f"^{word}$", np.zeros(len(self.langs)), 0
        for i in range(len(marked)):
            for k in range(min(MAX_GRAM, len(marked) - i), 0, -1):
                at = self.rows[k].get(marked[i:i + k])
                if at is not None:
                    total += self.logs[k][at]
                    used += 1
                    break
        return total / used if used else total

    def word(self, word: str) -> np.ndarray:
        at = self.rows[0].get(word)
        if at is not None:
            return self.logs[0][at]
        found = self.cache.get(word)
        if found is None:
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            found = self.cache[word] = self.backoff(word)
        return found

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        words, counts = [], np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            if t:
                found = _WORD.findall(t.lower())
                if any(c.isalpha() for w in found for c in w):  # a run may be of other numerals only
                    counts[i] = len(found)
                    words += found
        names, scores = ["und"] * len(texts), np.zeros(len(texts))
        if not words or not self.langs:
            return names, scores
        codes, unique = pd.factorize(np.array(words, dtype=object))
        by_word = np.array([self.word(w) for w in unique])[codes]
        doc = np.repeat(np.arange(len(texts)), counts)
        total = np.stack([np.bincount(doc, weights=by_word[:, j], minlength=len(texts)) for j in range(len(self.langs))], axis=1)
        p = np.exp(total - total.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        for i in np.flatnonzero(counts):
            j = int(p[i].argmax())
            names[i], scores[i] = self.langs[j], p[i, j]
        return names, scores


def identify(docs: DataFrame, model: pa.Table, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score``, the posterior of the language named.

    ``und`` with score 0 for a null text, a text without a letter, and any text
    if nothing was learned; ties go to the first language by code point.  The
    model is bounded by the sample it was learned from, so it is broadcast.  Repeated rows get equal results.
    Columns of ``docs`` with these names are replaced."""
    docs = keep_columns(docs, ["lang_pred", "score"])
    shared, name = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    return add_computed(docs, [text_col], [StructField("lang_pred", StringType()), StructField("score", DoubleType())],
                        lambda: _Scorer(_built(name, shared)).predict)


def q_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.select("doc_id", "text", "lang"))
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    return identify(docs.select("doc_id", "text"), model) \
        .select("doc_id", F.coalesce(fold, F.lit(False)).alias("held_out"), "lang_pred", "score")

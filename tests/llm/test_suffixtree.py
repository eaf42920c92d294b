"""Suffix-tree scores against a plain version that follows the definitions, and the contract's base figures."""

import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import registry, suffixtree

SF001 = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string"
END = None


def split(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), END]


def fold(c="doc_id"):
    return F.pmod(F.crc32(F.col(c).cast("string").cast("binary")), F.lit(5)) == 1


class Plain:
    """The tree in dictionaries of tuples."""

    def __init__(self, train, max_context, min_share):
        self.grams = Counter()
        for t in train:
            for d in range(1, max_context + 2):
                self.grams.update(tuple(t[i:i + d]) for i in range(len(t) - d + 1))
        self.c = Counter(x for t in train for x in t)
        self.n, self.v = sum(self.c.values()), len(self.c)
        least = max(suffixtree.MIN_COUNT, math.ceil(min_share * self.n))
        self.listed = {g: n for g, n in self.grams.items() if n >= least and self.c[g[0]] >= least}
        self.escape, self.branches = {}, {}
        by_context = {}
        for g in self.listed:
            if len(g) > 1:
                by_context.setdefault(g[:-1], []).append(g)
        for s in sorted(by_context, key=len):
            p = {g: (self.listed[g] - suffixtree.DISCOUNT) / self.listed[s] for g in by_context[s]}
            below = {g: 10 ** self.log(s[1:], g[-1]) for g in p}
            left, left_below = max(1 - sum(p.values()), 1e-12), max(1 - sum(below.values()), 1e-12)
            gain = sum(q * math.log(q / below[g]) for g, q in p.items()) + left * math.log(left / left_below)
            if self.listed[s] * gain > 0.5 * len(p) * math.log(self.n):
                self.escape[s], self.branches[s] = math.log10(left / left_below), p

    def log(self, context, symbol):
        if not context:
            return math.log10((self.c[symbol] + 0.5) / (self.n + 0.5 * (self.v + 1)))
        if context in self.escape:
            p = self.branches[context].get((*context, symbol))
            return math.log10(p) if p else self.escape[context] + self.log(context[1:], symbol)
        return self.log(context[1:], symbol)

    def score(self, t, max_context):
        return sum(self.log(tuple(t[max(0, i - max_context):i]), x) for i, x in enumerate(t))


def hostile_rows():
    rng = random.Random(4)
    words = ["the", "The", "cat", "sat", "on", "a", "mat", "dog", "ran", "über", "Ünder", "x\x0by", "ß", " ", "\x1c", "end"]
    rows, state = [], 0
    for i in range(300):
        text = []
        for _ in range(rng.choice([0, 1, 3, 12, 40])):
            state = (state * 3 + 1 + (rng.random() < 0.3)) % len(words)
            text.append(words[state] if rng.random() < 0.9 else f"rare{rng.randrange(400)}")
        rows.append((i, rng.choice([" ", "\t", "\n ", "\r\n"]).join(text), "en"))
    same = "the cat sat on a mat " * 40
    return rows + [(1001, same, "en")] * 5 + [(2000, None, None), (2001, "", "en"), (None, "the cat sat", "en"), (None, None, None),
                                              (2002, "the mat " * 20_000, "en"), (2003, " \t\n", "en")]


@pytest.mark.parametrize("max_context,min_share", [(0, 1e-6), (1, 1e-6), (3, 1e-6), (2, 1e-3)])
def test_against_plain_version(spark, monkeypatch, max_context, min_share):
    monkeypatch.setattr(suffixtree, "BLOCK_BYTES", 2_000)  # many blocks share words
    rows = hostile_rows()
    docs = spark.createDataFrame(rows, DOCS)
    for c in ("score", "_held", "_block", "_text", "a.b"):
        docs = docs.withColumn(c, F.lit("mine"))
    got, tree = suffixtree.fit_and_score(docs.repartition(3), fold(), max_context=max_context, min_share=min_share)
    assert got.columns == ["doc_id", "lang", "_held", "_block", "_text", "a.b", *suffixtree.PRODUCED]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _, _ in rows]
    plain = Plain([split(t) for (_, t, _), h in zip(rows, held) if not h], max_context, min_share)
    assert tree.total == plain.n and tree.distinct == plain.v
    assert [int(s.sum()) for s in tree.states] == [sum(len(s) == d for s in plain.escape) for d in range(1, len(tree.states) + 1)]
    assert max_context == 0 or (plain.escape and tree.states[0].sum() > 3)
    want = []
    for (i, t, lang), h in zip(rows, held):
        x = split(t)
        base = sum(math.log10((plain.c[w] + 0.5) / (plain.n + 0.5 * (plain.v + 1))) for w in x)
        want.append((str(i), lang, h, len(x), sum(plain.c[w] > 0 for w in x), plain.n, base, plain.score(x, max_context)))
    have = [(str(r.doc_id), r.lang, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got.collect()]
    assert {r["_held"] for r in got.collect()} == {"mine"}
    key = lambda r: (r[0], r[3], r[6])
    for a, b in zip(sorted(have, key=key), sorted(want, key=key), strict=True):
        assert a[:6] == b[:6] and a[6] == pytest.approx(b[6], rel=1e-9, abs=1e-9) and a[7] == pytest.approx(b[7], rel=1e-7, abs=1e-7)


def test_distributions_sum_to_one():
    rng = random.Random(1)
    train = []
    for _ in range(60):
        t = ["a"]
        while len(t) < 50:
            t.append("abc"[("abc".index(t[-1][0]) + (rng.random() < 0.8)) % 3] + "x" * (rng.random() < 0.1))
        train.append([*t, END])
    plain = Plain(train, 2, 1e-6)
    assert plain.escape
    for s in plain.escape:
        mass = sum(10 ** plain.log(s, x) for x in plain.c) + 10 ** plain.log(s, "never seen")
        assert mass == pytest.approx(1, abs=1e-9)


def test_empty_and_all_held_out(spark):
    got, tree = suffixtree.fit_and_score(spark.createDataFrame([], DOCS), fold())
    assert got.collect() == [] and tree.total == 0
    got, _ = suffixtree.fit_and_score(spark.createDataFrame([(1, "a b", "en")], DOCS), F.lit(True))
    r = got.first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (True, 3, 0, 0, 0.0, 0.0)


def test_query_beats_the_base_on_held_out_texts(spark):
    rows = registry.QUERIES["op11_suffix_tree_score"](spark, SF001).collect()
    assert len(rows) == 200 and {r.train_tokens for r in rows} == {sum(r.n_tokens for r in rows if not r.held_out)}
    held = [r for r in rows if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.n_known == r.n_tokens for r in rows if not r.held_out) and all(r.score <= 0 for r in rows)

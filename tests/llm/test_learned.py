"""Learned operators against plain versions: FTRL's update rule, the training bound, language scores; private patterns by hand."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid, pii, toxicity

DOCS = "doc_id long, text string, lang string"


def test_ftrl_follows_the_published_update():
    rng = random.Random(3)
    samples = [(np.unique([rng.randrange(40) for _ in range(8)] + ([50] if i % 3 == 0 else [])), int(i % 3 == 0)) for i in range(300)]
    z, n, bias = Counter(), Counter(), 1 << toxicity.BITS
    positive = sum(y for _, y in samples)
    weigh = {1: len(samples) / (2 * positive), 0: len(samples) / (2 * (len(samples) - positive))}

    def weight(i):
        if abs(z[i]) <= toxicity.L1:
            return 0.0
        return -(z[i] - math.copysign(toxicity.L1, z[i])) / ((toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2)

    order = np.random.default_rng(7)
    for _ in range(toxicity.EPOCHS):
        for k in order.permutation(len(samples)):
            at, y = [*samples[k][0].tolist(), bias], samples[k][1]
            w = {i: weight(i) for i in at}
            p = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values())))))
            for i in at:
                g = (p - y) * weigh[y]
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / toxicity.ALPHA
                z[i] += g - sigma * w[i]
                n[i] += g * g
    at, w = toxicity.train_ftrl(samples)
    assert sorted(at.tolist()) == sorted(i for i in z if weight(i) != 0.0) and 50 in at.tolist()
    assert [pytest.approx(weight(i), rel=1e-6) for i in at.tolist()] == w.tolist()


def test_training_rows_are_bounded_whatever_one_id_holds(spark, monkeypatch):
    """The bound counts different pairs of id and text: copies train once, many texts of one id are sampled."""
    sizes, real = [], toxicity.materialize

    def counted(df, name):
        out = real(df, name)
        sizes.append((name, out.count()))
        return out

    monkeypatch.setattr(toxicity, "materialize", counted)
    one = next(i for i in range(2, 99) if zlib.crc32(str(i).encode()) % 3 != 1)
    labels = spark.createDataFrame([(one, 1), (one, 0), (one + 100, 0)], "doc_id long, toxic int")
    same = spark.range(3000).select(F.lit(one).cast("long").alias("doc_id"), F.lit("one text").alias("text"))
    toxicity.fit(same, labels, train_rows=10)
    assert dict(sizes)["toxic-samples"] == 1
    many = spark.range(3000).select(F.lit(one).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    sizes.clear()
    toxicity.fit(many, labels, train_rows=10)
    assert dict(sizes)["toxic-pairs"] == 3000 and dict(sizes)["toxic-samples"] <= 30
    assert toxicity.fit(same.limit(0), labels).empty and toxicity.fit(same, labels.limit(0)).empty


def plain_language(train, texts):
    langs = sorted({lang for _, lang in train})
    def words(t):  # noqa: E306
        return re.findall(r"[^\W\d_]+", t.lower())

    counts = [{lang: Counter() for lang in langs} for _ in range(langid.MAX_GRAM + 1)]
    for t, lang in train:
        for w in words(t):
            counts[0][lang][w] += 1
            for k in range(1, langid.MAX_GRAM + 1):
                counts[k][lang].update(f"^{w}$"[i:i + k] for i in range(len(w) + 3 - k))
    kinds = [set().union(*c.values()) for c in counts]

    def log(k, token, lang):
        c = counts[k][lang]
        return math.log(c[token] + langid.SMOOTHING) - math.log((sum(c.values()) or 1) + langid.SMOOTHING * max(1, len(kinds[k])))

    out = []
    for t in texts:
        found = words(t or "")
        if not any(c.isalpha() for w in found for c in w):
            out.append(("und", 0.0))
            continue
        total = dict.fromkeys(langs, 0.0)
        for w in found:
            if w in kinds[0]:
                used = [(0, w)]
            else:
                marked = f"^{w}$"
                longest = [next(((k, marked[i:i + k]) for k in range(min(langid.MAX_GRAM, len(marked) - i), 0, -1)
                                 if marked[i:i + k] in kinds[k]), None) for i in range(len(marked))]
                used = [x for x in longest if x]
            for lang in langs if used else []:
                total[lang] += sum(log(k, x, lang) for k, x in used) / len(used)
        top = max(total.values())
        p = {lang: math.exp(v - top) for lang, v in total.items()}
        best = max(langs, key=lambda lang: (p[lang], [-ord(c) for c in lang]))
        out.append((best, p[best] / sum(p.values())))
    return out


def test_language_against_plain_version(spark):
    rng = random.Random(8)
    stock = {"en": "the house stands near water while people walk", "de": "das haus steht beim wasser während leute gehen",
             "fr": "la maison est près de eau quand les gens marchent"}
    train = [(" ".join(rng.choices(stock[lang].split(), k=rng.randrange(1, 9))) + f" {rng.randrange(50)}x", lang) for lang in stock for _ in range(30)]
    train += [("once ²", "en"), ("m² x²", "fr"), ("_ 7 …", "de")]
    texts = [t for t, _ in train] + [None, "", "12 … _", "²", "m²", "x² y³", "houses wassers maisons", "Ж", "zzqqj", "THE Haus", "the " * 5000]
    ids = [i for i in range(10_000) if zlib.crc32(str(i).encode()) % 4 != 2]
    docs = spark.createDataFrame([(ids[i], t, lang) for i, (t, lang) in enumerate(train)], DOCS)
    model = langid.fit(docs, train_rows=10**6)
    rows = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)] * 2, DOCS).withColumn("lang_pred", F.lit("mine"))
    got = langid.identify(rows, model).collect()
    want = plain_language(train, texts)
    assert len(got) == 2 * len(want)
    for r in got:
        assert r.lang_pred == want[r.doc_id][0], texts[r.doc_id]
        assert r.score == pytest.approx(want[r.doc_id][1], abs=1e-9)
    named = {texts[r.doc_id]: r.lang_pred for r in got}
    assert named["m²"] != "und" and named["²"] == "und" == named["12 … _"]


def luhn(digits):
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def plain_private(text):
    def ok(kind, value):
        digits = re.sub("[^0-9]", "", value)
        return {"email": True, "ip": all(int(p) <= 255 for p in value.split(".")) if kind == "ip" else True,
                "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]

    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    return [(kind, m.start(), m.end()) for kind, p in patterns.items() for m in re.finditer(p, text or "") if ok(kind, m[0])]


def test_private_patterns_against_plain_version(spark):
    rng = random.Random(6)
    parts = ["a@b.c", "@", ".", "x.y@z-1.com", "1.2.3.4", "999.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (499) 555-6503", "+",
             "é", "\x01", "-", " ", "12", "_%", "..", "a", "𝛼", "0" * 20, "(", ")"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 14))) for _ in range(1500)] + [None, ""]
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], DOCS)
    for r in pii.find_private(docs).collect():
        want = plain_private(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for x, _, _ in want) for k in pii.KINDS], texts[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest(), texts[r.doc_id]


def test_private_positions_of_very_many_matches(spark):
    many = "a@b.cd, " * 100_000
    r = pii.find_private(spark.createDataFrame([(1, many, None)], DOCS)).first()
    assert r.n_email == 100_000 and r.n_spans == 100_000
    assert r.base_sha256 == hashlib.sha256(",".join(f"email:{8 * i}:{8 * i + 6}" for i in range(100_000)).encode()).hexdigest()


def plain_disclosing(texts, alpha, min_texts):
    """Flagged terms by the definition: shares over documents, evidence by different texts."""
    def entities(t):  # noqa: E306
        return {(k, re.sub("[^0-9]", "", t[a:b]) if k in ("card", "phone") else t[a:b].lower()) for k, a, b in plain_private(t)}

    def terms(t):
        return set(re.findall(r"[^\W\d_]{4,}", (t or "").lower()))

    holders, n_t, flagged = {}, Counter(w for t in texts for w in terms(t)), set()
    for t in texts:
        for e in entities(t or ""):
            holders.setdefault(e, []).append(t)
    for own in holders.values():
        for w in {w for t in own for w in terms(t)}:
            with_w = [t for t in own if w in terms(t)]
            if len(set(with_w)) >= min_texts and len(with_w) / n_t[w] >= min(1, len(own) / len(texts)) ** (1 - alpha):
                flagged.add(w)
    return flagged


def test_disclosing_terms_against_plain_version(spark):
    """A name a sentence away from an address is flagged, and masked throughout the corpus."""
    rng = random.Random(2)
    common = "these words stand anywhere and say nothing about anyone that writes letters".split()
    texts = [f"Agent Zarquon lives far. {' '.join(rng.choices(common, k=12))}. {' '.join(rng.choices(common, k=30))}: zar@deep.example.org" for _ in range(6)]
    texts += [f"{' '.join(rng.choices(common, k=20))} zarquon was seen, ZARQUON again", "mail zarquon@zarquon.org or Zarquon"]
    texts += [" ".join(rng.choices(common, k=25)) + f" number{i} call +1 (499) 555-650{i % 3}" for i in range(40)]
    texts += [" ".join(rng.choices(common, k=25)) for _ in range(300)] + [None, "", texts[0], texts[0]]
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r for r in pii.find_private(docs).collect()}
    flagged = plain_disclosing(texts, pii.ALPHA, pii.MIN_TEXTS)
    assert {"zarquon", "agent", "lives"} <= flagged and not flagged & set(common)
    for i, t in enumerate(texts):
        inside = plain_private(t)
        want = [(m.start(), m.end()) for m in re.finditer(r"[^\W\d_]{4,}", t or "") if m[0].lower() in flagged
                and not any(a < m.end() and m.start() < b for _, a, b in inside)]
        assert [(f["start"], f["end"]) for f in got[i].found if f["kind"] == "term"] == want, t
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert not any("zarquon" in (t or "").lower() for t in clean.values())
    assert clean[7] == "mail [EMAIL] or [TERM]"

"""Training-data operators: edge cases, planted cases, and plain versions of what SQL cannot say."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, decontam, htmltext, jaccard, langid, licenses, mixing, pii, quality, registry, sharding, toxicity
from tidemark.llm.graph import connected_components

SF001 = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(20_000)) + "."
EDGE = [
    (1, None, "en", "a", None), (2, "", None, None, 0), (3, " \n\t", "en", "a", 3), (None, "only words here.", "en", None, 1),
    (5, LONG, "en", "b", len(LONG)), (6, "same text " * 30, "en", "a", 300), (6, "same text " * 30, "en", "a", 300),
    (7, "same text " * 30, "de", "a", 300), (8, "1 2 3 …", "en", "c", 7),
]


def edge(spark):
    """Edge rows with extra columns named like the operators' own."""
    docs = spark.createDataFrame(EDGE, DOCS)
    for c in ("score", "size", "shard", "kept", "taken", "_key", "spans", "lang_pred", "n_words"):
        docs = docs.withColumn(c, F.lit("mine"))
    return docs


def empty(spark):
    return spark.createDataFrame([], DOCS)


def bench(spark):
    return spark.createDataFrame([(1, " ".join(LONG.split()[50:62])), (2, "only words HERE"), (None, None), (3, "")], "item_id long, text string")


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    got = registry.QUERIES[name](spark, SF001)
    want = con.execute(registry.SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(map(repr, (tuple(r) for r in got.select(*names).collect()))) == sorted(map(repr, want.fetchall()))


def test_quality_edges(spark):
    r = {x.doc_id: x for x in quality.judge_lines(edge(spark)).collect()}
    assert r[1].n_words == 0 and r[1].base_failed and not r[1].kept and r[1].clean_text == ""
    assert r[5].n_words == 20_000 and r[5].kept
    assert r[6].n_repeat_words == 60 and r[6].base_failed
    assert quality.judge_lines(empty(spark)).count() == 0
    lines = "Home | About | Contact\n" + "This is a line of prose that says something.\n" * 1 + " ".join(f"x{i}" for i in range(30)) + "."
    kept = quality.clean_documents(spark.createDataFrame([(1, lines, "en", "a", 1)], DOCS)).first()
    assert kept.text == lines.split("\n", 1)[1] and kept.n_chars == len(kept.text)


def test_html(spark):
    page = ('<html><body><nav>Menu</nav><div class="cookie-notice">We use cookies</div><article><h1>T&amp;C</h1><p><b>One\n two<br>'
            'three<p>Four<div class="ad">Buy</div><script>var x="</p>";</script></article><section id=comments>Hi</section>'
            '<footer>&copy; x</footer>')
    loose = "<body><div>Common words of the host</div><div><p>Body {}</p></div></body>"
    rows = [(1, "http://a.org/x", page), (2, None, None), (3, "bad url", ""), (1, "http://a.org/x", page)]
    rows += [(10 + i, f"http://b.org/{i}", loose.format(i)) for i in range(12)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("mine"))
    r = {x.page_id: x for x in htmltext.extract_text(pages).collect()}
    assert r[1].text == "T&C\nOne two three\nFour" and r[1].n_chars == len(r[1].text)
    assert r[2].text == "" and r[3].n_chars == 0
    assert r[15].text == "Body 5"  # what every page of the host says is template
    assert htmltext.extract_text(pages.limit(0)).count() == 0


def extracted(spark, pages):
    rows = [(i, url, html) for i, (url, html) in enumerate(pages)]
    return [r.text for r in htmltext.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("page_id").collect()]


def test_html_template_inside_main(spark):
    """Text that the host's pages repeat is template in an article too, and on hosts of a few pages; copies are no evidence."""
    page = "<article><p>Read more on our site</p><p>Story {} itself</p></article>"
    small = "<div>Site title</div><div>Story {} itself</div>"
    copies = "<nav>Menu {}</nav><article><p>The one story of this host</p></article>"
    got = extracted(spark, [("http://a.org/x", page.format(i)) for i in range(12)] + [("http://b.org/x", small.format(i)) for i in range(4)]
                    + [("http://c.org/x", copies.format(i)) for i in range(12)])
    assert got[:12] == [f"Story {i} itself" for i in range(12)] and got[12:16] == [f"Story {i} itself" for i in range(4)]
    assert got[16:] == ["The one story of this host"] * 12


def test_html_main_text_outside_main(spark):
    """A teaser's article or a form in main does not hide a main text in plain divs."""
    body = "The long main text number {} of this page stands in plain elements. " * 5
    teasers = f"<div><p>{body}</p></div><div class=latest><article><h3>Teaser {{}}</h3></article></div>"
    form = "<main><form><p>Your name</p></form></main><div><p>Body {}</p></div>"
    got = extracted(spark, [("http://a.org/x", teasers.format(*[i] * 6)) for i in range(4)] + [("http://b.org/x", form.format(i)) for i in range(4)])
    assert all(body.format(*[i] * 5).strip() in got[i] for i in range(4)) and got[4:] == [f"Body {i}" for i in range(4)]


def test_private(spark):
    near = [(100 + i, f"The agent Zarquon writes from zar@deep.example.org about topic{i}.", "en", "a", 1) for i in range(6)]
    noise = [(200 + i, f"Nothing about anyone, number {i}, is writes here about topics.", "en", "a", 1) for i in range(60)]
    base = [(300, "a@b.c_x@d.e 1.2.3.4.5.6.7.8 256.1.1.1 card 4111 1111 1111 1111 +1 (499) 555-6503", "en", "a", 1),
            (301, "w" * 50_000 + "1 2 " * 5_000 + "a.b" * 3_000, "en", "a", 1)]
    docs = spark.createDataFrame(EDGE + near + noise + base, DOCS)
    r = {x.doc_id: x for x in pii.find_private(docs).collect()}
    spans = r[300].spans
    assert spans == "email:0:5,email:5:11,ip:12:19,ip:20:27,card:43:62,phone:63:80"
    assert r[300].base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
    assert r[101].n_email == 1 and "term:10:17" in r[101].spans and "term:18:24" not in r[101].spans
    assert r[1].spans == "" and r[301].n_email == 0 and r[210].spans == ""
    assert pii.find_private(empty(spark)).count() == 0
    clean = pii.sanitise(docs.where("doc_id = 300")).first()
    assert clean.text == "[EMAIL][EMAIL] [IP].[IP] 256.1.1.1 card [CARD] [PHONE]"


def test_licenses(spark):
    mit = licenses.TEMPLATES["MIT-text"]
    edited = mit.replace("free of charge", "without any charge").upper()
    docs = spark.createDataFrame(EDGE + [(50, "Intro text.\n" + edited + "\nEnd.", "en", "a", 1),
                                         (51, "It was released. Under the sea lives the MIT.", "en", "a", 1),
                                         (52, "x " * 500 + "Licensed under CC BY-NC 4.0.", "en", "a", 1)], DOCS)
    r = {x.doc_id: x for x in licenses.scan_licenses(docs).collect()}
    assert r[50].licenses == "MIT-text" and r[50].best_coverage > 0.95 and r[50].spans.startswith("MIT-text:12:")
    assert r[51].n_licenses == 0 and r[1].spans == "" and r[5].n_licenses == 0
    assert r[52].spans == "CC-BY-NC-4.0:1000:1027:1.000"
    assert licenses.scan_licenses(empty(spark)).count() == 0


def test_licenses_of_one_family(spark):
    """A license takes no relative's name: a differing variant, version or name is no hit, and every template finds itself."""
    gpl, cc = licenses.TEMPLATES["GPL-3.0-notice"], licenses.TEMPLATES["CC-BY-4.0"]
    cases = [(cc.replace("Attribution", "Attribution-NonCommercial"), "CC-BY-NC-4.0-text"), (cc.replace("4.0", "3.0"), ""),
             (gpl.replace("GNU", "GNU Affero"), "AGPL-3.0-notice"), (gpl.replace("GNU", "GNU Lesser"), "LGPL-3.0-notice"),
             (gpl.replace("version 3", "version 4"), ""), (licenses.TEMPLATES["GPL-3.0"].replace("3", "2"), "GPL-2.0"),
             ("Licensed under the Apache License, Version 1.1", ""), ("Released under the BSD License", ""),
             ("Licensed under CC BY-NC-SA 4.0", ""), ("Licensed under one and the other or no third Apache License, Version 2.0", ""),
             *[(text, name) for name, text in licenses.TEMPLATES.items()]]
    docs = spark.createDataFrame([(i, f"Some words. {text}. More words.", "en", "a", 1) for i, (text, _) in enumerate(cases)], DOCS)
    got = {r.doc_id: r.licenses for r in licenses.scan_licenses(docs).collect()}
    assert {text: got[i] for i, (text, _) in enumerate(cases)} == dict(cases)


def test_toxicity(spark):
    docs = spark.createDataFrame([(i, f"plain words number {i} {'vile scum' if i % 4 == 0 else 'kind folk'} and so on", "en", "a", 1)
                                  for i in range(1200)] + EDGE[:5], DOCS)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(9, 1200)] + [(None, 1), (20, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert 0 < len(model) < 500
    r = toxicity.score(docs.withColumn("score", F.lit("mine")), model).collect()
    held = [x for x in r if x.doc_id and x.doc_id > 8 and zlib.crc32(str(x.doc_id).encode()) % 3 == 1]
    assert held and all(x.predicted == int(x.doc_id % 4 == 0) for x in held)
    assert all(0 <= x.score <= 1 for x in r)
    assert toxicity.score(empty(spark), toxicity.fit(empty(spark), labels)).count() == 0


def plain_classes(rows, threshold=0.8):
    sets = []
    for _, t in rows:
        w = (t or "").lower().encode().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        for j, n in Counter(j for g in s for j in holders[g] if j != i).items():
            if n / (len(s) + len(sets[j]) - n) >= threshold:
                links[i] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    return [(rows[i][0], min(groups[find(i)]), links[i]) for i in range(len(rows))]


def test_jaccard_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    text = "one two three four five six seven eight nine ten " * 3
    extra = [(90_000 + i, " ".join(f"t{j}" for j in range(300)) + f" end{i} x{i}") for i in range(30)]  # all near copies
    extra += [(95_000, text), (95_001, text.upper()), (95_002, "two words"), (95_003, "two  words"), (95_004, None), (95_005, "")]
    docs = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    want = plain_classes([(r.doc_id, r.text) for r in docs.collect()])
    got = jaccard.similarity_classes(docs, block=8)  # small blocks: classes span several
    assert sorted((r.id, r.class_id, r.n_links) for r in got.collect()) == sorted(want)


def test_jaccard_edges(spark):
    r = jaccard.similarity_classes(edge(spark))
    assert {(x.id, x.class_id, x.n_links) for x in r.collect()} >= {(6, 6, 2), (7, 6, 2), (1, 1, 0), (5, 5, 0)}
    kept = jaccard.one_per_class(spark.createDataFrame(EDGE, DOCS)).collect()
    assert sorted(str(x.doc_id) for x in kept) == ["1", "2", "3", "5", "6", "8", "None"]
    assert jaccard.one_per_class(empty(spark)).count() == 0
    bands, rows = jaccard.band_shape(0.8, 0.999)
    assert bands * rows <= 128 and 1 - (1 - 0.8**rows) ** bands >= 0.999


def test_classes_of_null_and_shared_ids(spark):
    """Unrelated documents stay, whatever their ids: a class is known by its texts, not by an id."""
    text = [" ".join(f"t{k}w{i}" for i in range(30)) for k in range(6)]
    rows = [(None, text[0]), (None, text[1]), (None, text[2]), (None, text[2]), (7, text[3]), (7, text[4]), (7, text[5]),
            (None, text[5].upper()), (None, None), (7, "")]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], DOCS)
    kept = [(x.doc_id, x.text) for x in jaccard.one_per_class(docs).collect()]
    assert sorted(kept, key=repr) == sorted([*rows[:3], *rows[4:7], *rows[8:]], key=repr)
    r = jaccard.similarity_classes(docs).collect()
    worded = [x for x in r if x.class_key is not None]
    assert len(worded) == 8 and len({x.class_key for x in worded}) == 6 and sum(x.n_links for x in r) == 4


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 95), (7, 7)], "a int, b int")
    got = {r.node: r.label for r in connected_components(edges).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {90: 90, 95: 90, 100: 90}


def test_components_of_hubs(spark, monkeypatch):
    """Frequent nodes and keys take the broadcast way; results are those of the shuffled one."""
    monkeypatch.setattr(common, "HOT_ROWS", 3)
    edges = spark.createDataFrame([(1, i) for i in range(2, 40)] + [(i, 500) for i in range(100, 140)] + [(39, 100), (700, 701)], "a int, b int")
    got = {r.node: r.label for r in connected_components(edges).collect()}
    assert got == {i: 1 for i in [*range(1, 40), *range(100, 140), 500]} | {700: 700, 701: 700}


def test_join_by_count(spark, monkeypatch):
    left = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 1), ("b", 2), ("c", 3), (None, 4)], "k string, v int")
    right = spark.createDataFrame([("a", "x", 50), ("b", "y", 2), ("d", "z", 0)], "k string, w string, n long")
    for how in ("inner", "left"):
        want = sorted(map(repr, left.join(right, "k", how).collect()))
        monkeypatch.setattr(common, "HOT_ROWS", 10)
        assert sorted(map(repr, common.join_by_count(left, right, "k", "n", how).collect())) == want
        monkeypatch.undo()
        assert sorted(map(repr, common.join_by_count(left, right, "k", "n", how).collect())) == want
    assert common.join_by_count(left, right.limit(0), "k", "n").count() == 0


def test_chain_of_loosely_similar_texts_compares_candidates_only(spark):
    """Each text shares half of its grams with the next: one component of shared bands, but few pairs are compared."""
    n = 400
    texts = [(i, " ".join(f"w{j}" for j in range(i * 20, i * 20 + 60))) for i in range(n)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    signed = jaccard._sign(docs, "doc_id", "text", *jaccard.band_shape(0.8, 0.999)).select("copy", "bands")
    members, pairs = jaccard.candidate_blocks(signed, 8)
    block = {bytes(r.copy): r.block for r in members.collect()}
    size = Counter(block.values())
    met = {(r.x, r.y) for r in pairs.collect()}
    assert all(x <= y for x, y in met) and len(met) == pairs.count()
    compared = sum(size[x] * (size[x] - 1) // 2 if x == y else size[x] * size[y] for x, y in met)
    assert 0 < compared < 5 * n
    bands = {bytes(r.copy): set(r.bands) for r in signed.collect()}
    for a, b in itertools.combinations(sorted(bands), 2):
        if bands[a] & bands[b]:
            assert tuple(sorted((block[a], block[b]))) in met
    assert all(r.n_links == 0 for r in jaccard.similarity_classes(docs).collect())


def near_copies(n, words=300, heavy=4, seed=3):
    """Texts with one or two words changed, some with ``heavy`` to eight, and copies of some of them."""
    rng = random.Random(seed)
    base = [f"t{j}" for j in range(words)]
    texts = [" ".join(base)]
    for i in range(n):
        new = base[:]
        for k in rng.sample(range(words), rng.randint(heavy, 8) if heavy and i % 10 == 0 else rng.randint(1, 2)):
            new[k] = f"n{i}x{k}"
        texts.append(" ".join(new))
    return [(i, t) for i, t in enumerate(texts + texts[1:n // 4])]


def test_group_of_near_copies_against_all_pairs(spark):
    """Links that levels decide, links that blocks decide, and copies: each is counted once."""
    for rows in (near_copies(120), near_copies(60, 70, 2), near_copies(90, heavy=0)):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = jaccard.similarity_classes(docs, block=8)
        assert sorted((r.id, r.class_id, r.n_links) for r in got.collect()) == sorted(plain_classes(rows))


def test_near_copies_are_shipped_with_their_number(spark, monkeypatch):
    """Four times the near copies: the rows that meet in blocks do not grow with the square."""
    shipped, find = [], jaccard.candidate_blocks

    def watched(*args, **kwargs):
        members, pairs = find(*args, **kwargs)
        size = Counter(r.block for r in members.collect())
        shipped.append(sum(size[r.x] + (size[r.y] if r.x != r.y else 0) for r in pairs.collect()))
        return members, pairs

    monkeypatch.setattr(jaccard, "candidate_blocks", watched)
    for n in (150, 600):
        rows = near_copies(n, heavy=0)
        found = jaccard.similarity_classes(spark.createDataFrame(rows, "doc_id long, text string"), block=8).collect()
        assert all(r.class_id == 0 and r.n_links == len(rows) - 1 for r in found)
    assert shipped[0] < 4 * 150 and shipped[1] < 4 * 600


def test_small_homes_move_to_a_large_one(spark):
    """Texts far from a large group's center, but like its texts, are no blocks of their own against all of its blocks."""
    signed = [(bytes([0, i]), [1, 100 + i]) for i in range(40)]  # one bucket of 40
    signed += [(bytes([1, i]), [100 + i]) for i in range(10)]  # each shares a bucket with one of the 40 only
    texts = spark.createDataFrame(signed, "copy binary, bands array<long>")
    members, pairs = jaccard.candidate_blocks(texts, 8)
    block = {bytes(r.copy): r.block for r in members.collect()}
    met = {(r.x, r.y) for r in pairs.collect()}
    assert len(block) == 50 and len(set(block.values())) <= 7
    for (a, x), (b, y) in itertools.combinations(signed, 2):
        assert not set(x) & set(y) or tuple(sorted((block[a], block[b]))) in met


def test_shards(spark):
    r = sharding.assign_shards(edge(spark), block_rows=1).collect()
    assert all(x.grown_shard in (x.shard, 40) and x.law == "key" for x in r)
    slots = defaultdict(list)
    for x in r:
        slots[x.shard].append(x.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {x["size"] for x in r if x.doc_id == 1} == {16} and {x.text_crc32 for x in r if x.doc_id == 1} == {0}
    assert sharding.assign_shards(empty(spark)).count() == 0


def test_decontamination_edges(spark):
    docs = edge(spark)
    r = {x.doc_id: x for x in decontam.find_contamination(docs, bench(spark)).collect()}
    assert r[5].n_hit == 12 and r[5].n_items == 1 and r[5].items_sha256 == hashlib.sha256(b"1").hexdigest()
    assert r[None].n_hit == 3 and r[1].n_words == 0 and not r[6].contaminated
    assert sorted(str(x.doc_id) for x in decontam.decontaminate(docs, bench(spark)).collect()) == ["1", "2", "3", "6", "6", "7", "8"]
    assert decontam.find_contamination(empty(spark), bench(spark)).count() == 0
    assert decontam.find_contamination(docs, bench(spark).limit(0)).where("contaminated").count() == 0


def test_language(spark):
    words = {"en": "the house stands near water", "de": "das haus steht beim wasser", "fr": "la maison est pres eau"}
    docs = spark.createDataFrame([(i, f"{words[lang]} {i}", lang, "a", 1) for i in range(300) for lang in [sorted(words)[i % 3]]], DOCS)
    model = langid.fit(docs)
    r = {x.doc_id: x for x in langid.identify(docs.unionByName(spark.createDataFrame(
        EDGE + [(900, "houses standing", None, "a", 1)], DOCS)), model).collect()}
    assert all(r[i].lang_pred == sorted(words)[i % 3] and 0 <= r[i].score <= 1 for i in range(9, 300))
    assert r[8].lang_pred == "und" and r[1].lang_pred == "und" and r[900].lang_pred == "en"
    assert langid.identify(empty(spark), langid.fit(empty(spark))).count() == 0


def test_mix(spark):
    rows = [(i, "w " * (1 + i % 7), "en", ["big", "mid", "tiny", None][min(3, (i * i) % 11 // 3)], 1) for i in range(400)]
    docs = spark.createDataFrame(rows + EDGE[:2] + [rows[5]], DOCS)
    r = mixing.mix(docs, block_rows=7).collect()
    assert len(r) == 403
    size, target, taken = {}, {}, Counter()
    for x in r:
        size[x.source], target[x.source] = x.source_size, x.target
        taken[x.source] += x.taken
        assert 0 <= x.taken <= 3 * x["size"]
    assert all(taken[s] == int(target[s]) and target[s] <= 3 * size[s] for s in size)
    assert abs(sum(target.values()) - sum(size.values())) < 1e-6
    again = mixing.mix(docs.orderBy(F.desc("doc_id")), block_rows=50).collect()
    assert sorted(map(str, r)) == sorted(map(str, again))
    assert mixing.mix(empty(spark)).count() == 0 and mixing.mixed_documents(empty(spark)).count() == 0


def test_other_columns_pass_through(spark):
    """Large ids beside nulls, nested types, and extra columns named like helper columns come back unchanged."""
    big = 2**62 + 1
    text = " ".join(f"u{i}" for i in range(40)) + "."
    docs = spark.createDataFrame([(None, text, "en", "a", 1), (big, text + " And another line of words.", "en", None, None)], DOCS)
    names = ("score", "size", "rank", "weight", "kept", "taken", "_key", "_rest", "_blk", "copy", "_repeated", "clean_text", "none", "a.b")
    for c in names:
        docs = docs.withColumn(c, F.lit("mine"))
    docs = docs.withColumn("many", F.array(F.struct(F.lit(big).alias("x"), F.lit(None).cast("date").alias("d"))))
    model = toxicity.fit(empty(spark), spark.createDataFrame([], "doc_id long, toxic int"))
    tables = {
        "clean": quality.clean_documents(docs), "one": jaccard.one_per_class(docs, threshold=0.99),
        "mixed": mixing.mixed_documents(docs), "decontaminated": decontam.decontaminate(docs, bench(spark)),
        "sanitised": pii.sanitise(docs), "languages": langid.identify(docs, langid.fit(empty(spark))),
        "toxicity": toxicity.score(docs, model), "licenses": licenses.scan_licenses(docs), "lines": quality.judge_lines(docs),
    }
    assert all(tables[t].columns == docs.columns for t in ("clean", "one", "mixed", "decontaminated", "sanitised"))
    for t, out in tables.items():
        got = out.collect()
        assert {r.doc_id for r in got} == {None, big}, t
        produced = {"languages": {"score"}, "toxicity": {"score"}, "lines": {"kept", "clean_text"}}.get(t, set())
        assert all(r[c] == "mine" for r in got for c in names if c not in produced), t
        assert all(r.many[0].x == big and r.many[0].d is None for r in got), t
    classes = {r.id: r.class_id for r in jaccard.similarity_classes(docs, threshold=0.99).collect()}
    assert classes == {None: None, big: big}

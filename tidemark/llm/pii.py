"""Op 3: information-theoretic sanitisation, in SQL expressions.

Protected entities are the e-mail addresses, IP addresses, card and phone
numbers that fixed patterns find.  The corpus then tells which other terms reveal
one of them: a term ``t`` of a document with entity ``e`` discloses it when its
pointwise mutual information with ``e`` reaches ``ALPHA`` of the information
``e`` itself carries, that is ``n(e,t) / n(t) >= (n(e) / N) ** (1 - ALPHA)`` over the
documents of the whole corpus, wherever in them the two stand.  Every occurrence of such a term
is masked, in documents without the entity too, where it still tells of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, materialize, packed, row_key, table, unpacked

#: Share of an entity's information content that a term may not disclose.
ALPHA = 0.9
#: A pair of entity and term is evidence from this many different texts on: fewer shared texts may be chance.
MIN_TEXTS = 3
#: A term: a run of at least four letters.
TERM = r"\p{L}{4,}"
#: Matches numbered together; positions cost n * BLOCK / 2 + (n / BLOCK) ** 2 / 2 copies for n matches.
BLOCK = 256

KINDS = ("email", "ip", "card", "phone")
_LOCAL, _LABEL = r"[A-Za-z0-9._%+\x01-]", r"[A-Za-z0-9-]"
# Dots inside a domain and separators inside a card stand as \x01 when these run, so no pattern needs a
# repeated group (Java recurses on those); a start inside a run can only follow the end of a match.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++\x01[A-Za-z0-9\x01-]++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9][0-9\x01]{15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_MATCH = "array<struct<start:bigint,end:bigint,value:string>>"


def _found(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches: start and end in code points, and value.

    Positions are running sums of the lengths of matches and of the pieces between them: inside blocks of
    matches first, then the blocks are moved by what precedes them, so a text of very many matches stays cheap."""
    zero = F.lit(0).cast("bigint")

    def block(values: Column, pieces: Column, first: Column) -> Column:
        def add(acc: Column, i: Column) -> Column:
            start = acc["at"] + F.length(pieces[i])
            end = start + F.length(values[i])
            one = F.struct(start.alias("start"), end.alias("end"), values[i].alias("value"))
            return F.struct(end.alias("at"), F.concat(acc["list"], F.array(one)).alias("list"))

        last = F.least(first + BLOCK, F.size(values)) - 1
        return F.aggregate(F.sequence(first, last), F.struct(zero.alias("at"), F.array().cast(_MATCH).alias("list")), add)

    def move(acc: Column, b: Column) -> Column:
        moved = F.transform(b["list"], lambda m: F.struct(
            (m["start"] + acc["at"]).alias("start"), (m["end"] + acc["at"]).alias("end"), m["value"].alias("value")))
        return F.struct((acc["at"] + b["at"]).alias("at"), F.concat(acc["list"], F.array(moved)).alias("list"))

    def build(values: Column, pieces: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.size(values) - 1, F.lit(BLOCK)), lambda first: block(values, pieces, first))
        none = F.struct(zero.alias("at"), F.array().cast(f"array<{_MATCH}>").alias("list"))
        return F.aggregate(blocks, none, move, lambda s: F.flatten(s["list"]))

    both = F.array(F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("v"), F.split(text, pattern, -1).alias("p")))
    return F.flatten(F.transform(F.filter(both, lambda x: F.size(x["v"]) > 0), lambda x: build(x["v"], x["p"])))


def _luhn(digits: Column) -> Column:
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)), F.lit(0),
        lambda acc, i: acc + F.element_at(
            F.when(i % 2 == 0, F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]))
            .otherwise(F.array(*[F.lit(x) for x in range(10)])),
            F.substring(digits, -i, F.lit(1)).cast("int") + 1))
    return total % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def base_matches(text: Column) -> dict[str, Column]:
    """Per kind the valid matches of a text (an array, empty for null)."""
    plain = F.when(F.contains(text, F.lit("\x01")), F.translate(text, "\x01", "\x02")).otherwise(text)
    dotted = F.regexp_replace(plain, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", "\x01")
    joined = F.regexp_replace(plain, r"(?<=[0-9])[\x20-](?=[0-9])", "\x01")
    none = F.array().cast(_MATCH)
    card = F.filter(_found(joined, PATTERNS["card"]),
                    lambda m: F.length(_digits(m["value"])).between(16, 19) & _luhn(_digits(m["value"])))
    phone = F.filter(_found(plain, PATTERNS["phone"]), lambda m: F.length(_digits(m["value"])).between(8, 15))
    ip = F.filter(_found(plain, PATTERNS["ip"]), lambda m: F.rlike(m["value"], F.lit(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")))
    return {
        "email": F.when(F.contains(text, F.lit("@")), _found(dotted, PATTERNS["email"])).otherwise(none),
        "ip": F.when(F.rlike(text, F.lit(r"[0-9]\.[0-9]++\.[0-9]")), ip).otherwise(none),
        "card": F.when(F.rlike(text, F.lit(r"[0-9](?:[\x20-]?[0-9]){15}")), card).otherwise(none),
        "phone": F.when(F.contains(text, F.lit("+")), phone).otherwise(none),
    }


def _spans(matches: Column, kind: str) -> Column:
    return F.transform(matches, lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _distinct_terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def find_private(docs: DataFrame, alpha: float = ALPHA, min_texts: int = MIN_TEXTS) -> DataFrame:
    """One row per document: ``_key, doc_id``, the counts, base_sha256, spans, n_spans and ``found`` (array of kind, start, end).

    A null text has no spans.  Rows equal in id and text get equal results.
    All counts run over every document.  Pairs of entity and term are made once per different text, of
    entities and terms that ``min_texts`` different texts hold; a term inside a base span is part of that.
    Extra columns are ignored.
    """
    rows = docs.select("doc_id", row_key("doc_id", "text").alias("_key"), F.xxhash64("text").alias("_text"), F.col("text"))
    rows = rows.select("doc_id", "_key", "_text", *[m.alias(k) for k, m in base_matches(F.col("text")).items()])
    rows = materialize(rows, "pii-matches")
    base = rows.select("doc_id", "_key", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
                       F.concat(*[_spans(F.col(k), k) for k in KINDS]).alias("base"))
    terms = materialize(disclosing_terms(docs, rows, alpha, min_texts), "pii-disclosing")
    out = base.join(_occurrences(docs, base, terms), "_key", "left")
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    out = out.withColumn("found", F.concat("base", _spans(F.coalesce(F.col("terms"), none), "term")))
    return out.select("_key", "doc_id", *[f"n_{k}" for k in KINDS],
                      F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"),
                      F.size("found").cast("long").alias("n_spans"), "found")


def disclosing_terms(docs: DataFrame, rows: DataFrame, alpha: float, min_texts: int) -> DataFrame:
    """``(term)``: terms whose mutual information with some entity is too high, by counts over all documents.

    ``rows`` holds the matches of each document.  Copies of a text count as documents but are one piece of evidence, and are
    combined before terms and entities meet."""
    found = None
    for k in KINDS:
        value = F.lower(F.translate(F.col("m.value"), "\x01", ".")) if k == "email" else (
            F.col("m.value") if k == "ip" else _digits(F.col("m.value")))
        part = rows.select("_key", "_text", F.explode(k).alias("m")).select("_key", "_text", F.xxhash64(F.lit(k), value).alias("entity"))
        found = part if found is None else found.union(part)
    by_text = materialize(found.distinct().groupBy("entity", "_text").agg(F.count(F.lit(1)).alias("w")), "pii-entities")
    strong = by_text.groupBy("entity").agg(F.sum("w").alias("n_e"), F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= min_texts)
    holders = materialize(by_text.join(strong.select("entity", "n_e"), "entity"), "pii-holders")

    texts = docs.select(F.xxhash64("text").alias("_text"), "text").join(
        broadcast_if_small(materialize(holders.select("_text").distinct(), "pii-texts")), "_text", "left_semi")
    held = materialize(texts.select("_text", F.explode(_distinct_terms(F.col("text"))).alias("term")).distinct(), "pii-held")
    common = held.groupBy("term").agg(F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= min_texts).select("term")
    pairs = held.join(common, "term").join(holders, "_text").groupBy("entity", "n_e", "term") \
        .agg(F.sum("w").alias("n_et"), F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= min_texts)
    pairs = materialize(pairs, "pii-pairs")

    wanted = broadcast_if_small(materialize(pairs.select("term").distinct(), "pii-wanted"))
    counts = docs.select(F.explode(_distinct_terms(F.col("text"))).alias("term")).join(wanted, "term", "left_semi") \
        .groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    share = F.col("n_et") / F.greatest("n_t", "n_et")
    limit = F.pow(F.least(F.lit(1.0), F.col("n_e") / F.lit(max(1, rows.count()))), F.lit(1 - alpha))
    return pairs.join(counts, "term").where(share >= limit).select("term").distinct()


def _occurrences(docs: DataFrame, base: DataFrame, terms: DataFrame) -> DataFrame:
    """``(_key, terms)``: where the terms stand in the documents, outside the base spans.

    Only documents with a term are searched, each for its own terms, so the rows made are occurrences of terms."""
    terms = broadcast_if_small(terms)
    texts = docs.select(row_key("doc_id", "text").alias("_key"), "text")
    hits = materialize(texts.select("_key", F.explode(_distinct_terms(F.col("text"))).alias("term"))
                       .join(terms, "term", "left_semi").groupBy("_key").agg(F.collect_set("term").alias("flagged")), "pii-hits")
    hits = broadcast_if_small(hits)
    own = F.filter(_found(F.col("text"), TERM), lambda m: F.array_contains("flagged", F.lower(m["value"])))
    at = texts.join(hits, "_key").select("_key", F.explode(own).alias("m")) \
        .select("_key", "m.start", "m.end", F.lit(False).alias("base"))
    spans = base.join(hits, "_key", "left_semi").select("_key", F.explode("base").alias("b")) \
        .select("_key", "b.start", "b.end", F.lit(True).alias("base"))
    order = Window.partitionBy("_key").orderBy("start", "end")
    before = F.max(F.when(F.col("base"), F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    after = F.min(F.when(F.col("base"), F.col("start"))).over(order.rowsBetween(0, Window.unboundedFollowing))
    free = at.union(spans).distinct().withColumns({"_before": before, "_after": after}).where(
        ~F.col("base") & (F.coalesce("_before", F.lit(0)) <= F.col("start")) & (F.coalesce("_after", "end") >= F.col("end")))
    return free.groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("terms"))


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with ``text`` generalised: every span becomes its kind in brackets, as ``[EMAIL]`` or ``[TERM]``."""
    found = find_private(docs, **options).select("_key", "found").dropDuplicates(["_key"])
    rows = packed(docs, "doc_id", "text").withColumn("_key", row_key("doc_id", "text")).join(found, "_key", "left")
    ordered = F.array_sort(F.transform("found", lambda s: F.struct(s["start"], s["end"], s["kind"])))

    def add(acc: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        out = F.struct(s["end"].alias("at"), F.concat(acc["out"], F.array(gap, F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))).alias("out"))
        return F.when(s["start"] >= acc["at"], out).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out")))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))
    text = F.aggregate(ordered, start, add, lambda a: F.concat(
        F.array_join(a["out"], ""), F.substring(F.col("text"), (a["at"] + 1).cast("int"), F.length("text"))))
    return unpacked(rows, docs.columns, text=text)


def q_sanitise(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_private(docs).drop("_key", "found")

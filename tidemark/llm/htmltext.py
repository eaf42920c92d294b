"""Op 2: main text by equivalence-class template deduction.

Pages of one host share a template.  Every token of a page (an element at its
path, or a whole text at its path) has an occurrence vector: how often each
page of the host holds it.  Tokens with the same vector are one equivalence
class; frequent classes nest as their paths do and make the template.  A text whose
class holds an element is written by the template, not by an author, and is
furniture on every page.  What the template leaves
open are its slots.  The main slot is found by going down from the root into
the element that opens once a page and holds nearly all the text that varies.
Names of elements and classes are hints: they mark furniture inside the slot,
and on a page without text in the host's main slot they pick its article.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from tidemark.llm.common import add_computed, chunks, keep_columns, materialize, packed, table, unpacked

#: A class belongs to the template if it is on this share of the host's pages, and its texts if they are on so many pages.
MIN_SHARE, MIN_EVIDENCE = 0.5, 4
#: The main slot opens at most so often per page, and a slot beside it with less than this share of its varying text is left out.
MAX_OPENS, MAX_ASIDE = 1.5, 0.15
#: Templates are broadcast below this size, counted in bytes.
BROADCAST_BYTES = 64 << 20
#: Copies of each host's template in a shuffled join, so a large host spreads.
HOST_SPLIT = 32

# HTML element names by role, and words of class, id and role that name furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rb rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split())
FURNITURE = frozenset(
    "head title nav aside footer form script style noscript template button select textarea iframe svg dialog menu object "
    "canvas audio video map datalist".split())
MAIN = frozenset(["article", "main"])
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu menubar "
    "breadcrumb breadcrumbs footer sidebar aside notice notices cookie cookies consent gdpr popup modal overlay newsletter "
    "subscribe subscription signup login search comment comments reply replies respond disqus share sharing social related "
    "recommended recommendations widget toolbar pagination pager alert masthead skip".split())
#: Words that only say where or what kind of box a named element is: ``site-footer`` is a footer, ``search-algorithms`` no search.
BOX_WORDS = frozenset(
    "site page post posts article articles story stories top bottom left right main primary secondary global inner outer box block "
    "bar area wrap wrapper container content list item items link links section panel column col row slot unit form header icons "
    "button buttons text message thread js the reader readers user to".split())
#: Elements that carry text themselves: a slot that holds some beside a bigger one is the main slot as a whole.
CONTENT = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre figure table dl ol header hgroup".split())
_CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre "
    "section table ul details".split())
_CLOSED_BY_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
                   "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset("ul ol dl table article main nav aside section div body form footer header blockquote".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _names_furniture(name: str) -> bool:
    """Whether one class, id or role names furniture: a furniture word, alone or with box words only."""
    words = _NAME.findall(_CAMEL.sub(" ", name).lower())
    return any(w in FURNITURE_WORDS for w in words) and all(w in FURNITURE_WORDS or w in BOX_WORDS for w in words)


def _named_furniture(attributes: str) -> tuple[bool, str]:
    """Whether class, id, role or a hiding attribute name furniture; and the first class name."""
    furniture, first = False, ""
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            furniture = True
        elif name == "style":
            furniture |= "display:none" in value.replace(" ", "").lower()
        elif name in ("class", "id", "role"):
            names = value.split()
            furniture |= any(map(_names_furniture, names)) or (name == "role" and value.lower() in ("contentinfo", "complementary"))
            if name == "class" and names and not first:
                first = names[0].lower()
    return furniture, first


def _id(*parts) -> int:
    """A 63-bit id of a token, the same on every page."""
    key = "\n".join(map(str, parts)).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), "big") >> 1


class Block(NamedTuple):
    """A text with the id of its path; whether names call it furniture, article or main elements hold it, and the slot does."""

    path: int
    text: str
    furniture: bool
    main: bool
    inside: bool


class Open(NamedTuple):
    """An open element; ``outer`` is the text before an inline one that is cut out, to go on after it."""

    name: str
    path: int
    furniture: bool
    main: bool
    inside: bool
    outer: list[str] | None


ROOT = Open("", 0, False, False, False, None)


class Page:
    """Blocks of one page in order, and its paths: ``id -> [parent, step, opens, characters under it]``.

    A path is the chain of element names (with the first class, and a mark if names call it furniture) from
    the root, inline elements left out.  Ids are chained hashes, so depth costs nothing."""

    def __init__(self, source: str, slot: int | None = None):
        self.slot = slot
        self.blocks: list[Block] = []
        self.paths: dict[int, list] = {}
        self.stack: list[Open] = [ROOT]
        self.names: Counter[str] = Counter()
        self.text: list[str] = []
        at, n = 0, len(source)
        for_raw = ""
        while at < n:
            if for_raw:
                m = re.compile(rf"</{for_raw}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
                at = m.end() if m else n
                for_raw = ""
                continue
            m = _TOKEN.search(source, at)
            if not m:
                self.text.append(source[at:])
                break
            if m.start() > at:
                self.text.append(source[at:m.start()])
            at = m.end()
            name = m[2] or m[5]
            if name:
                name = name.lower()
                if m[1] or m[4]:
                    self.close(name)
                else:
                    self.open(name, m[3] or m[6] or "")
                    if name in RAW:
                        for_raw = name
        self.cut(1)
        self.flush()
        under = Counter()
        for b in self.blocks:
            under[b.path] += len(b.text)
        for path in reversed(self.paths):  # a path comes after its parent
            self.paths[path][3] = under[path]
            under[self.paths[path][0]] += under[path]

    def flush(self) -> None:
        if self.text:
            text = _SPACE.sub(" ", entities.unescape("".join(self.text))).strip()
            self.text = []
            if text:
                _, path, furniture, main, inside, _ = self.stack[-1]
                self.blocks.append(Block(path, text, furniture, main, inside))

    def cut(self, depth: int) -> None:
        """Close the elements from ``depth`` on; the text around an inline one that is cut out goes on."""
        while len(self.stack) > depth:
            top = self.stack[-1]
            self.flush()
            self.names[top.name] -= 1
            self.stack.pop()
            if top.outer is not None:
                self.text = top.outer

    def open(self, name: str, attributes: str) -> None:
        if name in RAW:
            return
        furniture, first = _named_furniture(attributes) if attributes else (False, "")
        above = self.stack[-1]
        if name in INLINE:
            if name == "br":
                self.text.append(" ")
            elif furniture and name not in VOID:  # an inline advert or notice is cut out of the block around it
                outer, self.text = self.text, []
                self.stack.append(Open(name, above.path, True, above.main, above.inside, outer))
                self.names[name] += 1
            return
        self.flush()
        if name in _CLOSES_P:
            self.leave({"p"})
        if name in _CLOSED_BY_SAME:
            self.leave(_CLOSED_BY_SAME[name])
        if name in VOID:
            return
        above = self.stack[-1]
        if name in ("html", "body", "main"):
            furniture = False
        furniture = furniture or name in FURNITURE or (name == "header" and not above.main)
        step = f"{name}.{first}{'!' if furniture else ''}"
        path = _id(above.path, step)
        self.paths.setdefault(path, [above.path, step, 0, 0])[2] += 1
        furniture = above.furniture or furniture
        self.stack.append(Open(name, path, furniture, above.main or (name in MAIN and not furniture), above.inside or path == self.slot, None))
        self.names[name] += 1

    def leave(self, names: set[str]) -> None:
        """Close an open element of these names, unless it lies outside the nearest enclosing container."""
        if not any(self.names[name] for name in names):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].name in names:
                self.cut(i)
                return
            if self.stack[i].name in _SCOPE:
                return

    def close(self, name: str) -> None:
        if self.names[name]:
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i].name == name:
                    self.cut(i)
                    return
                if name not in _SCOPE and self.stack[i].name in _SCOPE and name not in ("html", "body"):
                    break
        if name not in INLINE and name not in RAW:
            self.flush()

    def key(self) -> str:
        """The same for pages with the same text outside furniture: copies."""
        texts = "\n".join(b.text for b in self.blocks if not b.furniture)
        return hashlib.blake2b(texts.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest() if texts else ""


def host_of(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1)), F.lit(""))


TOKENS = "host string, token long, parent long, step string, page string, n long, chars long"


def page_tokens(page: Page) -> Iterator[tuple]:
    """Tokens of a page: ``token, parent, step, n, chars``.  A text has the step ``""`` and its own
    characters, a path those of all its texts and of the elements in it."""
    for path, (parent, step, n, chars) in page.paths.items():
        yield path, parent, step, n, chars
    for (path, text), n in Counter((b.path, b.text) for b in page.blocks).items():
        yield _id(path, text, "text"), path, "", n, n * len(text)


def occurrence_classes(pages: DataFrame) -> DataFrame:
    """Frequent tokens of every host with their class: ``host, token, parent, step, support, n, chars, pages, class_id``.

    A class id is a 128-bit sum over ``hash(page, count)``: equal for equal
    occurrence vectors, and a sum, so a host of any size is combined before the
    shuffle.  A host keeps at most 1 / MIN_SHARE times the tokens of an average page.
    Pages of one host with the same text outside furniture are copies and count
    once: a text that only copies repeat is no template.
    """
    rows = pages.select(host_of(F.col("url")).alias("host"), "html")

    def tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a, b in chunks(pdf["html"].tolist()):
                out = []
                for host, source in zip(pdf["host"][a:b], pdf["html"][a:b]):
                    page = Page(source or "")
                    key = page.key()
                    if key:
                        out.append((host, 0, 0, "", key, 1, sum(len(x.text) for x in page.blocks)))
                        out += [(host, token, parent, step, key, n, chars) for token, parent, step, n, chars in page_tokens(page)]
                yield pd.DataFrame(out, columns=["host", "token", "parent", "step", "page", "n", "chars"])

    found = rows.mapInPandas(tokens, TOKENS)
    found = found.groupBy("host", "token", "page").agg(*[F.max(c).alias(c) for c in ("parent", "step", "n", "chars")])
    # sums of 31-bit parts cannot overflow for any possible number of pages
    part = [F.shiftrightunsigned(F.xxhash64("page", "n", F.lit(s)), 33) for s in range(4)]
    grouped = found.groupBy("host", "token").agg(
        F.max("parent").alias("parent"), F.max("step").alias("step"), F.count(F.lit(1)).alias("support"), F.sum("n").alias("n"),
        F.sum("chars").alias("chars"), *[F.sum(p).alias(f"v{i}") for i, p in enumerate(part)]) \
        .where(f"step <> '' OR token = 0 OR support >= {MIN_EVIDENCE}")
    grouped = materialize(grouped, "html-vectors")
    hosts = grouped.where("token = 0").select("host", F.col("support").alias("pages"))
    class_id = F.md5(F.concat_ws(":", *[F.col(f"v{i}").cast("string") for i in range(4)]).cast("binary"))
    return grouped.join(hosts, "host").where(F.col("support") >= MIN_SHARE * F.col("pages")) \
        .select("host", "token", "parent", "step", "support", "n", "chars", "pages", class_id.alias("class_id"))


def template_of(tokens: list[tuple]) -> tuple[int | None, list[int]]:
    """Main slot and template texts of one host from its frequent ``(token, parent, step, support, n, chars, class_id)``.

    A text is the template's if its class holds an element (the page itself counts as one): it comes
    exactly where and as often as that element, so no author wrote it.  A path stands on every page that holds
    a path in it, so classes nest as their paths do.  From the root the slot goes down as long as one path that opens once a page
    holds nearly all the varying text; paths that names call furniture do not count against it.
    It stops at an article, and where headings or paragraphs stand beside the next path."""
    elements = {t[6] for t in tokens if t[2] or not t[0]}
    texts = [t for t in tokens if t[0] and not t[2] and t[6] in elements]
    path_of = {t[0]: t for t in tokens if t[2]}
    fixed: Counter[int] = Counter()
    for _, parent, _, _, _, chars, _ in texts:
        fixed[parent] += chars
    children: dict[int, list[int]] = {}
    for path, t in path_of.items():
        children.setdefault(t[1], []).append(path)
    order = [0]
    for path in order:
        order += children.get(path, ())
    for path in reversed(order[1:]):
        fixed[path_of[path][1]] += fixed[path]
    varying = {path: path_of[path][5] - fixed[path] for path in order[1:]}
    at = 0
    while True:
        below = [p for p in children.get(at, ()) if varying[p] > 0 and not path_of[p][2].endswith("!")]
        best = max(below, key=lambda p: (varying[p], p), default=None)
        if best is None:
            break
        _, _, step, support, n, _, _ = path_of[best]
        beside = [p for p in below if p != best]
        if n > MAX_OPENS * support or step.split(".")[0] in CONTENT or any(
                path_of[p][2].split(".")[0] in CONTENT or varying[p] >= MAX_ASIDE * varying[best] for p in beside):
            break
        at = best
        if step.startswith("article."):
            break
    return at or None, sorted(t[0] for t in texts)


def templates(classes: DataFrame) -> DataFrame:
    """One row per host: ``host, slot, texts``.  A host's frequent tokens are at most twice those of an average page of it."""
    names = ["token", "parent", "step", "support", "n", "chars", "class_id"]

    def deduce(pdf: pd.DataFrame) -> pd.DataFrame:
        slot, texts = template_of(list(pdf[names].itertuples(index=False, name=None)))
        return pd.DataFrame({"host": [pdf["host"].iloc[0]], "slot": pd.array([slot], dtype="Int64"), "texts": [texts]})

    return classes.groupBy("host").applyInPandas(deduce, "host string, slot long, texts array<long>")


def _size(blocks: list[Block]) -> int:
    return sum(len(b.text) for b in blocks)


def extract(source: str | None, slot: int | None = None, texts: frozenset[int] = frozenset()) -> str:
    """The main text of one page, given its host's main slot and template texts."""
    blocks = [b for b in Page(source or "", slot).blocks if not b.furniture]
    varying = [b for b in blocks if _id(b.path, b.text, "text") not in texts] if texts else blocks
    if not varying:  # a page of nothing but repeated text keeps its article
        varying = [b for b in blocks if b.main]
    kept = [b for b in varying if b.inside] or varying
    main = [b for b in kept if b.main]
    return "\n".join(b.text for b in (main if 2 * _size(main) >= _size(kept) else kept))


def extract_text(pages: DataFrame) -> DataFrame:
    """``pages`` plus ``text`` and ``n_chars``.

    Blocks are joined in page order by one newline; inside a block white space
    becomes one space and character references are decoded.  A null html is an
    empty page.  A page without varying text in its host's main slot gives its
    article and main elements if they hold at least half of its varying text,
    else all slots that are not furniture.  Null urls share the empty host;
    repeated rows and copies get equal results and count as one page of the
    host; equal slots are told apart by their ids.  Columns of ``pages`` named
    text or n_chars are replaced, all others stay.
    """
    pages = keep_columns(pages, ["text", "n_chars"])
    found = materialize(templates(occurrence_classes(pages)), "html-templates")
    size = found.agg(F.sum(F.octet_length("host") + F.size("texts") * 8 + 32)).first()[0] or 0
    rows = packed(pages, "url", "html").withColumn("_host", host_of(F.col("url")))
    found = found.withColumnRenamed("host", "_host")
    if size <= BROADCAST_BYTES:
        rows = rows.join(F.broadcast(found), "_host", "left")
    else:
        rows = rows.withColumn("_part", F.pmod(F.xxhash64("url", "html"), F.lit(HOST_SPLIT)).cast("int"))
        copies = found.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(HOST_SPLIT - 1))))
        rows = rows.join(copies, ["_host", "_part"], "left").drop("_part")
    rows = rows.drop("_host")

    def make():
        sets: dict[tuple, frozenset] = {}

        def run(sources: list, slots: list, fixed: list) -> list[list]:
            nonlocal sets
            out = []
            for source, slot, t in zip(sources, slots, fixed):
                key = tuple(t or ())
                if key not in sets:
                    sets = {key: frozenset(key)}
                out.append(extract(source, slot, sets[key]))
            return [out, [len(t) for t in out]]

        return run

    fields = [StructField("text", StringType()), StructField("n_chars", LongType())]
    done = add_computed(rows, ["html", "slot", "texts"], fields, make, drop=["slot", "texts"])
    return unpacked(done, [*pages.columns, "text", "n_chars"])


def q_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages).select("page_id", "url", "text", "n_chars")

"""Op 1: line-first cleaning.

Every line is judged by itself: its punctuation, whether it reads like
navigation, whether it is boilerplate.  Lines that fail are removed, and a
document that loses too much of its text with them is rejected.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField

from tidemark.llm.common import add_computed, keep_columns, packed, table, unpacked

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: A document that loses more than this share of its word characters is rejected.
MAX_LOST_PERCENT = 67
#: A line without a closing mark fails below this many words.
MIN_OPEN_WORDS = 4
#: Boilerplate phrases count in lines of at most this many words: longer ones are prose about the subject.
MAX_BOILERPLATE_WORDS = 25

# White space and symbols of the contract.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
SEPARATORS = "|»›•·→"
CLOSING = ".!?…:;\"'”’»)]}。！？"
NAVIGATION = (
    "home", "menu", "search", "login", "log in", "sign in", "sign up", "register", "next", "previous", "back", "back to top",
    "read more", "share", "contact", "contact us", "about", "about us", "skip to content", "site map", "sitemap",
)
BOILERPLATE = (
    "all rights reserved", "licensed under", "released under the", "privacy policy", "terms of service", "terms of use",
    "accept cookies", "use of cookies", "uses cookies", "enable javascript", "subscribe to our", "sign up for our",
    "copyright (c)", "copyright ©", "lorem ipsum", "powered by", "click here",
)
_BOILERPLATE = re.compile("|".join(map(re.escape, BOILERPLATE)))
_NAVIGATION = frozenset(NAVIGATION)
_TO_LOWER = {c: c + 32 for c in range(65, 91)}


def line_passes(line: str) -> bool:
    """The verdict on one line that has a word.

    Punctuation: fails if symbols make more than a tenth of its characters, if
    doubled exclamation marks follow at least every third word (two or more),
    or if it has fewer than ``MIN_OPEN_WORDS`` words and no closing mark; so
    does a line of which more than half of the words repeat the word before.
    Navigation: fails if separators stand at least once per three words
    (two or more), or if the line is a menu entry.  Boilerplate: fails if a
    short line holds a stock phrase.
    """
    text = line.strip(SPACES)
    split = line.encode("utf-8", "surrogatepass").split()
    words = len(split)
    symbols = sum(map(line.count, SYMBOLS))
    if symbols and 10 * symbols > len(line) - sum(map(line.count, SPACES)):
        return False
    shouts = line.count("!!")
    if shouts >= 2 and 3 * shouts >= words:
        return False
    if words < MIN_OPEN_WORDS and text[-1] not in CLOSING:
        return False
    if 2 * len(set(split)) <= words + 1 and 2 * sum(a == b for a, b in zip(split, split[1:])) > words:
        return False
    separators = sum(map(line.count, SEPARATORS))
    if separators >= 2 and 3 * separators >= words:
        return False
    if words <= MAX_BOILERPLATE_WORDS:
        low = text.translate(_TO_LOWER)
        if low in _NAVIGATION or _BOILERPLATE.search(low):
            return False
    return True


def _repeated_words(words: list[bytes], counts: np.ndarray) -> np.ndarray:
    """Per document the words inside 8-word windows that occur twice or more in it.

    Windows are numbered exactly by doubling: pairs of words, then of pairs,
    then of fours."""
    total, n_docs = len(words), len(counts)
    out = np.zeros(n_docs, np.int64)
    if total < WINDOW + 1:
        return out
    ids = pd.factorize(np.array(words, dtype=object))[0].astype(np.int64)
    size = 1
    while size < WINDOW:
        left, right = ids[:-size], ids[size:]
        ids = pd.factorize(left * (int(ids.max()) + 1) + right)[0].astype(np.int64)
        size *= 2
    ends = np.cumsum(counts)
    doc = np.repeat(np.arange(n_docs), counts)
    start = np.arange(len(ids))
    inside = start + WINDOW <= ends[doc[: len(ids)]]
    start, ids = start[inside], ids[inside]
    if not len(ids):
        return out
    codes, _ = pd.factorize(ids * n_docs + doc[start])
    twice = np.bincount(codes)[codes] > 1
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, start[twice], 1)
    np.add.at(edge, start[twice] + WINDOW, -1)
    covered = np.cumsum(edge[:-1]) > 0
    np.add.at(out, doc[covered], 1)
    return out


def _judge(texts: list[str | None]) -> pd.DataFrame:
    split = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in texts]
    counts = np.array([len(w) for w in split], np.int64)
    repeat = _repeated_words([w for ws in split for w in ws], counts)
    rows = []
    for t, n, rep in zip(texts, counts.tolist(), repeat.tolist()):
        t = t or ""
        chars = len(t) - sum(map(t.count, SPACES))
        symbols = sum(map(t.count, SYMBOLS))
        seen, dup, keep, kept_chars = set(), 0, [], 0
        for line in t.split("\n"):
            size = len(line) - sum(map(line.count, SPACES))
            if not size:
                keep.append(line)
                continue
            if line in seen:
                dup += 1
            seen.add(line)
            if line_passes(line):
                keep.append(line)
                kept_chars += size
        failed = n < MIN_WORDS or 100 * rep > MAX_REPEAT_PERCENT * n
        kept = not failed and 100 * (chars - kept_chars) <= MAX_LOST_PERCENT * chars
        rows.append((n, chars, symbols, dup, rep, failed, kept, chars - kept_chars, "\n".join(keep)))
    return pd.DataFrame(rows, columns=[f.name for f in _FIELDS])


_FIELDS = [
    StructField("n_words", LongType()), StructField("word_chars", LongType()), StructField("n_symbols", LongType()),
    StructField("n_dup_lines", LongType()), StructField("n_repeat_words", LongType()), StructField("base_failed", BooleanType()),
    StructField("kept", BooleanType()), StructField("lost_chars", LongType()), StructField("clean_text", StringType()),
]


def judge_lines(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus the counts, ``base_failed``, ``kept``, ``lost_chars`` and ``clean_text``.

    ``clean_text`` holds the lines that passed (lines without a word stay).  A
    null or empty text has no words, fails the base rule and cleans to ''.
    Columns of ``docs`` with a produced name are replaced.
    """
    docs = keep_columns(docs, [f.name for f in _FIELDS])

    def judge(texts: list[str | None]) -> list:
        judged = _judge(texts)
        return [judged[f.name] for f in _FIELDS]

    return add_computed(docs, [text_col], _FIELDS, lambda: judge)


def clean_documents(docs: DataFrame) -> DataFrame:
    """The kept documents with their failed lines removed; ``n_chars``, if present, counts the new text.

    All other columns come back as they were, whatever their names."""
    kept = judge_lines(packed(docs, "text")).where("kept")
    own = {"text": F.col("clean_text")}
    if "n_chars" in docs.columns:
        own["n_chars"] = F.length("clean_text").cast(docs.schema["n_chars"].dataType)
    return unpacked(kept, docs.columns, **own)


def q_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge_lines(docs).drop("text", "clean_text")


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (
  SELECT r, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS g
  FROM (SELECT r, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w WHERE len(ws) >= {WINDOW})),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + {WINDOW})) AS p FROM twice) GROUP BY r),
raw AS (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d),
lines AS (
  SELECT r, l, regexp_extract_all(l, '[^\x20\x09-\x0D]+') AS ls, len(ls) AS n,
         len(list_filter(range(2, n + 1), lambda i: ls[i] = ls[i - 1])) AS stutter, length(regexp_replace(l, '[\x20\x09-\x0D]', '', 'g')) AS chars,
         len(regexp_extract_all(l, '[#*$%&|<>]')) AS sym, len(regexp_extract_all(l, '!!')) AS shouts,
         len(regexp_extract_all(l, '[{SEPARATORS}]')) AS sep,
         regexp_replace(regexp_replace(l, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '') AS s
  FROM raw),
judged AS (
  SELECT *, translate(s, '{_UPPER}', '{_UPPER.lower()}') AS low FROM lines WHERE chars > 0),
passed AS (
  SELECT r, l, chars,
         NOT (10 * sym > chars OR (shouts >= 2 AND 3 * shouts >= n) OR 2 * stutter > n
              OR (n < {MIN_OPEN_WORDS} AND strpos('{CLOSING.replace("'", "''")}', right(s, 1)) = 0)
              OR (sep >= 2 AND 3 * sep >= n)
              OR (n <= {MAX_BOILERPLATE_WORDS} AND (low IN ({_quoted(NAVIGATION)})
                  OR list_bool_or(list_transform([{_quoted(BOILERPLATE)}], lambda x: contains(low, x)))))) AS ok
  FROM judged),
doc AS (
  SELECT r, count(*) - count(DISTINCT l) AS dup, sum(chars) AS chars, sum(CASE WHEN ok THEN 0 ELSE chars END) AS lost
  FROM passed GROUP BY r),
c AS (
  SELECT d.doc_id, len(ws) AS n, coalesce(doc.chars, 0) AS chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS sym,
         coalesce(doc.dup, 0) AS dup, coalesce(rep.n, 0) AS rep, coalesce(doc.lost, 0) AS lost
  FROM d JOIN w USING (r) LEFT JOIN rep USING (r) LEFT JOIN doc USING (r))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(chars AS BIGINT) AS word_chars, CAST(sym AS BIGINT) AS n_symbols,
       CAST(dup AS BIGINT) AS n_dup_lines, CAST(rep AS BIGINT) AS n_repeat_words,
       n < {MIN_WORDS} OR 100 * rep > {MAX_REPEAT_PERCENT} * n AS base_failed,
       NOT (n < {MIN_WORDS} OR 100 * rep > {MAX_REPEAT_PERCENT} * n) AND 100 * lost <= {MAX_LOST_PERCENT} * chars AS kept,
       CAST(lost AS BIGINT) AS lost_chars
FROM c
"""

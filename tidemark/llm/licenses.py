"""Op 4: license scan by winnowed fingerprints and banded alignment.

The templates' winnowed word 3-grams form an inverted index.  A document's
3-grams pick candidate templates and the place in the text where they would
start; a banded alignment there tells how much of the template is present
and where.  The matched span must also hold little else, and name the same
variant and version as the template.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, LongType, StringType, StructField

from tidemark.llm.common import add_computed, keep_columns, table

GRAM, RUN = 3, 2
#: Words by which a document may run ahead of or behind its template.
BAND = 8
#: Least share of a template's words, and of the words of the matched span, that must align.
MIN_COVERAGE = 0.7

# Public license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
    "MIT": "Released under the MIT License",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3",
    "LGPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
    "LGPL-2.1-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
        "your option) any later version.",
    "AGPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
    "GPL-2.0-notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "CC-BY-4.0-short": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-NC-4.0-text": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "CC-BY-NC-SA-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
    "CC-BY-ND-4.0": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License",
    "CC-BY-NC-ND-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License",
    "Unlicense": "This is free and unencumbered software released into the public domain",
    "All-rights-reserved": "All rights reserved",
}
# SPDX identifiers and names with versions, of three words or more; such a phrase counts only word for word.
SPDX = ("Apache-2.0 MIT MIT-0 GPL-2.0 GPL-3.0 LGPL-2.1 LGPL-3.0 AGPL-3.0 MPL-2.0 BSD-2-Clause BSD-3-Clause BSD-3-Clause-Clear ISC "
        "CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0 EPL-2.0 BSL-1.0 Unlicense Zlib").split()
NAMES = {
    "Apache-2.0": ["Apache License 2.0", "Apache License v2.0", "Apache License v2", "Apache 2.0 License", "under Apache 2.0", "under Apache-2.0"],
    "MIT": ["under the MIT License", "under MIT License"],
    "GPL-3.0": ["GNU General Public License v3.0", "GNU General Public License v3", "GNU General Public License 3.0", "GNU GPL v3", "under GNU GPLv3", "the GNU GPLv3"],
    "GPL-2.0": ["GNU General Public License v2.0", "GNU General Public License v2", "GNU General Public License 2.0", "GNU GPL v2"],
    "LGPL-3.0": ["GNU Lesser General Public License v3.0", "GNU Lesser General Public License v3", "GNU LGPL v3"],
    "LGPL-2.1": ["GNU Lesser General Public License v2.1", "GNU LGPL v2.1"],
    "AGPL-3.0": ["GNU Affero General Public License v3.0", "GNU Affero General Public License v3", "GNU AGPL v3"],
    "MPL-2.0": ["Mozilla Public License 2.0", "Mozilla Public License v2.0", "Mozilla Public License Version 2.0"],
    "BSD-2-Clause": ["BSD 2-Clause", "2-clause BSD"],
    "BSD-3-Clause": ["BSD 3-Clause", "3-clause BSD"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License v2.0"],
    "BSL-1.0": ["Boost Software License 1.0", "Boost Software License Version 1.0"],
    "CC0-1.0": ["CC0 1.0 Universal"],
}
_WORD = re.compile(r"[A-Za-z0-9]+")
# Words that tell a license from its relatives, and the version that follows them.
_VARIANT = re.compile(r"\b(affero|lesser|library general|non ?commercial|share ?alike|no ?deriv|nc|sa|nd|apache|mit|mozilla|gnu|bsd|eclipse|boost)")
_VARIANT_END = re.compile(r"\b(?:nc|sa|nd|mit|gnu|bsd|boost)\w")
_VERSION = re.compile(r"\b(?:version|v|attribution|commercial|noncommercial|alike|sharealike|derivatives|noderivatives|noderivs|by|nc|sa|nd)"
                      r" ([0-9]+(?: [0-9]+)?)\b")


def _words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def _identity(words: list[str]) -> tuple[frozenset[str], frozenset[str]]:
    """The variant words and the versions (without a last .0) that a text names."""
    text = " ".join(words)
    variants = frozenset(m[0].replace(" ", "") for m in _VARIANT.finditer(text) if not _VARIANT_END.match(text, m.start()))
    return variants, frozenset(v.removesuffix(" 0") for v in _VERSION.findall(text))


class Index:
    """Inverted index of the winnowed fingerprints of templates and of phrases that count only word for word."""

    def __init__(self, templates: dict[str, str], phrases: Sequence[tuple[str, str]] = ()):
        self.names = sorted(templates) + [name for name, _ in phrases]
        self.words = [_words(templates[n]) for n in sorted(templates)] + [_words(phrase) for _, phrase in phrases]
        self.exact = len(templates)  # from this template on
        self.identities = [_identity(ws) for ws in self.words]
        self.vocabulary = {w: i + 1 for i, w in enumerate(sorted({w for ws in self.words for w in ws}))}
        self.base = len(self.vocabulary) + 1
        self.places: dict[int, list[tuple[int, int]]] = {}
        for t, ws in enumerate(self.words):
            codes = self.codes(np.array([self.vocabulary[w] for w in ws], np.int64)).tolist()
            for p in self.winnow(codes):
                self.places.setdefault(codes[p], []).append((t, p))
        self.keys = np.array(sorted(self.places), np.int64)

    def codes(self, ids: np.ndarray) -> np.ndarray:
        """Exact numbers of the 3-grams."""
        if len(ids) < GRAM:
            return np.zeros(0, np.int64)
        return (ids[:-2] * self.base + ids[1:-1]) * self.base + ids[2:]

    @staticmethod
    def winnow(codes: list[int]) -> set[int]:
        """Positions of the smallest scrambled code of every run (the last of equals)."""
        keys = [(c * 0x9E3779B97F4A7C15) & (2**64 - 1) for c in codes]
        runs = range(max(1, len(keys) - RUN + 1)) if keys else ()
        return {min(range(s, min(s + RUN, len(keys))), key=lambda i: (keys[i], -i)) for s in runs}

    def seeds(self, ids: np.ndarray) -> dict[int, list[int]]:
        """Per template the document positions (may be negative) where it would start."""
        codes = self.codes(ids)
        if not len(codes) or not len(self.keys):
            return {}
        hit = np.flatnonzero(self.keys[np.minimum(np.searchsorted(self.keys, codes), len(self.keys) - 1)] == codes)
        out: dict[int, list[int]] = {}
        for i in hit.tolist():
            for t, p in self.places[int(codes[i])]:
                out.setdefault(t, []).append(i - p)
        return out

    def align(self, t: int, ids: list[int], start: int) -> tuple[int, int, int]:
        """Longest common subsequence of template and text within the band around ``start``:
        matched words and the first and last document word matched (-1 if none)."""
        own = [self.vocabulary[w] for w in self.words[t]]
        width = 2 * BAND + 1
        best = [(0, -1, -1)] * width  # cell b: document words up to start - BAND + i + b are used
        for i, w in enumerate(own):
            new, left = [], (0, -1, -1)
            for b in range(width):
                at = start + i + b - BAND
                up = best[b + 1] if b + 1 < width else (0, -1, -1)
                cell = up if up[0] >= left[0] else left
                if 0 <= at < len(ids) and ids[at] == w and best[b][0] + 1 > cell[0]:
                    n, first, _ = best[b]
                    cell = (n + 1, at if first < 0 else first, at)
                new.append(cell)
                left = cell
            best = new
        return max(best, key=lambda c: (c[0], -c[2]))

    def scan(self, text: str, seeds: dict[int, list[int]]) -> list[tuple[str, int, int, float, int]]:
        """``(name, start, end, coverage, words)`` in code points, end exclusive; of overlapping finds the longer stays."""
        found = list(_WORD.finditer(text))
        ids = [self.vocabulary.get(m[0].lower(), 0) for m in found]
        finds = []
        for t, starts in seeds.items():
            last = None
            if t >= self.exact:
                own = [self.vocabulary[w] for w in self.words[t]]
                finds += [(len(own), 1.0, -s, self.names[t], s + len(own) - 1) for s in set(starts)
                          if s >= 0 and ids[s:s + len(own)] == own]
                continue
            for s in sorted(set(starts)):
                if last is not None and s - last <= BAND // 2:
                    continue  # the band of the last start covers this one
                last = s
                n, first, end = self.align(t, ids, s)
                if n < MIN_COVERAGE * max(len(self.words[t]), end - first + 1):
                    continue
                if _identity([m[0].lower() for m in found[first:end + 1]]) == self.identities[t]:
                    finds.append((n, n / len(self.words[t]), -first, self.names[t], end))
        out, begins, ends = [], [], []  # the spans taken so far, disjoint and in order
        for n, coverage, first, name, end in sorted(finds, key=lambda f: (-f[0], -f[1], -f[2], f[3])):
            first = -first
            at = bisect_left(ends, first)
            if at == len(begins) or begins[at] > end:
                begins.insert(at, first)
                ends.insert(at, end)
                out.append((name, found[first].start(), found[end].end(), coverage, n))
        return sorted(out, key=lambda f: (f[1], f[2], f[0]))


def phrases() -> list[tuple[str, str]]:
    """SPDX lines and names with versions, as ``(name, phrase)``."""
    return [(f"{i}-spdx", f"SPDX-License-Identifier: {i}") for i in SPDX] + [(f"{i}-name", p) for i, ps in NAMES.items() for p in ps]


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``n_licenses``, ``licenses`` (names, comma-joined), ``best_coverage``, ``spans``
    (``name:start:end:coverage``, comma-joined, in text order).

    Without ``templates`` the library's notices, names and SPDX lines are sought.
    Null and empty texts have none (0, '', 0.0, '').  Of overlapping finds the one of more
    words stays, then the one of more coverage, the later one, the lesser name.  The index is as large
    as the given templates, which are a fixed list; each document, a repeated row too, is scanned
    by itself, whole.  Columns of ``docs`` with these names are replaced, all others stay."""
    docs = keep_columns(docs, ["n_licenses", "licenses", "best_coverage", "spans"])
    chosen = TEMPLATES if templates is None else templates
    fields = [StructField("n_licenses", LongType()), StructField("licenses", StringType()),
              StructField("best_coverage", DoubleType()), StructField("spans", StringType())]

    def make():
        index = Index(chosen, phrases() if templates is None else ())
        return lambda texts: list(zip(*_scan(index, texts)))

    return add_computed(docs, [text_col], fields, make)


def _scan(index: Index, texts: list[str | None]) -> list[tuple[int, str, float, str]]:
    words, ends = [], []
    for t in texts:
        words += _WORD.findall(t) if t else []
        ends.append(len(words))
    if not words:
        return [(0, "", 0.0, "")] * len(texts)
    codes, unique = pd.factorize(np.array(words, dtype=object))
    ids = np.array([index.vocabulary.get(w.lower(), 0) for w in unique], np.int64)[codes]
    out, begin = [], 0
    for t, end in zip(texts, ends):
        seeds = index.seeds(ids[begin:end])
        begin = end
        finds = index.scan(t, seeds) if seeds else []
        out.append((len(finds), ",".join(sorted({f[0] for f in finds})), max((f[3] for f in finds), default=0.0),
                    ",".join(f"{n}:{s}:{e}:{c:.3f}" for n, s, e, c, _ in finds)))
    return out


def q_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_licenses(docs).drop("text")

"""License scan by patience alignment of texts with templates.

A template's coverage is the share of its words that an alignment finds in the text, in order. The alignment anchors on words that are
unique both to the text's part and to the template's, keeps the longest run of anchors that rise in both (a longest increasing
subsequence), and aligns the gaps between them in the same way; equal words at the ends of a gap match as they are.

Short notices count only as a whole, with an eighth of inserted words at most. In longer templates the words that tell a license from others
(names and versions in headers, ``REQUIRED`` phrases in whole texts) have to be matched, and headers must not have the name of another license
inserted. Of templates that match the same part of a text, the one with most words in common and fewest words apart is reported.

A license may stand in a text many times, and then none of its words is unique. So a template is aligned with windows: if coverage
reaches ``share``, less than the rest of its words are missing, so of as many pivots plus one, one is there; windows of the
template's length and some slack lie around every occurrence of the pivots, the words that are rarest in the text. Texts
that do not hold enough of a template's words, counted with repetition, cannot reach the share and are skipped: that
bound is exact.

Nulls and oddities: a null or empty text has no license; templates without words are refused; whole texts of any length are read;
every place at which a license stands is a row, and repeated rows are read each.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from importlib import resources

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import portions

_WORD = re.compile(r"\w+(?:[.-]\w+)*")

_GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
          "documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, "
          "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
          "whom the Software is furnished to do so, subject to the following conditions. ")
_KEEP = ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. ")
_AS_IS = ("THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
          "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
          "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
          "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_USE = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_DISCLAIMS = ("THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
              "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
              "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
              "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. ")
_NO_NAME = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
            "software without specific prior written permission. ")
_BSD_AS_IS = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
              "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
              "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
              "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
              "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
              "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")

# The usual notices, the first sentences of headers, and whole texts of short licenses.
TEMPLATES = {
    "MIT notice": "Released under the MIT License.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "MPL-2.0 notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "All rights reserved": "All rights reserved.",
    "MIT": _GRANT + _KEEP + _AS_IS,
    "MIT-0": _GRANT.replace(", subject to the following conditions", "") + _AS_IS,
    "ISC": _USE + ", provided that the above copyright notice and this permission notice appear in all copies. " + _DISCLAIMS,
    "0BSD": _USE + ". " + _DISCLAIMS,
    "BSD-2-Clause": _BSD + _BSD_AS_IS,
    "BSD-3-Clause": _BSD + _NO_NAME + _BSD_AS_IS,
    "BSD-4-Clause": _BSD + "All advertising materials mentioning features or use of this software must display the following acknowledgement: "
                    "This product includes software developed by the organization. " + _NO_NAME + _BSD_AS_IS,
    "Apache-2.0 header": "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with "
                         "the License. You may obtain a copy of the License at",
    "GPL header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                  "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
}
TEMPLATES |= {name: TEMPLATES["GPL header"].replace("GNU General", kind).replace("version 3", version) for name, kind, version in (
    ("GPL-2.0 header", "GNU General", "version 2"), ("AGPL header", "GNU Affero General", "version 3"),
    ("LGPL-3.0 header", "GNU Lesser General", "version 3"), ("LGPL-2.1 header", "GNU Lesser General", "version 2.1"))}

# Words that name a license in notices and headers, as version numbers do.
TELLING = frozenset(
    "mit apache bsd bsd-style gnu gpl lgpl agpl gfdl affero lesser library mozilla mpl isc x11 zlib boost eclipse epl artistic unlicense cddl eupl python psf "
    "cc cc0 by by-sa by-nc by-nd by-nc-sa by-nc-nd commons noncommercial sharealike noderivatives noderivs non-commercial share-alike commercial".split())
_VERSION = re.compile(r"v?\d+(?:\.\d+)*")

# What a long text must hold to be told from its relatives.
REQUIRED = {
    "MIT": "this permission notice shall be included in all copies or substantial portions",
    "ISC": "provided that the above copyright notice and this permission notice appear in all copies",
    "BSD-2-Clause": "Redistributions in binary form must reproduce the above copyright notice",
    "BSD-3-Clause": "may be used to endorse or promote products derived from this software",
    "BSD-4-Clause": "All advertising materials mentioning features or use of this software must display the following acknowledgement",
    "GPL-3.0": "Use with the GNU Affero General Public License",
    "LGPL-2.0": "Version 2, June 1991", "LGPL-2.1": "Version 2.1, February 1999",
    "GFDL-1.2": "Version 1.2, November 2002", "GFDL-1.3": "Version 1.3, 3 November 2008",
}


def long_texts() -> dict[str, str]:
    """The whole texts of the long licenses, from the package."""
    folder = resources.files("tidemark.llm") / "license_texts"
    return {f.name.removesuffix(".txt"): f.read_text(encoding="utf-8") for f in sorted(folder.iterdir(), key=lambda f: f.name) if f.name.endswith(".txt")}


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def rising(values: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence, by patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    below = [-1] * len(values)
    for k, value in enumerate(values):
        pile = bisect_left(tops, value)
        if pile:
            below[k] = piles[pile - 1]
        if pile == len(tops):
            tops.append(value)
            piles.append(k)
        else:
            tops[pile], piles[pile] = value, k
    out, k = [], piles[-1] if piles else -1
    while k >= 0:
        out.append(k)
        k = below[k]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched positions of two word lists, rising in both."""
    found: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {b[j]: j for j in range(b0, b1) if in_b[b[j]] == 1}
        anchors = [(i, place[a[i]]) for i in range(a0, a1) if in_a[a[i]] == 1 and a[i] in place]
        anchors = [anchors[k] for k in rising([j for _, j in anchors])]
        if not anchors:
            continue
        found += anchors
        for (i, j), (u, v) in zip([(a0 - 1, b0 - 1), *anchors], [*anchors, (a1, b1)], strict=True):
            if i + 1 < u and j + 1 < v:
                gaps.append((i + 1, u, j + 1, v))
    return sorted(found)


@dataclass(frozen=True)
class Template:
    name: str
    text: str

    @cached_property
    def words(self) -> list[str]:
        found = words(self.text)
        if not found:
            raise ValueError(f"the template {self.name!r} has no words")
        return found

    @cached_property
    def counts(self) -> Counter:
        return Counter(self.words)

    @cached_property
    def tells(self) -> bool:
        """Is it a notice or header that names its license?"""
        return len(self.words) <= HEADER and any(map(telling, self.words))

    @cached_property
    def must(self) -> frozenset[int]:
        """Places of the words that an alignment has to match: what tells the license from others; all of a short notice."""
        size = len(self.words)
        if size <= SHORT:
            return frozenset(range(size))
        own = {i for i, w in enumerate(self.words) if self.tells and telling(w)}
        phrase = words(REQUIRED.get(self.name, ""))
        for i in range(size - len(phrase) + 1 if phrase else 0):
            if self.words[i:i + len(phrase)] == phrase:
                return frozenset(own | set(range(i, i + len(phrase))))
        return frozenset(own)


#: Words of the longest notice that counts only as a whole, and of the longest header.
SHORT, HEADER = 24, 60


def telling(word: str) -> bool:
    return word in TELLING or _VERSION.fullmatch(word) is not None


@dataclass(frozen=True)
class Match:
    name: str
    coverage: float
    matched: int
    first: int
    last: int

    @property
    def score(self) -> float:
        """Matched words, less those that only the template or only the text has."""
        return 3 * self.matched - round(self.matched / self.coverage) - (self.last - self.first + 1)


class Scanner:
    def __init__(self, templates: dict[str, str], share: float):
        self.share = share
        self.templates = [Template(name, text) for name, text in templates.items()]
        self.vocabulary = {w for t in self.templates for w in t.words}

    def scan(self, text: str) -> list[Match]:
        """Every place at which a license is found, by license, then by place; words are numbered from 0. Of templates that match the same words the best one counts."""
        body: list[str | None] = list(words(text))
        kept: list[Match] = []
        at: dict[str, list[int]] = {}
        for k, word in enumerate(body):
            if word in self.vocabulary:
                at.setdefault(word, []).append(k)
        live = self.templates
        while live:
            by_template = {t: self._matches(t, body, at) for t in live}
            live = [t for t, matches in by_template.items() if matches]
            taken: list[Match] = []
            starts: list[int] = []
            for match in sorted((m for matches in by_template.values() for m in matches), key=lambda m: (-m.score, m.first, m.name)):
                k = bisect_left(starts, match.first)
                if (k == 0 or taken[k - 1].last < match.first) and (k == len(taken) or match.last < starts[k]):
                    taken.insert(k, match)
                    starts.insert(k, match.first)
            # What a license took is no part of another one: look again at the rest.
            kept += taken
            for match in taken:
                body[match.first:match.last + 1] = [None] * (match.last + 1 - match.first)
            if taken:
                at = {w: left for w, places in at.items() if (left := [k for k in places if body[k] is not None])}
        order = {t.name: k for k, t in enumerate(self.templates)}
        return sorted(kept, key=lambda m: (order[m.name], m.first))

    def _matches(self, template: Template, body: list[str | None], at: dict[str, list[int]]) -> set[Match]:
        """Every match of a template that leaves out none of what it must hold."""
        size = len(template.words)
        short = size <= SHORT
        need = size if short else math.ceil(self.share * size)
        if len(body) < need or sum(min(n, len(at.get(w, ()))) for w, n in template.counts.items()) < need:
            return set()
        slack = size // 8 if short else size // 2 + 1
        # Of any size - need + 1 of its words, one is matched if enough are: take the places of the rarest words.
        places = sorted(range(size), key=lambda i: len(at.get(template.words[i], ())))[:size - need + 1]
        found = set()
        pivots = {k - i for i in places for k in at.get(template.words[i], ())}
        whole = {k for k in pivots if k >= 0 and body[k:k + size] == template.words}
        found |= {Match(template.name, 1.0, size, k, k + size - 1) for k in whole}
        # Starts of long windows are rounded down, and the windows are longer by as much.
        step = 1 if short else max(1, size // 8)
        for start in sorted({max(0, k - slack) // step * step for k in pivots - whole}) if slack else ():
            window = body[start:start + size + 2 * slack + step - 1]
            if sum((template.counts & Counter(window)).values()) < need:
                continue
            pairs = align(template.words, window)
            if len(pairs) < need or not template.must <= {i for i, _ in pairs}:
                continue
            first, last = pairs[0][1], pairs[-1][1]
            matched = {j for _, j in pairs}
            between = [w for j, w in enumerate(window[first:last + 1], first) if j not in matched] if last - first >= len(pairs) else []
            if None in between or short and len(between) > slack or template.tells and any(map(telling, between)):
                continue
            found.add(Match(template.name, len(pairs) / size, len(pairs), start + first, start + last))
        return found


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, share: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per place at which a document holds a license: ``doc_id, license, coverage, matched, first_word, last_word``.

    Documents without one have a row of nulls. There is no shuffle; a task reads one text at a time.
    """
    scanner = Scanner(TEMPLATES | long_texts() if templates is None else templates, share)
    schema = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("coverage", pa.float64()), ("matched", pa.int64()),
                        ("first_word", pa.int64()), ("last_word", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = scanner.scan(text or "")
                rows += [(doc_id, m.name, m.coverage, m.matched, m.first, m.last) for m in found] or [(doc_id, None, None, None, None, None)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(scan, "doc_id long, license string, coverage double, matched long, first_word long, last_word long")

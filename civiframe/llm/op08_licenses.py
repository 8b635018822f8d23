"""License scans by patience alignment.

Words that occur once in the text and once in a template are the anchors. The longest
increasing subsequence of their places keeps those in the same order; between two kept
anchors, and before the first and after the last, the same is done again, and words next to
an aligned one are matched on as they are equal. The coverage is the share of the
template's words that are aligned.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from importlib.resources import files
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from civiframe.llm.tables import read

_WORDS = re.compile(r"\w+(?:[.\-]\w+)*")

# The notices to look for, as their licences state them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted"
        " provided that the following conditions are met"
    ),
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files, to deal in the Software without restriction"
    ),
    "reserved": "All rights reserved.",
}
#: Words that tell a licence from its neighbours; each run is aligned as it stands, nothing between.
REQUIRED: dict[str, list[str]] = {
    "Apache-2.0": ["apache license version 2.0"],
    "MIT": ["mit license"],
    "CC-BY-NC-4.0": ["cc by-nc 4.0"],
    "CC-BY-4.0": ["cc by 4.0"],
    "GPL-3.0": ["gnu general public license", "version 3"],
}


def _add(name: str, text: str, *required: str) -> None:
    TEMPLATES[name] = text
    REQUIRED[name] = list(required)


# one sentence: "Licensed under the ..." and "Released under the ..."
for _id, _named in {
    "Apache-2.0": "Apache License, Version 2.0", "Apache-1.1": "Apache License, Version 1.1", "MIT": "MIT License",
    "ISC": "ISC License", "BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": "BSD 3-Clause License",
    "MPL-2.0": "Mozilla Public License, Version 2.0", "MPL-1.1": "Mozilla Public License, Version 1.1",
    "GPL-2.0": "GNU General Public License, version 2", "GPL-3.0": "GNU General Public License, version 3",
    "LGPL-2.1": "GNU Lesser General Public License, version 2.1", "LGPL-3.0": "GNU Lesser General Public License, version 3",
    "AGPL-3.0": "GNU Affero General Public License, version 3", "Unlicense": "Unlicense", "Zlib": "zlib License",
}.items():
    for _verb in ("Licensed", "Released"):
        _sentence = f"{_verb} under the {_named}."
        if _sentence not in TEMPLATES.values():
            _add(f"{_id}-{_verb.lower()}", _sentence, " ".join(_WORDS.findall(_named.lower())))
    if _id in ("GPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0"):
        _add(_id, f"This work is licensed under the {_named}.", *_named.lower().split(", "))

# Creative Commons: short names, the full name, the address
for _kind, _long in {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}.items():
    for _version in ("3.0", "4.0"):
        _id = f"CC-{_kind}-{_version}"
        _ported = "Unported" if _version == "3.0" else "International"
        if _id not in TEMPLATES:
            _add(_id, f"Licensed under CC {_kind} {_version}.", f"cc {_kind.lower()} {_version}")
        _add(f"{_id}-hyphens", f"Licensed under {_id}.", _id.lower())
        _add(
            f"{_id}-notice", f"This work is licensed under a Creative Commons {_long} {_version} {_ported} License.",
            f"commons {_long.lower()} {_version}",
        )
_add("CC0-1.0", "Licensed under CC0 1.0.", "cc0 1.0")

for _id in (
    "0BSD AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 BSD-2-Clause BSD-3-Clause CC-BY-4.0 CC-BY-NC-4.0 CC-BY-SA-4.0"
    " CC0-1.0 GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.1 LGPL-2.1-only"
    " LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later MIT MPL-1.1 MPL-2.0 Unlicense Zlib"
).split():
    _add(f"{_id}-spdx", f"SPDX-License-Identifier: {_id}", f"spdx-license-identifier {_id.lower()}")

# the notices of the GNU licences, at the head of a file
for _id, _named, _version in (
    ("GPL-2.0", "GNU General Public License", "2"), ("GPL-3.0", "GNU General Public License", "3"),
    ("LGPL-2.1", "GNU Lesser General Public License", "2.1"), ("LGPL-3.0", "GNU Lesser General Public License", "3"),
    ("AGPL-3.0", "GNU Affero General Public License", "3"),
):
    _what = "library" if _id == "LGPL-2.1" else "program"
    _add(
        f"{_id}-notice",
        f"This {_what} is free software; you can redistribute it and/or modify it under the terms of the {_named} as published by"
        f" the Free Software Foundation; either version {_version} of the License, or (at your option) any later version. This {_what} is"
        " distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of"
        f" MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {_named} for more details.",
        f"the terms of the {_named.lower()}", f"version {_version} of the license",
    )

_add(
    "Apache-2.0-notice",
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'
    " You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to"
    ' in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY'
    " KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "apache license version 2.0",
)
_add(
    "MPL-2.0-notice",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with"
    " this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "mozilla public license v 2.0",
)

_NO_WARRANTY = (
    ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT'
    " NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE"
    " COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES"
    " (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS"
    " INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR"
    " OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD = (
    TEMPLATES["BSD-3-Clause"]
    + ": 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    " 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in"
    " the documentation and/or other materials provided with the distribution."
)
_add("BSD-2-Clause-text", _BSD + _NO_WARRANTY)
_add(
    "BSD-3-Clause-text",
    _BSD + " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"
    " derived from this software without specific prior written permission." + _NO_WARRANTY,
    "endorse or promote products",
)
_add(
    "MIT-whole",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the"
    ' "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,'
    " publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do"
    " so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or"
    ' substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING'
    " BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE"
    " AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR"
    " OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
)
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_END = (
    ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED'
    " WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR"
    " CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,"
    " NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_add(
    "ISC-text", f"{_ISC}, provided that the above copyright notice and this permission notice appear in all copies.{_ISC_END}",
    "this permission notice appear in all copies",
)
_add("0BSD-text", f"{_ISC}.{_ISC_END}")
_add(
    "Unlicense-text",
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell,"
    " or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and"
    " by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright"
    " interest in the software to the public domain.",
    "public domain",
)
_add(
    "Zlib-text",
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any"
    " damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including"
    " commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this"
    " software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product,"
    " an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly"
    " marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any"
    " source distribution.",
)
# whole licences, as files beside this one
for _id, _file, _title in (
    ("Apache-2.0", "Apache-2.0", "apache license version 2.0"), ("GPL-2.0", "GPL-2", "gnu general public license version 2"),
    ("GPL-3.0", "GPL-3", "gnu general public license version 3"), ("LGPL-2.1", "LGPL-2.1", "gnu lesser general public license version 2.1"),
    ("LGPL-3.0", "LGPL-3", "gnu lesser general public license version 3"), ("MPL-1.1", "MPL-1.1", "mozilla public license version 1.1"),
    ("MPL-2.0", "MPL-2.0", "mozilla public license version 2.0"), ("CC0-1.0", "CC0-1.0", "cc0 1.0 universal"),
):
    _add(f"{_id}-text", (files("civiframe.llm") / "licenses" / f"{_file}.txt").read_text("utf-8"), _title)

MIN_COVERAGE = 0.8
#: Tokens whose template words are remembered by a worker.
REMEMBERED = 400_000
#: From this many words on, starts of a template that lie close together are tried once.
LONG = 64


def words_of(text: str) -> list[tuple[str, int, int]]:
    return [(m.group(), m.start(), m.end()) for m in _WORDS.finditer(text)]


def increasing(places: list[int]) -> list[int]:
    """Indexes of a longest increasing subsequence (patience sorting)."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for k, place in enumerate(places):
        pile = bisect_left(tops, place)
        back.append(piles[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(place)
            piles.append(k)
        else:
            tops[pile], piles[pile] = place, k
    out, k = [], piles[-1] if piles else -1
    while k >= 0:
        out.append(k)
        k = back[k]
    return out[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Aligned places (text, template) in increasing order."""
    pairs: list[tuple[int, int]] = []
    gaps = [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            pairs.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            pairs.append((b, d))
        if a >= b or c >= d:
            continue
        in_text, in_template = Counter(text[a:b]), Counter(template[c:d])
        at = {w: k for k, w in enumerate(text[a:b], a) if in_text[w] == 1}
        anchors = [(at[w], k) for k, w in enumerate(template[c:d], c) if in_template[w] == 1 and w in at]
        anchors = [anchors[k] for k in increasing([x for x, _ in anchors])]
        if not anchors:
            continue
        pairs += anchors
        edges = [(a - 1, c - 1), *anchors, (b, d)]
        gaps += [(x + 1, u, y + 1, v) for (x, y), (u, v) in zip(edges, edges[1:]) if x + 1 < u and y + 1 < v]
    return sorted(pairs)


class Scanner:
    def __init__(self, templates: dict[str, str], required: dict[str, list[str]] | None = None):
        self.templates = {name: [w.lower() for w, _, _ in words_of(t)] for name, t in templates.items()}
        self.needed = {name: math.ceil(MIN_COVERAGE * len(words) - 1e-9) for name, words in self.templates.items()}
        self.counts = {name: Counter(words) for name, words in self.templates.items()}
        # places of each required run in the template; one of them is aligned without a gap
        self.runs: dict[str, list[tuple[int, list[int]]]] = {}
        self.musts: dict[str, frozenset[str]] = {}
        for name, words in self.templates.items():
            phrases = [p.split() for p in (required or {}).get(name, ())]
            self.musts[name] = frozenset(w for p in phrases for w in p)
            self.runs[name] = [(len(p), [k for k in range(len(words)) if words[k : k + len(p)] == p]) for p in phrases]
            if not all(places for _, places in self.runs[name]):
                raise ValueError(f"{name}: a required run is not in the template")
        self.wanted = {w for words in self.templates.values() for w in words}
        shared = Counter(w for words in self.templates.values() for w in set(words))
        # an occurrence lacks too few words to lack all of these; the rarest in templates first, then the longest
        self.leads: dict[str, list[tuple[str, int]]] = {}
        for name, words in self.templates.items():
            held = 0
            for w in sorted(dict.fromkeys(words), key=lambda w: (shared[w], -len(w), w)):
                self.leads.setdefault(w, []).append((name, words.index(w)))
                held += words.count(w)
                if held > len(words) - self.needed[name]:
                    break
        self.known: dict[str, tuple[str, ...]] = {}

    def lookup(self, token: str) -> tuple[str, ...]:
        """The template words in a token."""
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        out = self.known[token] = tuple(w for w, _, _ in words_of(token) if w in self.wanted)
        return out

    def possible(self, text: str) -> list[str]:
        """Templates of which the text has enough words in any order."""
        present: set[str] = set()
        known, lookup = self.known, self.lookup
        for token in text.lower().split():
            found = known[token] if token in known else lookup(token)
            if found:
                present.update(found)
        return [
            name
            for name, counts in self.counts.items()
            if self.musts[name] <= present and sum(n for w, n in counts.items() if w in present) >= self.needed[name]
        ]

    def distinguished(self, name: str, pairs: list[tuple[int, int]]) -> bool:
        """Whether all required runs are aligned."""
        at = {c: a for a, c in pairs}
        return all(
            any(p in at and all(at.get(p + k) == at[p] + k for k in range(n)) for p in places) for n, places in self.runs[name]
        )

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """``(template, coverage, start, end)`` of each occurrence, by place; of occurrences
        that overlap the one with most aligned words stays."""
        names = set(self.possible(text)) if text else set()
        if not names:
            return []
        found = words_of(text)
        words = [w.lower() for w, _, _ in found]
        starts: dict[str, list[int]] = {}
        for k, w in enumerate(words):
            for name, place in self.leads.get(w, ()):
                if name in names:
                    starts.setdefault(name, []).append(k - place)
        out = []
        for name, own in starts.items():
            template, n = self.templates[name], len(self.templates[name])
            tried = sorted(set(own))
            if n >= LONG:  # a window reaches a template's length to both sides
                votes = Counter(own)
                tried = [max(near, key=lambda x: votes[x]) for _, near in groupby(tried, lambda x: x // (n // 8))]
            done = -1
            for start in tried:
                if start < done:  # in a whole occurrence
                    continue
                pairs: list[tuple[int, int]] = []
                for slack in (0, n):  # as it stands, else with other words around and between
                    lo, hi = max(0, start - slack), min(len(words), start + n + slack)
                    aligned = densest([(lo + a, c) for a, c in align(words[lo:hi], template)], n)
                    pairs = max(pairs, aligned, key=len)
                    if len(pairs) == n:
                        break
                if len(pairs) == n:
                    done = pairs[-1][0]
                if len(pairs) >= self.needed[name] and self.distinguished(name, pairs):
                    out.append((len(pairs), name, len(pairs) / n, found[pairs[0][0]][1], found[pairs[-1][0]][2]))
        kept: list[tuple[str, float, int, int]] = []
        for _, name, coverage, start, end in sorted(out, key=lambda x: (-x[0], -x[2], x[4] - x[3], x[3], x[1])):
            if all(end <= a or start >= b for _, _, a, b in kept):
                kept.append((name, coverage, start, end))
        return sorted(kept, key=lambda x: (x[2], x[0]))


def densest(pairs: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """The most pairs within a stretch of the text of twice the template's length."""
    best, first = (0, 0), 0
    for last in range(len(pairs)):
        while pairs[last][0] - pairs[first][0] >= 2 * length:
            first += 1
        best = max(best, (last + 1 - first, -first))
    return pairs[-best[1] : -best[1] + best[0]]


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row for each notice found: ``doc_id, license, coverage, start, length, matched``
    (characters from 0; the text matched). Documents without a notice have one row with nulls.

    A notice is found where a template's aligned words reach ``MIN_COVERAGE`` within twice
    its length and the words that tell it from other licences (``REQUIRED``) are aligned. Null and empty texts have no notice. Repeated rows and ids are scanned one
    by one; extra columns are not read.
    """
    scanner = Scanner(TEMPLATES, REQUIRED) if templates is None else Scanner(templates)

    def scan(batches):
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].tolist(), batch["text"].tolist()):
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                hits = scanner.scan(text)
                rows += [(doc_id, name, c, a, b - a, text[a:b]) for name, c, a, b in hits] or [(doc_id, *[None] * 5)]
            out = pd.DataFrame(rows, columns=["doc_id", "license", "coverage", "start", "length", "matched"])
            yield out.astype({"doc_id": "Int64", "coverage": "float64", "start": "Int64", "length": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(
        scan, "doc_id long, license string, coverage double, start long, length long, matched string"
    )


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(read(spark, folder, "documents"))

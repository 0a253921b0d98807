"""License scan: winnowed fingerprints pick candidates, banded alignment measures them.

Templates (a parameter) are cut into words and winnowed: of every ``WINNOW``
neighbouring hashes of ``GRAM`` words the smallest is kept, so any shared run of
``GRAM + WINNOW - 1`` words has a common fingerprint. The inverted index of the
fingerprints proposes places in a text; a banded global-in-template alignment
then reports which share of the template's words is matched, and where. Words that tell families, versions and
variants apart must match, and of templates that compete for a place the one
with the most matched words is reported.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, text_of

GRAM, WINNOW, BAND, COVERAGE = 3, 2, 6, 0.8
WORD = re.compile(r"\w+")
CACHE_WORDS = 200_000
# fixed values: words that tell licenses apart (numbers do too), and those of them that make another license where put in
TELLING = frozenset("""mit apache bsd isc gnu gpl lgpl agpl lesser library affero mozilla mpl eclipse epl creative commons cc cc0 nc
sa nd zero noncommercial sharealike noderivatives noderivs attribution boost zlib unlicense wtfpl artistic european union eupl
only later""".split())
VARIANT = frozenset("lesser library affero nc sa nd noncommercial sharealike noderivatives noderivs".split())
# fixed values: notices, opening paragraphs and short bodies of public licenses
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
           "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
           "persons to whom the Software is furnished to do so, subject to the following conditions:",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
           "provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
           "following conditions are met:",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                  "with the License. You may obtain a copy of the License at",
    "GPL": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
           "License as published by the Free Software Foundation",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "MIT-conditions": "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
                      "of the Software.",
    "MIT-disclaimer": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
                      "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
                      "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
                      "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
                      "DEALINGS IN THE SOFTWARE.",
    "ISC-disclaimer": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
                      "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
                      "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
                      "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION "
                      "WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "BSD-source-clause": "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                         "following disclaimer.",
    "BSD-binary-clause": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                         "following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-endorsement-clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                                "promote products derived from this software without specific prior written permission.",
    "BSD-4-advertising-clause": "All advertising materials mentioning features or use of this software must display the following "
                                "acknowledgement",
    "BSD-disclaimer": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
                      "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
                      "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
                      "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
                      "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
                      "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING "
                      "IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "Apache-2.0-disclaimer": "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                             "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
                             "See the License for the specific language governing permissions and limitations under the License.",
    "Unlicense-grant": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code "
                       "form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
            "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
            "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
            "restrictions:",
    "BSL-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
               "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, "
               "and transmit the Software, and to prepare derivative works of the Software",
    "BSL-1.0-notice": "Distributed under the Boost Software License, Version 1.0.",
    "CC0-1.0-waiver": "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to "
                      "this software to the public domain worldwide.",
    "MPL-2.0-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at",
    "EPL-1.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
}
for _id, _name, _versions in (("GPL", "GNU General Public License", "1 2 3"), ("LGPL", "GNU Lesser General Public License", "2.1 3"),
                              ("LGPL", "GNU Library General Public License", "2"), ("AGPL", "GNU Affero General Public License", "3"),
                              ("Apache", "Apache License", "1.1 2.0"), ("MPL", "Mozilla Public License", "1.1 2.0"),
                              ("EPL", "Eclipse Public License", "1.0 2.0"), ("EUPL", "European Union Public Licence", "1.1 1.2")):
    TEMPLATES.setdefault(f"{_id}-named" if "Library" not in _name else "LGPL-library-named", f"under the terms of the {_name}")
    for _v in _versions.split():
        _full = f"{_id}-{_v if '.' in _v else _v + '.0'}"
        TEMPLATES[f"{_full}-title"] = f"{_name}, Version {_v}"
        if _id in ("GPL", "LGPL", "AGPL"):
            _what = "library" if _v.startswith("2") and _id == "LGPL" else "program"
            TEMPLATES[f"{_full}-header"] = (f"This {_what} is free software: you can redistribute it and/or modify it under the terms of the "
                                            f"{_name} as published by the Free Software Foundation, either version {_v} of the License")
for _by, _words in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
                    ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
    for _v in ("2.0", "2.5", "3.0", "4.0"):
        TEMPLATES.setdefault(f"CC-{_by}-{_v}-notice", f"Licensed under CC {_by} {_v}.")
        TEMPLATES[f"CC-{_by}-{_v}-short"] = f"CC {_by} {_v}"
        TEMPLATES[f"CC-{_by}-{_v}-title"] = f"Creative Commons {_words} {_v}"
TEMPLATES |= {f"{_id}-SPDX": f"SPDX-License-Identifier: {_id}" for _id in (
    "MIT MIT-0 ISC 0BSD BSD-2-Clause BSD-3-Clause BSD-4-Clause Apache-1.1 Apache-2.0 GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 "
    "GPL-3.0-only GPL-3.0-or-later LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later AGPL-3.0 "
    "AGPL-3.0-only AGPL-3.0-or-later MPL-1.1 MPL-2.0 EPL-1.0 EPL-2.0 EUPL-1.2 CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0 "
    "BSL-1.0 Zlib Unlicense WTFPL Artistic-2.0").split()}
TEMPLATES |= {"CC0-1.0-title": "CC0 1.0 Universal", "MIT-title": "The MIT License", "ISC-title": "The ISC License",
              "BSD-2-title": "BSD 2-Clause License", "BSD-3-title": "BSD 3-Clause License", "Artistic-2.0-title": "The Artistic License 2.0"}
HIT = T.ArrayType(T.StructType([T.StructField("license", T.StringType()), T.StructField("coverage", T.DoubleType()),
                                T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def _hashes(ids: np.ndarray) -> np.ndarray:
    n = len(ids) - GRAM + 1
    out = np.zeros(max(0, n), dtype=np.uint64)
    for j in range(GRAM):
        out = (out ^ ids[j:j + len(out)].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return out


class Index:
    """Templates as word ids and the inverted index of their winnowed fingerprints."""

    def __init__(self, templates: dict[str, str]):
        self.vocab: dict[str, int] = {}
        self.memo: dict[str, int] = {}
        self.names, self.words, self.must, self.other, posting = [], [], [], [], defaultdict(list)
        self.variant = {w: self.vocab.setdefault(w, len(self.vocab) + 1) for w in sorted(VARIANT | {"gnu"})}
        for name, text in sorted(templates.items()):
            ids = np.array([self.vocab.setdefault(w.lower(), len(self.vocab) + 1) for w in WORD.findall(text)], dtype=np.int64)
            h = _hashes(ids)
            if not len(h):
                continue
            for s in range(max(1, len(h) - WINNOW + 1)):
                part = h[s:s + WINNOW]
                q = s + int(np.flatnonzero(part == part.min())[-1])
                if (len(self.names), q) not in posting[int(h[q])]:
                    posting[int(h[q])].append((len(self.names), q))
            self.names.append(name)
            self.words.append(ids)
            must = [i for i, w in enumerate(WORD.findall(text)) if w.lower() in TELLING or any(c.isdigit() for c in w)]
            self.must.append(np.array(must, dtype=np.int64))
            naming = any(w.lower() in TELLING for w in WORD.findall(text))
            self.other.append(np.array(sorted({self.variant[v] for v in VARIANT if naming}.difference(ids.tolist())), dtype=np.int64))
        self.posting = dict(posting)
        self.known = np.array(sorted(self.posting), dtype=np.uint64)

    def ids(self, words: list[str]) -> np.ndarray:
        if len(self.memo) > CACHE_WORDS:
            self.memo.clear()
        for w in set(words).difference(self.memo):
            self.memo[w] = self.vocab.get(w.lower(), 0)
        return np.fromiter(map(self.memo.__getitem__, words), dtype=np.int64, count=len(words))

    def find(self, text: str) -> list[dict]:
        words = WORD.findall(text)
        ids = self.ids(words)
        h = _hashes(ids)
        if not len(h) or not len(self.known):
            return []
        spot = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        places = defaultdict(set)
        for p in np.flatnonzero(self.known[spot] == h).tolist():
            for k, q in self.posting[int(h[p])]:
                places[k].add(p - q)
        out = []
        for k in sorted(places):
            free = -1
            shifts = sorted(places[k])
            groups = np.split(np.array(shifts), np.flatnonzero(np.diff(shifts) > BAND) + 1)
            for g in groups:
                last = None
                for shift in g.tolist():
                    if last is not None and shift - last <= BAND:
                        continue  # inside the band of the last one
                    last = shift
                    got = align(self.words[k], ids, shift)
                    if got is None or got[0] < COVERAGE or got[1] <= free or not got[3][self.must[k]].all():
                        continue
                    extra = got[1] + np.flatnonzero(np.isin(ids[got[1]:got[2] + 1], self.other[k]))
                    # "this library" is no variant, "GNU Library" is one
                    if any(ids[p] != self.variant["library"] or p and ids[p - 1] == self.variant["gnu"] for p in extra):
                        continue
                    free = got[2]
                    out.append((int(got[3].sum()), got[0], self.names[k], got[1], got[2]))
        if not out:
            return []
        spans = [m.span() for m in WORD.finditer(text)]
        return [{"license": name, "coverage": share, "start": spans[a][0], "end": spans[b][1]}
                for _, share, name, a, b in sorted(winners(out), key=lambda o: (o[3], o[2]))]


def winners(found: list[tuple]) -> list[tuple]:
    """(matched words, coverage, name, first, last): those without a better one over half of their words."""
    kept, owned = [], defaultdict(int)
    for one in sorted(found, key=lambda o: (-o[0], -o[1], o[2])):
        place = range(one[3], one[4] + 1)
        if 2 * sum(owned[p] for p in place) <= len(place):
            kept.append(one)
            for p in place:
                owned[p] = 1
    return kept


def align(want: np.ndarray, ids: np.ndarray, shift: int):
    """(share of template words matched, first and last matched word, which matched) of the best path within ``BAND`` of the diagonal."""
    n, width = len(want), 2 * BAND + 1
    best = np.zeros((n + 1, width), dtype=np.int64)  # matches so far; column c stands for text word i + shift + c - BAND
    move = np.zeros((n + 1, width), dtype=np.int8)
    for i in range(1, n + 1):
        for c in range(width):
            p = i - 1 + shift + c - BAND
            same = 0 <= p < len(ids) and ids[p] == want[i - 1]
            options = [(best[i - 1, c] + int(same), 0)]
            if c + 1 < width:
                options.append((best[i - 1, c + 1], 1))  # a template word without a partner
            if c:
                options.append((best[i, c - 1], 2))  # a text word without a partner
            best[i, c], move[i, c] = max(options, key=lambda o: (o[0], -o[1]))
    i, c, hit, which = n, int(best[n].argmax()), [], np.zeros(n, dtype=bool)
    while i > 0:
        if move[i, c] == 0:
            p = i - 1 + shift + c - BAND
            if 0 <= p < len(ids) and ids[p] == want[i - 1]:
                hit.append(p)
                which[i - 1] = True
            i -= 1
        elif move[i, c] == 1:
            i, c = i - 1, c + 1
        else:
            c -= 1
    return (len(hit) / n, hit[-1], hit[0], which) if hit else None


def scan(docs: DataFrame, templates: dict[str, str] | None = None, column: str = "licenses", keep=None) -> DataFrame:
    """``docs`` with ``licenses``: license, coverage, start and end (characters) of every matched template.

    Null and empty texts match nothing; templates under ``GRAM`` words are left
    out; matches of one template do not overlap, and of different templates over the
    same words the one with the most matched words stays; repeated rows each give a row; an empty table gives an empty table.
    The templates travel with the tasks: their number is fixed by the parameter.
    """
    shared = docs.sparkSession.sparkContext.broadcast(TEMPLATES if templates is None else templates)

    def build():
        index = Index(shared.value)
        return lambda texts: [[index.find(t or "") for t in texts.to_pylist()]]

    return add_columns(docs, build, ["text"], [(column, HIT)], keep)


def matches(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, license, coverage, start, end: a row per matched template."""
    return scan(docs.select("doc_id", text_of().alias("text")), templates, keep=["doc_id"]).select("doc_id", F.inline("licenses"))

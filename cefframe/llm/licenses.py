"""License scans: patience alignment of texts with license templates.

Texts and templates are sequences of lower-case words (letters and digits).  A region of a text is
aligned with a template as in patience sorting: common words at both ends are matched; words that
occur once in the region and once in the template are anchors; the longest increasing subsequence
of anchors is kept; and the gaps between kept anchors are aligned in the same way.  Coverage is the
share of the template's words that are matched; a license is found where it reaches THRESHOLD and
where the words that tell it from its rivals (KEYS: name, family, version) are matched as whole
phrases, so "GNU Lesser General" is no "GNU General" and "BY-NC-SA" no "BY-NC".

Regions: a region that reaches the threshold matches all but a few of the template's words, so of
any (words - needed + 1) places of the template at least one is matched.  The places whose words
are rarest in the text are taken; each occurrence of such a word proposes the regions in which it
could be matched, which begin at most two slacks from where the template would begin if nothing
were inserted or missing.  No other region can reach the threshold, so nothing is missed, and most
texts, which lack too many of a template's words or one of its key phrases, are not aligned at all.
The words that a region shares with the template, counted while a window slides over the text, bound
what its alignment can match: regions are aligned in falling order of that bound, until none that is
left can beat the best found.  A text full of one license thus costs one alignment, not hundreds.

Defined cases: null or empty text holds no license (license null, coverage 0); ties in coverage go
to the longer template, then to the first by name, then to the first region; "licence" counts as "license"; rows may repeat and stay; an empty table
gives an empty result; extra columns are ignored; texts of any length are scanned whole.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, table

THRESHOLD, SLACK = 0.8, 0.25

#: Openings, usual notices and headings of the licenses that are looked for (names, years
#: and owners left out), not whole licenses.  A text under another license has none of these.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution."),
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "MIT notice": "Released under the MIT License",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software."),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. 3. Neither the name of nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission."),
    "BSD notice": "Released under the BSD License",
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at mozilla.org/MPL/2.0/."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means."),
    "Apache-2.0 terms": (
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, "
        "REPRODUCTION, AND DISTRIBUTION 1. Definitions. \"License\" shall mean the terms and conditions for use, "
        "reproduction, and distribution as defined by Sections 1 through 9 of this document."),
    "MPL-2.0 terms": (
        "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity that "
        "creates, contributes to the creation of, or owns Covered Software."),
    "EPL-2.0": (
        "Eclipse Public License - v 2.0 THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE "
        "(\"AGREEMENT\"). ANY USE, REPRODUCTION OR DISTRIBUTION OF THE PROGRAM CONSTITUTES RECIPIENT'S ACCEPTANCE OF THIS "
        "AGREEMENT."),
    "CC0-1.0": (
        "CC0 1.0 Universal CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM AND DOES NOT PROVIDE LEGAL SERVICES. DISTRIBUTION "
        "OF THIS DOCUMENT DOES NOT CREATE AN ATTORNEY-CLIENT RELATIONSHIP."),
}

#: Phrases of each template that must be matched word after word.
KEYS = {
    "Apache-2.0 notice": ["apache license", "2 0"], "Apache-2.0": ["apache license", "2 0"],
    "BSD-3-Clause": ["neither the name of"], "BSD notice": ["bsd license"], "MIT notice": ["mit license"],
    "MIT": ["subject to the following conditions"], "ISC": ["provided that the above copyright notice"],
    "GPL-3.0 notice": ["gnu general public license", "version 3"],
    "GPL-3.0": ["gnu general public license", "version 3 of"],
    "CC-BY-NC-4.0 notice": ["cc by nc 4 0"],
    "MPL-2.0": ["mozilla public license v 2 0"], "Unlicense": ["free and unencumbered software"],
    "Apache-2.0 terms": ["apache license version 2 0"], "MPL-2.0 terms": ["mozilla public license version 2 0"],
    "EPL-2.0": ["eclipse public license v 2 0"], "CC0-1.0": ["cc0 1 0 universal"],
}

#: Headings, fields and references that are found word for word.
HEADINGS = {
    "MIT": ["MIT License", "License: MIT"], "ISC": ["ISC License", "License: ISC"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License v2.0", "Apache License 2.0", "License: Apache-2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "License: BSD-2-Clause"],
    "BSD-3-Clause": ["BSD 3-Clause License", "License: BSD-3-Clause"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "License: MPL-2.0"],
    "EPL-2.0": ["Eclipse Public License, version 2.0", "Eclipse Public License 2.0", "License: EPL-2.0"],
    "GPL-2.0": ["GNU General Public License v2.0", "License: GPL-2.0"],
    "GPL-3.0": ["GNU General Public License v3.0", "License: GPL-3.0"],
    "LGPL-2.1": ["GNU Lesser General Public License v2.1"], "LGPL-3.0": ["GNU Lesser General Public License v3.0"],
    "AGPL-3.0": ["GNU Affero General Public License v3.0", "License: AGPL-3.0"],
    "CC0-1.0": ["CC0 1.0 Universal", "License: CC0-1.0"], "CC-BY-4.0": ["Creative Commons Attribution 4.0 International"],
    "CC-BY-SA-4.0": ["Creative Commons Attribution-ShareAlike 4.0 International"],
    "CC-BY-ND-4.0": ["Creative Commons Attribution-NoDerivatives 4.0 International"],
    "CC-BY-NC-4.0": ["Creative Commons Attribution-NonCommercial 4.0 International"],
    "CC-BY-NC-SA-4.0": ["Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International"],
    "CC-BY-NC-ND-4.0": ["Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International"],
}
#: The GNU licenses' own first lines: family, version, date.
_FIRST = {"GPL-2.0": ("General", "2", "June 1991"), "GPL-3.0": ("General", "3", "29 June 2007"),
          "LGPL-2.1": ("Lesser General", "2.1", "February 1999"), "LGPL-3.0": ("Lesser General", "3", "29 June 2007"),
          "AGPL-3.0": ("Affero General", "3", "19 November 2007")}
_VERBATIM = ("Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license "
             "document, but changing it is not allowed.")

_GNU = (
    "This {0} is free software{1} you can redistribute it and/or modify it under the terms of the GNU {2} Public License as "
    "published by the Free Software Foundation, either version {3} of the License, or (at your option) any later version. "
    "This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.")
for _name, _what, _family, _version in (("GPL-2.0", "program", "General", "2"), ("LGPL-2.1", "library", "Lesser General", "2.1"),
                                        ("LGPL-3.0", "library", "Lesser General", "3"), ("AGPL-3.0", "program", "Affero General", "3")):
    TEMPLATES[_name] = _GNU.format(_what, ";", _family, _version)
    KEYS[_name] = [f"gnu {_family} public license".lower(), f"version {_version} of".replace(".", " ")]
    _line = f"This work is licensed under the GNU {_family} Public License"
    TEMPLATES[f"{_name} notice"] = f"{_line}, version {_version}"
    KEYS[f"{_name} notice"] = [f"gnu {_family} public license".lower(), f"version {_version}".replace(".", " ")]
for _name, _version in (("GPL-2.0", "2"), ("GPL-3.0", "3")):
    TEMPLATES[f"{_name} notice (v{_version})"] = f"This work is licensed under the GNU General Public License v{_version}"
    KEYS[f"{_name} notice (v{_version})"] = [f"gnu general public license v{_version}"]
for _kind in ("BY", "BY-SA", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
    TEMPLATES[f"CC-{_kind}-4.0 notice"] = f"Licensed under CC {_kind} 4.0"
    KEYS[f"CC-{_kind}-4.0 notice"] = [f"cc {_kind.lower().replace('-', ' ')} 4 0"]
for _name in ("MIT", "ISC", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later",
              "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later",
              "AGPL-3.0-only", "AGPL-3.0-or-later", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "Unlicense"):
    TEMPLATES[f"{_name} tag"] = f"SPDX-License-Identifier: {_name}"
    KEYS[f"{_name} tag"] = ["spdx license identifier " + re.sub(r"\W", " ", _name.lower())]

WORDS = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower().replace("licence", "license"))


for _name, (_family, _version, _date) in _FIRST.items():
    TEMPLATES[f"{_name} terms"] = f"GNU {_family} Public License Version {_version}, {_date} {_VERBATIM}"
    KEYS[f"{_name} terms"] = [" ".join(words_of(f"GNU {_family} Public License Version {_version} {_date}"))]
for _name, _forms in HEADINGS.items():
    for _k, _form in enumerate(_forms, 1):
        TEMPLATES[f"{_name} heading {_k}"] = _form
        KEYS[f"{_name} heading {_k}"] = [" ".join(words_of(_form))]


def increasing(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence, by patience sorting with links back."""
    tops, piles, back = [], [], []
    for i, v in enumerate(values):
        at = bisect_left(tops, v)
        back.append(piles[at - 1] if at else -1)
        if at == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[at], piles[at] = v, i
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched places (i in a, j in b), increasing in both."""
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: i for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1}
        pairs = [(place[w], j) for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1 and w in place]
        kept = [pairs[k] for k in increasing([i for i, _ in pairs])]
        if not kept:
            continue
        found += kept
        edges = [(a0 - 1, b0 - 1), *kept, (a1, b1)]
        todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:]) if i + 1 < k and j + 1 < m]
    return sorted(found)


class Scanner:
    def __init__(self, templates: dict[str, str], threshold: float = THRESHOLD, keys: dict[str, list[str]] | None = None):
        self.templates = [(name, words_of(text)) for name, text in sorted(templates.items())]
        self.needed = [-int(-threshold * len(w) // 1) for _, w in self.templates]
        self.vocabulary = {w for _, ws in self.templates for w in ws}
        self.keys = [[self._span(ws, words_of(p)) for p in (keys or {}).get(name, ())] for name, ws in self.templates]

    @staticmethod
    def _span(template: list[str], phrase: list[str]) -> tuple[int, int]:
        """First and last place of a phrase in the template."""
        return next((j, j + len(phrase) - 1) for j in range(len(template)) if template[j:j + len(phrase)] == phrase)

    def told(self, pairs: list[tuple[int, int]], k: int) -> bool:
        """Whether all key phrases are matched, word after word."""
        at = {j: i for i, j in pairs} if self.keys[k] else {}
        return all(j in at and at[j] == at.get(first, -1) + j - first for first, last in self.keys[k] for j in range(first, last + 1))

    def regions(self, words: list[str], places: dict[str, list[int]], k: int) -> list[tuple[int, int, int, int]]:
        """(bound, place, start, end) of the regions that can reach the threshold, by falling bound, then place."""
        template, needed = self.templates[k][1], self.needed[k]
        if not template or sum(w in places for w in template) < needed:
            return []
        for first, last in self.keys[k]:
            phrase = template[first:last + 1]
            if not any(words[i:i + len(phrase)] == phrase for i in places.get(phrase[0], ())):
                return []
        rare = sorted(range(len(template)), key=lambda j: (len(places.get(template[j], ())), j))[:len(template) - needed + 1]
        slack = int(len(template) * SLACK) + 1
        want, have, bound, lo, hi, found = Counter(template), Counter(), 0, 0, 0, []
        done = -2 * len(template) - 2 * slack  # no region starts here or before
        for middle in sorted({at - j for j in rare for at in places.get(template[j], ())}):
            for s in range(max(done + 1, middle - 2 * slack), middle + 2 * slack + 1):
                done = s
                a, b = max(0, s - slack), min(len(words), s + len(template) + slack)
                if a >= b or (found and found[-1][2:] == (a, b)):
                    continue
                if a >= hi:
                    have.clear()
                    bound, lo, hi = 0, a, a
                for w in words[hi:b]:
                    if w in want:
                        have[w] += 1
                        bound += have[w] <= want[w]
                for w in words[lo:a]:
                    if w in want:
                        bound -= have[w] <= want[w]
                        have[w] -= 1
                lo, hi = a, b
                if bound >= needed:
                    found.append((bound, s, a, b))
        return sorted(found, key=lambda r: -r[0])

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(license, coverage, first word, last word) of each license found, best region of each."""
        words = words_of(text)
        places: dict[str, list[int]] = defaultdict(list)
        if not self.vocabulary.isdisjoint(words):
            for i, w in enumerate(words):
                if w in self.vocabulary:
                    places[w].append(i)
        found = []
        for k, (name, template) in enumerate(self.templates):
            best, where = None, None
            for bound, s, a, b in self.regions(words, places, k):
                # What is left matches fewer words, or as many in a later region.
                if best and (bound, -s) < (best[0], -where):
                    break
                pairs = align(words[a:b], template)
                if len(pairs) >= self.needed[k] and (best is None or (len(pairs), -s) > (best[0], -where)) and self.told(pairs, k):
                    best, where = (len(pairs), a + pairs[0][0], a + pairs[-1][0]), s
            if best:
                found.append((name, best[0] / len(template), best[1], best[2]))
        return found


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = THRESHOLD, keys: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per document: id, license and coverage of the best find, its words, n_licenses, all licenses."""
    wording = dict(TEMPLATES if templates is None else templates)
    keys = KEYS if templates is None and keys is None else keys

    def run(batches):
        scanner = Scanner(wording, threshold, keys)
        length = {name: len(words) for name, words in scanner.templates}
        for batch in batches:
            cols = [[] for _ in range(6)]
            for cell in batch.column(1):
                found = scanner.scan(cell.as_py())
                best = min(found, key=lambda f: (-f[1], -length[f[0]], f[0])) if found else (None, 0.0, None, None)
                for col, value in zip(cols, (*best, len(found), [f[0] for f in found])):
                    col.append(value)
            kinds = [pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                                             ["id", "license", "coverage", "first_word", "last_word", "n_licenses", "licenses"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_arrow(rows, run, "id long, license string, coverage double, first_word long, last_word long, "
                                "n_licenses long, licenses array<string>").withColumnRenamed("id", id_col)


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))

"""License scan by patience alignment of texts with license templates.

Words that occur once in the text and once in the template are anchors; the
longest increasing subsequence of their places in both is the backbone of the
alignment; the gaps between its words are aligned the same way, after equal
words at their ends.  Coverage is the part of the template's words that are
aligned.

A text is aligned where a template can be: places of a template's own words
are gathered into clusters, and a cluster is cut into parts where a word comes
again that the template has once, so repeated notices are windows of their
own.  Such a word may also come again inside one notice (after a copyright
line, say), so each cluster is also aligned in overlapping windows of the
template's size, twice that, and so on up to the cluster's; windows that share
too few words with the template to reach the least coverage, or the best so
far, are passed over, and the best window counts.  The parts of the text before
and after it are then searched the same way, until no part holds a match, so
every place of a template is found; larger windows are tried in such a part
only where smaller ones match nothing, and of equal matches the one nearest the
middle splits it (one that is wide enough for two matches, and holds them, is
both), so thousands of copies of a notice in one text take about the
logarithm of their number in passes.  Texts without any of a
template's signal words are passed over; the signal words are so many that no
text without them reaches the least coverage, so nothing is lost.  Each text
is handled whole, in the task that reads it: nothing is shuffled.

Longer texts (a whole GPL, say) are given as a parameter: ``read_templates``
reads a folder of them.

Defined results: a null or empty text has no words and no license; of
templates with equal coverage the longer one wins, then the first by name, and
of equal places of a template the first; places of one template never overlap,
those of two templates may (a header holds a notice); a template without words
matches nothing; a null ``doc_id`` stays; repeated rows give equal rows; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Least part of a template's words for a match.
LEAST_COVERAGE = 0.8
#: Most bytes of templates read from a folder; every task holds all of them.
TEMPLATE_BYTES = 16 << 20
#: Wording of common license notices and texts.
TEMPLATES = {
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS "
    "IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
    "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
    "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
    "SOFTWARE.",
    "AGPL-3.0-or-later (header)": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the "
    "Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will "
    "be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero "
    "General Public License for more details. You should have received a copy of the GNU Affero General Public License along with this program.",
    "Apache-2.0 (header)": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a "
    "copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed "
    "under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for "
    "the specific language governing permissions and limitations under the License.",
    "Apache-2.0 (notice)": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary "
    "form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
    "provided with the distribution.",
    "BSD-2-Clause (with disclaimer)": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary "
    "form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
    "provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN "
    "IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary "
    "form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
    "provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.",
    "BSD-3-Clause (with disclaimer)": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary "
    "form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
    "provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" "
    "AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE "
    "ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
    "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "BSL-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by "
    "this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the "
    "Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software "
    "and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the "
    "Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of "
    "machine-executable object code generated by a source language processor.",
    "CC-BY-4.0 (notice)": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0 (notice)": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0 (notice)": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0 (notice)": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0-or-later (header)": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
    "Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be "
    "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
    "License for more details.",
    "GPL-3.0 (notice)": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-or-later (header)": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
    "Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be "
    "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
    "License for more details.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
    "copyright notice and this permission notice appear in all copies.",
    "ISC (with disclaimer)": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
    "copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH "
    "REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "LGPL-2.1-or-later (header)": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the "
    "Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it "
    "will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser "
    "General Public License for more details.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
    "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MIT (notice)": "Released under the MIT License.",
    "MIT (with disclaimer)": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
    "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS "
    "IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
    "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
    "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "MPL-2.0 (header)": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can "
    "obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute "
    "this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions "
    "that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We "
    "make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt "
    "act of relinquishment in perpetuity of all present and future rights to this software under copyright law.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from "
    "the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
    "redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that you "
    "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not "
    "required. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. This notice may not "
    "be removed or altered from any source distribution.",
}
#: Words too common to hold a place.
COMMON = frozenset("a an and any are as at be by for from if in is it not of on or that the this to was with you".split())
_WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, in order of the first, in which the second increases (patience sorting)."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for k, (_, b) in enumerate(pairs):
        pile = bisect_left(tops, b)
        back.append(at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(b)
            at.append(k)
        else:
            tops[pile], at[pile] = b, k
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Aligned places (text, template), increasing in both."""
    out: list[tuple[int, int]] = []
    gaps = [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        here, there = Counter(text[a:b]), Counter(template[c:d])
        place = {w: k for k, w in enumerate(template[c:d], c) if there[w] == 1 and here[w] == 1}
        backbone = increasing([(k, place[w]) for k, w in enumerate(text[a:b], a) if w in place])
        if not backbone:
            continue
        out += backbone
        edges = [(a - 1, c - 1), *backbone, (b, d)]
        gaps += [(x + 1, y, u + 1, v) for (x, u), (y, v) in zip(edges, edges[1:])]
    return sorted(out)


class Template:
    def __init__(self, name: str, text: str, least: float):
        self.name = name
        self.words = words(text)
        self.count = Counter(self.words)
        self.least = least
        self.own = {w for w in self.words if w not in COMMON}
        # Signal words, the rarest kind first: without them, fewer than the least part of the words are left.
        self.signals: set[str] = set()
        for w in sorted(self.own, key=lambda w: (-len(w), w)):
            if (len(self.words) - sum(self.count[s] for s in self.signals)) / len(self.words) < least:
                break
            self.signals.add(w)

    def windows(self, text: list[str]) -> Iterator[tuple[int, int, int, int]]:
        """(first word, end, words shared with the template, length it is made for) of parts of a text that may hold the template, short ones first."""
        size = len(self.words)
        places = [k for k, w in enumerate(text) if w in self.count]
        # No alignment has more words than what both have in common.
        if (Counter(text[k] for k in places) & self.count).total() < self.least * size:
            return
        groups: list[list[int]] = []
        clusters: list[tuple[int, int]] = []
        seen: set[str] = set()
        for k in places:
            w = text[k]
            if w not in self.own:
                continue
            near = bool(groups) and k - groups[-1][-1] <= size
            if near:
                clusters[-1] = clusters[-1][0], k + 1
            else:
                clusters.append((k, k + 1))
            if not near or (w in seen and self.count[w] == 1):
                groups.append([])
                seen = set()
            groups[-1].append(k)
            seen.add(w)
        # Room on both sides for the template's common words, up to the next group.
        for n, group in enumerate(groups):
            before = groups[n - 1][-1] + 1 if n else 0
            after = groups[n + 1][0] if n + 1 < len(groups) else len(text)
            first, end = max(before, group[0] - size), min(after, group[-1] + size + 1)
            yield first, end, (Counter(text[first:end]) & self.count).total(), size
        # A part of up to ``length`` words lies in one of these whole, wherever it begins.
        clusters = [(max(0, first - size), min(len(text), end + size)) for first, end in clusters]
        length = size
        while clusters:
            step = max(1, length // 8)
            for first, end in clusters:
                inside = places[bisect_left(places, first): bisect_left(places, end)]
                have: Counter = Counter()
                shared = low = high = 0
                for start in range(first, end, step):
                    stop = min(end, start + length + step)
                    while high < len(inside) and inside[high] < stop:
                        w = text[inside[high]]
                        have[w] += 1
                        shared += have[w] <= self.count[w]
                        high += 1
                    while low < high and inside[low] < start:
                        w = text[inside[low]]
                        shared -= have[w] <= self.count[w]
                        have[w] -= 1
                        low += 1
                    if shared >= self.least * size:
                        yield start, stop, shared, length
                    if stop == end:
                        break
            clusters = [(first, end) for first, end in clusters if length < end - first]
            length *= 2

    def aligned(self, text: list[str], first: int, end: int) -> tuple[float, int, int]:
        """(coverage, first word, end) of the alignment of text[first:end]; aligned again where fewer words around it make more of them unique."""
        pairs = align(text[first:end], self.words)
        if not pairs:
            return 0.0, first, first
        while True:
            first, end = first + pairs[0][0], first + pairs[-1][0] + 1
            again = align(text[first:end], self.words)
            if len(again) <= len(pairs):
                return len(pairs) / len(self.words), first, end
            pairs = again

    def match(self, text: list[str]) -> tuple[float, int, int]:
        """(coverage, first word, end) of the best window, of equals the one aligned first; coverage 0 if there is none."""
        best = (0.0, 0, 0)
        for first, end, shared, _ in self.windows(text):
            if shared / len(self.words) < max(self.least, best[0]) or (shared / len(self.words) == best[0] and first >= best[1]):
                continue
            found = self.aligned(text, first, end)
            if found[0] > best[0] or (found[0] == best[0] and found[1] < best[1]):
                best = found
        return best

    def split(self, text: list[str]) -> tuple[float, int, int]:
        """Like ``match``, but of the shortest windows that match at all, and of equals the one nearest the middle."""
        best, off, reached = (0.0, 0, 0), len(text) + 1, 0
        for first, end, shared, length in self.windows(text):
            if best[0] >= self.least and length > reached:
                break
            reached = length
            bound = shared / len(self.words)
            if bound < max(self.least, best[0]) or (bound == best[0] and max(2 * first - len(text), len(text) - 2 * end) >= off):
                continue
            found = self.aligned(text, first, end)
            away = abs(found[1] + found[2] - len(text))
            if found[0] > best[0] or (found[0] == best[0] > 0 and away < off):
                best, off = found, away
        return best

    def halves(self, text: list[str], first: int, end: int) -> tuple[tuple[float, int, int], tuple[float, int, int], int] | None:
        """Two matches that a place long enough for both consists of, and where it is cut: words of two changed copies can also make one wide match."""
        least = math.ceil(self.least * len(self.words))
        best = None
        if end - first > 4 * len(self.words):
            # Too wide for every cut: the shortest match inside, and one beside it.
            coverage, a, b = self.split(text[first:end])
            if coverage < self.least:
                return None
            inner = coverage, first + a, first + b
            for c, d in ((first, first + a), (first + b, end)):
                coverage, e, f = self.split(text[c:d])
                if coverage >= self.least:
                    other = coverage, c + e, c + f
                    return (other, inner, d) if d == inner[1] else (inner, other, c)
            return None
        for cut in range(first + least, end - least + 1, max(1, len(self.words) // 16)):
            left = self.aligned(text, first, cut)
            if left[0] >= self.least:
                right = self.aligned(text, cut, end)
                if right[0] >= self.least and (best is None or left[0] + right[0] > best[0][0] + best[1][0]):
                    best = left, right, cut
        return best

    def everywhere(self, text: list[str]) -> list[tuple[float, int, int]]:
        """(coverage, first word, end) of all places of the template, which do not overlap, in order."""
        best = self.match(text)
        out = []
        todo = [(best, 0, len(text))]
        while todo:
            (coverage, first, end), a, b = todo.pop()
            if coverage < self.least:
                continue
            two = self.halves(text, first, end)
            if two:
                left, right, cut = two
                todo += [(left, a, cut), (right, cut, b)]
                continue
            out.append((coverage, first, end))
            for c, d in ((a, first), (end, b)):
                if d - c >= self.least * len(self.words):
                    coverage, first_in, end_in = self.split(text[c:d])
                    todo.append(((coverage, c + first_in, c + end_in), c, d))
        return sorted(out, key=lambda m: m[1])


def templates(given: dict[str, str] | None = None, least: float = LEAST_COVERAGE) -> list[Template]:
    return [Template(n, t, least) for n, t in sorted((given or TEMPLATES).items()) if words(t)]


def read_templates(spark: SparkSession, folder: str) -> dict[str, str]:
    """Templates from a folder of text files, named by their files; at most TEMPLATE_BYTES of them."""
    files = spark.read.text(folder, wholetext=True)
    size = files.agg(F.sum(F.octet_length("value"))).first()[0] or 0
    if size > TEMPLATE_BYTES:
        raise ValueError(f"{folder} has {size} bytes of templates, more than {TEMPLATE_BYTES}")
    name = F.regexp_replace(F.element_at(F.split(F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B")), "/"), -1), r"\.[A-Za-z]+$", "")
    return {r.name: r.value for r in files.select(name.alias("name"), "value").collect()}


def places(found: list[str], known: list[Template]) -> list[tuple[Template, list[tuple[float, int, int]]]]:
    """Each template that a text's words hold with all its places, the template with the best place first."""
    here = set(found)
    out = [(t, t.everywhere(found)) for t in known if not t.signals.isdisjoint(here)]
    out = [(t, every) for t, every in out if every]
    out.sort(key=lambda x: (-max(x[1])[0], -len(x[0].words), x[0].name))
    return out


def scan(text: str, known: list[Template]) -> list[tuple[str, float, int, int]]:
    """(template, coverage, first word, end) of the best place of each template found in a whole text, best first."""
    return [(t.name, *max(every, key=lambda m: (m[0], -m[1]))) for t, every in places(words(text), known)]


_OCCURRENCE = pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("first_word", pa.int64()), ("end_word", pa.int64())])


def _scan(given: dict[str, str] | None, least: float, id_type: pa.DataType):
    schema = pa.schema([("doc_id", id_type), ("n_words", pa.int64()), ("license", pa.string()), ("coverage", pa.float64()), ("first_word", pa.int64()), ("end_word", pa.int64()),
                        ("matches", pa.list_(pa.string())), ("occurrences", pa.list_(_OCCURRENCE))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = templates(given, least)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                found = words(text.as_py() or "")
                hits = places(found, known)
                every = sorted(((t.name, *m) for t, all_of_it in hits for m in all_of_it), key=lambda m: (m[2], -m[3], m[0]))
                best = (hits[0][0].name, *max(hits[0][1], key=lambda m: (m[0], -m[1]))) if hits else (None, 0.0, None, None)
                rows.append((doc_id, len(found), *best, [t.name for t, _ in hits], [dict(zip(_OCCURRENCE.names, m)) for m in every]))
            columns = list(zip(*rows)) if rows else [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def license_scan(docs: DataFrame, given: dict[str, str] | None = None, least: float = LEAST_COVERAGE) -> DataFrame:
    """(doc_id, n_words, license, coverage, first_word, end_word, matches, occurrences): the best place of the best template of each text,
    all templates that match, best first, and all their places, in the text's order."""
    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(
        _scan(given, least, pa.int64()), "doc_id long, n_words long, license string, coverage double, first_word long, end_word long, matches array<string>, "
        "occurrences array<struct<license: string, coverage: double, first_word: long, end_word: long>>")


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    """Licenses of every whole text of ``documents``."""
    from sideline.llm.common import table

    return license_scan(table(spark, sf_dir, "documents"))

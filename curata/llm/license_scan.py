"""License scans by patience alignment.

Words (runs of letters and digits, A-Z lower-cased) that are unique to both a stretch of the text and the template are
anchors; the longest increasing subsequence of their places is kept, and the gaps between neighbours are aligned the
same way, after equal words at both ends of a gap are paired. A gap without a word that is unique to both is aligned by
a longest common subsequence. Coverage is the share of the template's words that are paired, and it alone decides.

Stretches are windows of the text of three sizes, so that a notice of up to twice its template's words lies whole in one of
them, and one that stands alone in a tight one, where the words around it can't spoil its anchors. A window that hasn't
enough of the template's words is passed over, and so is a text, which is counted for a whole batch at once; that
loses nothing, since a pair needs its word. Of the alignments that pair enough, those that pair most are places, without
overlap.

Some words make a licence another one: the name, the version, a clause. A template's obligatory words must be paired, and
none of QUALIFIERS that the template hasn't may stand within the place. A place that overlaps one of another template
with more paired words is a part of that licence, not one of its own.

A null or empty text has no licence. Rows are scanned one by one: repeated rows repeat their results, and of equally
good places the first counts. Texts are read whole; memory is bounded by a batch's bytes or one text. An empty table
gives no rows. Further columns are not read.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.llm.common import IS_PUNCTUATION, lower_ascii, pieces, quoted, small_batches, span_hashes, text_buffer, words_of

#: Whole texts of short public licences, and the notices by which files are put under the longer ones.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "mit-notice": "Released under the MIT License.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        'You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, '
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "mit": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "mit-grant": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. '
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution. "
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES '
        "OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
        "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; "
        "OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY "
        "WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "bsd-3-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution. "
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission. "
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES '
        "OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
        "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; "
        "OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY "
        "WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "bsd-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution."
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: "
        "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the "
        "product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. "
        "3. This notice may not be removed or altered from any source distribution."
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code "
        "form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software "
        "dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and "
        "successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law."
    ),
    "gpl-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation; either version 2 of the License, or (at your option) any later version."
    ),
    "gpl-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "lgpl-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
        "the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."
    ),
    "agpl-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
        "You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
}

#: Words of each template without which a text is under another licence.
OBLIGATORY = {
    "apache-2.0-notice": ("apache", "2"), "mit-notice": ("mit",), "gpl-3.0-notice": ("general", "public", "3"), "cc-by-nc-4.0-notice": ("cc", "by", "nc", "4"), "all-rights-reserved": ("all", "rights", "reserved"),
    "apache-2.0": ("apache",), "bsd-3-clause": ("neither", "endorse"), "gpl-2.0": ("general", "2"), "gpl-3.0": ("general", "3"), "lgpl-2.1": ("lesser", "2", "1"), "agpl-3.0": ("affero", "3"),
    "mpl-2.0": ("mozilla",), "cc-by-4.0": ("creative", "commons", "attribution", "4"), "cc-by-sa-4.0": ("creative", "commons", "attribution", "sharealike", "4"),
}
#: Words that make another licence of the one in whose notice they stand.
QUALIFIERS = ("lesser", "affero", "nc", "sa", "nd", "sharealike", "noncommercial", "noderivatives", "noderivs")
#: Windows: their size and step, in quarters of the template's words.
WINDOWS = ((12, 4), (8, 2), (5, 1))


def words(text: str) -> list[str]:
    raw = lower_ascii(np.frombuffer(text.encode(), np.uint8))
    start, end, _ = words_of(raw, np.array([0, len(raw)]), IS_PUNCTUATION)
    data = raw.tobytes()
    return [data[a:z].decode() for a, z in zip(start.tolist(), end.tolist(), strict=True)]


def longest_increasing(values: Sequence[int]) -> list[int]:
    """Indexes of a longest increasing subsequence: piles of patience, each card pointing to the pile before."""
    tops: list[int] = []
    top_values: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(top_values, v)
        before[i] = tops[k - 1] if k else -1
        tops[k : k + 1] = [i]
        top_values[k : k + 1] = [v]
    out, i = [], tops[-1] if tops else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(text: Sequence, template: Sequence) -> list[tuple[int, int]]:
    """Pairs (place in text, place in template) of a patience alignment, in order. The text is a few templates long."""
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
        if a >= b or c >= d:
            continue
        here, there = Counter(text[a:b]), Counter(template[c:d])
        place = {text[i]: i for i in range(a, b) if here[text[i]] == 1}
        anchors = [(place[template[j]], j) for j in range(c, d) if there[template[j]] == 1 and template[j] in place]
        kept = [anchors[i] for i in longest_increasing([i for i, _ in anchors])]
        if not kept:
            out += [(a + i, c + j) for i, j in common(text[a:b], template[c:d])]
            continue
        out += kept
        edges = [(a - 1, c - 1), *kept, (b, d)]
        gaps += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:], strict=False)]
    return sorted(out)


def common(text: Sequence, template: Sequence) -> list[tuple[int, int]]:
    """Pairs (place in text, place in template) of a longest common subsequence: a row of the table is the bits of one
    integer, clear where the length grows."""
    bits: dict = {}
    for j, x in enumerate(template):
        bits[x] = bits.get(x, 0) | 1 << j
    full = (1 << len(template)) - 1
    rows, v = [], full
    for x in text:
        u = v & bits.get(x, 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    out, i, j = [], len(text), len(template)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                j -= 1
                out.append((i, j))
    return out[::-1]


def windows(n_text: int, n_template: int) -> Iterator[tuple[int, int]]:
    """Start and end of each window of a text."""
    for size, step in WINDOWS:
        width, step = -(-size * n_template // 4), max(1, step * n_template // 4)
        start = 0
        while True:
            yield start, min(n_text, start + width)
            if start + width >= n_text:
                break
            start += step


def places(ids: Sequence[int], template: Sequence[int], least: int, obligatory: Sequence[int] = (), others: Sequence[int] = ()) -> list[tuple[int, int, int]]:
    """(words paired, first word, end word) of the places where at least `least` of the template's words are aligned, the
    obligatory ones among them, with none of the others in between; those that pair most, then the shorter, then the
    first, without overlap."""
    whole, needed, barred = Counter(template), set(obligatory), set(others) - set(template)
    held = np.concatenate([[0], np.cumsum(np.isin(ids, template))])
    found: set[tuple[int, int, int]] = set()
    for a, z in windows(len(ids), len(template)):
        if held[z] - held[a] < least or (Counter(ids[a:z]) & whole).total() < least:
            continue
        pairs = align(ids[a:z], template)
        if len(pairs) < least:
            continue
        first, end = a + pairs[0][0], a + pairs[-1][0] + 1
        if needed <= {template[j] for _, j in pairs} and barred.isdisjoint(ids[first:end]):
            found.add((-len(pairs), end - first, first))
    out: list[tuple[int, int, int]] = []
    for n, size, first in sorted(found):
        if all(first >= e or first + size <= f for _, f, e in out):
            out.append((-n, first, first + size))
    return out


class Scanner:
    def __init__(self, templates: dict[str, str], least: float, obligatory: dict[str, Sequence[str]]) -> None:
        self.least, self.names = least, list(templates)
        split = [words(t) for t in templates.values()]
        vocabulary = sorted({w for t in split for w in t} | set(QUALIFIERS))
        number = {w: i for i, w in enumerate(vocabulary)}
        self.templates = [[number[w] for w in t] for t in split]
        self.obligatory = [[number[w] for w in obligatory.get(name, ())] for name in templates]
        self.qualifiers = [number[w] for w in QUALIFIERS]
        self.counts = np.array([np.bincount(t, minlength=len(vocabulary)) for t in self.templates])
        joined = "".join(vocabulary).encode()
        ends = np.cumsum([len(w.encode()) for w in vocabulary])
        hashes = span_hashes(np.frombuffer(joined, np.uint8), ends - [len(w.encode()) for w in vocabulary], ends)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def number(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The vocabulary's number of each word of all texts, -1 for others; offsets of the texts."""
        data = lower_ascii(data)
        start, end, at = words_of(data, offsets, IS_PUNCTUATION)
        h = span_hashes(data, start, end)
        i = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[i] == h, self.order[i], -1), at

    def scan(self, ids: np.ndarray, at: np.ndarray) -> Iterator[tuple]:
        """(row, template, paired words, first word, end word, places found, template of which it is a part or None) of
        each template that a text covers."""
        n, size = len(at) - 1, self.counts.shape[1]
        known = np.flatnonzero(ids >= 0)
        row = np.searchsorted(at, known, side="right") - 1
        held = np.bincount(row * size + ids[known], minlength=n * size).reshape(n, size)
        found: dict[int, dict[int, list[tuple[int, int, int]]]] = {}
        for t, template in enumerate(self.templates):
            need = self.least * len(template)
            for r in np.flatnonzero(np.minimum(held, self.counts[t]).sum(axis=1) >= need).tolist():
                if own := places(ids[at[r] : at[r + 1]].tolist(), template, max(1, math.ceil(need - 1e-9)), self.obligatory[t], self.qualifiers):
                    found.setdefault(r, {})[t] = own
        for r in sorted(found):
            for t, own in found[r].items():
                wholes = [self._whole(found[r], t, place) for place in own]
                paired, first, end = own[0]
                yield r, t, paired, first, end, len(own), wholes[0] if None not in wholes else None

    def _whole(self, found: dict[int, list[tuple[int, int, int]]], t: int, place: tuple[int, int, int]) -> int | None:
        """The template whose place overlaps this one and pairs more words, or as many and more of its own; the most."""
        paired, first, end = place
        rank = lambda n, u: (n, n / len(self.templates[u]), -u)
        better = [(rank(n, u), u) for u, own in found.items() if u != t for n, f, e in own if f < end and first < e and rank(n, u) > rank(paired, t)]
        return max(better)[1] if better else None


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8, doc_id: str = "doc_id", text: str = "text", obligatory: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """doc_id, license, n_paired, n_template (words), first_word, end_word of the best place, n_found (bigint), part_of (the
    licence that it is a part of, null for one of its own): a row for each licence that at least `least` of is in a
    document. obligatory: words of templates of one's own that must be paired."""
    small_batches(docs.sparkSession)
    obligatory = OBLIGATORY if templates is None else obligatory or {}
    templates = templates or TEMPLATES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, least, obligatory)
        for batch in batches:
            for b in pieces(batch, "text"):
                hits = list(scanner.scan(*scanner.number(*text_buffer(b.column(1)))))
                if not hits:
                    continue
                rows, which, paired, first, end, found, whole = zip(*hits, strict=True)
                columns = [b.column(0).take(pa.array(rows)), pa.array([scanner.names[t] for t in which]), *(pa.array(x, pa.int64()) for x in (paired, [len(scanner.templates[t]) for t in which], first, end, found)), pa.array([None if w is None else scanner.names[w] for w in whole], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "license", "n_paired", "n_template", "first_word", "end_word", "n_found", "part_of"])

    source = docs.select(F.col(quoted(doc_id)).cast("bigint").alias("doc_id"), F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"))
    return source.mapInArrow(run, "doc_id bigint, license string, n_paired bigint, n_template bigint, first_word bigint, end_word bigint, n_found bigint, part_of string")

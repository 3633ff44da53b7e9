"""License scans by patience alignment.

Words of a text and a template that are unique to both are anchors; the longest increasing subsequence of their
places keeps their order, and the gaps between anchors are aligned in the same way. The matched words give the
coverage of the template. Regions to align are those where the words of a template crowd.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import Texts, Words, slices
from tidemark.llm.shipping import shipped

shipped(__name__)

COVERAGE = 0.8
STRETCH = 1.5  # words of a region for each word of the template
FILTER_BITS = 20

# Short lines as they are in use, notices in full as their licenses state them.
TEMPLATES = {
    "AGPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero "
        "General Public License for more details. You should have received a copy of the GNU Affero General Public License "
        "along with this program. If not, see <https://www.gnu.org/licenses/>."
    ),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS "
        "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, "
        "INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
        "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
        "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN "
        "ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS "
        "PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT "
        "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN "
        "NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
        "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
        "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
        "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
        "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "BSL-1.0 header": (
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
        "https://www.boost.org/LICENSE_1_0.txt)"
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details. You should have received a copy of the GNU General Public License along with this "
        "program. If not, see <https://www.gnu.org/licenses/>."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
        "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."
    ),
    "LGPL-3.0 header": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser "
        "General Public License for more details. You should have received a copy of the GNU Lesser General Public License "
        "along with this library. If not, see <https://www.gnu.org/licenses/>."
    ),
    "MIT": "Released under the MIT License",
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
        "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
        "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "MPL-2.0 header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
}


def folded() -> np.ndarray:
    """ASCII letters in lower case, other ASCII that is no letter or digit to a space."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] = table[97:123]
    for b in range(128):
        if not chr(b).isalnum():
            table[b] = 32
    return table


def increasing(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence, by patience sorting: each pile remembers its top, each card the top
    of the pile before."""
    tops: list[int] = []
    cards: list[int] = []
    back: list[int] = []
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        if pile == len(tops):
            tops.append(v)
            cards.append(i)
        else:
            tops[pile], cards[pile] = v, i
        back.append(cards[pile - 1] if pile else -1)
    out, i = [], cards[-1] if cards else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def aligned(text: list[int], template: list[int]) -> list[tuple[int, int]]:
    """Pairs of equal words, increasing on both sides. Gaps are worked off from a list, not by recursion."""
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:  # common words at either end need no anchor
            pairs.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            pairs.append((b, d))
        if a == b or c == d:
            continue
        left, right = Counter(text[a:b]), Counter(template[c:d])
        places = {w: i for i, w in enumerate(text[a:b], a) if left[w] == 1 and right.get(w) == 1}
        anchors = [(places[w], j) for j, w in enumerate(template[c:d], c) if w in places]
        chosen = [anchors[i] for i in increasing([i for i, _ in anchors])]
        pairs += chosen
        if chosen:
            borders = [(a - 1, c - 1), *chosen, (b, d)]
            todo += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(borders, borders[1:])]
    return sorted(pairs)


class Templates:
    """Words of the templates, with the number of different ones that a region needs."""

    def __init__(self, texts: Mapping[str, str], coverage: float):
        self.names, self.splitter, self.table = list(texts), Words(lower=True), folded()
        self.words = [self.hashes(Texts(pa.array([t])))[0].tolist() for t in texts.values()]
        self.keys = np.unique(np.array([w for t in self.words for w in t], np.uint64))
        number = {int(k): i for i, k in enumerate(self.keys)}
        self.words = [[number[w] for w in t] for t in self.words]
        self.member = np.zeros((len(self.keys), len(self.names)), bool)
        for i, t in enumerate(self.words):
            self.member[t, i] = True
        self.coverage, self.needed = coverage, [math.ceil(coverage * len(t)) for t in self.words]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.keys >> np.uint64(64 - FILTER_BITS)] = True

    def hashes(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        texts.data = self.table[texts.data]
        return self.splitter.hashes(texts)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for those of no template."""
        out = np.full(len(hashes), -1, np.int64)
        own = np.flatnonzero(self.filter[hashes >> np.uint64(64 - FILTER_BITS)])
        if len(own) and len(self.keys):
            at = np.searchsorted(self.keys, hashes[own])
            at[at == len(self.keys)] = 0
            right = self.keys[at] == hashes[own]
            out[own[right]] = at[right]
        return out

    def scan(self, words: np.ndarray) -> list[tuple[str, int, int, int, float]]:
        """(template, start, end, matched words, coverage) of a text; where templates overlap, the most words win."""
        hits = np.flatnonzero(words >= 0)
        present = np.zeros(len(self.keys), bool)
        present[words[hits]] = True
        found = []
        for i, template in enumerate(self.words):
            if not template or self.member[present, i].sum() < self.needed_different(i):
                continue
            own = hits[self.member[words[hits], i]]
            width, at = math.ceil(STRETCH * len(template)), 0
            ends = np.searchsorted(own, own + width)
            while at < len(own):
                stop = int(ends[at])
                if stop - at < self.needed[i] or len(set(words[own[at:stop]].tolist())) < self.needed_different(i):
                    at += 1
                    continue
                start = int(own[at])
                pairs = aligned(words[start : start + width].tolist(), template)
                if len(pairs) < self.needed[i]:
                    at += 1
                    continue
                begin, end = start + pairs[0][0], start + pairs[-1][0] + 1
                found.append((len(pairs), -(end - begin), begin, end, i))
                at = max(int(np.searchsorted(own, end)), at + 1)
        found.sort(key=lambda f: (-f[0], -f[1], len(self.words[f[4]]), f[2], f[4]))
        kept: list[tuple[int, int, int, int, int]] = []
        for hit in found:
            if all(hit[3] <= other[2] or hit[2] >= other[3] for other in kept):
                kept.append(hit)
        return sorted(
            ((self.names[i], begin, end, matched, matched / len(self.words[i])) for matched, _, begin, end, i in kept), key=lambda r: r[1]
        )

    def needed_different(self, i: int) -> int:
        """Different words that a region with enough matched words has at least."""
        counts = sorted(Counter(self.words[i]).values(), reverse=True)
        need, different = self.needed[i], 0
        while need > 0:
            need -= counts[different]
            different += 1
        return different


def scanned(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, license, start, end, matched, coverage): the regions of each text that cover a template.

    Words are runs of ASCII letters, digits and other than ASCII letters, A-Z in lower case; start and end count words
    of the text. A region of at most 1.5 words for each word of the template is reported if its alignment matches
    `coverage` of the template's words. Of overlapping regions the one with the most matched words stays, then the
    shorter one, then that of the shorter template, then the earlier one, then that of the first template. Null and empty texts and templates have none; repeated rows are reported alike; other columns are
    not returned. The templates are a parameter of the job and are shipped with it.
    """
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = given.schema["id"].dataType.simpleString()
    texts = dict(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Templates(texts, coverage)
        least = min((own.needed_different(i) for i, t in enumerate(own.words) if t), default=None)
        for batch in batches:
            for piece in slices(batch, 1):
                hashes, bounds = own.hashes(Texts(piece.column(1)))
                words = own.numbers(hashes)
                found: list[list] = [[] for _ in range(6)]
                many = np.concatenate([[0], np.cumsum(words >= 0)])
                busy = np.flatnonzero(many[bounds[1:]] - many[bounds[:-1]] >= least) if least else []
                for i in busy:
                    for hit in own.scan(words[bounds[i] : bounds[i + 1]]):
                        for column, value in zip(found, (i, *hit)):
                            column.append(value)
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
                ids = piece.column(0).take(pa.array(found[0], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array(c, k) for c, k in zip(found[1:], kinds))], ["id", "license", "start", "end", "matched", "coverage"]
                )

    result = given.mapInArrow(run, f"id {kind}, license string, start long, end long, matched long, coverage double")
    return result.withColumnRenamed("id", id_col)

"""License scan: Dice coefficient over word bigrams against templates.

Units of a text are its lines, its paragraphs (between blank lines), the
whole, and the runs of consecutive lines in which a template stands inside a
longer text (``Scanner.runs``). Unit and template are normalised to lower-case words; with a and b
bigrams (repeats counted) and c in common, Dice is 2c / (a + b). As c is at
most the smaller count, a score of t needs b between a t / (2 - t) and
a (2 - t) / t: only templates in that range are compared.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"\w+")

# License notices and texts as published, by license name.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS
PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with
the distribution. """
_BSD_NAME = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission. """
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF
THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
TEMPLATES = [
    ("MIT", _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_NAME + _BSD_TAIL),
    ("BSD-3-Clause", "Licensed under the 3-Clause BSD License."),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
     hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
     in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
     Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
     on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
     the specific language governing permissions and limitations under the License."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
     General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
     option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
     WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
     General Public License for more details."""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0 Universal."),
]


def bigrams(text: str) -> Counter:
    w = WORD.findall(text.lower())
    return Counter(zip(w, w[1:]))


def units(text: str, scanner: Scanner | None = None):
    """``(start, end)`` in code points of the ``blocks``, then of the runs of
    lines that ``scanner`` (default: ``TEMPLATES`` at 0.8) finds."""
    seen = list(blocks(text))
    yield from seen
    yield from (scanner or standard()).runs(text, seen)


def blocks(text: str):
    """``(start, end)`` in code points of lines, of paragraphs that have
    several lines, and of the whole text if it has several paragraphs."""
    at, head, n, met = 0, 0, 0, 0
    for line in [*text.split("\n"), ""]:
        if line.strip():
            yield at, at + len(line)
            head, n = (head, n + 1) if n else (at, 1)
        elif n:
            met += 1
            if n > 1:
                yield head, at - 1
            n = 0
        at += len(line) + 1
    if met > 1:
        yield 0, len(text)


class Scanner:
    """Templates by size; the bigrams that occur in any of them."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float):
        rows = [(sum(b.values()), i, name, b) for i, (name, text) in enumerate(templates) if (b := bigrams(text))]
        self.rows = sorted(rows, key=lambda r: r[:2])
        self.sizes = [r[0] for r in self.rows]
        self.known = frozenset(g for r in self.rows for g in r[3])
        self.low, self.high = threshold / (2 - threshold), (2 - threshold) / threshold
        self.threshold = threshold

    def best(self, words: list[str]) -> tuple[str, float] | None:
        """License and Dice of the best template at the threshold or above
        for a unit of these words; ties go to the one listed first."""
        n = len(words) - 1
        a, b = bisect_left(self.sizes, n * self.low - 1e-9), bisect_right(self.sizes, n * self.high + 1e-9)
        if n < 1 or a == b or self.known.isdisjoint(zip(words, words[1:])):
            return None
        own, top = Counter(zip(words, words[1:])), None
        for size, i, name, grams in self.rows[a:b]:
            small, large = (grams, own) if len(grams) < len(own) else (own, grams)
            score = 2 * sum(min(c, large[g]) for g, c in small.items() if g in large) / (n + size)
            if score >= self.threshold and (top is None or (-score, i) < top[0]):
                top = ((-score, i), name)
        return (top[1], -top[0][0]) if top else None

    def runs(self, text: str, seen: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """``(start, end)`` of runs of consecutive lines, blank ones between
        included, that have ``threshold`` or more with some template. Of
        single lines and runs that overlap only the best counts (then the
        longer, then the earlier); one that has the words of a place in
        ``seen``, or is a single line, is not returned.

        A matching run of a template of b bigrams shares at least
        b t / (2 - t) with it, so texts that share fewer are left at once.
        Runs begin and end at lines that share a bigram and grow up to the
        size bound; what a run shares is counted up word by word.
        """
        words = [(m.group().lower(), m.start(), m.end()) for m in WORD.finditer(text)] if text else []
        pairs = [(a[0], b[0]) for a, b in zip(words, words[1:])]
        common = Counter(g for g in pairs if g in self.known)
        near = [r for r in self.rows if sum(min(c, common[g]) for g, c in r[3].items() if g in common) >= r[0] * self.low - 1e-9]
        if not near:
            return []
        first, at = [], 0  # first word of each line that has words
        for k, (_, a, _) in enumerate(words):
            if k == 0 or text.find("\n", at, a) >= 0:
                first.append(k)
            at = a
        first.append(len(words))
        found = []
        for size, i, _, grams in near:
            hits = [0]
            for g in pairs:
                hits.append(hits[-1] + (g in grams))
            heads = [x for x in range(len(first) - 1) if hits[min(first[x + 1], len(pairs))] > hits[min(first[x], len(pairs))]]
            for x in heads:
                own, c, p = Counter(), 0, first[x]
                for y in range(x, len(first) - 1):
                    stop = first[y + 1] - 1
                    if stop - first[x] > size * self.high + 1e-9:
                        break
                    was = c
                    while p < stop:
                        g = pairs[p]
                        if g in grams:
                            own[g] += 1
                            c += own[g] <= grams[g]
                        p += 1
                    dice = 2 * c / (size + stop - first[x]) if stop > first[x] else 0
                    if c > was and dice >= self.threshold:
                        found.append((-dice, first[x] - stop, first[x], stop, x == y))
        taken, out = [], []
        have = {self.span(words, a, b) for a, b in seen} if found else set()
        for _, _, a, b, single in sorted(set(found)):
            k = bisect_right(taken, (a, b))
            if (k and taken[k - 1][1] >= a) or (k < len(taken) and taken[k][0] <= b):
                continue
            taken.insert(k, (a, b))
            if not single and (a, b) not in have:
                start = text.rfind("\n", 0, words[a][1]) + 1
                end = text.find("\n", words[b][2])
                out.append((start, end if end >= 0 else len(text)))
        return out

    @staticmethod
    def span(words: list[tuple], a: int, b: int) -> tuple[int, int]:
        """First and last word between two places of the text."""
        return bisect_left(words, a, key=lambda w: w[1]), bisect_left(words, b, key=lambda w: w[1]) - 1

    def scan(self, text: str | None) -> list[tuple]:
        """``(start, end, license, dice)`` of the units that match."""
        out = []
        for a, b in units(text, self) if text else ():
            if hit := self.best(WORD.findall(text[a:b].lower())):
                out.append((a, b, *hit))
        return sorted(out)


@lru_cache(maxsize=1)
def standard() -> Scanner:
    return Scanner(TEMPLATES, 0.8)


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """``doc_id, matches`` for each row of ``docs(doc_id, text)``: an array of
    ``start, end, license, dice`` sorted by place, each a unit whose best
    template has at least ``threshold``.

    ``templates`` is a list held by every task. Null and empty texts, and
    units or templates of fewer than two words, match nothing. Other columns
    are ignored; repeated rows each give a row.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    hits = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("license", pa.string()), ("dice", pa.float64())]))
    scanner = Scanner(templates, threshold)

    def run(batches):
        for b in batches:
            rows = [[dict(zip(("start", "end", "license", "dice"), m)) for m in scanner.scan(t.as_py())]
                    for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(rows, hits)], ["doc_id", "matches"])

    return docs.select("doc_id", F.col("text")).mapInArrow(
        run, f"doc_id {kind}, matches array<struct<start:long,end:long,license:string,dice:double>>")

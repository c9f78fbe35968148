"""Licence scans: normalised text against licence templates by the Dice coefficient over word bigrams.

A text is compared as a whole, paragraph by paragraph and line by line, and by windows of words anywhere in it, across
lines and paragraphs. A window has as many bigrams as the template or more; a shorter one begins and ends with a line or
sentence, as a part of a notice may name another licence. A template is only compared with what has a number of bigrams
that lets the coefficient reach the threshold, and enough bigrams of it; it only matches what has all its version numbers.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tideframe.llm.repeats import _batch

THRESHOLD = 0.8
#: First bigrams whose windows are looked at at once.
BLOCK = 2048

#: Notices and texts of public licences, without names and years.
TEMPLATES: list[tuple[str, str]] = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."),
    ("EUPL-1.2", "Licensed under the European Union Public Licence, version 1.2."),
    ("Artistic-2.0", "This work is licensed under the Artistic License 2.0."),
    ("WTFPL", "This work is licensed under the Do What The Fuck You Want To Public License."),
    ("Unlicense", "Released into the public domain under the Unlicense."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC-BY-3.0", "This work is licensed under a Creative Commons Attribution 3.0 Unported License."),
    ("CC-BY-SA-3.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("OFL-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
    ("all-rights-reserved", "All rights reserved."),
]

_WORDS = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
#: Words that tell a version from another: a template only matches what has all of its own.
_VERSION = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_SENTENCE = re.compile(r"[.!?:;]+(?=\s)")


def bigrams(text: str) -> Counter:
    """The pairs of neighbouring words of a normalised text: lower case, letters and digits only. One word pairs with nothing."""
    words = _WORDS.findall(text.lower())
    return Counter(zip(words, [*words[1:]])) if len(words) > 1 else Counter((w, "") for w in words)


class Ranges:
    """The windows of a text that match one template: for each first bigram the best last one."""

    def __init__(self, size: int, most: int, threshold: float, before: np.ndarray, lows: np.ndarray, whole: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.size, self.most, self.threshold = size, most, threshold
        self.before, self.starts, self.ends = np.concatenate([before, np.full(most, len(before))]), starts, ends
        self.n = len(before)
        scores, lasts = [np.zeros(0)], [np.zeros(0, np.int64)]
        for k in range(0, len(lows), BLOCK):
            score, last = self._score(lows[k : k + BLOCK], whole[k : k + BLOCK], self.n)
            scores.append(score)
            lasts.append(last)
        self.score, self.last = np.concatenate(scores), np.concatenate(lasts)
        found = self.score > 0
        self.lows, self.whole, self.score, self.last = lows[found], whole[found], self.score[found], self.last[found]

    def _score(self, lows: np.ndarray, whole: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The greatest coefficient of a window from each of these bigrams on that ends before `end`, and its last bigram
        (of equal ones the first); 0 if none matches. A bigram counts as often as the template has it at most."""
        view = np.lib.stride_tricks.sliding_window_view(self.before, self.most)[lows]
        both = np.cumsum(view < lows[:, None], axis=1)
        n = np.arange(1, self.most + 1)
        last = lows[:, None] + n - 1
        fits = (2 * both >= self.threshold * (n + self.size)) & (last < end) & (last >= whole[:, None])
        fits &= (n >= self.size) | self.starts[lows][:, None] & self.ends[np.minimum(last + 1, self.n)]
        dice = np.where(fits, 2 * both / (n + self.size), 0.0)
        at = dice.argmax(axis=1)
        return dice[np.arange(len(lows)), at], lows + at

    def best(self, low: int, high: int, number: int) -> tuple[float, int, int, int] | None:
        """(-coefficient, number, first, last bigram) of the least such window between low and high (exclusive)."""
        a, b = np.searchsorted(self.lows, [low, high])
        if a >= b:
            return None
        inside = self.last[a:b] < high
        score = np.where(inside, self.score[a:b], 0.0)
        k = int(score.argmax())
        best = (-float(score[k]), number, int(self.lows[a + k]), int(self.last[a + k])) if score[k] > 0 else None
        # windows that would end behind high may end before it instead: those that could still be better are tried
        cut = a + np.flatnonzero(~inside & (self.score[a:b] >= (score[k] or 1e-9)))
        for j in range(0, len(cut), BLOCK):
            own = cut[j : j + BLOCK]
            score, last = self._score(self.lows[own], self.whole[own], high)
            k = int(score.argmax())
            if score[k] > 0:
                new = (-float(score[k]), number, int(self.lows[own][k]), int(last[k]))
                best = min(best, new) if best else new
        return best


class Scanner:
    def __init__(self, templates: list[tuple[str, str]], threshold: float):
        self.threshold = threshold
        self.templates = [(name, bigrams(text)) for name, text in templates]
        self.sizes = [sum(b.values()) for _, b in self.templates]
        self.versions = [frozenset(w for pair in b for w in pair if _VERSION.fullmatch(w)) for _, b in self.templates]
        self.having = defaultdict(list)
        for i, (_, b) in enumerate(self.templates):
            for pair in b:
                self.having[pair].append(i)
        self.first = {pair[0] for pair in self.having}
        self.least = min(self.sizes) * threshold / (2 - threshold)
        self.most = max(self.sizes) * (2 - threshold) / threshold

    def best(self, words: list[str]) -> tuple[str, float] | None:
        """The licence of the greatest coefficient, if that reaches the threshold; of equal ones the first template's."""
        n = max(1, len(words) - 1)
        if not words or n < self.least or n > self.most or self.first.isdisjoint(words):
            return None
        own = Counter(zip(words, words[1:])) if len(words) > 1 else Counter([(words[0], "")])
        score, which = 0.0, -1
        for i in {i for pair in own for i in self.having.get(pair, ())}:
            m = self.sizes[i]
            if 2 * min(n, m) >= self.threshold * (n + m) and self.versions[i].issubset(words):
                dice = 2 * (own & self.templates[i][1]).total() / (n + m)
                if dice > score or dice == score and i < which:
                    score, which = dice, i
        return (self.templates[which][0], score) if score >= self.threshold else None

    def bounds(self, i: int) -> tuple[int, int]:
        """The least common bigrams and the most bigrams of a window that reaches the threshold with a template."""
        m = self.sizes[i]
        return ceil(m * self.threshold / (2 - self.threshold) - 1e-9), int(m * (2 - self.threshold) / self.threshold + 1e-9)

    def dense(self, pairs: list[tuple[str, str]]) -> dict[int, list[int]]:
        """Of the templates that may match a window: where their bigrams are."""
        hits = defaultdict(list)
        for at, pair in enumerate(pairs):
            if pair in self.having:
                for i in self.having[pair]:
                    hits[i].append(at)
        out = {}
        for i, at in hits.items():
            need, most = self.bounds(i)
            if any(b - a < most for a, b in zip(at, at[need - 1 :])):
                out[i] = at
        return out

    def ranges(self, i: int, pairs: list[tuple[str, str]], at: list[int], starts: np.ndarray, ends: np.ndarray) -> Ranges:
        """The windows of one template over a text whose bigrams at these places are the template's."""
        m, own = self.sizes[i], self.templates[i][1]
        need, most = self.bounds(i)
        # where a bigram came last, so many times ago as the template has it: it counts in a window that starts behind that
        before, seen = np.full(len(pairs), len(pairs), np.int64), defaultdict(list)
        for k in at:
            places, times = seen[pairs[k]], own[pairs[k]]
            before[k] = places[-times] if len(places) >= times else -1
            places.append(k)
        hits = np.zeros(len(pairs) + 1, np.int64)
        np.add.at(hits, np.array(at) + 1, 1)
        hits = np.cumsum(hits)
        lows = np.arange(len(pairs))
        lows = lows[hits[np.minimum(lows + most, len(pairs))] - hits[lows] >= need]
        # the last bigram that a window needs to hold all words of the template's version
        whole = np.zeros(len(lows), np.int64)
        for word in self.versions[i]:
            held = np.array([k for k, pair in enumerate(pairs) if pair[0] == word or pair[1] == word], np.int64)
            whole = np.maximum(whole, np.append(held, len(pairs))[np.searchsorted(held, lows)])
        return Ranges(m, most, self.threshold, before, lows, whole, starts, ends)

    def windows(self, pairs: list[tuple[str, str]], hits: dict[int, list[int]], starts: set[int], ends: set[int]) -> list[tuple[float, int, int, int]]:
        """Coefficient, template, first and last bigram of the windows that match, the best of those that overlap.

        The words at starts begin a line or sentence, those at ends end one. The best window of a text is taken first, then
        those of what is left before and behind it.
        """
        flags = [np.isin(np.arange(len(pairs) + 1), [*s]) for s in (starts, ends)]
        ranges = {i: self.ranges(i, pairs, at, *flags) for i, at in hits.items()}
        out, parts = [], [(0, len(pairs))]
        while parts:
            low, high = parts.pop()
            best = min((x for i, r in ranges.items() if (x := r.best(low, high, i))), default=None)
            if best:
                dice, i, lo, hi = best
                out.append((-dice, i, lo, hi))
                parts += [(low, lo - 1), (hi + 2, high)]  # words, one more than bigrams, aren't shared
        return sorted(out, key=lambda x: (-x[0], *x[1:]))

    def scan(self, text: str) -> Iterator[tuple[str, float, int, int]]:
        """Licence, coefficient, first and last line (from 0) of every line, paragraph and text that matches, and of every
        window that does where none of those has its licence."""
        lines = text.split("\n")
        words = [_WORDS.findall(x.lower()) for x in lines]
        marks = [not self.first.isdisjoint(x) for x in words]
        flat = [w for x in words for w in x]
        found = []
        start = 0
        for i, line in enumerate([*lines, ""]):
            if i < len(lines) and marks[i] and (got := self.best(words[i])):
                found.append((*got, i, i))
            if not line.strip():
                if i - start > 1 and any(marks[start:i]) and (got := self.best([w for x in words[start:i] for w in x])):
                    found.append((*got, start, i - 1))
                start = i + 1
        if any(not x.strip() for x in lines):
            filled = [i for i, x in enumerate(lines) if x.strip()]
            parts = sum(1 for a, b in zip(filled, filled[1:]) if b - a > 1)
            if parts and any(marks) and (got := self.best(flat)):
                found.append((*got, filled[0], filled[-1]))
        yield from found
        pairs = [*zip(flat, flat[1:])]
        hits = self.dense(pairs)
        if not hits:
            return
        line_of, starts, ends = [], set(), set()
        for i, (line, own) in enumerate(zip(lines, words)):
            at = len(line_of)
            if own:
                starts.add(at)
                ends.add(at + len(own) - 1)
                low = line.lower()
                places = [x.start() for x in _WORDS.finditer(low)]
                for x in _SENTENCE.finditer(low):
                    n = at + bisect_left(places, x.end())
                    starts.add(n)
                    ends.add(n - 1)
            line_of += [i] * len(own)
        for dice, i, lo, hi in self.windows(pairs, hits, starts, ends):
            name, one, two = self.templates[i][0], line_of[lo], line_of[hi + 1]
            if not any(have == name and a <= two and one <= b for have, _, a, b in found):
                yield name, dice, one, two


_OUT = pa.schema([("doc_id", pa.int64()), ("licence", pa.string()), ("dice", pa.float64()), ("n_matches", pa.int64()), ("first_line", pa.int64()), ("last_line", pa.int64())])


def scan(df: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, licence, dice, n_matches, first_line, last_line: for each row of df and licence found in its text, the best
    match (of equal ones the first) and how many there are. A null or empty text has none; repeated rows are repeated;
    null ids stay; a text of any length is scanned whole; an empty df gives no rows; other columns are not read.
    """
    templates = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, threshold)
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found: dict[str, list] = {}
                for name, dice, lo, hi in scanner.scan(text.as_py() or ""):
                    have = found.setdefault(name, [-dice, lo, hi, 0])
                    have[:3] = min(have[:3], [-dice, lo, hi])
                    have[3] += 1
                out += [(doc, name, -d, n, lo, hi) for name, (d, lo, hi, n) in found.items()]
            yield _batch(iter(out), _OUT)

    return df.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, "doc_id long, licence string, dice double, n_matches long, first_line long, last_line long")

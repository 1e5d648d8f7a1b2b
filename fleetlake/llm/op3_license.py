"""License scans by patience alignment.

Every text is searched for license notices. Stretches of twice a template's length, at every word, are
screened by how many of the template's words they can cover at all. Windows of three lengths start at
every template length, so each such stretch lies whole in one; a window with a stretch that can reach
the threshold is aligned, whole and around the places where the template's words are densest: words that are unique in both the window and the
template are anchors, their longest increasing subsequence is kept, and the gaps between anchors are
aligned in the same way, after equal words at both ends of a gap. Coverage is the share of template
words aligned. The words that tell a license from its neighbours (KEYS: its name, its version) must
be among them, side by side where they are one phrase.

The hits of all templates compete for the words of the text: the one with most aligned words is taken
first (then most coverage, then the shortest, then the first), its words count for no other, and the
windows it touches are searched again without them. So a notice that several templates resemble gives
one hit, and notices may follow or interrupt one another.

Words are lower-case runs of letters and digits; a notice spread over more than twice its length is
not one. A null, empty or wordless text has no hits, so neither have texts that only contain a few
words of a template. Rows with null or repeated ids are scanned each. An empty table gives an empty
result.
"""

from __future__ import annotations

import bisect
import heapq
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import lower_in_place, map_arrow, record_batch, rename_inputs, slices, table

COVERAGE = 0.8
SPREAD = 2     # template lengths a notice may be spread over
WINDOW = SPREAD + 1

_WORD = re.compile(r"[^\W_]+")

_GNU = ("This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published "
        "by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This "
        "{work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details.")

# Wording of public license notices.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "mit-line": "Released under the MIT License.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                  "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
                  "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                  "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
                  "See the License for the specific language governing permissions and limitations under the License.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
           "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
           "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
           "notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
               "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
               "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
               "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
               "General Public License for more details.",
    # neighbours that share most of their words with one of the above
    "bsd-line": "Released under the BSD License.",
    "mit-0-line": "Released under the MIT No Attribution License.",
    "mpl-2.0-line": "Licensed under the Mozilla Public License, Version 2.0.",
    "epl-2.0-line": "Licensed under the Eclipse Public License, Version 2.0.",
    "cc-by-4.0-line": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0.",
    "cc-by-nd-4.0-line": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-sa-4.0-line": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nc-nd-4.0-line": "Licensed under CC BY-NC-ND 4.0.",
    "gpl-2.0-line": "This work is licensed under the GNU General Public License, version 2.",
    "lgpl-2.1-line": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "lgpl-3.0-line": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl-3.0-line": "This work is licensed under the GNU Affero General Public License, version 3.",
    "gpl-2.0": _GNU.format(work="program", name="General Public License", version="2"),
    "lgpl-2.1": _GNU.format(work="library", name="Lesser General Public License", version="2.1"),
    "lgpl-3.0": _GNU.format(work="library", name="Lesser General Public License", version="3"),
    "agpl-3.0": _GNU.format(work="program", name="Affero General Public License", version="3"),
    "hpnd": "Permission to use, copy, modify, and distribute this software and its documentation for any purpose and without fee "
            "is hereby granted, provided that the above copyright notice appear in all copies and that both that copyright notice "
            "and this permission notice appear in supporting documentation.",
}

# Words that identify the license: each phrase must be aligned whole at one of its places in the template.
KEYS = {
    "apache-2.0-line": ["apache", "2"], "apache-2.0": ["apache", "2"], "mit-line": ["mit"], "mit-0-line": ["mit", "no attribution"],
    "bsd-line": ["bsd"], "mpl-2.0-line": ["mozilla", "2"], "epl-2.0-line": ["eclipse", "2"],
    "cc-by-4.0-line": ["cc", "by", "4"], "cc-by-sa-4.0-line": ["cc", "sa", "4"], "cc-by-nd-4.0-line": ["cc", "nd", "4"],
    "cc-by-nc-4.0-line": ["cc", "nc", "4"], "cc-by-nc-sa-4.0-line": ["cc", "nc", "sa", "4"],
    "cc-by-nc-nd-4.0-line": ["cc", "nc", "nd", "4"],
    "gpl-2.0-line": ["gnu general", "2"], "gpl-2.0": ["gnu general", "2"], "gpl-3.0-line": ["gnu general", "3"],
    "gpl-3.0": ["gnu general", "3"], "lgpl-2.1-line": ["lesser", "2 1"], "lgpl-2.1": ["lesser", "2 1"],
    "lgpl-3.0-line": ["lesser", "3"], "lgpl-3.0": ["lesser", "3"], "agpl-3.0-line": ["affero", "3"], "agpl-3.0": ["affero", "3"],
    "hpnd": ["documentation"],
}


def words(text: str | None) -> list[str]:
    return _WORD.findall(lower_in_place(text or ""))


def longest_increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence with rising second places of pairs in order of the first."""
    tails: list[int] = []
    at: list[int] = []
    back = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        n = bisect.bisect_left(tails, j)
        tails[n:n + 1] = [j]
        at[n:n + 1] = [k]
        back[k] = at[n - 1] if n else -1
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Patience alignment: pairs of places with equal items, rising in both sequences."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, i2, j, j2 = todo.pop()
        while i < i2 and j < j2 and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < i2 and j < j2 and a[i2 - 1] == b[j2 - 1]:
            i2, j2 = i2 - 1, j2 - 1
            out.append((i2, j2))
        if i == i2 or j == j2:
            continue
        in_a, in_b = Counter(a[i:i2]), Counter(b[j:j2])
        place = {w: k for k, w in enumerate(b[j:j2], j) if in_b[w] == 1}
        anchors = longest_increasing([(k, place[w]) for k, w in enumerate(a[i:i2], i) if in_a[w] == 1 and w in place])
        for k, m in anchors:
            out.append((k, m))
            todo.append((i, k, j, m))
            i, j = k + 1, m + 1
        if anchors:
            todo.append((i, i2, j, j2))
    return sorted(out)


def tighten(pairs: list[tuple[int, int]], text: list, template: list) -> list[tuple[int, int]]:
    """The same template words at the places of ``text`` closest together from either end."""
    def later(pairs):
        out = [pairs[-1]]
        for _, j in reversed(pairs[:-1]):
            i = out[-1][0] - 1
            while text[i] != template[j]:
                i -= 1
            out.append((i, j))
        return out[::-1]

    def earlier(pairs):
        out = [pairs[0]]
        for _, j in pairs[1:]:
            i = out[-1][0] + 1
            while text[i] != template[j]:
                i += 1
            out.append((i, j))
        return out

    return min(earlier(later(pairs)), later(earlier(pairs)), key=lambda x: x[-1][0] - x[0][0])


class Scanner:
    def __init__(self, templates: dict[str, str], coverage: float, keys: dict[str, list[str]] | None = None):
        if keys is None:  # KEYS hold for the wording they were made for
            keys = {n: KEYS.get(n, []) for n, t in templates.items() if t == TEMPLATES.get(n)}
        self.names = list(templates)
        self.words = [words(templates[n]) for n in self.names]
        self.number = {w: k for k, w in enumerate(sorted({w for t in self.words for w in t}), 1)}
        self.ids = [np.array([self.number[w] for w in t], dtype=np.int64) for t in self.words]
        self.member = np.zeros((len(self.names), len(self.number) + 1), dtype=np.int64)
        for k, t in enumerate(self.ids):
            self.member[k, t] = 1
        self.bags = [Counter(t) for t in self.words]
        self.need = [max(1, -int(-coverage * len(t) // 1)) for t in self.words]
        self.keys = [[(len(p), [i for i in range(len(t)) if t[i:i + len(p)] == p]) for p in map(words, keys.get(n, ()))]
                     for n, t in zip(self.names, self.words)]

    def _named(self, k: int, pairs: list[tuple[int, int]]) -> bool:
        """Whether every identifying phrase is aligned, its words side by side."""
        at = {j: i for i, j in pairs}
        return all(any(p in at and all(at.get(p + d) == at[p] + d for d in range(size)) for p in places)
                   for size, places in self.keys[k])

    def _regions(self, k: int, text: list, lo: int, hi: int) -> list[tuple[int, int]]:
        """Where to align in a window: all of it, where the words of the template are densest, and every
        stretch a notice may be spread over, some words apart."""
        n = len(self.words[k])
        inside = np.concatenate(([0], np.cumsum([w in self.bags[k] for w in text[lo:hi]])))
        out = [(lo, hi)]
        for size in (n, n + n // 4, n + n // 2, SPREAD * n):
            if size < hi - lo:
                at = lo + int(np.argmax(inside[size:] - inside[:-size]))
                out.append((at, at + size))
        ends = np.minimum(np.arange(hi - lo) + SPREAD * n, hi - lo)
        many = inside[ends] - inside[:-1] >= self.need[k]
        return out + [(lo + a, lo + int(ends[a])) for a in range(0, hi - lo, max(1, n // 4)) if many[a]]

    def _find(self, k: int, text: list, lo: int, hi: int) -> list[tuple[int, int]] | None:
        """The aligned places of the best notice of one template in a window."""
        t, best = self.words[k], None
        if (Counter(text[lo:hi]) & self.bags[k]).total() < self.need[k]:
            return None
        for a, b in self._regions(k, text, lo, hi):
            pairs = [(a + i, j) for i, j in align(text[a:b], t)]
            if len(pairs) >= self.need[k]:
                pairs = tighten(pairs, text, t)
                while pairs[-1][0] - pairs[0][0] >= SPREAD * len(t):  # stray words go, the more distant end first
                    pairs = pairs[1:] if pairs[1][0] - pairs[0][0] > pairs[-1][0] - pairs[-2][0] else pairs[:-1]
                if len(pairs) < self.need[k]:
                    continue
                rank = (len(pairs), pairs[0][0] - pairs[-1][0])
                if (best is None or rank > best[0]) and self._named(k, pairs):
                    best = rank, pairs
        return best and best[1]

    def _windows(self, k: int, ids: np.ndarray) -> list[int]:
        """Starts of the windows that can hold a notice."""
        n = len(self.words[k])
        total = np.concatenate(([0], np.cumsum(self.member[k][ids])))
        ends = np.minimum(np.arange(len(ids)) + SPREAD * n, len(ids))
        return (np.unique(np.flatnonzero(total[ends] - total[:-1] >= self.need[k]) // n) * n).tolist()

    def hits(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(license, coverage, first word, last word) of every notice, in text order."""
        free = words(text)
        get = self.number.get
        ids = np.fromiter((get(w, 0) for w in free), dtype=np.int64, count=len(free))
        if np.count_nonzero(ids) < min(self.need, default=1):
            return []
        seen = np.zeros(len(self.number) + 1, dtype=bool)
        seen[ids] = True
        open_ = {k: set(self._windows(k, ids)) for k, t in enumerate(self.ids) if np.count_nonzero(seen[t]) >= self.need[k]}
        queue, latest = [], {}

        def look(k: int, start: int) -> None:
            n = len(self.words[k])
            pairs = latest[k, start] = self._find(k, free, start, min(start + WINDOW * n, len(free)))
            if pairs:
                first, last = pairs[0][0], pairs[-1][0]
                heapq.heappush(queue, (-len(pairs), -len(pairs) / n, last - first, first, k, start, pairs))

        for k, starts in open_.items():
            for start in starts:
                look(k, start)
        out = []
        while queue:
            *_, first, k, start, pairs = heapq.heappop(queue)
            if latest[k, start] is not pairs:
                continue
            last = pairs[-1][0]
            out.append((self.names[k], len(pairs) / len(self.words[k]), first, last))
            for i, _ in pairs:
                free[i] = ""
            for other, starts in open_.items():
                n = len(self.words[other])
                for s in range(max(first // n - WINDOW + 1, 0) * n, last + 1, n):
                    if s in starts:
                        look(other, s)
        return sorted(out, key=lambda x: (x[2], x[3]))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE,
         keys: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per notice found: doc_id, license, coverage, start and end (code points)."""
    templates = TEMPLATES if templates is None else templates
    schema = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int64()),
                        ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, coverage, keys)
        for b in slices(batches, "text"):
            rows = []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                hits = scanner.hits(text)
                if hits:
                    spans = [m.span() for m in _WORD.finditer(lower_in_place(text))]
                    rows += [(doc_id, name, c, spans[first][0], spans[last][1]) for name, c, first, last in hits]
            yield record_batch(schema, **{n: [r[i] for r in rows] for i, n in enumerate(schema.names)})

    src = rename_inputs(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(src, run, "doc_id long, license string, coverage double, start long, end long")


def op3_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in all documents."""
    return scan(table(spark, sf_dir, "documents"))

"""License scans by Dice coefficient over word bigrams (operator 6).

Texts are lower-cased (ASCII), punctuation becomes spaces and "licence" is spelled with an s. Three
kinds of unit are compared with the templates: each line, each paragraph (lines between blank ones,
copyright lines left out) of two lines or more, and the whole text. Dice is twice the common bigrams
over all bigrams of both, counted with repeats; since common bigrams are at most those of the
smaller side, a template can only reach ``least`` if its size is within ``least / (2 - least)`` of
the unit's, and others are not looked at. Of templates that reach it the best is reported, on ties
the first by name.

With ``windows`` (the registered query), windows of each template's size also slide over all words of
the text. A window that reaches ``least`` holds one at least of any template bigrams that together
exceed the share that may be missing, so windows are counted only around the rarest of those.
Overlapping windows are merged to the one with the most common bigrams, and those within a unit found
under the same licence are left out.

Null and empty texts match nothing and keep their row; repeated rows are scanned row by row. The
work is one pass without a shuffle, in memory proportional to the longest text.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from importlib import resources

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import aside

#: Notices of common licences by SPDX name and a running letter.
TEMPLATES = {
    "Apache-2.0/a": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0/b": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.""",
    "BSD-2-Clause/a": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause/a": "Licensed under the BSD 3-Clause License.",
    "BSD-3-Clause/b": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0/a": "Licensed under CC BY 4.0.",
    "CC-BY-4.0/b": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0/a": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0/b": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-SA-4.0/a": "Licensed under CC BY-SA 4.0.",
    "CC-BY-SA-4.0/b": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0/a": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "GPL-2.0/a": "This work is licensed under the GNU General Public License version 2.",
    "GPL-3.0/a": "This work is licensed under the GNU General Public License version 3.",
    "GPL-3.0/b": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
any later version.""",
    "ISC/a": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "LGPL-3.0/a": "This work is licensed under the GNU Lesser General Public License version 3.",
    "MIT/a": "Released under the MIT License.",
    "MIT/b": "Licensed under the MIT License.",
    "MIT/c": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software.""",
    "MPL-2.0/a": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "Unlicense/a": "This is free and unencumbered software released into the public domain.",
}


def standard() -> dict[str, str]:
    """TEMPLATES with whole licence texts and standard notices of ``data/license_texts.json``."""
    return TEMPLATES | json.loads(resources.files("dumpmill.data").joinpath("license_texts.json").read_text())


#: Bytes after ASCII lower-casing: letters, digits, new lines and other characters stay.
_PLAIN = bytes(c if c > 127 or c == 10 or chr(c).isalnum() else 32 for c in range(256))


def plain(text: str | None) -> bytes:
    return (text or "").encode().lower().translate(_PLAIN).replace(b"licence", b"license")


def bigrams(words: list[bytes]) -> Counter:
    return Counter(zip(words, words[1:], strict=False))


class Templates:
    """Templates by the unit sizes (bigrams) at which they can reach ``least``."""

    def __init__(self, least: float, texts: dict[str, str] | None = None):
        self.least = least
        self.anchors: dict[tuple[bytes, bytes], list[int]] = {}
        self.own: list[tuple[str, Counter, int]] = []
        self.by_size: dict[int, list[tuple[str, Counter, int]]] = {}
        for name, text in sorted((texts or TEMPLATES).items()):
            own = bigrams(plain(text).split())
            n = sum(own.values())
            for size in range(1, int((2 - least) / least * n) + 2):
                if 2 * min(n, size) >= least * (n + size):
                    self.by_size.setdefault(size, []).append((name, own, n))
            self.own.append((name, own, n))
        shared = Counter(b for _, own, _ in self.own for b in own)
        for k, (_, own, n) in enumerate(self.own):
            held = 0
            for b in sorted(own, key=lambda b: (shared[b], -len(b[0] + b[1]), b)):
                if held > n * (1 - least) + 1e-9:
                    break
                self.anchors.setdefault(b, []).append(k)
                held += own[b]

    def best(self, words: list[bytes]) -> tuple[str, float] | None:
        size = len(words) - 1
        found = None
        for name, own, n in self.by_size.get(size, ()):
            unit = bigrams(words)
            common = sum(min(c, own[b]) for b, c in unit.items() if b in own)
            dice = 2 * common / (size + n)
            if dice >= self.least and (found is None or dice > found[1]):
                found = name, dice
        return found

    def windows(self, words: list[bytes]) -> list[tuple[str, int, int, float]]:
        """(template, first word, end, dice) of windows that reach a template, best of those that overlap."""
        grams = list(zip(words, words[1:], strict=False))
        spans: dict[int, list[list[int]]] = {}
        for p, b in enumerate(grams):
            for k in self.anchors.get(b, ()):
                n = self.own[k][2]
                first, last = max(0, p - n + 1), min(p, len(grams) - n)
                if first <= last:
                    own = spans.setdefault(k, [])
                    if own and first <= own[-1][1] + 1:
                        own[-1][1] = last
                    else:
                        own.append([first, last])
        hits = []
        for k, own in spans.items():
            name, want, n = self.own[k]
            for first, last in own:
                have: Counter = Counter()
                common = 0
                for i in range(first, last + n):
                    if (b := grams[i]) in want:
                        have[b] += 1
                        common += have[b] <= want[b]
                    if i - n >= first and (b := grams[i - n]) in want:
                        common -= have[b] <= want[b]
                        have[b] -= 1
                    if i - n + 1 >= first and common / n >= self.least:
                        hits.append((-common, -common / n, name, i - n + 1, i + 2))
        out: list[tuple[str, int, int, float]] = []
        taken = bytearray(len(words))
        for _, dice, name, a, b in sorted(hits):
            if not any(taken[a:b]):
                taken[a:b] = b"\1" * (b - a)
                out.append((name, a, b, -dice))
        return sorted(out, key=lambda x: x[1])


@lru_cache(maxsize=4)
def templates(least: float, full: bool = False) -> Templates:
    return Templates(least, standard() if full else None)


def matches(text: str | None, own: Templates, windows: bool = False) -> list[tuple[str, str, int, float]]:
    """(kind of unit, template, first line, dice) of each unit that reaches a template."""
    lines = [line.split() for line in plain(text).split(b"\n")]
    out = []
    spans: list[tuple[str, int, int]] = []  # licence and lines of units found

    def look(kind: str, at: int, words: list[bytes], end: int) -> None:
        if len(words) - 1 in own.by_size and (hit := own.best(words)):
            out.append((kind, hit[0], at, hit[1]))
            spans.append((hit[0].split("/")[0], at, end))

    start = 0
    for i, words in enumerate([*lines, []]):
        if words:
            look("line", i, words, i + 1)
            continue
        if i - start > 1:
            block = [w for line in lines[start:i] if line[0] != b"copyright" for w in line]
            look("paragraph", start, block, i)
        start = i + 1
    if len(lines) > 1:
        look("text", 0, [w for line in lines for w in line], len(lines))
    if windows:
        words, at = [w for line in lines for w in line], [i for i, line in enumerate(lines) for _ in line]
        for name, a, b, dice in own.windows(words):
            if not any(x == name.split("/")[0] and first <= at[b - 1] and at[a] < end for x, first, end in spans):
                out.append(("window", name, at[a], dice))
    return out


def license_matches(docs: DataFrame, least: float = 0.8, name: str = "licenses", windows: bool = False, full: bool = False) -> DataFrame:
    """``docs`` with ``name``: array of (unit, license, line, dice), in the order of the text, windows last.
    An input column of that name is kept as ``<name>_``. ``full`` compares with ``standard()``, else with TEMPLATES."""
    docs = aside(docs, name)
    names = docs.columns
    kind = "array<struct<unit string, license string, line int, dice double>>"
    inner = pa.list_(pa.struct([("unit", pa.string()), ("license", pa.string()), ("line", pa.int32()), ("dice", pa.float64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = templates(least, full)
        for batch in batches:
            rows = [[dict(zip(("unit", "license", "line", "dice"), m, strict=True)) for m in matches(t.as_py(), own, windows)] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names if c != "text"), pa.array(rows, inner)], names=[*(c for c in names if c != "text"), name])

    rest = [c for c in names if c != "text"]
    from pyspark.sql.types import _parse_datatype_string

    schema = docs.select(rest).schema.add(name, _parse_datatype_string(kind))
    return docs.select(*rest, "text").mapInArrow(scan, schema)


def license_report(docs: DataFrame, least: float = 0.8, windows: bool = False, full: bool = False) -> DataFrame:
    """One row per document: doc_id, n_matches, license (best, without its letter), dice, licenses."""
    own = license_matches(docs.select("doc_id", "text"), least, windows=windows, full=full)
    best = F.element_at(F.array_sort("licenses", lambda a, b: F.when(a["dice"] > b["dice"], -1).when(a["dice"] < b["dice"], 1)
                                     .when(a["license"] < b["license"], -1).when(a["license"] > b["license"], 1).otherwise(0)), 1)
    short = lambda c: F.substring_index(c, "/", 1)
    full = F.size("licenses") > 0
    return own.select(
        "doc_id", F.size("licenses").cast("long").alias("n_matches"), F.when(full, short(best["license"])).alias("license"),
        F.when(full, F.round(best["dice"], 6)).alias("dice"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("licenses", lambda m: short(m["license"])))), ",").alias("licenses"))

"""License scan by patience alignment of texts with notice templates.

Words that occur once in the text and once in the template are anchors; the longest increasing subsequence of their
places keeps those in common order; the gaps between them are aligned in the same way. Coverage is the
share of the template's words that are aligned.

A template is looked for in windows that start at every multiple of its length and hold the longest acceptable span from
any of its first words, so that every occurrence lies whole in one window, wherever it starts. A window is aligned only
if it holds enough words of the template for the wanted coverage, which rules out nothing that could reach it. Where
several occurrences hide each other's anchors, the window is aligned again from each place of the template's rarest words,
in as much text as a span can take.

Scale: one scan without a shuffle; the templates are a parameter of fixed size. A task holds one batch of rows.

Defined cases: null and empty texts match nothing; templates without words are ignored; of matches that
overlap the one with the most aligned words stays, then the one of larger coverage, then the earlier; repeated rows are scanned one by one.
A match of a known template counts only if its span has the words that tell the template from its siblings (version, third
clause) and none of theirs (nc, sa, nd, lesser, affero). Full texts lie in ``license_texts``, read by the driver.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkprint.llm.common import lists, query, table, with_struct
from inkprint.llm.decontaminate import _characters, words_of

# Public notices, as they are worded by their authors or customarily referred to
TEMPLATES = {
    "apache-2.0-reference": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
        BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
    "cc-by-nc-4.0-reference": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-reference": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-3.0-reference": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version.""",
    "mit-reference": "Released under the MIT License.",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
        to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
        whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
        permission notice shall be included in all copies or substantial portions of the Software.""",
    "bsd-2-clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution.""",
    "bsd-3-clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
        products derived from this software without specific prior written permission.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
        commercial or non-commercial, and by any means.""",
    "zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for
        any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions""",
    "mpl-2.0-notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
        was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "agpl-3.0-section": """Notwithstanding any other provision of this License, if you modify the Program, your modified version must
        prominently offer all users interacting with it remotely through a computer network (if your version supports such
        interaction) an opportunity to receive the Corresponding Source of your version by providing access to the Corresponding
        Source from a network server at no charge, through some standard or customary means of facilitating copying of software.""",
    "mpl-2.0-reference": "This work is licensed under the Mozilla Public License, version 2.0.",
    "isc-reference": "Released under the ISC License.",
    "unlicense-reference": "Released under the Unlicense.",
    "bsd-2-clause-reference": "Released under the BSD 2-Clause License.",
    "bsd-3-clause-reference": "Released under the BSD 3-Clause License.",
    "cc0-1.0-reference": "Licensed under CC0 1.0.",
    "cc0-1.0-notice": "This work is dedicated to the public domain under CC0 1.0 Universal.",
    "all-rights-reserved": "All rights reserved.",
}
# Words that a match must have, and may not have, so that it is not one of a sibling
_GNU = {"lesser", "library", "affero"}
_CC = {"nc": {"noncommercial", "commercial"}, "sa": {"sharealike", "share"}, "nd": {"noderivatives", "noderivs", "derivatives", "derivs"}}
RULES: dict[str, tuple[set[str], set[str]]] = {
    "apache-2.0-reference": ({"apache", "2"}, set()), "mpl-2.0-reference": ({"mozilla", "2"}, set()),
    "mpl-2.0-notice": ({"mozilla", "2"}, set()), "mit-reference": ({"mit"}, set()), "isc-reference": ({"isc"}, set()),
    "unlicense-reference": ({"unlicense"}, set()), "bsd-2-clause-reference": ({"bsd", "2"}, set()),
    "bsd-3-clause-reference": ({"bsd", "3"}, set()), "bsd-3-clause": ({"neither", "endorse"}, set()),
    "cc0-1.0-reference": ({"cc0", "1"}, set()), "cc0-1.0-notice": ({"cc0", "1"}, set()),
    "agpl-3.0-section": ({"remotely", "network"}, set()), "gpl-1-text": ({"february", "1989"}, set()),
    "gpl-2-text": ({"june", "1991"}, set()), "gpl-3-text": ({"29", "june", "2007"}, set()), "lgpl-2-text": ({"june", "1991"}, set()),
    "lgpl-2.1-text": ({"february", "1999"}, set()), "lgpl-3-text": ({"lesser", "june", "2007"}, set()),
    "gfdl-1.2-text": ({"november", "2002"}, set()), "gfdl-1.3-text": ({"november", "2008"}, set()),
    "mpl-1.1-text": ({"1"}, set()), "mpl-2.0-text": ({"2"}, set()),
}


def _siblings() -> None:
    """The GNU and the Creative Commons licenses in all versions: references and customary notices."""
    for name, kind, version in (("gpl", "", "1"), ("gpl", "", "2"), ("gpl", "", "3"), ("lgpl", "Library ", "2"), ("lgpl", "Lesser ", "2.1"),
                                ("lgpl", "Lesser ", "3"), ("agpl", "Affero ", "3")):
        full = f"{name}-{version if '.' in version else version + '.0'}"
        own = {kind.strip().lower()} - {""}
        rule = ({"general", *own, *version.split(".")}, _GNU - own)
        for tail, text in (
                ("reference", f"This work is licensed under the GNU {kind}General Public License, version {version}."),
                ("notice", f"""you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published
                    by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.""")):
            TEMPLATES.setdefault(f"{full}-{tail}", text)
            RULES[f"{full}-{tail}"] = rule
    for code in ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd"):
        parts = code.split("-")
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            nd = "NoDerivatives" if version == "4.0" else "NoDerivs"
            long = "-".join({"by": "Attribution", "sa": "ShareAlike", "nc": "NonCommercial", "nd": nd}[x] for x in parts)
            kind = {"4.0": "International", "3.0": "Unported"}.get(version, "Generic")
            other = [x for x in _CC if x not in parts]
            bars = set(other).union(*(_CC[x] for x in other))
            numbers = set(version.split("."))
            for tail, text, needs in (
                    ("reference", f"Licensed under CC {code.upper()} {version}.", {"cc", *parts}),
                    ("notice", f"This work is licensed under a Creative Commons {long} {version} {kind} License.",
                     {"creative", "commons", *long.lower().split("-")})):
                TEMPLATES.setdefault(f"cc-{code}-{version}-{tail}", text)
                RULES[f"cc-{code}-{version}-{tail}"] = (needs | numbers, bars)


_siblings()


def known_templates() -> dict[str, str]:
    """All templates, the full texts too."""
    return {**TEMPLATES, **{p.stem: p.read_text(encoding="utf-8") for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}}

_FIELDS = T.StructType([T.StructField("matches", T.ArrayType(T.StructType([
    T.StructField("license", T.StringType()), T.StructField("coverage", T.DoubleType()),
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))])


def align(text: list, template: list) -> list[tuple[int, int]]:
    """Aligned places (in the text, in the template), both increasing."""
    out, todo = [], [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        anchors = _increasing(_unique_pairs(text, a, b, template, c, d)) if a < b and c < d else []
        if not anchors:
            continue
        for x, y in anchors:
            todo.append((a, x, c, y))
            a, c = x + 1, y + 1
        todo.append((a, b, c, d))
        out += anchors
    return sorted(out)


def _unique_pairs(text, a, b, template, c, d) -> list[tuple[int, int]]:
    """Places of the words that occur once in both stretches, in the order of the text."""
    def once(words, start, end):
        place: dict = {}
        for k in range(start, end):
            place[words[k]] = -1 if words[k] in place else k
        return place
    there = once(template, c, d)
    return sorted((x, there[w]) for w, x in once(text, a, b).items() if x >= 0 and there.get(w, -1) >= 0)


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence that increases in the second place too: piles of a game of patience."""
    tops: list[int] = []
    top_of: list[int] = []
    back: list[int] = []
    for k, (_, y) in enumerate(pairs):
        pile = bisect_left(tops, y)
        back.append(top_of[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(y)
            top_of.append(k)
        else:
            tops[pile], top_of[pile] = y, k
    out, k = [], top_of[-1] if top_of else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def _tight(words: list, span: list[int]) -> list[int]:
    """The same aligned words at places that are as close to each other as may be: each the first after the one before, then
    each the last before the one behind."""
    span = list(span)
    for i in range(1, len(span)):
        span[i] = words.index(words[span[i]], span[i - 1] + 1, span[i] + 1)
    for i in range(len(span) - 2, -1, -1):
        span[i] = next(x for x in range(span[i + 1] - 1, span[i] - 1, -1) if words[x] == words[span[i]])
    return span


class Scanner:
    def __init__(self, templates: dict[str, str], min_coverage: float, min_density: float = 0.5,
                 rules: dict[str, tuple[set[str], set[str]]] | None = None):
        self.templates = {name: words for name, t in sorted(templates.items()) if (words := words_of(t.encode()))}
        self.min_coverage, self.min_density = min_coverage, min_density
        self.kinds = {name: set(words) for name, words in self.templates.items()}
        self.all = set().union(*self.kinds.values()) if self.kinds else set()
        self.counts = {name: Counter(words) for name, words in self.templates.items()}
        self.rules = {name: tuple({w.encode() for w in part} for part in rule) for name, rule in (rules or {}).items()}

    def scan(self, words: list[bytes]) -> list[tuple[str, float, int, int]]:
        """(template, coverage, first word, last word) of all matches, by place."""
        found = []
        present = self.all.intersection(words)
        for name, template in self.templates.items():
            spare = int((1 - self.min_coverage) * len(template) + 1e-9)  # template words that may stay unaligned
            kinds = self.kinds[name]
            needs, bars = self.rules.get(name, (set(), set()))
            if len(words) < len(template) - spare or not needs <= present or len(kinds & present) < len(kinds) - spare:
                continue
            for n, first, last in set(self._windows(words, template, kinds, len(template) - spare, self.counts[name])):
                span = set(words[first:last + 1])
                if needs <= span and not bars & span:
                    found.append((name, n / len(template), first, last, n))
        return sorted(self._best(found), key=lambda m: (m[2], m[0]))

    def _windows(self, words, template, kinds, need, counts):
        size = len(template)
        longest = int(size / self.min_density + 1e-9)  # words of a span that is dense enough
        inside = np.concatenate([[0], np.cumsum(np.fromiter((w in kinds for w in words), np.int64, len(words)))])
        starts = np.arange(0, max(1, len(words)), size)
        ends = np.minimum(starts + longest + size, len(words))
        held = inside[ends] - inside[starts]
        for start, end in zip(starts[held >= need].tolist(), ends[held >= need].tolist()):
            todo = [(start, end)]
            while todo:
                a, b = todo.pop()
                if inside[b] - inside[a] < need or (Counter(words[a:b]) & counts).total() < need:
                    continue
                found = self._dense(words, a, b, template, need)
                if found:
                    yield found
                    todo += [(a, found[1]), (found[2] + 1, b)]
                else:
                    yield from self._singly(words, a, b, template, need, longest)

    def _dense(self, words, a, b, template, need):
        span = _tight(words, [a + x for x, _ in align(words[a:b], template)])
        if len(span) >= need and len(span) >= self.min_density * (span[-1] - span[0] + 1):
            return len(span), span[0], span[-1]
        return None

    def _singly(self, words, a, b, template, need, longest):
        """Occurrences around each place of a rare word of the template; of the rarest, as many as may be unaligned and one more, so
        that every acceptable occurrence holds one of them."""
        size = len(template)
        places: dict = {}
        for k in range(a, b):
            places.setdefault(words[k], []).append(k)
        rare = sorted(range(size), key=lambda y: (len(places.get(template[y], ())), y))[:size - need + 1]
        for x, y in sorted({(x, y) for y in rare for x in places.get(template[y], ())}):
            before = align(words[max(a, x - longest + 1):x][::-1], template[:y][::-1])
            after = align(words[x + 1:min(b, x + longest)], template[y + 1:])
            first = [x - 1 - p for p, _ in before]
            last = [x + 1 + p for p, _ in after]
            span = _tight(words, [*first[::-1], x, *last])
            best = self._densest(span, need)
            if best:
                yield best

    def _densest(self, span, need):
        """The most aligned words in a row that are dense enough."""
        for n in range(len(span), need - 1, -1):
            for k in range(len(span) - n + 1):
                if n >= self.min_density * (span[k + n - 1] - span[k] + 1):
                    return n, span[k], span[k + n - 1]
        return None

    @staticmethod
    def _best(matches):
        kept: list[tuple[str, float, int, int]] = []
        for name, coverage, first, last, _ in sorted(matches, key=lambda m: (-m[4], -m[1], m[2], m[0])):
            if all(last < k[2] or first > k[3] for k in kept):
                kept.append((name, coverage, first, last))
        return kept


def scan_licenses(docs: DataFrame, text: str = "text", templates: dict[str, str] | None = None, min_coverage: float = 0.8,
                  into: str = "licenses") -> DataFrame:
    """Every row of ``docs`` with a struct ``into``: matches (license, coverage, start and end in characters)."""
    shared = docs.sparkSession.sparkContext.broadcast(known_templates() if templates is None else templates)
    rules = RULES if templates is None else {}

    def start():
        scanner = Scanner(shared.value, min_coverage, rules=rules)

        def compute(texts):
            offsets, names, coverage, spans = [0], [], [], []
            for t in texts:
                matches = scanner.scan(words_of(t))
                names += [m[0] for m in matches]
                coverage += [m[1] for m in matches]
                spans += _characters(t, [(m[2], m[3]) for m in matches]) if matches else []
                offsets.append(len(names))
            rows = pa.StructArray.from_arrays([
                pa.array(names, pa.string()), pa.array(coverage, pa.float64()), pa.array([s for s, _ in spans], pa.int32()),
                pa.array([e for _, e in spans], pa.int32())], ["license", "coverage", "start", "end"])
            return [lists(np.array(offsets), rows)]
        return compute

    return with_struct(docs, text, into, _FIELDS, start)


@query("op2_license_scan")
def op2(spark, d):
    found = F.col("licenses.matches")
    return scan_licenses(table(spark, d, "documents").select("doc_id", "text")).select(
        "doc_id", F.size(found).cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(found["license"])), ",").alias("licenses"),
        F.coalesce(F.array_max(found["coverage"]), F.lit(0.0)).alias("coverage"),
        F.transform(found, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"))).alias("spans"))

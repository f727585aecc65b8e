"""Licence scans: notices and licence texts found by Dice similarity.

A text is cut into lines, into paragraphs (runs of lines between empty ones) and
taken as a whole.  Each part is normalised (lower-cased words of letters, digits
and inner dots) and compared to licence templates over sets of word bigrams:
Dice = 2 |A and B| / (|A| + |B|).  A part of b bigrams can only reach the limit t
against templates of a bigrams with a t / (2 - t) <= b <= a (2 - t) / t, so the
bigram counts choose the templates; a part that no template's bounds admit is
dropped before its words are looked at further.  Common bigrams are counted
through an inverted index of the templates.

Notices inside longer parts are found by windows: where a text holds enough of a
template's bigrams, windows from one of them to another are compared, from every
start to the end that is best, and of overlapping windows the one with the most
common bigrams stays, then the most similar.  A window starts and ends with a
common bigram, as any other only adds words of its own.

Documents are independent: one pass, no shuffle.  The templates are a fixed, small
list that travels with the function: usual notices and short licence texts, and
SPDX lines, notices and headings of the licences in LICENCES.  Callers may pass
their own, such as whole texts of long licences, which are not in the list.

Cases: null and empty texts and parts of fewer than two words match nothing; of
several templates that match a part the most similar is given, ties to the first
name; a part that is also the whole paragraph or text is reported once, as a
line; a window inside a part that is reported is not reported again; repeated rows each give their rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

LIMIT = 0.8

# Usual notices and short public licence texts, by SPDX name.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
     "except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
     "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
     "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
     "permissions and limitations under the License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met: 1. Redistributions of source code must retain "
     "the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
     "binary form must reproduce the above copyright notice, this list of conditions and the following "
     "disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the "
     "LICENSE file."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
     "License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
     "License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or "
     "neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the "
     "GNU General Public License as published by the Free Software Foundation, either version 3 of the License, "
     "or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
     "fee is hereby granted, provided that the above copyright notice and this permission notice appear in all "
     "copies."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
     "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
     "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
     "following conditions: The above copyright notice and this permission notice shall be included in all "
     "copies or substantial portions of the Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
     "of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("LicenseRef-all-rights-reserved", "All rights reserved."),
)

# SPDX names and the licences' own names.
LICENCES = (
    ("0BSD", "BSD Zero Clause License"), ("AFL-3.0", "Academic Free License version 3.0"),
    ("AGPL-3.0", "GNU Affero General Public License, version 3"), ("Apache-1.1", "Apache License, Version 1.1"),
    ("Apache-2.0", "Apache License, Version 2.0"), ("Apache-2.0", "Apache License 2.0"),
    ("Artistic-1.0", "Artistic License 1.0"), ("Artistic-2.0", "Artistic License 2.0"),
    ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-4-Clause", "BSD 4-Clause License"), ("BSL-1.0", "Boost Software License, Version 1.0"),
    ("BUSL-1.1", "Business Source License 1.1"),
    ("CC-BY-3.0", "Creative Commons Attribution 3.0 License"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-NC-ND-4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
    ("CC-BY-NC-SA-4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("CC-BY-ND-4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("CC-BY-SA-3.0", "Creative Commons Attribution-ShareAlike 3.0 License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC0-1.0", "CC0 1.0 Universal Public Domain Dedication"),
    ("CDDL-1.0", "Common Development and Distribution License 1.0"),
    ("CECILL-2.1", "CeCILL Free Software License Agreement version 2.1"),
    ("ECL-2.0", "Educational Community License, Version 2.0"),
    ("EPL-1.0", "Eclipse Public License 1.0"), ("EPL-2.0", "Eclipse Public License 2.0"),
    ("EUPL-1.1", "European Union Public Licence, version 1.1"),
    ("EUPL-1.2", "European Union Public Licence, version 1.2"), ("EUPL-1.2", "EUPL, Version 1.2"),
    ("GFDL-1.3", "GNU Free Documentation License, Version 1.3"),
    ("GPL-1.0", "GNU General Public License, version 1"),
    ("GPL-2.0", "GNU General Public License, version 2"), ("GPL-3.0", "GNU General Public License, version 3"),
    ("ISC", "ISC License"), ("LGPL-2.1", "GNU Lesser General Public License, version 2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License, version 3"), ("MIT", "MIT License"),
    ("MIT-0", "MIT No Attribution License"), ("MPL-1.1", "Mozilla Public License 1.1"),
    ("MPL-2.0", "Mozilla Public License 2.0"), ("MS-PL", "Microsoft Public License"),
    ("MS-RL", "Microsoft Reciprocal License"), ("NCSA", "University of Illinois/NCSA Open Source License"),
    ("ODbL-1.0", "Open Database License v1.0"), ("OFL-1.1", "SIL Open Font License, Version 1.1"),
    ("OSL-3.0", "Open Software License version 3.0"), ("PostgreSQL", "PostgreSQL License"),
    ("PSF-2.0", "Python Software Foundation License Version 2"), ("Unlicense", "Unlicense"),
    ("WTFPL", "Do What The F*ck You Want To Public License"), ("Zlib", "zlib License"),
    ("ZPL-2.1", "Zope Public License 2.1"),
)
SUFFIXES = ("", "-only", "-or-later")       # of the SPDX names of the GNU licences
STARTS = ("distributed under", "licensed under", "released under", "terms of")
HEADING_WORDS = 6                           # a shorter name is a mention, no notice

_WORD = re.compile(r"[^\W_]+(?:\.[^\W_]+)*")


def normal_words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def short_forms(licences=LICENCES) -> list[tuple[str, str]]:
    """SPDX lines, notices and headings of named licences.

    Words that all forms share are few beside the name, so that they alone do not
    reach the limit: two shared bigrams in four or more, one in an SPDX line."""
    forms = []
    for spdx, name in licences:
        size = len(normal_words(name))
        forms += [(spdx, f"License-Identifier: {spdx}{x}") for x in (SUFFIXES if "GNU" in name else SUFFIXES[:1])]
        if size > 1:
            forms += [(spdx, f"{start} the {name}") for start in STARTS]
        if size >= HEADING_WORDS:
            forms.append((spdx, name))
    return sorted(set(forms))


KNOWN = (*TEMPLATES, *short_forms())


class Templates:
    """Templates by size, and an inverted index of their bigrams."""

    def __init__(self, templates=KNOWN, limit: float = LIMIT):
        self.limit = limit
        self.names = [name for name, _ in templates]
        sets = [set(zip(w, w[1:])) for w in (normal_words(text) for _, text in templates)]
        self.sizes = [len(s) for s in sets]
        self.by_bigram: dict[tuple, list[int]] = {}
        for i, s in enumerate(sets):
            for pair in s:
                self.by_bigram.setdefault(pair, []).append(i)
        # a hair wider, as a bound that is a whole number may be rounded past it
        self.bounds = [(size * limit / (2 - limit) - 1e-9, size * (2 - limit) / limit + 1e-9) for size in self.sizes]
        self.low = min((b[0] for b in self.bounds), default=0)
        self.high = max((b[1] for b in self.bounds), default=0)

    def best(self, words: list[str]) -> tuple[str, float] | None:
        """The most similar template of a part, where it reaches the limit.

        A set is never larger than its list, so the upper bound needs the set;
        the lower bound prunes on the list already.
        """
        if len(words) - 1 < self.low or len(words) < 2:
            return None
        get = self.by_bigram.get
        if len(words) > 12 and not any(map(get, zip(words, words[1:]))):
            return None
        pairs = set(zip(words, words[1:]))
        size = len(pairs)
        if not self.low <= size <= self.high:
            return None
        fits = {i for i, (low, high) in enumerate(self.bounds) if low <= size <= high}
        common = Counter(i for pair in pairs for i in get(pair, ()) if i in fits)
        scored = [(2 * n / (size + self.sizes[i]), i) for i, n in common.items()]
        scored = [(d, i) for d, i in scored if d >= self.limit]
        if not scored:
            return None
        dice, i = min(scored, key=lambda x: (-x[0], self.names[x[1]], x[1]))
        return self.names[i], dice

    def windows(self, words: list[str]) -> list[tuple[int, int, str, float]]:
        """(first word, end, licence, dice) of the windows that reach a limit;
        they share no bigram."""
        get = self.by_bigram.get
        pairs = list(zip(words, words[1:]))
        distinct = Counter(i for pair in set(pairs) for i in get(pair, ()))
        # common bigrams are at least the lower bound
        needs = {i: n for i, c in distinct.items() if c >= (n := max(1, math.ceil(self.bounds[i][0])))}
        hits: dict[int, list[int]] = {}
        for at, pair in enumerate(pairs if needs else ()):
            for i in get(pair, ()):
                if i in needs:
                    hits.setdefault(i, []).append(at)
        found = []
        for i, places in hits.items():
            size, high, need = self.sizes[i], self.bounds[i][1], needs[i]
            known = set(places)
            for start in places[:len(places) - need + 1]:
                inside, common, best = {pairs[start]}, 1, (0.0, 0, 0)
                for at in range(start, len(pairs)):
                    if at > start:
                        if pairs[at] == pairs[start]:
                            break           # the later start has all that this one has
                        if pairs[at] in inside:
                            continue
                        inside.add(pairs[at])
                        common += at in known
                    if len(inside) > high:
                        break
                    if at in known:
                        best = max(best, (2 * common / (len(inside) + size), common, -at))
                        if common == size:
                            break
                if best[0] >= self.limit:
                    found.append((-best[1], -best[0], self.names[i], start, 1 - best[2]))
        out, taken = [], set()
        for _, dice, name, start, end in sorted(found):
            if taken.isdisjoint(range(start, end)):
                taken.update(range(start, end))
                out.append((start, end + 1, name, -dice))
        return sorted(out)

    def scan(self, text: str) -> list[tuple[str, float, str, int]]:
        """(licence, dice, part, number of its first line from 0)."""
        out = []
        lines = [normal_words(line) for line in text.split("\n")]
        firsts = list(accumulate(map(len, lines), initial=0))
        parts = []      # reported: first word and end
        for number, words in enumerate(lines):
            if found := self.best(words):
                out.append((*found, "line", number))
                parts.append((firsts[number], firsts[number + 1]))
        whole: list[str] = []
        paragraph: list[str] = []
        first = held = paragraphs = filled = 0
        for number, words in enumerate([*lines, []]):
            if words:
                if not paragraph:
                    first, held = number, 0
                paragraph += words
                held += 1
                filled += 1
            elif paragraph:
                if held > 1 and (found := self.best(paragraph)):
                    out.append((*found, "paragraph", first))
                    parts.append((firsts[first], firsts[first] + len(paragraph)))
                whole += paragraph
                paragraphs += 1
                paragraph = []
        if paragraphs > 1 and (found := self.best(whole)):
            out.append((*found, "text", 0))
            parts.append((0, len(whole)))
        for start, end, name, dice in self.windows(whole):
            if not any(a <= start and end <= b for a, b in parts):
                out.append((name, dice, "window", bisect_right(firsts, start) - 1))
        return out


def scan(docs: DataFrame, templates=KNOWN, limit: float = LIMIT) -> DataFrame:
    """(doc_id, licence, dice, part, line): every licence part of every document."""
    known = Templates(templates, limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for i, value in enumerate(batch.column(1)):
                text = value.as_py()
                found = known.scan(text) if text else ()
                rows += found
                at += [i] * len(found)
            columns = list(zip(*rows)) or [(), (), (), ()]
            kinds = (pa.string(), pa.float64(), pa.string(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int32())), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                names=["doc_id", "licence", "dice", "part", "line"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, licence string, dice double, part string, line int")

"""Licence scans: passages compared with licence templates by the Dice coefficient over word bigrams."""

from __future__ import annotations

import bisect
import heapq
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import map_rows, query, table
from ledgerloom.llm.passages import Vocabulary, lookup, words_of

LEAST_DICE = 0.8

# Public licence notices and texts, as their owners ask them to be given.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all copies
        or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
        EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
        PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
        DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
        CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
        INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
        ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE,
        DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
        CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-conditions": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce
        the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or
        other materials provided with the distribution.""",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is
        distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See
        the License for the specific language governing permissions and limitations under the License.""",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify it under the terms of the
        GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or
        (at your option) any later version. This program is distributed in the hope that it will be useful, but
        WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
        See the GNU General Public License for more details.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
        was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary,
        for any purpose, commercial or non-commercial, and by any means.""",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-SA-4.0-long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-ND-4.0-long": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC-BY-NC-SA-4.0-long": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "CC-BY-NC-ND-4.0-long": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "CC0-1.0": "This work is marked with CC0 1.0 Universal.",
    "LGPL-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-2.1-notice": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "AGPL-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "BSL-1.0-notice": "Distributed under the Boost Software License, Version 1.0.",
    "EPL-2.0-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
}


class Templates:
    """Bigrams of the templates, and which passages can reach the least Dice coefficient by size alone."""

    def __init__(self, texts: dict[str, str], least: float):
        kept = {name: words_of(t) for name, t in texts.items() if len(words_of(t)) > 1}
        self.names, self.least = list(kept), least
        self.vocabulary = Vocabulary(kept.values())
        self.counts = [Counter(self.vocabulary.gram_codes(self.vocabulary.ids(w), 2)[0].tolist()) for w in kept.values()]
        self.sizes = [sum(c.values()) for c in self.counts]
        self.codes = np.array(sorted({c for own in self.counts for c in own}), np.int64)
        self.member = np.array([[c in own for c in self.codes.tolist()] for own in self.counts], bool).reshape(len(kept), -1)
        # 2 overlap / (size + other) >= least, with overlap <= the smaller, bounds the other size and the overlap.
        self.largest = [int(s * (2 - least) / least + 1e-9) for s in self.sizes]
        self.overlap = [int(np.ceil(s * least / (2 - least) - 1e-9)) for s in self.sizes]


def passages(codes: list[int], at: list[int], counts: Counter, size: int, largest: int, need: int, least: float) -> list[tuple[float, int, int]]:
    """(dice, first, last bigram) of passages that match a template, the most alike first, none over another.

    ``codes`` and ``at`` are the template's bigrams that the text has, and where. A best passage begins and ends with a
    shared bigram, and a passage is no longer than ``largest``, so each place looks that far ahead once, and again only
    when a passage found cuts off its own. Ties go to the first.
    """

    def best_from(i: int, stop: int) -> tuple[float, int, int] | None:
        if i + need > stop or at[i + need - 1] - at[i] >= largest:
            return None
        left: dict[int, int] = {}
        best, overlap = None, 0
        for j in range(i, stop):
            if at[j] - at[i] >= largest:
                break
            taken = left.get(codes[j], 0)
            if taken < counts[codes[j]]:
                left[codes[j]] = taken + 1
                overlap += 1
                dice = 2 * overlap / (size + at[j] - at[i] + 1)
                if dice >= least - 1e-12 and (best is None or dice > -best[0]):
                    best = (-dice, i, j)
        return best

    heap = [b for i in range(len(at)) if (b := best_from(i, len(at)))]
    heapq.heapify(heap)
    starts, ends, out = [], [], []  # of the passages found, in order of their place
    while heap:
        dice, i, j = heapq.heappop(heap)
        k = bisect.bisect_right(starts, i)
        if k and ends[k - 1] >= i:
            continue
        if k < len(starts) and starts[k] <= j:
            if again := best_from(i, starts[k]):
                heapq.heappush(heap, again)
            continue
        starts.insert(k, i)
        ends.insert(k, j)
        out.append((-dice, at[i], at[j]))
    return out


def found_in(templates: Templates, text: str | None) -> list[tuple[str, float, int, int]]:
    """(template, dice, first word, end word) of the passages found, by place; of overlapping ones the most alike."""
    codes, at = templates.vocabulary.gram_codes(templates.vocabulary.ids(words_of(text)), 2)
    hit, which = lookup(templates.codes, codes)
    if not len(hit):
        return []
    found = []
    for t, name in enumerate(templates.names):
        own = templates.member[t][which]
        places, need = at[hit[own]], templates.overlap[t]
        # Size bound: enough of the template's bigrams must lie within the largest passage that can match.
        if len(places) < need or not (places[need - 1 :] - places[: len(places) - need + 1] < templates.largest[t]).any():
            continue
        best = passages(codes[hit[own]].tolist(), places.tolist(), templates.counts[t], templates.sizes[t], templates.largest[t], need, templates.least)
        found += [(name, dice, first, last + 2) for dice, first, last in best]
    starts: list[int] = []
    kept: list[tuple[str, float, int, int]] = []  # by place
    for one in sorted(found, key=lambda f: (-f[1], f[2] - f[3], f[2], f[0])):
        k = bisect.bisect_right(starts, one[2])
        if (not k or kept[k - 1][3] <= one[2]) and (k == len(kept) or kept[k][2] >= one[3]):
            starts.insert(k, one[2])
            kept.insert(k, one)
    return kept


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST_DICE) -> DataFrame:
    """Columns doc_id, n_licenses, licenses (array of name, dice, start_word, end_word), for every row.

    Texts and templates are normalised to lower-cased words. A passage (any run of words, so also a whole text)
    matches a template if the Dice coefficient of their bigrams, repeats counted, is ``least`` or more. By size
    alone a template of n bigrams can only match passages of n least / (2 - least) to n (2 - least) / least
    bigrams, with at least the former in common; a text without so many within such a stretch is not compared.
    Of passages that overlap the one most alike stays (then the longer, the earlier, the first by name). Nothing is
    shuffled; the templates (a parameter, here a few kB) go to every task. Null and empty texts hold none. Repeated
    rows and null ids keep their rows; an empty table gives none; other columns are ignored.
    """
    known = Templates(templates, least)

    def run(doc_id, text):
        found = found_in(known, text)
        yield doc_id, len(found), [dict(zip(("name", "dice", "start_word", "end_word"), f)) for f in found]

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    one = "array<struct<name:string,dice:double,start_word:long,end_word:long>>"
    return map_rows(texts, run, f"doc_id long, n_licenses long, licenses {one}")


@query("op10_licenses")
def op10_licenses(spark, sf_dir):
    found = scan(table(spark, sf_dir, "documents", "doc_id", "text"))
    shown = F.transform("licenses", lambda f: F.concat_ws(":", f["name"], F.format_number(f["dice"], 4), f["start_word"].cast("string"), f["end_word"].cast("string")))
    best = F.array_max(F.transform("licenses", lambda f: F.struct(f["dice"].alias("dice"), f["name"].alias("name"))))
    return found.select("doc_id", "n_licenses", F.array_join(shown, ",").alias("licenses"), best["name"].alias("best_license"), best["dice"].alias("best_dice"))

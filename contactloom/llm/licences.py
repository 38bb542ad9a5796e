"""Licence notices found by the Dice coefficient of word bigrams, in DataFrame functions.

``licence_lines`` takes every line as a candidate.  Its distinct bigrams are
compared with those of a template when the sizes allow the threshold, and when
the line holds one of the bigrams that any similar line must share (so many of
a template's bigrams that the rest would not reach the threshold).

``licence_notices`` slides windows of words over the whole text, line breaks
taken as spaces, so that wrapped notices and notices inside a line are found.

All work is within the row: no shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom.llm.tables import col

# fixed values: short notices as they are published with the licences
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0"],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}
# longer notices, licence texts and other versions, for windows of the whole text
_GPL = "This {0} is free software{1} you can redistribute it and/or modify it under the terms of the GNU {2}General Public License as published by the Free Software Foundation{3} either version {4} of the License, or (at your option) any later version."
_AS_IS = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_BSD_2 = TEMPLATES["BSD"][0] + " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
_BSD_3 = _BSD_2 + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
LONGER = {
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3.", _GPL.format("program", ":", "Affero ", ",", 3), "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "Apache-1.1": ["Licensed under the Apache License, Version 1.1."],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    ],
    "BSD": [_BSD_2 + _AS_IS, _BSD_3 + _AS_IS],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0.", "Boost Software License - Version 1.0 - August 17th, 2003"],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "This work is released under CC0 1.0 Universal, Public Domain Dedication"],
    "GPL-1.0": ["This work is licensed under the GNU General Public License, version 1."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", _GPL.format("program", ";", "", ";", 2), "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "GPL-3.0": [_GPL.format("program", ":", "", ",", 3), "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "ISC": [TEMPLATES["ISC"][0] + ", provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."],
    "LGPL-2.1": ["This work is licensed under the GNU Lesser General Public License, version 2.1.", _GPL.format("library", ";", "Lesser ", ";", "2.1"), "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3.", _GPL.format("program", ":", "Lesser ", ",", 3), "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "MIT": ["The MIT License (MIT)", TEMPLATES["MIT"][2] + " (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
    "MPL-1.1": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1."],
    "MPL-2.0": [TEMPLATES["MPL-2.0"][0] + " If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.", "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity"],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
} | {f"CC-{k}-{v}": [f"This work is licensed under a Creative Commons {name} {v} {kind} License.", f"Licensed under CC {k} {v}."] for k, name in _CC.items() for v, kind in (("3.0", "Unported"), ("4.0", "International"))}
#: Identifiers of a family that differ from its name.
IDENTIFIERS = {"BSD": ("BSD-2-Clause", "BSD-3-Clause")}

def every_template() -> dict[str, list[str]]:
    """All notices of each family, with the tag line of its identifiers."""
    names = sorted({*TEMPLATES, *LONGER})
    return {k: TEMPLATES.get(k, []) + LONGER.get(k, []) + [f"SPDX-License-Identifier: {x}" for x in IDENTIFIERS.get(k, (k,))] for k in names}


NOT_WORD = "[^\\p{L}\\p{N}\\n]+"


def bigrams_of(text: str) -> list[str]:
    """Distinct word bigrams of one line, as the Spark expressions make them."""
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


def _bigrams(line: Column) -> Column:
    # a nested transform binds the words, so that they are split once
    made = F.transform(F.array(F.array_remove(F.split(line, " "), "")), lambda w: F.array_distinct(F.transform(F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))), lambda x, i: F.concat(x, F.lit(" "), F.get(w, i + 1)))))
    return F.get(made, F.lit(0))


def licence_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """A row per input row: ``id_col`` and ``matches``, array of (line, licence, permille).

    ``line`` counts from 0, ``permille`` is 1000 times the Dice coefficient,
    rounded down; of a line's templates the most similar counts, on ties the
    first name.  A null or empty text has no matches; lines of fewer than two
    words have no bigrams.  Letters are compared in lower case, everything but
    letters and digits parts words.  Repeated rows and null ids are rows like
    others; an empty table gives none.  Only the two named columns are read.
    """
    table = _table(templates or TEMPLATES, threshold)
    text = F.regexp_replace(F.lower(F.coalesce(col(text_col).cast("string"), F.lit(""))), NOT_WORD, " ")
    made = docs.select(col(id_col).alias("i"), _split_lines(text).alias("l"))
    near = made.select("i", _near_lines(F.col("l"), table, threshold).alias("l"))
    return near.select(F.col("i").alias(id_col), _best_of_lines(F.col("l"), table, threshold).alias("matches"))


def _table(templates: dict[str, list[str]], threshold: float) -> list[tuple[str, list[str], int]]:
    """Name, distinct bigrams and number of bigrams of every template."""
    table = [(name, bigrams_of(t), len([w for w in re.split(r"[\W_]+", t.lower()) if w]) - 1) for name, ts in sorted(templates.items()) for t in dict.fromkeys(ts)]
    if not 0 < threshold <= 1 or any(not b for _, b, _ in table):
        raise ValueError("a threshold in (0, 1] and templates of two words or more are needed")
    return table


def _bounds(b: list[str], threshold: float) -> tuple[int, int]:
    """Least and greatest number of distinct bigrams of what reaches the threshold."""
    ratio = threshold / (2 - threshold)
    return math.ceil(ratio * len(b) - 1e-9), math.floor(len(b) / ratio + 1e-9)


def _rows(table: list, threshold: float) -> Column:
    """The templates as an array; ``reach`` is the greatest number of bigrams of a window."""
    rows = []
    for name, b, n in table:
        lo, hi = _bounds(b, threshold)
        rows.append(F.struct(F.lit(name).alias("name"), F.array(*map(F.lit, b)).alias("b"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"), F.lit(hi + n - len(b)).alias("reach")))
    return F.array(*rows)


def _split_lines(text: Column) -> Column:
    return F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("line"), _bigrams(x).alias("b")))


def _near_lines(lines: Column, table: list, threshold: float) -> Column:
    often = Counter(x for _, b, _ in table for x in b)
    probes = set()
    for _, b, _ in table:
        probes |= set(sorted(b, key=lambda x: (often[x], x))[: len(b) - _bounds(b, threshold)[0] + 1])
    lo, hi = min(_bounds(b, threshold)[0] for _, b, _ in table), max(_bounds(b, threshold)[1] for _, b, _ in table)
    probe = F.array(*map(F.lit, sorted(probes)))
    return F.filter(lines, lambda e: (F.size(e["b"]) >= lo) & (F.size(e["b"]) <= hi) & F.arrays_overlap(e["b"], probe))


def _best_of_lines(lines: Column, table: list, threshold: float) -> Column:
    rows = _rows(table, threshold)

    def scored(e: Column) -> Column:
        fits = F.filter(rows, lambda t: (F.size(e["b"]) >= t["lo"]) & (F.size(e["b"]) <= t["hi"]))
        one = F.transform(fits, lambda t: F.struct(F.floor(F.lit(2000) * F.size(F.array_intersect(e["b"], t["b"])) / (F.size(e["b"]) + F.size(t["b"]))).alias("permille"), t["name"].alias("licence")))
        return F.filter(one, lambda s: s["permille"] >= int(1000 * threshold))

    def best(e: Column) -> Column:
        # the greatest similarity, then the first name
        ordered = F.array_sort(F.transform(scored(e), lambda s: F.struct((-s["permille"]).alias("a"), s["licence"].alias("licence"))))
        return F.transform(F.slice(ordered, F.lit(1), F.lit(1)), lambda s: F.struct(e["line"].cast("bigint").alias("line"), s["licence"].alias("licence"), (-s["a"]).alias("permille")))

    return F.flatten(F.transform(lines, best))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _windows(hits: Column, t: Column, threshold: float) -> Column:
    """The best window from every word pair of a template: (-shared, -permille, licence, p, e)."""
    size = F.size(t["b"])

    def marked(h: Column) -> Column:
        # the place of the same pair before, as far as a window reaches
        def before(x: Column, k: Column) -> Column:
            first = F.greatest(k + 1 - t["reach"], F.lit(1))
            same = F.filter(F.slice(h, first, k - first + 1), lambda y: y["b"] == x["b"])
            return F.struct(x["p"].alias("p"), F.coalesce(F.array_max(F.transform(same, lambda y: y["p"])), F.lit(-1)).alias("prev"))

        return F.transform(h, before)

    def from_start(h: Column, x: Column, k: Column) -> Column:
        seg = F.filter(F.slice(h, k + 1, t["reach"]), lambda y: y["p"] < x["p"] + t["reach"])
        zero = F.struct(F.lit(0).alias("s"), F.lit(0).alias("d"), F.lit(0).alias("m"), F.lit(0).alias("bs"), F.lit(0).alias("e"))

        def step(a: Column, y: Column) -> Column:
            new = F.when(y["prev"] < x["p"], 1).otherwise(0)

            def put(c: Column) -> Column:
                better = (c["m"] > a["m"]) | ((c["m"] == a["m"]) & (c["s"] > a["bs"]))
                return F.struct(c["s"].alias("s"), c["d"].alias("d"), F.when(better, c["m"]).otherwise(a["m"]).alias("m"), F.when(better, c["s"]).otherwise(a["bs"]).alias("bs"), F.when(better, y["p"]).otherwise(a["e"]).alias("e"))

            def with_size(c: Column) -> Column:
                # a window is no smaller than the template
                held = F.greatest(y["p"] - x["p"] + 1 - c["d"], size)
                return _let(F.struct(c["s"].alias("s"), c["d"].alias("d"), F.floor(F.lit(2000) * c["s"] / (held + size)).cast("int").alias("m")), put)

            return _let(F.struct((a["s"] + new).alias("s"), (a["d"] + 1 - new).alias("d")), with_size)

        found = F.when(F.size(seg) >= t["lo"], F.aggregate(seg, zero, step)).otherwise(zero)
        return _let(found, lambda r: F.struct((-r["bs"]).alias("s"), (-r["m"]).alias("m"), t["name"].alias("licence"), x["p"].alias("p"), r["e"].alias("e")))

    mine = F.filter(hits, lambda x: F.array_contains(t["b"], x["b"]))
    every = _let(mine, lambda h: _let(marked(h), lambda q: F.transform(q, lambda x, k: from_start(q, x, k))))
    return F.filter(every, lambda c: c["m"] <= -int(1000 * threshold))


def licence_notices(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """A row per input row: ``id_col`` and ``matches``, array of (line, licence, permille).

    Windows of words over the whole text, line breaks taken as spaces, that
    begin and end with a word pair of a template are compared with it; those
    shorter than the template count as long as it.  Of overlapping windows the
    one with most common pairs stays, then the most similar, then the first
    name.  ``line`` is where the window starts.  Lines that ``licence_lines``
    finds with the same templates and that no window touches are added.

    A template is looked at only where the text has as many of its distinct
    pairs as the threshold asks for.  Windows grow with the text times a
    template's length; parting overlaps, with the notices of one text squared.
    A null or empty text has no matches, repeated rows and null ids are rows
    like others, an empty table gives none, and only the two named columns are
    read.
    """
    table = _table(templates or every_template(), threshold)
    pairs = sorted({x for _, b, _ in table for x in b})
    firsts, seconds = (sorted({x.split()[k] for x in pairs}) for k in (0, 1))
    rows = _rows(table, threshold)
    split = lambda x: F.array_remove(F.split(x, " "), "")
    empty = F.array().cast("array<struct<line:bigint,licence:string,permille:bigint>>")

    def pair_hits(w: Column) -> Column:
        # most words begin no pair, so that few pairs are put together
        paired = lambda x, k: _let(F.concat(x, F.lit(" "), F.get(w, k + 1)), lambda g: F.when(g.isin(pairs), F.struct(k.alias("p"), g.alias("b"))))
        found = F.transform(w, lambda x, k: F.when(x.isin(firsts) & F.get(w, k + 1).isin(seconds), paired(x, k)))
        return F.filter(found, lambda x: x.isNotNull())

    def parted(c: Column) -> Column:
        touches = lambda a, x: (x["p"] <= a["e"] + 1) & (a["p"] <= x["e"] + 1)
        none = F.filter(c, lambda x: F.lit(False))
        return F.aggregate(c, none, lambda acc, x: F.when(F.exists(acc, lambda a: touches(a, x)), acc).otherwise(F.concat(acc, F.array(x))))

    def finished(chosen: Column, text: Column) -> Column:
        at = F.flatten(F.transform(F.split(text, "\n"), lambda x, k: F.array_repeat(k, F.size(split(x)))))
        spans = _let(at, lambda ln: F.transform(chosen, lambda c: F.struct(F.get(ln, c["p"]).cast("bigint").alias("line"), c["licence"].alias("licence"), (-c["m"]).cast("bigint").alias("permille"), F.get(ln, c["e"] + 1).alias("last"))))

        def joined(s: Column) -> Column:
            lines = _best_of_lines(_near_lines(_split_lines(text), table, threshold), table, threshold)
            rest = F.filter(lines, lambda x: ~F.exists(s, lambda a: (a["line"] <= x["line"]) & (x["line"] <= a["last"])))
            return F.array_sort(F.concat(F.transform(s, lambda a: F.struct(a["line"].alias("line"), a["licence"].alias("licence"), a["permille"].alias("permille"))), rest))

        return _let(spans, joined)

    def matches(hits: Column, text: Column) -> Column:
        held = F.array_distinct(F.transform(hits, lambda x: x["b"]))
        fits = _let(held, lambda d: F.filter(rows, lambda t: F.when(F.size(d) >= t["lo"], F.size(F.array_intersect(d, t["b"])) >= t["lo"]).otherwise(False)))

        def looked(f: Column) -> Column:
            all_windows = F.array_sort(F.flatten(F.transform(f, lambda t: _windows(hits, t, threshold))))
            return F.when(F.size(f) > 0, _let(parted(all_windows), lambda c: finished(c, text))).otherwise(empty)

        return _let(fits, looked)

    made = docs.select(col(id_col).alias("i"), F.regexp_replace(F.lower(F.coalesce(col(text_col).cast("string"), F.lit(""))), NOT_WORD, " ").alias("x"))
    found = _let(F.col("x"), lambda x: _let(split(F.translate(x, "\n", " ")), lambda w: _let(pair_hits(w), lambda h: matches(h, x))))
    return made.select(F.col("i").alias(id_col), found.alias("matches"))

"""Licence scan: Dice coefficient over word bigrams against licence templates.

A document's segments are the whole text, its paragraphs, lines and sentences.
A segment is normalised to its words (A-Z as a-z, runs of a-z and 0-9), and it
matches the template with the greatest Dice coefficient of their sets of word
bigrams, if that is THRESHOLD or more.

A notice need not fill a segment.  A template that no segment matches is looked
for in windows of as many words as it has, laid so that one of its bigrams with a
required word (below) falls on its own place; the best window counts if its
coefficient is THRESHOLD or more, the leftmost of equals.  A window that would
start before the text starts with it, one that would go on behind it ends there.

Two bounds keep this cheap.  Sizes: a coefficient of t needs sizes within a
factor (2 - t) / t of each other, so other templates are not compared.  Words: a
match holds at least t / (2 - t) of a template's bigrams, so one of these bigrams
has a word out of a small set that is derived from the templates; texts without
any of these required words are not split at all, and every window that matches
shares such a bigram.

One pass without a shuffle, built-in functions only; the templates are constants.

Cases: null and empty texts, and texts without words, match nothing; each row,
repeated or not, gets its result; of equal coefficients the first template
counts; extra columns don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Licence notices, in their published wording.
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "BSD-3-Clause-text": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "BSD-clause-1": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "BSD-clause-2": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "ISC-text": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "MIT": "Released under the MIT License.",
    "MIT-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "MIT-text": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "all-rights-reserved": "All rights reserved.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}


def words_of(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def bigrams(text: str) -> list[str]:
    w = words_of(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:])))


def anchors(templates: dict[str, str], required: list[str]) -> list[tuple[str, str, int, int]]:
    """(bigram, template, its words, place of the bigram from 0) of all bigrams with a required word."""
    found = []
    for name, text in templates.items():
        w = words_of(text)
        found += [(f"{a} {b}", name, len(w), i) for i, (a, b) in enumerate(zip(w, w[1:])) if a in required or b in required]
    return found


def required_words(templates: dict[str, list[str]], threshold: float) -> list[str]:
    """Words, few of them, one of which every matching text contains: for each
    template they cover more of its bigrams than a match can lack."""
    lack = {k: len(b) - math.ceil(threshold / (2 - threshold) * len(b) - 1e-9) for k, b in templates.items()}
    covered: dict[str, set[str]] = {k: set() for k in templates}
    chosen: list[str] = []
    while open_ := [k for k in templates if len(covered[k]) <= lack[k]]:
        gain: dict[str, int] = {}
        for k in open_:
            for g in set(templates[k]) - covered[k]:
                for w in set(g.split()):
                    gain[w] = gain.get(w, 0) + (len(w) > 4) * 100 + 1
        best = max(sorted(gain), key=gain.__getitem__)
        chosen.append(best)
        for k in templates:
            covered[k] |= {g for g in templates[k] if best in g.split()}
    return chosen


def _sql(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _known(grams: dict[str, list[str]]) -> Column:
    """array<struct<name, n, grams>>, written as one SQL literal: thousands of Column objects take seconds to build."""
    return F.expr("array({})".format(", ".join(
        f"named_struct('name', {_sql(k)}, 'n', {len(b)}, 'grams', array({', '.join(map(_sql, b))}))" for k, b in grams.items())))


def scan_column(text: Column | str, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> Column:
    """array<struct<licence, dice, words>>, an entry per matching segment, then one per template found in a window only."""
    grams = {k: bigrams(v) for k, v in templates.items()}
    required = required_words(grams, threshold)
    folded = F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    maybe = None
    for w in required:
        maybe = folded.contains(w) if maybe is None else maybe | folded.contains(w)
    cuts = [r"\n\s*\n", r"\n", r"(?<=[.!?])\s+"]
    parts = F.concat(F.array(folded), *(F.split(folded, c) for c in cuts))
    known = _known(grams)
    least = min(map(len, grams.values())) * threshold / (2 - threshold)
    most = max(map(len, grams.values())) * (2 - threshold) / threshold
    words = F.filter(F.array_distinct(F.transform(parts, lambda s: F.trim(F.regexp_replace(s, "[^a-z0-9]+", " ")))),
                     lambda s: (F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))).between(math.floor(least), 1 << 30))
    split = F.transform(words, lambda s: F.struct(s.alias("words"), F.split(s, " ").alias("w")))
    pairs = F.transform(split, lambda s: F.struct(
        s["words"].alias("words"),
        F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(s["w"]) - 1), lambda i: F.concat(F.get(s["w"], i - 1), F.lit(" "), F.get(s["w"], i)))).alias("grams")))
    pairs = F.filter(pairs, lambda s: (F.size(s["grams"]) >= F.lit(least)) & (F.size(s["grams"]) <= F.lit(most)))

    def best(s):
        near = F.filter(known, lambda t: (t["n"] * F.lit(threshold / (2 - threshold)) <= F.size(s["grams"]) + F.lit(1e-9))
                        & (F.size(s["grams"]) <= t["n"] * F.lit((2 - threshold) / threshold) + F.lit(1e-9)))
        scored = F.transform(near, lambda t: F.struct(
            (F.lit(2.0) * F.size(F.array_intersect(s["grams"], t["grams"])) / (F.size(s["grams"]) + t["n"])).alias("dice"), t["name"].alias("licence")))
        good = F.filter(scored, lambda t: t["dice"] >= F.lit(threshold))
        top = F.array_max(F.transform(good, lambda t: t["dice"]))
        return F.struct(F.array_min(F.transform(F.filter(good, lambda t: t["dice"] == top), lambda t: t["licence"])).alias("licence"),
                        top.alias("dice"), s["words"].alias("words"))

    found = F.filter(F.transform(pairs, best), lambda m: m["licence"].isNotNull())
    inside = _windows(folded, templates, grams, required, threshold)
    found = _once(F.struct(found.alias("found"), inside.alias("inside")), lambda x: F.concat(
        x["found"], F.filter(x["inside"], lambda m: ~F.exists(x["found"], lambda f: f["licence"] == m["licence"]))))
    return F.when(maybe, found).otherwise(F.array().cast("array<struct<licence:string,dice:double,words:string>>"))


def _once(value: Column, use) -> Column:
    """use(value), the value evaluated once wherever use has it, lambdas included."""
    return F.transform(F.array(value), use)[0]


def _grams(w: Column, start: Column, n: Column) -> Column:
    """The bigrams of up to n words from start (from 0) on; slice would copy all words for each window."""
    return F.array_distinct(F.transform(F.sequence(start, F.least(start + n, F.size(w)) - 2), lambda i: F.concat(F.get(w, i), F.lit(" "), F.get(w, i + 1))))


def _windows(folded: Column, templates: dict[str, str], grams: dict[str, list[str]], required: list[str], threshold: float) -> Column:
    """array<struct<licence, dice, words>>: the best window of each template that has one."""
    laid = F.expr("array({})".format(", ".join(
        f"named_struct('gram', {_sql(g)}, 'name', {_sql(k)}, 'n', {n}, 'at', {i})" for g, k, n, i in anchors(templates, required))))
    known = _known(grams)
    least = F.lit(threshold / (2 - threshold))

    def of_text(w):
        needed = F.array(*map(F.lit, required))
        marks = F.filter(F.sequence(F.lit(0), F.greatest(F.size(w) - 2, F.lit(0))),
                         lambda i: F.array_contains(needed, F.get(w, i)) | F.array_contains(needed, F.get(w, i + 1)))
        starts = F.array_distinct(F.flatten(F.transform(marks, lambda i: F.transform(
            F.filter(laid, lambda a: a["gram"] == F.concat(F.get(w, i), F.lit(" "), F.get(w, i + 1))),
            lambda a: F.struct(a["name"].alias("name"), a["n"].alias("n"), F.greatest(i - a["at"], F.lit(0)).alias("start"))))))

        def score(t, s):
            return _once(_grams(w, s["start"], s["n"]), lambda g: F.when(
                F.size(g) >= F.size(t["grams"]) * least,
                F.lit(2.0) * F.size(F.array_intersect(g, t["grams"])) / (F.size(g) + F.size(t["grams"]))).otherwise(F.lit(0.0)))

        tops = _once(starts, lambda all_: F.transform(known, lambda t: F.array_max(F.filter(F.transform(
            F.filter(all_, lambda s: s["name"] == t["name"]),
            lambda s: F.struct(score(t, s).alias("dice"), (-s["start"]).alias("before"), s["n"].alias("n"), t["name"].alias("licence"))),
            lambda m: m["dice"] >= F.lit(threshold)))))
        return F.transform(F.filter(tops, lambda m: m.isNotNull()), lambda m: F.struct(
            m["licence"].alias("licence"), m["dice"].alias("dice"), F.concat_ws(" ", F.slice(w, F.lit(1) - m["before"], m["n"])).alias("words")))

    whole = F.filter(F.split(F.regexp_replace(folded, "[^a-z0-9]+", " "), " "), lambda x: x != "")
    return F.flatten(F.transform(F.filter(F.array(whole), lambda w: F.size(w) >= 2), of_text))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_matches, licences, best_licence, best_dice, matches)."""
    m = F.col("matches")
    top = F.array_max(F.transform(m, lambda x: x["dice"]))
    return (docs.select("doc_id", scan_column("text", templates, threshold).alias("matches"))
                .select("doc_id", F.size(m).cast("long").alias("n_matches"),
                        F.array_sort(F.array_distinct(F.transform(m, lambda x: x["licence"]))).alias("licences"),
                        F.array_min(F.transform(F.filter(m, lambda x: x["dice"] == top), lambda x: x["licence"])).alias("best_licence"),
                        top.alias("best_dice"), m))

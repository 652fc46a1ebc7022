"""License scans by Dice coefficient over word bigrams.

Texts are normalised, and runs of their words compared as sets of word bigrams to license templates. Twice the smaller
set bounds what both share: only templates of which a text has enough are compared at all, and only to runs of a
similar size. ``scan`` compares single lines and paragraphs instead, and counts them. All of it is Spark SQL; the templates are literals of the expression.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, functions as F

from .common import ROW, text_of

#: Notices and texts under which works are published, as their publishers word them.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."),
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details."),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."),
    "mit-line": "Released under the MIT License.",
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means."),
}
# the whole texts of short licenses: the grant, then the disclaimer
TEMPLATES |= {
    "bsd-2-clause-text": TEMPLATES["bsd-2-clause"] + " " + (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    "isc-text": TEMPLATES["isc"] + " " + (
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
        "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
        "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION "
        "WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "mit-text": TEMPLATES["mit"] + " " + (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
        "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."),
}
LEAST = 0.8
#: What separates words after lower-casing.
BETWEEN = "[^a-z0-9]+"
#: A copyright line names a holder, which is no part of a license.
HOLDER = r"(?imd)^[^a-z0-9]*copyright\b[^\n]*$"
PAIR = r"(?=([a-z0-9]+ [a-z0-9]+))[a-z0-9]+"


def bigrams_of(text: str) -> list[str]:
    """The distinct word bigrams of a template, in order."""
    words = [w for w in re.split(BETWEEN, text.lower()) if w]
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def bigrams_in_order(text: Column) -> Column:
    plain = F.regexp_replace(F.lower(F.regexp_replace(text, HOLDER, "")), BETWEEN, " ")
    return F.regexp_extract_all(plain, F.lit(PAIR), F.lit(1))


def bigrams(unit: Column) -> Column:
    """The distinct word bigrams of a text."""
    return F.array_distinct(bigrams_in_order(unit))


def units(text: Column) -> Column:
    """All lines, and all paragraphs of more than one line."""
    paragraphs = F.filter(F.split(text, r"\n[\x20\x09-\x0D]*\n"), lambda p: F.contains(p, F.lit("\n")))
    return F.concat(F.split(text, "\n"), paragraphs)


def scored(pairs: Column, templates: dict[str, str], least: float) -> Column:
    """Array of (license, score) of the templates that a set of bigrams is close to."""
    size, found = F.size(pairs), []
    for name, text in sorted(templates.items()):
        own = bigrams_of(text)
        # 2 * min(a, b) / (a + b) >= least
        low, high = len(own) * least / (2 - least), len(own) * (2 - least) / least
        shared = F.size(F.array_intersect(pairs, F.array(*map(F.lit, own))))
        score = F.lit(2.0) * shared / (size + len(own))
        found.append(F.when((size >= low) & (size <= high), F.struct(F.lit(name).alias("license"), score.alias("score"))))
    return F.filter(F.array_compact(F.array(*found)), lambda f: f["score"] >= least)


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """doc_id and licenses, an array of (license, units, score), for every row of ``docs``.

    ``units`` counts the lines and paragraphs close to the template, ``score`` is the best; sorted by name. Null and
    empty texts, and texts without a word pair, have none; repeated rows each have their own result.
    """
    rows = docs.select(F.monotonically_increasing_id().alias(ROW), "doc_id", text_of().alias("text"))
    each = rows.select(ROW, "doc_id", F.explode(units(F.col("text"))).alias("unit"))
    pairs = each.select(ROW, "doc_id", bigrams(F.col("unit")).alias("pairs"))
    hits = pairs.select(ROW, "doc_id", F.explode_outer(scored(F.col("pairs"), templates, least)).alias("hit"))
    by_name = hits.groupBy(ROW, "doc_id", "hit.license").agg(F.count("*").alias("units"), F.max("hit.score").alias("score"))
    one = F.when(F.col("license").isNotNull(), F.struct("license", "units", "score"))
    return by_name.groupBy(ROW, "doc_id").agg(F.sort_array(F.collect_list(one)).alias("licenses")).drop(ROW)


def bounds(own: list[str], least: float = LEAST) -> tuple[int, int]:
    """The fewest bigrams that a text must share with a template, and the most that it may have."""
    # 2 * shared / (a + b) >= least, where shared <= a and shared <= b
    return math.ceil(len(own) * least / (2 - least) - 1e-9), math.floor(len(own) * (2 - least) / least + 1e-9)


def in_texts(docs: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """doc_id and licenses, an array of (license, score), for every row of ``docs``: whole texts, wherever lines end.

    A template is found where some run of words is close to it, in one line, over several paragraphs or inside a
    sentence. The score is that of the best run; runs begin and end with bigrams of the template, as any other is no
    better without its ends. Sorted by name. Null and empty texts, and texts without a word pair, have none; repeated
    rows each have their own result; no rows give no rows.
    """
    listed, known = [], {}
    for name, text in sorted(templates.items()):
        own = bigrams_of(text)
        known |= dict.fromkeys(own)
        fewest, longest = bounds(own, least)
        listed.append(F.struct(F.lit(name).alias("license"), F.array(*map(F.lit, own)).alias("own"),
                               F.lit(fewest).alias("fewest"), F.lit(longest).alias("longest")))
    rows = docs.select(F.monotonically_increasing_id().alias(ROW), "doc_id", bigrams_in_order(text_of()).alias("pairs"))
    # one look at a text tells which bigrams of any template it has; few texts have enough of one template
    rows = rows.withColumn("shared", F.array_intersect("pairs", F.array(*map(F.lit, known))))
    close = F.filter(F.array(*listed), lambda t: F.size(F.array_intersect("shared", t["own"])) >= t["fewest"])
    close = F.when(F.size("shared") >= min(bounds(bigrams_of(t), least)[0] for t in templates.values()), close)
    rows = rows.withColumn("t", F.explode_outer(close))
    hits = F.filter(F.sequence(F.lit(0), F.size("pairs") - 1), lambda i: F.array_contains("t.own", F.get("pairs", i)))
    rows = rows.select(ROW, "doc_id", F.col("t.license").alias("license"), F.col("t.own").alias("own"), F.col("t.fewest").alias("fewest"),
                       F.col("t.longest").alias("longest"), "pairs", F.when(F.col("t").isNotNull(), hits).alias("at"))

    def span(k: Column, j: Column) -> Column:
        return F.get("at", j) - F.get("at", k) + 1

    def score(k: Column, j: Column) -> Column:
        run = F.array_distinct(F.slice("pairs", F.get("at", k) + 1, span(k, j)))
        return F.lit(2.0) * F.size(F.array_intersect(run, F.col("own"))) / (F.size(run) + F.size("own"))

    def best_from(k: Column) -> Column:
        # hits are places of the text, so there are no more than the longest run has
        last = F.least(F.size("at"), k + F.col("longest")) - 1
        ends = F.filter(F.sequence(k + F.col("fewest") - 1, last), lambda j: span(k, j) <= F.col("longest"))
        return F.aggregate(ends, F.lit(0.0), lambda best, j: F.greatest(best, score(k, j)))

    starts = F.filter(F.sequence(F.lit(0), F.size("at") - F.col("fewest")),
                      lambda k: span(k, k + F.col("fewest") - 1) <= F.col("longest"))
    best = F.aggregate(starts, F.lit(0.0), lambda best, k: F.greatest(best, best_from(k)))
    rows = rows.select(ROW, "doc_id", "license", F.when(F.col("at").isNotNull(), best).alias("score"))
    found = F.when(F.col("score") >= least, F.struct("license", "score"))
    return rows.groupBy(ROW, "doc_id").agg(F.sort_array(F.collect_list(found)).alias("licenses")).drop(ROW)


def passages(docs: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """doc_id, license and score: a row for each license that ``in_texts`` finds in a row of ``docs``, none without."""
    return in_texts(docs, templates, least).select("doc_id", F.inline("licenses"))

"""Licence scans: units of a text against licence templates by the Dice coefficient of word bigrams.

Units are the lines of a text, its paragraphs of several lines, and the whole
text. A unit of n bigrams can reach a coefficient t with a template of m only if
t / (2 - t) <= n / m <= (2 - t) / t, so word counts prune most pairs before any
bigram is built. All steps are built-in expressions.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.shared import only

THRESHOLD = 0.8
# Notices and texts of public licences.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "MIT": [
        "Released under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "proprietary": ["All rights reserved."],
}
WORD = r"[a-z0-9]+"


def _plain(text: Column) -> Column:
    """Lower case, British spelling as American."""
    return F.replace(F.lower(text), F.lit("licence"), F.lit("license"))


def _bigrams(unit: Column) -> Column:
    """Bigrams of the words of ASCII letters and digits, as 64-bit hashes."""
    words = F.regexp_extract_all(unit, F.lit(WORD), F.lit(0))
    return F.transform(F.array(words), lambda w: F.transform(F.slice(w, 1, F.size(w) - 1), lambda x, i: F.xxhash64(x, F.get(w, i + 1))))[0]


def _template_table(templates: dict[str, list[str]]) -> tuple[Column, list[int]]:
    """All templates as one constant array of (name, bigrams with their counts, n), and their sizes."""
    rows = []
    for name, texts in templates.items():
        for text in texts:
            words = re.findall(WORD, text.lower().replace("licence", "license"))
            grams = Counter(zip(words, words[1:]))
            if grams:
                rows.append((name, grams))
    table = F.array(*(
        F.struct(
            F.lit(name).alias("name"), F.array(*(F.xxhash64(F.lit(a), F.lit(b)) for a, b in grams)).alias("bigrams"),
            F.array(*map(F.lit, grams.values())).alias("counts"), F.lit(grams.total()).alias("n"),
        ) for name, grams in rows
    ))
    return table, [g.total() for _, g in rows]


def license_matches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, matches: array of (dice, name), best first.

    Every distinct unit is matched with its best template at or above
    ``threshold``; ties go to the last name. Bigrams count as often as they
    occur. Null and empty texts have no matches; texts of any length are cut into
    units whole, and a notice that shares its line and paragraph with other words
    may be lost; null ids are carried along;
    repeated rows get equal results; an empty table gives none; other columns
    are ignored.
    """
    table, sizes = _template_table(templates or TEMPLATES)
    ratio = (2 - threshold) / threshold
    least, most = min(sizes) / ratio, max(sizes) * ratio
    d = only(docs, doc_id=doc_id, text=text).withColumn("text", _plain(F.coalesce("text", F.lit(""))))
    lines, parts = F.split("text", "\n"), F.filter(F.split("text", r"\n[ \t]*\n"), lambda p: p.contains("\n"))
    whole = F.when(F.contains("text", F.lit("\n")), F.array("text")).otherwise(F.array().cast("array<string>"))
    # n bigrams are n + 1 words: most units are out of every template's bounds and never cut into bigrams
    fits = lambda u: (F.length(u) >= 2 * least) & (F.regexp_count(u, F.lit(WORD)) - 1).between(least, most)
    units = F.array_distinct(F.concat(*(F.filter(u, fits) for u in (lines, parts, whole))))
    d = d.select("doc_id", F.transform(units, _bigrams).alias("grams"))

    def overlap(b: Column, t: Column) -> Column:
        """Common bigrams, each as often as both have it."""
        common = F.transform(t["bigrams"], lambda g, i: F.least(F.get(t["counts"], i), F.size(F.filter(b, lambda x: x == g))))
        return F.when(F.arrays_overlap(b, t["bigrams"]), F.aggregate(common, F.lit(0), lambda n, x: n + x)).otherwise(0)

    def best(b: Column) -> Column:
        n = F.size(b)
        near = F.filter(table, lambda t: (n >= t["n"] / ratio) & (n <= t["n"] * ratio))
        scored = F.transform(near, lambda t: F.struct((2.0 * overlap(b, t) / (n + t["n"])).alias("dice"), t["name"].alias("name")))
        return F.array_max(F.filter(scored, lambda s: s["dice"] >= threshold))

    found = F.filter(F.transform("grams", best), lambda s: s.isNotNull())
    return d.select("doc_id", F.sort_array(found, asc=False).alias("matches"))

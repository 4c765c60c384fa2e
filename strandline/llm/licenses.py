"""License scans: blocks and word windows of text compared to license notices by shared word bigrams.

A block is a line, a paragraph or the whole text; a window is any run of as many consecutive
words of the text as the template has. The Dice coefficient of two bigram sets of sizes a and b
is at most 2 * min(a, b) / (a + b). So for a threshold only blocks whose size is close to a
template's are compared with it at all, and only windows that hold enough of its bigrams.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Notices as their publishers word them.
TEMPLATES = {
    "agpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Affero General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."
    ),
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "apache-2.0-warranty": (
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions "
        "and limitations under the License."
    ),
    "bsd-2-clause": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions "
        "and the following disclaimer. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution."
    ),
    "bsd-3-clause": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission."
    ),
    "bsd-notice": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:"
    ),
    "bsd-warranty": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
        "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
    ),
    "bsl-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of "
        "the software and accompanying documentation covered by this license (the \"Software\") to use, "
        "reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative "
        "works of the Software, and to permit third-parties to whom the Software is furnished to do so"
    ),
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    ),
    "cc0-1.0": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and "
        "neighboring rights to this software to the public domain worldwide. This software is distributed "
        "without any warranty."
    ),
    "gpl-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation; either version "
        "2 of the License, or (at your option) any later version."
    ),
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version."
    ),
    "gpl-warranty": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "General Public License for more details."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        "in all copies."
    ),
    "lgpl-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the "
        "GNU Lesser General Public License as published by the Free Software Foundation; either version "
        "2.1 of the License, or (at your option) any later version."
    ),
    "mit": "Released under the MIT License.",
    "mit-condition": (
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "mit-header": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions:"
    ),
    "mit-licensed": "Licensed under the MIT License.",
    "mit-warranty": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
        "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
        "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
        "the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
        "modify, publish, use, compile, sell, or distribute this software, either in source code form or as "
        "a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the "
        "authors be held liable for any damages arising from the use of this software. Permission is "
        "granted to anyone to use this software for any purpose, including commercial applications, and to "
        "alter it and redistribute it freely, subject to the following restrictions:"
    ),
}
THRESHOLD = 0.8


def template_words(text: str) -> list[str]:
    """Words of a normalised template."""
    return re.sub("[^a-z0-9]+", " ", text.lower()).split()


def template_bigrams(text: str) -> list[str]:
    """Distinct bigrams of a normalised template."""
    words = template_words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def size_bounds(size: int, threshold: float) -> tuple[float, float]:
    """Bigram counts between which a block can reach the threshold with a template.

    A little wider than exact, so that rounding excludes nothing.
    """
    ratio = threshold / (2 - threshold)
    return size * ratio * (1 - 1e-9), size / ratio * (1 + 1e-9)


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def array_of(grams: list[str]) -> str:
    """SQL of an array of bigrams, which Spark splits once while it plans."""
    return f"split({quoted('|'.join(grams))}, '[|]')"


def fewest_shared(size: int, threshold: float) -> int:
    """Bigrams of a template of ``size`` that any window reaching the threshold holds.

    2i / (a + b) >= t and a >= i give i >= b * t / (2 - t).
    """
    return max(1, math.ceil(size_bounds(size, threshold)[0]))


def rare_bigrams(grams: list[str], threshold: float) -> list[str]:
    """So many of a template's bigrams that a window without any of them misses the threshold.

    The longest are taken, since long words are rare in other texts.
    """
    if not grams:
        return []
    return sorted(grams, key=lambda g: (-len(g), g))[: len(grams) - fewest_shared(len(grams), threshold) + 1]


def table_of(templates: Mapping[str, str], threshold: float) -> Column:
    """Templates of at least one bigram as an array of structs, which Spark folds to a literal."""
    rows = []
    for name, text in templates.items():
        if grams := template_bigrams(text):
            low, high = size_bounds(len(grams), threshold)
            rows.append(
                f"named_struct('license', {quoted(name)}, 'grams', {array_of(grams)}, 'size', {len(grams)}, "
                f"'length', {len(template_words(text)) - 1}, 'needed', {fewest_shared(len(grams), threshold)}, "
                f"'low', {low!r}D, 'high', {high!r}D)"
            )
    return F.expr(f"array({', '.join(rows)})")


def dice_of(grams: Column, template: Column) -> Column:
    shared = F.size(F.array_intersect(grams, template["grams"]))
    return 2.0 * shared / (F.size(grams) + template["size"])


def starts_of_windows(places: Column, n_grams: Column, template: Column) -> Column:
    """Starts of windows of the template's length that hold enough of the sorted ``places``."""
    needed, length = template["needed"], template["length"]
    nowhere = F.array().cast("array<int>")

    def around(i: Column) -> Column:
        first, last = F.get(places, i), F.get(places, i + needed - 1)
        return F.when(
            last - first < length, F.sequence(F.greatest(last - length + 1, F.lit(0)), F.least(first, n_grams - length))
        ).otherwise(nowhere)

    starts = F.flatten(F.transform(F.sequence(F.lit(0), F.size(places) - needed), around))
    enough = (F.size(places) >= needed) & (n_grams >= length)
    return F.when(enough, F.array_sort(F.array_distinct(starts))).otherwise(nowhere)


def windows_found(templates: Column, threshold: float) -> Column:
    """Per template its places among the bigrams ``b``: windows that reach the threshold, runs of them counted once.

    ``seen`` are the places in ``b`` of bigrams of any template, with the bigram.
    """

    def named(value: Column, use) -> Column:
        return F.get(F.transform(F.array(value), use), F.lit(0))  # computed once

    def found(template: Column) -> Column:
        own = F.filter("seen", lambda x: F.array_contains(template["grams"], x["gram"]))

        def window(start: Column) -> Column:
            grams = F.array_distinct(F.slice("b", start + 1, template["length"]))
            return F.struct(start.alias("at"), dice_of(grams, template).alias("dice"))

        def reaching(places: Column) -> Column:
            starts = starts_of_windows(places, F.size("b"), template)
            return F.filter(F.transform(starts, window), lambda x: x["dice"] >= threshold)

        def counted(hits: Column) -> Column:
            fresh = F.filter(
                hits, lambda x, i: F.when(i == 0, F.lit(True)).otherwise(x["at"] - F.get(hits, i - 1)["at"] > 1)
            )
            return F.struct(
                template["license"].alias("license"), F.size(fresh).cast("long").alias("n_places"),
                F.array_max(F.transform(hits, lambda x: x["dice"])).alias("dice"),
            )

        return named(named(F.transform(own, lambda x: x["at"]), reaching), counted)

    return F.filter(F.transform(templates, found), lambda x: x["n_places"] > 0)


def scan(
    df: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(doc_id, license, n_blocks, n_places, dice): which notices a document carries.

    ``n_blocks`` counts the document's different blocks that reach the threshold, ``n_places``
    the places where windows of the template's length do (windows that start at consecutive
    words are one place, and so are copies in a row), and ``dice`` is the highest of all their coefficients. So a notice is
    found inside a longer line or comment, and a shortened one as a block of its own.
    Templates that resemble each other are all reported; the coefficients tell which is meant.

    Normalised text is in lower case with one blank for every run of other characters than a-z
    and 0-9. Blocks of fewer than two words match nothing, so null and empty texts give no rows,
    and neither does an empty table. Rows that share a doc_id are reported together, also those
    with none; equal blocks in different rows count once for each row. Other columns are not read.
    """
    sets = [template_bigrams(x) for x in templates.values()]
    if not any(sets):
        raise ValueError("no template has two words")
    known = table_of(templates, threshold)
    t = F.col(text).cast("string")
    blocks = F.array_distinct(F.concat(F.array(t), F.split(t, "\n"), F.split(t, r"\n[ \t\r]*\n")))
    words = F.split(F.btrim(F.regexp_replace(F.lower("block"), "[^a-z0-9]+", " ")), " ")
    # no filter on w or g: Spark would push it down and compute both once more
    rows = df.select(F.col(doc_id).alias("doc_id"), F.posexplode(blocks).alias("nth", "block")).select(
        "doc_id", "nth", words.alias("w")
    )
    grams = F.transform(
        F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))), lambda x, i: F.concat(x, F.lit(" "), F.get(F.col("w"), i + 1))
    )
    sized = rows.select("doc_id", "nth", grams.alias("b")).select("doc_id", "nth", "b", F.array_distinct("b").alias("g"))

    close = F.filter(known, lambda x: F.size("g").between(x["low"], x["high"]))
    compared = F.transform(
        close,
        lambda x: F.struct(x["license"].alias("license"), F.lit(0).cast("long").alias("n_places"), dice_of(F.col("g"), x).alias("dice")),
    )
    hits = F.filter(compared, lambda x: x["dice"] >= threshold)

    rare = F.expr(array_of(list(dict.fromkeys(x for g in sets for x in rare_bigrams(g, threshold)))))
    every = ", ".join(quoted(x) for x in dict.fromkeys(x for g in sets for x in g))
    seen = F.expr(f"filter(transform(b, (x, i) -> struct(i AS at, x AS gram)), x -> x.gram IN ({every}))")
    # the first block is the whole text
    scanned = F.when((F.col("nth") == 0) & F.arrays_overlap("g", rare), seen)
    marked = sized.select("doc_id", "b", hits.alias("hits"), scanned.alias("seen"))
    nothing = F.array().cast("array<struct<license:string,n_places:bigint,dice:double>>")
    inside = F.when(F.col("seen").isNotNull(), windows_found(known, threshold)).otherwise(nothing)
    return (
        marked.select("doc_id", F.inline(F.concat("hits", inside)))
        .groupBy("doc_id", "license")
        .agg(
            F.count_if(F.col("n_places") == 0).alias("n_blocks"),
            F.sum("n_places").alias("n_places"),
            F.max("dice").alias("dice"),
        )
    )

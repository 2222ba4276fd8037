"""License scans: MinHash bands over text windows, then exact containment.

Words are runs of letters and digits of the lower-cased text, shingles are five
words in a row.  Windows of 1, 4 and 16 shingles overlap by half.  A template of
``m`` shingles uses the largest window size ``s`` with ``m >= s + s/2``, so every
full occurrence of it holds a whole window of the text, whatever its place; of
the template itself all windows of that size are indexed, one for each place.  So
a window of the text inside an unchanged occurrence equals one of the template's
windows and always collides.  If single words are changed, a window with Jaccard
similarity ``j`` collides in one of ``BANDS`` bands of one row each, every band
with a hash function of its own, with probability ``1 - (1 - j) ** BANDS``
(``collision_probability``: 0.9961 for j = 0.75, 0.9375 for 0.5), and each
occurrence holds several windows.  Windows of one shingle look the shingle itself
up.  A template of fewer than five words (an identifier line) is looked up by its
whole word sequence, and found where the text has exactly these words in a row.

Every other hit is verified exactly: of the template's distinct shingles, the
share found around the hit (a template's length to each side) must reach
``CONTAINMENT``.

Templates are (name, text) rows: a list, or a DataFrame of any size (``read_templates``
makes one of a folder of license texts).  A list of up to ``PLAN_WORDS`` words travels
inside the plan (``scan``): no row leaves its task before it is a match.  Larger
lists, and DataFrames, stay tables (``scan_table``), with equal results: window values
that pass a bitmap of fixed size are joined to the table of the templates' values,
and the few texts with hits meet their templates' shingles by joins on keys.

NULL and empty texts match nothing; templates without words are left out.  Texts
of any length are scanned whole.  Repeated rows give one result per (doc_id,
license), and rows of equal or NULL ids share one; an empty table gives none.
Further columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poststream.llm.tables import stored

SHINGLE = 5
CONTAINMENT = 0.8
SIZES = (1, 4, 16)
BANDS = 4
PLAN_WORDS = 5_000
SIEVE_BITS = 1 << 20

# fixed values: identifiers of short lines (SPDX-License-Identifier: <id>)
IDENTIFIERS = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause",
    "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "CDDL-1.0",
    "EPL-2.0", "EUPL-1.2", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later",
    "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT",
    "MPL-2.0", "Unlicense", "WTFPL", "Zlib")

# fixed values: public notices, name and wording
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
     "this file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
     "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
     "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
     "specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files (the \"Software\"), to deal in the Software "
     "without restriction, including without limitation the rights to use, copy, modify, merge, "
     "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
     "whom the Software is furnished to do so, subject to the following conditions:"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met:"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3"),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms "
     "of the GNU General Public License as published by the Free Software Foundation, either version "
     "3 of the License, or (at your option) any later version."),
    ("LGPL", "Licensed under the GNU Lesser General Public License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
     "If a copy of the MPL was not distributed with this file, You can obtain one at "
     "http://mozilla.org/MPL/2.0/."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International "
     "License"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
     "International License"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
     "without fee is hereby granted, provided that the above copyright notice and this permission "
     "notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or "
     "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
     "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
     "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
     "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
     "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
     "OR OTHER DEALINGS IN THE SOFTWARE."),
    ("BSD", "Redistributions of source code must retain the above copyright notice, this list of "
     "conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
     "copyright notice, this list of conditions and the following disclaimer in the documentation "
     "and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be "
     "used to endorse or promote products derived from this software without specific prior written "
     "permission."),
    ("ISC", "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO "
     "THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL "
     "THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
     "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
     "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE "
     "OF THIS SOFTWARE."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event "
     "will the authors be held liable for any damages arising from the use of this software. "
     "Permission is granted to anyone to use this software for any purpose, including commercial "
     "applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a "
     "copy of the software and accompanying documentation covered by this license (the \"Software\") to "
     "use, reproduce, display, distribute, execute, and transmit the Software, and to prepare "
     "derivative works of the Software, and to permit third-parties to whom the Software is furnished "
     "to do so, all subject to the following:"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this "
     "software, either in source code form or as a compiled binary, for any purpose, commercial or "
     "non-commercial, and by any means."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms "
     "of the GNU General Public License as published by the Free Software Foundation; either version "
     "2 of the License, or (at your option) any later version."),
    ("GPL", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
     "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
     "GNU General Public License for more details."),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of "
     "the GNU Lesser General Public License as published by the Free Software Foundation; either "
     "version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms "
     "of the GNU Affero General Public License as published by the Free Software Foundation, either "
     "version 3 of the License, or (at your option) any later version."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the "
     "Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("CDDL-1.0", "The contents of this file are subject to the terms of the Common Development and "
     "Distribution License (the \"License\"). You may not use this file except in compliance with the "
     "License."),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related "
     "and neighboring rights to this software to the public domain worldwide. This software is "
     "distributed without any warranty."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
     "International License"),
    ("WTFPL", "Do What The Fuck You Want To Public License"),
] + [(i, f"SPDX-License-Identifier: {i}") for i in IDENTIFIERS]


def collision_probability(similarity: float, bands: int = BANDS, windows: int = 1) -> float:
    """That one of ``windows`` windows shares at least one band."""
    return 1 - (1 - similarity) ** (bands * windows)


def words_of(templates: list[tuple[str, str]]) -> int:
    """About how many words a list has."""
    return sum(len(re.findall(r"\w+", text)) for _, text in templates)


def read_templates(spark: SparkSession, folder: str) -> DataFrame:
    """(name, text) of a folder of license texts: the name is the file's, without
    its ending; blank files give no template."""
    files = spark.read.text(folder, wholetext=True).select(
        F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.txt|\.md)?$", 1).alias("name"),
        F.col("value").alias("text"))
    return files.where(F.col("text").rlike(r"[\p{L}\p{N}]"))


def with_shingles(df: DataFrame, text: str, out: str, words: str | None = None) -> DataFrame:
    """Add ``out``: hashes of the five-word shingles of ``text``, in order, and, if
    asked for, ``words``: the hashes of its words."""
    t = words or f"_{out}_words"
    parts = ", ".join(f"get({t}, i + {j})" for j in range(SHINGLE))
    # words stop at letters of any script, so that é does not cut a word in two
    df = df.withColumn(t, F.expr(
        f"transform(regexp_extract_all(lower({text}), r'[\\p{{L}}\\p{{N}}]+', 0), x -> xxhash64(x))"))
    df = df.withColumn(out, F.expr(
        f"if(coalesce(size({t}), 0) < {SHINGLE}, cast(array() as array<bigint>), "
        f"transform(sequence(0, size({t}) - {SHINGLE}), i -> xxhash64({parts})))"))
    return df if words else df.drop(t)


def _sequences(words: str, length: int) -> str:
    """Hashes of all runs of ``length`` words (below a shingle's)."""
    parts = ", ".join(f"get({words}, i + {j})" for j in range(length))
    return (f"if(coalesce(size({words}), 0) < {length}, cast(array() as array<bigint>), "
            f"transform(sequence(0, size({words}) - {length}), i -> xxhash64({length}, {parts})))")


def _orders(df: DataFrame, array: str, sizes) -> DataFrame:
    """Add ``o_b``: the shingles under the hash function of each band ``b``."""
    if all(size == 1 for size in sizes):
        return df
    return df.withColumns({f"o_{band}": F.expr(f"transform({array}, x -> xxhash64({band}, x))")
                           for band in range(BANDS)})


def _minima(array: str, size: int, step: int, band: int) -> str:
    """Least hash of a band in each window of ``size`` shingles."""
    if size == 1:
        return array
    # the band's column is bound once: a lambda would evaluate it for each window
    return (f"if(size({array}) = 0, cast(array() as array<bigint>), get(transform(array(o_{band}), "
            f"o -> transform(sequence(0, greatest(size({array}) - {size}, 0), {step}), "
            f"k -> array_min(slice(o, k + 1, {size})))), 0))")


def _kinds(sizes) -> list[tuple[int, int]]:
    """(window size, band) of each lookup; a window of one shingle needs one band."""
    return [(s, b) for s in sorted(sizes) for b in range(BANDS if s > 1 else 1)]


WINDOW_OF = "case " + " ".join(
    f"when size(sh) >= {s + s // 2} then {s}" for s in sorted(SIZES, reverse=True) if s > 1) \
    + " when size(sh) > 0 then 1 else 0 end"


def template_rows(templates: DataFrame) -> DataFrame:
    """(template, name, sh, size, length, sequence): distinct shingles in ``own`` and
    the window size; shorter ones have size 0 and the hash of their word sequence."""
    t = templates.select("name", "text").distinct().withColumn(
        "template", F.xxhash64(F.lit("template"), "name", "text"))
    t = with_shingles(t, "text", "sh", "w").where("size(w) > 0")
    whole = "case " + " ".join(
        f"when size(w) = {n} then {_sequences('w', n)}[0]" for n in range(1, SHINGLE)) + " end"
    return t.select("template", "name", "sh", F.expr("array_distinct(sh)").alias("own"),
                    F.expr(WINDOW_OF).alias("size"), F.size("w").alias("length"),
                    F.expr(whole).alias("sequence"))


def template_values(rows: DataFrame) -> DataFrame:
    """(size, band, value, template): every value by which a template is looked up;
    word sequences have minus their length as size."""
    sequences = rows.where("size = 0").select((-F.col("length")).alias("size"), F.lit(0).alias("band"),
                                              F.col("sequence").alias("value"), "template")
    wide = _orders(rows, "sh", SIZES)
    each = F.array(*[F.struct(F.lit(s).alias("size"), F.lit(b).alias("band"),
                              F.expr(_minima("sh", s, 1, b)).alias("values")) for s, b in _kinds(SIZES)])
    found = (wide.withColumn("each", F.filter(each, lambda e: e["size"] == F.col("size")))
             .select("template", F.explode("each").alias("e"))
             .select("e.size", "e.band", F.explode("e.values").alias("value"), "template"))
    return sequences.unionByName(found).distinct()


def _long(v: int) -> str:
    return f"{v}L" if v > -(1 << 63) else f"({v + 1}L - 1L)"


def _longs(values) -> str:
    return "array(" + ", ".join(map(_long, values)) + ")" if values else "cast(array() as array<bigint>)"


def _texts(docs: DataFrame) -> DataFrame:
    return with_shingles(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
                         "text", "sh", "w")


def _step(size: int) -> int:
    return max(1, size // 2)


def _around(at: str, m: str) -> str:
    """The shingles within a template's length of a hit."""
    return f"slice(sh, greatest({at} - {m}, 0) + 1, 2 * {m} + {max(SIZES)})"


def _licenses(found: DataFrame) -> DataFrame:
    return (found.where(f"containment >= {CONTAINMENT}").groupBy("doc_id", "license")
            .agg(F.max("containment").alias("containment"),
                 F.min("at").cast("long").alias("first_word"),
                 F.countDistinct("at").alias("places")))


def scan(docs: DataFrame, templates: list[tuple[str, str]] | DataFrame | None = None) -> DataFrame:
    """(doc_id, license, containment, first_word, places): the licenses that
    each document names, the best containment, the word with which the first
    matching window begins and the number of matching windows."""
    spark = docs.sparkSession
    if templates is None:
        templates = TEMPLATES
    if isinstance(templates, DataFrame):
        return scan_table(docs, templates)
    table = spark.createDataFrame(templates, "name string, text string")
    if words_of(templates) > PLAN_WORDS:
        return scan_table(docs, table)
    # a list of at most PLAN_WORDS words
    rows = template_rows(table).select("template", "name", "own", "size").orderBy("template").collect()
    number = {r["template"]: i for i, r in enumerate(rows)}
    values: dict[tuple[int, int], dict[int, list[int]]] = {}
    for v in template_values(template_rows(table)).collect():
        values.setdefault((v["size"], v["band"]), {}).setdefault(v["value"], []).append(
            number[v["template"]])
    df = _orders(_texts(docs), "sh", [s for s, _ in values if s > 0])
    hits = []
    for (size, band), found in sorted(values.items()):
        name = f"{abs(size)}_{band}" if size > 0 else f"s{-size}"
        step, minima, hit = _step(size), f"m_{name}", f"h_{name}"
        known = _longs(sorted(found))
        df = df.withColumn(minima, F.expr(
            _minima("sh", size, step, band) if size > 0 else _sequences("w", -size)))
        # most texts share no value with the templates and stop here
        df = df.withColumn(minima, F.expr(
            f"if(arrays_overlap({minima}, {known}), {minima}, cast(array() as array<bigint>))"))
        owners = "array(" + ", ".join(
            f"named_struct('v', {_long(v)}, 't', {t})" for v, ts in sorted(found.items())
            for t in sorted(ts)) + ")"
        df = df.withColumn(hit, F.expr(
            f"flatten(transform({minima}, (x, k) -> if(array_contains({known}, x), "
            f"transform(filter({owners}, p -> p.v = x), "
            f"p -> struct(p.t as template, cast(k * {step} as int) as at)), "
            f"cast(array() as array<struct<template: int, at: int>>))))")).drop(minima)
        hits.append(hit)
    if not hits:
        return _licenses(df.select("doc_id", F.lit("").alias("license"), F.lit(0.0).alias("containment"),
                                   F.lit(0).alias("at")).where("false"))
    wanted = "array(" + ", ".join(_longs(sorted(r["own"])) for r in rows) + ")"
    df = df.withColumn("hits", F.expr(f"array_distinct(concat({', '.join(hits)}))"))
    # outer: a filter below the generator would repeat all of the above in it
    found = df.select("doc_id", "sh", F.explode_outer("hits").alias("hit")).where("hit is not null")
    found = found.withColumn("m", F.expr(f"size(get({wanted}, hit.template))"))
    found = found.withColumn("containment", F.expr(
        f"if(m = 0, 1D, size(array_intersect({_around('hit.at', 'm')}, get({wanted}, hit.template))) / m)"))
    names = F.array(*[F.lit(r["name"]) for r in rows])
    return _licenses(found.withColumn("license", F.get(names, F.col("hit.template")))
                     .withColumn("at", F.col("hit.at")))


def _sieve(values: DataFrame) -> str:
    """A bitmap over the last bits of the values, as a literal of ``SIEVE_BITS``
    bits, whatever the number of templates."""
    found = (values.select(F.expr(f"value & {SIEVE_BITS - 1}L").alias("bit"))
             .groupBy(F.expr("cast(shiftright(bit, 6) as int)").alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("bits")).collect())
    bits = [0] * (SIEVE_BITS // 64)
    for r in found:
        bits[r["word"]] = r["bits"]
    return _longs(bits)


def scan_table(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """``scan`` with the templates as a table of (name, text) rows of any size.

    Windows that pass the sieve are joined to the templates' values by equality;
    those rows are narrow.  Texts with hits are read again, and meet their hits by
    id and hash of the text, and each template's shingles by its number.
    """
    rows = stored(template_rows(templates), "license-templates")
    values = stored(template_values(rows), "license-values")
    sizes = [r[0] for r in values.select("size").distinct().collect()]   # at most seven
    wide = [s for s in sizes if s > 0]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null") \
        .withColumn("h", F.xxhash64("text"))
    df = _orders(with_shingles(texts, "text", "sh", "w").drop("text"), "sh", wide)
    lists = []
    for size, band in _kinds(wide) + [(s, 0) for s in sorted(sizes) if s < 0]:
        found = _minima("sh", size, _step(size), band) if size > 0 else _sequences("w", -size)
        lists.append(f"transform({found}, (x, k) -> named_struct('size', {size}, 'band', {band}, "
                     f"'value', x, 'at', cast(k * {_step(size)} as int)))")
    if not lists:   # no template has a word
        lists = ["cast(array() as array<struct<size: int, band: int, value: bigint, at: int>>)"]
    bit = f"(x.value & {SIEVE_BITS - 1}L)"
    passes = f"getbit(get({_sieve(values)}, cast(shiftright({bit}, 6) as int)), cast({bit} & 63 as int)) = 1"
    windows = df.select("doc_id", "h", F.explode(F.expr(
        f"filter(flatten(array({', '.join(lists)})), x -> {passes})")).alias("x")).select("doc_id", "h", "x.*")
    hits = stored(windows.join(values, ["size", "band", "value"])
                  .groupBy("doc_id", "h", "template").agg(F.collect_set("at").alias("at")), "license-hits")
    same = F.expr("a.doc_id <=> b.doc_id and a.h = b.h")
    read = with_shingles(texts.alias("a").join(hits.alias("b"), same, "left_semi"), "text", "sh") \
        .select("doc_id", "h", "sh")
    found = (read.alias("a").join(hits.alias("b"), same).select("a.doc_id", "a.sh", "b.template", "b.at")
             .join(rows.select("template", F.col("name").alias("license"), "own"), "template")
             .withColumn("m", F.size("own")))
    checked = F.expr(
        f"transform(at, p -> struct(p as at, if(m = 0, 1D, "
        f"size(array_intersect({_around('p', 'm')}, own)) / m) as containment))")
    return _licenses(found.select("doc_id", "license", F.explode(checked).alias("c"))
                     .select("doc_id", "license", "c.*"))

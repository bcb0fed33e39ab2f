"""License notices in texts: MinHash bands over overlapping windows retrieve templates, shared shingles confirm them.

Only DataFrame functions; no Python runs on the data.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
BANDS, ROWS = 32, 2

# The wording of public license notices.
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution. "
)
_BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS "
    "BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
TEMPLATES = {
    "agpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that "
        "it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
        "See the GNU Affero General Public License for more details."
    ),
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "bsd-2-clause": _BSD_HEAD + _BSD_TAIL,
    "bsd-3-clause": (
        _BSD_HEAD + "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission. " + _BSD_TAIL
    ),
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that "
        "it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
        "See the GNU General Public License for more details."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD "
        "TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE "
        "OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "lgpl-3.0-notice": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This library is distributed in the hope that "
        "it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
        "See the GNU Lesser General Public License for more details."
    ),
    "mit": "Released under the MIT License.",
    "mit-notice": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
        "You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute "
        "this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
}


def words_of(text: str) -> list[str]:
    """A-Z in lower case; words are runs of a-z and 0-9."""
    return re.findall("[a-z0-9]+", text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)))


def window_of(n_words: int) -> tuple[int, int]:
    """(step, width) of the windows for a template of n_words: each run of that many words lies in a window whole."""
    step = max(1, n_words // 8)
    return step, n_words + step - 1


def shingles_of(words: list[str]) -> set[str]:
    return {" ".join(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)}


def anchors(templates: dict[str, str], percent: int) -> list[str]:
    """Words of which a text has one if it holds `percent` of a template's shingles: more shingles have one than may be missing."""
    chosen: set[str] = set()
    for text in templates.values():
        shingles = shingles_of(words_of(text))
        if not shingles:
            continue
        spare = len(shingles) - -(-percent * len(shingles) // 100)
        while sum(any(w in chosen for w in s.split()) for s in shingles) <= spare:
            open_ = [s for s in shingles if not any(w in chosen for w in s.split())]
            words = {w for s in open_ for w in s.split()}
            chosen.add(max(words, key=lambda w: (len(w) >= 5, sum(w in s.split() for s in open_), len(w), w)))
    return sorted(chosen)


def _bands(hashes: Column) -> Column:
    """Band keys of a set of shingle hashes: the least of each of BANDS * ROWS hash functions, ROWS to a key."""
    seeds = F.sequence(F.lit(1), F.lit(BANDS * ROWS))
    signature = F.transform(seeds, lambda s: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, s))))
    return F.transform(F.sequence(F.lit(1), F.lit(BANDS)), lambda b: F.xxhash64(b, F.slice(signature, (b - 1) * ROWS + 1, ROWS)))


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(license, n_words, step, width, hashes): one row a template; their number bounds what is broadcast."""
    rows = []
    for name, text in templates.items():
        words = words_of(text)
        step, width = window_of(len(words))
        shingles = F.array(*[F.xxhash64(F.lit(s)) for s in sorted(shingles_of(words))])
        rows.append(F.struct(F.lit(name).alias("license"), F.lit(step).alias("step"), F.lit(width).alias("width"), shingles.alias("hashes")))
    return spark.range(1).select(F.inline(F.array(*rows)))


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, license, n_shingles, n_shared, containment, window_start) for each license that a document holds.

    A document holds a template if one of its windows holds `percent` of the template's five-word
    shingles; n_shared is the most that one window holds, window_start the first word of the first such
    window. Windows step an eighth of the template's length and are as much longer, so that a notice lies in
    one whole. A window is the set of its shingles that any template has, as others can't be shared; so it is at 0.6 or
    more of a template that it holds, at which the 32 bands of 2 miss it once in 10**6. Windows without any such shingle are
    not there to be signed; nor are texts without an anchor word. A template of under five words is one shingle of its own
    width, which a text holds whole or not.

    The templates are a parameter, so the tables of them that are broadcast don't grow with the documents. Positions of shingles move,
    never texts. Null text and empty text hold none; results of rows that repeat an id are merged; null ids are one id. Templates need a word.
    """
    templates = templates or TEMPLATES
    short = {name: words for name, text in templates.items() if len(words := words_of(text)) < SHINGLE}
    if not all(short.values()):
        raise ValueError("templates need a word")
    templates = {name: text for name, text in templates.items() if name not in short}
    lower = F.translate(F.col(f"`{text_col}`"), string.ascii_uppercase, string.ascii_lowercase)
    # Whatever lower() makes of other letters can only add texts to look at.
    low = F.lower(F.col(f"`{text_col}`"))
    if not templates:
        return _short_notices(docs, short, id_col, low, lower)
    table = template_table(docs.sparkSession, templates)
    likely = F.lit(False)
    for word in anchors(templates, percent):
        likely = likely | F.contains(F.col("low"), F.lit(word))
    words = docs.select(F.col(f"`{id_col}`").alias("doc_id"), low.alias("low"), F.col(f"`{text_col}`").alias("text")).where(likely)
    words = words.select("doc_id", F.xxhash64("text").alias("mark"), F.regexp_extract_all(F.translate("text", string.ascii_uppercase, string.ascii_lowercase), F.lit("[a-z0-9]+"), F.lit(0)).alias("words"))
    runs = F.transform(F.sequence(F.lit(1), F.size("words") - SHINGLE + 1), lambda i: F.xxhash64(F.concat_ws(" ", F.slice("words", i, SHINGLE))))
    placed = words.where(F.size("words") >= SHINGLE).select("doc_id", "mark", F.posexplode(runs).alias("at", "hit"))
    kinds = table.select(F.explode("hashes").alias("hit"), "step", "width").distinct()
    hits = placed.join(F.broadcast(kinds), "hit")
    first = F.greatest(F.lit(0), F.ceil((F.col("at") - F.col("width") + SHINGLE) / F.col("step")) * F.col("step")).cast("int")
    last = (F.floor(F.col("at") / F.col("step")) * F.col("step")).cast("int")
    starts = hits.select("doc_id", "mark", "hit", "step", "width", F.explode(F.sequence(first, last, F.col("step"))).alias("start"))
    windows = starts.groupBy("doc_id", "mark", "step", "width", "start").agg(F.collect_set("hit").alias("window"))
    signed = windows.select("*", F.explode(_bands(F.col("window"))).alias("band"))
    offered = table.select("license", "step", "width", "hashes", F.explode(_bands(F.col("hashes"))).alias("band"))
    met = signed.join(F.broadcast(offered), ["step", "width", "band"]).select(
        "doc_id", "license", "start", F.size("hashes").alias("n_shingles"), F.size(F.array_intersect("window", "hashes")).alias("n_shared")
    )
    best = met.where(F.col("n_shared") * 100 >= F.col("n_shingles") * percent).groupBy("doc_id", "license", "n_shingles").agg(
        F.max(F.struct("n_shared", (-F.col("start")).alias("back"))).alias("x")
    )
    long_ones = best.select(
        "doc_id", "license", "n_shingles", F.col("x.n_shared").alias("n_shared"), (F.col("x.n_shared") / F.col("n_shingles")).alias("containment"), (-F.col("x.back")).alias("window_start")
    )
    return long_ones.unionByName(_short_notices(docs, short, id_col, low, lower)) if short else long_ones


def _short_notices(docs: DataFrame, short: dict[str, list[str]], id_col: str, low: Column, lower: Column) -> DataFrame:
    """The rows of templates of under SHINGLE words: one shingle of the template's own width, held whole or not at all."""
    likely = F.lit(False)
    for words in short.values():
        likely = likely | F.contains(low, F.lit(max(words, key=len)))
    found = docs.where(likely).select(F.col(f"`{id_col}`").alias("doc_id"), F.regexp_extract_all(lower, F.lit("[a-z0-9]+"), F.lit(0)).alias("words"))
    # spaces at both ends keep words whole; what comes before the first hit has as many spaces as words, and one more
    text = F.concat(F.lit(" "), F.concat_ws(" ", "words"), F.lit(" "))
    places = F.array(*[F.struct(F.lit(name).alias("license"), F.instr(F.col("flat"), f" {' '.join(words)} ").alias("at")) for name, words in short.items()])
    hits = found.select("doc_id", text.alias("flat")).select("doc_id", "flat", F.explode(places).alias("x")).where("x.at > 0")
    start = F.length(F.regexp_replace(F.expr("substring(flat, 1, x.at)"), "[^ ]", "")) - 1
    firsts = hits.groupBy("doc_id", F.col("x.license").alias("license")).agg(F.min(start).cast("int").alias("window_start"))
    return firsts.select("doc_id", "license", F.lit(1).alias("n_shingles"), F.lit(1).alias("n_shared"), F.lit(1.0).alias("containment"), "window_start")


def license_sql(templates: dict[str, str] | None = None, percent: int = 80) -> str:
    """The same by comparing every window with every template, without signatures; short templates by their words in a row."""
    values, short = [], []
    for name, text in (templates or TEMPLATES).items():
        words = words_of(text)
        step, width = window_of(len(words))
        values += [f"('{name}', {step}, {width}, {len(shingles_of(words))}, '{s}')" for s in sorted(shingles_of(words))]
        short += [f"('{name}', ' {' '.join(words)} ')"] if len(words) < SHINGLE else []
    more = f"""
UNION ALL SELECT doc_id, name, 1, 1, 1.0::DOUBLE, CAST(min(length(regexp_replace(substr(flat, 1, strpos(flat, phrase)), '[^ ]', '', 'g')) - 1) AS INT)
FROM (SELECT doc_id, ' ' || array_to_string(w, ' ') || ' ' AS flat FROM d), (VALUES {", ".join(short)}) AS p(name, phrase) WHERE strpos(flat, phrase) > 0 GROUP BY doc_id, name""" if short else ""
    return f"""
WITH t(license, step, width, n_shingles, shingle) AS (VALUES {", ".join(values)}),
d AS (SELECT doc_id, regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[a-z0-9]+') AS w FROM documents),
e AS (SELECT doc_id, r, unnest(w) AS word, unnest(range(len(w))) AS pos FROM (SELECT *, row_number() OVER () AS r FROM d)),
s AS (SELECT doc_id, r, pos, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o AS shingle
      FROM e WINDOW o AS (PARTITION BY r ORDER BY pos)),
h AS (SELECT doc_id, r, pos, t.* FROM s JOIN t ON s.shingle = t.shingle),
x AS (SELECT doc_id, r, license, n_shingles, shingle,
             unnest(range(CAST(greatest(0, ceil((pos - width + 5) / CAST(step AS DOUBLE)) * step) AS BIGINT), pos // step * step + 1, CAST(step AS BIGINT))) AS start FROM h),
c AS (SELECT doc_id, r, license, n_shingles, start, count(DISTINCT shingle) AS n_shared FROM x GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id, license ORDER BY n_shared DESC, start) AS place FROM c WHERE n_shared * 100 >= n_shingles * {percent})
SELECT doc_id, license, CAST(n_shingles AS INT) AS n_shingles, CAST(n_shared AS INT) AS n_shared,
       CAST(n_shared AS DOUBLE) / n_shingles AS containment, CAST(start AS INT) AS window_start FROM b WHERE place = 1{more}
"""

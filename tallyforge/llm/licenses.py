"""Licence scans: sparse TF-IDF cosine of header lines, header blocks, comments and licence files to templates, then inheritance along paths."""

from __future__ import annotations

import re
from collections import Counter
from math import log, sqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import BROADCAST_ROWS, drop_staged, fresh, staged

#: Least cosine. A word counts once in a unit, so that a unit of cosine t has t^2 / (1 - t^2) known words for each unknown one.
THRESHOLD = 0.6
#: Different words that a unit must share with its template, or all of a shorter one ("MIT License"): one or two others ("all
#: rights", "mit") are words of other languages and uses.
LEAST_WORDS = 3
#: Wins only where a file has no unit of another licence: its words stand in the headers of open licences too.
LAST = "Proprietary"
#: A file is a licence file if its name says so, or if the template words in its licence units are this share of its words.
FILE_SHARE = 0.5
FILE_NAME = r"(?i)^(licen[cs]e|copying|notice|unlicense)(\.|-|$)"

# The public texts and notices of the licences. Each entry is a template of its own.
_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. '
    "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. '
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT_GRANT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, '
    "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
)
_BSD_GRANT = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_TWO = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_THREE = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version. "
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."
)
_APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 '
    'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
    "See the License for the specific language governing permissions and limitations under the License."
)
TEMPLATES = {
    "MIT": (
        "MIT License", "Released under the MIT License.", "Licensed under the MIT License.", "The MIT License (MIT)", "SPDX-License-Identifier: MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy", _MIT_GRANT,
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.", f"{_MIT_GRANT} The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. {_WARRANTY}",
    ),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/", "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION", _APACHE),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-or-later", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "This program is free software under the terms of the GNU GPL v3", _GNU.format(name="General Public License", v="3"),
    ),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", _GNU.format(name="General Public License", v="2")),
    "LGPL-3.0": ("Licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-3.0-or-later", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", _GNU.format(name="Lesser General Public License", v="3")),
    "AGPL-3.0": ("Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-or-later", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", _GNU.format(name="Affero General Public License", v="3")),
    "BSD-3-Clause": ("Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause", "Redistribution and use in source and binary forms are permitted", _BSD_GRANT, _BSD_THREE, f"{_BSD_GRANT} {_BSD_TWO} {_BSD_THREE} {_BSD_WARRANTY}"),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-2-Clause", f"{_BSD_GRANT} {_BSD_TWO} {_BSD_WARRANTY}"),
    "ISC": (
        "ISC License", "Licensed under the ISC License.", "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "MPL-2.0": (
        "SPDX-License-Identifier: MPL-2.0", "Mozilla Public License Version 2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "Zlib": (
        "zlib License",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0-1.0": ("Dedicated to the public domain under CC0 1.0 Universal.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    "Proprietary": ("Copyright. All rights reserved.", "All rights reserved.", "This software is proprietary and confidential. Unauthorized copying is strictly prohibited."),
}
WORD = r"[a-z0-9]+"
BLANK_LINES = r"\n[ \t\r\n]*\n"
#: A line that is no comment: its first character isn't one of those that comments start with.
NO_COMMENT = r"^[ \t]*[^ \t\n#/*;%-][^\n]*$"


def _template_words() -> list[tuple[str, list[str]]]:
    return [(name, sorted(set(re.findall(WORD, text.lower())))) for name, texts in TEMPLATES.items() for text in texts]


def template_weights() -> tuple[list[tuple[str, str, float, int]], dict[str, float], float]:
    """(token, number and licence of a template, weight of unit length, words of it that a unit must hold), inverse document
    frequencies over the templates, and that of words in none of them."""
    parts = _template_words()
    n = len(parts)
    df = Counter(t for _, words in parts for t in words)
    idf = {t: log((1 + n) / (1 + c)) + 1 for t, c in df.items()}
    rows = []
    for i, (name, words) in enumerate(parts):
        norm = sqrt(sum(idf[t] ** 2 for t in words))
        rows += [(t, f"{i:03d} {name}", idf[t] / norm, min(LEAST_WORDS, len(words))) for t in words]
    return rows, idf, log(1 + n) + 1


def _tokens(unit: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(unit), F.lit(WORD), F.lit(0)))


def unit_licences(spark: SparkSession, units: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(unit, licence, score): the best template of each distinct unit, if its cosine reaches the threshold.

    Ties go to the template listed first. Templates are a constant of some hundred rows, so they are broadcast.
    """
    weights, idf, unknown = template_weights()
    table = F.broadcast(spark.createDataFrame(weights, "token string, template string, w double, least int"))
    known = F.broadcast(spark.createDataFrame(sorted(idf.items()), "token string, idf double"))
    words = units.select("unit").distinct().select("unit", F.explode(_tokens(F.col("unit"))).alias("token"))
    parts = words.join(known, "token", "left").select("unit", "token", F.coalesce("idf", F.lit(unknown)).alias("x"))
    norms = parts.groupBy("unit").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dots = parts.join(table, "token").groupBy("unit", "template", "least").agg(F.sum(F.col("x") * F.col("w")).alias("dot"), F.count("*").alias("hits")).where("hits >= least")
    scored = dots.join(norms, "unit").select("unit", "template", F.round(F.col("dot") / F.col("norm"), 6).alias("score")).where(F.col("score") >= threshold)
    best = scored.groupBy("unit").agg(F.min(F.struct((-F.col("score")).alias("s"), "template")).alias("b"))
    return best.select("unit", F.substring("b.template", 5, 100).alias("licence"), (-F.col("b.s")).alias("score"))


def scan_licences(files: DataFrame, path_col: str, text_col: str = "text", threshold: float = THRESHOLD, file_share: float = FILE_SHARE) -> DataFrame:
    """``files`` with licence, licence_score, licence_from: 'header' (own units), 'directory' (inherited) or null.

    Units are all lines of the whole text, all blocks of lines between blank ones and all runs of comment lines, so that a
    notice is found on one line or wrapped, also right above code. A unit goes on if so large a share of its words stands in some template that the cosine can reach the
    threshold; no other unit could. The best unit of a text is its own licence, a reservation of all rights only if there
    is no other. A directory's licence is that of its licence files (the commonest; ties by name). A file without an own
    licence takes that of its nearest ancestor directory that has one, found by joining directories with their ancestors'
    paths. Null paths have no directory and inherit nothing; null or empty texts have no units; files of one path are told
    apart by their texts; repeated rows are kept; very long texts are read whole; an empty table gives none. Columns
    named like a result are replaced, other names can't clash.
    """
    spark = files.sparkSession
    path, text = F.col(path_col), F.col(text_col)
    known = F.array(*[F.lit(t) for t in sorted(template_weights()[1])])
    ratio = threshold**2 / (1 - threshold**2)

    titles = [words for _, words in _template_words() if len(words) < LEAST_WORDS]

    def possible(x):
        hits, titled = F.size(x["held"]), F.lit(False)
        for words in titles:
            titled = titled | (F.size(F.array_intersect(x["held"], F.array(*[F.lit(t) for t in words]))) == len(words))
        return (hits >= ratio * (x["n"] - hits)) & ((hits >= LEAST_WORDS) | ((hits >= min(map(len, titles), default=LEAST_WORDS)) & titled))

    lines = F.transform(F.split(text, "\n"), lambda x: F.struct(F.lit(0).alias("block"), F.trim(x).alias("unit")))
    blocks = F.transform(F.filter(F.split(text, BLANK_LINES), lambda x: x.contains("\n")), lambda x: F.struct(F.lit(1).alias("block"), F.trim(x).alias("unit")))
    comments = F.split(F.regexp_replace(text, "(?md)" + NO_COMMENT, ""), BLANK_LINES)
    comments = F.filter(F.transform(comments, lambda x: F.struct(F.lit(2).alias("block"), F.trim(x, F.lit(" \n")).alias("unit"))), lambda x: x["unit"].contains("\n"))
    comments = F.when(text.rlike(r"(?:^|\n)[ \t]*[#/*;%-]"), comments).otherwise(F.slice(lines, 1, 0))
    # each step is an array of its own, so that a unit is cut into words once
    units = F.transform(F.array_distinct(F.concat(lines, blocks, comments)), lambda x: F.struct(x["block"].alias("block"), x["unit"].alias("unit"), _tokens(x["unit"]).alias("words")))
    units = F.transform(units, lambda x: F.struct(x["block"].alias("block"), x["unit"].alias("unit"), F.size(x["words"]).alias("n"), F.filter(x["words"], lambda w: w.isin(*sorted(template_weights()[1]))).alias("held")))
    units = F.transform(F.filter(units, possible), lambda x: F.struct(x["block"].alias("block"), x["unit"].alias("unit")))
    key = [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("file"), text).alias("h2")]
    seen = staged(files.select(path.alias("path"), *key, F.when(F.length(text) > 0, units).alias("units")), "licence-units")
    words = F.size(F.filter(F.regexp_extract_all(F.lower("unit"), F.lit(WORD), F.lit(0)), lambda x: F.array_contains(known, x)))
    each = seen.where(F.size("units") > 0).select("h1", "h2", F.explode("units").alias("u")).select("h1", "h2", "u.block", "u.unit").distinct()
    best = unit_licences(spark, each, threshold)
    counted = each.join(best, "unit").withColumn("n", words)
    own = counted.groupBy("h1", "h2").agg(
        F.min(F.struct((F.col("licence") == LAST).alias("last"), (-F.col("score")).alias("s"), "licence")).alias("b"),
        F.greatest(*[F.sum(F.when(F.col("block") == kind, F.col("n")).otherwise(0)) for kind in range(3)]).alias("held"),
    )
    own = staged(own.select("h1", "h2", F.col("b.licence").alias("own"), (-F.col("b.s")).alias("score"), "held"), "licences")
    small = own.count() <= BROADCAST_ROWS
    sized = lambda df: F.broadcast(df) if small else df
    # words of the texts that have a licence; the others need no count
    total = files.select(text.alias("text"), *key).join(sized(own.select("h1", "h2")), ["h1", "h2"], "left_semi").select("h1", "h2", F.size(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0))).alias("words")).distinct()
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    rows = seen.where("path is not null").select("path", "h1", "h2").join(sized(own.join(total, ["h1", "h2"])), ["h1", "h2"])
    holders = rows.where(name.rlike(FILE_NAME) | (F.col("held") >= F.col("words") * F.lit(float(file_share))))
    votes = holders.groupBy(_directory(F.col("path")).alias("ancestor"), "own").count()
    held = votes.groupBy("ancestor").agg(F.min(F.struct((-F.col("count")).alias("n"), "own")).alias("b")).select("ancestor", F.col("b.own").alias("licence"))
    dirs = seen.where("path is not null").select(_directory(F.col("path")).alias("dir")).distinct()
    levels = F.split("dir", "/")
    steps = dirs.select("dir", F.explode(F.sequence(F.lit(0), F.size(levels))).alias("depth"))
    steps = steps.where("depth > 0 or dir <> ''").select("dir", "depth", F.array_join(F.slice(levels, 1, F.col("depth")), "/").alias("ancestor"))
    near = staged(steps.join(held, "ancestor").groupBy("dir").agg(F.max(F.struct("depth", "licence")).alias("b")).select("dir", F.col("b.licence").alias("inherited")), "licence-directories")
    drop_staged(seen)
    a1, a2, mine, score, folder, heir = fresh(files, "a1", "a2", "mine", "score", "folder", "heir")
    near = near.select(F.col("dir").alias(folder), F.col("inherited").alias(heir))
    near = F.broadcast(near) if near.count() <= BROADCAST_ROWS else near
    own = own.select(F.col("h1").alias(a1), F.col("h2").alias(a2), F.col("own").alias(mine), F.col("score").alias(score))
    out = files.join(sized(own), (key[0] == F.col(a1)) & (key[1] == F.col(a2)), "left").join(near, path.isNotNull() & (_directory(path) == F.col(folder)), "left")
    results = ("licence", "licence_score", "licence_from")
    return out.select(
        *[F.col(f"`{c}`") for c in files.columns if c not in results or c in (path_col, text_col)],
        F.coalesce(mine, heir).alias("licence"),
        F.col(score).alias("licence_score"),
        F.when(F.col(mine).isNotNull(), "header").when(F.col(heir).isNotNull(), "directory").alias("licence_from"),
    )


def _directory(path: Column) -> Column:
    """The path without its last part; '' at the top."""
    return F.when(path.contains("/"), F.regexp_extract(path, r"^(.*)/[^/]*$", 1)).otherwise(F.lit(""))


def document_path(source: str = "source", lang: str = "lang", id_col: str = "doc_id", per_folder: int = 100) -> Column:
    """A path for a document: source / language / a folder for each hundred ids / id. Missing parts are named '-'."""
    folder = F.floor(F.col(id_col) / per_folder).cast("string")
    return F.concat_ws("/", *[F.coalesce(c, F.lit("-")) for c in (F.col(source), F.col(lang), folder, F.col(id_col).cast("string"))])


def _values(rows, fmt) -> str:
    return ", ".join(fmt(*r) for r in rows)


def _sql() -> str:
    weights, idf, unknown = template_weights()
    q = lambda s: "'" + s.replace("'", "''") + "'"
    words = "list_distinct(regexp_extract_all(lower(unit), '[a-z0-9]+'))"
    listed = ", ".join(q(t) for t in sorted(idf))
    return f"""
WITH files AS (
  SELECT doc_id, text, coalesce(source, '-') || '/' || coalesce(lang, '-') || '/' || coalesce(CAST(CAST(floor(doc_id / 100.0) AS BIGINT) AS VARCHAR), '-') || '/' || coalesce(CAST(doc_id AS VARCHAR), '-') AS path FROM documents),
texts AS (SELECT DISTINCT text FROM files WHERE text <> ''),
units AS (
  SELECT DISTINCT text, 0 AS block, trim(unnest(string_split(text, chr(10))), ' ') AS unit FROM texts
  UNION SELECT DISTINCT text, 1, trim(b, ' ') FROM (SELECT text, unnest(string_split_regex(text, '\\n[ \\t\\r\\n]*\\n')) AS b FROM texts) WHERE contains(b, chr(10))
  UNION SELECT DISTINCT text, 2, b FROM (SELECT text, trim(unnest(string_split_regex(regexp_replace(text, '(?m){NO_COMMENT}', '', 'g'), '\\n[ \\t\\r\\n]*\\n')), ' ' || chr(10)) AS b FROM texts) WHERE contains(b, chr(10))),
weights(token, template, w, least) AS (VALUES {_values(weights, lambda t, n, w, k: f"({q(t)}, {q(n)}, {w!r}::DOUBLE, {k})")}),
known(token, idf) AS (VALUES {_values(sorted(idf.items()), lambda t, v: f"({q(t)}, {v!r}::DOUBLE)")}),
tokens AS (SELECT unit, unnest({words}) AS token FROM (SELECT DISTINCT unit FROM units)),
parts AS (SELECT unit, t.token, coalesce(idf, {unknown!r}::DOUBLE) AS x FROM tokens t LEFT JOIN known ON t.token = known.token),
norms AS (SELECT unit, sqrt(sum(x * x)) AS norm FROM parts GROUP BY unit),
dots AS (SELECT unit, template, sum(x * w) AS dot FROM parts JOIN weights USING (token) GROUP BY unit, template, least HAVING count(*) >= least),
scored AS (SELECT unit, template, round(dot / norm, 6) AS score FROM dots JOIN norms USING (unit) WHERE round(dot / norm, 6) >= {THRESHOLD}),
best AS (SELECT unit, substr(template, 5) AS licence, score FROM (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY score DESC, template) AS r FROM scored) WHERE r = 1),
counted AS (SELECT text, block, licence, score, len(list_filter(regexp_extract_all(lower(unit), '[a-z0-9]+'), lambda x: list_contains([{listed}], x))) AS n FROM units JOIN best USING (unit)),
owned AS (
  SELECT text, len(regexp_extract_all(lower(text), '[a-z0-9]+')) AS words, greatest(coalesce(sum(n) FILTER (block = 0), 0), coalesce(sum(n) FILTER (block = 1), 0), coalesce(sum(n) FILTER (block = 2), 0)) AS held,
    arg_min(licence, (licence = {q(LAST)}, -score, licence)) AS own, arg_min(score, (licence = {q(LAST)}, -score, licence)) AS score FROM counted GROUP BY text),
holders AS (SELECT regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, own, count(*) AS n FROM files JOIN owned USING (text) WHERE held >= words * {FILE_SHARE} GROUP BY ALL),
lead AS (SELECT dir, arg_min(own, (-n, own)) AS licence FROM holders GROUP BY dir),
dirs AS (SELECT DISTINCT regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir FROM files),
steps AS (SELECT dir, k, array_to_string(string_split(dir, '/')[1:k], '/') AS ancestor FROM (SELECT dir, unnest(range(1, len(string_split(dir, '/')) + 1)) AS k FROM dirs)),
near AS (SELECT steps.dir, arg_max(lead.licence, k) AS inherited FROM steps JOIN lead ON steps.ancestor = lead.dir GROUP BY steps.dir)
SELECT f.doc_id, f.path, coalesce(o.own, n.inherited) AS licence, o.score AS licence_score,
  CASE WHEN o.own IS NOT NULL THEN 'header' WHEN n.inherited IS NOT NULL THEN 'directory' END AS licence_from
FROM files f LEFT JOIN owned o ON f.text = o.text LEFT JOIN near n ON regexp_extract(f.path, '^(.*)/[^/]*$', 1) = n.dir
"""


SQL = _sql()

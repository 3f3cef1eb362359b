"""License scans: which license a file states, or inherits from its directories.

A file's passages are compared with templates by the cosine of sparse TF-IDF vectors: its lines with
the usual one-line notices, and its lines, runs of neighbouring lines and sentences, and a licence
file as a whole, with headers, tags and licence texts. A file without a statement of its own inherits
that of the nearest licence file in its directory or above, found by joins on paths.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.llm.common import stored

#: Stands for a notice that grants nothing. It keeps a file from inheriting.
NO_RIGHTS = "all-rights-reserved"
#: The usual one-line notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted. BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0 Universal.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    NO_RIGHTS: "All rights reserved.",
}
_IDS = {
    "AGPL-3.0": ["AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"],
    "GPL-2.0": ["GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later"],
    "GPL-3.0": ["GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"],
    "LGPL-3.0": ["LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"],
} | {n: [n] for n in ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "ISC", "MIT", "MPL-2.0", "Unlicense")}
_GNU = {
    "AGPL-3.0": ("Affero ", 3, "19 November 2007"),
    "GPL-2.0": ("", 2, "June 1991"),
    "GPL-3.0": ("", 3, "29 June 2007"),
    "LGPL-3.0": ("Lesser ", 3, "29 June 2007"),
}
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_MIT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal '
    "in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
    "other materials provided with the distribution. "
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without "
    "specific prior written permission. "
)
_BSD_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED '
    "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, "
    "INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, "
    "OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_UNLICENSE = (
    "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
    "commercial or non-commercial, and by any means."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice "
    "and this permission notice appear in all copies."
)
#: (licence, text) of tags, titles, headers and texts. Of the long licences (Apache, GNU, MPL, CC) the
#: title is here, not the whole text; a GNU title without its version says nothing.
NOTICES = [
    *((n, f"SPDX-License-Identifier: {i}") for n, ids in _IDS.items() for i in ids),
    *((n, text) for n, text in TEMPLATES.items()),
    *((n, f"GNU {kind}General Public License Version {v}, {day}") for n, (kind, v, day) in _GNU.items()),
    *(
        (n, f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by "
            f"the Free Software Foundation, either version {v} of the License, or (at your option) any later version.")
        for n, (kind, v, _) in _GNU.items()
    ),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Apache License"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-2-Clause", _BSD + _BSD_AS_IS),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-3-Clause", _BSD + _BSD_NAMES + _BSD_AS_IS),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International"),
    ("CC0-1.0", "Creative Commons CC0 1.0 Universal"),
    ("ISC", "ISC License"),
    ("ISC", _ISC),
    ("MIT", "MIT License"),
    ("MIT", "This file is released under the MIT License."),
    ("MIT", _MIT),
    ("MIT", f"MIT License Copyright (c) {_MIT} The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. {_AS_IS}"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", _UNLICENSE),
    ("Unlicense", f"{TEMPLATES['Unlicense']} {_UNLICENSE}"),
]
#: Neighbouring lines that are read together, at most.
WINDOW = 8
_SENTENCE = r"(?<=[.!?;])[ \t]+"
#: Names of licence files, which are read as a whole too.
LICENCE_FILE = r"(?i)(?:^|/)(?:(?:un)?licen[sc]e|copying)(?:[.-][^/]*)?$"
THRESHOLD = 0.75
#: A term: ASCII letters and digits, joined by single dots or hyphens, in lower case.
TERM = "(?i)[a-z0-9]+(?:[.-][a-z0-9]+)*"
VOCABULARY = sorted({t.lower() for text in TEMPLATES.values() for t in re.findall(TERM, text)})
NOTICE_VOCABULARY = sorted({t.lower() for _, text in NOTICES for t in re.findall(TERM, text)})


def terms(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), lambda t: F.lower(t))


def idf(files: DataFrame, text: str = "text", vocabulary: list[str] = VOCABULARY) -> dict[str | None, float]:
    """ln((1 + files) / (1 + files with the term)) + 1 for the terms of the templates, counted over all
    files; under None that of any other term, taken as one that no file has. The counts that reach the
    driver are as many as the templates have terms."""
    n = files.count()
    known = F.array(*map(F.lit, vocabulary))
    seen = files.select(F.explode(F.array_intersect(terms(F.col(text)), known)).alias("term")).groupBy("term").count()
    counts = dict(seen.collect())
    weigh = lambda df: math.log((1 + n) / (1 + df)) + 1
    return {t: weigh(counts.get(t, 0)) for t in vocabulary} | {None: weigh(0)}


def template_weights(weights: dict[str | None, float], templates: dict[str, str] = TEMPLATES) -> dict[str, dict[str, float]]:
    """Unit TF-IDF vector of each template."""
    out = {}
    for name, text in templates.items():
        found = [t.lower() for t in re.findall(TERM, text)]
        vector = {t: found.count(t) * weights[t] for t in found}
        norm = math.sqrt(sum(w * w for w in vector.values()))
        out[name] = {t: w / norm for t, w in vector.items()}
    return out


def cues(weights: dict[str | None, float], threshold: float = THRESHOLD, templates: dict[str, str] = TEMPLATES) -> list[str]:
    """Terms of which a line must have one to reach the threshold for any template, rare ones if
    possible: what the others make up of a template's unit vector bounds the cosine (Cauchy-Schwarz)."""
    units = template_weights(weights, templates)
    chosen: list[str] = []
    for term in sorted({t for u in units.values() for t in u}, key=lambda t: (-weights[t], t)):
        short = [u for u in units.values() if sum(w * w for t, w in u.items() if t not in chosen) >= (threshold * 0.999) ** 2]
        if any(term in u for u in short):
            chosen.append(term)
    return chosen


def _literal(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """A small fixed table, as literals of the plan."""
    structs = (F.struct(*(F.lit(v).alias(k) for k, v in row.items())) for row in rows)
    return spark.range(1).select(F.inline(F.array(*structs)))


def _having(weights: dict[str | None, float], threshold: float) -> str:
    """Pattern of the lines that can reach the threshold."""
    return "(?i)(?<![a-z0-9])(?:" + "|".join(re.escape(c) for c in cues(weights, threshold)) + ")(?![a-z0-9])"


def passages(files: DataFrame, key: str, text: str, wanted: list[str]) -> DataFrame:
    """(key, line, part, terms) of what is compared with the notices: lines, runs of 2 to ``WINDOW``
    lines, sentences (of up to ``WINDOW`` lines), each with the line it begins in, and whole licence
    files. Only those of two terms or more that have one of the terms ``wanted``; these are looked up
    in the terms, as a pattern of so many alternatives is slow."""
    some = F.array(*map(F.lit, wanted))
    has = lambda t: F.arrays_overlap(terms(t), some)
    whole = files.where(F.col("path").rlike(LICENCE_FILE)) if "path" in files.columns else files.limit(0)
    whole = whole.select(F.col(key).alias("key"), F.lit(0).alias("line"), F.lit(-1).alias("part"), F.col(text).alias("text"))
    rows = files.select(F.col(key).alias("key"), F.col(text).alias("_text")).where(has(F.col("_text")))
    rows = rows.withColumn("_lines", F.split("_text", "\r?\n", -1)).withColumn("_hits", F.transform("_lines", has))
    any_hit = lambda i: F.exists(F.slice("_hits", i, WINDOW), lambda x: x)
    near = F.transform(F.sequence(F.lit(1), F.size("_lines")), lambda i: F.when(any_hit(i), F.slice("_lines", i, WINDOW)))
    starts = rows.select("key", F.posexplode(near).alias("line", "_near")).where(F.col("_near").isNotNull())
    runs = F.transform(F.sequence(F.lit(1), F.size("_near")), lambda n: F.array_join(F.slice("_near", F.lit(1), n), " "))
    own = F.size(F.split(F.get("_near", F.lit(0)), _SENTENCE, -1))
    sentences = F.slice(F.split(F.array_join("_near", " "), _SENTENCE, -1), F.lit(1), own)
    parts = starts.select("key", "line", F.posexplode(F.concat(runs, sentences)).alias("part", "text"))
    found = parts.unionByName(whole).select("key", "line", "part", terms(F.col("text")).alias("terms"))
    return found.where((F.size("terms") > 1) & F.arrays_overlap("terms", some))


def _scored(found: DataFrame, weights: dict[str | None, float], units: dict[str, dict[str, float]], names: dict[str, str], threshold: float) -> DataFrame:
    """(key, line, licence, score) of the passages (key, line, part) that reach the threshold, from
    their terms and counts."""
    spark, by = found.sparkSession, ["key", "line", "part"]
    known = _literal(spark, [{"term": t, "idf": w} for t, w in weights.items() if t])
    parts = _literal(spark, [{"term": t, "template": n, "licence": names[n], "unit": w} for n, u in units.items() for t, w in u.items()])
    weighed = found.join(F.broadcast(known), "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(weights[None])))
    norms = weighed.groupBy(*by).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = weighed.join(F.broadcast(parts), "term").groupBy(*by, "template", "licence").agg(F.sum(F.col("w") * F.col("unit")).alias("dot"))
    norms = norms.withColumnsRenamed({c: f"_{c}" for c in by})
    same = (F.col("line") == F.col("_line")) & (F.col("part") == F.col("_part")) & F.col("key").eqNullSafe(F.col("_key"))
    scores = dots.join(norms, same).withColumn("score", F.round(F.col("dot") / F.col("norm"), 6)).where(F.col("score") >= threshold)
    return scores.select("key", "line", "licence", "score")


def stated(files: DataFrame, key: str = "path", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(key, licence, score, line): the best statement of each file that has one.

    Score is the cosine, rounded to 6 places; ties go to the template's name, then the earlier line
    (from 0). A licence goes before ``NO_RIGHTS``, whatever the scores. NULL and empty texts state
    nothing. Rows of one key are one file, and so are those without. Lines are compared with
    ``TEMPLATES``; ``passages``, of two terms or more, with ``NOTICES``, all of whose terms are weighed.
    """
    notices = {f"{i}": text for i, (_, text) in enumerate(NOTICES)}
    wide = idf(files, text, NOTICE_VOCABULARY)
    weights = {t: w for t, w in wide.items() if t is None or t in VOCABULARY}
    lines = files.select(F.col(key).alias("key"), F.posexplode(F.split(text, "\n", -1)).alias("line", "text"))
    lines = lines.where(F.col("text").rlike(_having(weights, threshold))).withColumn("part", F.lit(0))
    by = ["key", "line", "part"]
    count = lambda rows, of: rows.select(*by, F.explode(of).alias("term")).groupBy(*by, "term").agg(F.count(F.lit(1)).alias("tf"))
    found = stored(count(lines, terms(F.col("text"))), "terms")
    near = stored(count(passages(files, key, text, cues(wide, threshold, notices)), F.col("terms")), "passages")
    scores = _scored(found, weights, template_weights(weights), {n: n for n in TEMPLATES}, threshold)
    scores = scores.unionByName(_scored(near, wide, template_weights(wide, notices), {f"{i}": n for i, (n, _) in enumerate(NOTICES)}, threshold))
    none = (F.col("licence") == NO_RIGHTS).alias("none")
    best = scores.groupBy("key").agg(F.min(F.struct(none, (-F.col("score")).alias("minus"), "licence", "line")).alias("best"))
    return best.select(F.col("key").alias(key), "best.licence", (-F.col("best.minus")).alias("score"), "best.line")


def directories(path: Column) -> Column:
    """A directory and those above it, from itself to the root ''."""
    parts = F.split(path, "/")
    above = F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    return F.when(path == "", F.array(F.lit(""))).otherwise(F.array_append(above, F.lit("")))


def scan(files: DataFrame, key: str = "path", order: str = "path", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(path, key, own_licence, own_score, licence, inherited_from) of every file.

    A notice in a file speaks for that file alone. A licence file (``LICENCE_FILE``) speaks for its
    directory and all below it, too; of several in a directory the first by ``order`` that states a
    licence does. A file without a notice takes the licence of the nearest directory above it that has
    one; ``inherited_from`` names the directory ('' is the root) and is NULL for a licence of its own.
    A file that reserves all rights inherits nothing, and hands nothing on. Without any both are NULL.
    NULL paths are files in no directory; a file without a key has its notices like any other.

    Directories are resolved among themselves before files are joined to the one they lie in, so that
    a crowded directory is a plain skewed join.
    """
    own = stored(stated(files, key, text, threshold), "statements")
    own = own.withColumnsRenamed({"licence": "own_licence", "score": "own_score", key: "_own_key"}).drop("line")
    columns = files.select(*dict.fromkeys(["path", key, order]))
    named = columns.join(own, columns[key].eqNullSafe(own["_own_key"]), "left").drop("_own_key")
    parent = F.regexp_replace("path", "/?[^/]*$", "")
    speaks = F.col("path").rlike(LICENCE_FILE) & (F.col("own_licence") != NO_RIGHTS)
    claims = named.where(speaks).select(parent.alias("dir"), F.col(order).alias("by"), "own_licence")
    holders = claims.groupBy("dir").agg(F.min_by("own_licence", F.struct("by", "own_licence")).alias("licence"))
    dirs = named.where(F.col("path").isNotNull()).select(parent.alias("parent")).distinct()
    above = dirs.select("parent", F.explode(directories(F.col("parent"))).alias("dir"))
    resolved = above.join(holders, "dir").groupBy("parent").agg(F.max_by(F.struct("licence", "dir"), F.length("dir")).alias("found"))
    joined = named.withColumn("parent", parent).join(resolved, "parent", "left")
    mine = F.col("own_licence").isNotNull()
    return joined.select(
        "path",
        *([key] if key != "path" else []),
        "own_licence",
        "own_score",
        F.coalesce("own_licence", "found.licence").alias("licence"),
        F.when(~mine, F.col("found.dir")).alias("inherited_from"),
    )

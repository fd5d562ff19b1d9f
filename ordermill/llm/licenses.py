"""License scans: TF-IDF cosine of headers and licence files to templates, then inheritance by directory."""

from __future__ import annotations

import math
import re
from collections import Counter
from importlib import resources

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import stage, text_id, two_hashes

# Wording of common licence notices; the whole licence texts are added below.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "SPDX-License-Identifier: Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ],
    "BSD-3-Clause": [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC-BY-4.0": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-NC-4.0": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ],
    "MIT": [
        "Released under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
        "SPDX-License-Identifier: MIT",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
}
for _name, _texts in TEMPLATES.items():
    _whole = resources.files(__package__).joinpath("licence_texts", f"{_name}.txt")
    if _whole.is_file():  # no copy of CC BY-NC 4.0 is at hand: it is known by its notices alone
        _texts.append(_whole.read_text("utf-8"))

_V = r"(?: v| version)? ?v?"
_BY = r"(?: as published by the free software foundation)?(?: either)?"
_BSD = "redistribution and use in source and binary forms"
# How lower-case words state a licence, and how they state a version or kind of it that is not listed.
# The first statement in a text counts.
STATED = {
    "Apache-2.0": (
        rf"apache(?: software)?(?: licen[cs]e)?{_V}2(?: 0)?\b|version 2(?: 0)? of the apache",
        rf"apache(?: software)?(?: licen[cs]e)?{_V}(?:[013-9]|2 [1-9])\b|version [013-9](?: \d)? of the apache",
    ),
    "BSD-3-Clause": (
        rf"(?:3|three) clause bsd|{_BSD}(?=.{{0,2500}} endorse or promote)(?!.{{0,2500}} all advertising materials)",
        rf"bsd [0124] clause|0bsd|(?:2|two|4|four|zero|simplified) (?:clause )?bsd|{_BSD}(?=.{{0,2500}} all advertising materials)"
        rf"|{_BSD}(?=.{{0,2500}} this software is provided)(?!.{{0,2500}} endorse or promote)",
    ),
    "CC-BY-4.0": (
        r"attribution 4",
        r"attribution (?:[0-35-9] \d|non ?commercial|share ?alike|no ?deriv)|cc by (?:[0-35-9]|nc|sa|nd)",
    ),
    "CC-BY-NC-4.0": (
        r"attribution non ?commercial 4",
        r"attribution (?:\d \d|share ?alike|no ?deriv)|attribution non ?commercial (?:[0-35-9]|share|no)"
        r"|cc by (?:\d|sa|nd)|cc by nc (?:[0-35-9]|sa|nd)",
    ),
    "GPL-3.0": (
        rf"(?:gnu )?general public licen[cs]e(?: gpl)?{_BY}{_V}3\b|version 3(?: 0)? of the (?:gnu )?(?:general|gpl)|gpl{_V}3\b",
        rf"(?:gnu )?general public licen[cs]e(?: gpl)?{_BY}{_V}[0-24-9]\b|version [0-24-9](?: \d)? of the (?:gnu )?(?:general|gpl)"
        rf"|gpl{_V}[0-24-9]\b|(?:lesser|library|affero) general public|version \d(?: \d)? of the (?:gnu )?(?:lesser|library|affero)"
        r"|[al]gpl(?:v?\d)?\b|(?:mozilla|eclipse|common|european union) public licen[cs]e",
    ),
    "MIT": ("", r"mit (?:0|no attribution)|permission is hereby granted free of charge(?=.{0,2500} except as contained in this notice the name)"),
    "MPL-2.0": (
        rf"(?:mozilla public licen[cs]e|mpl){_V}2(?: 0)?\b",
        rf"(?:mozilla public licen[cs]e|mpl){_V}(?:[013-9]|2 [1-9])\b|(?:eclipse|common|general|european union) public licen[cs]e",
    ),
}
# The comments that a file begins with; possessive, so that none is too long to match.
COMMENTS = (
    r"^\s*+(?:<\?[^\n]*+\n\s*+)?+(?:(?:/\*(?s:.*?)\*/|<!--(?s:.*?)-->|\(\*(?s:.*?)\*\)"
    r"|\x22{3}(?s:.*?)\x22{3}|\x27{3}(?s:.*?)\x27{3}|(?:#|//|--|;|%|(?i:dnl|rem)\b)[^\n]*+)\s*+)++"
)
MARKS = r"(?im)^[ \t]*(?:dnl|rem)\b"
BLANK = r"\n[ \t]*[#/*;%!-]*[ \t\r]*(?=\n)"
LICENCE_NAME = r"(?i)^(un)?licen[cs]e|^copying|^notice"
LONG = 120  # words from which on a template is a whole text, met only by segments of half its words
BREAKS = r"[^\p{L}\p{N}]+"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), BREAKS, -1), "")


def _template_words(text: str) -> list[str]:
    return [w for w in re.split(r"[^a-z0-9]+", text.lower()) if w]


def _weighted(templates: dict[str, list[str]], idf: dict[str, float]) -> list[tuple[str, int, dict[str, float], int]]:
    """(licence, number, word -> weight, fewest words of a segment) of every template, scaled to length 1."""
    scaled = []
    for name, texts in sorted(templates.items()):
        for number, text in enumerate(texts):
            words = _template_words(text)
            weights = {w: n * idf[w] for w, n in Counter(words).items()}
            length = math.sqrt(sum(x * x for x in weights.values()))
            scaled.append((name, number, {w: x / length for w, x in weights.items()}, len(words) // 2 if len(words) >= LONG else 0))
    return scaled


def needed_words(weights: dict[str, float], least: float, uses: dict[str, int]) -> set[str]:
    """Words, held by some file, without any of which no text reaches cosine `least` to the template.

    A text without them reaches at most the length of the words left out, which are those that spare
    the most files for their weight.
    """
    rest, left_out = (least - 1e-6) ** 2, set()
    for word, x in sorted(weights.items(), key=lambda p: (-uses.get(p[0], 0) / (p[1] * p[1]), p[0])):
        if x * x < rest:
            rest -= x * x
            left_out.add(word)
    return {w for w in weights if w not in left_out and uses.get(w, 0)}


def _literal(words: set[str]) -> Column:
    """The words as one constant array."""
    return F.array_remove(F.split(F.lit(" ".join(sorted(words))), " ", -1), "")


def _statement(name: Column, words: Column, names: list[str], tags: bool) -> Column:
    """1 if `words` state the licence `name` first, -1 if a version or kind of it that is not listed, else 0.

    With `tags`, an SPDX tag that does not list the licence speaks against it too.
    """
    said, out = F.array_join(words, " "), F.lit(0)
    for n in names:
        tag = " ".join(_template_words(n))
        good, bad = STATED.get(n, ("", ""))
        other = rf"spdx licen[cs]e identifier(?! (?:\w+ ){{0,12}}?{tag}\b)" if tags else ""
        bad = "|".join(filter(None, [bad, other])) or "(?!)"
        good = "|".join(filter(None, [good, rf"{tag}\b"]))
        pattern = rf"\b(?:({bad})|({good}))"
        first = F.when(F.regexp_extract(said, pattern, 1) != "", -1).when(F.regexp_extract(said, pattern, 2) != "", 1).otherwise(0)
        out = F.when(name == n, first).otherwise(out)
    return out


def _cosines(segments: DataFrame, idf: dict[str, float], unseen: float, scaled, least: float) -> DataFrame:
    """Best template per licence of each distinct segment (_hash, words): _hash, license, score of at least `least`, nearest."""
    spark = segments.sparkSession
    weights = spark.createDataFrame([(w, x) for w, x in sorted(idf.items())], "word string, idf double")
    entries = [(w, name, number, fewest, x) for name, number, v, fewest in scaled for w, x in sorted(v.items())]
    templates = spark.createDataFrame(entries, "word string, license string, number int, fewest int, share double")
    terms = segments.select("_hash", F.explode("words").alias("word")).groupBy("_hash", "word").agg(F.count(F.lit(1)).alias("tf"))
    terms = terms.join(F.broadcast(weights), "word", "left").withColumn("x", F.col("tf") * F.coalesce("idf", F.lit(unseen)))
    terms = stage(terms.select("_hash", "word", "tf", "x"), "licence-terms")
    length = terms.groupBy("_hash").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length"), F.sum("tf").alias("words"))
    dots = terms.join(F.broadcast(templates), "word").groupBy("_hash", "license", "number", "fewest").agg(F.sum(F.col("x") * F.col("share")).alias("dot"))
    scores = dots.join(length, "_hash").where("words >= fewest").select("_hash", "license", F.round(F.col("dot") / F.col("length"), 6).alias("score"))
    best = scores.where(F.col("score") >= least).groupBy("_hash", "license").agg(F.max("score").alias("score"))
    return best.withColumn("nearest", F.col("score") == F.max("score").over(Window.partitionBy("_hash")))


def scan_licenses(
    files: DataFrame,
    least: float = 0.7,
    least_file: float = 0.6,
    templates: dict[str, list[str]] | None = None,
    doc_id: str = "doc_id",
    path: str = "path",
    text: str = "text",
) -> DataFrame:
    """One row per row of `files`: doc_id, path, license, score, origin, license_dir.

    Words are weighed by term count and inverse document frequency, counted over all files for the
    templates' words; any other word weighs as one that no file holds.  Templates are notices and
    whole licence texts; the latter (LONG words or more) are met only by texts at least half as long.  A header is a line, the joined lines of the comments that the text begins
    with, or one paragraph of these, if its cosine to a template is at least `least`; a file is a
    licence file if its whole text reaches `least_file`, or if it is named like one and holds a header.
    What states a version or kind of a licence that is not listed (STATED), by itself or else by the
    first statement of the whole text, does not hold it, nor the next licence by score unless it is
    stated.  origin is `header` for a file's own best
    header or licence, `inherited` for the licence of the nearest directory above that holds a
    licence file (license_dir, "" for the root), else null with the licence.

    Only files and segments with a word that a score of that height needs are scored, and equal ones
    once; directories are resolved once for all their files.  Ties go to the first licence by name.
    Null and empty texts hold no header but inherit; a null path has no directory.  Repeated rows are
    rows of their own; an empty table gives an empty result; other columns are not read.
    """
    templates = TEMPLATES if templates is None else templates
    rows = files.select(F.col(doc_id).alias("doc_id"), F.col(path).alias("path"), F.col(text).alias("_body"))
    rows = rows.withColumn("_text", text_id(F.col("_body")))
    vocabulary = sorted({w for texts in templates.values() for t in texts for w in _template_words(t)})
    held = F.array_intersect(_words(F.col("_body")), _literal(set(vocabulary)))
    counted = rows.select(F.explode(held).alias("word")).groupBy("word").count().collect()  # the templates' words at most
    uses = {r["word"]: r["count"] for r in counted}
    total = rows.count()
    idf = {w: math.log((total + 1) / (uses.get(w, 0) + 1)) + 1 for w in vocabulary}
    unseen = math.log(total + 1) + 1
    scaled = _weighted(templates, idf)
    lowest = min(least, least_file)
    shortest = min((fewest for *_, fewest in scaled if fewest), default=0)

    def may_reach(words: Column, score: float) -> Column:
        """Whether words that a template needs are there, and for whole texts enough words."""
        needed = [set().union(*[needed_words(v, score, uses) for _, _, v, n in scaled if bool(n) == long]) for long in (False, True)]
        return F.arrays_overlap(words, _literal(needed[0])) | ((F.size(words) >= shortest) & F.arrays_overlap(words, _literal(needed[1])))

    body = F.col("_body")
    comments = F.regexp_replace(F.regexp_extract(body, COMMENTS, 0), MARKS, "")
    pieces = F.concat(F.split(body, "\n", -1), F.split(comments, BLANK, -1), F.array(comments))
    each = F.transform(pieces, lambda x: F.struct(F.lit(False).alias("whole"), _words(x).alias("words")))
    each = F.concat(each, F.array(F.struct(F.lit(True).alias("whole"), _words(body).alias("words"))))
    key = ["doc_id", "path", "_text"]
    found = rows.where(may_reach(_words(body), lowest)).select(*key, F.explode(each).alias("s")).select(*key, "s.*")
    found = found.where(F.col("whole") | may_reach(F.col("words"), least))
    found = stage(found.withColumn("_hash", two_hashes(F.col("words"))), "licence-segments")
    distinct = found.groupBy("_hash").agg(F.first("words").alias("words"))
    scored = stage(_cosines(distinct, idf, unseen, scaled, lowest), "licence-scores")

    names = sorted(templates)
    reached = F.col("score") >= F.when(F.col("whole"), least_file).otherwise(least)
    said = _statement(F.col("license"), F.col("words"), names, True)
    met = stage(found.join(scored, "_hash").where(reached).where(F.col("nearest") | (said > 0)).select(*key, "whole", "license", "score", said.alias("said")), "licence-met")
    asked = met.where("said = 0").select(*[F.col(c).alias(f"of_{c}") for c in key], F.col("license").alias("of_license")).distinct()
    same = [found[c].eqNullSafe(asked[f"of_{c}"]) for c in key]
    around = _statement(F.col("of_license"), F.col("words"), names, False).alias("around")
    context = found.where("whole").join(asked, same).select(*asked.columns, around).distinct()
    context = stage(context, "licence-context")
    same = [met[c].eqNullSafe(context[f"of_{c}"]) for c in key] + [met["license"] == context["of_license"]]
    meant = met.join(context, same, "left").where((F.col("said") > 0) | ((F.col("said") == 0) & (F.col("around") >= 0)))

    named = F.coalesce(F.regexp_extract(F.col("path"), "([^/]*)$", 1).rlike(LICENCE_NAME), F.lit(False))
    top = F.min(F.struct((-F.col("score")).alias("minus"), "license")).alias("b")
    own = meant.groupBy(*key).agg(top, F.max(F.col("whole") | named).alias("as_file"))
    own = stage(own.select(*key, "b.license", (-F.col("b.minus")).alias("score"), "as_file"), "licence-own")

    directory = F.regexp_extract("path", "^(.*)/[^/]*$", 1)  # "" at the root
    first = F.min(F.struct((-F.col("score")).alias("minus"), "license")).alias("b")
    of_dir = own.where(F.col("as_file") & F.col("path").isNotNull()).groupBy(directory.alias("above")).agg(first)
    of_dir = stage(of_dir.select("above", F.col("b.license").alias("dir_license"), (-F.col("b.minus")).alias("dir_score")), "licence-dirs")
    parts = F.split("dir", "/", -1)
    above = F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/")))
    dirs = rows.where("path is not null").select(directory.alias("dir")).distinct()
    chain = dirs.select("dir", F.explode(F.array_distinct(above)).alias("above")).join(of_dir, "above")
    nearest = F.max(F.struct(F.length("above").alias("depth"), "above", "dir_license", "dir_score")).alias("n")
    inherited = stage(chain.groupBy("dir").agg(nearest).select("dir", "n.above", "n.dir_license", "n.dir_score"), "licence-inherited")

    base = rows.select("doc_id", "path", "_text", F.when(F.col("path").isNotNull(), directory).alias("dir"))
    mine = own.select(*[F.col(c).alias(f"own_{c}") for c in ("doc_id", "path", "_text")], "license", "score")
    match = [base[c].eqNullSafe(mine[f"own_{c}"]) for c in ("doc_id", "path", "_text")]
    joined = base.join(mine, match, "left").join(inherited, "dir", "left")
    header = F.col("license").isNotNull()
    return joined.select(
        "doc_id",
        "path",
        F.coalesce("license", "dir_license").alias("license"),
        F.when(header, F.col("score")).otherwise(F.col("dir_score")).alias("score"),
        F.when(header, "header").when(F.col("dir_license").isNotNull(), "inherited").alias("origin"),
        F.when(~header, F.col("above")).alias("license_dir"),
    )

"""Licences of files: TF-IDF cosine of their texts to templates, and inheritance along directories.

Sentences are compared with one-line notices; paragraphs, such as a header of several lines, and the whole texts of
licence files with headers, titles and bodies. Words are weighted by how many files of the whole collection hold them.
A text can only reach the threshold if it shares one of the words that carry most of a template's weight, which is
tested first. A file without a licence of its own takes that of the nearest directory above it that has a licence file.
All of it is DataFrame expressions and joins.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide.llm.tables import written

THRESHOLD = 0.7
WORD = r"[a-z]+|[0-9]+(?:\.[0-9]+)*"
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)"

# Notices as licence texts and their stewards word them (fixed values).
NOTICES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This work is subject to the terms of the Mozilla Public License, version 2.0.",
}

# Headers, titles and bodies as licence texts and their stewards word them (fixed values). What stands before the first
# space is the licence. Long licences are told by title.
TEMPLATES = {
    "AGPL-3.0 header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version.""",
    "AGPL-3.0 title": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "Apache-2.0 header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.""",
    "Apache-2.0 title": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    "BSD-2-Clause body": """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice,
this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution.""",
    "BSD-3-Clause body": """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice,
this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE
COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
DAMAGE.""",
    "GPL-2.0 header": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option)
any later version.""",
    "GPL-2.0 title": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "GPL-3.0 header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
any later version.""",
    "GPL-3.0 title": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "ISC body": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "LGPL-3.0 title": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "MIT body": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation
the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "MPL-2.0 header": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of
the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "MPL-2.0 title": "Mozilla Public License Version 2.0",
}


def words(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def sentences(text: Column) -> Column:
    """Lines, parted behind full stops."""
    return F.split(F.replace(text, F.lit(". "), F.lit(".\n")), "\n", -1)


def paragraphs(text: Column) -> Column:
    """Parts between blank lines, such as a header of several lines."""
    return F.split(text, r"\n[ \t\r]*\n", -1)


def _passages(path: Column, text: Column) -> Column:
    """Paragraphs, and the whole text of a licence file."""
    whole = F.when(_is_licence_file(path), F.array(text)).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(paragraphs(text), whole))


def _is_licence_file(path: Column) -> Column:
    return F.regexp_extract(path, "[^/]*$", 0).rlike(LICENCE_FILE)


def telling_words(notices: dict[str, str], idf: dict[str, float], threshold: float) -> list[str]:
    """Words of which a sentence must hold one to reach the threshold with any notice.

    Without the heaviest words of a notice the rest of it is shorter than the threshold times the whole, and
    so is its share of any cosine.
    """
    out = set()
    for text in notices.values():
        weight = {w: n * idf[w] for w, n in Counter(words(text)).items()}
        whole = rest = sum(x * x for x in weight.values())
        for w in sorted(weight, key=lambda w: (-weight[w], w)):
            if rest < threshold**2 * whole:
                break
            out.add(w)
            rest -= weight[w] ** 2
    return sorted(out)


def _file_counts(files: DataFrame, repeated: DataFrame, terms: DataFrame) -> DataFrame:
    """(word, df): how many files of `files` (path, text) have each of `terms` (word).

    The rows of the paths in `repeated` are one file for each path.
    """
    each = F.explode(F.array_distinct(_words(F.col("text")))).alias("word")
    held = files.join(repeated, "path", "left_anti").select(each).join(terms, "word", "left_semi")
    again = files.join(repeated, "path", "left_semi").select("path", each).join(terms, "word", "left_semi")
    return held.union(again.distinct().select("word")).groupBy("word").agg(F.count("*").alias("df"))


def notices_found(files: DataFrame, notices: dict[str, str], threshold: float, units: Column) -> DataFrame:
    """(path, licence, cosine): the best notice in each file of `files` (path, text) that has one.

    `units` are the texts of a file, an array, that are compared with notices. Every word weighs by how many of all files
    have it. Those that no notice has are counted only if they stand in a unit that reaches the threshold with them
    at 1, the least weight there is. A notice's key begins with its licence, up to a space. Equal cosines go to the
    licence that is first in order.
    """
    spark = files.sparkSession
    paths = files.groupBy("path").agg(F.count("*").alias("rows"))
    n = paths.count()
    repeated = written(paths.where("rows > 1").select("path"), "repeated")
    vocabulary = sorted({w for t in notices.values() for w in words(t)})
    terms = spark.createDataFrame([(w,) for w in vocabulary], "word string")
    df = dict(_file_counts(files, repeated, terms).collect())  # of the notices' words
    idf = {w: math.log((1 + n) / (1 + df.get(w, 0))) + 1 for w in vocabulary}
    licences = sorted(notices)
    share = {w: [0.0] * len(licences) for w in vocabulary}
    for i, licence in enumerate(licences):
        tf = Counter(words(notices[licence]))
        length = math.sqrt(sum((k * idf[w]) ** 2 for w, k in tf.items()))
        for w, k in tf.items():
            share[w][i] = k * idf[w] * idf[w] / length
    known = spark.createDataFrame(
        [(w, idf[w], *share[w]) for w in vocabulary],
        ", ".join(["word string", "idf double", *(f"w{i} double" for i in range(len(licences)))]),
    )
    telling = "(?i)(?<![a-z])(" + "|".join(map(re.escape, telling_words(notices, idf, threshold))) + ")(?![a-z])"
    some = F.filter(units, lambda s: s.rlike(telling)).alias("some")
    # Rows that repeat a path have lines of their own.
    rows = files.select("path", some, F.monotonically_increasing_id().alias("row"))
    lines = rows.select("path", "row", F.posexplode("some").alias("line", "sentence"))
    counted = (
        lines.select("path", "row", "line", F.explode(_words(F.col("sentence"))).alias("word"))
        .groupBy("path", "row", "line", "word").agg(F.count("*").alias("tf"))
    )
    line, square = ["path", "row", "line"], F.pow(F.col("tf") * F.col("idf"), 2)
    dots = [F.coalesce(F.sum(F.col("tf") * F.col(f"w{i}")), F.lit(0.0)) for i in range(len(licences))]
    weighed = counted.join(F.broadcast(known), "word", "left").groupBy(*line).agg(
        F.array(*dots).alias("dots"), F.coalesce(F.sum(square), F.lit(0.0)).alias("known"),
        F.collect_list(F.when(F.col("idf").isNull(), F.struct("word", "tf"))).alias("others"),
    )
    least = F.sqrt(F.col("known") + F.aggregate("others", F.lit(0.0), lambda x, o: x + o["tf"] * o["tf"]))
    likely = written(weighed.where(F.array_max("dots") / least >= threshold - 1e-6), "likely")
    others = likely.select(*line, F.explode("others").alias("of")).select(*line, "of.word", "of.tf")
    counts = written(_file_counts(files, repeated, others.select("word").distinct()), "word_counts")
    weight = counts.select("word", (F.log((1 + n) / (1 + F.col("df"))) + 1).alias("idf"))
    more = others.join(weight, "word").groupBy(*line).agg(F.sum(square).alias("more"))
    length = F.sqrt(F.col("known") + F.coalesce("more", F.lit(0.0)))
    scored = likely.join(more, line, "left").select(
        "path", length.alias("length"), F.posexplode("dots").alias("number", "dot")
    )
    licence = F.get(F.array(*[F.lit(name.split(" ")[0]) for name in licences]), F.col("number"))
    cosine = F.round(F.col("dot") / F.col("length"), 6)
    best = scored.select("path", licence.alias("licence"), cosine.alias("cosine"))
    best = best.where(F.col("cosine") >= threshold).groupBy("path").agg(
        F.min(F.struct((-F.col("cosine")).alias("minus"), F.col("licence"))).alias("best")
    )
    return best.select("path", F.col("best.licence").alias("licence"), (-F.col("best.minus")).alias("cosine"))


def _directory(path: Column) -> Column:
    """The directory a path is in; empty at the top."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def _ancestors(directory: Column) -> Column:
    """A directory and all above it."""
    parts = F.split(directory, "/", -1)
    above = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")
    )
    return F.array_distinct(F.concat(F.array(F.lit("")), above))


def scan_licences(
    files: DataFrame,
    notices: dict[str, str] | None = None,
    threshold: float = THRESHOLD,
    templates: dict[str, str] | None = None,
) -> DataFrame:
    """(path, licence, cosine, origin, licence_file) of every path of `files` (path, text).

    `notices` are compared with sentences, `templates` with paragraphs and with the whole texts of licence files; the
    highest cosine counts, then the licence first in order. `origin` is `own` for a file with a licence in its text,
    `inherited` where the nearest directory above with a licence file gives the licence, else `none`. Of several licence
    files in one directory the one with the highest cosine counts, then the first path. A null text is empty. A null path
    is the empty one, in the top directory. Rows that repeat a path are one file of all their texts. Other columns are
    ignored; an empty table gives no rows.
    """
    notices, templates = NOTICES if notices is None else notices, TEMPLATES if templates is None else templates
    rows = files.select(
        F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    found = [
        notices_found(rows, of, threshold, units)
        for of, units in ((notices, sentences(F.col("text"))), (templates, _passages(F.col("path"), F.col("text"))))
        if of
    ]
    best = F.min(F.struct((-F.col("cosine")).alias("minus"), F.col("licence"))).alias("best")
    either = reduce(DataFrame.union, found).groupBy("path").agg(best)
    own = either.select("path", F.col("best.licence").alias("licence"), (-F.col("best.minus")).alias("cosine"))
    own = written(own, "notices")
    is_licence = _is_licence_file(F.col("path"))
    per_directory = own.where(is_licence).groupBy(_directory(F.col("path")).alias("above")).agg(
        F.min(F.struct((-F.col("cosine")).alias("minus"), F.col("path"), F.col("licence"))).alias("best")
    )
    paths = rows.select("path").distinct().withColumn("directory", _directory(F.col("path")))
    directories = paths.select("directory").distinct()
    climbed = directories.select("directory", F.explode(_ancestors(F.col("directory"))).alias("above"))
    nearest = climbed.join(per_directory, "above").groupBy("directory").agg(
        F.max(F.struct(F.length("above").alias("deep"), F.col("best"))).alias("of")
    )
    inherited = nearest.select(
        "directory", F.col("of.best.licence").alias("given"), F.col("of.best.path").alias("given_by")
    )
    joined = paths.join(own, "path", "left").join(inherited, "directory", "left")
    has_own, has_given = F.col("licence").isNotNull(), F.col("given").isNotNull()
    origin = F.when(has_own, "own").when(has_given, "inherited").otherwise("none")
    return joined.select(
        "path", F.coalesce("licence", "given").alias("licence"), "cosine", origin.alias("origin"),
        F.when(~has_own, F.col("given_by")).alias("licence_file"),
    )

"""Licences of files: statements in the text, and licence files inherited from the nearest directory.

Sentences that mention licensing, as they stand and with wrapped lines joined, the leading comment block and whole
licence files are compared with template statements and full texts by the cosine of sparse TF-IDF
vectors. Equal ones are scored once; document frequencies count every occurrence in the corpus. An SPDX line is
taken at its word; next comes the nearest whole text, then the nearest sentence. A file
with no statement of its own takes the licence of the licence file in its own or the nearest higher
directory.
"""

from __future__ import annotations

from functools import lru_cache
from importlib import resources
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.batches import packed, unpacked

# Usual wordings of notices that point to a licence.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Licensed under the Apache License, Version 2.0.",
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "Released under the MIT License.",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Released under the BSD 3-Clause License.",
    ),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, version 3.",
        "This work is licensed under the GNU General Public License, version 3.",
    ),
    "LGPL-3.0": ("This library is licensed under the GNU Lesser General Public License, version 3.",),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
            "the above copyright notice and this permission notice appear in all copies.",),
    "0BSD": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",),
    "Zlib": ("This software is provided 'as-is', without any express or implied warranty.",
             "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
             "redistribute it freely, subject to the following restrictions:"),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "EPL-2.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",),
    "BSL-1.0": ("Distributed under the Boost Software License, Version 1.0.",),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright; dedicated to the public domain under CC0 1.0.",),
}

# Usual file headers: name, kind of program, licence, version.
FAMILY = (("GPL-2.0", "program", "General", "2"), ("GPL-3.0", "program", "General", "3"), ("LGPL-2.1", "library", "Lesser General", "2.1"),
          ("LGPL-3.0", "program", "Lesser General", "3"), ("AGPL-3.0", "program", "Affero General", "3"))
GNU_GRANT = ("This {0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1} Public License as published by the "
             "Free Software Foundation, either version {2} of the License, or (at your option) any later version.")
GNU_REST = (" This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
            "FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} Public License for more details. You should have received a copy of the GNU {1} Public "
            "License along with this {0}. If not, see https://www.gnu.org/licenses/.")
MIT_GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), "
             "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
             "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:")
MIT_REST = (" The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS "
            "PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
            "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
            "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
BSD_TWO = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
           "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
           "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
           "documentation and/or other materials provided with the distribution. ")
BSD_THIRD = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
             "software without specific prior written permission. ")
BSD_REST = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
            "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
            "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
            "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
            "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
            "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
for _name, *_words in FAMILY:
    TEMPLATES[_name] = (*TEMPLATES.get(_name, ()), GNU_GRANT.format(*_words))
TEMPLATES["MIT"] = (*TEMPLATES["MIT"], MIT_GRANT)


# Licences whose whole texts lie in the folder licences.
FULL_TEXTS = ("Apache-2.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0")


@lru_cache(maxsize=1)
def whole_texts() -> dict[str, tuple[str, ...]]:
    """Whole headers and licence files by licence."""
    found = {n: (GNU_GRANT.format(*w) + GNU_REST.format(*w),) for n, *w in FAMILY}
    found |= {"MIT": (MIT_GRANT + MIT_REST,), "BSD-2-Clause": (BSD_TWO + BSD_REST,), "BSD-3-Clause": (BSD_TWO + BSD_THIRD + BSD_REST,)}
    folder = resources.files("granary.llm") / "licences"
    for name in FULL_TEXTS:  # also from a zip archive; a text that is absent is an error
        found[name] = (*found.get(name, ()), (folder / f"{name}.txt").read_text())
    return found


SPDX = "SPDX-License-Identifier:[ \\t]*([A-Za-z0-9.+() \\t-]*[A-Za-z0-9.+)])"
COMMENT = "(?m)^[ \\t]*(?:<!--|/\\*+|\\*+/|\\*+|//+|#+|;+|--+|%+)?[ \\t]*|[ \\t]*(?:\\*+/|-->)[ \\t]*$"
COMMENT_LINE = "^[ \\t]*(#|//|;|--|%|\\r?$)"
CUE = "(?i)licen[sc]|permission\\s+(is|to)|redistribut|public\\s+domain|spdx|as[ -]is\\b"
LICENCE_FILE = "(?i)^(licen[sc]e|copying|unlicense)([._-][a-z0-9.]*)?$"
LEAST_COSINE = 0.6
WHOLE_COSINE = 0.85


def terms_of(text: Column) -> Column:
    """Lower-case words and numbers; dots and dashes count only inside."""
    return F.filter(F.transform(F.split(F.lower(text), "[^a-z0-9.-]+"), lambda t: F.btrim(t, F.lit(".-"))), lambda t: t != "")


def unwrapped(text: Column) -> Column:
    """Without comment marks; lines are kept."""
    return F.regexp_replace(text, COMMENT, "")


def header(text: Column) -> Column:
    """The comment block that a text starts with; empty if it starts with none."""
    start, lines = F.ltrim(text), F.split(text, "\n")
    code = F.array_position(F.transform(lines, lambda line: line.rlike(COMMENT_LINE)), False)
    block = F.when(start.startswith("/*"), F.substring_index(start, "*/", 1)).when(start.startswith("<!--"), F.substring_index(start, "-->", 1))
    return block.otherwise(F.array_join(F.when(code > 0, F.slice(lines, F.lit(1), (code - 1).cast("int"))).otherwise(lines), "\n"))


def one_line(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, "\\s+", " "))


def sentences(documents: DataFrame, text: str = "text") -> DataFrame:
    """(_row, _piece): the distinct sentences of each whole text that mention licensing, by line and across wrapped lines."""
    cue = documents.where(F.col(text).rlike(CUE))
    by_line = F.split(F.col(text), "\\n|(?<=[.!?])\\s+")
    across = F.transform(F.split(unwrapped(F.col(text)), "\\n\\s*\\n|(?<=[.!?])\\s+"), one_line)
    return cue.select("_row", F.explode(F.array_distinct(F.filter(F.concat(by_line, across), lambda p: p.rlike(CUE)))).alias("_piece"))


def wholes(documents: DataFrame) -> DataFrame:
    """(_row, _words, _piece): the whole text of a licence file, the leading comment block of another, and its digest."""
    part = F.when(F.col("_file"), F.col("_text")).otherwise(header(F.col("_text")))
    cue = documents.where(F.col("_text").rlike(CUE))
    return cue.select("_row", one_line(unwrapped(part)).alias("_words")).where(F.col("_words").rlike(CUE)).withColumn("_piece", F.sha2("_words", 256))


def _weighted(counted: DataFrame, frequency: DataFrame, total: Column) -> DataFrame:
    """(id, term, weight) with tf * (ln((1 + N) / (1 + df)) + 1), scaled to length 1 per id."""
    joined = counted.join(frequency, "_term", "left")
    rare = F.log((1 + F.col("_total")) / (1 + F.coalesce("_df", F.lit(0)))) + 1
    weighed = joined.withColumn("_total", total).select("_id", "_term", (F.col("_tf") * rare).alias("_w"))
    lengths = weighed.groupBy("_id").agg(F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_length")).withColumnRenamed("_id", "_of")
    return weighed.join(lengths, weighed["_id"] == lengths["_of"]).select("_id", "_term", (F.col("_w") / F.col("_length")).alias("_w"))


def match(pieces: DataFrame, templates: Mapping[str, Sequence[str]] = TEMPLATES, least: float = LEAST_COSINE,
          words: str = "_piece") -> DataFrame:
    """(_piece, licence, score): the nearest template of each distinct sentence if its cosine is at least
    ``least``; ties go to the licence whose name is last. ``pieces`` has a row per occurrence; ``words``
    is the column with the text where ``_piece`` is a short key of it."""
    spark = pieces.sparkSession
    distinct = pieces.groupBy("_piece").agg(F.count(F.lit(1)).alias("_times"), *([F.first(words).alias(words)] if words != "_piece" else []))
    exploded = distinct.select(F.col("_piece").alias("_id"), "_times", F.explode(terms_of(F.col(words))).alias("_term"))
    counted = exploded.groupBy("_id", "_term").agg(F.count(F.lit(1)).alias("_tf"), F.min("_times").alias("_times"))
    frequency = counted.groupBy("_term").agg(F.sum("_times").alias("_df"))
    total = distinct.agg(F.coalesce(F.sum("_times"), F.lit(0)).alias("n")).scalar()
    known = [(f"{name}\n{k}", text) for name, texts in templates.items() for k, text in enumerate(texts)]
    wording = spark.createDataFrame(known, "_id string, _text string").select(
        "_id", F.explode(terms_of(F.col("_text"))).alias("_term"))
    of_templates = _weighted(wording.groupBy("_id", "_term").agg(F.count(F.lit(1)).alias("_tf")), frequency, total).select(
        F.substring_index("_id", "\n", 1).alias("licence"), F.col("_id").alias("_template"), F.col("_term").alias("_t"), F.col("_w").alias("_v"))
    of_pieces = _weighted(counted.drop("_times"), frequency, total)
    products = of_pieces.join(F.broadcast(of_templates), F.col("_term") == F.col("_t"))  # templates are a fixed short list
    cosines = products.groupBy(F.col("_id").alias("_piece"), "licence", "_template").agg(F.sum(F.col("_w") * F.col("_v")).alias("score"))
    best = cosines.groupBy("_piece").agg(F.max(F.struct("score", "licence")).alias("_best"))
    return best.select("_piece", "_best.licence", "_best.score").where(F.col("score") >= least)


def directory(path: Column) -> Column:
    """All but the last part; the empty string is the root, NULL for no path."""
    return F.when(path.isNull(), F.lit(None)).when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.lit(""))


def inherited(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """(_dir, _licence, _score, _from): for every distinct directory the licence of the nearest licensed
    directory among itself and those above. ``licensed`` has one row per directory."""
    parts = F.split("_dir", "/")
    depth = F.when(F.col("_dir") == "", F.lit(0)).otherwise(F.size(parts))
    above = directories.distinct().select("_dir", F.explode(F.sequence(F.lit(0), depth)).alias("_depth")).withColumn(
        "_above", F.array_join(F.slice(parts, F.lit(1), F.col("_depth")), "/"))
    met = above.join(licensed, F.col("_above") == F.col("_licensed_dir"))
    return met.groupBy("_dir").agg(F.max(F.struct("_depth", "_licence", "_score", "_above")).alias("_n")).select(
        "_dir", F.col("_n._licence").alias("_licence"), F.col("_n._score").alias("_score"), F.col("_n._above").alias("_from"))


def scan(files: DataFrame, path: str = "path", text: str = "text", templates: Mapping[str, Sequence[str]] = TEMPLATES,
         least: float = LEAST_COSINE) -> DataFrame:
    """All columns but ``text``, and licence, score, via (header, file, inherited or NULL) and licence_from.

    An SPDX line counts first, with score 1 and its expression as it stands (the last by name if several differ), then the header or licence file
    as a whole, then the best sentence, ties going to the licence whose name is last. A licence file is known
    by its name; of several in a directory the best statement holds. A NULL path lies in no directory and
    inherits nothing; a NULL or empty text has no statement. Rows with equal (path, text) are equal and all stay;
    a source column named like a new one gives way.
    """
    new = ("licence", "score", "via", "licence_from")
    kept = [c for c in files.columns if c != text and c.lower() not in new]
    # Rows are told apart by content, which is the same on every attempt of a task.
    row = F.sha2(F.concat_ws("\x01", F.coalesce(F.col(path), F.lit("\x02")), F.coalesce(F.col(text), F.lit("\x02"))), 256)
    marked = files.select(packed(kept).alias("_kept"), F.col(path).alias("_path"), F.col(text).alias("_text"), row.alias("_row"),
                          F.coalesce(F.substring_index(F.col(path), "/", -1).rlike(LICENCE_FILE), F.lit(False)).alias("_file"))
    pieces, blocks = sentences(marked, "_text"), wholes(marked)
    named = marked.where(F.col("_text").contains("SPDX-License-Identifier:")).select(
        "_row", F.explode(F.regexp_extract_all("_text", F.lit(SPDX), F.lit(1))).alias("licence")).select("_row", F.lit(2).alias("_rank"), F.lit(1.0).alias("score"), "licence")
    by_block = blocks.select("_row", "_piece").join(match(blocks, whole_texts(), WHOLE_COSINE, "_words"), "_piece").select("_row", F.lit(1).alias("_rank"), "score", "licence")
    by_sentence = pieces.distinct().join(match(pieces, templates, least), "_piece").select("_row", F.lit(0).alias("_rank"), "score", "licence")
    stated = by_sentence.unionByName(by_block).unionByName(named).groupBy("_row").agg(F.max(F.struct("_rank", "score", "licence")).alias("_own")).withColumnRenamed("_row", "_stated")
    wide = marked.select("_kept", "_row", directory(F.col("_path")).alias("_in"), "_file")
    own = wide.join(stated, wide["_row"] == stated["_stated"], "left")
    licensed = own.where("_file and _own is not null and _in is not null").groupBy(F.col("_in").alias("_licensed_dir")).agg(F.max("_own").alias("_best")).select(
        "_licensed_dir", F.col("_best.licence").alias("_licence"), F.col("_best.score").alias("_score"))
    near = inherited(wide.where("_in is not null").select(F.col("_in").alias("_dir")), licensed)
    joined = own.join(near, own["_in"] == near["_dir"], "left")
    has = F.col("_own").isNotNull()
    return joined.select(
        *unpacked("_kept", kept), F.coalesce("_own.licence", "_licence").alias("licence"), F.coalesce("_own.score", "_score").alias("score"),
        F.when(has & F.col("_file"), "file").when(has, "header").when(F.col("_licence").isNotNull(), "inherited").alias("via"),
        F.when(has, F.col("_in")).otherwise(F.col("_from")).alias("licence_from"))

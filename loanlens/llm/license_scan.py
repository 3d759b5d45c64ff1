"""License statements found by an exact set-similarity join.

Every text block is a set of words, every template too, and a block matches
when it holds at least a given share of the template's words.  The template's
words are ordered by how many documents hold them, rarest first.  A matching
block must then hold one of a template's first ``size - needed + 1`` words, so
one join on those rare words finds every candidate; the length of the block and
the place of the first common word rule out more before the words are counted.
Column functions only.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import LOWER, UPPER, bind

# Phrases and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Notices and paragraphs of well-known licenses, by label.
TEMPLATES = {
    "agpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU Affero General Public License as published by the Free Software Foundation",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"
        " without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See"
        " the GNU Affero General Public License for more details.",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file"
        " except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the"
        " License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,"
        " either express or implied. See the License for the specific language governing permissions"
        " and limitations under the License.",
        "Grant of Copyright License. Subject to the terms and conditions of this License, each"
        " Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge,"
        " royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of,"
        " publicly display, publicly perform, sublicense, and distribute the Work and such Derivative"
        " Works in Source or Object form.",
        "Trademarks. This License does not grant permission to use the trade names, trademarks,"
        " service marks, or product names of the Licensor, except as required for reasonable and"
        " customary use in describing the origin of the Work and reproducing the content of the"
        " NOTICE file.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of"
        " conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of"
        " conditions and the following disclaimer in the documentation and/or other materials provided"
        " with the distribution.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS"
        " OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF"
        " MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE"
        " COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,"
        " EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE"
        " GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED"
        " AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING"
        " NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED"
        " OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    "bsd-3-clause": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to"
        " endorse or promote products derived from this software without specific prior written"
        " permission.",
    ),
    "cc-by": ("Licensed under CC BY 4.0.", "Creative Commons Attribution 4.0 International License"),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    "cc0": (
        "To the extent possible under law, the person who associated CC0 with this work has waived all"
        " copyright and related or neighboring rights to this work.",
    ),
    "epl": (
        "This program and the accompanying materials are made available under the terms of the Eclipse"
        " Public License 2.0 which is available at",
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU General Public License as published by the Free Software Foundation",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"
        " without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See"
        " the GNU General Public License for more details.",
        "This work is licensed under the GNU General Public License, version 3.",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS"
        " SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL"
        " THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY"
        " DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF"
        " CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE"
        " OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of"
        " the GNU Lesser General Public License as published by the Free Software Foundation",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"
        " without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See"
        " the GNU Lesser General Public License for more details.",
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files (the \"Software\"), to deal in the Software"
        " without restriction",
        "including without limitation the rights to use, copy, modify, merge, publish, distribute,"
        " sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is"
        " furnished to do so, subject to the following conditions",
        "The above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,"
        " INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR"
        " PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR"
        " ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,"
        " ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE"
        " SOFTWARE.",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a"
        " copy of the MPL was not distributed with this file, you can obtain one at",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software,"
        " either in source code form or as a compiled binary, for any purpose, commercial or"
        " non-commercial, and by any means.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,"
        " INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR"
        " PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES"
        " OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF"
        " OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
}

THRESHOLD = 0.8
BLOCK_BREAK = r"\n[ \t\r]*\n"
_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str) -> list[str]:
    """Words of a template, by the rule for documents."""
    return _WORD.findall(text.translate(str.maketrans(UPPER, LOWER)))


def _words(text: Column) -> Column:
    """The words in order; those of ASCII alone are lower-cased exactly.

    Words with other letters lose their case too, which no template word can
    tell: the Kelvin sign, the one letter that would become an ASCII word, is
    replaced first.
    """
    return F.array_remove(F.split(F.lower(F.replace(text, F.lit("\u212a"), F.lit("\u00e6"))), _BETWEEN), "")


def needed_words(size: int, threshold: float) -> int:
    return max(1, math.ceil(threshold * size - 1e-9))


def word_frequencies(docs: DataFrame, text: str, vocabulary: Sequence[str]) -> dict[str, int]:
    """In how many documents each word of the vocabulary occurs, over all of them."""
    listed = F.array(*map(F.lit, vocabulary))
    found = docs.select(F.explode(F.array_intersect(listed, _words(F.col(text)))).alias("w"))
    return {r["w"]: r["n"] for r in found.groupBy("w").agg(F.count("*").alias("n")).collect()}


def prefix_index(
    templates: Mapping[str, Sequence[str]], frequencies: Mapping[str, int], threshold: float
) -> list[tuple]:
    """(word, place, label, size, needed, words) for the first words of each template."""
    rows = []
    for label, texts in sorted(templates.items()):
        for text in texts:
            ordered = sorted(set(words_of(text)), key=lambda w: (frequencies.get(w, 0), w))
            need = needed_words(len(ordered), threshold)
            for place, word in enumerate(ordered[: len(ordered) - need + 1]):
                rows.append((word, place, label, len(ordered), need, ordered))
    return rows


def near_templates(templates: Mapping[str, Sequence[str]], threshold: float) -> list[tuple]:
    """(label, text, near): for each template those of other labels that one block may match with it.

    ``near`` has (mine, theirs, all, needed): the words only the template has,
    those only the other one has, all of the other one and how many it needs.
    """
    every = [(label, text, set(words_of(text))) for label, texts in sorted(templates.items()) for text in texts]
    rows = []
    for label, text, own in every:
        near = []
        for other_label, _, other in every:
            need = needed_words(len(other), threshold)
            close = len(own & other) >= min(need, needed_words(len(own), threshold))
            if other_label != label and other != own and close:
                near.append((sorted(own - other), sorted(other - own), sorted(other), need))
        rows.append((label, text, near))
    return rows


def _closer(tokens: Column, words: Column, near: Column, verbatim: Column) -> Column:
    """Whether no near template fits a block better, or the template's own words stand there in their order.

    Of two templates the one fits better that differs from the block in fewer
    words, of the words in either.
    """

    def better(n: Column) -> Column:
        mine, theirs = n["mine"], n["theirs"]
        own = F.size(mine) - 2 * F.size(F.array_intersect(mine, tokens))
        other = F.size(theirs) - 2 * F.size(F.array_intersect(theirs, tokens))
        return (F.size(F.array_intersect(n["all"], tokens)) >= n["need"]) & (own > other)

    whole = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    return ~F.exists(near, better) | F.exists(verbatim, lambda v: F.contains(whole, v))


def template_matches(
    docs: DataFrame,
    text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Every (block, template) with at least ``threshold`` of the template's words in the block.

    Blocks are the parts of a text between blank lines.  Returns the ``carry``
    columns, ``block`` (its number and text), ``label`` and ``containment``.  A
    template goes when one of another label fits the block better, unless its
    own words stand there in their order: so a CC BY-NC statement is no CC BY
    one, though it holds all of its words.

    A null or empty text has no block that matches; rows are treated one by
    one, repeated ones alike.  Empty tables or no templates give no rows.
    """
    spark = docs.sparkSession
    vocabulary = sorted({w for texts in templates.values() for t in texts for w in words_of(t)})
    index = prefix_index(templates, word_frequencies(docs, text, vocabulary), threshold)
    schema = (
        "_word string, _place int, label string, _size int, _need int, _all array<string>, _verbatim array<string>,"
        " _near array<struct<mine array<string>, theirs array<string>, all array<string>, need int>>"
    )
    known: dict[tuple, tuple] = {}
    for label, t, near in near_templates(templates, threshold):
        said = known.setdefault((label, frozenset(words_of(t))), ([], near))[0]
        said.append(f" {' '.join(words_of(t))} ")
    index = [(*row, *known[row[2], frozenset(row[5])]) for row in index]
    # as many rows as the given templates have prefix words
    prefixes = F.broadcast(spark.createDataFrame(index, schema))
    rare = F.array(*[F.lit(w) for w in sorted({row[0] for row in index})]).cast("array<string>")
    least = min((row[4] for row in index), default=1)
    blocks = (
        docs.select(*carry, F.posexplode(F.split(F.col(text), BLOCK_BREAK)).alias("_number", "_block"))
        .withColumn("_tokens", _words(F.col("_block")))
        .where(F.size("_tokens") >= least)
        .withColumn("_common", F.array_intersect(rare, F.col("_tokens")))
        .where(F.size("_common") > 0)
        .withColumn("_tokens", F.array_distinct("_tokens"))
    )
    candidates = (
        blocks.withColumn("_word", F.explode("_common"))
        .join(prefixes, "_word")
        .where("size(_tokens) >= _need and _size - _place >= _need")  # length and position
        .where(F.size(F.array_intersect(F.slice("_all", F.lit(1), F.col("_place")), F.col("_tokens"))) == 0)
    )
    shared = F.size(F.array_intersect("_all", "_tokens"))
    matches = candidates.withColumn("_shared", shared).where("_shared >= _need")
    closest = _closer(F.col("_tokens"), _words(F.col("_block")), F.col("_near"), F.col("_verbatim"))
    return matches.where(closest).select(
        *carry,
        F.struct(F.col("_number").alias("number"), F.col("_block").alias("text")).alias("block"),
        "label",
        (F.col("_shared") / F.col("_size")).alias("containment"),
    )


def _phrase_places(words: Column, phrases: Mapping[str, str]) -> Column:
    """(start, label) of every place where a phrase's words stand consecutively."""
    def places(phrase: str, label: str) -> Column:
        first, *rest = phrase.split(" ")

        def start(word: Column, i: Column) -> Column:
            same = word == first
            for k, following in enumerate(rest, 1):
                same = same & (F.get(words, i + k) == following)
            return F.when(same, i)

        starts = F.filter(F.transform(words, start), lambda i: i.isNotNull())
        return F.transform(starts, lambda i: F.struct(i.alias("start"), F.lit(label).alias("label")))

    return F.concat(*[places(phrase, label) for phrase, label in phrases.items()])


def license_scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Licenses named in each document, by phrase and by template.

    Returns the key, ``n_words``, ``n_base`` (places of phrases), ``first_word``
    and ``last_word`` (their smallest and largest start), ``base_labels``,
    ``labels`` (also those of templates) and ``score``: 1 with a phrase, else
    the largest containment, 0 without any.

    A null or empty text has no words, so no labels (empty strings) and score 0.
    Null keys stay; rows with equal key and text are treated alike, each gives a
    row.  An empty table gives an empty result; other columns are not read.
    """
    rows = docs.select(
        F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_whole"), F.xxhash64(text).alias("_text")
    )
    labels = sorted(set(phrases.values()))
    last_words = sorted({p.split(" ")[-1] for p in phrases})
    may_hold = F.lit(False)
    for word in last_words:
        may_hold = may_hold | F.contains(F.lower("_whole"), F.lit(word))
    none = F.array().cast("array<struct<start:int,label:string>>")
    base = rows.select(
        "_key",
        "_text",
        bind(
            _words(F.col("_whole")),
            lambda words: F.struct(
                F.size(words).alias("n"),
                F.when(may_hold, _phrase_places(words, phrases)).otherwise(none).alias("places"),
            ),
        ).alias("_b"),
    ).select(
        "_key",
        "_text",
        F.col("_b.n").cast("long").alias("n_words"),
        F.size("_b.places").cast("long").alias("n_base"),
        F.array_min("_b.places.start").cast("long").alias("first_word"),
        F.array_max("_b.places.start").cast("long").alias("last_word"),
        F.array_intersect(F.array(*map(F.lit, labels)), "_b.places.label").alias("_base"),
    )
    found = (
        template_matches(rows, "_whole", ["_key", "_text"], templates, threshold)
        .groupBy(F.col("_key").alias("_k"), F.col("_text").alias("_t"))
        .agg(F.collect_set("label").alias("_found"), F.max("containment").alias("_best"))
    )
    joined = base.join(found, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_text") == F.col("_t")), "left")
    every = F.array_sort(F.array_union("_base", F.coalesce("_found", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("_best", F.lit(0.0)))
    return joined.select(
        F.col("_key").alias(key),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("_base", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        score.alias("score"),
    )

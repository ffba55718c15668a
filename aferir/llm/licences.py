"""Licences of documents: statements found by TF-IDF cosine, and inheritance along the path.

Templates are short notices, SPDX lines, the usual file headers, and sentences that licence files begin or
tell themselves apart with. They are compared with every sentence of a text: those within a line, and those
that are wrapped over lines, with comment signs in front of the lines taken off. Vectors are sparse, over
words: occurrences times inverse document frequency, counted over all words of all documents in one grouped
pass, which stays a table. Texts without any of the telling words cannot reach the threshold (the remaining
words of every template are shorter than it), so only the others are cut into sentences. A document has the
licence of its best sentence. A licence file is a document with a telling name, or one that mostly consists of
licence sentences; its licence holds for its directory and all below, unless a nearer directory has one.
Everything is a DataFrame expression.

Edge cases: a null or empty text has no statement; a null path is the root directory; of two licences in
one directory the better match wins, then the larger name; of templates that fit equally well the first
counts; repeated rows get equal results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aferir.llm.common import stored, whole_text
from aferir.session import broadcast_if_small

# Short notices of common licences.
NOTICES = {
    "agpl-3.0": "This program is licensed under the GNU Affero General Public License, version 3.",
    "all-rights-reserved": "Copyright. All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "bsd-2-clause": "Released under the BSD 2-Clause License.",
    "bsd-3-clause": "Released under the BSD 3-Clause License.",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc0-1.0": "This work is dedicated to the public domain under CC0 1.0 Universal.",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "isc": "Released under the ISC License.",
    "lgpl-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
}
#: Identifiers of the SPDX list by licence.
SPDX = {
    "agpl-3.0": ("AGPL-3.0-only", "AGPL-3.0-or-later"),
    "apache-2.0": ("Apache-2.0",),
    "bsd-2-clause": ("BSD-2-Clause",),
    "bsd-3-clause": ("BSD-3-Clause",),
    "bsl-1.0": ("BSL-1.0",),
    "cc-by-4.0": ("CC-BY-4.0",),
    "cc-by-nc-4.0": ("CC-BY-NC-4.0",),
    "cc-by-sa-4.0": ("CC-BY-SA-4.0",),
    "cc0-1.0": ("CC0-1.0",),
    "gpl-2.0": ("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later"),
    "gpl-3.0": ("GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"),
    "isc": ("ISC",),
    "lgpl-2.1": ("LGPL-2.1-only", "LGPL-2.1-or-later"),
    "lgpl-3.0": ("LGPL-3.0-only", "LGPL-3.0-or-later"),
    "mit": ("MIT",),
    "mpl-2.0": ("MPL-2.0",),
    "unlicense": ("Unlicense",),
    "zlib": ("Zlib",),
}
# Sentences of file headers and licence files.
GNU = (
    "This {work} is free software: you can redistribute it and/or modify it under the terms of the {name} as"
    " published by the Free Software Foundation, either version {version} of the License, or (at your option) any"
    " later version."
)
SENTENCES = [
    ("agpl-3.0", GNU.format(work="program", name="GNU Affero General Public License", version="3")),
    ("agpl-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("apache-2.0", "you may not use this file except in compliance with the License."),
    ("apache-2.0", "Apache License Version 2.0, January 2004"),
    (
        "bsd-2-clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met:",
    ),
    (
        "bsd-3-clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or"
        " promote products derived from this software without specific prior written permission.",
    ),
    (
        "bsl-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software"
        " and accompanying documentation covered by this license",
    ),
    ("gpl-2.0", GNU.format(work="program", name="GNU General Public License", version="2")),
    ("gpl-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("gpl-3.0", GNU.format(work="program", name="GNU General Public License", version="3")),
    ("gpl-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("lgpl-2.1", GNU.format(work="library", name="GNU Lesser General Public License", version="2.1")),
    ("lgpl-3.0", GNU.format(work="library", name="GNU Lesser General Public License", version="3")),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        ' documentation files (the "Software"), to deal in the Software without restriction, including without'
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of"
        " the Software, and to permit persons to whom the Software is furnished to do so, subject to the following"
        " conditions:",
    ),
    ("mit", "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "zlib",
        "This software is provided 'as-is', without any express or implied warranty.",
    ),
]
#: All templates. The name counts twice in an SPDX line, so that a line with another name stays below the threshold.
TEMPLATES = [
    *NOTICES.items(),
    *((licence, f"SPDX-License-Identifier: {name} {name}") for licence, names in SPDX.items() for name in names),
    *SENTENCES,
]
SIMILARITY = 0.75
#: Share of a text's words in licence sentences that makes it a licence file.
FILE_SHARE = 0.5
FILE_NAME = r"(?i)(^|/)(licen[cs]e|copying|copyright|notice)[^/]*$"
UNIT_END = r"\n+|(?<=[.!?;])[ \t]+"
#: Signs of comments in front of a line, lines without anything else between paragraphs, ends of wrapped sentences.
COMMENT = r"[ \t]*(?:/\*+|\*+/|//+|\*+|#+|--+|;+|%+|>+|dnl\b|rem\b)?[ \t]*"
PARAGRAPH_END = rf"(?i)\n(?:{COMMENT}\n)+"
WRAPPED_END = r"(?<=[.!?;:])\s+"
NOT_WORD = "[^a-z0-9]+"


def split_words(text: str) -> list[str]:
    return [word for word in re.split(NOT_WORD, text.lower()) if word]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), NOT_WORD), "")


def document_frequencies(docs: DataFrame) -> DataFrame:
    """Every word of all documents and the number of documents that have it; the empty word is in all."""
    words = F.array_append(F.array_distinct(words_of(F.col("text"))), F.lit(""))
    return stored(docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n")))


def template_frequencies(frequency: DataFrame) -> tuple[int, dict[str, int]]:
    """Number of documents, and of those with each word of the templates: a row for each of these words."""
    terms = sorted({word for _, text in TEMPLATES for word in split_words(text)})
    found = {row["word"]: row["n"] for row in frequency.where(F.col("word").isin("", *terms)).collect()}
    return found.pop("", 0), found


def notice_vectors(n_docs: int, frequency: dict[str, int]) -> tuple[dict[str, float], dict[int, dict[str, float]]]:
    """Inverse document frequency of each word, and unit vectors of the templates by number."""
    idf, vectors = {}, {}
    for number, (_, text) in enumerate(TEMPLATES):
        tf = Counter(split_words(text))
        for word in tf:
            idf[word] = rarity(n_docs, frequency.get(word, 0))
        norm = math.sqrt(sum((n * idf[word]) ** 2 for word, n in tf.items()))
        vectors[number] = {word: n * idf[word] / norm for word, n in tf.items()}
    return idf, vectors


def rarity(n_docs: int, with_word: int) -> float:
    return math.log((n_docs + 1) / (with_word + 1)) + 1


def telling_words(idf: dict[str, float], vectors: dict[int, dict[str, float]]) -> list[str]:
    """The rarest words, so many that without them no template reaches the threshold.

    Each template adds its rarest words that are not there yet until what is left of it is too short.
    """
    chosen: set[str] = set()
    for vector in sorted(vectors.values(), key=len):
        rest = sum(w * w for word, w in vector.items() if word not in chosen)
        for word in sorted(vector, key=lambda word: (-idf[word], word)):
            if rest < SIMILARITY**2:
                break
            if word not in chosen:
                chosen.add(word)
                rest -= vector[word] ** 2
    return sorted(chosen)


def sentences(text: Column) -> Column:
    """Sentences of a text: those within lines, then those that are wrapped over lines, without comment signs."""
    bare = F.regexp_replace(text, rf"(?im)^{COMMENT}", "")
    paragraphs = F.filter(F.split(F.regexp_replace(text, PARAGRAPH_END, "\n\n"), r"\n\n+"), lambda p: p.contains("\n"))
    cleaned = F.transform(paragraphs, lambda p: F.regexp_replace(p, rf"(?im)^{COMMENT}", ""))
    wrapped = F.flatten(F.transform(cleaned, lambda p: F.split(p, WRAPPED_END)))
    return F.concat(F.split(bare, UNIT_END), F.filter(wrapped, lambda unit: unit.contains("\n")))


def statements(docs: DataFrame) -> DataFrame:
    """Sentences that match a template: doc_id, text_hash, place, licence, score, n_words."""
    frequency = document_frequencies(docs)
    n_docs, known = template_frequencies(frequency)
    idf, vectors = notice_vectors(n_docs, known)
    telling = telling_words(idf, vectors)
    pattern = rf"\b({'|'.join(map(re.escape, telling))})\b"
    likely = docs.where(F.arrays_overlap(words_of(F.col("text")), F.array(*map(F.lit, telling))))
    units = F.filter(sentences(F.col("text")), lambda unit: F.lower(unit).rlike(pattern))
    key = ["doc_id", "text_hash", "place"]
    found = likely.select("doc_id", "text_hash", F.posexplode(units).alias("place", "unit"))
    counts = stored(found.select(*key, F.explode(words_of(F.col("unit"))).alias("word")).groupBy(*key, "word").agg(F.count("*").alias("tf")))
    # The words of these sentences with their frequencies.
    wanted = broadcast_if_small(stored(counts.select("word").distinct()))
    rare = F.log(F.lit(n_docs + 1.0) / (F.coalesce("n", F.lit(0)) + 1)) + 1
    weighed = counts.join(frequency.join(wanted, "word", "left_semi"), "word", "left").withColumn("w", F.col("tf") * rare)
    sizes = weighed.groupBy(*key).agg(F.sum("tf").alias("n_words"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    # A literal row for each word of each template.
    sparse = [{"word": word, "template": i, "weight": w} for i, vector in vectors.items() for word, w in sorted(vector.items())]
    rows = F.from_json(F.lit(json.dumps(sparse)), "array<struct<word:string,template:int,weight:double>>")
    templates = F.broadcast(docs.sparkSession.range(1).select(F.inline(rows)))
    dots = weighed.join(templates, "word").groupBy(*key, "template").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    same = F.col("s.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("s.text_hash") == F.col("t.text_hash")) & (F.col("s.place") == F.col("t.place"))
    scored = dots.alias("t").join(sizes.alias("s"), same)
    # Sums of doubles may come in any order; rounding makes the result the same.
    score = F.struct(F.round(F.col("dot") / F.col("norm"), 6).alias("score"), (-F.col("template")).alias("order"))
    best = scored.groupBy("s.doc_id", "s.text_hash", "s.place").agg(F.max(score).alias("best"), F.max("n_words").alias("n_words"))
    licence = F.element_at(F.array(*[F.lit(licence) for licence, _ in TEMPLATES]), 1 - F.col("best.order"))
    return best.select(*key, licence.alias("licence"), F.col("best.score").alias("score"), "n_words").where(F.col("score") >= SIMILARITY)


def own_licences(docs: DataFrame) -> DataFrame:
    """Per text with a statement: its licence, the score, and the words in licence sentences."""
    best = F.max(F.struct(F.col("score"), F.col("licence"))).alias("best")
    found = statements(docs).groupBy("doc_id", "text_hash").agg(best, F.sum("n_words").alias("said"))
    return found.select("doc_id", "text_hash", "best.licence", "best.score", "said")


def directory(path: Column) -> Column:
    """The path without its last part; the empty text for the root."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def ancestors(path: Column) -> Column:
    """The directory itself and every directory above, up to the root."""
    parts = F.array_remove(F.split(path, "/"), "")
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.concat_ws("/", F.slice(parts, F.lit(1), n)))


REPORT = ("doc_id", "path", "licence", "score", "source", "licence_dir")


def licence_report(docs: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """One row per document: its licence, whether it is its own or inherited, and from which directory."""
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.regexp_replace(F.coalesce(F.col(path), F.lit("")), r"^/+|/+$", "").alias("path"),
        whole_text(text).alias("text"),
    )
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    own = broadcast_if_small(stored(own_licences(docs)))
    # Documents without their text from here on.
    words = F.when(F.col("said").isNotNull(), F.size(words_of(F.col("text"))))
    on = F.col("d.doc_id").eqNullSafe(F.col("o.doc_id")) & (F.col("d.text_hash") == F.col("o.text_hash"))
    slim = docs.alias("d").join(own.alias("o"), on, "left").select(
        "d.doc_id", "path", directory(F.col("path")).alias("dir"), "licence", "score", "said", words.alias("n_words")
    )
    slim = stored(slim)
    is_file = F.col("path").rlike(FILE_NAME) | (F.col("said") >= FILE_SHARE * F.col("n_words"))
    files = slim.where(F.col("licence").isNotNull() & is_file)
    held = files.groupBy("dir").agg(F.max(F.struct("score", "licence")).alias("best"))
    held = broadcast_if_small(stored(held.select(F.col("dir").alias("licence_dir"), F.col("best.licence").alias("passed_on"))))
    # Directories are resolved once each, however many documents they hold.
    dirs = slim.select("dir").distinct()
    above = dirs.select("dir", F.posexplode(ancestors(F.col("dir"))).alias("depth", "licence_dir"))
    nearest = above.join(held, "licence_dir").groupBy("dir").agg(F.max(F.struct("depth", "licence_dir", "passed_on")).alias("near"))
    nearest = broadcast_if_small(stored(nearest.select("dir", "near.licence_dir", "near.passed_on")))
    joined = slim.join(nearest, "dir", "left")
    source = F.when(F.col("licence").isNotNull(), "own").when(F.col("passed_on").isNotNull(), "inherited")
    return joined.withColumns({"source": source, "licence": F.coalesce("licence", "passed_on")}).withColumn(
        "licence_dir", F.when(F.col("source") == "inherited", F.col("licence_dir"))
    ).select(*REPORT)

"""Licences of files: sparse TF-IDF cosine to templates, then inheritance from the nearest directory above.

Every line, sentence and paragraph of a file is compared with the templates. Words that no template has weigh as the rarest ones, so a
passage has to be mostly licence wording to be like a template. Document frequencies of the templates' words are counted over all
files. A passage must also name the version and the variant (non-commercial, lesser and so on) of its template, and no other variant. A file named like a licence file gives its licence to its directory; a file without a licence of its own takes that of the nearest
directory at or above its own that has one.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import takewhile

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import map_batches, stage
from pricelake.session import discard

LEAST_COSINE = 0.75
WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")
#: Names of licence files, without directory, in lower case.
LICENCE_FILE = r"^(un)?(licen[cs]e|copying|copyright)s?([.\-_][^/]*)?$"

# Usual wording of licence notices.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions:",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies.",
    ),
    ("ISC", "Licensed under the ISC License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    (
        "LGPL-3.0",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
        "https://www.eclipse.org/legal/epl-2.0/",
    ),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    (
        "EPL-1.0",
        "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which "
        "accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    ),
    ("EPL-1.0", "Eclipse Public License - v 1.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "Zlib",
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages "
        "arising from the use of this software.",
    ),
    (
        "Zlib",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute "
        "it freely, subject to the following restrictions:",
    ),
    ("Zlib", "Licensed under the zlib License."),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation "
        "covered by this license (the Software) to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative "
        "works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
    ),
    ("WTFPL", "Do What The Fuck You Want To Public License"),
    ("WTFPL", "Do What The Fuck You Want To Public License Version 2, December 2004"),
    ("WTFPL", "Licensed under the WTFPL."),
    *(
        (f"CC-{code}-{version}", text)
        for version, scope in (("4.0", "International"), ("3.0", "Unported"))
        for code, name in (
            ("BY", "Attribution"),
            ("BY-SA", "Attribution-ShareAlike"),
            ("BY-NC", "Attribution-NonCommercial"),
            ("BY-ND", "Attribution-NoDerivatives"),
            ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        )
        for text in (
            f"Licensed under CC {code} {version}.",
            f"Creative Commons {name} {version} {scope} Public License",
            f"This work is licensed under a Creative Commons {name} {version} {scope} License.",
        )
    ),
    ("CC0-1.0", "Creative Commons CC0 1.0 Universal"),
)
#: The notices, and for each licence the line that declares it by its identifier.
TEMPLATES = NOTICES + tuple((name, f"SPDX-License-Identifier: {name}") for name in sorted({name for name, _ in NOTICES}))
#: Words that end the first identifier of a declaration, as in "GPL-3.0-or-later" or "MIT AND Zlib".
DECLARED_BY, DECLARATION_ENDS = ["spdx", "license", "identifier"], {"or", "and", "with", "only"}
#: Words that tell licences of a family apart; different spellings stand for the same variant.
VARIANTS = {
    **dict.fromkeys(("nc", "noncommercial", "commercial"), "nc"),
    **dict.fromkeys(("nd", "noderivatives", "noderivs", "derivatives", "derivs"), "nd"),
    **dict.fromkeys(("sa", "sharealike", "alike"), "sa"),
    **{w: w for w in ("lesser", "affero", "cc0")},
}
#: The terms of the first stand in the second as well.
INCLUDED = {"BSD-2-Clause": "BSD-3-Clause"}
SENTENCE_END = re.compile(r"(?<=[.!?;])\s+")
VERSION = re.compile(r"v?[0-9]+(?:\.[0-9]+)*")
CLAUSES = re.compile(r"[0-9]+")


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def distinguishing(parts: list[str]) -> tuple[set[str], set[str]]:
    """Variants and versions a passage names. A number is a version if it has a dot or a v, or stands after "version" or "v" or before "clause".

    The identifier a declaration names, the first of several, stands with the versions, so a declaration is only like that of the same licence.
    """
    variants = {VARIANTS[w] for w in parts if w in VARIANTS}
    versions = set()
    for before, word, after in zip(["", *parts], parts, [*parts[1:], ""], strict=False):
        if VERSION.fullmatch(word) and ("." in word or word[0] == "v" or before in ("version", "v")):
            versions.add(word.lstrip("v").removesuffix(".0"))
        elif after == "clause" and CLAUSES.fullmatch(word):
            versions.add(f"{word} clause")
        elif word == "identifier" and "spdx" in parts:
            at = parts.index("spdx")
            named = list(takewhile(lambda w: w not in DECLARATION_ENDS, parts[at + 3 :]))
            if parts[at : at + 3] == DECLARED_BY:
                versions.add("declared " + " ".join(named))
    return variants, versions


def passages(text: str) -> Iterator[str]:
    """Each line that is not blank, each paragraph of more than one line, and each sentence of a paragraph of more than one."""
    for paragraph in re.split(r"\n[^\S\n]*\n", text):
        lines = [line for line in paragraph.split("\n") if line.strip()]
        yield from lines
        whole = "\n".join(lines)
        if len(lines) > 1:
            yield whole
        sentences = SENTENCE_END.split(whole.strip())
        if len(sentences) > 1:
            yield from filter(None, sentences)


class Matcher:
    """Templates under the document frequencies of one corpus."""

    def __init__(self, templates: tuple, files: int, found_in: dict[str, int]):
        self.rarest = 1 + math.log(1 + files)
        self.idf = {w: 1 + math.log((1 + files) / (1 + found_in.get(w, 0))) for _, text in templates for w in words(text)}
        self.postings: dict[str, list[tuple[int, float]]] = {}
        self.names = [name for name, _ in templates]
        self.marks = [distinguishing(words(text)) for _, text in templates]
        for n, (_, text) in enumerate(templates):
            weights = {w: times * self.idf[w] for w, times in Counter(words(text)).items()}
            norm = math.sqrt(sum(v * v for v in weights.values()))
            for word, value in weights.items():
                self.postings.setdefault(word, []).append((n, value / norm))

    def of_passage(self, passage: str, least: float) -> tuple[float, int] | None:
        """(cosine, template) of the most alike template, the first of equals, if one is alike enough and its version and variant are named."""
        parts = words(passage)
        known, own, every = {}, 0.0, 0.0
        for word, times in Counter(parts).items():
            idf = self.idf.get(word)
            if idf is not None:
                known[word] = times * idf
                own += (times * idf) ** 2
            every += (times * (idf or self.rarest)) ** 2
        # The known words bound the cosine.
        if not own or own < (least - 1e-9) ** 2 * every:
            return None
        sums: dict[int, float] = {}
        for word in sorted(known):
            for n, value in self.postings[word]:
                sums[n] = sums.get(n, 0.0) + known[word] * value
        length = math.sqrt(every)
        alike = [n for n, total in sums.items() if total >= (least - 1e-6) * length]
        if not alike:
            return None
        variants, versions = distinguishing(parts)
        alike = [n for n in alike if self.marks[n][0] == variants and self.marks[n][1] <= versions]
        n = min(alike, key=lambda n: (-round(sums[n], 9), n), default=None)
        cosine = round(min(1.0, sums[n] / length), 9) if alike else 0.0
        return (cosine, n) if alike and cosine >= least else None

    def of_text(self, text: str | None, least: float) -> tuple[str | None, float]:
        """Licence and cosine of the most alike passage; (None, 0) if none is alike enough."""
        found: dict[str, tuple[float, int]] = {}
        for cosine, n in filter(None, (self.of_passage(p, least) for p in passages(text or ""))):
            found[self.names[n]] = max(found.get(self.names[n], (0.0, -n)), (cosine, -n))
        if not found:
            return None, 0.0
        name = max(found, key=found.get)
        name = INCLUDED[name] if INCLUDED.get(name) in found else name
        return name, found[name][0]


def document_frequencies(texts: DataFrame, vocabulary: frozenset[str]) -> tuple[int, dict[str, int]]:
    """Number of all rows, and for each word of the templates how many of them have it. ``None`` stands for the rows."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows = Counter(), 0
        for batch in batches:
            rows += batch.num_rows
            for text in batch.column(0):
                found.update(vocabulary.intersection(words(text.as_py() or "")))
        names = [None, *found]
        yield pa.record_batch([pa.array(names, pa.string()), pa.array([rows, *found.values()], pa.int64())], ["word", "times"])

    counts = map_batches(texts, counted, "word string, times bigint").groupBy("word").agg(F.sum("times").alias("times"))
    found = {r.word: r.times for r in counts.collect()}
    return found.pop(None, 0), found


def own_licences(files: DataFrame, path: str = "path", text: str = "text", templates: tuple = TEMPLATES, least: float = LEAST_COSINE) -> DataFrame:
    """All columns of ``files`` but ``text``, with ``licence`` (NULL if none) and ``cosine``."""
    body = files.select(F.col(f"`{text}`").cast("string").alias("body"))
    vocabulary = frozenset(w for _, t in templates for w in words(t))
    shared = files.sparkSession.sparkContext.broadcast(Matcher(templates, *document_frequencies(body, vocabulary)))
    others = [c for c in files.columns if c != text]
    rows = files.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.col(f"`{text}`").cast("string").alias("body"))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.of_text(t.as_py(), least) for t in batch.column(1)]
            names, cosines = zip(*found, strict=True) if found else ((), ())
            yield pa.record_batch([batch.column(0), pa.array(names, pa.string()), pa.array(cosines, pa.float64())], ["row", "licence", "cosine"])

    kind = rows.schema["row"].dataType.simpleString()
    return map_batches(rows, of_batches, f"row {kind}, licence string, cosine double").select("row.*", "licence", "cosine")


def directory(path: Column) -> Column:
    """Path without its last part; '' at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def ancestors(folder: str) -> Column:
    """A directory and all above it, down from '' at the top, as an array."""
    parts = F.filter(F.split(F.col(folder), "/"), lambda p: p != "")
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def scan_licences(
    files: DataFrame,
    key: str,
    path: str = "path",
    text: str = "text",
    templates: tuple = TEMPLATES,
    least: float = LEAST_COSINE,
) -> DataFrame:
    """``key``, ``path``, ``licence``, ``origin``, ``cosine`` and ``licence_path``, one row per file.

    ``origin`` is ``own`` where a passage of the file is like a template, ``inherited`` where a licence file at or above its directory gives it, else
    NULL with the licence. Of several licence files in a directory the one most alike counts, ties by path. NULL and empty texts have no
    own licence. A NULL path counts as a file at the top, ''. Empty parts of a path count for nothing. Repeated rows each come back. Other columns are not read.
    """
    spark = files.sparkSession
    plain = F.array_join(F.filter(F.split(F.coalesce(F.col(f"`{path}`"), F.lit("")), "/"), lambda p: p != ""), "/")
    rows = files.select(F.col(f"`{key}`").alias("id"), plain.alias("at"), F.col(f"`{text}`").alias("body"))
    found, _ = stage(own_licences(rows, "at", "body", templates, least).withColumn("folder", directory(F.col("at"))), "own-licences")
    named = found.where("licence IS NOT NULL").where(F.lower(F.regexp_extract("at", "[^/]*$", 0)).rlike(LICENCE_FILE))
    giving = named.groupBy("folder").agg(
        F.min_by(F.struct("licence", "cosine", "at"), F.struct(-F.col("cosine"), "at")).alias("given")
    )
    giving, giving_path = stage(giving, "licence-folders")
    above = found.select("folder").distinct().select("folder", F.explode(ancestors("folder")).alias("above"))
    nearest = above.join(giving.withColumnRenamed("folder", "above"), "above").groupBy("folder").agg(
        F.max_by("given", F.length("above")).alias("given")
    )
    # Written out, so that the last join has two plain shuffles and a directory of very many files can be split.
    nearest, _ = stage(nearest, "nearest-licences")
    discard(spark, giving_path)
    joined = found.join(nearest, "folder", "left")
    has_own, inherits = F.col("licence").isNotNull(), F.col("given").isNotNull()
    return joined.select(
        F.col("id").alias(key),
        F.col("at").alias("path"),
        F.coalesce("licence", "given.licence").alias("licence"),
        F.when(has_own, "own").when(inherits, "inherited").alias("origin"),
        F.when(has_own, F.col("cosine")).when(inherits, F.col("given.cosine")).alias("cosine"),
        F.when(has_own, F.col("at")).when(inherits, F.col("given.at")).alias("licence_path"),
    )

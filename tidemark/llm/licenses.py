"""Licences of files: TF-IDF cosine to templates, then inheritance along directories.

A file's own licence is the template most like one of its lines, paragraphs, or the whole
text. A licence file speaks for its directory; a file without a licence of its own has
that of the nearest directory above it, found by joining paths.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import WORD_BYTES, extended, own, scratch

THRESHOLD = 0.6
LICENSE_FILE = r"(?i)^(un)?licen[sc]e|^copying|^notice"

# Notices as licences and their stewards word them.
TEMPLATES = {
    "AFL-3.0": ["Licensed under the Academic Free License version 3.0"],
    "AGPL-3.0": [
        "Licensed under the GNU Affero General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
        "implied. See the License for the specific language governing permissions and limitations under the "
        "License.",
    ],
    "BSD-2-Clause": [
        "Use of this source code is governed by a BSD 2-Clause license",
        "Released under the BSD 2-Clause License",
    ],
    "BSD-3-Clause": [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD 3-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0. See accompanying file LICENSE_1_0.txt or copy "
        "at http://www.boost.org/LICENSE_1_0.txt",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC0-1.0": [
        "Dedicated to the public domain under CC0 1.0",
        "To the extent possible under law, the author has dedicated all copyright and related and neighboring "
        "rights to this software to the public domain worldwide.",
    ],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public "
        "License 2.0",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ],
    "ISC": [
        "Released under the ISC License",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "LGPL-2.1": ["Licensed under the GNU Lesser General Public License, version 2.1"],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3"],
    "MIT": [
        "Released under the MIT License",
        "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}

ADDED = T.StructType(
    [
        T.StructField("own_license", T.StringType()),
        T.StructField("own_score", T.DoubleType()),
        T.StructField("whole_file", T.BooleanType()),
    ]
)


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(WORD_BYTES).split()


def vocabulary(templates: dict[str, Sequence[str]]) -> list[bytes]:
    return sorted({w for texts in templates.values() for t in texts for w in words_of(t.encode())})


class Scorer:
    """Cosines of texts to templates in sparse TF-IDF vectors.

    `counts` has the number of documents with a word of the templates, `total` that of
    all. Words of no template weigh like words that no document has.
    """

    def __init__(self, templates: dict[str, Sequence[str]], counts: dict[bytes, int], total: int):
        self.rare = math.log(1 + total) + 1
        self.idf = {w: math.log((1 + total) / (1 + counts.get(w, 0))) + 1 for w in vocabulary(templates)}
        self.names, self.postings = [], {}
        for name in sorted(templates):
            for text in templates[name]:
                tf = Counter(words_of(text.encode()))
                norm = math.sqrt(sum((n * self.idf[w]) ** 2 for w, n in tf.items()))
                for w, n in tf.items():
                    self.postings.setdefault(w, []).append((len(self.names), n * self.idf[w] / norm))
                self.names.append(name)

    def best(self, words: list[bytes], least: float) -> tuple[float, str] | None:
        """The highest cosine of at least `least`; the first name among equals."""
        idf = self.idf
        known = Counter([w for w in words if w in idf])
        if not known:
            return None
        inside = sum((n * idf[w]) ** 2 for w, n in known.items())
        others = Counter([w for w in words if w not in idf]) if len(known) < len(words) else {}
        norm2 = inside + self.rare**2 * sum(n * n for n in others.values())
        if inside < least * least * norm2:  # no cosine can exceed this part of the length
            return None
        dots = [0.0] * len(self.names)
        for w, n in known.items():
            weight = n * idf[w]
            for i, x in self.postings[w]:
                dots[i] += weight * x
        top = max(range(len(dots)), key=lambda i: (dots[i], -i))
        score = round(dots[top] / math.sqrt(norm2), 9)
        return (score, self.names[top]) if score >= least else None

    def scan(self, raw: bytes, least: float) -> tuple[str | None, float | None, bool]:
        """The best licence among lines, paragraphs and the whole, and whether the whole has it."""
        found: list[tuple[float, str]] = []
        paragraph: list[bytes] = []
        every: list[bytes] = []
        lines = 0
        for line in [*raw.translate(WORD_LINES).split(b"\n"), b""]:
            words = line.split()
            if words:
                every += words
                paragraph += words
                lines += 1
                if best := self.best(words, least):
                    found.append(best)
            else:
                if lines > 1 and (best := self.best(paragraph, least)):
                    found.append(best)
                paragraph, lines = [], 0
        whole = self.best(every, least)
        if whole:
            found.append(whole)
        if not found:
            return None, None, False
        score, name = min(found, key=lambda f: (-f[0], f[1]))
        return name, score, bool(whole)


# Words as elsewhere, but line ends stay.
WORD_LINES = bytes(10 if b == 10 else c for b, c in enumerate(WORD_BYTES))


def document_counts(docs: DataFrame, text: str, words: Sequence[bytes]) -> tuple[dict[bytes, int], int]:
    """Documents that hold each of the given words, and all documents with text.

    Counted over all rows, summed up in each task; the result has a number per word.
    """
    wanted = frozenset(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                if raw:
                    found[b""] += 1
                    found.update(wanted.intersection(words_of(raw)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["word", "n"]
        )

    rows = docs.select(F.col(text).cast("binary").alias("raw")).mapInArrow(count, "word binary, n long")
    sums = {bytes(r["word"]): r["n"] for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return sums, sums.pop(b"", 0)


def own_licenses(
    files: DataFrame,
    text: str = "text",
    templates: dict[str, Sequence[str]] | None = None,
    threshold: float = THRESHOLD,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """Add `own_license`, `own_score` (cosine) and `whole_file` to every row.

    Null where no line, paragraph or whole text has a cosine of `threshold`. Statistics
    are counted over all rows first; what is broadcast has a number per template word.
    Null and empty texts have no licence. A row out for every row in.
    """
    templates = TEMPLATES if templates is None else templates
    counts, total = document_counts(files, text, vocabulary(templates))
    at = own(files, "_tm_raw")
    carried, schema = extended(files, carry, ADDED)
    names = schema.fieldNames()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(templates, counts, total)
        for batch in batches:
            rows = [scorer.scan(raw or b"", threshold) for raw in batch.column(at).to_pylist()]
            made = {
                f.name: pa.array([r[i] for r in rows], kind)
                for i, (f, kind) in enumerate(zip(ADDED, (pa.string(), pa.float64(), pa.bool_()), strict=True))
            }
            yield pa.RecordBatch.from_arrays([made[n] if n in made else batch.column(n) for n in names], names)

    return files.select(*carried, F.col(text).cast("binary").alias(at)).mapInArrow(work, schema)


def directory(path: Column) -> Column:
    """What stands before the last slash; the empty root where there is none."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def ancestors(path: Column) -> Column:
    """The directory itself and all above it up to the root, as (directory, depth)."""
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda n: F.struct(F.array_join(F.slice(parts, 1, n), "/").alias("above"), n.alias("depth")),
    )


def inherit(files: DataFrame, path: str = "path") -> DataFrame:
    """Add `license`, `inherited_from` (a directory, null if the licence is its own).

    `files` has `own_license`, `own_score` and `whole_file`. A licence file is one named
    like one, or one whose whole text is a notice; of several in a directory the best
    scored counts, then the first name. Paths are compared without empty parts; a null
    path inherits nothing.

    Directories, not files, are joined with their ancestors; so a directory of any
    number of files is one row there, and is joined back by a shuffled join that
    adaptive execution can split.
    """
    plain = F.array_join(F.filter(F.split(directory(F.col(path)), "/"), lambda p: p != ""), "/")
    last = F.regexp_extract(F.col(path), r"([^/]*)$", 1)
    rows = files.withColumn("_tm_dir", plain)
    speaks = F.col("own_license").isNotNull() & F.col(path).isNotNull() & (
        F.col("whole_file") | last.rlike(LICENSE_FILE)
    )
    granted = (
        rows.filter(speaks)
        .groupBy(F.col("_tm_dir").alias("above"))
        .agg(F.min(F.struct((-F.col("own_score")).alias("by"), F.col("own_license").alias("name")))["name"].alias("granted"))
    )
    found = (
        rows.filter(F.col("_tm_dir").isNotNull())
        .select("_tm_dir")
        .distinct()
        .select("_tm_dir", F.inline(ancestors(F.col("_tm_dir"))))
        .join(granted, "above")
        .groupBy(F.col("_tm_dir").alias("_tm_of"))
        .agg(F.max(F.struct("depth", "granted", "above")).alias("_tm_near"))
    )
    own = F.col("own_license").isNotNull()
    return (
        rows.join(found, F.col("_tm_dir").eqNullSafe(F.col("_tm_of")), "left")
        .withColumn("license", F.coalesce("own_license", F.col("_tm_near.granted")))
        .withColumn("inherited_from", F.when(~own, F.col("_tm_near.above")))
        .drop("_tm_dir", "_tm_of", "_tm_near")
    )


def scan_licenses(
    files: DataFrame,
    text: str = "text",
    path: str = "path",
    templates: dict[str, Sequence[str]] | None = None,
    threshold: float = THRESHOLD,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """Own and inherited licences of every file: `own_licenses`, then `inherit`.

    What is found in the texts is written once to the shared folder, without the texts
    if `carry` leaves them out, and read three times: for licence files, directories
    and files.
    """
    own = own_licenses(files, text, templates, threshold, carry)
    where = scratch(files.sparkSession, "licenses")
    own.write.parquet(where)
    return inherit(files.sparkSession.read.schema(own.schema).parquet(where), path)

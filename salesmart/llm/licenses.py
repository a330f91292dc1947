"""Licence scan: TF-IDF cosine to templates, then inheritance along paths.

Every line, every paragraph (lines up to an empty one) and the whole of each
file is compared with each licence template by the cosine of sparse TF-IDF
vectors; document frequencies are counted over all files. Templates are short
notices, file headers, SPDX tags, the full texts in ``license_texts`` and their
openings (the first 128, 256, 512, ... words, matched by segments of about that
length). Templates with a cosine of ``SIMILAR`` or more are then held against
the segment in word order: half of their pairs of neighbouring words must agree
(all of them in an SPDX tag), and where templates of two licences agree equally
well, the segment has no licence.
The best template of the best segment is the file's own licence; a full text
goes before a notice, and a notice of one licence before one that others
hold as well; of such shared notices the longest says most. ``own_licenses`` lists the licences of all lines and paragraphs
(of the whole file alone, where that is a full text). A bound on the
cosine (the weight of words that occur in no template) discards nearly all
segments before their vectors are built; it never discards a match.

A file is a licence file when its name says so (LICENSE, COPYING, ...) or when
the matching segment is at least half of its words. The licence of a directory
is that of its best licence file, and a file without a licence of its own
inherits from the nearest ancestor directory that has one: each file joins the
directories of its path, one row per level.

Defined cases: null or empty text has no licence of its own and still
inherits; a null path has no directory; of equal scores the first licence id
wins, of a directory's licence files the best score, then the first path;
repeated rows give repeated results; an empty table gives an empty result;
other columns are not read. Words are runs of letters and digits, lower-cased.
"""

from __future__ import annotations

import pkgutil
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.shared import salted_join, stored
from salesmart.llm.words import mix, row_slices, span_hashes, text_buffer, word_spans

SIMILAR = 0.75
TEXT_WORDS = 110  # words from which a template is a full text
OPENING_WORDS = 128  # shortest opening of a full text
IN_ORDER = 0.5       # pairs of neighbouring words that agree
LICENSE_NAME = r"(?i)^(licen[cs]e|copying|copyright|unlicense|notice)([-_.].*)?$"

# Usual notices and file headers of licences, as their texts or their common
# one-line forms give them (fixed values).
NOTICES: tuple[tuple[str, str], ...] = (
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("All-Rights-Reserved", "All rights reserved."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
                 "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                 "or (at your option) any later version."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met: 1. Redistributions of source code must retain the "
                     "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
                     "binary form must reproduce the above copyright notice, this list of conditions and the following "
                     "disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met: 1. Redistributions of source code must retain the "
                     "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
                     "binary form must reproduce the above copyright notice, this list of conditions and the following "
                     "disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the "
                     "name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                     "products derived from this software without specific prior written permission."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation; either version 2 of the License, "
                "or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                 "General Public License as published by the Free Software Foundation; either version 2.1 of the License, "
                 "or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
                 "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                 "or (at your option) any later version."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
)

# Identifiers of the SPDX list for the licences above, as tags name them (fixed values).
SPDX: tuple[tuple[str, str], ...] = (
    ("AGPL-3.0", "AGPL-3.0"), ("AGPL-3.0", "AGPL-3.0-only"), ("AGPL-3.0", "AGPL-3.0-or-later"), ("Apache-2.0", "Apache-2.0"),
    ("BSD-2-Clause", "BSD-2-Clause"), ("BSD-3-Clause", "BSD-3-Clause"), ("CC-BY-4.0", "CC-BY-4.0"),
    ("CC-BY-NC-4.0", "CC-BY-NC-4.0"), ("CC-BY-SA-4.0", "CC-BY-SA-4.0"), ("CC0-1.0", "CC0-1.0"), ("GPL-2.0", "GPL-2.0"),
    ("GPL-2.0", "GPL-2.0-only"), ("GPL-2.0", "GPL-2.0-or-later"), ("GPL-3.0", "GPL-3.0"), ("GPL-3.0", "GPL-3.0-only"),
    ("GPL-3.0", "GPL-3.0-or-later"), ("ISC", "ISC"), ("LGPL-2.1", "LGPL-2.1"), ("LGPL-2.1", "LGPL-2.1-only"),
    ("LGPL-2.1", "LGPL-2.1-or-later"), ("LGPL-3.0", "LGPL-3.0"), ("LGPL-3.0", "LGPL-3.0-only"),
    ("LGPL-3.0", "LGPL-3.0-or-later"), ("MIT", "MIT"), ("MPL-2.0", "MPL-2.0"), ("Unlicense", "Unlicense"))
SPDX_TAG = "SPDX-License-Identifier: "

FULL_TEXTS = ("AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1",
              "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense")
TEMPLATES: tuple[tuple[str, str], ...] = NOTICES + tuple((name, SPDX_TAG + tag) for name, tag in SPDX) + tuple(
    (name, pkgutil.get_data("salesmart.llm", f"license_texts/{name}.txt").decode()) for name in FULL_TEXTS)

_GAP = np.ones(256, bool)
_GAP[128:] = False
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    _GAP[_a:_b] = False


def _words(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By slices of rows: (first row, end, word hashes, row, line and paragraph
    number of each word)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    raw_all, off_all = text_buffer(pc.utf8_lower(column.cast(pa.large_string()).fill_null("")))
    for i, j in row_slices(raw_all, off_all):
        raw, off = raw_all[off_all[i]:off_all[j]], off_all[i:j + 1] - off_all[i]
        starts, lengths, bounds = word_spans(raw, off, _GAP)
        row = np.repeat(np.arange(j - i), np.diff(bounds))
        breaks = np.flatnonzero(raw == 10)
        line = np.searchsorted(breaks, starts) + row      # a row begins a line
        blank = _blank_lines(raw, breaks)
        paragraph = np.searchsorted(blank, starts) + row
        yield i, j, span_hashes(raw, starts, lengths, lower=False), row, line, paragraph


def _blank_lines(raw: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """Line breaks that follow a line without any word character."""
    if len(breaks) < 2:
        return breaks[:0]
    words = np.concatenate([[0], np.cumsum(~_GAP[raw])])
    return breaks[1:][words[breaks[1:]] == words[breaks[:-1]]]


def _pairs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of neighbouring words and how often each occurs."""
    return np.unique(mix(words[:-1]) + words[1:], return_counts=True)


class Templates:
    """The template vectors over their vocabulary, given document counts."""

    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES):
        self.ids, texts = [name for name, _ in templates], [text for _, text in templates]
        words = [np.zeros(0, np.uint64)] * len(texts)
        for i, j, hashes, row, _, _ in _words(pa.array(texts)):
            for r in range(j - i):
                words[i + r] = hashes[row == r]
        self.exact = [text.startswith(SPDX_TAG) for text in texts]
        # A full text is matched by segments of its length, not by its
        # disclaimer alone, and its openings by segments of theirs.
        self.least = [SIMILAR * len(w) if len(w) >= TEXT_WORDS else 0 for w in words]
        self.most = [float("inf")] * len(words)
        for name, w in list(zip(self.ids, words)):
            size = OPENING_WORDS
            while size < len(w):
                self.ids.append(name)
                words.append(w[:size])
                self.exact.append(False)
                self.least.append(SIMILAR * size)
                self.most.append(2 * SIMILAR * size)
                size *= 2
        self.least, self.most = np.array(self.least), np.array(self.most)
        self.vocabulary = np.unique(np.concatenate(words))
        self.counts = np.stack([np.bincount(np.searchsorted(self.vocabulary, w), minlength=len(self.vocabulary)) for w in words])
        self.sizes = [len(w) for w in words]
        self.full = [size >= TEXT_WORDS and most == float("inf") for size, most in zip(self.sizes, self.most)]
        self.pairs = [_pairs(w) for w in words]
        # A notice that another licence's template holds too says less.
        self.own = [not any(name != self.ids[k] and w.tobytes() in words[k].tobytes() for k in range(len(words)))
                    for name, w in zip(self.ids, words)]

    def weigh(self, files: int, seen: np.ndarray) -> None:
        """Inverse document frequencies: ``seen`` files hold each word."""
        self.idf = 1 + np.log((1 + files) / (1 + seen))
        self.other = 1 + np.log(1.0 + files)  # of a word that no template has
        self.vectors = self.counts * self.idf
        self.vectors /= np.linalg.norm(self.vectors, axis=1, keepdims=True)

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each word in the vocabulary, -1 for other words."""
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def best(self, number: np.ndarray, hashes: np.ndarray) -> tuple[float, int]:
        """Cosine and template of one segment: of those similar enough, the
        one that agrees best in word order, then in cosine, first of equals;
        0 where none does or those of two licences agree equally."""
        known, times = np.unique(number[number >= 0], return_counts=True)
        mine = times * self.idf[known]
        rest = np.unique(hashes[number < 0], return_counts=True)[1]
        norm = np.sqrt((mine ** 2).sum() + (rest.astype(float) ** 2).sum() * self.other ** 2)
        cosine = np.round(self.vectors[:, known] @ mine / max(norm, 1e-12), 9)
        similar = np.flatnonzero((cosine >= SIMILAR) & (len(hashes) >= self.least) & (len(hashes) <= self.most))
        if not len(similar):
            return 0.0, 0
        found = _pairs(hashes)
        order = {int(k): self.in_order(found, int(k)) for k in similar}
        fit = [k for k, share in order.items() if share >= (1 if self.exact[k] else IN_ORDER)]
        if not fit:
            return 0.0, 0
        k = max(fit, key=lambda k: (order[k], cosine[k], -k))
        if any(order[j] == order[k] and self.ids[j] != self.ids[k] for j in fit):
            return 0.0, 0
        return float(cosine[k]), k

    def in_order(self, found: tuple[np.ndarray, np.ndarray], k: int) -> float:
        """Share of neighbouring pairs that a segment and a template have in
        common; of two single words 1 (their cosine tells)."""
        size = int(found[1].sum() + self.pairs[k][1].sum())
        if not size:
            return 1.0
        _, a, b = np.intersect1d(found[0], self.pairs[k][0], assume_unique=True, return_indices=True)
        return 2 * int(np.minimum(found[1][a], self.pairs[k][1][b]).sum()) / size


def _scan_rows(column: pa.Array, known: Templates) -> Iterator[tuple[str | None, float, float, list[str]]]:
    """(licence, score, share of the words in the matching segment, licences
    of all segments) by row."""
    for i, j, hashes, row, line, paragraph in _words(column):
        number = known.number(hashes)
        weight = np.where(number >= 0, known.idf[number], 0.0)
        total = np.bincount(row, minlength=j - i)
        best: list[tuple[float, int, int, tuple]] = [(0.0, 0, 0, ())] * (j - i)
        every: list[set[str]] = [set() for _ in range(j - i)]
        for segment in (line, paragraph, row):
            if not len(segment):
                continue
            start = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
            end = np.append(start[1:], len(segment))
            mine = np.add.reduceat(weight, start) ** 2
            others = np.add.reduceat((number < 0).astype(float), start) * known.other ** 2
            # The cosine is at most the root of mine / (mine + others).
            for k in np.flatnonzero(mine >= SIMILAR ** 2 * (mine + others)):
                score, which = known.best(number[start[k]:end[k]], hashes[start[k]:end[k]])
                r = int(row[start[k]])
                words = int(end[k] - start[k])
                own = known.own[which]
                rank = known.full[which], own, score if own else words, words if own else score
                if score < SIMILAR:
                    continue
                if segment is row and known.full[which]:
                    every[r] = {known.ids[which]}
                elif segment is not row or not every[r]:
                    every[r].add(known.ids[which])
                if rank > best[r][3]:
                    best[r] = (score, which, words, rank)
        for r, (score, which, words, _) in enumerate(best):
            yield (known.ids[which] if words else None), score, words / max(1, int(total[r])), sorted(every[r])


def own_licenses(files: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """id and path of files(id, path, text) with own_license, score, share and
    own_licenses."""
    known = Templates(templates)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(len(known.vocabulary), np.int64), 0
        for batch in batches:
            n += len(batch)
            for i, j, hashes, row, _, _ in _words(batch.column(0)):
                number = known.number(hashes)
                pair = np.unique(row[number >= 0] * len(known.vocabulary) + number[number >= 0])
                seen += np.bincount(pair % len(known.vocabulary), minlength=len(known.vocabulary))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, len(seen), dtype=np.int64)), pa.array(np.append([n], seen))], ["word", "files"])

    counted = {r["word"]: r["files"] for r in
               files.select("text").mapInArrow(count, "word long, files long").groupBy("word").agg(F.sum("files").alias("files")).collect()}
    known.weigh(counted.get(-1, 0), np.array([counted.get(k, 0) for k in range(len(known.vocabulary))], float))
    shared = files.sparkSession.sparkContext.broadcast(known)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            name, score, share, every = zip(*_scan_rows(batch.column(2), shared.value)) if len(batch) else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(name, pa.string()), pa.array(score, pa.float64()),
                 pa.array(share, pa.float64()), pa.array(every, pa.list_(pa.string()))],
                ["id", "path", "own_license", "score", "share", "own_licenses"])

    return files.select("id", "path", "text").mapInArrow(
        scan, "id long, path string, own_license string, score double, share double, own_licenses array<string>")


def scan_licenses(files: DataFrame, id_col: str = "id", path_col: str = "path", text_col: str = "text",
                  templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """One row per file: id, path, own_license, score, own_licenses, license (its own, else
    that of the nearest ancestor directory), origin (own, inherited, none) and
    inherited_from (that directory)."""
    rows = files.select(F.col(id_col).cast("long").alias("id"), F.col(path_col).alias("path"), F.col(text_col).alias("text"))
    found = stored(own_licenses(rows, templates), "licenses")
    parts = F.split("path", "/")
    levels = F.size(parts) - 1  # the directories of a path: "", "a", "a/b", ...
    named = F.element_at(parts, -1).rlike(LICENSE_NAME) | (F.col("share") >= 0.5)
    directory = F.array_join(F.slice(parts, 1, F.greatest(levels, F.lit(0))), "/")
    directories = stored(
        found.where(F.col("own_license").isNotNull() & F.col("path").isNotNull()).where(named)
        .groupBy(directory.alias("dir"))
        .agg(F.min(F.struct((-F.col("score")).alias("s"), "path", "own_license")).alias("best"))
        .select("dir", F.col("best.own_license").alias("dir_license")), "license-directories")
    alone = found.where("own_license is null").where("path is not null")
    # Files of one directory share its answer: one row per directory and level.
    asked = alone.select(directory.alias("of")).distinct()
    steps = F.split("of", "/")
    up = asked.select("of", F.explode(F.sequence(F.lit(0), F.size(steps))).alias("depth"), steps.alias("steps")).select(
        "of", "depth", F.array_join(F.slice("steps", 1, F.col("depth")), "/").alias("dir")).where("depth > 0 or of <> ''")
    nearest = (salted_join(up, directories, ["dir"], ["of"]).groupBy("of")
               .agg(F.max(F.struct("depth", "dir", "dir_license")).alias("near"))
               .select("of", F.col("near.dir").alias("inherited_from"), F.col("near.dir_license").alias("dir_license")))
    inherited = salted_join(alone.withColumn("of", directory), nearest, ["of"], ["id", "path"], "left")
    columns = ["id", "path", "own_license", "score", "own_licenses"]
    own = found.where(F.col("own_license").isNotNull() | F.col("path").isNull()).select(
        *columns, F.col("own_license").alias("license"),
        F.when(F.col("own_license").isNotNull(), "own").otherwise("none").alias("origin"),
        F.lit(None).cast("string").alias("inherited_from"))
    return own.unionByName(inherited.select(
        *columns, F.col("dir_license").alias("license"),
        F.when(F.col("dir_license").isNotNull(), "inherited").otherwise("none").alias("origin"), "inherited_from"))

"""License scans: sparse TF-IDF cosine of passages to licence templates, then inheritance from the nearest directory.

Every text is searched whole, by one rule for all lengths: each template is compared with every window of as many terms
as it has, wherever lines break (a shorter text is one window). A window can reach the threshold only if the terms that
it shares with the template hold that share of the template's squared weight, whatever else stands in it; sums of these
weights over a whole text, then over its windows, leave the few windows that are compared. Words that no template has
weigh as much as the rarest one, so running text in a window lowers its score. A window must also hold its template's
own version and variant words, and no variant word of another licence (lesser, nd, ...), so that a licence whose
template is missing isn't taken for its nearest relative.

A file's licence is that of its best passage. A licence file (by its name) also gives it to its directory. The
directories of all files, each once, are exploded to their ancestors and joined with the directories that have a
licence; the deepest wins. Files without a licence of their own take that of their directory in a second join.

Defined results: null and empty texts have no passage; equal scores go to the first template, then the first passage;
of several licence files in a directory the best score wins, then the first path; null paths lie in no directory and
inherit nothing; repeated rows are scanned each; an empty table gives an empty result; other columns pass through: where one is named as
a column of the result, the result's own gets an underscore at its end.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .util import free_name, lean_batches, materialize, table

THRESHOLD = 0.75
#: Words too common to tell licences apart; left out on both sides.
STOP = set("a an and any are as at be by for in is it of on or other that the this to with you your".split())
#: Words that tell apart licences of one family.
VARIANTS = set("lesser library affero nc nd sa noncommercial noderivatives sharealike".split())
_WARRANTY = "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAMES = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_TAIL = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
_GNU_COPY = "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."


def _gnu_notice(name: str, version: str) -> str:
    return f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."


#: What the licences' own texts and the notices that they ask for say.
TEXTS = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _WARRANTY,
    ),
    "BSD-2-Clause": (_BSD_HEAD + " " + _BSD_TAIL,),
    "BSD-3-Clause": (_BSD_HEAD + " " + _BSD_NAMES + " " + _BSD_TAIL, _BSD_NAMES),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",),
    "GPL-2.0": (_gnu_notice("General Public License", "2"), "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc. " + _GNU_COPY),
    "GPL-3.0": (_gnu_notice("General Public License", "3"), "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. " + _GNU_COPY),
    "LGPL-2.1": (_gnu_notice("Lesser General Public License", "2.1"), "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, Inc. " + _GNU_COPY),
    "LGPL-3.0": (_gnu_notice("Lesser General Public License", "3"), "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. " + _GNU_COPY),
    "AGPL-3.0": (_gnu_notice("Affero General Public License", "3"), "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc. " + _GNU_COPY),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    "EPL-2.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",),
    "Unlicense": ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",),
    "Zlib": ("This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",),
    "BSL-1.0": ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, execute, and transmit the Software",),
    "CC0-1.0": ("To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this software to the public domain worldwide.", "CC0 1.0 Universal Public Domain Dedication"),
}
#: How running text names the licences.
NAMES = {
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"), "MIT": ("MIT License",), "BSD-2-Clause": ("BSD 2-Clause License",), "BSD-3-Clause": ("BSD 3-Clause License",), "ISC": ("ISC License",),
    "GPL-2.0": ("GNU General Public License, version 2",), "GPL-3.0": ("GNU General Public License, version 3",), "LGPL-2.1": ("GNU Lesser General Public License, version 2.1",), "LGPL-3.0": ("GNU Lesser General Public License, version 3",),
    "AGPL-3.0": ("GNU Affero General Public License, version 3",), "MPL-2.0": ("Mozilla Public License 2.0",), "EPL-2.0": ("Eclipse Public License 2.0",), "Unlicense": ("Unlicense",), "BSL-1.0": ("Boost Software License 1.0",), "Zlib": ("zlib License",), "CC0-1.0": ("CC0 1.0",),
}


def _templates() -> dict[str, tuple[str, ...]]:
    """All templates: the texts, then short notices by name; the Creative Commons family by its rule."""
    found = {name: [f"Released under the {full}" for full in fulls] + [f"Licensed under the {full}" for full in fulls] + [f"This work is licensed under the {full}" for full in fulls] for name, fulls in NAMES.items()}
    words = {"BY": "Attribution", "NC": "NonCommercial", "ND": "NoDerivatives", "SA": "ShareAlike"}
    for parts in (["BY"], ["BY", "SA"], ["BY", "ND"], ["BY", "NC"], ["BY", "NC", "SA"], ["BY", "NC", "ND"]):
        short = f"CC {'-'.join(parts)} 4.0"
        found[f"CC-{'-'.join(parts)}-4.0"] = [f"Licensed under {short}", f"Released under {short}", f"This work is licensed under a Creative Commons {'-'.join(words[p] for p in parts)} 4.0 International License"]
    for name in found:
        found[name] += TEXTS.get(name, ())
        found[name].append(f"SPDX-License-Identifier: {name}")
    return {name: tuple(dict.fromkeys(texts)) for name, texts in found.items()}


TEMPLATES = _templates()
TERM = re.compile(r"\d+(?:\.\d+)+|\w+")


def terms_of(text: str) -> list[str]:
    return [w for w in TERM.findall(text.lower()) if w not in STOP]


class Matcher:
    """Template vectors, the sums that any match must reach, and the comparison."""

    def __init__(self, templates: dict[str, tuple[str, ...]] = TEMPLATES, threshold: float = THRESHOLD):
        counts = [(name, Counter(terms_of(t))) for name, texts in templates.items() for t in texts]
        df = Counter(w for _, c in counts for w in c)
        self.idf = {w: log((1 + len(counts)) / (1 + n)) + 1 for w, n in df.items()}
        self.unknown = log((1 + len(counts)) / 2) + 1
        self.threshold, self.least = threshold, threshold**2 - 1e-9
        self.names, self.vectors = [n for n, _ in counts], [self.vector(c) for _, c in counts]
        self.lengths = [sum(c.values()) for _, c in counts]
        self.lists: dict[str, list[tuple[int, float]]] = {}
        for k, v in enumerate(self.vectors):
            for w, x in v.items():
                self.lists.setdefault(w, []).append((k, x * x))
        digits = lambda name: {x for p in name.split("-") if p[0].isdigit() for x in (p, p.removesuffix(".0"))}
        self.keys = [{w for w in c if w in VARIANTS or w in digits(name)} for name, c in counts]
        self.others = [(VARIANTS & set(df)) - set(c) for _, c in counts]

    def vector(self, counts: Counter) -> dict[str, float]:
        v = {w: (1 + log(n)) * self.idf.get(w, self.unknown) for w, n in counts.items()}
        norm = sum(x * x for x in v.values()) ** 0.5 or 1.0
        return {w: x / norm for w, x in v.items()}

    def possible(self, terms: list[str]) -> list[int]:
        """The templates of whose squared weight the terms hold enough for a match."""
        sums: dict[int, float] = {}
        for w in self.lists.keys() & set(terms):
            for k, x in self.lists[w]:
                sums[k] = sums.get(k, 0.0) + x
        return sorted(k for k, x in sums.items() if x >= self.least)

    def may_match(self, passage: str) -> bool:
        return bool(self.possible(terms_of(passage)))

    def best(self, passage: str) -> tuple[float, int]:
        """Score and number of the nearest template, the first of equals; 0 and -1 where no term is shared."""
        v = self.vector(Counter(terms_of(passage)))
        sums: dict[int, float] = {}
        for w, x in v.items():
            for k, _ in self.lists.get(w, ()):
                sums[k] = sums.get(k, 0.0) + x * self.vectors[k][w]
        k = min(sums, key=lambda k: (-round(sums[k], 9), k), default=-1)
        return (round(sums[k], 9), k) if k >= 0 else (0.0, -1)

    def slide(self, terms: list[str], k: int, keys: bool = False) -> int:
        """Where the window of the template's own length that is nearest to it begins, the first of equals; -1 if none reaches the threshold.

        With `keys` only windows count that hold all of the template's own key words and none of other licences.
        """
        return self.nearest(terms, k, keys)[0]

    def nearest(self, terms: list[str], k: int, keys: bool = False) -> tuple[int, float]:
        """`slide`, with the window's score."""
        size, vector, best, start, end = min(self.lengths[k], len(terms)), self.vectors[k], self.threshold - 1e-6, -1, -1
        held = np.cumsum([0.0] + [vector.get(w, 0.0) ** 2 for w in terms])
        counts: Counter = Counter()
        norm = dot = 0.0
        for at in np.flatnonzero(held[size:] - held[: len(held) - size] >= self.least - 1e-9).tolist():
            if at != end:  # a new run of windows
                counts, norm, dot = Counter(), 0.0, 0.0
                moves = [(w, 1) for w in terms[at : at + size]]
            else:
                moves = [(terms[at - 1], -1), (terms[at + size - 1], 1)]
            for w, by in moves:
                n = counts[w]
                counts[w] = n + by
                idf = self.idf.get(w, self.unknown)
                old, new = ((1 + log(x)) * idf if x else 0.0 for x in (n, n + by))
                norm += new * new - old * old
                dot += (new - old) * vector.get(w, 0.0)
            end = at + 1
            if dot > 0 and dot / norm**0.5 > best + 1e-9 and not (keys and (any(not counts[w] for w in self.keys[k]) or any(counts[w] for w in self.others[k]))):
                best, start = dot / norm**0.5, at
        return start, best if start >= 0 else 0.0

    def scan(self, text: str | None) -> tuple[str | None, float, str | None]:
        """Licence, score and passage of the best passage of a text; nothing below the threshold."""
        low = (text or "").lower()
        if not (ks := self.possible(TERM.findall(low))):
            return None, 0.0, None
        found = [m for m in TERM.finditer(text) if m[0].lower() not in STOP]
        terms = [m[0].lower() for m in found]
        hits = []
        for k in ks:
            at, score = self.nearest(terms, k, True)
            if at >= 0:
                hits.append((-min(round(score, 9), 1.0), -self.lengths[k], k, at))
        if not hits:
            return None, 0.0, None
        score, size, k, at = min(hits)
        return self.names[k], -score, text[found[at].start() : found[min(at - size, len(found)) - 1].end()]


def scan_files(files: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES) -> DataFrame:
    """The rows of `files`, without text, with own_license, own_score and passage, its last three columns; `files` has text."""
    lean_batches(files.sparkSession)
    names = files.columns
    at = names.index("text")
    own = [free_name(files, n) for n in ("own_license", "own_score", "passage")]
    matcher: list[Matcher] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not matcher:
            matcher.append(Matcher(templates))
        for b in batches:
            found = [matcher[0].scan(t.as_py()) for t in b.column(at)]
            yield pa.RecordBatch.from_arrays([*[c for i, c in enumerate(b.columns) if i != at], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.string())], names=[*[n for n in names if n != "text"], *own])

    fields = [f for f in files.schema.fields if f.name != "text"]
    return files.mapInArrow(run, T.StructType([*fields, *[T.StructField(n, kind) for n, kind in zip(own, (T.StringType(), T.DoubleType(), T.StringType()), strict=True)]]))


def directory(path):
    """The directory of a path, without the last slash; empty for the top."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def inherit(scanned: DataFrame, licence_name: str = r"(?i)^(licen[cs]e|copying|copyright|unlicense)(\.\w+)?$") -> DataFrame:
    """Add license and inherited_from: a file's own licence, or that of the nearest directory above it; `scanned` has path
    and, as its last three columns, what `scan_files` adds."""
    mine, score = scanned.columns[-3:-1]
    kept = scanned.columns
    named = scanned.withColumn("_dir", directory(F.col("path"))).withColumn("_own", F.col(mine)).withColumn("_score", F.col(score))
    base = F.regexp_extract("path", r"([^/]*)$", 1)
    given = named.filter(F.col("_own").isNotNull() & F.col("path").isNotNull() & base.rlike(licence_name))
    owners = given.groupBy("_dir").agg(F.min(F.struct((-F.col("_score")).alias("s"), F.col("path").alias("p"), F.col("_own").alias("o"))).alias("g")).select(F.col("_dir").alias("_at"), F.col("g.o").alias("_license"), F.col("g.p").alias("_from"))
    dirs = named.filter("_dir IS NOT NULL").select("_dir").distinct()
    parts = F.split("_dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    ladder = dirs.select("_dir", F.posexplode(above).alias("_depth", "_at")).distinct()
    nearest = ladder.join(owners, "_at").groupBy("_dir").agg(F.max(F.struct("_depth", "_license", "_from")).alias("n")).select("_dir", "n._license", "n._from")
    own = F.col("_own").isNotNull()
    return named.join(nearest, "_dir", "left").select(*kept, F.coalesce("_own", "_license").alias(free_name(scanned, "license")), F.when(~own, F.col("_from")).alias(free_name(scanned, "inherited_from")))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as files: source/lang/k/id.txt with k = id div 100; the first of each hundred is its LICENSE."""
    docs = table(spark, sf_dir, "documents")
    folder = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), F.floor(F.col("doc_id") / 100).cast("string"))
    name = F.when(F.col("doc_id") % 100 == 0, F.lit("LICENSE")).otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    scanned = materialize(scan_files(docs.select("doc_id", F.concat(folder, F.lit("/"), name).alias("path"), "text")), "licenses")
    return inherit(scanned).select("doc_id", "path", "own_license", "own_score", "license", "inherited_from")

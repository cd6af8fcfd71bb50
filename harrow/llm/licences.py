"""Licence scan: sparse TF-IDF cosine to templates, then inheritance along directories.

Every line of a text (a header is a line or more) and every text as a whole is compared
with the template notices.  Document frequencies are counted over all documents, but only
for the templates' own terms, a list bounded by the templates; any other term weighs as
one that no document has.  The best template at or above the threshold names a file's own
licence.  A file without one takes that of the licence file (by name) in its nearest
ancestor directory: directories are exploded to their ancestors, joined with the licence
directories by path, and only then joined with the files, so a crowded directory is one
row in the search.

Defined cases: null text has no licence but may inherit one; a null path has no directory, one without a slash stands in the root;
of equal scores the licence that sorts first wins, of several licence files in a directory
the best score, then the licence that sorts first; repeated rows stay; empty tables give
empty results; other columns are not read."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.llm.common import lower_ascii, small_batches, stored

TERM_RE = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
THRESHOLD = 0.6
LICENCE_FILES = ("LICENSE", "LICENCE", "COPYING", "NOTICE")

# The short notices of common licences, as their texts ask for them.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not '
                   "use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without "
                     "modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International "
                  "License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial "
                     "4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under "
                "the terms of the GNU General Public License as published by the Free Software "
                "Foundation, either version 3 of the License, or any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files, to deal in the Software without "
            "restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
                "v. 2.0."),
)


def terms(text: str | None) -> list[str]:
    return TERM_RE.findall(lower_ascii(text or ""))


def template_terms() -> set[str]:
    return {t for _, text in TEMPLATES for t in terms(text)}


def document_frequencies(files: DataFrame, text_col: str = "text") -> tuple[int, dict[str, int]]:
    """Rows, and rows that hold each template term (a bounded list)."""
    wanted = template_terms()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter[str] = Counter()
        for batch in batches:
            held[""] += len(batch)
            for text in batch["text"]:
                held.update(wanted.intersection(terms(text)))
        if held:
            yield pd.DataFrame({"term": list(held), "n": list(held.values())})

    rows = (files.select(F.col(text_col).cast("string").alias("text"))
            .mapInPandas(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")))
    found = {r["term"]: r["n"] for r in rows.collect()}
    return found.pop("", 0), found


class Matcher:
    """Cosines of a text's lines, and of the whole text, to the templates."""

    def __init__(self, rows: int, frequency: Mapping[str, int]):
        self.idf = {t: math.log((1 + rows) / (1 + frequency.get(t, 0))) for t in template_terms()}
        self.other = math.log(1 + rows)
        self.index: dict[str, list[tuple[int, float]]] = {}
        self.names = [name for name, _ in TEMPLATES]
        for i, (_, text) in enumerate(TEMPLATES):
            weights = {t: n * self.idf[t] for t, n in Counter(terms(text)).items()}
            norm = math.sqrt(sum(w * w for w in weights.values()))
            for t, w in weights.items():
                if w:
                    self.index.setdefault(t, []).append((i, w / norm))

    def cosines(self, counts: Mapping[str, int]) -> dict[str, float]:
        dots: Counter[int] = Counter()
        norm = 0.0
        for t, n in counts.items():
            norm += (n * self.idf.get(t, self.other)) ** 2
            for i, w in self.index.get(t, ()):
                dots[i] += n * self.idf[t] * w
        out: dict[str, float] = {}
        for i, dot in dots.items():
            out[self.names[i]] = max(out.get(self.names[i], 0.0), dot / math.sqrt(norm))
        return out

    def best(self, text: str | None, threshold: float) -> tuple[str | None, float | None]:
        found: dict[str, float] = {}
        whole: Counter[str] = Counter()
        for line in (text or "").split("\n"):
            counts = Counter(terms(line))
            whole.update(counts)
            for name, score in self.cosines(counts).items():
                found[name] = max(found.get(name, 0.0), score)
        for name, score in self.cosines(whole).items():
            found[name] = max(found.get(name, 0.0), score)
        ranked = sorted((-round(s, 9), name) for name, s in found.items() if round(s, 9) >= threshold)
        return (ranked[0][1], -ranked[0][0]) if ranked else (None, None)


def own_licences(files: DataFrame, threshold: float = THRESHOLD, path_col: str = "path",
                 text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``path``, the columns of ``keep``, ``own_licence`` and ``own_score`` (null: none)."""
    small_batches(files.sparkSession)
    matcher = Matcher(*document_frequencies(files, text_col))

    @F.pandas_udf("licence string, score double")
    def match(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            found = [matcher.best(t, threshold) for t in batch]
            yield pd.DataFrame({"licence": pd.Series([f[0] for f in found], dtype=object),
                                "score": pd.Series([f[1] for f in found], dtype="float64")})

    rows = files.select(F.col(path_col).cast("string").alias("path"), *keep,
                        match(F.col(text_col).cast("string")).alias("m"))
    return rows.select("path", *keep, F.col("m.licence").alias("own_licence"),
                       F.col("m.score").alias("own_score"))


def inherit(owned: DataFrame) -> DataFrame:
    """Adds ``licence`` and ``licence_from`` (the directory it comes from; null if the
    licence is the file's own, or if there is none)."""
    owned = owned.withColumn("__dir", F.regexp_extract("path", r"(?s)^(.*)/[^/]*$", 1))
    named = F.element_at(F.split("path", "/"), -1).isin(*LICENCE_FILES)
    places = (owned.where(named & F.col("own_licence").isNotNull()).groupBy(
        F.col("__dir").alias("__place"))
        .agg(F.min(F.struct((-F.col("own_score")).alias("s"), "own_licence")).alias("m"))
        .select("__place", F.col("m.own_licence").alias("__lic")))
    parts = F.split("__dir", "/")
    above = (owned.where(F.col("own_licence").isNull() & F.col("path").isNotNull())
             .select("__dir").distinct()
             .select("__dir", F.explode(F.transform(
                 F.sequence(F.lit(1), F.size(parts)),
                 lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/")
                                    .alias("at")))).alias("a")))
    nearest = (above.join(places, F.col("a.at") == F.col("__place"))
               .groupBy("__dir").agg(F.max(F.struct(F.col("a.depth"), "__place", "__lic")).alias("m"))
               .select(F.col("__dir").alias("__d"), F.col("m.__place").alias("__from"),
                       F.col("m.__lic").alias("__lic")))
    own = F.col("own_licence").isNotNull()
    return (owned.join(nearest, F.col("__dir") == F.col("__d"), "left")
            .withColumn("licence", F.coalesce("own_licence", "__lic"))
            .withColumn("licence_from", F.when(~own, F.col("__from")))
            .drop("__dir", "__d", "__from", "__lic"))


def scan_licences(files: DataFrame, threshold: float = THRESHOLD, path_col: str = "path",
                  text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per file: ``path``, the columns of ``keep``, ``own_licence``, ``own_score``,
    ``licence`` and ``licence_from``."""
    return inherit(stored(own_licences(files, threshold, path_col, text_col, keep),
                          "licences-own"))

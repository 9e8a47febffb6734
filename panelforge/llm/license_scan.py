"""Licence scan: TF-IDF cosine to templates, and inheritance along directories.

A file is cut into segments at markup tags and line ends.  Every segment, the
file as a whole, and every run of as many terms as a template has, across
segments and inside them, is compared with notice templates by the cosine of
sparse TF-IDF vectors.  Inverse document frequencies of the template terms are counted
over all files; a word of no template weighs as a term that no file has.

A file that is named like a licence file licenses its directory; among web
pages, which have no such names, a page titled with a notice does.  Other files take their own notice, else the licence of
the nearest ancestor directory.  Directories are made distinct before their
ancestors are expanded and joined.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, column, pick

THRESHOLD = 0.6
_CHUNK = 1 << 14  # terms whose runs are bounded at a time
_SLACK = 1e-9     # scores this close are equal

# Short forms of public licence notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
                   "except in compliance with the License. You may obtain a copy of the License at"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files, to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of "
                "the GNU General Public License as published by the Free Software Foundation, either version 3 "
                "of the License, or any later version"),
    ("GPL-3.0", "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation, either version 3 of the License, or any later version"),
    ("LGPL-3.0", "licensed under the GNU Lesser General Public License, version 3"),
    # with the core of the GPL header above it, Lesser alone tells the two headers apart
    ("LGPL-3.0", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
                 "published by the Free Software Foundation, either version 3 of the License, or any later version"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are "
                     "permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
)
LICENSE_NAMES = r"(?i)^(un)?(licen[cs]e|copying|copyright|notice)([.-].*)?$"

_SEGMENT = re.compile(r"<[^<>]*>|\n")  # a < that no > closes before the next < is text
_TERM = re.compile(r"[^\W_]+(?:\.[0-9]+)*")


def terms_of(text: str) -> list[str]:
    return _TERM.findall(text.lower())


class TemplateIndex:
    """Normalised TF-IDF vectors of the templates, by term."""

    def __init__(self, document_counts: dict[str, int], n_files: int, threshold: float = THRESHOLD):
        def idf(count: int) -> float:
            return math.log((1 + n_files) / (1 + count)) + 1
        self.idf = {t: idf(document_counts.get(t, 0)) for t in template_terms()}
        self.unknown = idf(0) ** 2
        self.postings: dict[str, list[tuple[int, float]]] = {}
        for i, (_, text) in enumerate(TEMPLATES):
            weights = {t: n * self.idf[t] for t, n in Counter(terms_of(text)).items()}
            norm = math.sqrt(sum(w * w for w in weights.values()))
            for t, w in weights.items():
                self.postings.setdefault(t, []).append((i, w / norm))
        self.threshold = threshold
        self.lengths = sorted({len(terms_of(text)) for _, text in TEMPLATES})
        # columns of the last row: a term of no template
        self.numbers = {t: k for k, t in enumerate(sorted(self.idf))}
        self.gains = np.zeros((len(self.idf) + 1, len(TEMPLATES)))
        self.squares = np.full(len(self.idf) + 1, self.unknown)
        for t, k in self.numbers.items():
            self.squares[k] = self.idf[t] ** 2
            for i, v in self.postings[t]:
                self.gains[k, i] = self.idf[t] * v
        self.telling = self._telling()

    def _telling(self) -> set[str]:
        """Terms of which a run at the threshold holds one: all other terms of a template together lie below it."""
        out = set()
        for i in range(len(TEMPLATES)):
            total = 0.0
            for v, t in sorted((v, t) for t, found in self.postings.items() for j, v in found if j == i):
                total += v * v
                if total >= self.threshold ** 2 - _SLACK:
                    out.add(t)
        return out

    def runs(self, terms: list[str]) -> Iterator[tuple[float, int, str]]:
        """(cosine, start, licence) of the best run of each length, of equal ones the first; none without a telling term."""
        if self.telling.isdisjoint(terms):
            return
        reach = self.lengths[-1]
        at = np.array([i for i, t in enumerate(terms) if t in self.telling])
        other = len(self.numbers)
        ids = dict(self.numbers)
        numbers = np.array([ids.setdefault(t, len(ids)) for t in terms])
        breaks = np.flatnonzero(np.diff(at) >= 2 * reach)
        for first, last in zip(at[np.r_[0, breaks + 1]], at[np.r_[breaks, len(at) - 1]]):
            high = min(len(terms), last + reach)
            for begin in range(max(0, first - reach + 1), high, _CHUNK):
                part = numbers[begin:min(high, begin + _CHUNK + reach - 1)]
                rows = np.minimum(part, other)
                dots = np.zeros((len(part) + 1, len(TEMPLATES)))
                np.cumsum(self.gains[rows], axis=0, out=dots[1:])
                squares = self.squares[rows]
                norms = np.zeros(len(part) + 1)
                before = np.zeros(len(part))  # of each term, how often it stands in the n - 1 terms before it
                for n in range(1, min(reach, len(part)) + 1):
                    if n > 1:
                        before[n - 1:] += part[n - 1:] == part[:len(part) - n + 1]
                    # a count of c adds c squared, so its last term adds 2 c - 1
                    norms = norms[:-1] + (squares * (1 + 2 * before))[n - 1:]
                    if n in self.lengths:
                        cosines = (dots[n:] - dots[:-n])[:_CHUNK] / np.sqrt(norms[:_CHUNK, None])
                        best = cosines.max(axis=1)
                        i = int(np.argmax(best >= best.max() - _SLACK))
                        k = int(np.argmax(cosines[i] >= best[i] - _SLACK))
                        yield float(best[i]), int(begin + i), TEMPLATES[k][0]

    def notice(self, segments: list[list[str]]) -> tuple[float, str | None]:
        """Best score of a file and its licence; of equal scores the one that begins first."""
        found, start, whole = (0.0, None), 0, []
        for terms in segments:
            score = self.best(terms)
            if score[0] > found[0] + _SLACK:
                found, start = score, len(whole)
            whole += terms
        score = self.best(whole)
        if score[0] > found[0] + _SLACK:
            found, start = score, 0
        for score, begin, name in self.runs(whole):
            if score >= self.threshold - _SLACK and (
                    score > found[0] + _SLACK or score >= found[0] - _SLACK and begin < start):
                found, start = (score, name), begin
        return found

    def best(self, terms: list[str]) -> tuple[float, str | None]:
        """Highest cosine and its licence; of equal ones the first template's."""
        counts = Counter(terms)
        squares, dots = 0.0, {}
        for t, n in counts.items():
            if t in self.idf:
                w = n * self.idf[t]
                squares += w * w
                for i, v in self.postings[t]:
                    dots[i] = dots.get(i, 0.0) + w * v
            else:
                squares += n * n * self.unknown
        if not dots:
            return 0.0, None
        i = max(sorted(dots), key=lambda d: dots[d])
        return dots[i] / math.sqrt(squares), TEMPLATES[i][0]


def template_terms() -> set[str]:
    return {t for _, text in TEMPLATES for t in terms_of(text)}


def _decoded(raw: bytes | None) -> str:
    return (raw or b"").decode("utf-8", "replace")


def _document_counts(files: DataFrame) -> tuple[dict[str, int], int]:
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = template_terms(), Counter()
        for batch in parts:
            for text in column(batch, "text"):
                counts[""] += 1
                counts.update(known.intersection(terms_of(_SEGMENT.sub(" ", _decoded(text)))) if text else ())
        yield pa.RecordBatch.from_pydict({"term": list(counts), "n": list(counts.values())},
                                         pa.schema([("term", pa.string()), ("n", pa.int64())]))

    rows = files.select("text").mapInArrow(batches, "term string, n long").groupBy("term").agg(
        F.sum("n").alias("n")).collect()  # at most one row per template term
    counts = {r["term"]: r["n"] for r in rows}
    return counts, counts.pop("", 0)


def _own_notices(files: DataFrame, index: TemplateIndex, threshold: float) -> DataFrame:
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            found = []
            for text in column(batch, "text"):
                segments = [t for t in map(terms_of, _SEGMENT.split(_decoded(text))) if t]
                opening = bool(segments) and index.best(segments[0])[0] >= threshold
                score, name = index.notice(segments)
                found.append((score, name if score >= threshold else None, opening))
            yield pa.RecordBatch.from_arrays(
                [batch.column("file_id"), batch.column("path"), pa.array([f[0] for f in found], pa.float64()),
                 pa.array([f[1] for f in found], pa.string()), pa.array([f[2] for f in found], pa.bool_())],
                names=["file_id", "path", "score", "license", "opens"])

    return files.mapInArrow(batches, "file_id long, path string, score double, license string, opens boolean")


def license_scan(df: DataFrame, id_col: str, path_col: str, text_col: str,
                 threshold: float = THRESHOLD, titles: bool = False) -> DataFrame:
    """file_id, path, own_license, score, is_license_file, inherited_from, license: one row per row of ``df``.

    ``own_license`` is that of the best template at ``threshold`` or above, in
    a segment, the whole file or a run of terms (``score`` below the threshold
    is that of segments and file alone);
    ``license`` is it, or else that of the nearest ancestor directory with a
    licence file, named in ``inherited_from``.  With ``titles`` a file whose
    first segment is a notice is a licence file too.  Of several licence files in a
    directory the best score decides, then the smallest path.  Null texts have
    no notice; null paths inherit nothing.  Rows that repeat an id or path are
    judged each; other columns are ignored; an empty table gives no rows.
    Malformed UTF-8 is replaced by U+FFFD.  A ``<`` that is not closed before
    the next one is text.
    """
    scratch = Scratch(df.sparkSession, "licenses")
    files = pick(df, file_id=id_col, path=path_col, text=text_col).select(
        F.col("file_id").cast("long"), F.col("path").cast("string"), F.col("text").cast("string").cast("binary"))
    index = TemplateIndex(*_document_counts(files), threshold)
    own = _own_notices(files, index, threshold)
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    folder = F.when(F.col("path").contains("/"), F.regexp_replace("path", r"/[^/]*$", "")).when(
        F.col("path").isNotNull(), F.lit(""))
    licensed = F.col("license").isNotNull() & (
        (F.col("opens") & F.lit(titles)) | F.coalesce(name.rlike(LICENSE_NAMES), F.lit(False)))
    own = scratch.table(own.select("file_id", "path", "score", F.col("license").alias("own_license"),
                                   licensed.alias("is_license_file"), folder.alias("folder")), "own")

    candidates = own.filter("is_license_file AND folder IS NOT NULL")
    top = scratch.table(candidates.groupBy("folder").agg(F.max("score").alias("score")), "top")
    holders = candidates.join(top, ["folder", "score"]).groupBy("folder").agg(
        F.min_by("own_license", F.struct("path", "own_license")).alias("folder_license"))
    holders = scratch.table(holders, "holders")

    # every distinct folder with those of itself and its ancestors that lie as deep as some holder;
    # the driver gets one number per such depth
    def depth(folder: str):
        return F.when(F.col(folder) == "", 0).otherwise(F.size(F.split(folder, "/")))

    depths = sorted(r[0] for r in holders.select(depth("folder")).distinct().collect())
    folders = own.filter("folder IS NOT NULL").select("folder", depth("folder").alias("depth")).distinct()
    level = F.explode(F.from_json(F.lit(str(depths)), "array<int>")).alias("level")
    expanded = folders.select("folder", "depth", level).filter("level <= depth").select(
        "folder", F.expr("substring_index(folder, '/', level)").alias("ancestor"))
    nearest = expanded.join(holders.withColumnRenamed("folder", "ancestor"), "ancestor").groupBy("folder").agg(
        F.max_by(F.struct("ancestor", "folder_license"), F.length("ancestor")).alias("near"))
    nearest = scratch.table(nearest, "nearest")
    out = own.join(nearest, "folder", "left")
    inherits = F.col("own_license").isNull()
    return out.select("file_id", "path", "own_license", F.round("score", 6).alias("score"), "is_license_file",
                      F.when(inherits, F.col("near.ancestor")).alias("inherited_from"),
                      F.coalesce("own_license", "near.folder_license").alias("license"))


def url_path(url_col: str):
    """host/path of a URL without scheme, port, query and fragment; null for a null URL."""
    bare = F.regexp_replace(F.regexp_replace(F.col(url_col).cast("string"), r"[?#].*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    return F.regexp_replace(bare, r"^([^/:]*):[0-9]+", "$1")

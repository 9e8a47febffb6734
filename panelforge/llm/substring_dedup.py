"""Removal of word passages that an earlier document already holds.

Level-wise doubling.  Every window of 50 words is assigned the smallest hash
among the 25-word windows inside it (its anchor); equal windows have equal
anchors.  Only anchors seen in two documents survive the first level, and only
windows with a surviving anchor are extended to 50 words.  Windows repeated at
50 are extended to 100 (two repeated halves), then 200 and so on, until none
survives.  A window is repeated when its hash starts in two documents; the
smallest doc_id keeps it.

Whole-text copies are collapsed to their smallest doc_id first; all words of
the others are covered.  Hot passages are aggregated to (min, max) doc_id
before the shuffle, and joined with one row per hash, so that the other side's
partition can be split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (Scratch, WindowHasher, column, fingerprint, id_and_text, long_lists, mix,
                     numbered, text_key, word_hashes)

WINDOW_WORDS = 50
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling the covered width."""
    covered, out = 1, values
    while covered * 2 <= width:
        out = np.minimum(out[:-covered], out[covered:])
        covered *= 2
    rest = width - covered
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def anchors(hashes: np.ndarray, window: int, windows: WindowHasher) -> np.ndarray:
    """For every window, the least hash of the half-length windows inside it."""
    half = window // 2
    return sliding_least(windows(hashes, half), window - half + 1)


def _profile(docs: DataFrame, window: int) -> DataFrame:
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = WindowHasher()
        for batch in parts:
            counts, prints, digests, found = [], [], [], []
            for text in column(batch, "text"):
                words = text.split() if text else []
                counts.append(len(words))
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
                hashes = word_hashes(words)
                prints.append(fingerprint(hashes.tobytes()))
                found.append(np.unique(anchors(hashes, window, windows))
                             if len(words) >= window else hashes[:0])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(counts, pa.int64()),
                 pa.array([p[0] for p in prints], pa.int64()),
                 pa.array([p[1] for p in prints], pa.int64()), pa.array(digests, pa.string()),
                 long_lists(found)],
                names=["doc_id", "text_key", "n_words", "print_a", "print_b", "sha", "anchors"])

    return docs.mapInArrow(batches, "doc_id long, text_key long, n_words long, print_a long, print_b long, "
                                    "sha string, anchors array<long>")


def _extended(docs: DataFrame, window: int) -> DataFrame:
    """Windows of ``docs`` (doc_id, text, hits) whose anchor is among ``hits``."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = WindowHasher()
        for batch in parts:
            starts, found = [], []
            hits = batch.column("hits")
            for i, text in enumerate(column(batch, "text")):
                hashes = word_hashes(text.split())
                if len(hashes) < window:  # another row with this doc_id has the hits
                    starts.append(np.empty(0, np.int64))
                    found.append(hashes[:0])
                    continue
                wanted = hits[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                at = np.flatnonzero(np.isin(anchors(hashes, window, windows), wanted))
                starts.append(at.astype(np.int64))
                found.append(windows(hashes, window)[at])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), batch.column("text"),
                 long_lists(starts), long_lists(found)],
                names=["doc_id", "text_key", "text", "starts", "hashes"])

    return docs.mapInArrow(batches, "doc_id long, text_key long, text binary, "
                                    "starts array<long>, hashes array<long>")


def _repeated(rows: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(doc_id, hits, removed): per document its hashes that start in two documents, and
    those of them that start in a smaller one."""
    exploded = rows.select("doc_id", F.explode("hashes").alias("hash")).distinct()
    exploded = scratch.table(exploded, f"{name}-windows")
    firsts = scratch.table(
        exploded.groupBy("hash").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .filter("first < last").select("hash", "first"), f"{name}-repeated")
    return scratch.table(
        exploded.join(firsts, "hash").groupBy("doc_id")
        .agg(F.collect_list("hash").alias("hits"),
             F.collect_list(F.when(F.col("doc_id") > F.col("first"), F.col("hash"))).alias("removed")),
        f"{name}-hits")


def _doubled(rows: DataFrame, length: int) -> DataFrame:
    """Windows of twice ``length`` both halves of which are among the row's ``hits``."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            new_starts, new_hashes = [], []
            cols = [batch.column(n) for n in ("starts", "hashes", "hits")]
            for i in range(batch.num_rows):
                starts, hashes, hits = (c[i].values.to_numpy(zero_copy_only=False) for c in cols)
                alive = np.isin(hashes, hits)
                starts, hashes = starts[alive], hashes[alive].view(np.uint64)
                other = np.searchsorted(starts, starts + length)
                inside = other < len(starts)
                inside[inside] = starts[other[inside]] == starts[inside] + length
                first, second = np.flatnonzero(inside), other[inside]
                new_starts.append(starts[first])
                new_hashes.append(mix(hashes[first] * np.uint64(3) + mix(hashes[second])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), long_lists(new_starts),
                 long_lists(new_hashes)], names=["doc_id", "text_key", "starts", "hashes"])

    return rows.mapInArrow(batches, "doc_id long, text_key long, starts array<long>, hashes array<long>")


def _cut_text(text: bytes, starts: np.ndarray, window: int) -> tuple[int, bytes]:
    """Number of words covered by the windows, and the text's other words."""
    words = text.split()
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    keep = np.cumsum(change)[:-1] == 0
    return int(len(words) - keep.sum()), b" ".join(w for w, k in zip(words, keep.tolist()) if k)


def _verdicts(rows: DataFrame, window: int) -> DataFrame:
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            removed, kept = [], []
            cols = [batch.column(n) for n in ("starts", "hashes", "removed")]
            for i, text in enumerate(column(batch, "text")):
                starts, hashes, out = (c[i].values.to_numpy(zero_copy_only=False) for c in cols)
                n, rest = _cut_text(text, starts[np.isin(hashes, out)], window)
                removed.append(n)
                kept.append(rest)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(removed, pa.int64()),
                 pa.array([hashlib.sha256(t).hexdigest() for t in kept], pa.string()),
                 pa.array([t.decode() for t in kept], pa.string())],
                names=["doc_id", "text_key", "n_cut", "cut_sha", "cut_text"])

    return rows.mapInArrow(batches, "doc_id long, text_key long, n_cut long, cut_sha string, "
                                    "cut_text string")


def repeated_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      window: int = WINDOW_WORDS, lengths: bool = True) -> DataFrame:
    """doc_id, text_key, n_words, n_removed, kept_sha256, kept_text, longest_repeat: one row per row of ``df``.

    Words are maximal runs of characters other than ASCII white space.  A word
    goes when it lies in a window of ``window`` words whose words also start in
    a document with a smaller doc_id.  ``kept_text`` is null where nothing was
    removed, else the kept words joined by one space.  ``longest_repeat`` is the
    largest length among window, 2 window, 4 window, ... at which a window of
    the document starts in one with another text (0: none; null for the later
    copies of a whole text, whose every word repeats, and with ``lengths``
    false, which stops the doubling at ``window``).

    Null and blank texts have no words; texts shorter than a window keep all of
    theirs.  Rows that repeat a doc_id do not remove each other's words.  A row
    with a null doc_id keeps its words and removes none.  Other columns are
    ignored.
    """
    scratch = Scratch(df.sparkSession, "substrings")
    docs = id_and_text(df, id_col, text_col).select("doc_id", text_key(), "text")
    profile = scratch.table(_profile(docs, window), "profile")
    prints = ["print_a", "print_b"]
    texts = scratch.table(
        profile.filter((F.col("n_words") >= window) & F.col("doc_id").isNotNull())
        .groupBy(*prints).agg(F.min("doc_id").alias("first"), F.first("anchors").alias("anchors")),
        "texts")

    # First level: anchors seen in two documents.
    seen = texts.select(F.col("first").alias("doc_id"), F.explode("anchors").alias("anchor"))
    repeated = scratch.table(
        seen.groupBy("anchor").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .filter("least < most").select("anchor"), "anchors")
    hits = seen.join(repeated, "anchor").groupBy("doc_id").agg(F.collect_set("anchor").alias("hits"))
    hits = scratch.table(hits, "anchor-hits")

    # Second level: windows of full length, for the documents that have such an anchor.
    rows = scratch.table(_extended(docs.filter("text IS NOT NULL").join(hits, "doc_id"), window),
                         "extended")
    verdict = _repeated(rows, scratch, f"level-{window}")
    cut = scratch.table(_verdicts(
        rows.join(verdict.filter(F.size("removed") > 0).select("doc_id", "removed"), "doc_id"),
        window).dropDuplicates(["doc_id", "text_key"]), "cut")

    longest = None
    if lengths:
        length, current, reached = window, rows.select("doc_id", "text_key", "starts", "hashes"), []
        while verdict.take(1):
            reached.append(verdict.select("doc_id", F.lit(length).cast("long").alias("length")))
            current = scratch.table(
                _doubled(current.join(verdict.select("doc_id", "hits"), "doc_id"), length)
                .filter(F.size("hashes") > 0), f"extended-{2 * length}")
            length *= 2
            verdict = _repeated(current, scratch, f"level-{length}")
        for part in reached:
            longest = part if longest is None else longest.unionByName(part)

    out = (profile.select("doc_id", "text_key", "n_words", *prints, "sha")
           .join(texts.select(*prints, "first"), prints, "left")
           .join(cut, ["doc_id", "text_key"], "left"))
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    n_removed = F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_cut", F.lit(0))).cast("long")
    out = out.select(
        "doc_id", "text_key", "n_words", n_removed.alias("n_removed"),
        F.when(copy, F.lit(_EMPTY_SHA)).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"),
        F.when(copy, F.lit("")).otherwise(F.col("cut_text")).alias("kept_text"), copy.alias("copy"))
    if not lengths:
        return out.withColumn("longest_repeat", F.lit(None).cast("long")).drop("copy")
    if longest is not None:
        longest = scratch.table(longest.groupBy("doc_id").agg(F.max("length").alias("length")), "longest")
        out = out.join(longest, "doc_id", "left")
    else:
        out = out.withColumn("length", F.lit(None).cast("long"))
    return out.withColumn("longest_repeat", F.when(~F.col("copy"), F.coalesce("length", F.lit(0)))
                          .cast("long")).drop("copy", "length")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW_WORDS) -> DataFrame:
    """``df`` with repeated passages cut out of ``text_col``; unchanged texts stay as they are.

    A changed text is the kept words joined by one space.  Rows that lose their
    last word go.
    """
    names, flat = df.columns, numbered(df)
    found = repeated_passages(df, id_col, text_col, window, lengths=False)
    changed = (found.filter("n_removed > 0").dropDuplicates(["doc_id", "text_key"])
               .select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"),
                       F.col("kept_text").alias("_kept")))
    text = f"c{names.index(text_col)}"
    out = flat.join(changed, (F.col(f"c{names.index(id_col)}").cast("long") == F.col("_id"))
                    & (F.xxhash64(F.col(text).cast("string").cast("binary")) == F.col("_key")), "left")
    out = out.filter(F.col("_kept").isNull() | (F.col("_kept") != ""))
    return out.withColumn(text, F.coalesce("_kept", text)).drop("_id", "_key", "_kept").toDF(*names)

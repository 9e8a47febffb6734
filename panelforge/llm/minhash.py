"""Near-duplicate groups by b-bit MinHash.

1. One pass over the texts hashes the distinct word shingles and takes 128
   minima.  Four minima at a time form 32 band keys; of every minimum only the
   low two bits are retained and packed into four longs.
2. Rows with the same shingle set collapse to one representative, so a group
   of copies that holds a third of the rows is one row from here on.
3. Band buckets give candidates.  Each member is first paired with its
   bucket's smallest id; only buckets whose members are not all connected
   after that pair the remaining ones, so a large group of near copies never
   emits all its pairs.
4. A candidate's similarity is estimated from the bit count of the packed
   signatures, corrected for chance agreement (1 in 4); the cut lies six
   standard deviations under the threshold.  A parity sketch of the sets then
   rules out most pairs below the threshold: every shingle flips one of 2,048
   bits, so two sketches never differ in more bits than the sets differ in
   shingles.  Every survivor is confirmed on the full shingle sets.
5. Components of the confirmed links come from large-star/small-star steps.

At a similarity of 0.8 a pair escapes all 32 bands with probability 5e-8.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (Scratch, WindowHasher, column, connected_components, fingerprint, id_and_text,
                     long_lists, mix, numbered, text_key, word_hashes)

SHINGLE_WORDS = 4
THRESHOLD_PERCENT = 80
MINIMA = 128
BAND_ROWS = 4
BITS = 2  # retained of each minimum
CUT_SIGMAS = 6.0
PARITY_BITS = 2048

_random = np.random.default_rng(97)
_XOR = _random.integers(0, 1 << 32, MINIMA, dtype=np.uint32)
_MULTIPLY = _random.integers(0, 1 << 32, MINIMA, dtype=np.uint32) | np.uint32(1)
_BAND_FACTORS = _random.integers(0, 1 << 63, BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CHUNK = 1024
_FIELDS = 64 // BITS  # retained minima in one long


def shingle_set(text: bytes | None, k: int, windows: WindowHasher) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of a text, A-Z lower-cased."""
    words = text.lower().split() if text else []  # bytes: only ASCII letters and white space
    hashes = word_hashes(words)
    return np.unique(windows(hashes, min(k, len(words)))) if words else hashes


def minima(shingles: np.ndarray) -> np.ndarray:
    keys = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    least = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(keys), _CHUNK):
        x = (keys[at:at + _CHUNK, None] ^ _XOR) * _MULTIPLY
        x ^= x >> np.uint32(16)
        np.minimum(least, x.min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    rows = least.reshape(-1, BAND_ROWS).astype(np.uint64)
    return mix((mix(rows) * _BAND_FACTORS).sum(axis=1) + np.arange(len(rows), dtype=np.uint64))


def packed(least: np.ndarray) -> np.ndarray:
    low = (least & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(-1, _FIELDS)
    return np.bitwise_or.reduce(low << np.arange(0, 64, BITS, dtype=np.uint64), axis=1)


def parity_sketch(shingles: np.ndarray) -> np.ndarray:
    odd = np.bincount((shingles >> np.uint64(7)).astype(np.int64) % PARITY_BITS, minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


_PRINTS = ["print_a", "print_b"]


def signatures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """One row per input row: set size, fingerprint of the set, band keys, packed low bits, parities."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = WindowHasher()
        for batch in parts:
            sizes, prints, bands, packs, parities = [], [], [], [], []
            for text in column(batch, "text"):
                shingles = shingle_set(text, shingle_words, windows)
                sizes.append(len(shingles))
                if not len(shingles):
                    prints.append((None, None))
                    bands.append(np.empty(0, np.uint64))
                    packs.append(np.empty(0, np.uint64))
                    parities.append(np.empty(0, np.uint64))
                    continue
                prints.append(fingerprint(shingles.tobytes()))
                least = minima(shingles)
                bands.append(band_keys(least))
                packs.append(packed(least))
                parities.append(parity_sketch(shingles))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()),
                 pa.array([p[0] for p in prints], pa.int64()),
                 pa.array([p[1] for p in prints], pa.int64()), long_lists(bands), long_lists(packs),
                 long_lists(parities)],
                names=["doc_id", "text_key", "n_shingles", "print_a", "print_b", "bands", "signature",
                       "parities"])

    return id_and_text(df, id_col, text_col).select("doc_id", text_key(), "text").mapInArrow(
        batches, "doc_id long, text_key long, n_shingles long, print_a long, print_b long, "
                 "bands array<long>, signature array<long>, parities array<long>")


def _shingle_sets(docs: DataFrame, shingle_words: int) -> DataFrame:
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = WindowHasher()
        for batch in parts:
            sets = [shingle_set(t, shingle_words, windows) for t in column(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), long_lists(sets)],
                                             names=["doc_id", "shingles"])

    return docs.mapInArrow(batches, "doc_id long, shingles array<long>")


def disagreements(left: Column, right: Column) -> Column:
    """How many of the retained minima differ, from two packed signatures."""
    low = 0x5555555555555555
    total = None
    for i in range(MINIMA // _FIELDS):
        x = left[i].bitwiseXOR(right[i])
        one = F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(low)))
        total = one if total is None else total + one
    return total


def estimated_similarity(left: Column, right: Column) -> Column:
    """Share of agreeing minima, less what chance alone gives."""
    chance = 2.0 ** -BITS
    return ((1 - disagreements(left, right) / F.lit(float(MINIMA))) - chance) / (1 - chance)


def _cut(threshold: float) -> float:
    chance = 2.0 ** -BITS
    agree = chance + (1 - chance) * threshold
    sigma = math.sqrt(agree * (1 - agree) / MINIMA) / (1 - chance)
    return threshold - CUT_SIGMAS * sigma


def possible(threshold_percent: int) -> Column:
    """Whether (n, signature, parities) of sides a and b allow the threshold, cheapest test first."""
    n_a, n_b = F.col("n_a"), F.col("n_b")
    differ = None
    for i in range(PARITY_BITS // 64):
        one = F.bit_count(F.col("parities_a")[i].bitwiseXOR(F.col("parities_b")[i]))
        differ = one if differ is None else differ + one
    return ((F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * threshold_percent)
            & (estimated_similarity(F.col("signature_a"), F.col("signature_b")) >= _cut(threshold_percent / 100))
            # of all shingles at most (1 - t) / (1 + t) are in one set only
            & (differ * (100 + threshold_percent) <= (n_a + n_b) * (100 - threshold_percent)))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS,
                    threshold_percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept: one row per row of ``df``.

    Null, empty and blank texts have no shingles and link with nothing; their
    component is their own id.  A text of fewer words than a shingle is one
    shingle.  Rows that repeat a doc_id are placed by their own text each; texts
    that have the same smallest doc_id are one node.  A null doc_id takes part
    in no link of its own: with a text that others share its component is
    theirs and it is not kept, else its component is null and it is kept.
    Other columns are ignored.
    """
    return _placed(df, id_col, text_col, shingle_words, threshold_percent).drop(*_PRINTS)


def _placed(df: DataFrame, id_col: str, text_col: str, shingle_words: int = SHINGLE_WORDS,
            threshold_percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """``near_duplicates`` with the fingerprint of every row's set."""
    spark = df.sparkSession
    scratch = Scratch(spark, "minhash")
    base = scratch.table(signatures(df, id_col, text_col, shingle_words), "signatures")
    prints = _PRINTS
    heads = scratch.table(
        base.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*prints)
        .agg(F.min("doc_id").alias("head"), F.first("n_shingles").alias("n"),
             F.first("bands").alias("bands"), F.first("signature").alias("signature"),
             F.first("parities").alias("parities")), "heads")

    members = heads.select(F.col("head").alias("id"), F.explode("bands").alias("band"))
    buckets = scratch.table(
        members.groupBy("band").agg(F.min("id").alias("first"), F.max("id").alias("last"))
        .filter("first < last").select("band", "first"), "buckets")
    shared = scratch.table(members.join(buckets, "band"), "shared")

    tested = heads.select(F.col("head").alias("id"), "n", "signature", "parities")

    def side(df: DataFrame, name: str) -> DataFrame:
        """``tested`` columns of ``df`` under names of one side of a pair."""
        return df.select(F.col("id").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in df.columns if c != "id"])

    def similar(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that their sizes, estimate and parities allow."""
        out = pairs.join(side(tested, "a"), "a").join(side(tested, "b"), "b")
        return out.filter(possible(threshold_percent)).select("a", "b")

    # Sets of the documents that share a bucket with another text, computed once for both rounds.
    wanted = shared.select(F.col("id").alias("doc_id")).distinct()
    docs = id_and_text(df, id_col, text_col)
    sets = scratch.table(_shingle_sets(docs.join(wanted, "doc_id", "left_semi"), shingle_words),
                         "sets")

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        pairs = scratch.table(pairs, f"{name}-candidates")
        both = (pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a")), "a")
                .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b")), "b"))
        common = F.size(F.array_intersect("set_a", "set_b"))
        both = both.select("a", "b", common.alias("common"),
                           (F.size("set_a") + F.size("set_b")).alias("sizes"))
        return scratch.table(
            both.filter(F.col("common") * 100 >= (F.col("sizes") - F.col("common")) * threshold_percent)
            .select("a", "b").distinct(), f"{name}-links")

    # Round 1: every member with the smallest id of each of its buckets.
    stars = shared.filter("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b"))
    links = confirmed(similar(stars.distinct()), "star")
    parts = scratch.table(connected_components(links, scratch), "parts")

    # Round 2: in buckets that still hold several components, the members outside the largest
    # one with all members of other components.  What a bucket's first id met is already decided.
    placed = shared.join(parts.withColumnRenamed("node", "id"), "id", "left").select(
        "band", "id", "first", F.coalesce("component", "id").alias("component"))
    placed = scratch.table(placed, "placed")
    largest = (placed.groupBy("band", "component").count().groupBy("band")
               .agg(F.max_by("component", F.struct("count", "component")).alias("largest"),
                    F.count(F.lit(1)).alias("components")).filter("components > 1"))
    largest = scratch.table(largest.select("band", "largest"), "largest")
    mixed = scratch.table(placed.join(largest, "band").filter("id <> first").drop("first")
                          .join(tested, "id"), "mixed")
    left = side(mixed.filter("component <> largest"), "a")
    right = side(mixed, "b")
    rest = left.join(
        right, (F.col("band_a") == F.col("band_b")) & (F.col("component_a") != F.col("component_b"))
        & ((F.col("component_b") == F.col("largest_b")) | (F.col("a") < F.col("b")))
        & possible(threshold_percent)).select("a", "b").distinct()
    more = confirmed(rest, "rest")
    if more.take(1):
        parts = scratch.table(connected_components(links.unionByName(more), scratch), "parts")

    classes = scratch.table(
        heads.join(parts.withColumnRenamed("node", "head"), "head", "left")
        .select(*prints, F.coalesce("component", "head").alias("component")), "classes")
    out = base.select("doc_id", "text_key", "n_shingles", *prints).join(classes, prints, "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "text_key", "n_shingles", *prints, component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         **options: int) -> DataFrame:
    """``df`` with one row of every component; all columns stay.

    It is that of the smallest id; of several, that of the smallest text key,
    then of the smallest values in the order of the columns.  Different texts of
    one id are judged each, so none goes with a text it is not linked to.  Rows
    of null id stay only if no row with an id has their set, one for each set.
    Rows without shingles are copies of nothing and all stay.
    """
    names, flat = df.columns, numbered(df)
    scratch = Scratch(df.sparkSession, "survivors")
    text = F.col(f"c{names.index(text_col)}").cast("string").cast("binary")
    flat = flat.withColumns({"_id": F.col(f"c{names.index(id_col)}").cast("long"), "_key": F.xxhash64(text)})

    def same(left: DataFrame, right: DataFrame) -> Column:
        return left["_id"].eqNullSafe(right["_id"]) & (left["_key"] == right["_key"])

    # a component is named by its id; rows of null id alone by their set
    # Written before it is aggregated: an aggregate would share the partitions of the join by
    # set, and a set that many rows have could then not be split.
    placed = scratch.table(_placed(df, id_col, text_col, **options).filter("n_shingles > 0").drop("n_shingles", "kept"), "placed")
    keys = placed.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), *_PRINTS).agg(
        F.count(F.lit(1)).alias("n"), F.first("component_id").alias("component"))
    keys = scratch.table(keys, "keys")
    nameless = F.col("component").isNull()
    named = keys.withColumns({"kind": F.when(nameless, 2).otherwise(0),
                              "a": F.when(nameless, F.col("print_a")).otherwise(F.col("component")),
                              "b": F.when(nameless, F.col("print_b")).otherwise(F.lit(0))})

    # Where an id has several texts, its components are found again with a node for every set.
    several = keys.filter("_id IS NOT NULL").groupBy("_id").agg(
        F.min(F.struct(*_PRINTS)).alias("low"), F.max(F.struct(*_PRINTS)).alias("high")).filter("low <> high")
    again = scratch.table(keys.join(several, "_id", "left_semi").select("component").distinct(), "again")
    if again.take(1):
        sets = keys.join(again, "component", "left_semi").groupBy(*_PRINTS).agg(
            F.min(F.struct(F.col("_id").isNull(), "_id", "_key")).alias("least"))
        sets = scratch.table(sets.select(*_PRINTS, "least._id", "least._key",
                                         F.monotonically_increasing_id().alias("node")), "sets")
        texts = flat.select("_id", "_key", text.alias("text"))
        texts = scratch.table(texts.join(sets, same(texts, sets)).groupBy("node").agg(
            F.min("text").alias("text")), "texts")
        found = near_duplicates(texts, "node", "text", **options).select(
            F.col("doc_id").alias("node"), F.col("component_id").alias("own"))
        found = scratch.table(sets.select(*_PRINTS, "node").join(found, "node").drop("node"), "found")
        own = F.col("own").isNotNull()
        named = named.join(found, _PRINTS, "left").withColumns({
            "kind": F.when(own, 1).otherwise(F.col("kind")), "a": F.coalesce("own", "a"),
            "b": F.when(own, 0).otherwise(F.col("b"))})

    stay = named.groupBy("kind", "a", "b").agg(F.min(F.struct(F.col("_id").isNull(), "_id", "_key")).alias("least"))
    stay = scratch.table(stay.select("least._id", "least._key"), "stay")
    one = scratch.table(keys.filter("n > 1").join(stay, same(keys, stay), "left_semi").select("_id", "_key"), "one")
    gone = keys.join(stay, same(keys, stay), "left_anti").select("_id", "_key").unionByName(one)
    gone = scratch.table(gone, "gone")
    columns = [f"c{i}" for i in range(len(names))]
    out = flat.join(gone, same(flat, gone), "left_anti").select(*columns)
    if one.take(1):
        ordered = [c for c, kind in flat.select(*columns).dtypes if "map<" not in kind and kind != "variant"]
        rows = flat.join(one, same(flat, one), "left_semi").groupBy("_id", "_key").agg(
            F.min_by(F.struct(*columns), F.struct(*ordered)).alias("row"))
        out = out.unionByName(rows.select("row.*"))
    return out.toDF(*names)

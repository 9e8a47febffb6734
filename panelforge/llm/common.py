"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.session import scratch_dir

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))


class Scratch:
    """Intermediate tables of one operator call, in the shared checkpoint folder.

    Writing a table cuts the lineage: a lost executor re-reads it instead of
    repeating what led to it.  The folder goes when the driver JVM ends.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = scratch_dir(spark, label)
        self._count = 0

    def table(self, df: DataFrame, name: str) -> DataFrame:
        self._count += 1
        path = f"{self.root}/{self._count:02d}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with its columns named c0, c1, ... so that no two names clash."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Columns of ``df`` by exact name, under the names given by the keywords."""
    flat, names = numbered(df), df.columns
    return flat.select(*[F.col(f"c{names.index(name)}").alias(alias) for alias, name in columns.items()])


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id`` (long) and ``text`` (UTF-8 bytes); other columns, whatever their names, go."""
    return pick(df, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary"))


def keep_rows(df: DataFrame, text_col: str,
              decide: Callable[[Iterator[list[bytes | None]]], Iterator[list[bool]]]) -> DataFrame:
    """Rows of ``df`` for which ``decide`` is true, decided in the tasks that read them.

    ``decide`` turns lists of texts into lists of verdicts.  All columns stay.
    """
    names, flat = df.columns, numbered(df)
    raw = flat.select("*", F.col(f"c{names.index(text_col)}").cast("string").cast("binary").alias("raw"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            keep = list(chain.from_iterable(decide(pieces_of(column(batch, "raw")))))
            yield batch.drop_columns(["raw"]).filter(pa.array(keep, pa.bool_()))

    return raw.mapInArrow(batches, flat.schema).toDF(*names)


def pieces_of(texts: list[bytes | None], max_bytes: int = 4 << 20) -> Iterator[list[bytes | None]]:
    """Cut a batch so that a piece holds ``max_bytes`` of text or a single longer one."""
    piece, size = [], 0
    for text in texts:
        if piece and size + len(text or b"") > max_bytes:
            yield piece
            piece, size = [], 0
        piece.append(text)
        size += len(text or b"")
    if piece:
        yield piece


def valid_utf8(raw: bytes | None) -> bytes:
    """Well-formed UTF-8: null is empty, malformed bytes become U+FFFD."""
    raw = raw or b""
    try:
        raw.decode()
        return raw
    except UnicodeDecodeError:
        return raw.decode("utf-8", "replace").encode()


def text_key() -> Column:
    """Tells apart the texts of rows that repeat a doc_id."""
    return F.xxhash64("text").alias("text_key")


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that all its bits depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class WindowHasher:
    """64-bit hashes of all windows of k consecutive words; grows its power tables as needed."""

    def __init__(self):
        self._up, self._down = _powers(_MULTIPLIER, 4096), _powers(_INVERSE, 4096)

    def __call__(self, hashes: np.ndarray, k: int) -> np.ndarray:
        n = len(hashes)
        if n < k:
            return np.empty(0, np.uint64)
        if n >= len(self._up):
            self._up, self._down = _powers(_MULTIPLIER, 2 * n), _powers(_INVERSE, 2 * n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * self._up[:n], out=sums[1:])
        return mix((sums[k:] - sums[:n - k + 1]) * self._down[:n - k + 1] + np.uint64(k))


def fingerprint(data: bytes) -> tuple[int, int]:
    """128 bits as two signed longs."""
    digest = xxhash.xxh3_128_digest(data)
    return (int.from_bytes(digest[:8], "little", signed=True),
            int.from_bytes(digest[8:], "little", signed=True))


def long_lists(arrays: list[np.ndarray]) -> pa.ListArray:
    """A list<int64> column from 64-bit arrays."""
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    values = np.concatenate(arrays).view(np.int64) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))


class RecentCache:
    """A bounded per-worker cache: of two generations, the older one goes when the younger is full."""

    def __init__(self, size: int):
        self.size, self.young, self._old = size, {}, {}

    def find(self, key):
        value = self.young.get(key)
        if value is None:
            value = self._old.get(key)
            if value is not None:
                self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self._old, self.young = self.young, {}
        self.young[key] = value


class Entries:
    """Entries of various lengths in one array, fetched by number."""

    def __init__(self, store: np.ndarray, lengths: np.ndarray):
        self.store, self.lengths = store, lengths
        self.starts = np.cumsum(lengths) - lengths

    def row(self, numbers: np.ndarray) -> np.ndarray:
        """The numbered entries one after the other."""
        n = self.lengths[numbers]
        return self.store[np.repeat(self.starts[numbers] - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def distinct(parts: list[list[str]]) -> tuple[np.ndarray, list[str]]:
    """Numbers of all strings of all parts, and the strings by number."""
    flat = np.array([*chain.from_iterable(parts), None], dtype=object)[:-1]  # stays one-dimensional
    codes, found = pd.factorize(flat)
    return codes, list(found)


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component): every node of ``edges`` (a, b) with the smallest node it reaches.

    Alternating large-star and small-star steps.  Each step groups and joins
    the edges on one end, so a node with many neighbours is pre-aggregated and
    its join partition can be split; edges stay distributed throughout.
    """
    def step(directed: DataFrame, name: str) -> DataFrame:
        directed = scratch.table(directed, name)
        least = directed.groupBy("u").agg(F.min("v").alias("least"))
        least = scratch.table(least.withColumn("least", F.least("u", "least")), f"{name}-least")
        return directed.join(least, "u")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
                     .first())

    current = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current = scratch.table(current.filter("u <> v").distinct(), "edges")
    before = state(current)
    while before[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = step(both, "large").filter("v > u AND v <> least")
        large = large.select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        small = step(large, "small")
        small = (small.filter("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
                 .unionByName(small.filter("u <> least")
                              .select("u", F.col("least").alias("v"))).distinct())
        current = scratch.table(small, "stars")
        after = state(current)
        if after == before:
            break
        before = after
    ends = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.unionByName(ends.select(F.col("component").alias("node"), "component")).distinct()

"""Exact ranked lexical search: inner products over sparse ball trees.

A document is a sparse vector of term weights, a query one of term counts, and
the score is their inner product.  Every task builds ball trees over shards of
its documents: a node is a ball with the centroid of its documents and the
radius that holds them.  For a query of counts u, no document below a node of
centroid c and radius r scores more than <u, c> + |u| r.  Only the query's own
terms count, so r may be taken within them: the root of the summed squares of
the largest deviation of each.  Bounds are rounded up beyond the error of
floating point.  Subtrees are visited best bound first until no bound reaches
the k-th score; documents in leaves are scored exactly in whole numbers.  A
task carries its k-th scores from shard to shard, and hands on k rows per query.

The queries are a stated set that meets all documents in blocks of bounded
size.  A block's terms are the only coordinates that its vectors need.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import Scratch, column, id_and_text, pick, pieces_of, valid_utf8

TOP = 10
B_PERCENT = 75                 # how much a document's length counts
QUERY_BLOCK_BYTES = 4 << 20    # text of the queries that are searched together
SHARD_DOCS, SHARD_ENTRIES = 4096, 1 << 20
LEAF_DOCS = 16
_ROUND_UP = 1 + 1e-9           # above the error of a sum of a million products
_SLACK = 1e-9                  # of squared lengths, against cancellation in distances
_NO_ID = 1 << 63               # sorts documents without an id behind all others

_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def terms_of(raw: bytes | None) -> list[bytes]:
    """Runs of ASCII letters, digits and characters beyond ASCII; only A-Z lower-cased."""
    return valid_utf8(raw).translate(_TERM_BYTES).split()


@dataclass(frozen=True)
class Query:
    terms: np.ndarray   # numbers of the terms in the block's vocabulary, ascending
    counts: np.ndarray
    length: float       # Euclidean, rounded up

    @staticmethod
    def of(words: list[bytes], vocabulary: dict[bytes, int]) -> Query:
        found = sorted(Counter(vocabulary[w] for w in words).items())
        terms, counts = np.array(found, np.int64).reshape(-1, 2).T
        return Query(terms, counts, math.sqrt(int((counts ** 2).sum())) * _ROUND_UP)


class BallTree:
    """A binary ball tree over sparse rows of whole, non-negative weights."""

    def __init__(self, lengths: np.ndarray, terms: np.ndarray, weights: np.ndarray, leaf: int = LEAF_DOCS):
        """Rows one after the other: ``lengths`` entries each (at least one) of (term, weight)."""
        self._names, terms = np.unique(terms, return_inverse=True)
        starts = np.cumsum(lengths) - lengths
        squares = np.add.reduceat(weights.astype(np.float64) ** 2, starts)
        order = np.arange(len(lengths))
        self.children: list[tuple[int, int] | None] = []
        self.spans: list[tuple[int, int]] = []
        self.radius: list[float] = []
        entries: list[tuple] = []
        waiting = [(0, len(lengths), None)]
        while waiting:
            low, high, parent = waiting.pop()
            node = len(self.spans)
            self.spans.append((low, high))
            self.children.append(None)
            if parent is not None:
                self.children[parent] = (*(self.children[parent] or ()), node)
            rows = order[low:high]
            n = lengths[rows]
            begins = np.cumsum(n) - n
            at = np.repeat(starts[rows] - begins, n) + np.arange(n.sum())
            own, w = terms[at], weights[at].astype(np.float64)
            centre = np.bincount(own, weights=w, minlength=len(self._names)) / len(rows)
            top = np.zeros(len(self._names))
            np.maximum.at(top, own, w)
            used = np.flatnonzero(top)
            centre_square = float((centre[used] ** 2).sum())
            from_centre = squares[rows] - 2 * np.add.reduceat(w * centre[own], begins) + centre_square
            farthest = int(np.argmax(from_centre))
            slack = _SLACK * (float(squares[rows].max()) + centre_square)
            self.radius.append(math.sqrt(max(float(from_centre[farthest]), 0.0) + slack) * _ROUND_UP)
            # a term's deviation counts upward only: weights are not negative, nor are query counts
            entries.append((used, np.full(len(used), node), centre[used],
                            (np.maximum(top[used] - centre[used], 0) * _ROUND_UP + top[used] * _SLACK) ** 2))
            if len(rows) > leaf:
                # two far documents; each half is nearer to one of them
                def nearness(row: int) -> np.ndarray:
                    pivot = np.zeros(len(self._names))
                    span = slice(starts[row], starts[row] + lengths[row])
                    pivot[terms[span]] = weights[span]
                    return squares[rows] + squares[row] - 2 * np.add.reduceat(w * pivot[own], begins)
                one = nearness(rows[farthest])
                order[low:high] = rows[np.argsort(one - nearness(rows[int(np.argmax(one))]), kind="stable")]
                middle = (low + high) // 2
                waiting += [(middle, high, node), (low, middle, node)]
        self.order = order
        n = lengths[order]
        self._ends = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(starts[order] - self._ends[:-1], n) + np.arange(n.sum())
        self._terms, self._weights = terms[at], weights[at]
        self.radius = np.array(self.radius)
        by_term, node, centre, deviation = map(np.concatenate, zip(*entries))
        sort = np.argsort(by_term, kind="stable")
        self._node, self._centre, self._deviation = node[sort], centre[sort], deviation[sort]
        self._term_ends = np.searchsorted(by_term[sort], np.arange(len(self._names) + 1))

    def _local(self, query: Query) -> tuple[np.ndarray, np.ndarray]:
        """The query's terms that some row holds, in the tree's numbers, and their counts."""
        at = np.searchsorted(self._names, query.terms)
        known = at < len(self._names)
        known[known] = self._names[at[known]] == query.terms[known]
        return at[known], query.counts[known]

    def bounds(self, query: Query) -> np.ndarray:
        """Per node, what no row below it exceeds."""
        terms, counts = self._local(query)
        low, high = self._term_ends[terms], self._term_ends[terms + 1]
        n = high - low
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        nodes, size = self._node[at], len(self.radius)
        inner = np.bincount(nodes, weights=self._centre[at] * np.repeat(counts, n), minlength=size)
        within = np.sqrt(np.bincount(nodes, weights=self._deviation[at], minlength=size))
        return (inner + query.length * np.minimum(within, self.radius)) * _ROUND_UP

    def scores(self, node: int, dense: np.ndarray) -> np.ndarray:
        """Exact scores of a leaf's rows against counts by the tree's terms."""
        low, high = self.spans[node]
        span = slice(self._ends[low], self._ends[high])
        return np.add.reduceat(self._weights[span] * dense[self._terms[span]], self._ends[low:high] - self._ends[low])

    def search(self, query: Query, best: list[tuple[int, int]], ids: list[int], k: int) -> int:
        """Put the tree's rows into the heap ``best`` of the k highest (score, -id); returns the leaves scored."""
        terms, counts = self._local(query)
        dense = np.zeros(len(self._names), np.int64)
        dense[terms] = counts
        bounds = self.bounds(query)
        heap, visited = [(-bounds[0], 0)], 0
        while heap:
            bound, node = heapq.heappop(heap)
            least = best[0][0] if len(best) == k else 1  # only scores above 0 count
            if -bound < least:
                break
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(heap, (max(-bounds[child], bound), child))
                continue
            visited += 1
            found = self.scores(node, dense)
            low = self.spans[node][0]
            for i in np.flatnonzero(found >= least).tolist():
                entry = int(found[i]), -ids[self.order[low + i]]
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return visited


def _vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms with repeats), terms, tfs: occurrences of the vocabulary's terms in every text."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.get
        for batch in parts:
            at, ids = 0, column(batch, "doc_id")
            for raws in pieces_of(column(batch, "text")):
                n, terms, tfs = [], [], []
                for raw in raws:
                    words = terms_of(raw)
                    found, counts = np.unique(np.array([t for t in map(get, words) if t is not None], np.int32),
                                              return_counts=True)
                    n.append(len(words))
                    terms.append(found)
                    tfs.append(counts.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at:at + len(raws)], pa.int64()), pa.array(n, pa.int64()),
                     pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))],
                    names=["doc_id", "n", "terms", "tfs"])
                at += len(raws)

    return docs.mapInArrow(batches, "doc_id long, n long, terms array<int>, tfs array<int>")


def _candidates(vectors: DataFrame, queries: list[Query], weights: np.ndarray, n_docs: int, n_terms: int,
                k: int, b_percent: int) -> DataFrame:
    """query, doc_id, score: the k best documents of every task for every query of the block."""
    def shards(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        kept, docs, size = [], 0, 0
        for batch in parts:
            step = max(1, min(SHARD_DOCS, batch.num_rows))
            for at in range(0, batch.num_rows, step):
                ids, n, terms, tfs = batch.slice(at, step).columns
                lengths = pc.list_value_length(terms).to_numpy()
                kept.append((np.array([_NO_ID if i is None else i for i in ids.to_pylist()], object), n.to_numpy(),
                             lengths, terms.flatten().to_numpy(), tfs.flatten().to_numpy()))
                docs, size = docs + len(lengths), size + int(lengths.sum())
                if docs >= SHARD_DOCS or size >= SHARD_ENTRIES:
                    yield tuple(map(np.concatenate, zip(*kept)))
                    kept, docs, size = [], 0, 0
        if kept:
            yield tuple(map(np.concatenate, zip(*kept)))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in queries]
        for ids, n, lengths, terms, tfs in shards(parts):
            m = 100 - b_percent + (b_percent * n.astype(np.int64) * n_docs) // max(n_terms, 1)
            tfs = tfs.astype(np.int64)
            parts_of_score = weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * np.repeat(m, lengths)))
            counts = parts_of_score > 0
            owner = np.repeat(np.arange(len(lengths)), lengths)[counts]
            used, lengths = np.unique(owner, return_counts=True)
            if not len(used):
                continue
            tree = BallTree(lengths, terms[counts], parts_of_score[counts])
            names = ids[used].tolist()
            for query, found in zip(queries, best):
                tree.search(query, found, names, k)
        rows = [(q, None if -i == _NO_ID else -i, score) for q, found in enumerate(best) for score, i in found]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*rows)], names=["query", "doc_id", "score"])

    return vectors.mapInArrow(batches, "query long, doc_id long, score long")


def _query_blocks(queries: DataFrame, block_bytes: int) -> Iterator[list[Row]]:
    """Rows of ``queries`` in lists of bounded text; the driver fetches one partition at a time."""
    block, size = [], 0
    for row in queries.toLocalIterator():
        block.append(row)
        size += len(row.text or b"") + 64
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def ranked_search(docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  query_id_col: str = "item_id", query_text_col: str = "text", k: int = TOP,
                  b_percent: int = B_PERCENT, block_bytes: int = QUERY_BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents of the highest score above 0 for every row of ``queries``.

    N is the number of documents with a term, L all their terms with repeats, n
    a document's, df the documents that hold a term and tf its occurrences in
    one.  A term weighs w = floor(1000 ln((2N + 2) / (2 df + 1))), and a
    document's score sums w * (10^9 tf div (1000 tf + 8 m)) over the query's
    terms, repeats included, with m = 100 - b + b n N div L.  Ranks start at 1;
    equal scores rank by ascending doc_id, a null one last.

    A null or empty text has no terms: such a document is never found, such a
    query finds nothing and has no rows.  Rows that repeat an id are documents,
    or queries, of their own, repeated queries with ranks of their own; a null
    query id stays null.  Other columns are ignored; without documents or
    queries there are no rows.  Malformed UTF-8 is replaced by U+FFFD.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "ranked-search")
    flat = id_and_text(docs, id_col, text_col)
    asked = pick(queries, item_id=query_id_col, text=query_text_col).withColumn(
        "text", F.col("text").cast("string").cast("binary"))
    id_type = asked.schema["item_id"].dataType
    out = None
    for rows in _query_blocks(asked, block_bytes):
        words = [terms_of(row.text) for row in rows]
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*words)))}
        vectors = scratch.table(_vectors(flat, vocabulary), "vectors")
        n_docs, n_terms = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        # one count per term of the block: bounded by its text
        held = np.zeros(len(vocabulary), np.int64)
        for term, df in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            held[term] = df
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in held.tolist()], np.int64)
        found = _candidates(vectors, [Query.of(w, vocabulary) for w in words], weights, n_docs, n_terms, k, b_percent)
        place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
        found = scratch.table(found.withColumn("rank", place).filter(F.col("rank") <= k), "found")
        names = spark.createDataFrame([(i, row.item_id) for i, row in enumerate(rows)], StructType(
            [StructField("query", LongType()), StructField("item_id", id_type)]))
        found = found.join(names, "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], StructType([StructField("item_id", id_type)])).select(
            "item_id", *[F.lit(None).cast(t).alias(c) for c, t in (("rank", "int"), ("doc_id", "long"), ("score", "long"))])
    return out

"""Benchmark decontamination with an FM-index per training shard.

A task cuts its documents into shards of bounded size, maps words to the
numbers of the phrase vocabulary and indexes the runs of known words that are
long enough to hold a phrase: suffix array, Burrows-Wheeler transform and a
wavelet tree over it.  All phrases are searched backward together, one wavelet
rank per step; occurrences are located by walking to sampled suffix positions,
and overlapping occurrences merge into removal spans.

The phrases are a stated query set.  They go to the tasks in blocks of bounded
size, one block per pass over the documents; a pass shuffles nothing and no
document leaves its task.  The hits of further passes, few rows without texts,
are written and join the first pass's by document.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, column, id_and_text, keep_rows, numbered, pick, pieces_of, text_key

WINDOW_WORDS = 13
SHARD_WORDS = 1 << 18      # indexed words of a shard; a longer document is a shard of its own
BLOCK_BYTES = 4 << 20      # benchmark text in one block of phrases
SAMPLE_EVERY = 16          # suffix positions kept for locating

# Delimiters become spaces, A-Z lower case, in one pass over the UTF-8 bytes.
_WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else
                    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
                    for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased."""
    return text.translate(_WORD_BYTES).split() if text else []


class WaveletTree:
    """Rank of a symbol in a prefix, one bit of the symbol per level."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.depth = max(1, int(sigma - 1).bit_length())
        self.ones, self.zeros = [], []
        for level in range(self.depth - 1, -1, -1):
            bits = (symbols >> level) & 1
            ones = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(bits, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(symbols) - int(ones[-1]))
            # all rows of bit 0 before all rows of bit 1, in order
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before position ``end`` (elementwise)."""
        start = np.zeros_like(end)
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = (symbol >> (self.depth - 1 - k)) & 1
            up_start, up_end = ones[start], ones[end]
            start = np.where(bit == 1, zeros + up_start, start - up_start)
            end = np.where(bit == 1, zeros + up_end, end - up_end)
        return end - start


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start positions in suffix order, by prefix doubling; the last symbol is the unique least."""
    rank, width, n = symbols.astype(np.int64), 1, len(symbols)
    while True:
        second = np.zeros(n, np.int64)
        second[:n - width if width < n else 0] = rank[width:] + 1
        key = rank * (n + int(symbols.max()) + 2) + second
        order = np.argsort(key, kind="stable")
        placed = key[order]
        new = np.zeros(n, np.int64)
        new[order] = np.cumsum(np.r_[False, placed[1:] != placed[:-1]])
        if new[order[-1]] == n - 1:
            return order
        rank, width = new, width * 2


class FMIndex:
    """Backward search over a sequence of small numbers (>= 1; 0 is the end mark)."""

    def __init__(self, sequence: np.ndarray, sigma: int, sample_every: int = SAMPLE_EVERY):
        symbols = np.append(sequence, 0).astype(np.int64)
        order = suffix_array(symbols)
        self.n = len(symbols)
        self.bwt = symbols[order - 1]  # position -1 wraps to the end mark
        self.tree = WaveletTree(self.bwt, sigma)
        self.before = np.zeros(sigma + 1, np.int64)
        np.cumsum(np.bincount(symbols, minlength=sigma), out=self.before[1:])
        self.sampled = order % sample_every == 0
        self.sample_rank = np.cumsum(self.sampled) - 1
        self.samples = order[self.sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [lo, hi) of the phrases (rows, right-aligned in the matrix)."""
        lo = np.zeros(len(phrases), np.int64)
        hi = np.full(len(phrases), self.n, np.int64)
        width = phrases.shape[1]
        for back in range(1, width + 1):
            live = np.flatnonzero((lengths >= back) & (lo < hi))
            if not len(live):
                break
            symbol = phrases[live, width - back]
            lo[live] = self.before[symbol] + self.tree.rank(symbol, lo[live])
            hi[live] = self.before[symbol] + self.tree.rank(symbol, hi[live])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows, by stepping left to a sampled position."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        out = np.full(len(rows), -1, np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            done = self.sampled[rows[open_]]
            at = open_[done]
            out[at] = self.samples[self.sample_rank[rows[at]]] + steps[at]
            open_ = open_[~done]
            symbol = self.bwt[rows[open_]]
            rows[open_] = self.before[symbol] + self.tree.rank(symbol, rows[open_])
            steps[open_] += 1
        return out


class PhraseBlock:
    """The distinct windows of some benchmark items, as rows of word numbers."""

    def __init__(self, items: list[tuple[object, bytes]], window: int):
        self.words: dict[bytes, int] = {}
        rows: dict[tuple[int, ...], set] = {}
        for item, text in items:
            ids = [self.words.setdefault(w, len(self.words) + 2) for w in words_of(text)]
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1 if ids else 0):
                rows.setdefault(tuple(ids[i:i + size]), set()).add(item)
        self.owners = [sorted(str(i) for i in found if i is not None) for found in rows.values()]
        self.lengths = np.array([len(r) for r in rows], np.int64)
        self.shortest = int(self.lengths.min()) if rows else 0
        self.phrases = np.zeros((len(rows), window), np.int64)
        for i, row in enumerate(rows):
            self.phrases[i, window - len(row):] = row
        self.sigma = len(self.words) + 2


def _runs(ids: np.ndarray, shortest: int) -> list[tuple[int, int]]:
    """Maximal runs of known words (ids > 0) that can hold a phrase."""
    edge = np.diff(np.concatenate([[0], (ids > 0).view(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long_ = ends - starts >= shortest
    return list(zip(starts[long_].tolist(), ends[long_].tolist()))


def _search_shard(runs: list[tuple[int, int, np.ndarray]], block: PhraseBlock,
                  found: dict[int, list[tuple[int, int, int]]]) -> None:
    """Add (start, end, phrase) per document for the shard's runs (document, start, ids)."""
    parts, origin = [], []
    for doc, start, ids in runs:
        parts += [ids, np.ones(1, np.int64)]  # 1 parts the runs and is in no phrase
        origin.append((doc, start))
    index = FMIndex(np.concatenate(parts), block.sigma)
    lo, hi = index.search(block.phrases, block.lengths)
    counts = hi - lo
    if not counts.any():
        return
    which = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = index.locate(lo[which] + within)
    begins = np.cumsum([0] + [len(ids) + 1 for _, _, ids in runs])
    run = np.searchsorted(begins, at, side="right") - 1
    for phrase, pos, r in zip(which.tolist(), at.tolist(), run.tolist()):
        doc, start = origin[r]
        begin = start + pos - int(begins[r])
        found.setdefault(doc, []).append((begin, begin + int(block.lengths[phrase]), phrase))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int,
            block_bytes: int) -> Iterator[PhraseBlock]:
    """Phrase blocks one by one; the driver holds one, and one partition of items, at a time."""
    items = pick(benchmark, item=id_col, text=text_col).select(
        F.col("item").cast("string"), F.col("text").cast("string").cast("binary")).filter("text IS NOT NULL")
    rows, size = [], 0
    for row in items.toLocalIterator():
        rows.append((row[0], bytes(row[1])))
        size += len(row[1])
        if size >= block_bytes:
            yield PhraseBlock(rows, window)
            rows, size = [], 0
    if rows:
        yield PhraseBlock(rows, window)


def _judge(raws: list[bytes | None], block: PhraseBlock | None, shard_words: int) -> Iterator[tuple[int, list, set[str]]]:
    """(words, merged spans, items) of every text."""
    texts = [words_of(t) for t in raws]
    found: dict[int, list[tuple[int, int, int]]] = {}
    if block is not None and len(block.lengths):
        get = block.words.get
        runs, size = [], 0
        for doc, words in enumerate(texts):
            ids = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
            for begin, end in _runs(ids, block.shortest):
                runs.append((doc, begin, ids[begin:end]))
                size += end - begin + 1
            if size >= shard_words:
                _search_shard(runs, block, found)
                runs, size = [], 0
        if runs:
            _search_shard(runs, block, found)
    for doc, words in enumerate(texts):
        hits = found.get(doc, ())
        items = set().union(*(block.owners[phrase] for phrase in {p for _, _, p in hits}))
        yield len(words), merged([(b, e) for b, e, _ in hits]), items


_HITS = "doc_id long, text_key long, n_words long, spans array<struct<start:int,end:int>>, items array<string>"
_SPANS_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _pass(docs: DataFrame, block: PhraseBlock | None, shard_words: int, hits_only: bool) -> DataFrame:
    """The hits of one block in every document, or in those that have some."""
    handle = docs.sparkSession.sparkContext.broadcast(block)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            found = [v for piece in pieces_of(column(batch, "text")) for v in _judge(piece, handle.value, shard_words)]
            out = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array([n for n, _, _ in found], pa.int64()),
                 pa.array([[{"start": b, "end": e} for b, e in spans] for _, spans, _ in found], _SPANS_ARROW),
                 pa.array([sorted(items) for _, _, items in found], pa.list_(pa.string()))],
                names=["doc_id", "text_key", "n_words", "spans", "items"])
            yield out.filter(pa.array([bool(spans) for _, spans, _ in found], pa.bool_())) if hits_only else out

    return docs.mapInArrow(batches, _HITS)


def _added_up(docs: DataFrame, blocks: Iterator[PhraseBlock], shard_words: int) -> DataFrame:
    """doc_id, text_key, n_words, spans, items of every row of ``docs`` against all blocks."""
    first = _pass(docs, next(blocks, None), shard_words, False)
    scratch, more = None, None
    for block in blocks:
        scratch = scratch or Scratch(docs.sparkSession, "phrases")
        found = scratch.table(_pass(docs, block, shard_words, True).drop("n_words").distinct(), "hits")
        more = found if more is None else more.unionByName(found)
    if more is None:
        return first
    # one row per document and block with hits: rows that repeat an id and a text were made one
    more = scratch.table(more.groupBy("doc_id", "text_key").agg(
        F.flatten(F.collect_list("spans")).alias("more_spans"), F.flatten(F.collect_list("items")).alias("more_items")), "more")
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.text_key") == F.col("b.text_key"))
    empty = [F.array().cast(more.schema[c].dataType) for c in ("more_spans", "more_items")]
    return first.alias("a").join(more.alias("b"), same, "left").select(
        "a.doc_id", "a.text_key", "n_words", _merged(F.concat("spans", F.coalesce("more_spans", empty[0]))).alias("spans"),
        F.array_sort(F.array_distinct(F.concat("items", F.coalesce("more_items", empty[1])))).alias("items"))


def _merged(spans: Column) -> Column:
    """``merged`` for a column of spans: in order, overlapping or touching ones made one."""
    def add(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        joined = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(wider))
        return F.when(F.size(done) == 0, F.array(span)).when(span["start"] <= last["end"], joined).otherwise(
            F.concat(done, F.array(span)))
    return F.aggregate(F.array_sort(spans), F.array().cast("array<struct<start:int,end:int>>"), add)


def contaminated(n_words: int, n_hit: int) -> bool:
    """A twentieth of the words or more lies in benchmark phrases."""
    return n_hit > 0 and 20 * n_hit >= n_words


def contamination(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text",
                  window: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES,
                  shard_words: int = SHARD_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans: one row per row of ``df``.

    A phrase is ``window`` consecutive words of an item, or a shorter item as a
    whole.  ``spans`` are the merged word ranges [start, end) covered by phrase
    occurrences, ``n_hit`` the words in them, ``n_items`` the items with an
    occurring phrase; ``items_sha256`` hashes their ids, sorted as strings and
    comma-joined.  The phrases of an item without an id count in ``n_hit``, but
    it is no named item.  Null and empty texts have no words and no hits; items
    without words, and an empty benchmark, match nothing.  Several items with
    one phrase all count; rows that repeat an id are judged by their own text.
    Other columns are ignored; an empty ``df`` gives no rows.
    """
    docs = id_and_text(df, id_col, text_col).select("doc_id", text_key(), "text")
    found = _added_up(docs, _blocks(benchmark, item_id_col, item_text_col, window, block_bytes), shard_words)
    found = found.withColumn("n_hit", _n_hit())
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        _contaminated().alias("contaminated"), "spans")


def _n_hit() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def _contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def decontaminate(df: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` without its contaminated rows; the others stay as they are, with all columns.

    Every row is judged by its text alone, so rows without an id, or that repeat
    one, are judged each; null and empty texts stay.  An empty benchmark removes
    nothing, an empty ``df`` stays empty.
    """
    blocks = _blocks(benchmark, "item_id", "text", WINDOW_WORDS, BLOCK_BYTES)
    first, second = next(blocks, None), next(blocks, None)
    if second is None:
        handle = df.sparkSession.sparkContext.broadcast(first)

        def decide(pieces: Iterator[list[bytes | None]]) -> Iterator[list[bool]]:
            for piece in pieces:
                yield [not contaminated(n, sum(e - b for b, e in spans))
                       for n, spans, _ in _judge(piece, handle.value, SHARD_WORDS)]

        return keep_rows(df, text_col, decide)
    # of several blocks a row's hits must be added up first: by text, told apart by two hashes
    handed = [b for b in (first, second) if b is not None]
    names, flat = df.columns, numbered(df)
    text = F.col(f"c{names.index(text_col)}").cast("string").cast("binary")
    keyed = flat.withColumns({"doc_id": F.xxhash64(F.lit(1), text), "text_key": F.xxhash64(text)})
    docs = keyed.select("doc_id", "text_key", text.alias("text"))
    found = _added_up(docs, chain(handed, blocks), SHARD_WORDS).withColumn("n_hit", _n_hit())
    gone = Scratch(df.sparkSession, "contaminated").table(
        found.filter(_contaminated()).select("doc_id", "text_key").distinct(), "gone")
    return keyed.join(gone, ["doc_id", "text_key"], "left_anti").select(flat.columns).toDF(*names)

"""Packing token sequences by Karmarkar-Karp multiway differencing.

A document longer than a window gives full windows; what is left of it, or a
shorter document whole, is a piece to be packed.  Pieces are gathered into
blocks of a fixed number of windows.  Differencing then deals a block's pieces
out: every piece starts as a partial partition that holds it in one window,
and the two partial partitions of the largest spread merge, the fullest window
of one with the emptiest of the other, until one partition is left.  Its
windows are nearly equal; when one exceeds the capacity the block gets another
window.

Documents may be cut anywhere, so a block is cut to fill its windows exactly,
and some of its longest pieces are halved again and again: the small pieces
come last in differencing and level the windows out.  What remains at the end
of a task beyond whole windows goes into sequences whose lengths are powers of two.

Blocks are made by the tasks that read the documents: nothing is shuffled, and
a task holds one block and one batch of texts.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import itemgetter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Entries, column, id_and_text, pieces_of

RANKS = "byte_bpe_50k.tiktoken"        # the vocabulary of byte_bpe_50k.json
SPECIALS = {"<|endoftext|>": 50256}    # fixed value: its added token
WINDOW = 2048
END_ID = 1
BLOCK_WINDOWS = 64
_BATCH_BYTES = 16 << 20
_first = itemgetter(0)


class TokenIds:
    """Ids of whole texts under a byte-level BPE; each distinct stretch of a batch is encoded once.

    A single space between two characters that are no white space always
    starts a pre-token, so a text's ids are those of its first stretch and
    those of every other stretch with a space in front.  Only the first token
    of such a stretch starts with a space, which tells the stretches apart
    when all are encoded in one call.
    """

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self._encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                           special_tokens=SPECIALS)
        self._starts_with_space = np.zeros(self._encoding.n_vocab, bool)
        self._starts_with_space[[rank for token, rank in ranks.items() if token.startswith(b" ")]] = True

    def whole(self, text: str) -> np.ndarray:
        return self._encoding.encode_to_numpy(text, allowed_special="all")

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        parts = pc.split_pattern(pa.array(texts, pa.string()), " ")
        ends, values = parts.offsets.to_numpy().tolist(), parts.values.dictionary_encode()
        found, codes = values.dictionary, values.indices.to_numpy()
        # stretches whose ends are white space, or that may hold a special string, are not independent
        odd = pc.or_(pc.equal(pc.binary_length(found), 0), pc.not_equal(pc.utf8_trim_whitespace(found), found))
        for special in SPECIALS:
            odd = pc.or_(odd, pc.match_substring(found, special))
        odd = odd.to_numpy(zero_copy_only=False)
        plain = found.filter(pa.array(~odd))
        ids, lengths = np.empty(0, np.uint32), np.zeros(len(found), np.int64)
        if len(plain):
            line = pc.binary_join(pa.ListArray.from_arrays([0, len(plain)], plain), " ")[0].as_py()
            ids = self._encoding.encode_to_numpy(" " + line, allowed_special="all")
            starts = np.flatnonzero(self._starts_with_space[ids])
            if len(starts) != len(plain):
                raise ValueError("a stretch has other than one token that starts with a space")
            lengths[~odd] = np.diff(np.append(starts, len(ids)))
        entries = Entries(ids, lengths)
        for text, begin, end in zip(texts, ends, ends[1:]):
            own = codes[begin:end]
            if odd[own].any():
                yield self.whole(text)
            else:
                yield np.concatenate([self.whole(text[:text.find(" ")] if len(own) > 1 else text),
                                      entries.row(own[1:])])


@dataclass(frozen=True, slots=True)
class Piece:
    doc: int    # number of the document within its task
    start: int
    length: int

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, at), Piece(self.doc, self.start + at, self.length - at)


def difference(sizes: list[int], windows: int) -> list[tuple[int, list[int]]]:
    """(total, members) of every window that holds something, fullest first.

    Partial partitions are lists of (total, members), fullest first, without
    their empty windows; members are a tree of pairs.
    """
    heap = [(-size, i, [(size, i)]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    made = len(sizes)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        if len(a) + len(b) <= windows:
            merged = a + b
        else:  # the fullest of one side stand alone, the others meet the other side's fullest in reverse
            alone_a, alone_b = windows - len(b), windows - len(a)
            merged = a[:alone_a] + b[:alone_b]
            merged += [(x + y, (m, n)) for (x, m), (y, n) in zip(a[alone_a:], reversed(b[alone_b:]))]
        merged.sort(key=_first, reverse=True)
        emptiest = merged[-1][0] if len(merged) == windows else 0
        heapq.heappush(heap, (emptiest - merged[0][0], made, merged))
        made += 1
    return [(total, _members(tree)) for total, tree in heap[0][2]] if heap else []


def _members(tree) -> list[int]:
    out, stack = [], [tree]
    while stack:
        node = stack.pop()
        if isinstance(node, tuple):
            stack += node
        else:
            out.append(node)
    return sorted(out)


def halved(pieces: list[Piece], count: int) -> list[Piece]:
    """The ``count`` longest pieces cut in half, what is left of each again, down to single tokens."""
    order = sorted(pieces, key=lambda p: (-p.length, p.doc, p.start))
    out = order[count:]
    for piece in order[:count]:
        while piece.length > 1:
            half, piece = piece.cut((piece.length + 1) // 2)
            out.append(half)
        out.append(piece)
    return sorted(out, key=lambda p: (p.doc, p.start))


def level_windows(pieces: list[Piece], capacity: int) -> list[list[Piece]]:
    """Deal pieces out to nearly equal windows of at most ``capacity`` tokens."""
    windows = -(-sum(p.length for p in pieces) // capacity)
    for cut in (windows // 2, windows):
        dealt = halved(pieces, cut)
        parts = difference([p.length for p in dealt], windows)
        if not parts or parts[0][0] <= capacity:
            break
    while parts and parts[0][0] > capacity:
        windows += 1
        parts = difference([p.length for p in dealt], windows)
    return [[dealt[i] for i in members] for _, members in parts]


def take(pieces: list[Piece], tokens: int) -> list[Piece]:
    """Remove the last ``tokens`` tokens from ``pieces``, cutting one where needed, and return them."""
    taken = []
    while tokens:
        piece = pieces.pop()
        if piece.length > tokens:
            kept, piece = piece.cut(piece.length - tokens)
            pieces.append(kept)
        taken.append(piece)
        tokens -= piece.length
    return taken[::-1]


class Packer:
    """Sequences (lists of pieces) from documents added one by one."""

    def __init__(self, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS):
        self._window, self._block = window, window * block_windows
        self._pending: list[Piece] = []
        self._tokens = 0

    def add(self, doc: int, length: int) -> Iterator[list[Piece]]:
        whole = length - length % self._window
        for start in range(0, whole, self._window):
            yield [Piece(doc, start, self._window)]
        if length > whole:
            self._pending.append(Piece(doc, whole, length - whole))
            self._tokens += length - whole
        if self._tokens >= self._block:
            self._tokens -= self._block
            rest = take(self._pending, self._tokens)
            yield from level_windows(self._pending, self._window)
            self._pending = rest

    def close(self) -> Iterator[list[Piece]]:
        rest, size = self._tokens % self._window, 1
        while rest:
            if rest & 1:
                yield take(self._pending, size)
            rest, size = rest >> 1, size << 1
        yield from level_windows(self._pending, self._window)
        self._pending, self._tokens = [], 0

    def waiting(self) -> set[int]:
        """The documents that pieces of the open block belong to."""
        return {piece.doc for piece in self._pending}


_TOKENIZERS: dict[str, TokenIds] = {}  # one per worker process and file


def _token_ids(path: str) -> TokenIds:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = TokenIds(path)
    return _TOKENIZERS[path]


def pack_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   end_id: int = END_ID, ranks: str = RANKS, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id, offset: one row per piece.

    A document is its text's ids and then ``end_id``; a null or empty text is
    that id alone.  Its pieces, in order of ``start``, hold each id once.
    ``ids`` are the piece's ids as little-endian unsigned 32-bit numbers.  A
    sequence holds the pieces of its ``sequence_id``, one after the other from
    ``offset`` 0, at most ``window`` tokens.  ``window`` must be a power of two
    where the short last sequences of a task are to need no padding.

    Rows that repeat an id, or have none, are documents of their own; other
    columns are ignored; an empty table gives no rows.  Malformed UTF-8 is
    replaced by U+FFFD.  Sequence ids tell the task's partition and a counter,
    so they depend on how ``df`` is partitioned; where its plan shuffles, write
    it first, so that a task that runs again meets the same rows.
    ``ranks`` is a ``.tiktoken`` file name of the public tokenizers or a path
    that every executor can read.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _token_ids(ranks if "/" in ranks else public_tokenizers.path(ranks))
        packer, docs, number = Packer(window, block_windows), {}, 0
        sequence = TaskContext.get().partitionId() << 32

        def rows(sequences: Iterator[list[Piece]]) -> Iterator[tuple]:
            nonlocal sequence
            for pieces in sequences:
                offset = 0
                for piece in pieces:
                    doc_id, ids = docs[piece.doc]
                    yield (doc_id, piece.start, piece.length, ids[piece.start:piece.start + piece.length].tobytes(),
                           len(ids), sequence, offset)
                    offset += piece.length
                sequence += 1

        for batch in parts:
            owners = iter(column(batch, "doc_id"))
            for raws in pieces_of(column(batch, "text"), _BATCH_BYTES):
                texts, out = [(raw or b"").decode("utf-8", "replace") for raw in raws], []
                for doc_id, ids in zip(islice(owners, len(texts)), encode(texts)):
                    docs[number] = doc_id, np.append(ids, np.uint32(end_id))
                    out += rows(packer.add(number, len(ids) + 1))
                    number += 1
                docs = {d: docs[d] for d in packer.waiting()}
                if out:
                    yield _batch(out)
        out = list(rows(packer.close()))
        if out:
            yield _batch(out)

    return id_and_text(df, id_col, text_col).mapInArrow(batches, _SCHEMA)


_SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
           "offset long")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=names)


def packed_sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, n_tokens, ids: the sequences put together from the rows of ``pack_documents``.

    One row per sequence; a sequence is at most one window, whatever its documents.
    """
    part = F.struct("offset", "ids")
    return (pieces.groupBy("sequence_id")
            .agg(F.sum("length").alias("n_tokens"), F.array_sort(F.collect_list(part)).alias("parts"))
            .select("sequence_id", "n_tokens", F.aggregate(
                "parts", F.lit(b""), lambda made, p: F.concat(made, p["ids"])).alias("ids")))

"""SentencePiece encoding and decoding with N-best segmentations.

A text with one space put in front is a lattice of vocabulary pieces.  Forward Viterbi gives every position the best score of
reaching it; a backward A-star search from the end uses these scores as exact
heuristics, so it pops complete segmentations in order of score and expands
nothing beyond the N best.

No piece of the vocabulary has a space after another character, so the lattice
falls apart where a space follows a word.  The N best of a text combine the N
best of its stretches, and only the N - 1 stretches whose second best loses
least can differ from the best.  A Viterbi pass in either direction, over all
distinct stretches of a batch side by side (``piece_batch``), gives each its best
segmentation and that loss; the A-star search runs where alternatives can count.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import Entries, RecentCache, column, distinct, id_and_text, numbered, pieces_of
from .piece_batch import LONGEST, PieceTrie, best_of

MODEL = "piece_bpe_32k.model"
N_BEST = 4
_SPACE = "▁"  # how the model's file writes a space
_STRETCH = re.compile(" *[^ ]+| +")
_CACHE_STRETCHES = 20_000   # searched ones, in each of the two generations that a worker keeps
_CACHE_CHARS = 48           # longer stretches are searched each time
_NEVER = 1 << 60            # the loss of a second segmentation where there is none

Segmentation = tuple[int, tuple[int, ...]]           # loss against the best, piece ids
Change = tuple[int, int, tuple[int, ...]]            # from this position, so many ids, become these
Best = tuple[int, int, tuple[int, ...]]
Forward = tuple[str, list[list], list[int], list[tuple]]


class PieceLattice:
    """N-best segmentation with the scores stored in a SentencePiece model.

    Where no piece spells a character it is written as byte pieces; each costs
    more than the rarest piece.  So is U+2581, by which the model's file writes
    spaces, when it stands in a text: decoding stays exact.  Scores are whole numbers, so sums are exact;
    segmentations of equal score come in the order the search meets them, which
    is always the same for the same text.
    """

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: dict[str, tuple[int, tuple[int]]] = {}
        self.bytes: dict[int, int] = {}
        spelled: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:-1], 16)] = i
                spelled.append(bytes([int(piece[3:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                spelled.append(b"")
            else:
                piece = piece.replace(_SPACE, " ")
                if " " in piece.lstrip(" "):
                    raise ValueError("a piece spans a space: stretches would not be independent")
                self.pieces[piece] = (round(model.get_score(i)), (i,))
                spelled.append(piece.encode())
        self._spelled = Entries(np.frombuffer(b"".join(spelled), np.uint8), np.array(list(map(len, spelled))))
        self.longest = max(map(len, self.pieces))
        ordinary = [s for s, _ in self.pieces.values() if s > -10 ** 8]  # white-space runs lie below
        self.byte_score = min(ordinary) - 1
        # every ending of a piece; None where it is not a piece itself
        self._ends = {p[i:]: None for p in self.pieces for i in range(1, len(p))} | self.pieces
        self._searched = RecentCache(_CACHE_STRETCHES)
        self._trie = PieceTrie(self.pieces)
        self._byte_ids = np.array([self.bytes[b] for b in range(256)], np.int32)

    def forward(self, text: str, before: Forward | None = None) -> Forward:
        """Per end position: the edges (start, score, ids) that arrive, latest start first, the best
        score, and its edge (of equal ones, that with the latest start).

        What ``before``, the pass over another text, has for a common prefix is taken over.
        """
        n, longest, find, same = len(text), self.longest, self._ends.get, 0
        incoming, scores, last = [[]], [0], [()]
        if before:
            other = before[0]
            for a, b in zip(text, other):
                if a != b:
                    break
                same += 1
            incoming, scores, last = (kept[:same + 1] for kept in before[1:])
        for end in range(same + 1, n + 1):
            edges, top, chosen = [], -_NEVER, ()
            for start in range(end - 1, max(end - longest, 0) - 1, -1):
                piece = find(text[start:end], 0)
                if not piece:
                    if start == end - 1:  # no piece spells the character
                        raw = text[start].encode()
                        piece = self.byte_score * len(raw), tuple([self.bytes[b] for b in raw])
                    elif piece == 0:
                        break
                    else:
                        continue
                score, ids = piece
                edge = (start, score, ids)
                edges.append(edge)
                if scores[start] + score > top:
                    top, chosen = scores[start] + score, edge
            incoming.append(edges)
            scores.append(top)
            last.append(chosen)
        return text, incoming, scores, last

    def best(self, text: str, before: Forward | None = None) -> tuple[Best, Forward]:
        """(score of the best segmentation, what the second best loses, ids of the best), and the pass."""
        passed = self.forward(text, before)
        _, incoming, forward, last = passed
        # any other segmentation has an edge off the best path; the best through each edge is known
        on = len(text)
        backward, second, path = [-_NEVER] * on + [0], -_NEVER, []
        for end in range(on, 0, -1):
            behind, chosen = backward[end], None
            if end == on:
                chosen = last[end]
                on = chosen[0]
                path.append(chosen[2])
            for edge in incoming[end]:
                start, score, _ = edge
                score += behind
                if score > backward[start]:
                    backward[start] = score
                if edge is not chosen and forward[start] + score > second:
                    second = forward[start] + score
        path.reverse()
        ids = path[0] if len(path) == 1 else tuple(chain.from_iterable(path))
        return (forward[-1], forward[-1] - second if second > -_NEVER else _NEVER, ids), passed

    def search(self, text: str, n: int) -> list[Segmentation]:
        """The n best segmentations of ``text``."""
        _, incoming, forward, _ = self.forward(text)
        best = forward[-1]
        # exact loss of the best completion; of equal ones, the newest (goes deep first)
        heap: list = [(0, 0, len(text), 0, None)]
        pushed, found = 0, []
        while heap and len(found) < n:
            loss, _, at, behind, link = heapq.heappop(heap)
            if not at:
                ids: list[int] = []
                while link:
                    ids += link[0]
                    link = link[1]
                found.append((loss, tuple(ids)))
                continue
            for start, score, made in reversed(incoming[at]):
                pushed += 1
                heapq.heappush(heap, (best - forward[start] - behind - score, -pushed, start,
                                      behind + score, (made, link)))
        return found

    def best_of(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray, Entries]:
        """``best`` of many stretches: scores, what the second best lose, ids."""
        long = [i for i, s in enumerate(stretches) if len(s) >= LONGEST]
        if not long:
            return best_of(stretches, self._trie, self.byte_score, self._byte_ids, _NEVER)
        skipped = set(long)
        short = [i for i in range(len(stretches)) if i not in skipped]
        scores, gaps, ids = best_of([stretches[i] for i in short], self._trie, self.byte_score, self._byte_ids, _NEVER)
        found = [self.best(" " + stretches[i])[0] for i in long]
        place = np.argsort(np.array(short + long), kind="stable")
        entries = Entries(np.concatenate([ids.store, *[np.array(made, np.int32) for _, _, made in found]]),
                          np.concatenate([ids.lengths, [len(made) for _, _, made in found]]).astype(np.int64))
        return (np.append(scores, [score for score, _, _ in found])[place], np.append(gaps, [gap for _, gap, _ in found])[place],
                Entries(entries.row(place), entries.lengths[place]))

    def _alternatives(self, stretch: str, n: int) -> list[Segmentation]:
        found = self._searched.find((stretch, n))
        if found is None:
            found = self.search(" " + stretch, n)
            if len(stretch) <= _CACHE_CHARS:
                self._searched.put((stretch, n), found)
        return found

    @staticmethod
    def stretches(text: str) -> list[str]:
        """Independent parts of the lattice, each without the space that starts it."""
        if not text:
            return []
        if "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return [s[1:] for s in _STRETCH.findall(" " + text)]

    def ranked(self, texts: list[str], n: int = N_BEST) -> Iterator[tuple[int, np.ndarray, list[tuple[int, list[Change]]]]]:
        """Per text: best score, ids of the best segmentation, and the n best as (loss, changes to the
        best, in order).  Each distinct stretch of the texts is looked up once."""
        parts = list(map(self.stretches, texts))
        codes, stretches = distinct(parts)
        scores, gaps, ids = self.best_of(stretches)
        at = 0
        for part in parts:
            own = codes[at:at + len(part)]
            at += len(part)
            loose = [i for i in np.argsort(gaps[own], kind="stable")[:n - 1].tolist() if gaps[own[i]] < _NEVER]
            # combinations of choices in the loose stretches, best first
            options: list[tuple[int, tuple]] = [(0, ())]
            found = [(i, self._alternatives(part[i], n)) for i in loose]
            for _, choices in found:
                options = heapq.nsmallest(n, [(loss + more, (*choice, k)) for loss, choice in options
                                              for k, (more, _) in enumerate(choices)])
            begins = np.cumsum(ids.lengths[own])
            yield (int(scores[own].sum()), ids.row(own),
                   [(loss, sorted((int(begins[i] - ids.lengths[own[i]]), int(ids.lengths[own[i]]), choices[k][1])
                                  for (i, choices), k in zip(found, choice) if k))
                    for loss, choice in options])

    def nbest(self, text: str, n: int = N_BEST) -> tuple[int, list[Segmentation]]:
        """Best score and n best segmentations of a whole text."""
        score, best, options = next(self.ranked([text], n))
        return score, [(loss, changed(best.tolist(), changes)) for loss, changes in options]

    def decode(self, ids: tuple[int, ...] | np.ndarray) -> str:
        """The text of piece ids; drops the one space that encoding puts in front."""
        ids = np.asarray(ids, np.int64)
        if len(ids) and ids.min() < 0:
            raise IndexError(f"no piece {ids.min()}")
        raw = self._spelled.row(ids).tobytes()
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def changed(best: list[int], changes: list[Change]) -> tuple[int, ...]:
    for at, n, ids in reversed(changes):
        best = [*best[:at], *ids, *best[at + n:]]
    return tuple(best)


_LATTICES: dict[str, PieceLattice] = {}  # one per worker process and file


def _lattice(path: str) -> PieceLattice:
    if path not in _LATTICES:
        _LATTICES[path] = PieceLattice(path)
    return _LATTICES[path]


def encode_pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_best: int = N_BEST,
                  model: str = MODEL) -> DataFrame:
    """doc_id, n_chars, n_pieces, score, losses, pieces, alternatives, pieces_sha256, round_trip: one row per row of ``df``.

    ``pieces`` is the best segmentation (ids); ``score`` its score; ``losses``
    what each of the ``n_best`` best segmentations scores less, best first (so
    it starts with 0, and is shorter where the text has fewer segmentations).
    ``alternatives`` holds the others in the same order, as what they change:
    in place of ``n`` ids of ``pieces`` from position ``at``, ``pieces`` (see
    ``segmentations``).  ``pieces_sha256`` hashes the best ids as little-endian
    32-bit numbers.  ``round_trip`` tells whether decoding them gives the text
    again.  A null or empty text has no pieces and the score 0.  Malformed UTF-8
    is replaced by U+FFFD first.  Texts of any length are encoded whole.  Rows
    that repeat an id are encoded each; other columns are ignored; an empty
    table gives no rows.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _lattice(model if "/" in model else public_tokenizers.path(model))
        for batch in parts:
            ids = iter(column(batch, "doc_id"))
            for raws in pieces_of(column(batch, "text")):
                texts = [(raw or b"").decode("utf-8", "replace") for raw in raws]
                rows, made = [], []
                for text, (score, best, found) in zip(texts, lattice.ranked(texts, n_best)):
                    made.append(best)
                    others = [[{"at": at, "n": n, "pieces": new} for at, n, new in changes] for _, changes in found[1:]]
                    rows.append((len(text), len(best), score, [loss for loss, _ in found], others,
                                 hashlib.sha256(best.tobytes()).hexdigest(), lattice.decode(best) == text))
                ends = np.cumsum([0] + [len(m) for m in made]).astype(np.int32)
                columns = [pa.array(list(values), kind) for values, kind in zip(zip(*rows), _KINDS)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(islice(ids, len(texts))), pa.int64()), *columns[:4],
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(made))), *columns[4:]],
                    names=["doc_id", "n_chars", "n_pieces", "score", "losses", "pieces", "alternatives", "pieces_sha256",
                           "round_trip"])

    return id_and_text(df, id_col, text_col).mapInArrow(
        batches, "doc_id long, n_chars long, n_pieces long, score long, losses array<long>, pieces array<int>, "
                 "alternatives array<array<struct<at: int, n: int, pieces: array<int>>>>, pieces_sha256 string, "
                 "round_trip boolean")


_KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()),
          pa.list_(pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32()), ("pieces", pa.list_(pa.int32()))]))),
          pa.string(), pa.bool_())


def segmentations(encoded: DataFrame) -> DataFrame:
    """doc_id, rank, score, pieces: the N best segmentations of every row of ``encode_pieces``, best first from rank 1.

    A null or empty text has one, without pieces.  Rows that repeat an id give
    theirs each.
    """
    def rewritten(pieces, change):
        return F.concat(F.slice(pieces, F.lit(1), change["at"]), change["pieces"],
                        F.slice(pieces, change["at"] + change["n"] + 1, F.size(pieces)))

    every = F.concat(F.array(F.array().cast(encoded.schema["alternatives"].dataType.elementType)), "alternatives")
    rows = encoded.select("doc_id", "score", "losses", "pieces", F.posexplode(every).alias("at", "changes"))
    # from the last change to the first, so that positions hold
    pieces = F.aggregate(F.reverse("changes"), F.col("pieces"), rewritten)
    return rows.select("doc_id", (F.col("at") + 1).alias("rank"), (F.col("score") - F.col("losses")[F.col("at")]).alias("score"),
                       pieces.alias("pieces"))


def decode_pieces(df: DataFrame, pieces_col: str = "pieces", decoded_col: str = "decoded", model: str = MODEL) -> DataFrame:
    """``df`` with the text that the ids of ``pieces_col`` spell, as ``decoded_col`` at the end.

    The inverse of ``encode_pieces``, for any of its segmentations.  Null or
    empty pieces spell the empty text, a null id nothing; an id that the model
    does not have raises.  Ids that end within a character give U+FFFD.
    """
    names, flat = df.columns, numbered(df)
    source = f"c{names.index(pieces_col)}"
    inner = [*flat.columns, "decoded"]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _lattice(model if "/" in model else public_tokenizers.path(model))
        for batch in parts:
            for at in range(0, batch.num_rows, _DECODE_ROWS):
                part = batch.slice(at, _DECODE_ROWS)
                rows = [lattice.decode([i for i in row or () if i is not None]) for row in column(part, source)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(rows, pa.string())], names=inner)

    made = flat.mapInArrow(batches, StructType([*flat.schema.fields, StructField("decoded", StringType())]))
    return made.toDF(*names, decoded_col)


_DECODE_ROWS = 500

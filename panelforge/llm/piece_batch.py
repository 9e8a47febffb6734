"""Viterbi over many short lattices at once.

Stretches of about the same length are laid side by side, a column each.  A
step handles all pieces that start at one character and have one length: no
two of them share a column, so scores move by plain array operations.  The
trie of the pieces is a hash table from (node, character) to node.
"""

from __future__ import annotations

import numpy as np

from .common import Entries

LONGEST = 64  # characters of a stretch, the space in front included
_WIDTHS = np.array([*range(1, 13), 14, 16, 20, 24, 32, 48, LONGEST])
_LOW = -(1 << 60)
_EMPTY = np.uint32(0xFFFFFFFF)
_SPREAD = np.uint32(2654435761)  # spreads keys over the slots of the table


class PieceTrie:
    """The prefixes of all pieces; node 0 is the empty one."""

    def __init__(self, pieces: dict[str, tuple[int, tuple[int]]]):
        letters = sorted(set("".join(pieces)))
        # 0 is no character, 1 one that no piece holds
        self.codes = np.ones(0x110000, np.int32)
        self.codes[list(map(ord, letters))] = np.arange(2, len(letters) + 2)
        self._width = len(letters) + 2
        nodes = {"": 0}
        for piece in pieces:
            for i in range(1, len(piece) + 1):
                nodes.setdefault(piece[:i], len(nodes))
        self.scores = np.full(len(nodes), _LOW, np.int64)
        self.ids = np.zeros(len(nodes), np.int32)
        for piece, (score, ids) in pieces.items():
            self.scores[nodes[piece]], self.ids[nodes[piece]] = score, ids[0]
        if len(nodes) * self._width >= int(_EMPTY):
            raise ValueError("too many pieces for 32-bit keys")
        keys = np.array([nodes[p[:-1]] * self._width + int(self.codes[ord(p[-1])]) for p in list(nodes)[1:]], np.uint32)
        values = np.arange(1, len(nodes), dtype=np.int32)
        bits = max(int(np.ceil(np.log2(len(nodes) * 4))), 4)
        self._shift, self._mask = np.uint32(32 - bits), np.uint32((1 << bits) - 1)
        self._keys, self._values = np.full(1 << bits, _EMPTY), np.zeros(1 << bits, np.int32)
        slots = (keys * _SPREAD) >> self._shift
        left = np.arange(len(keys))
        while len(left):  # of those that want a free slot, one gets it; the others try the next
            free = left[self._keys[slots[left]] == _EMPTY]
            self._keys[slots[free]] = keys[free]
            won = free[self._keys[slots[free]] == keys[free]]
            self._values[slots[won]] = values[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            slots[left] = (slots[left] + np.uint32(1)) & self._mask

    def step(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The node behind each character, -1 where there is none."""
        keys = (nodes * np.int32(self._width) + codes).astype(np.uint32)
        slots = (keys * _SPREAD) >> self._shift
        held = self._keys[slots]
        out = np.where(held == keys, self._values[slots], np.int32(-1))
        left = np.flatnonzero((held != keys) & (held != _EMPTY))
        while len(left):
            slots[left] = (slots[left] + np.uint32(1)) & self._mask
            held = self._keys[slots[left]]
            hit = held == keys[left]
            out[left[hit]] = self._values[slots[left[hit]]]
            left = left[~hit & (held != _EMPTY)]
        return out


def best_of(stretches: list[str], trie: PieceTrie, byte_score: int, byte_ids: np.ndarray,
            never: int) -> tuple[np.ndarray, np.ndarray, Entries]:
    """Per stretch, a space in front: the best score, what the second best loses (``never`` without
    one), and the ids of the best; of equal edges into a character, that with the latest start.

    ``byte_ids[b]`` is the id of byte b, which spells characters that are no piece.
    """
    total = len(stretches)
    lengths = np.fromiter(map(len, stretches), np.int64, total) + 1
    if total and lengths.max() > LONGEST:
        raise ValueError(f"a stretch of {lengths.max()} characters")
    width = np.searchsorted(_WIDTHS, lengths)
    scores, gaps = np.zeros(total, np.int64), np.full(total, never, np.int64)
    counts = np.zeros(total, np.int64)
    parts = []
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        n = lengths[rows]
        flat = np.frombuffer("".join([" " + stretches[i] for i in rows.tolist()]).encode("utf-32-le"), np.uint32)
        points = np.full((len(rows), _WIDTHS[w]), -1, np.int32)
        points[np.arange(_WIDTHS[w]) < n[:, None]] = flat
        scores[rows], second, made = _columns(np.ascontiguousarray(points.T), n, trie, byte_score)
        gaps[rows] = np.minimum(scores[rows] - second, never)
        flat, counts[rows] = _spelled(made, trie, byte_ids)
        parts.append((rows, flat))
    # the parts hold the stretches by width: put their ids in the given order
    order = np.concatenate([rows for rows, _ in parts]) if parts else np.empty(0, np.int64)
    by_width = Entries(np.concatenate([flat for _, flat in parts]) if parts else np.empty(0, np.int32), counts[order])
    place = np.empty(total, np.int64)
    place[order] = np.arange(total)
    return scores, gaps, Entries(by_width.row(place), counts)


def _columns(points: np.ndarray, n: np.ndarray, trie: PieceTrie, byte_score: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best and second best score of every column of characters (-1: no character), and the best
    one's symbols by end: an id, or -1 - character for one that bytes spell, or 0 where nothing ends."""
    height, count = points.shape
    codes = np.where(points >= 0, trie.codes[points], np.int32(0))
    edges: list[tuple[int, int, np.ndarray, np.ndarray]] = []  # start, end, columns, scores
    forward = np.full((height + 1, count), _LOW, np.int64)
    forward[0] = 0
    came = np.zeros((height + 1, count), np.int8)
    symbol = np.zeros((height + 1, count), np.int32)
    roots = np.zeros(count, np.int32)
    for start in range(height):
        at = np.flatnonzero(codes[start])
        if not len(at):
            break
        nodes = trie.step(roots[at], codes[start][at])
        for end in range(start + 1, height + 1):
            if end > start + 1:
                following = codes[end - 1][at]
                go = np.flatnonzero(following > 1)
                if not len(go):
                    break
                at = at[go]
                nodes = trie.step(nodes[go], following[go])
                on = np.flatnonzero(nodes >= 0)
                if not len(on):
                    break
                at, nodes = at[on], nodes[on]
                score = trie.scores[nodes]
                whole = np.flatnonzero(score > _LOW)
                columns, score, made = at[whole], score[whole], trie.ids[nodes[whole]]
            else:  # every character has an edge of its own, of bytes if it is no piece
                score = np.where(nodes >= 0, trie.scores[nodes], _LOW)
                made = trie.ids[nodes]
                bare = np.flatnonzero(score == _LOW)
                if len(bare):
                    point = points[start][at[bare]]
                    score[bare] = byte_score * (1 + (point > 0x7F) + (point > 0x7FF) + (point > 0xFFFF))
                    made[bare] = -1 - point
                columns = at
                keep = np.flatnonzero(nodes >= 0)
                at, nodes = at[keep], nodes[keep]
            if len(columns):
                edges.append((start, end, columns, score))
                reach = forward[start][columns] + score
                better = np.flatnonzero(reach >= forward[end][columns])
                chosen = columns[better]
                forward[end][chosen] = reach[better]
                came[end][chosen] = start
                symbol[end][chosen] = made[better]
            if not len(at):
                break
    every = np.arange(count)
    on_path = np.zeros((height + 1, count), bool)
    cursor = n.copy()
    for end in range(height, 0, -1):
        on_path[end] = cursor == end
        cursor = np.where(on_path[end], came[end], cursor)
    # any other segmentation has an edge off the best path; the best through each edge is known
    backward = np.full((height + 1, count), _LOW, np.int64)
    backward[n, every] = 0
    second = np.full(count, 2 * _LOW, np.int64)
    for start, end, columns, score in reversed(edges):
        behind = backward[end][columns] + score
        backward[start][columns] = np.maximum(backward[start][columns], behind)
        through = np.where(on_path[end][columns] & (came[end][columns] == start), 2 * _LOW,
                           forward[start][columns] + behind)
        second[columns] = np.maximum(second[columns], through)
    return forward[n, every], second, np.where(on_path, symbol, np.int32(_NONE))[1:].T


_NONE = -(1 << 31)  # no piece ends here


def _spelled(symbols: np.ndarray, trie: PieceTrie, byte_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows one after the other, and how many each row has."""
    held = symbols != _NONE
    flat, counts = symbols[held], held.sum(axis=1)
    bare = np.flatnonzero(flat < 0)
    if not len(bare):
        return flat, counts
    raw = [chr(-1 - point).encode() for point in flat[bare].tolist()]
    sizes = np.ones(len(flat), np.int64)
    sizes[bare] = list(map(len, raw))
    owner = np.repeat(np.arange(len(symbols)), counts)
    out = np.repeat(flat, sizes)
    ends = np.cumsum(sizes)
    at = np.repeat(ends[bare] - sizes[bare], sizes[bare]) + np.concatenate([np.arange(len(r)) for r in raw])
    out[at] = byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
    return out, np.bincount(owner, weights=sizes, minlength=len(symbols)).astype(np.int64)

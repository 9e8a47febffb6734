"""Prefix token counts of many words at once.

Words of about the same length are laid side by side, a column each.  For
every end the candidate last tokens are tried from the longest on, for all
columns together; whether one token can follow another is looked up in a hash
table of pairs, and asked for only once per pair.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from .common import Entries
from .piece_batch import PieceTrie

LONGEST = 64  # bytes of a word, the space in front included
_WIDTHS = np.array([*range(1, 17), 20, 24, 32, 48, LONGEST])
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_FREE = np.int64(-1)


class PairTable:
    """Verdicts on pairs of numbers, kept until the table is half full."""

    def __init__(self, judge: Callable[[int, int], bool], width: int, bits: int = 20):
        """``judge(left, right)`` of numbers below ``width``."""
        self._judge, self._width, self._bits = judge, width, bits
        self._clear()

    def _clear(self) -> None:
        self._keys, self._values = np.full(1 << self._bits, _FREE), np.zeros(1 << self._bits, bool)
        self._held = 0

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _SPREAD) >> np.uint64(64 - self._bits)).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of every key, -1 for one that the table does not hold."""
        slots = self._slots(keys)
        left = np.arange(len(keys))
        while len(left):
            held = self._keys[slots[left]]
            slots[left[held == _FREE]] = -1
            left = left[(held != keys[left]) & (held != _FREE)]
            slots[left] = (slots[left] + 1) & (len(self._keys) - 1)
        return slots

    def __call__(self, lefts: np.ndarray, rights: np.ndarray) -> np.ndarray:
        keys = lefts.astype(np.int64) * self._width + rights
        slots = self._find(keys)
        new = np.flatnonzero(slots < 0)
        if not len(new):
            return self._values[slots]
        out = np.zeros(len(keys), bool)
        known = slots >= 0
        out[known] = self._values[slots[known]]
        fresh, which = np.unique(keys[new], return_inverse=True)
        verdicts = np.fromiter((self._judge(*divmod(k, self._width)) for k in fresh.tolist()), bool, len(fresh))
        out[new] = verdicts[which]
        self._add(fresh, verdicts)
        return out

    def _add(self, keys: np.ndarray, verdicts: np.ndarray) -> None:
        if self._held + len(keys) > len(self._keys) // 2:
            self._clear()
            keys, verdicts = keys[:len(self._keys) // 2], verdicts[:len(self._keys) // 2]
        self._held += len(keys)
        slots = self._slots(keys)
        left = np.arange(len(keys))
        while len(left):  # of those that want a free slot, one gets it; the others try the next
            free = left[self._keys[slots[left]] == _FREE]
            self._keys[slots[free]] = keys[free]
            won = free[self._keys[slots[free]] == keys[free]]
            self._values[slots[won]] = verdicts[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            slots[left] = (slots[left] + 1) & (len(self._keys) - 1)


def prefix_counts(words: list[bytes], trie: PieceTrie, follows: PairTable, none: int) -> Entries:
    """Token counts at every byte end of every word (none longer than ``LONGEST``).

    ``follows(left, right)`` tells whether two tokens stay two next to each other;
    ``none`` is the left one of a token that begins the word.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    width = np.searchsorted(_WIDTHS, lengths)
    parts = []
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        points = np.full((len(rows), _WIDTHS[w]), -1, np.int32)
        held = np.arange(_WIDTHS[w]) < lengths[rows, None]
        points[held] = np.frombuffer(b"".join([words[i] for i in rows.tolist()]), np.uint8)
        counts = _columns(np.ascontiguousarray(points.T), trie, follows, none)
        parts.append((rows, counts.T[held]))
    if not parts:
        return Entries(np.empty(0, np.int16), lengths)
    order = np.concatenate([rows for rows, _ in parts])
    by_width = Entries(np.concatenate([flat for _, flat in parts]), lengths[order])
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    return Entries(by_width.row(place), lengths)


def _columns(points: np.ndarray, trie: PieceTrie, follows: PairTable, none: int) -> np.ndarray:
    """Counts by end of every column of bytes (-1: no byte)."""
    height, count = points.shape
    codes = np.where(points >= 0, trie.codes[points], np.int32(0))
    tokens: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}  # by start and end: columns, tokens
    for start in range(height):
        at = np.flatnonzero(codes[start])
        nodes = np.zeros(len(at), np.int32)
        for end in range(start + 1, height + 1):
            following = codes[end - 1][at]
            go = np.flatnonzero(following > 1)
            if not len(go):
                break
            at, nodes = at[go], trie.step(nodes[go], following[go])
            on = np.flatnonzero(nodes >= 0)
            at, nodes = at[on], nodes[on]
            whole = np.flatnonzero(trie.scores[nodes] == 0)
            if len(whole):
                tokens[start, end] = at[whole], trie.ids[nodes[whole]]
    counts = np.zeros((height + 1, count), np.int16)
    last = np.full((height + 1, count), none, np.int32)
    for end in range(1, height + 1):
        open_ = codes[end - 1] != 0
        left = int(open_.sum())
        for start in range(end):
            if not left:
                break
            columns, made = tokens.get((start, end), (None, None))
            if columns is None:
                continue
            mine = np.flatnonzero(open_[columns])
            columns, made = columns[mine], made[mine]
            fits = np.flatnonzero(follows(last[start][columns], made))
            columns = columns[fits]
            counts[end][columns] = counts[start][columns] + 1
            last[end][columns] = made[fits]
            open_[columns] = False
            left -= len(columns)
    return counts[1:]

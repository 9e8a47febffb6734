"""Exact byte-level BPE token counts of every prefix of a text.

The encoding of a prefix ends in exactly one token: the suffix token that can
follow the last token of what stands before it, that is, the pair re-encodes to
itself.  So within a pre-token, dynamic programming over the byte positions
gives the last token and the count of every prefix.  Pre-tokens before the cut
are closed, and their counts add up.

A text is split into units: white space and the word, number, punctuation run
or contraction that follows.  The count differences at the characters of a unit
do not depend on its neighbours; a text's table is their running sum.  Where
single spaces part a text, no unit crosses one, so each distinct stretch
between spaces is computed once, and words of letters side by side (``prefix_batch``).  Truncation points and budgets are
read off the table without encoding anything again.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import Entries, RecentCache, column, distinct, id_and_text, pieces_of, valid_utf8
from .piece_batch import PieceTrie
from .prefix_batch import LONGEST, PairTable, prefix_counts

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
_CACHE_STRETCHES = 800_000  # in each of the two generations that a worker keeps
_CACHE_CHARS = 48           # longer stretches are computed each time
_CACHE_PAIRS = 200_000
_NEVER = 1 << 60            # the rank of a pair that does not merge

# A contraction directly after a space is punctuation and a word, as the space joins the quote.
_UNIT = regex.compile(r"\s*(?:(?<! )'(?:s|t|re|ve|m|ll|d)|\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+)|\s+")
_SPACES = regex.compile(r"\s*")
_MARKS = ",.;:!?%$#*&"
_SPLIT_CONTRACTIONS = ("'re", "'ve", "'ll")  # their two-character prefix is two pre-tokens


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class PrefixCounter:
    """Token counts of all prefixes under one byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()

        def raw(piece: str) -> bytes:
            return bytes(letters[c] for c in piece)

        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self._splits = [(raw(a), raw(b)) for a, b in merges]
        self._ranks = {pair: i for i, pair in enumerate(self._splits)}
        self._made = {a + b: i for i, (a, b) in reversed(list(enumerate(self._splits)))}
        # a token that no merge makes never comes out
        self._tokens = {bytes([b]) for b in range(256)} | set(self._made)
        self._longest = max(map(len, self._tokens))
        self._specials = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self._special = regex.compile("|".join(map(regex.escape, self._specials)) or r"(?!)")
        self._pairs = RecentCache(_CACHE_PAIRS)
        self._edges: tuple[dict, dict] = {}, {}
        self._after_space = RecentCache(_CACHE_STRETCHES)
        self._tails: dict[str, list[int]] = {}
        self._previous: tuple[bytes, list[int], list[bytes]] = b"", [0], [b""]
        self._names = sorted(self._tokens)
        self._trie = PieceTrie({t.decode("latin-1"): (0, (i,)) for i, t in enumerate(self._names)})
        self._follows = PairTable(self._number_follows, len(self._names) + 1)

    def _merged(self, text: bytes) -> list[bytes]:
        parts = [text[i:i + 1] for i in range(len(text))]
        while len(parts) > 1:
            rank, at = min((self._ranks.get(pair, _NEVER), i)
                           for i, pair in enumerate(zip(parts, parts[1:])))
            if rank == _NEVER:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _edge(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """The parts at one end of a token as its merges build it, byte first, each with the
        rank of the merge that swallows it.  Empty for a token that its own bytes never make."""
        known = self._edges[side].get(token)
        if known is None:
            known, part, above = [], token, _NEVER
            while True:
                known.append((part, above))
                if len(part) == 1:
                    break
                above = self._made[part]
                part = self._splits[above][0 if side else 1]
            known.reverse()
            if self._merged(token) != [token]:
                known = []
            self._edges[side][token] = known
        return known

    def _can_follow(self, left: bytes, right: bytes) -> bool:
        """Whether the two tokens next to each other stay two tokens.

        Merges run by rank, so the parts that face each other at the seam are
        followed upward; they would merge if that came before either is swallowed.
        """
        pair = (left, right)
        known = self._pairs.find(pair)
        if known is None:
            ends, begins = self._edge(left, 0), self._edge(right, 1)
            known, i, j = bool(ends and begins), 0, 0
            while known:
                (a, up_a), (b, up_b) = ends[i], begins[j]
                rank = self._ranks.get((a, b), _NEVER)
                if rank < up_a and rank <= up_b and rank != _NEVER:
                    known = False
                elif up_a == up_b == _NEVER:
                    break
                elif up_a <= up_b:  # of one rank, the left merge runs first
                    i += 1
                else:
                    j += 1
            self._pairs.put(pair, known)
        return known

    def _number_follows(self, left: int, right: int) -> bool:
        """``_can_follow`` for token numbers; one past the last stands for the begin of a pre-token."""
        if left == len(self._names):
            return bool(self._edge(self._names[right], 0))
        return self._can_follow(self._names[left], self._names[right])

    def piece_counts(self, piece: bytes) -> list[int]:
        """Token count of every byte prefix of a pre-token (index 0: nothing).

        The previous pre-token's table serves for the prefix that both have.
        """
        other, counts, last = self._previous
        same = 0
        for a, b in zip(piece, other):
            if a != b:
                break
            same += 1
        counts, last = counts[:same + 1], last[:same + 1]
        tokens, pairs = self._tokens, self._pairs.young
        for end in range(same + 1, len(piece) + 1):
            for start in range(max(0, end - self._longest), end):
                token = piece[start:end]
                if token in tokens:
                    if start:
                        fits = pairs.get((last[start], token))
                        if fits is None:
                            fits = self._can_follow(last[start], token)
                            pairs = self._pairs.young
                    else:
                        fits = bool(self._edge(token, 0))
                    if fits:
                        counts.append(counts[start] + 1)
                        last.append(token)
                        break
        if same or len(piece) > 2:  # a single mark between two words leaves the table in place
            self._previous = piece, counts, last
        return counts

    def _chars(self, piece: str) -> list[int]:
        """Counts at the character ends of a pre-token."""
        counts = self.piece_counts(piece.encode())
        if len(counts) == len(piece) + 1:
            return counts[1:]
        out, at = [], 0
        for c in piece:
            at += len(c.encode())
            out.append(counts[at])
        return out

    def _unit(self, unit: str) -> list[int]:
        """Counts at the unit's characters."""
        spaces = _SPACES.match(unit)[0] if unit[0].isspace() else ""
        core = unit[len(spaces):]
        if not spaces:
            out = self._chars(core)
            if core in _SPLIT_CONTRACTIONS:
                out[1] = out[0] + 1
            return out
        if spaces == " " and core:
            return self._chars(unit)
        out = self._chars(spaces)  # a prefix that ends in the run holds it as one piece
        if core:
            # before a word the run's last character is not part of it
            closed = self._chars(spaces[:-1])[-1] if len(spaces) > 1 else 0
            if spaces[-1] == " ":
                tail = self._chars(" " + core)[1:]
            else:
                closed += self._chars(spaces[-1])[-1]
                tail = self._unit(core)
            out += [closed + n for n in tail]
        return out

    def _units(self, text: str) -> bytes:
        differences = array("h")
        for unit in _UNIT.findall(text):
            before = 0
            for n in self._unit(unit):
                differences.append(n - before)
                before = n
        return differences.tobytes()

    def _stretch(self, stretch: str) -> bytes:
        """Differences of a space and a stretch; nothing if the spaces do not close its ends."""
        made = self._after_space.find(stretch)
        if made is None:
            word = stretch.rstrip(_MARKS)
            if word.isalpha():  # a word and marks: two pre-tokens
                counts = self._chars(" " + word)
                if len(word) < len(stretch):
                    marks = stretch[len(word):]
                    tail = self._tails.get(marks)
                    if tail is None:
                        tail = self._chars(marks)
                        if len(marks) <= 3:  # of few marks, so the table stays small
                            self._tails[marks] = tail
                    counts = counts + [counts[-1] + n for n in tail]
                made = array("h", [n - before for n, before in zip(counts, [0, *counts])]).tobytes()
            else:
                inner = bool(stretch) and not stretch[0].isspace() and not stretch[-1].isspace()
                made = self._units(" " + stretch) if inner else b""
            if len(stretch) <= _CACHE_CHARS:
                self._after_space.put(stretch, made)
        return made

    def _plain(self, text: str) -> bytes:
        stretches = text.split(" ")
        if not stretches[0] or stretches[0][-1].isspace():
            return self._units(text)
        found = [self._units(stretches[0]), *map(self._stretch, stretches[1:])]
        return b"".join(found) if all(found) else self._units(text)

    def _word_differences(self, words: list[str]) -> Entries:
        """Differences at the characters of words of letters, with or without a space in front."""
        if not words:
            return Entries(np.empty(0, np.int16), np.empty(0, np.int64))
        raw = [word.encode() for word in words]
        counts = prefix_counts(raw, self._trie, self._follows, len(self._names))
        flat = np.frombuffer(b"".join(raw), np.uint8)
        # a character ends where no byte follows that continues it
        ends = (np.append(flat[1:], np.uint8(0)) & 0xC0) != 0x80
        at_ends = counts.store[ends]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        out = np.diff(at_ends, prepend=np.int16(0))
        starts = np.cumsum(lengths) - lengths
        out[starts] = at_ends[starts]
        return Entries(out, lengths)

    @staticmethod
    def _word_parts(stretch: str) -> list[str]:
        """The words, marks and line ends of a space and a stretch of nothing else; else nothing."""
        if stretch.isalpha() and len(stretch) < LONGEST // 4:
            return [" " + stretch]
        parts, front = [], " "
        for line in stretch.split("\n"):
            word = line.rstrip(_MARKS)
            if not word.isalpha() or len(word) >= LONGEST // 4:
                return []
            parts.append(front + word)
            if len(word) < len(line):
                parts.append(line[len(word):])
            parts.append("\n")
            front = ""
        return parts[:-1]

    def _differences(self, stretches: list[str]) -> tuple[Entries, np.ndarray]:
        """Those of distinct stretches, and the entry of each stretch.

        Words of letters, with marks or single line ends between them, are counted
        side by side; the others one by one, new ones in alphabetic order:
        neighbours share prefixes.
        """
        plain, other, parts = [], [], []
        for i, stretch in enumerate(stretches):
            found = self._word_parts(stretch)
            (plain if found else other).append(i)
            if found:
                parts.append(found)
        codes, names = distinct(parts)
        words = [i for i, name in enumerate(names) if name[-1].isalpha()]
        of_words = self._word_differences([names[i] for i in words])
        is_word = np.zeros(len(names), bool)
        is_word[words] = True
        tails = [np.diff(self._chars(n), prepend=0).astype(np.int16) for n, word in zip(names, is_word.tolist()) if not word]
        number = np.empty(len(names), np.int64)  # the words' entries, then those of marks and line ends
        number[is_word], number[~is_word] = np.arange(len(words)), np.arange(len(words), len(names))
        entries = Entries(np.concatenate([of_words.store, *tails]),
                          np.concatenate([of_words.lengths, np.fromiter(map(len, tails), np.int64, len(tails))]))
        codes = number[codes]
        sums = np.concatenate([[0], np.cumsum(entries.lengths[codes])])
        ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))])
        found = list(map(self._after_space.find, [stretches[i] for i in other]))
        for i in sorted([i for i, known in enumerate(found) if known is None], key=lambda i: stretches[other[i]]):
            found[i] = self._stretch(stretches[other[i]])
        store = np.concatenate([entries.row(codes), np.frombuffer(b"".join(found), np.int16)])
        lengths = np.concatenate([np.diff(sums[ends]), np.fromiter(map(len, found), np.int64, len(found)) // 2])
        place = np.empty(len(stretches), np.int64)
        place[plain + other] = np.arange(len(stretches))
        return Entries(store, lengths), place

    def tables(self, texts: list[str]) -> Iterator[np.ndarray]:
        """``table`` of many texts: each distinct stretch is looked up once."""
        parts = [text.split(" ") for text in texts]
        codes, stretches = distinct([part[1:] for part in parts])
        entries, place = self._differences(stretches)
        codes, lengths = place[codes], entries.lengths
        at = 0
        for text, part in zip(texts, parts):
            own = codes[at:at + len(part) - 1]
            at += len(part) - 1
            open_end = not part[0] or part[0][-1].isspace()
            if open_end or (lengths[own] == 0).any() or self._special.search(text):
                yield self.table(text)
                continue
            first = np.frombuffer(self._units(part[0]), np.int16)
            counts = np.zeros(len(text) + 1, np.int32)
            np.cumsum(np.concatenate([first, entries.row(own)]), out=counts[1:], dtype=np.int32)
            yield counts

    def table(self, text: str) -> np.ndarray:
        """counts[i]: tokens of the first i characters."""
        parts, at = [], 0
        for special in self._special.finditer(text):
            # until its last character a special string is ordinary text
            part = np.frombuffer(self._plain(text[at:special.end()]), np.int16).astype(np.int32)
            before = part[:special.start() - at].sum()
            part[-1] = before + 1 - part[:-1].sum()
            parts.append(part)
            at = special.end()
        parts.append(np.frombuffer(self._plain(text[at:]), np.int16).astype(np.int32))
        counts = np.zeros(len(text) + 1, np.int32)
        np.cumsum(np.concatenate(parts), out=counts[1:])
        return counts


def fitting_prefix(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    return int(np.flatnonzero(counts <= budget)[-1])


_COUNTERS: dict[str, PrefixCounter] = {}  # one per worker process and file


def _counter(path: str) -> PrefixCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def prefix_token_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        tokenizer: str = TOKENIZER, limit: int = LIMIT,
                        tables: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, chars_in_limit[, prefix_tokens]: one row per row of ``df``.

    ``chars_in_limit`` is the length of the longest prefix of at most ``limit``
    tokens.  With ``tables`` true, ``prefix_tokens[i]`` is the count of the
    first i characters.  Special strings in a text count as one token; nothing
    is added at the ends.  A null text counts as empty: no bytes, no tokens.
    Malformed UTF-8 is replaced by U+FFFD first.
    Rows that repeat an id are counted each; other columns are ignored.
    ``tokenizer`` is a file name of the public tokenizers or a path that every
    executor can read.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer if "/" in tokenizer else public_tokenizers.path(tokenizer)
        counter = _counter(path)
        for batch in parts:
            ids = iter(column(batch, "doc_id"))
            size = 1 << 18 if tables else 4 << 20  # tables are wide: hand them on in small batches
            for raws in pieces_of(column(batch, "text"), size):
                raw = list(map(valid_utf8, raws))
                texts = [r.decode() for r in raw]
                counts = list(counter.tables(texts))
                totals = [int(c[-1]) for c in counts]
                out = [pa.array(list(islice(ids, len(raw))), pa.int64()), pa.array([len(t) for t in raw], pa.int64()),
                       pa.array(totals, pa.int64()), pa.array([n > limit for n in totals]),
                       pa.array([fitting_prefix(c, limit) for c in counts], pa.int64())]
                names = ["doc_id", "n_bytes", "n_tokens", "over_limit", "chars_in_limit"]
                if tables:
                    out.append(pa.array(counts, pa.list_(pa.int32())))
                    names.append("prefix_tokens")
                yield pa.RecordBatch.from_arrays(out, names=names)

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, chars_in_limit long"
    return id_and_text(df, id_col, text_col).mapInArrow(
        batches, schema + (", prefix_tokens array<int>" if tables else ""))

"""Language identification by a byte convolutional network trained in numpy.

Windows of fixed length cover the whole text.  A window's bytes pass through
filters of widths 2, 3 and 4, a rectifier, max pooling over the positions and a
softmax layer; a text's score per language is the mean over its windows,
weighted by their bytes.  The filters read one-hot bytes, so a filter bank of
width w is w lookup tables, and two neighbouring bytes share one table of pairs
when the trained network is applied.
"""

from __future__ import annotations

import copy
import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, column, id_and_text, keep_rows, pick
from .importance import kth_largest

UNKNOWN = "und"
WINDOW_BYTES = 192
WIDTHS = (2, 3, 4)
FILTERS = 16             # per width
ROWS_PER_LANGUAGE = 800  # bound of the training sample
WINDOWS_PER_ROW = 4      # distinct ones, spread over the whole text
SHARD_WINDOWS = 25_000   # training windows that one copy of the network learns from before copies are averaged
SHARD_PARTITIONS = 2000  # at most; a partition takes its shards one after the other
REFINE_RATE = 0.001
PAIR_SHARE = 1_000_000   # a pair of bytes is known if it makes a millionth of the pairs of some label
TAIL = 0.001             # share of the held-out rows that limits leave below them
MAX_LABELS = 1000        # more are taken for a wrong column
EPOCHS = 10
_FRACTION = 1 << 24      # fixed point, so that sums do not depend on their order
_BATCH_WINDOWS = 256
_LETTER = regex.compile(r"\p{L}")


def windows_of(raw: bytes, width: int = WINDOW_BYTES) -> np.ndarray:
    """The text cut into windows, the last one filled up with spaces."""
    n = max(1, -(-len(raw) // width))
    return np.frombuffer(raw.ljust(n * width, b" "), np.uint8).reshape(n, width)


class ByteNetwork:
    """Weights of the network; trained by Adam on the cross-entropy."""

    def __init__(self, labels: list[str], seed: int = 5):
        rng = np.random.default_rng(seed)
        self.labels = labels
        # one table of 256 rows for every place in a filter
        self.tables = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(labels))).astype(np.float32)
        self.out_bias = np.zeros(len(labels), np.float32)
        self.seen = np.zeros(1 << 16, bool)  # pairs of neighbouring bytes in the training windows
        self._pairs: list[np.ndarray] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_pairs": None}

    def _pooled(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Pooled activations (windows, filters) and the positions they come from."""
        pooled, places = [], []
        for table, bias, w in zip(self.tables, self.bias, WIDTHS):
            n = x.shape[1] - w + 1
            act = table[0][x[:, :n]]
            for k in range(1, w):
                act += table[k][x[:, k:k + n]]
            at = act.argmax(axis=1)
            pooled.append(np.take_along_axis(act, at[:, None], 1)[:, 0] + bias)
            places.append(at)
        return np.concatenate(pooled, axis=1), places

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def parameters(self) -> list[np.ndarray]:
        return [*self.tables, *self.bias, self.out, self.out_bias]

    def gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        """Of the mean weighted cross-entropy, in the order of ``parameters``."""
        pooled, places = self._pooled(x)
        hidden = np.maximum(pooled, 0)
        p = self._softmax(hidden @ self.out + self.out_bias)
        p[np.arange(len(x)), y] -= 1
        p *= (weight / len(x))[:, None]
        back = (p @ self.out.T) * (pooled > 0)
        tables, biases = [], []
        for k, (w, place) in enumerate(zip(WIDTHS, places)):
            g = back[:, k * FILTERS:(k + 1) * FILTERS]
            grad = np.zeros((w, 256, FILTERS), g.dtype)
            filters = np.broadcast_to(np.arange(FILTERS), place.shape)
            for j in range(w):
                np.add.at(grad[j], (np.take_along_axis(x, place + j, 1), filters), g)
            tables.append(grad)
            biases.append(g.sum(axis=0))
        return [*tables, *biases, hidden.T @ p, p.sum(axis=0)]

    def train(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int = EPOCHS,
              seed: int = 6, rate: float = 0.01) -> None:
        self.seen[x[:, :-1].astype(np.intp) * 256 + x[:, 1:]] = True
        rng = np.random.default_rng(seed)
        params = self.parameters()
        first = [np.zeros_like(p) for p in params]
        second = [np.zeros_like(p) for p in params]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), 64):
                rows = order[at:at + 64]
                step += 1
                for q, g, m, v in zip(params, self.gradients(x[rows], y[rows], weight[rows]), first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    q -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-7)

    def _fast_pooled(self, x: np.ndarray) -> np.ndarray:
        """As ``_pooled``, by tables of byte pairs."""
        if self._pairs is None:
            # for widths 2, 3, 4: first pair; the third place alone; the second pair
            self._pairs = [(t[a][:, None] + t[a + 1][None]).reshape(-1, FILTERS)
                           for t in self.tables for a in range(0, t.shape[0] - 1, 2)]
        pairs = iter(self._pairs)
        both = x[:, :-1].astype(np.intp) * 256 + x[:, 1:]
        out = []
        for table, bias, w in zip(self.tables, self.bias, WIDTHS):
            n = x.shape[1] - w + 1
            act = None
            for k in range(0, w, 2):
                more = (next(pairs).take(both[:, k:k + n], axis=0) if k + 1 < w
                        else table[k].take(x[:, k:k + n], axis=0))
                act = more if act is None else np.add(act, more, out=act)
            out.append(act.max(axis=1) + bias)
        return np.concatenate(out, axis=1)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return self._softmax(np.maximum(self._fast_pooled(x), 0) @ self.out + self.out_bias)


def _mean(network: ByteNetwork, raw: bytes) -> np.ndarray:
    """Mean probabilities over the windows of a text, by their bytes."""
    x = windows_of(raw)
    weight = np.full(len(x), 1.0)
    weight[-1] = (len(raw) - (len(x) - 1) * WINDOW_BYTES) / WINDOW_BYTES
    total = np.zeros(len(network.labels))
    for at in range(0, len(x), _BATCH_WINDOWS):
        total += weight[at:at + _BATCH_WINDOWS] @ network.probabilities(x[at:at + _BATCH_WINDOWS])
    return total / weight.sum()


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that are never learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _labelled(df: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """doc_id, text, label of the rows that have a label and a letter."""
    rows = pick(df, doc_id=id_col, text=text_col, label=label_col).select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("label").cast("string"))
    return rows.filter(F.col("label").isNotNull() & F.col("text").rlike(r"\p{L}"))


def train_language_model(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         label_col: str = "lang",
                         rows_per_language: int = ROWS_PER_LANGUAGE) -> ByteNetwork | None:
    """Fit the network on at most ``rows_per_language`` rows of every label; None without any.

    The rows with the smallest hashes of id and text are taken, so the sample does not depend
    on the partitioning.  Each gives up to ``WINDOWS_PER_ROW`` distinct windows spread over its
    whole text.  More than ``MAX_LABELS`` labels raise.
    """
    rows = _labelled(df, id_col, text_col, label_col).filter(~held_out())
    # A hash below the label's bound keeps about twice the wanted rows; of these the smallest stay.
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().limit(MAX_LABELS + 1).collect()}
    if len(counts) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels in {label_col}: not a column of languages")
    if not counts:
        return None
    key = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    bound = F.lit(0)
    for label, n in sorted(counts.items()):
        share = min(1.0, (2 * rows_per_language + 50) / n)
        bound = F.when(F.col("label") == label, F.lit(int(share * (1 << 30)))).otherwise(bound)
    raw = F.col("text").cast("binary")
    n_windows = F.greatest(F.lit(1), F.ceil(F.length(raw) / WINDOW_BYTES).cast("int"))
    picked = F.transform(F.sequence(F.lit(0), F.least(F.lit(WINDOWS_PER_ROW), n_windows) - 1),
                         lambda i: F.substring(raw, (F.floor(i * n_windows / F.least(F.lit(WINDOWS_PER_ROW), n_windows)).cast("int")
                                                     * WINDOW_BYTES + 1), F.lit(WINDOW_BYTES)))
    sample = rows.withColumn("key", key).filter(F.col("key") < bound)
    sample = sample.select("label", "key", "doc_id", picked.alias("windows")).collect()
    sample.sort(key=lambda r: (r["label"], r["key"], r["doc_id"], [bytes(w) for w in r["windows"]]))
    labels = sorted(counts)
    x, y, taken = [], [], dict.fromkeys(labels, 0)
    for row in sample:
        if taken[row["label"]] < rows_per_language:
            taken[row["label"]] += 1
            for w in row["windows"]:
                x.append(windows_of(bytes(w))[0])
                y.append(labels.index(row["label"]))
    y = np.array(y)
    weight = len(y) / (len(labels) * np.bincount(y, minlength=len(labels)).clip(1)).astype(np.float32)
    network = ByteNetwork(labels)
    network.train(np.array(x), y, weight[y].astype(np.float32))
    return network


def _shard_sums(network: ByteNetwork, rows: Iterable[tuple[str, bytes]], weight: np.ndarray,
                block: int) -> pa.RecordBatch:
    """(place, total): the weights of a copy that learned from a shard, times its windows, and pair counts by label."""
    local, numbers = copy.deepcopy(network), {label: k for k, label in enumerate(network.labels)}
    x, y, waiting, seen_windows, pairs = [], [], 0, 0, {}

    def learn() -> None:
        windows, labels = np.concatenate(x), np.concatenate(y)
        for at in range(0, len(windows), block):
            chosen = labels[at:at + block]
            local.train(windows[at:at + block], chosen, weight[chosen], epochs=1, rate=REFINE_RATE)

    for label, raw in rows:
        k, windows = numbers[label], windows_of(raw)
        x.append(windows)
        y.append(np.full(len(windows), k))
        waiting += len(windows)
        seen_windows += len(windows)
        text = np.frombuffer(raw, np.uint8)
        found = np.bincount(text[:-1].astype(np.intp) * 256 + text[1:], minlength=1 << 16)
        pairs[k] = pairs[k] + found if k in pairs else found
        if waiting >= block:
            learn()
            x, y, waiting = [], [], 0
    if waiting:
        learn()
    flat = np.concatenate([p.ravel() for p in local.parameters()]).astype(np.float64)
    places, totals = [np.arange(len(flat))], [np.rint(flat * seen_windows * _FRACTION).astype(np.int64)]
    for k, found in pairs.items():
        used = np.flatnonzero(found)
        places.append(len(flat) + (k << 16) + used)
        totals.append(found[used])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(places), pa.int64()),
                                       pa.array(np.concatenate(totals), pa.int64())], names=["place", "total"])


def refine_language_model(df: DataFrame, network: ByteNetwork | None, id_col: str = "doc_id",
                          text_col: str = "text", label_col: str = "lang",
                          shard_windows: int = SHARD_WINDOWS) -> ByteNetwork | None:
    """``network`` after one pass over every window of every row it may learn from.

    Rows are dealt by hash to shards of about ``shard_windows`` windows.  A copy
    of the network learns from each shard, and the copies are averaged by their
    windows.  ``seen`` becomes the pairs that make at least one in
    ``PAIR_SHARE`` of the pairs in all texts of some label.  The result does not
    depend on the partitioning.
    """
    if network is None:
        return None
    rows = _labelled(df, id_col, text_col, label_col).filter(~held_out() & F.col("label").isin(network.labels))
    rows = rows.withColumns({"key": F.xxhash64("doc_id", "text"), "text": F.col("text").cast("binary")})
    n_windows = F.ceil(F.length("text") / WINDOW_BYTES)
    counts = dict(rows.groupBy("label").agg(F.sum(n_windows)).collect())  # at most one row per label
    total = sum(counts.values())
    if not total:
        return network
    weight = np.array([total / (len(counts) * counts[label]) if label in counts else 0 for label in network.labels],
                      np.float32)
    shards = -(-total // shard_windows)
    rows = rows.withColumn("shard", F.pmod("key", F.lit(shards))).repartition(min(shards, SHARD_PARTITIONS), "shard")
    rows = rows.sortWithinPartitions("shard", "key", "doc_id", "label").select("shard", "label", "text")

    def trained(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = (row for batch in parts
                for row in zip(column(batch, "shard"), column(batch, "label"), column(batch, "text")))
        for _, members in itertools.groupby(flat, key=lambda row: row[0]):
            yield _shard_sums(network, ((label, raw) for _, label, raw in members), weight, shard_windows)

    sums = rows.mapInArrow(trained, "place long, total long").groupBy("place").agg(F.sum("total").alias("total"))
    sums = Scratch(df.sparkSession, "language").table(sums, "sums")
    refined = copy.deepcopy(network)
    size = sum(p.size for p in refined.parameters())
    flat = np.zeros(size)
    for place, value in sums.filter(F.col("place") < size).collect():  # the size of the network
        flat[place] = value / (total * _FRACTION)
    ends = np.cumsum([p.size for p in refined.parameters()])
    for p, part in zip(refined.parameters(), np.split(flat, ends[:-1])):
        p[...] = part.reshape(p.shape)
    place = F.col("place") - size
    pairs = sums.filter(place >= 0).select(F.shiftright(place, 16).alias("label"), place.bitwiseAND(F.lit(0xFFFF)).alias("pair"), "total")
    whole = pairs.groupBy("label").agg(F.sum("total").alias("whole"))
    known = pairs.join(F.broadcast(whole), "label").filter(F.col("total") * PAIR_SHARE >= F.col("whole"))
    refined.seen[:] = False
    refined.seen[[r["pair"] for r in known.select("pair").distinct().collect()]] = True  # at most 65,536 rows
    return refined


def identify_language(df: DataFrame, network: ByteNetwork | None, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score: one row per row of ``df``.

    ``lang_pred`` is the label with the highest mean probability (the first of
    equal ones) and ``score`` that probability.  Null texts, texts without a
    letter, and all texts where there is no network, are ``und`` with score 0.
    Rows that repeat an id are judged each; other columns are ignored.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            langs, scores = [], []
            for raw in column(batch, "text"):
                if network is None or not raw or not _LETTER.search(raw.decode("utf-8", "replace")):
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                total = _mean(network, raw)
                langs.append(network.labels[int(total.argmax())])
                scores.append(min(1.0, float(total.max())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()),
                 pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return id_and_text(df, id_col, text_col).mapInArrow(
        batches, "doc_id long, lang_pred string, score double")


def coverage(network: ByteNetwork, raw: bytes) -> float:
    """Share of the text's pairs of neighbouring bytes that stood in the training windows."""
    x = np.frombuffer(raw, np.uint8)
    return float(network.seen[x[:-1].astype(np.intp) * 256 + x[1:]].mean()) if len(x) > 1 else 1.0


def _quantile(bits: DataFrame, n: int, share: float) -> float:
    """The quantile, between the two nearest of ``n`` values, of doubles from 0 up; ``key`` holds their bits."""
    at = share * (n - 1)
    low, high = (float(np.int64(kth_largest(bits, n - k)).view(np.float64)) for k in (int(at), min(int(at) + 1, n - 1)))
    return low + (high - low) * (at - int(at))


def rejection_limits(df: DataFrame, network: ByteNetwork | None, id_col: str = "doc_id", text_col: str = "text",
                     label_col: str = "lang") -> tuple[float, float]:
    """(score, coverage) below which a text fits no learned language.

    From all held-out labelled rows: half way between chance, one over the
    number of labels, and the score that all but a thousandth of them reach, and
    half the coverage that all but a thousandth reach.  (0, 0), which rejects
    nothing, without a network or such rows.  The quantiles are exact, found by
    aggregations of bounded size.
    """
    if network is None:
        return 0.0, 0.0
    known = _labelled(df, id_col, text_col, label_col).filter(held_out()).select(F.col("text").cast("binary"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            texts = column(batch, "text")
            figures = [np.array([float(_mean(network, t).max()) for t in texts], np.float64),
                       np.array([coverage(network, t) for t in texts], np.float64)]
            # the bits of doubles from 0 up order as the doubles do
            yield pa.RecordBatch.from_arrays([pa.array(f.view(np.int64)) for f in figures], names=["score", "coverage"])

    found = Scratch(df.sparkSession, "language").table(known.mapInArrow(batches, "score long, coverage long"), "held-out")
    n = found.count()
    if not n:
        return 0.0, 0.0
    score, covered = (_quantile(found.select(F.col(c).alias("key")), n, TAIL) for c in ("score", "coverage"))
    chance = 1 / len(network.labels)
    return float(chance + (score - chance) / 2), float(covered / 2)


def keep_identified(df: DataFrame, network: ByteNetwork | None, min_score: float, min_coverage: float = 0.0,
                    text_col: str = "text") -> DataFrame:
    """``df`` without the rows whose language is unknown; all columns stay.

    Unknown is that of null texts, texts without a letter, and those whose score
    or coverage lies below its limit; without a network, of all.
    """
    def decide(pieces: Iterator[list[bytes | None]]) -> Iterator[list[bool]]:
        for piece in pieces:
            yield [network is not None and bool(raw) and bool(_LETTER.search(raw.decode("utf-8", "replace")))
                   and coverage(network, raw) >= min_coverage and float(_mean(network, raw).max()) >= min_score
                   for raw in piece]

    return keep_rows(df, text_col, decide)

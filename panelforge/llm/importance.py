"""Quality selection by importance resampling.

Words and word pairs are hashed into a fixed number of buckets.  Two
generative models, smoothed multinomials over the buckets, are fitted: one to
target text, one to all raw text.  A document's weight is the log ratio of its
likelihoods per n-gram (by their sum, length alone would decide).  The key of a
document is this mean log ratio plus Gumbel noise scaled by a temperature T, and
the top k keys are kept: k documents drawn one after the other without
replacement, each draw with odds exp(mean log ratio / T).  A small T comes close
to a plain top k, a large one to a uniform sample.

The bucket counts are one bounded vector per task, summed in Spark.  The k-th
key is found by a radix search over the keys' bits, four aggregations of
bounded size, so no sorted copy of the corpus is made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, column, id_and_text, mix, word_hashes

BUCKETS = 1 << 14
TARGET_ROWS = 20_000   # bound of the labelled sample the target model is fitted to
KEEP_SHARE = 0.8       # k, as a share of the documents
SMOOTHING = 0.5        # added to every bucket count
TEMPERATURE = 0.005    # T: scale of the Gumbel noise against the mean log ratio per n-gram
SEED = 11


def ngram_buckets(text: bytes | None, buckets: int = BUCKETS) -> np.ndarray:
    """Bucket numbers of the lower-cased words and neighbouring word pairs of a text."""
    words = word_hashes(text.lower().split()) if text else np.empty(0, np.uint64)
    pairs = mix(words[:-1] * np.uint64(3) + mix(words[1:]))
    return (np.concatenate([words, pairs]) % np.uint64(buckets)).astype(np.int64)


def bucket_counts(docs: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of (raw, target) n-grams per bucket; ``docs`` has doc text and is_target."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in parts:
            for text, hit in zip(column(batch, "text"), column(batch, "is_target")):
                counts = np.bincount(ngram_buckets(text, buckets), minlength=buckets)
                raw += counts
                if hit:
                    target += counts
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(raw[used]), pa.array(target[used])], names=["bucket", "raw", "target"])

    rows = docs.mapInArrow(batches, "bucket long, raw long, target long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()  # at most one row per bucket
    raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for r in rows:
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    return raw, target


def log_ratios(raw: np.ndarray, target: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """Per bucket: log probability under the target model less that under the raw model."""
    def logs(counts: np.ndarray) -> np.ndarray:
        return np.log(counts + smoothing) - np.log(counts.sum() + smoothing * len(counts))
    return logs(target) - logs(raw)


def gumbel(seed: int) -> Column:
    """Noise that depends on the document's id and text alone, so a recomputed task draws it again."""
    uniform = (F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text_key"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return -F.log(-F.log(uniform))


def kth_largest(keys: DataFrame, k: int) -> int | None:
    """The k-th largest of the long column ``key``; None if there are fewer."""
    prefix, rest = None, k
    for shift in (48, 32, 16, 0):
        digit = F.shiftrightunsigned("key", shift).bitwiseAND(F.lit(0xFFFF)).alias("digit")
        rows = keys if prefix is None else keys.filter(F.shiftrightunsigned("key", shift + 16) == prefix)
        counts = dict(rows.groupBy(digit).count().collect())  # at most 65,536 rows
        for d in sorted(counts, reverse=True):
            if rest <= counts[d]:
                break
            rest -= counts[d]
        else:
            return None
        prefix = d if prefix is None else (prefix << 16) | d
    return prefix


def importance_sample(df: DataFrame, target_ids: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text", keep_share: float = KEEP_SHARE, buckets: int = BUCKETS,
                      target_rows: int = TARGET_ROWS, seed: int = SEED,
                      temperature: float = TEMPERATURE) -> DataFrame:
    """doc_id, n_ngrams, log_ratio, gumbel_key, kept: one row per row of ``df``.

    ``target_ids`` (doc_id) names documents of the wanted kind; the target model
    is fitted to the ``target_rows`` of them with the smallest id hashes, the
    raw model to all rows.  ``log_ratio`` is the mean over the n-grams.  Rows are
    drawn without replacement with odds exp(log_ratio / ``temperature``).  k is ``keep_share`` of the rows that have
    n-grams, rounded up; ties with the k-th key are kept too.  Null and blank
    texts have no n-grams, ratio 0 and are never kept.  With no target row, all
    ratios compare the flat model with the raw one.  Rows that repeat an id are
    judged by their own text; other columns are ignored.
    """
    scratch = Scratch(df.sparkSession, "importance")
    docs = id_and_text(df, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    ids = target_ids.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id IS NOT NULL").distinct()
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(target_rows)
    ids = scratch.table(ids.withColumn("is_target", F.lit(True)), "target-ids")
    marked = docs.join(F.broadcast(ids), "doc_id", "left")  # at most target_rows ids
    ratio = log_ratios(*bucket_counts(marked.select("text", "is_target"), buckets))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            found = [ngram_buckets(t, buckets) for t in column(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array([len(f) for f in found], pa.int64()),
                 pa.array([float(ratio[f].mean()) if len(f) else 0.0 for f in found], pa.float64())],
                names=["doc_id", "text_key", "n_ngrams", "log_ratio"])

    scored = docs.mapInArrow(batches, "doc_id long, text_key long, n_ngrams long, log_ratio double")
    noisy = F.col("log_ratio") + temperature * gumbel(seed)
    # fixed point above zero: long keys order as the doubles do
    key = F.when(F.col("n_ngrams") > 0, (F.least(F.greatest(noisy, F.lit(-1e3)), F.lit(1e3)) * 1e12 + 2e15).cast("long"))
    scored = scratch.table(scored.withColumns({"gumbel_key": noisy, "key": key}), "scored")
    with_text = scored.filter("key IS NOT NULL").select("key")
    k = -(-with_text.count() * round(keep_share * 1000) // 1000)
    cut = kth_largest(with_text, k) if k else None
    kept = F.coalesce(F.col("key") >= cut, F.lit(False)) if cut is not None else F.lit(False)
    return scored.select("doc_id", "n_ngrams", "log_ratio", "gumbel_key", kept.alias("kept"))

"""Host-level quality rules, in DataFrame functions only.

Every document's rule measures come from array functions over its words and
lines.  Failures are counted per host, and each host's failure rate is shrunk
towards all hosts by a beta prior whose parameters are fitted to the hosts'
rates (method of moments).  Hosts whose shrunk rate is clearly above the limit
are rejected, and the verdict is joined back to their documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, pick

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
HOST_MAX_RATE = 0.6    # shrunk failure rate from which a host is rejected
HOST_SIGMAS = 2.0      # posterior standard deviations by which it must be above
MAX_PRIOR_WEIGHT = 1e6  # hosts without spread beyond chance: a prior this strong

_BLANK = r"[ \t\n\x0B\f\r]+"
_REPEAT_WINDOW = 3


def _words(text: Column) -> Column:
    """Runs of characters other than ASCII white space."""
    return F.filter(F.split(text, _BLANK), lambda w: w != "")


def _repeated_words(windows: Column) -> Column:
    """Words inside 3-word windows that occur twice or more, from (hash, start) sorted."""
    twice = F.filter(
        F.transform(windows, lambda w, i: F.when(
            (F.get(windows, i - 1)["h"] == w["h"]) | (F.get(windows, i + 1)["h"] == w["h"]), w["i"])),
        lambda at: at.isNotNull())
    starts = F.array_sort(twice)
    covered = F.zip_with(starts, F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))),
                         lambda a, b: F.least(F.coalesce(b - a, F.lit(_REPEAT_WINDOW)), F.lit(_REPEAT_WINDOW)))
    return F.aggregate(covered, F.lit(0), lambda total, x: total + x).cast("long")


def rule_measures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  host_col: str = "source") -> DataFrame:
    """doc_id, host and the measures n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed: one row per row of ``df``.  A null text has no words, lines or symbols."""
    docs = pick(df, doc_id=id_col, host=host_col, text=text_col).select(
        F.col("doc_id").cast("long"), F.col("host").cast("string"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^ \t\n\x0B\f\r]"))
    docs = docs.select("doc_id", "host", _words(F.col("text")).alias("words"), lines.alias("lines"),
                       (F.size(F.split("text", r"[#*$%&|<>]")) - 1).cast("long").alias("n_symbols"))
    n = F.size("words")
    at = F.when(n >= _REPEAT_WINDOW, F.sequence(F.lit(0), n - _REPEAT_WINDOW)).otherwise(
        F.array().cast("array<int>"))
    words = F.col("words")
    windows = F.transform(at, lambda i: F.struct(
        F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))
    docs = docs.select(
        "doc_id", "host", n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"), "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(windows).alias("windows"))
    docs = docs.select("doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       _repeated_words(F.col("windows")).alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return docs.withColumn("base_failed", failed)


def host_verdicts(measures: DataFrame) -> DataFrame:
    """host, n_docs, n_failed, host_rate, host_rejected.

    The prior's mean is the hosts' mean rate; its weight follows from how far
    the rates spread beyond binomial chance.  Without spread, or with one host,
    the prior is very strong and all hosts get the common rate.
    """
    hosts = measures.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"),
                                         F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    fit = hosts.agg(F.avg(rate).alias("mean"), F.var_pop(rate).alias("spread"),
                    F.avg(1 / F.col("n_docs")).alias("chance"))
    fit = fit.first()  # three numbers
    mean = min(max(fit["mean"] or 0.0, 1e-6), 1 - 1e-6)
    noise = mean * (1 - mean) * (fit["chance"] or 0.0)
    between = max((fit["spread"] or 0.0) - noise, mean * (1 - mean) / MAX_PRIOR_WEIGHT)
    weight = max(mean * (1 - mean) / between - 1, 1e-3)
    alpha, beta = mean * weight, (1 - mean) * weight
    total = F.col("n_docs") + F.lit(alpha + beta)
    shrunk = (F.col("n_failed") + F.lit(alpha)) / total
    limit = F.lit(HOST_MAX_RATE) + HOST_SIGMAS * F.sqrt(shrunk * (1 - shrunk) / (total + 1))
    return hosts.select("host", "n_docs", "n_failed", shrunk.alias("host_rate"),
                         (shrunk > limit).alias("host_rejected"))


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  host_col: str = "source") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    host_rejected: one row per row of ``df``.

    ``kept`` is false for rows that fail a base rule and for all rows of a
    rejected host.  Null hosts form one host.  Rows that repeat an id are judged
    each; other columns are ignored.
    """
    scratch = Scratch(df.sparkSession, "rules")
    measures = scratch.table(rule_measures(df, id_col, text_col, host_col), "measures")
    hosts = scratch.table(host_verdicts(measures).select(F.col("host").alias("_host"), "host_rejected"), "hosts")
    out = measures.join(hosts, F.col("host").eqNullSafe(F.col("_host")), "left")
    rejected = F.coalesce("host_rejected", F.lit(False))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", (~F.col("base_failed") & ~rejected).alias("kept"),
                      rejected.alias("host_rejected"))

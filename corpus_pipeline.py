"""A corpus pipeline over the driver's ``documents``: five stages, each rereading the last one's Parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm.common import Scratch
from panelforge.llm.decontaminate import decontaminate
from panelforge.llm.language_id import keep_identified, refine_language_model, rejection_limits, train_language_model
from panelforge.llm.minhash import drop_near_duplicates
from panelforge.llm.pieces import encode_pieces
from panelforge.llm.substring_dedup import remove_repeats
from panelforge.session import scratch_scope
from panelforge.sources.tables import read_table

SHINGLE_WORDS = 5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts that are null, hold no letter or fit no learned language.

    The network learns from every row that is not held out; the limits are those of all held-out rows.
    """
    network = refine_language_model(docs, train_language_model(docs))
    return keep_identified(docs, network, *rejection_limits(docs, network))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of five-word-shingle similarity 0.8 or more."""
    return drop_near_duplicates(docs, shingle_words=SHINGLE_WORDS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 50 words or more that a smaller id holds; n_chars follows the text."""
    return remove_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents a twentieth of whose words lies in benchmark phrases."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best segmentation of every text, and what the next best ones lose."""
    return encode_pieces(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("piece_encoding", piece_encoding),
]

ORACLE_SQL = None  # hashing, a trained network and lattice search are beyond SQL; tests hold it to brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch_scope(spark):  # a stage's intermediate tables go when its result is written
            docs = scratch.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

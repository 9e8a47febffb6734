"""The corpus operators applied to whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.sources.tables import read_table

from .ball_tree import ranked_search
from .decontaminate import contamination
from .fill_in_middle import fill_in_middle, restore_middle
from .importance import importance_sample
from .language_id import held_out, identify_language, train_language_model
from .license_scan import license_scan, url_path
from .minhash import near_duplicates
from .packing import pack_documents
from .pieces import encode_pieces
from .quality_rules import quality_rules
from .substring_dedup import repeated_passages
from .token_counts import prefix_token_counts
from .warc import archive_round_trip


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices of every page, and what a page inherits along its URL's directories."""
    pages = read_table(spark, sf_dir, "pages").withColumn("path", url_path("url"))
    return license_scan(pages, "page_id", "path", "html", titles=True).withColumnRenamed("file_id", "page_id")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read_table(spark, sf_dir, "documents"),
                         read_table(spark, sf_dir, "benchmark")).drop("spans")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(spark, read_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op5_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: documents labelled as good and not toxic."""
    good = read_table(spark, sf_dir, "labels").filter("quality = 1 AND coalesce(toxic, 0) = 0")
    return importance_sample(read_table(spark, sf_dir, "documents"), good)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    out = identify_language(documents, train_language_model(documents))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(read_table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256", "longest_repeat")


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents")).drop("text_key")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_token_counts(read_table(spark, sf_dir, "documents"))


def op11_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = restore_middle(fill_in_middle(read_table(spark, sf_dir, "documents")))
    digests = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    fn.__name__: fn for fn in (
        op1_license_scan, op2_quality_rules, op3_decontamination, op4_warc, op5_importance_resampling,
        op6_language_id, op7_pieces, op8_substring_dedup, op9_minhash, op10_token_counts,
        op11_ball_tree, op12_packing, op13_fill_in_middle)}

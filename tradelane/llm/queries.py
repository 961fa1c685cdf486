"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (classifier, exact, extraction, lines, minhash, mixing, packing, rules, search, setjoin, spelling,
               substring, toxicity)
from .tables import labelled_sample, read, texts


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_removed", "longest_run",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_dedup(read(spark, sf_dir, "documents")).drop("row")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return classifier.quality_scores(read(spark, sf_dir, "documents"), labels)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"),
                             labelled_sample(spark, sf_dir, "toxic", toxicity.SAMPLE))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(read(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(read(spark, sf_dir, "documents"))
    model = rules.fit_rules(docs, labelled_sample(spark, sf_dir, "quality", rules.SAMPLE))
    return rules.score_rules(docs, model)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract_pages(read(spark, sf_dir, "pages"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.schedule(docs).drop("kept", "key", "size")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer_path())


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(read(spark, sf_dir, "documents")).drop("kept_text")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.set_join(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_line_dedup, op2_minhash, op3_quality, op4_toxicity, op5_exact_dedup, op6_quality_rules, op7_html_extraction,
                            op8_mixing, op9_best_fit_packing, op10_substring_dedup, op11_spelling_variants, op12_ranked_search,
                            op13_set_join)}

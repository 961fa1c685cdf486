"""Corpus pipeline: quality rules, line dedup, near-dedup, mixing to target weights, packing.

``run`` applies the stages to ``documents``; each stage's rows are written as Parquet and read
again as the next one's documents. All stages but the last return the columns of ``documents``. What a
stage leaves in the shared folder besides goes when the next one begins.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelane.llm import lines, minhash, mixing, packing, rules
from tradelane.llm.queries import tokenizer_path
from tradelane.llm.tables import column, cut, drop_recorded, labelled_sample, numbered, of_numbered, read, recorded, texts


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(f: Stage) -> Stage:
    """A stage begins when the one before it is written: what that one left in the shared folder goes."""
    @wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_recorded(spark)
        with recorded():
            return f(spark, docs, sf_dir)
    return run_stage


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go, null and empty texts among them; all columns stay.

    Rows that repeat are judged alike; an empty table stays empty.
    """
    model = rules.fit_rules(texts(docs), labelled_sample(spark, sf_dir, "quality", rules.SAMPLE))
    return rules.keep_by_rules(docs, model)


@stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated lines go, and documents of which nothing else is left.

    Texts without lines (null, empty) stay as they are, and so does the first of rows that repeat. ``n_chars``
    is that of the new text. Clashing names, long texts and empty tables are as in ``dedup_lines``.
    """
    cleaned = lines.dedup_lines(docs)
    places = [F.col(f"c{i}") for i in range(len(docs.columns) + 3)]
    n_lines, n_removed = places[-3:-1]
    text = places[docs.columns.index("text")]
    return cleaned.toDF(*(f"c{i}" for i in range(len(places)))).where((n_removed == 0) | (n_removed < n_lines)).select(
        *((F.length(text).cast(docs.schema[i].dataType) if c == "n_chars" else places[i]).alias(c)
          for i, c in enumerate(docs.columns)))


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, with all its columns.

    Texts without words are groups of their own; of rows that repeat one stays.
    """
    rows = numbered(docs)
    kept = minhash.near_dedup(of_numbered(rows), row_col="row").where("kept").select("row").hint("merge")
    return rows.join(kept, "row", "left_semi").select(*(column(c, "kept").alias(c) for c in docs.columns))


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in an order that gives the sources their target weights.

    Null sources are one; null and empty texts and rows that repeat are kept like all others.
    """
    return mixing.mixed(docs)


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces in token sequences, which follow the mixed order by sequence_id.

    Null, empty and very long texts are as in ``pack_documents``.
    """
    return packing.pack_documents(docs, tokenizer_path(), in_order=True)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("mixing", mix_sources), ("packing", pack)]
ORACLE_SQL = None  # fitted trees and tokenizers are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, one in STAGES:
        docs = cut(one(spark, docs, sf_dir), name)  # the results of the stages stay, to go on from
    drop_recorded(spark)
    return docs

"""Quality rules: fixed base rules first, then boosted trees over document statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import stats, trees
from .textops import slices

SAMPLE = 20_000  # labelled rows the trees are fitted on, at most
THRESHOLD = 0.3
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30


def base_failed(c: dict[str, np.ndarray]) -> np.ndarray:
    return (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, f in slices(batch):
            x = stats.features(f, stats.counts(f))
            yield pa.record_batch(
                [rows.column("label"),
                 pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))],
                ["label", "x"])


def fit_rules(docs: DataFrame, sample: DataFrame, **settings) -> trees.Trees:
    """Trees from the texts of ``sample`` (doc_id, label), which the caller has bounded.

    ``docs`` has doc_id and text. A doc_id on several rows counts with each text.
    """
    found = (docs.join(F.broadcast(sample), "doc_id").select("label", "text")
             .mapInArrow(_features, "label int, x array<double>").toArrow())
    x = found.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    y = found.column("label").to_numpy().astype(float)
    order = np.lexsort([*x.reshape(-1, len(stats.FEATURES)).T, y])  # not the order of arrival
    monotone = np.array([stats.MONOTONE.get(k, 0) for k in stats.FEATURES])
    return trees.fit(x.reshape(-1, len(stats.FEATURES))[order], y[order], monotone, **settings)


def verdicts(model: trees.Trees, threshold: float, f) -> dict[str, np.ndarray]:
    c = stats.counts(f)
    failed = base_failed(c)
    score = model.probability(stats.features(f, c))
    return c | {"base_failed": failed, "score": score, "kept": ~failed & (score >= threshold)}


def score_rules(docs: DataFrame, model: trees.Trees, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): the base counts, base_failed, score and kept.

    Null text counts as empty and so fails (no words); an empty table gives an empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, f in slices(batch):
                v = verdicts(model, threshold, f)
                yield pa.record_batch(
                    [rows.column("doc_id"), *(pa.array(v[k], pa.int64()) for k in stats.COUNTS),
                     pa.array(v["base_failed"]), pa.array(v["kept"]), pa.array(v["score"])],
                    ["doc_id", *stats.COUNTS, "base_failed", "kept", "score"])

    fields = ", ".join(f"{k} long" for k in stats.COUNTS)
    return docs.mapInArrow(run, f"doc_id long, {fields}, base_failed boolean, kept boolean, score double")


def keep_by_rules(docs: DataFrame, model: trees.Trees, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of a table with a ``text`` column that the rules keep, all columns as they are."""
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))  # a name may hold any character
    text = f"c{docs.columns.index('text')}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, f in slices(batch, text):
                yield rows.filter(pa.array(verdicts(model, threshold, f)["kept"]))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)

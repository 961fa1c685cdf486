"""Quality classifier: random Fourier features, ridge by summed normal equations, isotonic scores.

One pass over the texts stores the statistics of every document. Folds 1 to 3 of the labelled rows
give the normal equations, which tasks sum before anything is shuffled; fold 4 calibrates; fold 0
is never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import stats
from .tables import cut, fold, texts
from .textops import slices

FOURIER = 96
GAMMA = 0.5  # of the kernel exp(-gamma * mean squared distance of the standardised statistics)
RIDGE = 1e-3  # times the number of rows
BINS = 1000  # of raw scores, for the calibration


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, f in slices(batch):
            x = stats.features(f, stats.counts(f))
            yield pa.record_batch([rows.column("doc_id"), *(pa.array(v) for v in x.T)],
                                  ["doc_id", *stats.FEATURES])


def document_stats(docs: DataFrame) -> DataFrame:
    fields = ", ".join(f"{k} double" for k in stats.FEATURES)
    return docs.mapInArrow(_stats, f"doc_id long, {fields}")


@dataclass
class Quality:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    phase: np.ndarray
    beta: np.ndarray
    at: np.ndarray  # knots of the calibration, rising
    to: np.ndarray

    def fourier(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.concatenate([np.cos(z @ self.weights + self.phase) * np.sqrt(2 / len(self.phase)),
                               np.ones((len(x), 1))], 1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.fourier(x) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.at, self.to), 0, 1)


def isotonic(at: np.ndarray, good: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the rising fit to good/n by pooling neighbours that fall; ``at`` rises."""
    blocks: list[list[float]] = []  # good, n, weighted sum of places
    for a, g, w in zip(at, good, n, strict=True):
        blocks.append([g, w, a * w])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            top = blocks.pop()
            blocks[-1] = [x + y for x, y in zip(blocks[-1], top, strict=True)]
    return np.array([s / w for _, w, s in blocks]), np.array([g / w for g, w, _ in blocks])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in stats.FEATURES], 1)


def _moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    aggs = [f(k).alias(f"{n}_{k}") for k in stats.FEATURES for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    got = rows.agg(*aggs).first()
    mean = np.array([got[f"m_{k}"] or 0.0 for k in stats.FEATURES])
    scale = np.array([got[f"s_{k}"] or 0.0 for k in stats.FEATURES])
    return mean, np.where(scale > 1e-9, scale, 1.0)


def fit_quality(rows: DataFrame, seed: int = 7) -> Quality:
    """From stored statistics with ``label`` and ``fold``; without labels every score is 1."""
    mean, scale = _moments(rows.where("fold between 1 and 3"))
    width, random = len(stats.FEATURES), np.random.default_rng(seed)
    model = Quality(mean, scale, random.normal(0, np.sqrt(2 * GAMMA / width), (width, FOURIER)),
                    random.uniform(0, 2 * np.pi, FOURIER), np.zeros(FOURIER + 1), np.zeros(1), np.ones(1))

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FOURIER + 1, FOURIER + 2))
        for b in batches:
            if b.num_rows:
                z = model.fourier(_matrix(b))
                y = b.column("label").to_numpy(zero_copy_only=False).astype(float)
                total += z.T @ np.concatenate([z, y[:, None]], 1)
        yield pa.record_batch([pa.array(np.arange(len(total))), pa.array(list(total))], ["i", "row"])

    sent = rows.where("fold between 1 and 3").mapInArrow(equations, "i long, row array<double>")
    summed = (sent.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j")
              .agg(F.sum("v").alias("v")).groupBy("i")
              .agg(F.sort_array(F.collect_list(F.struct("j", "v"))).getField("v").alias("row")).collect())
    if not summed:
        return model
    total = np.zeros((FOURIER + 1, FOURIER + 2))
    for r in summed:
        total[r.i] = r.row
    n = total[-1, -2]
    if not n:
        return model
    penalty = np.eye(FOURIER + 1) * RIDGE * n / FOURIER
    penalty[-1, -1] = 0
    model.beta = np.linalg.solve(total[:, :-1] + penalty, total[:, -1])

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.record_batch([pa.array(model.raw(_matrix(b))), b.column("label")], ["raw", "label"])

    binned = (rows.where("fold = 4").mapInArrow(raw, "raw double, label int")
              .groupBy(F.floor(F.least(F.greatest(F.col("raw"), F.lit(-1.0)), F.lit(2.0)) * BINS).alias("bin"))
              .agg(F.avg("raw").alias("at"), F.sum("label").alias("good"), F.count(F.lit(1)).alias("n"))
              .orderBy("bin").collect())
    if binned:
        model.at, model.to = isotonic(*(np.array([float(r[k]) for r in binned]) for k in ("at", "good", "n")))
    else:
        model.at, model.to = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1, the higher the likelier label 1), predicted.

    ``labels`` has doc_id and label; of a doc_id labelled twice the largest label counts, null ids
    and labels are left out. Null text counts as empty and is scored. Null doc_id is not held out.
    """
    known = (labels.where("doc_id is not null and label is not null")
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("label").cast("int").alias("label")))
    table = cut(document_stats(texts(docs, id_col, text_col)), "document-stats")
    model = fit_quality(table.join(known, "doc_id").withColumn("fold", fold()).where("fold > 0"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                s = model.score(_matrix(b))
                yield pa.record_batch([b.column("doc_id"), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                      ["doc_id", "score", "predicted"])

    scored = table.mapInArrow(run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score", "predicted")

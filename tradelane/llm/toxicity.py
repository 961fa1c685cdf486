"""Toxicity grades by cumulative-link ordinal regression on the words of whole texts.

P(grade <= k) = sigmoid(theta_k - w.x): one weight per word, shared by all thresholds, which
rise by construction. x marks the distinct words of a text, hashed to BUCKETS places.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import texts
from .textops import Flat, byte_class, slices

BUCKETS = 1 << 18
SAMPLE = 60_000  # labelled rows the model is fitted on, at most
LEAST_TEXTS = 4  # of the sample, for a word to get a weight
Z = 4.0  # deviations from chance that make a word telling

_LETTER = byte_class("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
_LETTER[0x80:] = True
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32


def marks(f: Flat) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of each distinct word, A-Z as a-z, in order of both."""
    low = Flat(_LOWERED[f.data], f.offsets)
    text, starts, ends = low.pieces(_LETTER[low.data])
    at = low.hashes(starts, ends) % np.uint64(BUCKETS)
    own = np.unique(text.astype(np.int64) * BUCKETS + at.astype(np.int64))
    return own // BUCKETS, own % BUCKETS


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Ordinal:
    weights: np.ndarray
    theta: np.ndarray  # rising, one less than there are grades

    def above(self, text: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        """P(grade > k) of n texts, one column per threshold."""
        z = np.bincount(text, self.weights[bucket], n)
        return _sigmoid(z[:, None] - self.theta[None, :])


def fit_ordinal(text: np.ndarray, bucket: np.ndarray, grade: np.ndarray, rounds: int = 200,
                rate: float = 0.15, l2: float = 5e-5) -> Ordinal:
    """Full-batch Adam on the mean negative log-likelihood. Grades are 0 to K, some may be missing."""
    n, top = len(grade), max(1, int(grade.max(initial=0)))
    names, bucket = np.unique(bucket, return_inverse=True)
    share = np.array([(np.sum(grade > k) + 0.5) / (n + 1) for k in range(top)])
    start = -np.log(share / (1 - share))
    free = np.concatenate([np.zeros(len(names)), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    m, v, d = np.zeros_like(free), np.zeros_like(free), len(names)
    rows = np.arange(n)
    for step in range(1, rounds + 1 if n else 1):
        gaps = np.exp(free[d + 1:])
        theta = free[d] + np.concatenate([[0], np.cumsum(gaps)])
        z = np.bincount(text, free[:d][bucket], n)
        s = np.zeros((n, top + 2))
        s[:, 1:-1], s[:, -1] = _sigmoid(theta[None, :] - z[:, None]), 1
        a, b = s[rows, grade + 1], s[rows, grade]
        p = np.maximum(a - b, 1e-9)
        by_z = 1 - a - b
        by_theta = np.zeros(top + 2)
        np.add.at(by_theta, grade + 1, -a * (1 - a) / p)
        np.add.at(by_theta, grade, b * (1 - b) / p)
        tail = np.cumsum(by_theta[1:-1][::-1])[::-1]
        g = np.concatenate([np.bincount(bucket, by_z[text], d) / n + l2 * free[:d],
                            [tail[0] / n], tail[1:] * gaps / n])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        free = free - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    weights = np.zeros(BUCKETS)
    weights[names] = free[:d]
    return Ordinal(weights, free[d] + np.concatenate([[0], np.cumsum(np.exp(free[d + 1:]))]))


@dataclass
class Words:
    """How many texts of either flag have each word of the sample."""

    bad: np.ndarray
    good: np.ndarray
    n_bad: int
    n_good: int

    def telling(self) -> np.ndarray:
        """Words that the flag's texts have more or less often than by chance, by Z deviations."""
        both, share = self.bad + self.good, self.n_bad / max(self.n_bad + self.n_good, 1)
        z = (self.bad - both * share) / np.sqrt(np.maximum(both * share * (1 - share), 1e-9))
        return (both >= LEAST_TEXTS) & (np.abs(z) >= Z)

    def markers(self) -> np.ndarray:
        """Words that flagged texts use at least e**2 times as often as others do."""
        odds = np.log((self.bad + 0.5) / (self.n_bad + 1)) - np.log((self.good + 0.5) / (self.n_good + 1))
        return (odds > 2) & (self.bad >= LEAST_TEXTS)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per word and task, and under bucket -1 the numbers of texts."""
    total = np.zeros((2, BUCKETS + 1), np.int64)
    for batch in batches:
        for rows, f in slices(batch):
            bad = rows.column("label").to_numpy() > 0
            text, bucket = marks(f)
            for flag in (0, 1):
                total[flag, :-1] += np.bincount(bucket[bad[text] == flag], minlength=BUCKETS)
                total[flag, -1] += np.sum(bad == flag)
    at = np.flatnonzero(total.any(0))
    yield pa.record_batch([pa.array(np.where(at == BUCKETS, -1, at)), pa.array(total[1, at]), pa.array(total[0, at])],
                          ["bucket", "bad", "good"])


def count_words(sample: DataFrame) -> Words:
    """``sample`` has label and text; what comes back is bounded by BUCKETS."""
    got = (sample.select("label", "text").mapInArrow(_count, "bucket long, bad long, good long")
           .groupBy("bucket").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).toArrow())
    total = np.zeros((2, BUCKETS + 1), np.int64)
    at = got.column("bucket").to_numpy()
    total[0, at], total[1, at] = got.column("bad").to_numpy(), got.column("good").to_numpy()
    return Words(total[0, :-1], total[1, :-1], int(total[0, -1]), int(total[1, -1]))


def fit_toxicity(docs: DataFrame, sample: DataFrame, graded: bool = False, **settings) -> Ordinal:
    """From the texts of ``sample`` (doc_id, label), which the caller has bounded.

    With ``graded`` the labels are grades 0 to K. Else they are a flag, and the flagged texts with
    more than the median share of marker words get grade 2, the others 1.
    """
    known = docs.join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")
    words = count_words(known)
    telling, markers = words.telling(), words.markers()

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, f in slices(batch):
                text, bucket = marks(f)
                share = np.bincount(text, markers[bucket], f.n) / np.maximum(np.bincount(text, minlength=f.n), 1)
                text, bucket = text[telling[bucket]], bucket[telling[bucket]]
                cuts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=f.n))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(bucket.astype(np.int32)))
                yield pa.record_batch([rows.column("doc_id"), rows.column("label"), pa.array(share), lists],
                                      ["doc_id", "label", "share", "words"])

    found = known.mapInArrow(chosen, "doc_id long, label int, share double, words array<int>").toArrow()
    found = found.sort_by([("doc_id", "ascending"), ("share", "ascending")]).combine_chunks()
    label = found.column("label").to_numpy().astype(int)
    share = found.column("share").to_numpy()
    sizes = found.column("words").combine_chunks().value_lengths().to_numpy() if found.num_rows else label
    bucket = found.column("words").combine_chunks().flatten().to_numpy().astype(np.int64)
    if graded:
        grade = label
    else:
        bad = label > 0
        grade = bad.astype(int) + (bad & (share > (np.median(share[bad]) if bad.any() else 0)))
    return fit_ordinal(np.repeat(np.arange(len(label)), sizes), bucket, grade, **settings)


def toxicity(docs: DataFrame, sample: DataFrame, threshold: float = 0.25, id_col: str = "doc_id",
             text_col: str = "text", graded: bool = False) -> DataFrame:
    """Per row: doc_id, p_toxic (grade above 0), severity (expected grade), grade (likeliest), toxic.

    Null and empty texts have no words and get the base rates. Without labelled rows p_toxic is 0.5.
    """
    own = texts(docs, id_col, text_col)
    model = fit_toxicity(own, sample, graded)
    held = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.theta))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Ordinal(*held.value)
        for batch in batches:
            for rows, f in slices(batch):
                above = fitted.above(*marks(f), f.n)
                each = np.concatenate([np.ones((f.n, 1)), above], 1) - np.concatenate([above, np.zeros((f.n, 1))], 1)
                yield pa.record_batch(
                    [rows.column("doc_id"), pa.array(above[:, 0]), pa.array(above.sum(1)),
                     pa.array(each.argmax(1).astype(np.int32)), pa.array(above[:, 0] >= threshold)],
                    ["doc_id", "p_toxic", "severity", "grade", "toxic"])

    return own.mapInArrow(run, "doc_id long, p_toxic double, severity double, grade int, toxic boolean")

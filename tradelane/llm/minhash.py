"""Near-duplicates by ProbMinHash signatures of weighted word shingles.

A shingle of weight w (its count in the document) arrives at the times of a Poisson process of rate
w, each time at one of SLOTS places; a place keeps whoever came first. A shingle is followed only
until its next arrival is later than every place's first, which ends the work early. Two
documents agree in a place with their probability Jaccard similarity. Bands of ROWS places give
candidates; these are verified exactly: a pair is linked if the probability Jaccard similarity of
the counts, or the Jaccard similarity of the sets, is 0.8 or more. A text that repeats a shingle has
a second signature, in which every shingle weighs one, with bands of its own, so that both kinds
of pairs meet. Texts without repeats have the same signature either way, so the bands of both kinds
share their buckets. Classes are the components.

Documents with the same shingles and counts are one from the start; those that differ in counts may
be similar to different others, and are linked as others. ``linking`` verifies the members of the
buckets, which are never expanded into their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linking import Measure, connect, shared_buckets
from .tables import column, cut
from .textops import Flat, mix, slices

SHINGLE = 5
BANDS, ROWS = 20, 4
SLOTS = BANDS * ROWS
SIMILAR = Measure(percent=80, counted=True)
U = np.uint64


def shingles(f: Flat, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and count of each distinct shingle, by text, then hash.

    A text of fewer than k words has one shingle, all its words; one without words has none.
    """
    text, starts, ends = f.words
    at, h = f.windows(k)
    per = np.bincount(text, minlength=f.n)
    short = np.flatnonzero((per > 0) & (per < k))
    own, hashes = text[at], h
    if len(short):
        words = f.hashes(starts, ends)
        first = np.searchsorted(text, short)
        extra = np.zeros(len(short), U)
        for i in range(k - 1):
            more = per[short] > i
            extra[more] = mix(extra[more] + words[first[more] + i] + U(i))
        own, hashes = np.concatenate([own, short]), np.concatenate([hashes, extra])
    order = np.lexsort((hashes, own))
    own, hashes = own[order], hashes[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return own[at], hashes[at], np.diff(np.append(at, len(own)))


def signatures(text: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int, m: int = SLOTS) -> np.ndarray:
    """The shingle that came first at each of m places, for n texts; 0 without shingles."""
    first, who = np.full(n * m, np.inf), np.zeros(n * m, U)
    time, k = np.zeros(len(text)), 0
    while len(text):
        k += 1
        seed = mix(h + U(k * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF))
        time = time - np.log(((seed >> U(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / weight
        place = text * m + (mix(seed + U(0x632BE59BD9B4E019)) % U(m)).astype(np.int64)
        early = np.flatnonzero(time < first[place])
        early = early[np.lexsort((h[early], time[early]))[::-1]]  # the earliest is written last
        first[place[early]] = time[early]
        who[place[early]] = h[early]
        on = time < first.reshape(n, m).max(1)[text]
        text, h, weight, time = text[on], h[on], weight[on], time[on]
    return who.reshape(n, m)


def _bands(sig: np.ndarray) -> np.ndarray:
    bands = np.zeros((len(sig), BANDS), U)
    for r in range(ROWS):
        bands = mix(bands + sig[:, r::ROWS][:, :BANDS] + U(r + 1))
    return mix(bands + np.arange(1, BANDS + 1, dtype=U)).view(np.int64)


PROFILE = "row long, doc_id long, n int, k1 long, k2 long, bands array<long>, ids binary, counts binary"


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, f in slices(batch):
            text, h, count = shingles(f)
            per = np.bincount(text, minlength=f.n)
            cuts = np.concatenate([[0], np.cumsum(per)])
            sig = signatures(text, h, count.astype(np.float64), f.n)
            uneven = np.zeros(f.n, bool)
            uneven[text[count > 1]] = True
            of = uneven[text]
            flat_sig = signatures((np.cumsum(uneven) - 1)[text[of]], h[of], np.ones(int(of.sum())), int(uneven.sum()))
            bands = np.zeros((f.n, 2, BANDS), np.int64)
            bands[:, 0], bands[uneven, 1] = _bands(sig), _bands(flat_sig)
            own = np.ones((f.n, 2, BANDS), bool)
            own[:, 1] = uneven[:, None] & (bands[:, 1] != bands[:, 0])
            ends = np.concatenate([[0], np.cumsum(own.sum((1, 2)))])
            keys = []
            for s in (3, 5):  # sums do not depend on order
                each = np.concatenate([[U(0)], np.cumsum(mix(mix(h + U(s)) + count.astype(U)))])
                keys.append((each[cuts[1:]] - each[cuts[:-1]]).view(np.int64))
            low, many = (h >> U(32)).astype("<u4"), count.astype("<u4")
            spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
            yield pa.record_batch(
                [rows.column("row"), rows.column("doc_id"), pa.array(per, pa.int32()), *(pa.array(k) for k in keys),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bands[own])),
                 pa.array([low[a:b].tobytes() for a, b in spans], pa.binary()),
                 pa.array([many[a:b].tobytes() if (many[a:b] > 1).any() else b"" for a, b in spans], pa.binary())],
                [x.split()[0] for x in PROFILE.split(", ")])


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               row_col: str | None = None) -> DataFrame:
    """Per row of ``docs``: row (its number), doc_id, class_id, class_size, kept.

    ``class_id`` is the smallest doc_id of the class; its row stays, of several the first. Texts
    without words, null and empty ones among them, are classes of their own; long ones are read whole. Rows
    that repeat are copies. Null doc_ids stay before others. Other columns are not looked at; an empty
    table gives no rows. The numbers are those of ``row_col``, which stands in the stored ``docs``;
    without it they are given in the one scan of ``docs`` and mean nothing beyond this result.
    """
    row = F.monotonically_increasing_id() if row_col is None else column(row_col)
    own = docs.select(row.alias("row"), column(id_col).cast("long").alias("doc_id"),
                      F.coalesce(column(text_col), F.lit("")).alias("text"))
    profiles = cut(own.mapInArrow(_profiles, PROFILE), "profiles")
    slim = profiles.select("row", "doc_id", "n", "k1", "k2")
    same = (slim.where("n > 0").groupBy("k1", "k2", "n").agg(F.min("row").alias("one"), F.count(F.lit(1)).alias("c"))
            .where("c > 1").drop("c"))
    same = cut(same, "same-shingles")
    named = cut(slim.join(same, ["k1", "k2", "n"], "left").select(
        "row", "doc_id", F.coalesce("one", "row").alias("one")), "shingle-classes")
    firsts = named.where("one = row").select("row")
    each = cut(profiles.where("n > 0").select("row", "bands").join(firsts.hint("merge"), "row")
               .select("row", F.explode("bands").alias("bucket")), "bands")
    comp = connect(shared_buckets(each), profiles, SIMILAR).toDF("one", "comp")
    found = cut(named.join(comp, "one", "left").select("row", "doc_id", F.coalesce("comp", "one").alias("comp")), "classes")
    classes = found.groupBy("comp").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"),
                                        F.min(F.struct("doc_id", "row")).alias("first"))
    return found.join(cut(classes, "class-sizes"), "comp").select(
        "row", "doc_id", "class_id", "class_size", (F.col("row") == F.col("first.row")).alias("kept"))

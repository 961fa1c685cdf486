"""Exact deduplication with two passes of a Bloom filter.

Pass 1 reads the texts once and stores a 32-byte digest per row. Each task of the next job puts
its digests' bits into a filter and sends, per segment of the filter, the positions set once and
those set twice; a segment's task joins them into the positions set twice or more. Pass 2 probes
every digest with that second filter: a row whose bits are not all set there has no equal and goes
straight to the result; the other rows alone are shuffled by digest and decided exactly.

The filter never exceeds ``max_bits``. More rows than it suits are done in slices of the hash range:
the digests (not the texts) are dealt to slices once and written to a folder of each, and a slice's
round reads its own folder only, so every digest is read once per pass however many slices there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tradelane.session import scratch_path

from .tables import cut, texts

BITS_PER_ROW = 16
HASHES = 3
MAX_BITS = 1 << 28  # 32 MB, the most that is broadcast
SEGMENT_BITS = 1 << 22
FILES_PER_SLICE = 8
_PROBED = "doc_id long, sha binary, row long, maybe boolean"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sha = hashlib.sha256
    for b in batches:
        if b.num_rows:
            found = [sha(t.lower()).digest() for t in b.column("text").cast(pa.large_binary()).to_pylist()]
            yield pa.record_batch([b.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "sha"])


def _positions(sha: pa.Array, bits: int) -> np.ndarray:
    """HASHES bit positions of each digest, as columns."""
    raw = np.frombuffer(b"".join(sha.to_pylist()), "<u8").reshape(-1, 4)
    return (raw[:, 1:1 + HASHES] % np.uint64(bits)).astype(np.int64)


def _fill(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = [], []
        for b in batches:
            if b.num_rows:
                once.append(_positions(b.column("sha"), bits).ravel())
        if not once:
            return
        at, n = np.unique(np.concatenate(once), return_counts=True)
        twice = n > 1
        for s in np.unique(at // SEGMENT_BITS):
            own = at // SEGMENT_BITS == s
            yield pa.record_batch(
                [pa.array([int(s)], pa.int64()),
                 pa.array([(at[own] % SEGMENT_BITS).astype("<u4").tobytes()], pa.binary()),
                 pa.array([np.packbits(twice[own]).tobytes()], pa.binary())], ["segment", "at", "twice"])
    return run


def _merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams over what the tasks sent for one segment; holds two bit sets."""
    once, more = np.zeros(SEGMENT_BITS, bool), np.zeros(SEGMENT_BITS, bool)
    for b in batches:
        for at, twice in zip(b.column("at").to_pylist(), b.column("twice").to_pylist(), strict=True):
            at = np.frombuffer(at, "<u4")
            two = np.unpackbits(np.frombuffer(twice, np.uint8), count=len(at)).astype(bool)
            more[at[once[at] | two]] = True
            once[at] = True
    yield pa.record_batch([pa.array([key[0].as_py()], pa.int64()),
                           pa.array([np.packbits(more).tobytes()], pa.binary())], ["segment", "bits"])


def repeated_filter(keys: DataFrame, bits: int) -> np.ndarray:
    """The filter of positions set twice or more; ``bits`` bounds what reaches the driver."""
    sent = keys.select("sha").mapInArrow(_fill(bits), "segment long, at binary, twice binary")
    merged = sent.groupBy("segment").applyInArrow(_merge, "segment long, bits binary")
    out = np.zeros(-(-bits // SEGMENT_BITS) * SEGMENT_BITS // 8, np.uint8)
    step = SEGMENT_BITS // 8
    for row in merged.collect():  # ``bits`` at most
        out[row.segment * step:(row.segment + 1) * step] = np.frombuffer(row.bits, np.uint8)
    return out


def _probe(held, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value
        for b in batches:
            if b.num_rows:
                at = _positions(b.column("sha"), bits)
                hit = (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).all(axis=1)
                yield b.append_column("maybe", pa.array(hit))
    return run


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z, long ones as a whole; null counts as empty. The
    row with the largest doc_id stays (null ids are the smallest); of several such rows, one. Other columns
    are not looked at. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    keys = texts(docs, id_col, text_col).mapInArrow(_digests, "doc_id long, sha binary")
    keys = cut(keys.withColumn("row", F.monotonically_increasing_id()), "digests")
    n = keys.count()
    slices = max(1, -(-n * BITS_PER_ROW // max_bits))
    bits = int(min(max_bits, max(1 << 16, n * BITS_PER_ROW)))
    if slices == 1:
        held = spark.sparkContext.broadcast(repeated_filter(keys, bits))
        return decide(cut(keys.mapInArrow(_probe(held, bits), _PROBED), "probed"))
    dealt, probed = scratch_path(spark, "digest-slices"), scratch_path(spark, "probed")
    # a digest that very many rows share is spread over the files of its slice
    of = F.pmod(F.xxhash64("sha"), F.lit(slices))
    (keys.withColumn("slice", of).repartition("slice", F.pmod("row", F.lit(FILES_PER_SLICE)))
     .write.partitionBy("slice").parquet(dealt))
    stored = spark.read.schema(StructType([*keys.schema, StructField("slice", IntegerType())])).parquet(dealt)
    for i in range(slices):
        own = stored.where(F.col("slice") == i).drop("slice")  # one folder
        held = spark.sparkContext.broadcast(repeated_filter(own, bits))
        own.mapInArrow(_probe(held, bits), _PROBED).write.parquet(f"{probed}/slice={i}")
        held.unpersist()
    return decide(spark.read.schema(_PROBED).parquet(f"{probed}/*"))


def decide(probed: DataFrame) -> DataFrame:
    """Rows marked ``maybe`` are grouped by digest; the others are alone."""
    alone = probed.where("not maybe").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
    maybe = probed.where("maybe")
    groups = maybe.groupBy("sha").agg(F.count(F.lit(1)).alias("group_size"),
                                      F.max(F.struct("doc_id", "row")).alias("last"))
    # unique on the right, which is stored, so that AQE can split a hot digest on the left
    copies = maybe.join(cut(groups, "groups"), "sha").select(
        "doc_id", F.col("last.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("last.row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
    return alone.unionAll(copies)

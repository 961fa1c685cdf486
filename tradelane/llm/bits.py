"""A filter of bounded size over ids, to keep rows without a partner out of a shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .textops import mix

BITS = 1 << 27  # 16 MB at most; with more ids than it suits it lets more rows through, never fewer
SEGMENT = 1 << 20


def _at(ids: pa.Array, bits: int) -> np.ndarray:
    return (mix(ids.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)) % np.uint64(bits)).astype(np.int64)


def filter_of(df: DataFrame, column: str):
    """A broadcast bit set of the hashed ids in a column without nulls."""
    bits = int(min(BITS, max(SEGMENT, df.count() * 16)))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [_at(b.column(0), bits) for b in batches if b.num_rows]
        at = np.unique(np.concatenate(seen)) if seen else np.zeros(0, np.int64)
        cuts = np.flatnonzero(np.diff(at // SEGMENT, prepend=-1, append=-2))
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield pa.record_batch([pa.array([int(at[a] // SEGMENT)]),
                                   pa.array([(at[a:b] % SEGMENT).astype("<u4").tobytes()], pa.binary())], ["segment", "at"])

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = np.zeros(SEGMENT, bool)
        for b in batches:
            for x in b.column("at").to_pylist():
                one[np.frombuffer(x, "<u4")] = True
        yield pa.record_batch([pa.array([key[0].as_py()]), pa.array([np.packbits(one).tobytes()], pa.binary())],
                              ["segment", "bits"])

    merged = (df.select(column).mapInArrow(fill, "segment long, at binary").groupBy("segment")
              .applyInArrow(merge, "segment long, bits binary"))
    out = np.zeros(-(-bits // SEGMENT) * SEGMENT // 8, np.uint8)
    for r in merged.collect():  # BITS at most, whatever the number of ids
        out[r.segment * SEGMENT // 8:(r.segment + 1) * SEGMENT // 8] = np.frombuffer(r.bits, np.uint8)
    return df.sparkSession.sparkContext.broadcast((bits, out))


def may_hold(held, ids: np.ndarray) -> np.ndarray:
    """Marks of the ids (64-bit integers) that the filter may hold."""
    bits, table = held.value
    at = (mix(ids.view(np.uint64)) % np.uint64(bits)).astype(np.int64)
    return (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def possible(held, column: str):
    """For mapInArrow: the rows whose id the filter may hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                ids = b.column(column).to_numpy(zero_copy_only=False).astype(np.int64)
                yield b.filter(pa.array(may_hold(held, ids)))
    return run

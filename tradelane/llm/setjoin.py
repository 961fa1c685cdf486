"""Classes of texts whose shingle sets reach a Jaccard similarity, by a size-aware heavy-light join.

Sets of equal shingles are one from the start. Two sets of sizes a and b reach the similarity if and
only if they share a subset of a certain size, which a and b fix. Small sets therefore enumerate
all subsets of that size for every size a partner can have: those that meet in a subset are linked
without a look at each other. For large sets that would be too many; they scan inverted lists instead.
A set need only be in the lists of its rarest shingles, as many as a partner cannot all lack, and
what meets in a list is verified (``linking``). The boundary between small and large is where
enumerating and scanning together cost least, by the numbers of subsets and of list entries per size.

Rare means an order that is the same for all sets: shingles are counted exactly, packed in arrays by
ranges of their hash, and those in 2, 16 or 128 sets and more are held in filters of bounded size. A
shingle outside all filters is in one set only, so its list is not made; it keeps its place in the
order, so a text with many shingles of its own is in no list at all. Where a filter holds more than
it should, lists get longer, and the result stays the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bits import filter_of, may_hold
from .linking import Measure, connect, shared_buckets
from .minhash import shingles
from .tables import column, cut
from .textops import lowered, mix, slices

SHINGLE = 3
PERCENT = 90
WIDTH = 6  # bytes of a shingle's hash that are kept
LEVELS = (2, 16, 128)  # sets that hold a shingle, from which it counts as more frequent
RECORDS = 2_000_000  # of a range of hashes
BUFFER = 2_000_000  # shingles counted together by a task
SMALL_MOST = 40  # largest size for which enumerating is considered
SUBSETS = 50_000  # of a set, sent at a time
U = np.uint64

PROFILE = "row long, doc_id long, n int, k1 long, k2 long, ids binary"
_PROFILE_NAMES = [x.split()[0] for x in PROFILE.split(", ")]


def least_common(a: int, b: int, percent: int = PERCENT) -> int:
    """The least number of elements that sets of sizes a and b share if they are similar."""
    return -(-percent * (a + b) // (100 + percent))


def partners(a: int, percent: int = PERCENT) -> range:
    """The sizes of sets that one of size a can be similar to."""
    return range(-(-percent * a // 100), 100 * a // percent + 1)


def subset_count(a: int, percent: int = PERCENT) -> int:
    """How many subsets a set of size a enumerates."""
    return sum(comb(a, least_common(a, b, percent)) for b in _joined_sizes(a, percent))


def _joined_sizes(a: int, percent: int) -> list[int]:
    """Partner sizes for which subsets are needed: equal sets of equal sizes are one already."""
    return [b for b in partners(a, percent) if (least := least_common(a, b, percent)) <= min(a, b)
            and not a == b == least]


@cache
def _left_out(a: int, k: int) -> np.ndarray:
    """All choices of k of a places."""
    return np.array(list(combinations(range(a), k)), np.int64).reshape(comb(a, k), k)


def _pack(ids: np.ndarray) -> bytes:
    return ids.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WIDTH].tobytes()


def _unpack(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Place of the set and kept hash of all shingles of a batch."""
    sets = column.to_pylist()
    n = np.fromiter((len(x) // WIDTH for x in sets), np.int64, len(sets))
    raw = np.frombuffer(b"".join(sets), np.uint8).reshape(-1, WIDTH)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :WIDTH] = raw
    return np.repeat(np.arange(len(sets)), n), out.view("<u8").ravel()


def _profiles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, f in slices(batch):
                text, h, _ = shingles(lowered(f), k)
                per = np.bincount(text, minlength=f.n)
                ends = np.concatenate([[0], np.cumsum(per)])
                keys = []
                for s in (3, 5):  # sums do not depend on order
                    each = np.concatenate([[U(0)], np.cumsum(mix(h + U(s)))])
                    keys.append((each[ends[1:]] - each[ends[:-1]]).view(np.int64))
                kept = h >> U(64 - 8 * WIDTH)
                ids = [_pack(kept[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                yield pa.record_batch([rows.column("row"), rows.column("doc_id"), pa.array(per, pa.int32()),
                                       *(pa.array(x) for x in keys), pa.array(ids, pa.binary())], _PROFILE_NAMES)
    return run


class _Ranges:
    """Ranges of the kept hashes; within a range 32 bits tell shingles apart when they are counted."""

    def __init__(self, total: int, records: int):
        self.n = max(8, -(-total // records))

    def of(self, ids: np.ndarray) -> np.ndarray:
        return (ids >> U(8 * WIDTH - 32)) * U(self.n) >> U(32)

    def names(self, ids: np.ndarray) -> np.ndarray:
        """What a shingle is called in counts and filters; the same for all sets."""
        return ((self.of(ids) << U(32)) | (ids & U(0xFFFFFFFF))).view(np.int64)


def _count(ranges: _Ranges):
    """The distinct shingles of a task's sets with their number, packed by range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = TaskContext.get().partitionId() % 64
        held, n = [], 0

        def flush() -> pa.RecordBatch:
            names, c = np.unique(np.concatenate(held), return_counts=True)
            own, c = names.view(U), np.minimum(c, 0xFFFF).astype("<u2")
            range_, low = (own >> U(32)).astype(np.int64), (own & U(0xFFFFFFFF)).astype("<u4")
            cuts = np.flatnonzero(np.diff(range_, prepend=-1, append=-2))
            spans = list(zip(cuts.tolist(), cuts[1:].tolist(), strict=False))
            return pa.record_batch(
                [pa.array(range_[cuts[:-1]]), pa.array([piece] * len(spans), pa.int64()),
                 pa.array([low[a:b].tobytes() for a, b in spans], pa.binary()),
                 pa.array([c[a:b].tobytes() for a, b in spans], pa.binary())], ["range", "piece", "low", "c"])

        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                held.append(ranges.names(_unpack(batch.column("ids").slice(a, 512))[1]))
                n += len(held[-1])
                if n >= BUFFER:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()
    return run


def _added(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a range with their number, up to 65535, merged as they come."""
    low, c, wait, held = np.zeros(0, "<u4"), np.zeros(0, "<u2"), [], 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        own, back = np.unique(np.concatenate([low, *(x for x, _ in wait)]), return_inverse=True)
        total = np.bincount(back, np.concatenate([c, *(x for _, x in wait)]), len(own))
        return own, np.minimum(total, 0xFFFF).astype("<u2")

    for b in batches:
        for x, y in zip(b.column("low").to_pylist(), b.column("c").to_pylist(), strict=True):
            wait.append((np.frombuffer(x, "<u4"), np.frombuffer(y, "<u2")))
            held += len(wait[-1][0])
            if held > max(1_000_000, len(low)):
                low, c = merged()
                wait, held = [], 0
    return merged() if wait else (low, c)


def _merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    low, c = _added(batches)
    yield pa.record_batch([pa.array([key[0].as_py()]), pa.array([low.tobytes()], pa.binary()),
                           pa.array([c.tobytes()], pa.binary())], ["range", "low", "c"])


def _frequent(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    low, c = _added(batches)
    real = c >= LEVELS[0]
    names = (U(key[0].as_py()) << U(32) | low[real].astype(U)).view(np.int64)
    for a in range(0, len(names), 100_000):
        yield pa.record_batch([pa.array(names[a:a + 100_000]), pa.array(c[real][a:a + 100_000].astype(np.int32))], ["name", "c"])


def _rarest(ranges: _Ranges, filters: list, percent: int):
    """Each set's entries in the lists of its rarest shingles that others may have too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                rows = batch.slice(a, 512)
                own, ids = _unpack(rows.column("ids"))
                names = ranges.names(ids)
                level = np.zeros(len(ids), np.int8)
                on = np.arange(len(ids))
                for held in filters:  # what is in one filter is in those before it
                    on = on[may_hold(held, names[on])]
                    level[on] += 1
                order = np.lexsort((mix(ids), level, own))
                n = np.bincount(own, minlength=rows.num_rows)
                place = np.arange(len(ids)) - (np.cumsum(n) - n)[own]  # own rises in this order too
                lacking = n - (-(-percent * n // 100)) + 1
                chosen = order[(place < lacking[own]) & (level[order] > 0)]
                at = pa.array(own[chosen])
                yield pa.record_batch([rows.column("row").take(at), rows.column("n").take(at),
                                       pa.array(ids[chosen].view(np.int64))], ["row", "n", "bucket"])
    return run


def _subsets(percent: int):
    """All subsets of small sets in which a similar set would meet them."""
    names = ["row", "n", "a", "b", "k1", "k2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = zip(*(batch.column(c).to_pylist() for c in ("row", "n", "ids")), strict=True)
            for row, n, ids in columns:
                own = _unpack(pa.array([ids], pa.binary()))[1]
                each = [mix(own + U(s)) for s in (3, 5)]
                for b in _joined_sizes(n, percent):
                    out = _left_out(n, n - least_common(n, b, percent))
                    for x in range(0, len(out), SUBSETS):
                        k1, k2 = ((e.sum(dtype=U) - e[out[x:x + SUBSETS]].sum(1, dtype=U)).view(np.int64) for e in each)
                        m = len(k1)
                        yield pa.record_batch([pa.array([row] * m), *(pa.array([v] * m, pa.int32()) for v in (
                            n, min(n, b), max(n, b))), pa.array(k1), pa.array(k2)], names)
    return run


def small_links(profiles: DataFrame, percent: int = PERCENT) -> DataFrame:
    """row, one of small sets (row, n, ids) that share a subset with a similar set, directly or through ``one``."""
    each = profiles.mapInArrow(_subsets(percent), "row long, n int, a int, b int, k1 long, k2 long")
    each = cut(each, "subsets")
    keys = ["a", "b", "k1", "k2"]
    met = each.groupBy(*keys).agg(F.min("row").alias("one"), F.min("n").alias("lo"), F.max("n").alias("hi"),
                                  F.count(F.lit(1)).alias("c"))
    # of sets of one size those of the other size make the link; of equal sizes any two are linked
    met = cut(met.where("c > 1 and (a = b or lo < hi)").drop("lo", "hi", "c"), "subset-groups")
    return cut(each.join(met.hint("merge"), keys).where("row <> one").select("row", "one").distinct(), "small-links")


def boundary(sets: dict[int, int], scanned: dict[int, int], most: int = SMALL_MOST, percent: int = PERCENT) -> int:
    """The largest size whose sets are enumerated: where all subsets and list entries together are fewest.

    ``sets`` has the number of sets and ``scanned`` the entries of their lists by size.
    """
    def cost(x: int) -> int:
        least = -(-percent * (x + 1) // 100)  # smaller sets cannot be similar to a large one
        return (sum(c * subset_count(n, percent) for n, c in sets.items() if n <= x)
                + sum(c for n, c in scanned.items() if n >= least))
    return min(range(most + 1), key=lambda x: (cost(x), x))


def set_join(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, id_col: str = "doc_id",
             text_col: str = "text", records: int = RECORDS, small_most: int = SMALL_MOST,
             least_size: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Null and empty texts and those without words have no shingles and are alone; their component is
    their own id. Long texts are read whole. Rows that repeat are in one component; a null id counts
    only where no other row of the component has one. Equal texts with the same id stay as many rows. Other
    columns are not looked at. An empty table gives no rows. ``least_size`` fixes the boundary.
    """
    own = docs.select(F.monotonically_increasing_id().alias("row"), column(id_col).cast("long").alias("doc_id"),
                      F.coalesce(column(text_col), F.lit("")).alias("text"))
    profiles = cut(own.mapInArrow(_profiles(shingle), PROFILE), "sets")
    slim = profiles.select("row", "doc_id", "n", "k1", "k2")
    same = (slim.where("n > 0").groupBy("k1", "k2", "n").agg(F.min("row").alias("one"), F.count(F.lit(1)).alias("c"))
            .where("c > 1").drop("c"))
    named = cut(slim.join(cut(same, "equal-sets").hint("merge"), ["k1", "k2", "n"], "left").select(
        "row", "doc_id", "n", F.coalesce("one", "row").alias("one")), "set-classes")
    firsts = named.where("one = row and n > 0").select("row", "n")

    total = profiles.agg(F.sum("n").alias("n")).first().n or 0
    ranges = _Ranges(total, records)
    counted = (profiles.select("ids").mapInArrow(_count(ranges), "range long, piece long, low binary, c binary")
               .groupBy("range", "piece").applyInArrow(_merge, "range long, low binary, c binary")
               .groupBy("range").applyInArrow(_frequent, "name long, c int"))
    counted = cut(counted, "frequent-shingles")
    filters = [filter_of(counted.where(F.col("c") >= least).select("name"), "name") for least in LEVELS]
    rarest = profiles.select("row", "n", "ids").mapInArrow(_rarest(ranges, filters, percent), "row long, n int, bucket long")
    shared = shared_buckets(cut(rarest.join(firsts.select("row").hint("merge"), "row"), "rarest"))

    if least_size is None:
        few = F.col("n") <= 100 * small_most // percent + 1  # sizes, so no more rows than these
        sets = {r.n: r.c for r in firsts.where(few).groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()}
        scanned = {r.n: r.c for r in shared.where(few).groupBy("n").agg(F.sum("c").alias("c")).collect()}
        least_size = boundary(sets, scanned, small_most, percent)
    light = small_links(profiles.where(F.col("n").between(1, least_size)).select("row", "n", "ids").join(
        firsts.select("row").hint("merge"), "row"), percent)
    comp = connect(shared.where(F.col("n") * 100 >= percent * (least_size + 1)).select("row", "bucket", "c"),
                   profiles.withColumn("counts", F.lit(b"")), Measure(percent, WIDTH), light.toDF("one", "two"))
    comp = comp.toDF("one", "comp")
    found = cut(named.join(comp.hint("merge"), "one", "left").select(
        "doc_id", "n", F.coalesce("comp", "one").alias("comp")), "set-components")
    least = cut(found.groupBy("comp").agg(F.min("doc_id").alias("component_id")), "component-ids")
    return found.join(least.hint("merge"), "comp").select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")

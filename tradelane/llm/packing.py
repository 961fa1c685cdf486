"""Best-fit packing of token sequences by hierarchical residual rounds.

Each task packs its items best-fit, largest first, and emits the bins that are nearly full. The
others become single items of the next round, whose fewer tasks pack them again; what counts as
nearly full grows by round, and the last one emits everything. A task holds ITEMS items at most on
average; a bin holds no more members than it has tokens.

With ``in_order`` the order of the stored rows is kept, as mixing gives it: a task packs the items of
one range of WIDTH rows, bins that are left meet only those of neighbouring ranges, and sequences
are numbered by the mean place of their tokens. A piece that fills a sequence needs no task, so a
range has one item of each row at most, whatever the lengths.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import slices
from .tables import column, cut, placed, texts
from .tokens import encoder

CAPACITY = 2048
ITEMS = 100_000
SLACK = (16, 128, CAPACITY)  # free tokens with which a bin is emitted, by round
END = 0  # the id after each document
WIDTH = 2048  # rows of a range of the first round in order
FAN = 4  # neighbouring ranges that are one in the next round
TIES = 24  # bits of a sequence number below the place: two for the round, the others count

MEMBERS = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(),
           "ids_crc32": pa.int64()}
_BIN = ("sequence_id long, size long, " + ", ".join(
    f"{k} array<{'int' if t == pa.int32() else 'long'}>" for k, t in MEMBERS.items()))
_UNFOLDED = ", ".join(f"{k} {'int' if t == pa.int32() else 'long'}" for k, t in MEMBERS.items()) + (
    ", sequence_id long, offset long")


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Per piece of each row of ``docs`` (doc_id, text): doc_id, piece, start, length, ids_crc32.

    A document is its ids and then END. Longer ones than ``capacity`` are cut into pieces of that
    length, of which the first may be shorter. ``with_ids`` adds the ids themselves; a column
    ``place`` of ``docs`` comes along.
    """
    with_place = "place" in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, f in slices(batch):
                yield _cut_up(rows.column("doc_id"), *encoder(path)(f), capacity, with_ids,
                              rows.column("place") if with_place else None)

    more = (", ids array<long>" if with_ids else "") + (", place long" if with_place else "")
    return docs.mapInArrow(run, f"doc_id long, piece int, start long, length long, ids_crc32 long{more}")


def _cut_up(doc_id: pa.Array, ids: np.ndarray, at: np.ndarray, capacity: int, with_ids: bool,
            place: pa.Array | None = None) -> pa.RecordBatch:
    n = len(doc_id)
    whole = np.insert(ids, at[1:], np.uint32(END)).astype("<u4")
    at = at + np.arange(n + 1)
    size = np.diff(at)
    number = -(-size // capacity)
    first = size - (number - 1) * capacity
    doc = np.repeat(np.arange(n), number)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
    start = np.where(piece == 0, 0, first[doc] + (piece - 1) * capacity)
    length = np.where(piece == 0, first[doc], capacity)
    a = at[doc] + start
    crc = [zlib.crc32(whole[x:x + m].tobytes()) for x, m in zip(a.tolist(), length.tolist(), strict=True)]
    columns = {"doc_id": doc_id.take(pa.array(doc)), "piece": pa.array(piece, pa.int32()),
               "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
               "ids_crc32": pa.array(crc, pa.int64())}
    if with_ids:
        columns["ids"] = pa.array([whole[x:x + m] for x, m in zip(a.tolist(), length.tolist(), strict=True)],
                                  pa.list_(pa.int64()))
    if place is not None:
        columns["place"] = place.take(pa.array(doc))
    return pa.record_batch(list(columns.values()), list(columns))


def best_fit(size: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The bin of each item; ``size`` falls. An item goes where the least room is left after it."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by free tokens
    some, bins, out = 0, 0, np.zeros(len(size), np.int64)  # bit i of some: room[i] is not empty
    for i, s in enumerate(size.tolist()):
        fitting = some >> s
        if fitting:
            free = s + (fitting & -fitting).bit_length() - 1
            b = room[free].pop()
            if not room[free]:
                some ^= 1 << free
        else:
            free, b = capacity, bins
            bins += 1
        out[i] = b
        if free > s:
            room[free - s].append(b)
            some |= 1 << (free - s)
    return out


def _fill(t: pa.Table, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[pa.Array]]:
    """Order of the items of ``t``, bin of each in that order, size of the bins, their members."""
    t = t.combine_chunks()
    members = {k: t.column(k).combine_chunks() for k in MEMBERS}
    count = members["piece"].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    begin = np.cumsum(count) - count
    flat_ = {k: v.flatten() for k, v in members.items()}
    size = t.column("size").to_numpy()
    head = [flat_[k].take(pa.array(begin)).fill_null(-1).to_numpy() for k in ("piece", "ids_crc32", "doc_id")]
    order = np.lexsort([*head, -size])  # not the order of arrival
    bin_ = best_fit(size[order], capacity)
    by_bin = np.argsort(bin_, kind="stable")
    items, n = order[by_bin], int(bin_.max()) + 1
    per = count[items]
    take = pa.array(np.repeat(begin[items] - (np.cumsum(per) - per), per) + np.arange(per.sum()))
    cuts = pa.array(np.concatenate([[0], np.cumsum(np.bincount(bin_[by_bin], per, n))]).astype(np.int32))
    total = np.bincount(bin_, size[order], n).astype(np.int64)
    return order, bin_, total, [pa.ListArray.from_arrays(cuts, v.take(take)) for v in flat_.values()]


def _pack(round_: int, capacity: int):
    """All items of a task in, its bins out. An item is a bin of the round before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        _, _, total, members = _fill(pa.Table.from_batches(got), capacity)
        ids = (round_ << 56) + (TaskContext.get().partitionId() << 32) + np.arange(len(total))
        out = pa.record_batch([pa.array(ids), pa.array(total), *members], ["sequence_id", "size", *MEMBERS])
        for a in range(0, len(total), 5000):
            yield out.slice(a, 5000)
    return run


def _pack_range(round_: int, capacity: int):
    """All items of a range in, its bins out, each at the mean place of its tokens."""
    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        order, bin_, total, members = _fill(t, capacity)
        place, size = t.column("place").to_numpy()[order], t.column("size").to_numpy()[order]
        least = int(place.min())
        mean = least + np.bincount(bin_, (place - least) * size).astype(np.int64) // total
        by_place = np.argsort(mean, kind="stable")
        tie = np.empty(len(mean), np.int64)
        tie[by_place] = np.arange(len(mean)) - np.searchsorted(mean[by_place], mean[by_place])
        ids = (mean << TIES) + (round_ << TIES - 2) + tie
        return pa.table([pa.array(ids), pa.array(total), *members, pa.array(mean)],
                        ["sequence_id", "size", *MEMBERS, "place"])
    return run


def _unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            own = [b.column(k) for k in MEMBERS]
            per = own[1].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            values = [v.flatten() for v in own]
            ends = np.cumsum(values[3].to_numpy())
            starts = ends - values[3].to_numpy()
            first = np.repeat(starts[np.cumsum(per) - per], per)
            ids = np.repeat(b.column("sequence_id").to_numpy(), per)
            yield pa.record_batch([*values, pa.array(ids), pa.array(starts - first)],
                                  [*MEMBERS, "sequence_id", "offset"])


def pack(parts: DataFrame, capacity: int = CAPACITY, items: int = ITEMS, slack: tuple = SLACK) -> DataFrame:
    """``parts`` (as from ``pieces``) with sequence_id and offset; no sequence is over ``capacity``."""
    left = cut(parts.select(F.lit(0).cast("long").alias("sequence_id"), F.col("length").alias("size"),
                            *(F.array(k).alias(k) for k in MEMBERS)), "pieces")
    done = None
    for round_, free in enumerate(slack, 1):
        tasks = max(1, -(-left.count() // items))
        # dealt by what differs between items, so that hot documents are spread
        spread = left.repartition(tasks, F.xxhash64("sequence_id", "doc_id", "piece", "start", "ids_crc32"))
        packed = cut(spread.mapInArrow(_pack(round_, capacity), _BIN), f"bins-{round_}")
        full = packed.where(F.col("size") >= capacity - free)
        done = full if done is None else done.unionAll(full)
        left = packed.where(F.col("size") < capacity - free)
    return done.mapInArrow(_unfold, _UNFOLDED)


def pack_in_order(parts: DataFrame, capacity: int = CAPACITY, width: int = WIDTH, slack: tuple = SLACK) -> DataFrame:
    """``pack`` of ``parts`` with their ``place``: sequence_id rises along the places."""
    made = cut(parts.select(
        F.expr(f"shiftleft(place, {TIES}) + piece").alias("sequence_id"), F.col("length").alias("size"),
        *(F.array(k).alias(k) for k in MEMBERS), "place"), "pieces")
    done = made.where(F.col("size") == capacity).drop("place")
    left = made.where(F.col("size") < capacity)
    for round_, free in enumerate(slack, 1):
        ranges = left.groupBy(F.expr(f"place div {width * FAN ** (round_ - 1)}"))
        packed = cut(ranges.applyInArrow(_pack_range(round_, capacity), f"{_BIN}, place long"), f"bins-{round_}")
        done = done.unionAll(packed.where(F.col("size") >= capacity - free).drop("place"))
        left = packed.where(F.col("size") < capacity - free)
    return done.mapInArrow(_unfold, _UNFOLDED)


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                   in_order: bool = False) -> DataFrame:
    """Every document in sequences of at most CAPACITY tokens.

    Null and empty texts are the id END alone; long ones are cut into pieces. Rows that repeat are packed as
    often as they stand there; items of equal length go by what tells them apart, not by arrival. Other
    columns are not looked at. An empty table gives an empty result. With ``in_order``, ``docs`` is a stored
    table, and by sequence_id the sequences follow the order of its rows.
    """
    if in_order:
        rows = placed(docs).select(column(id_col, "kept").cast("long").alias("doc_id"),
                                   F.coalesce(column(text_col, "kept"), F.lit("")).alias("text"), "place")
        return pack_in_order(pieces(rows, path))
    return pack(pieces(texts(docs, id_col, text_col), path))

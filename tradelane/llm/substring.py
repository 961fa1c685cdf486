"""Repeated word windows by fixed-block anchors.

A window of WINDOW words anywhere contains a whole reference block, the blocks being the
non-overlapping runs of BLOCK words of each document. So two equal windows share a block of the
one, found at any place of the other: the blocks are the index, every rolling run of BLOCK words is
a probe, and a probe that meets the block of another place is an anchor. Around its anchors a
document's whole windows are hashed and counted; those that start twice or more are the exact
repeats. This takes the place of extending a hit word by word: the repeated windows that adjoin or
overlap make up the maximal repeat around the hit, and a word is removed exactly if one covers it.

Index and probes are dealt out by hash into shards of about RECORDS records, packed as arrays
(four bytes of hash and about one of place a probe), because there is one probe for every word.
A hash that is very frequent makes its shard large; such shards, known from a histogram, are split,
with the distinct blocks of the shard given to each part. No pairs of places are ever made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bits import filter_of, possible
from .tables import column, cut, numbered, of_numbered
from .textops import Flat, covered, mix, slices

WINDOW = 35
RECORDS = 3_000_000  # of a shard
SLOTS = 4096  # of the histogram
SAMPLED = 16  # every so many documents go into it; it only says which shards to split
BUFFER_WORDS = 1_000_000  # packed together
U = np.uint64
_ZSTD = pa.Codec("zstd", compression_level=1)


def joined(f: Flat, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The marked words of each text joined by one space, as bytes and offsets."""
    text, starts, ends = f.words
    text, starts, ends = text[keep], starts[keep], ends[keep]
    edges = np.zeros(len(f.data) + 1, np.int32)
    edges[starts] += 1
    edges[ends] -= 1
    inside = np.cumsum(edges[:-1]) > 0
    data = f.data.copy()
    follow = ends[:-1][text[1:] == text[:-1]]  # the byte after a word that another one follows
    data[follow] = 0x20
    inside[follow] = True
    return data[inside], np.concatenate([[0], np.cumsum(f.per_text(inside))])


def _digests(data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    view = memoryview(data.tobytes())
    return [hashlib.sha256(view[a:b]).digest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> U(52)).astype(np.int64)


def _base(block: int, window: int):
    """Per document: its words, their digest joined, and a key of the sequence; and the histograms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, SLOTS), np.int64)
        names = ["row", "doc_id", "n_words", "sha", "hist"]
        for batch in batches:
            for rows, f in slices(batch):
                text = f.words[0]
                sha = _digests(*joined(f, np.ones(len(text), bool)))
                yield pa.record_batch(
                    [rows.column("row"), rows.column("doc_id"), pa.array(np.bincount(text, minlength=f.n), pa.int64()),
                     pa.array(sha, pa.binary()), pa.nulls(f.n, pa.binary())], names)
                chosen = rows.column("row").to_numpy() % SAMPLED == 0
                for i, k in enumerate((block, window)):
                    at, h = f.windows(k)
                    seen[i] += np.bincount(_slot(h[chosen[text[at]]]), minlength=SLOTS)
        yield pa.record_batch([pa.array([-1]), pa.array([None], pa.int64()), pa.array([None], pa.int64()),
                               pa.array([None], pa.binary()), pa.array([seen.tobytes()], pa.binary())], names)
    return run


def _sum_histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, SLOTS), np.int64)
    for b in batches:
        for x in b.column("hist").to_pylist():
            total += np.frombuffer(x, np.int64).reshape(2, SLOTS)
    yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], ["hist"])


class Shards:
    """Which shard a hash belongs to and in how many parts the shard is split."""

    def __init__(self, hist: np.ndarray, records: int):
        total = int(hist.sum()) * SAMPLED
        self.n = max(8, -(-total // records))
        of_slot = np.maximum(1, np.ceil(hist * SAMPLED * min(1.0, SLOTS / self.n) / (2 * records))).astype(int)
        if self.n < SLOTS:
            load = np.bincount(np.arange(SLOTS) * self.n // SLOTS, hist * SAMPLED, self.n)
            self.parts = np.maximum(1, np.ceil(load / (2 * records))).astype(np.int64)
        else:
            self.parts = of_slot[np.arange(self.n) * SLOTS // self.n].astype(np.int64)

    def of(self, h: np.ndarray) -> np.ndarray:
        return ((h >> U(32)) * U(self.n) >> U(32)).astype(np.int64)


def _gaps(at: np.ndarray) -> bytes:
    """Rising places as compressed differences, byte planes apart."""
    steps = np.diff(at, prepend=0).astype("<u4")
    return _ZSTD.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes(), asbytes=True)


def _places(gaps: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(_ZSTD.decompress(gaps, 4 * n, asbytes=True), np.uint8).reshape(4, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64))


PACKED = "shard long, part long, buffer long, n long, hashes binary, flags binary, gaps binary, rows binary, sizes binary"
_PACKED_TYPES = [*[pa.int64()] * 4, *[pa.binary()] * 5]
_PACKED_NAMES = [x.split()[0] for x in PACKED.split(", ")]


class Packer:
    """Gathers records of many texts and packs them by shard; one more row lists the texts."""

    def __init__(self, shards: Shards, width: str):
        self.shards, self.width, self.flushed = shards, width, 0
        self._clear()

    def _clear(self) -> None:
        self.records, self.rows, self.sizes, self.words = [], [], [], 0

    def add(self, rows: np.ndarray, sizes: np.ndarray, at: np.ndarray, h: np.ndarray, value: np.ndarray,
            flag: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Records of one slice: word, the hash that deals, the hash that is compared, flag."""
        self.records.append((at + self.words, self.shards.of(h), value.astype(self.width), flag))
        self.rows.append(rows)
        self.sizes.append(sizes)
        self.words += int(sizes.sum())
        if self.words >= BUFFER_WORDS:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.rows:
            return
        buffer = (TaskContext.get().partitionId() << 24) + self.flushed
        at, shard, value, flag = (np.concatenate(x) for x in zip(*self.records, strict=True))
        order = np.argsort(shard.astype(np.uint16) if self.shards.n < 1 << 16 else shard, kind="stable")
        at, value, flag = at[order], value[order], flag[order]
        cuts = np.concatenate([[0], np.cumsum(np.bincount(shard, minlength=self.shards.n))])
        # dealt by a hash of task and flush: tasks that flush as often as each other do not meet in one part
        deal = int(mix(np.array([buffer], U))[0] >> U(1))
        out = [[-1 - buffer, 0, buffer, 0, None, None, None, np.concatenate(self.rows).astype("<i8").tobytes(),
                np.concatenate(self.sizes).astype("<i8").tobytes()]]
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            a, b = cuts[s], cuts[s + 1]
            out.append([s, deal % int(self.shards.parts[s]), buffer, int(b - a), value[a:b].tobytes(),
                        np.packbits(flag[a:b]).tobytes(), _gaps(at[a:b]), None, None])
        self.flushed += 1
        self._clear()
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _PACKED_TYPES, strict=True)],
                              _PACKED_NAMES)


def _blocks(f: Flat, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word and hash of every run of ``block`` words, and which of them are reference blocks."""
    at, h = f.windows(block)
    text = f.words[0]
    first = np.searchsorted(text, text[at]) if len(at) else at
    return at, h, (at - first) % block == 0


def _index(shards: Shards, block: int):
    """The reference blocks of a task, distinct, with their number up to 2."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            for _, f in slices(batch):
                _, h, reference = _blocks(f, block)
                found.append(h[reference])
        if found:
            yield from _distinct(np.concatenate(found), shards)
    return run


def _distinct(h: np.ndarray, shards: Shards) -> Iterator[pa.RecordBatch]:
    own, n = np.unique(h, return_counts=True)
    shard, low, n = shards.of(own), (own & U(0xFFFFFFFF)).astype("<u4"), np.minimum(n, 2).astype(np.uint8)
    cuts = np.flatnonzero(np.diff(shard, prepend=-1, append=-2))  # hashes rise, and so do shards
    part = TaskContext.get().partitionId()
    rows = [(int(shard[a]), part % int(shards.parts[shard[a]]), low[a:b].tobytes(), n[a:b].tobytes())
            for a, b in zip(cuts, cuts[1:], strict=False)]
    if rows:
        yield pa.record_batch([pa.array(c, t) for c, t in zip(
            zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
            ["shard", "piece", "hashes", "counts"])


def _add_counts(pairs: Iterator[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes with their summed numbers up to 2, merged as they come."""
    h, n, wait, held = np.zeros(0, "<u4"), np.zeros(0, np.uint8), [], 0
    for a, c in (*pairs, (None, None)):
        if a is not None:
            wait.append((np.frombuffer(a, "<u4"), np.frombuffer(c, np.uint8)))
            held += len(wait[-1][0])
        if wait and (a is None or held > max(1_000_000, len(h))):
            own, back = np.unique(np.concatenate([h, *(x for x, _ in wait)]), return_inverse=True)
            n = np.minimum(np.bincount(back, np.concatenate([n, *(x for _, x in wait)]), len(own)), 2).astype(np.uint8)
            h, wait, held = own, [], 0
    return h, n


def _merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    h, n = _add_counts((a, c) for b in batches for a, c in zip(
        b.column("hashes").to_pylist(), b.column("counts").to_pylist(), strict=True))
    yield pa.record_batch([pa.array([key[0].as_py()]), pa.array([h.tobytes()], pa.binary()),
                           pa.array([n.tobytes()], pa.binary())], ["shard", "hashes", "counts"])


def _probes(shards: Shards, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(shards, "<u4")
        for batch in batches:
            for rows, f in slices(batch):
                at, h, reference = _blocks(f, block)
                yield from packer.add(rows.column("row").to_numpy(), np.bincount(f.words[0], minlength=f.n),
                                      at, h, h & U(0xFFFFFFFF), reference)
        yield from packer.flush()
    return run


HITS = "buffer long, n long, gaps binary, rows binary, sizes binary"
_HIT_NAMES = [x.split()[0] for x in HITS.split(", ")]
_HIT_TYPES = [pa.int64(), pa.int64(), *[pa.binary()] * 3]


def _hit_rows(rows: list[list]) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _HIT_TYPES, strict=True)],
                              _HIT_NAMES)


def _meet(key: tuple[pa.Scalar, ...], probes: pa.Table, index: pa.Table) -> pa.Table:
    """Probes of one part of a shard that meet a block of another place."""
    if key[0].as_py() < 0:
        return probes.select(_HIT_NAMES)
    h = np.concatenate([np.zeros(0, "<u4"), *(np.frombuffer(x, "<u4") for x in index.column("hashes").to_pylist())])
    n = np.concatenate([np.zeros(0, np.uint8), *(np.frombuffer(x, np.uint8) for x in index.column("counts").to_pylist())])
    some = np.zeros(1 << 22, bool)
    some[h >> np.uint32(10)] = True
    out = []
    for r in probes.to_pylist() if len(h) else []:
        own = np.frombuffer(r["hashes"], "<u4")
        maybe = np.flatnonzero(some[own >> np.uint32(10)])
        place = np.minimum(np.searchsorted(h, own[maybe]), len(h) - 1)
        reference = np.unpackbits(np.frombuffer(r["flags"], np.uint8), count=r["n"])[maybe]
        hit = maybe[(h[place] == own[maybe]) & (n[place] > reference)]
        if len(hit):
            out.append([r["buffer"], len(hit), _gaps(_places(r["gaps"], r["n"])[hit]), None, None])
    if not out:
        return pa.table([pa.array([], t) for t in _HIT_TYPES], _HIT_NAMES)
    return pa.Table.from_batches(_hit_rows(out))


def _per_document(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words found in one buffer, by document."""
    rows = sizes = None
    found = [np.zeros(0, np.int64)]
    for b in batches:
        for r in b.to_pylist():
            if r["rows"] is not None:
                rows, sizes = np.frombuffer(r["rows"], "<i8"), np.frombuffer(r["sizes"], "<i8")
            else:
                found.append(_places(r["gaps"], r["n"]))
    at = np.sort(np.concatenate(found))
    if not len(at):
        return
    ends = np.cumsum(sizes)
    doc = np.searchsorted(ends, at, "right")
    at = (at - (ends - sizes)[doc]).astype("<u4")
    cuts = np.flatnonzero(np.diff(doc, prepend=-1, append=len(rows)))
    yield pa.record_batch(
        [pa.array(rows[doc[cuts[:-1]]]),
         pa.array([at[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())], ["row", "found"])


def _with_words(f: Flat, found: list[bytes]) -> np.ndarray:
    """The found words of each text as places among all words of the slice."""
    first = np.searchsorted(f.words[0], np.arange(f.n))
    return np.concatenate([np.zeros(0, np.int64), *(
        np.frombuffer(x, "<u4").astype(np.int64) + a for x, a in zip(found, first, strict=True))])


def _candidates(shards: Shards, block: int, window: int):
    """The whole windows around a document's anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(shards, "<u8")
        for batch in batches:
            for rows, f in slices(batch):
                text = f.words[0]
                at, h = f.windows(window)
                _, other = f.windows(window, 1)
                near = covered(np.maximum(_with_words(f, rows.column("found").to_pylist()) + block - window, 0),
                               window - block + 1, len(text) + window)[at]
                yield from packer.add(rows.column("row").to_numpy(), np.bincount(text, minlength=f.n),
                                      at[near], h[near], other[near], np.zeros(int(near.sum()), bool))
        yield from packer.flush()
    return run


COUNTED = f"shard long, {HITS}, hashes binary"
_COUNTED_TYPES, _COUNTED_NAMES = [pa.int64(), *_HIT_TYPES, pa.binary()], ["shard", *_HIT_NAMES, "hashes"]


def _count(parts: np.ndarray):
    """Windows whose hash is there twice or more; of a split shard also what is not decided yet."""
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, got = key[0].as_py(), [r for b in batches for r in b.to_pylist()]
        if shard < 0:
            out = [[None, r["buffer"], 0, None, r["rows"], r["sizes"], None] for r in got]
        else:
            h = np.concatenate([np.frombuffer(r["hashes"], "<u8") for r in got])
            own, back, n = np.unique(h, return_inverse=True, return_counts=True)
            twice, out, a = n[back] > 1, [], 0
            for r in got:
                t, own_h = twice[a:a + r["n"]], h[a:a + r["n"]]
                a += r["n"]
                at = _places(r["gaps"], r["n"])
                if t.any():
                    out.append([None, r["buffer"], int(t.sum()), _gaps(at[t]), None, None, None])
                if parts[shard] > 1 and not t.all():
                    out.append([shard, r["buffer"], int((~t).sum()), _gaps(at[~t]), None, None, own_h[~t].tobytes()])
            if parts[shard] > 1:
                known = own[n > 1]
                out.append([shard, -1, len(known), None, None, None, known.tobytes()])
        if out:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _COUNTED_TYPES, strict=True)],
                                  _COUNTED_NAMES)
    return run


def _count_rest(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What was single in each part of a split shard: each hash at most once a part, and so bounded."""
    got = [r for b in batches for r in b.to_pylist()]
    h = np.concatenate([np.frombuffer(r["hashes"], "<u8") for r in got])
    _, back, n = np.unique(h, return_inverse=True, return_counts=True)
    twice, out, a = n[back] > 1, [], 0
    for r in got:
        t = twice[a:a + r["n"]]
        a += r["n"]
        if r["buffer"] >= 0 and t.any():
            out.append([r["buffer"], int(t.sum()), _gaps(_places(r["gaps"], r["n"])[t]), None, None])
    yield from _hit_rows(out)


def _remove(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, f in slices(batch):
                text = f.words[0]
                gone = covered(_with_words(f, rows.column("found").to_pylist()), window, len(text))
                data, offsets = joined(f, ~gone)
                view = data.tobytes()
                kept = [view[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                yield pa.record_batch(
                    [rows.column("row"), pa.array(np.bincount(text[gone], minlength=f.n), pa.int64()),
                     pa.array(kept, pa.binary()).cast(pa.string())], ["row", "n_removed", "kept_text"])
    return run


def _only(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``docs`` joined with ``wanted`` by row; a filter of bounded size keeps most others from the shuffle."""
    held = filter_of(wanted, "row")
    schema = "row long, doc_id long, text string"
    return docs.mapInArrow(possible(held, "row"), schema).join(wanted, "row")


def removals(docs: DataFrame, window: int = WINDOW, records: int = RECORDS) -> tuple[DataFrame, DataFrame]:
    """Base table and removals of ``docs`` (row, doc_id, text).

    Base: row, doc_id, n_words, sha (of all words joined), copy (the same words stand elsewhere as
    a whole document). Removals: row, n_removed, kept_text of documents that lose some words and
    are no copies; a copy with ``window`` words or more loses all.
    """
    block = (window + 1) // 2
    found = cut(docs.mapInArrow(_base(block, window), "row long, doc_id long, n_words long, sha binary, hist binary"),
                "word-digests")
    hist = found.where("hist is not null").select("hist").coalesce(8).mapInArrow(_sum_histograms, "hist binary")
    total = sum((np.frombuffer(r.hist, np.int64).reshape(2, SLOTS) for r in hist.collect()),
                np.zeros((2, SLOTS), np.int64))
    probing, counting = Shards(total[0], records), Shards(total[1], records)

    base = found.where("hist is null").drop("hist")
    groups = (base.where(F.col("n_words") >= window).groupBy("sha").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("one"))
              .where("n > 1").select("sha", "one"))
    base = cut(base.join(cut(groups, "copied"), "sha", "left").select(
        "row", "doc_id", "n_words", "sha", F.col("one").isNotNull().alias("copy"),
        (F.col("one") != F.col("row")).alias("further")), "word-base")

    index = (docs.mapInArrow(_index(probing, block), "shard long, piece long, hashes binary, counts binary")
             .groupBy("shard", "piece").applyInArrow(_merge, "shard long, hashes binary, counts binary")
             .groupBy("shard").applyInArrow(_merge, "shard long, hashes binary, counts binary"))
    split = {int(s): int(probing.parts[s]) for s in np.flatnonzero(probing.parts > 1)}
    parts = F.lit(1)
    if split:  # no more entries than the histogram has slots, or shards
        parts = F.coalesce(F.create_map(*(F.lit(x) for kv in split.items() for x in kv))[F.col("shard").cast("int")], parts)
    index = index.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), (parts - 1).cast("long"))))
    probes = docs.mapInArrow(_probes(probing, block), PACKED)
    met = probes.groupBy("shard", "part").cogroup(index.groupBy("shard", "part")).applyInArrow(_meet, HITS)
    anchors = met.groupBy("buffer").applyInArrow(_per_document, "row long, found binary")
    # of copies of a whole document one is enough: it stands for the others' windows
    anchors = cut(anchors.join(base.where("not coalesce(further, false)").select("row"), "row"), "anchors")

    windows = _only(docs, anchors).select("row", "text", "found").mapInArrow(
        _candidates(counting, block, window), PACKED)
    counted = cut(windows.groupBy("shard", "part").applyInArrow(_count(counting.parts), COUNTED), "windows")
    hits = counted.where("shard is null").select(*_HIT_NAMES).unionAll(
        counted.where("shard is not null").groupBy("shard").applyInArrow(_count_rest, HITS))
    repeats = hits.groupBy("buffer").applyInArrow(_per_document, "row long, found binary")
    repeats = cut(repeats.join(base.where("not copy").select("row"), "row"), "repeats")
    return base, _only(docs, repeats).select("row", "text", "found").mapInArrow(
        _remove(window), "row long, n_removed long, kept_text string")


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                   records: int = RECORDS) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256, kept_text.

    Every word under a window of ``window`` words that also starts elsewhere goes. ``kept_text`` is
    null where nothing is removed (the words are the text's own) and empty where all are. Null and empty
    texts have no words; long ones are read whole. Rows that repeat are copies of each other, whose words
    all go from ``window`` words on. Other columns are not looked at; an empty table gives no rows.
    ``docs`` is read once and written with the numbers of its rows.
    """
    own = of_numbered(numbered(docs.select(column(id_col), column(text_col))), id_col, text_col)
    base, gone = removals(own, window, records)
    empty = hashlib.sha256(b"").hexdigest()
    return base.join(gone, "row", "left").select(
        "doc_id", "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copy"), F.lit(empty)).when(F.col("kept_text").isNull(), F.lower(F.hex("sha")))
        .otherwise(F.sha2(F.col("kept_text").cast("binary"), 256)).alias("kept_sha256"),
        F.when(F.col("copy"), F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"))

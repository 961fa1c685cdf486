r"""Ranked lexical search by pipelined term partitioning.

The documents are cut into shards of at most DOCS documents and about POSTINGS postings of the terms that
any item has, which are packed as arrays. Items are dealt into bundles. A term has one owner; owners follow each
other from the rarest terms to the most frequent ones, each with about the same number of postings. A
bundle visits every shard: there it goes from owner to owner, which is a cogroup with the
owner's postings of that shard, and carries a sparse accumulator of integer scores per item. What an
owner adds are whole numbers, so neither order nor partitioning changes a score.

Between owners an accumulator that cannot reach the ten best of its shard any more, not even with all
that the owners ahead can add, is left behind; the result is the same. After the last owner each shard
gives its ten best of an item, of which the ten best of all are taken. A frequent term is split by
shards, and no task holds more than one bundle in one shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .bits import filter_of, may_hold
from .tables import cut, texts
from .textops import Flat, lowered, slices

TOP = 10
OWNERS = 4
DOCS = 4096  # of a shard
POSTINGS = 2_000_000  # of a shard, after which it ends
ITEMS = 512  # of a bundle, on average; every bundle takes a copy of the postings, so bundles are large
SCALE = 1_000_000_000
MOST = SCALE // 1000  # no occurrence in a document adds more than this times the weight
U = np.uint64
# digits, letters and everything beyond ASCII
_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms(f: Flat) -> tuple[np.ndarray, np.ndarray]:
    """Text and 64-bit hash of every term, in order."""
    f = lowered(f)
    text, starts, ends = f.pieces(_TERM[f.data])
    return text, f.hashes(starts, ends).view(np.int64)


def _distinct(text: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and number of the distinct terms of each text."""
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (text[1:] != text[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    return text[at], h[at], np.diff(np.append(at, len(h)))


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, f in slices(batch):
            text, h, _ = _distinct(*terms(f))
            at = pa.array(text)
            yield pa.record_batch([rows.column("item").take(at), rows.column("item_id").take(at), pa.array(h)],
                                  ["item", "item_id", "h"])


SHARD = ("shard long, n_docs long, n_terms long, doc_ids array<long>, sizes binary, h binary, df binary, docs binary, "
         "tf binary")
_SHARD_NAMES = [x.split()[0] for x in SHARD.split(", ")]


def _shards(held, size: int, postings: int):
    """One row per ``size`` documents with terms, or fewer if they have many ``postings``: those of terms that an
    item may have, by term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId() << 32, 0
        ids, sizes, found = [], [], []
        held_docs = held_postings = 0

        def flush() -> pa.RecordBatch:
            doc, h, tf = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((doc, h))
            doc, h, tf = doc[order], h[order], tf[order]
            own, df = np.unique(h, return_counts=True)
            n = np.concatenate(sizes)
            doc_ids = pa.concat_arrays(ids)
            values = [pa.array([part + made]), pa.array([len(n)]), pa.array([int(n.sum())]),
                      pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), doc_ids),
                      *(pa.array([x.tobytes()], pa.binary()) for x in (
                          n.astype("<i8"), own.astype("<i8"), df.astype("<i8"), doc.astype("<u4"), tf.astype("<u4")))]
            return pa.record_batch(values, _SHARD_NAMES)

        for batch in batches:
            for whole, f_whole in slices(batch):
                for a in range(0, whole.num_rows, size):
                    b = min(a + size, whole.num_rows)
                    o = f_whole.offsets[a:b + 1]
                    f = Flat(f_whole.data[o[0]:o[-1]], o - o[0])
                    text, h = terms(f)
                    n = np.bincount(text, minlength=f.n)
                    real = np.flatnonzero(n)
                    if held_docs and (held_docs + len(real) > size or held_postings >= postings):
                        yield flush()
                        made, ids, sizes, found, held_docs, held_postings = made + 1, [], [], [], 0, 0
                    wanted = may_hold(held, h)
                    doc, h, tf = _distinct(text[wanted], h[wanted])
                    place = np.cumsum(n > 0) - 1 + held_docs
                    ids.append(whole.column("doc_id").slice(a, b - a).take(pa.array(real)))
                    sizes.append(n[real])
                    found.append((place[doc], h, tf))
                    held_docs += len(real)
                    held_postings += len(doc)
        if held_docs:
            yield flush()
    return run


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for h, df in zip(b.column("h").to_pylist(), b.column("df").to_pylist(), strict=True):
            yield pa.record_batch([pa.array(np.frombuffer(h, "<i8")), pa.array(np.frombuffer(df, "<i8"))], ["h", "df"])


DEALT = ("bundle long, shard long, owner int, doc_ids array<long>, items array<long>, item binary, h binary, w binary, "
         "owners binary, docs binary, scores binary")
_DEALT_NAMES = [x.split()[0] for x in DEALT.split(", ")]
_DEALT_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.binary()] * 6]


def _rows(out: list[list]) -> pa.Table:
    columns = list(zip(*out, strict=True)) if out else [[]] * len(_DEALT_TYPES)
    return pa.table([pa.array(c, t) for c, t in zip(columns, _DEALT_TYPES, strict=True)], _DEALT_NAMES)


def _deal(n_docs: int, n_terms: int):
    """A bundle at its shards: a row with the bundle's terms, and one with each owner's postings of them.

    A posting becomes what one occurrence of its term in the document adds for a weight of one.
    """
    def run(key: tuple[pa.Scalar, ...], bundle: pa.Table, shards: pa.Table) -> pa.Table:
        if not bundle.num_rows or not shards.num_rows:
            return _rows([])
        item, h, w, owner = (bundle.column(c).to_numpy() for c in ("item", "h", "w", "owner"))
        items, place = np.unique(item, return_inverse=True)
        order = np.lexsort((place, h))
        place, h, w, owner = place[order].astype("<u4"), h[order], w[order].astype("<i8"), owner[order].astype(np.uint8)
        out = []
        for r in shards.to_pylist():
            own, df = np.frombuffer(r["h"], "<i8"), np.frombuffer(r["df"], "<i8")
            docs, tf = np.frombuffer(r["docs"], "<u4"), np.frombuffer(r["tf"], "<u4").astype(np.int64)
            size = np.frombuffer(r["sizes"], "<i8")
            m = 10 + 90 * size * n_docs // n_terms
            each = SCALE * tf // (1000 * tf + 8 * m[docs])
            at = np.minimum(np.searchsorted(h, own), len(h) - 1)
            by = np.where(h[at] == own, owner[at], OWNERS)  # hashes that no item has belong to nobody
            per = np.repeat(by, df)
            out.append([key[0].as_py(), r["shard"], -1, r["doc_ids"], items.tolist(), place.tobytes(),
                        h.astype("<i8").tobytes(), w.tobytes(), owner.tobytes(), b"", b""])
            for o in np.unique(by[by < OWNERS]).tolist():
                out.append([key[0].as_py(), r["shard"], o, None, None, df[by == o].astype("<i8").tobytes(),
                            own[by == o].tobytes(), None, None, docs[per == o].tobytes(),
                            each[per == o].astype("<i8").tobytes()])
        return _rows(out)
    return run


def _best(scores: np.ndarray, top: int) -> int:
    """The score that ``top`` documents reach; 0 if fewer have one."""
    return int(np.partition(scores, len(scores) - top)[len(scores) - top]) if len(scores) >= top else 0


def _visit(owner: int, top: int, last: bool):
    """A bundle with its accumulators at one owner; at the last one what comes out is the best of the shard."""
    def run(key: tuple[pa.Scalar, ...], bundle: pa.Table, postings: pa.Table) -> pa.Table:
        r = bundle.to_pylist()[0]
        n, width = len(r["items"]), len(r["doc_ids"])
        total = np.zeros((n, width), np.int64)
        if r["docs"]:
            held = np.frombuffer(r["docs"], "<i8")
            total[held // width, held % width] = np.frombuffer(r["scores"], "<i8")
        place, h = np.frombuffer(r["item"], "<u4"), np.frombuffer(r["h"], "<i8")
        w, owners = np.frombuffer(r["w"], "<i8"), np.frombuffer(r["owners"], np.uint8)
        for p in postings.to_pylist():
            own, df = np.frombuffer(p["h"], "<i8"), np.frombuffer(p["item"], "<i8")
            docs, each = np.frombuffer(p["docs"], "<u4"), np.frombuffer(p["scores"], "<i8")
            ends = np.cumsum(df)
            first, after = np.searchsorted(h, own, "left"), np.searchsorted(h, own, "right")
            for a, b, x, y in zip((ends - df).tolist(), ends.tolist(), first.tolist(), after.tolist(), strict=True):
                for k in range(x, y):
                    total[place[k], docs[a:b]] += w[k] * each[a:b]
        if last:
            out_item, out_doc, out_score = [], [], []
            for i, x in enumerate(r["items"]):
                at = np.flatnonzero(total[i] >= max(1, _best(total[i], top)))
                ids = np.array([(d is not None, d or 0) for d in (r["doc_ids"][j] for j in at.tolist())], np.int64)
                at = at[np.lexsort((ids[:, 1], ids[:, 0], -total[i, at]))[:top]] if len(at) else at
                out_item += [x] * len(at)
                out_doc += [r["doc_ids"][j] for j in at.tolist()]
                out_score += total[i, at].tolist()
            return pa.table([pa.array(out_item, pa.int64()), pa.array(out_doc, pa.int64()),
                             pa.array(out_score, pa.int64())], ["item", "doc_id", "score"])
        ahead = np.bincount(place, np.where(owners > owner, w, 0), n).astype(np.int64) * MOST
        least = np.array([_best(x, top) for x in total]) if n else np.zeros(0, np.int64)
        at = np.flatnonzero((total > 0) & (total + ahead[:, None] >= least[:, None]))
        on = owners > owner
        return _rows([[r["bundle"], r["shard"], -1, r["doc_ids"], r["items"], place[on].tobytes(), h[on].tobytes(),
                       w[on].tobytes(), owners[on].tobytes(), at.astype("<i8").tobytes(),
                       total.reshape(-1)[at].tobytes()]])
    return run


def weighted_terms(items: DataFrame, shards: DataFrame, n_docs: int) -> DataFrame:
    """``items`` (item, h) with df, w and owner of their terms; terms that no document holds are left out."""
    df = shards.select("h", "df").mapInArrow(_document_counts, "h long, df long").groupBy("h").agg(F.sum("df").alias("df"))
    used = cut(df.join(items.select("h").distinct(), "h").withColumn(
        "w", F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1).cast("double")))), "terms")
    # weights are whole numbers of at most 1000 ln(2N + 2), so that many counts are held at most
    shares = [1 - i / OWNERS for i in range(1, OWNERS)]
    edges = used.agg(F.percentile("w", F.array(*map(F.lit, shares)), F.col("df")).alias("edges")).first().edges or []
    owner = sum((F.when(F.col("w") < e, 1).otherwise(0) for e in edges), F.lit(0))
    return items.join(used.withColumn("owner", owner.cast("int")), "h")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", shard_docs: int = DOCS,
           bundle_items: int = ITEMS, shard_postings: int = POSTINGS) -> DataFrame:
    """The ``top`` best documents of each row of ``items``: item_id, rank, doc_id, score.

    Null and empty texts have no terms: as documents they do not count, as items they find nothing.
    Long texts are read whole. Documents with the same score follow by doc_id, a null one first; rows
    that repeat are documents of their own, and so are items. Other columns of both tables are not
    looked at. Without documents or items there are no rows.
    """
    spark = docs.sparkSession
    asked = texts(items, item_col, item_text_col).select(
        F.monotonically_increasing_id().alias("item"), F.col("doc_id").alias("item_id"), "text")
    asked = cut(asked.mapInArrow(_item_terms, "item long, item_id long, h long"), "item-terms")
    schema = "item_id long, rank int, doc_id long, score long"
    n_items = asked.select("item").distinct().count()
    made = _shards(filter_of(asked, "h"), shard_docs, shard_postings)
    shards = cut(texts(docs, id_col, text_col).mapInArrow(made, SHARD), "shards")
    n = shards.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms"), F.count(F.lit(1)).alias("shards")).first()
    if not n_items or not n.shards:
        return spark.createDataFrame([], schema)

    bundles = max(1, -(-n_items // bundle_items))
    known = weighted_terms(asked, shards, n.docs).withColumn("bundle", F.pmod(F.xxhash64("item"), F.lit(bundles)))
    known = cut(known.select("bundle", "item", "h", "w", "owner"), "bundles")
    each = known.withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n.shards - 1).cast("long"))))
    spread = (shards.withColumn("slot", F.pmod(F.xxhash64("shard"), F.lit(n.shards)))
              .withColumn("bundle", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bundles - 1).cast("long")))))
    dealt = cut(each.groupBy("bundle", "slot").cogroup(spread.groupBy("bundle", "slot")).applyInArrow(
        _deal(n.docs, n.terms), DEALT), "dealt")
    carried = dealt.where("owner = -1")
    for owner in range(OWNERS):
        # columns of their own, so that the sides can be told apart
        postings = dealt.where(F.col("owner") == owner).toDF(*_DEALT_NAMES)
        last = owner == OWNERS - 1
        carried = carried.groupBy("bundle", "shard").cogroup(postings.groupBy("bundle", "shard")).applyInArrow(
            _visit(owner, top, last), "item long, doc_id long, score long" if last else DEALT)
    rank = F.row_number().over(W.partitionBy("item").orderBy(F.desc("score"), F.asc("doc_id")))
    best = carried.withColumn("rank", rank).where(F.col("rank") <= top)
    return best.join(asked.select("item", "item_id").distinct(), "item").select("item_id", "rank", "doc_id", "score")

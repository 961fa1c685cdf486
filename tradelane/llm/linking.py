"""Classes of similar texts from buckets, without ever expanding a bucket into its pairs.

Texts that may be similar share a bucket. In a bucket each member is compared with one leader, the one
whose buckets are largest, which is the text that others were copied from if there is one. In buckets
that hold several components after that, those outside the main one meet the members of other
components in blocks: a task counts what all texts of two blocks have in common by one product of matrices
over the items that both sides have, and gives out links only. Counts are whole numbers, so the test
is exact.

Rows are dealt by bucket only in joins with one stored row per bucket, whose hot buckets AQE can
split; what a bucket's members add up to is combined before it is dealt.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bits import filter_of, possible
from .tables import cut

BLOCK = 512  # rows of a side that are compared in one task
COLUMNS = 4096  # items of a product at a time
UNARY = 16  # counts beyond this are bounded in doubling steps


@dataclass(frozen=True)
class Measure:
    """Two texts are similar from ``percent`` on, by sets or, if ``counted``, by counts as well.

    A profile is ``ids``, the items in ``width`` bytes each, and ``counts`` (4 bytes each; empty if all are 1).
    """

    percent: int
    width: int = 4
    counted: bool = False

    def items(self, ids: bytes) -> np.ndarray:
        raw = np.frombuffer(ids, np.uint8).reshape(-1, self.width)
        out = np.zeros((len(raw), 8), np.uint8)
        out[:, :self.width] = raw
        return out.view("<u8").ravel()

    def similar(self, a: bytes, b: bytes, count_a: bytes, count_b: bytes) -> bool:
        x, y = self.items(a), self.items(b)
        if not len(x) or not len(y):
            return False
        common = len(np.intersect1d(x, y))
        if 100 * common >= self.percent * (len(x) + len(y) - common):
            return True
        if not self.counted or not count_a and not count_b:
            return False
        return probability_jaccard(*weights(x, y, count_a, count_b)) * 100 >= self.percent


def weights(x: np.ndarray, y: np.ndarray, count_x: bytes, count_y: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The counts of two profiles over the items of both."""
    own = np.union1d(x, y)
    out = []
    for items, counts in ((x, count_x), (y, count_y)):
        w = np.zeros(len(own))
        np.add.at(w, np.searchsorted(own, items), np.frombuffer(counts, "<u4") if counts else 1)
        out.append(w)
    return out[0], out[1]


def probability_jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """Sum over i of 1 / sum over j of max(x_j/x_i, y_j/y_i); x and y are weights of the same items."""
    with np.errstate(divide="ignore"):
        ratio = np.where(x > 0, y / np.maximum(x, 1e-300), np.inf)
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    upto = np.searchsorted(ratio, ratio, "right")
    px, py = np.concatenate([[0], np.cumsum(x)]), np.concatenate([[0], np.cumsum(y)])
    both = (x > 0) & (y > 0)
    return float((1 / (px[upto[both]] / x[both] + (py[-1] - py[upto[both]]) / y[both])).sum())


class _Side:
    """Texts of a block: their items one after another, with text and count."""

    def __init__(self, ids: list[bytes], counts: list[bytes], measure: Measure):
        items = [measure.items(x) for x in ids]
        self.n = np.array([len(x) for x in items], np.int64)
        self.text, self.item = np.repeat(np.arange(len(items)), self.n), np.concatenate([np.zeros(0, np.uint64), *items])
        self.count = np.concatenate([np.zeros(0, np.int64), *(
            np.frombuffer(c, "<u4").astype(np.int64) if c else np.ones(n, np.int64)
            for c, n in zip(counts, self.n.tolist(), strict=True))])
        self.total = np.bincount(self.text, self.count, len(items))


def _product(x: tuple[np.ndarray, ...], y: tuple[np.ndarray, ...], n: int, m: int) -> np.ndarray:
    """Sum over the items (as text, item, value) that texts of both sides have of the products of values."""
    own = np.intersect1d(x[1], y[1])
    out = np.zeros((n, m))
    sides = []
    for text, item, value in (x, y):
        at = np.searchsorted(own, item)
        real = (at < len(own)) & (own[np.minimum(at, len(own) - 1)] == item) if len(own) else np.zeros(len(item), bool)
        order = np.argsort(at[real], kind="stable")
        sides.append((text[real][order], at[real][order], value[real][order]))
    for a in range(0, len(own), COLUMNS):
        dense = []
        for (text, at, value), rows in zip(sides, (n, m), strict=True):
            lo, hi = np.searchsorted(at, [a, a + COLUMNS])
            one = np.zeros((rows, min(COLUMNS, len(own) - a)), np.float32)
            one[text[lo:hi], at[lo:hi] - a] = value[lo:hi]
            dense.append(one)
        out += dense[0] @ dense[1].T
    return out


def _unary(s: _Side) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, item, level and weight, so that equal levels add up to the lesser count (or more, past UNARY)."""
    edges = [*range(1, UNARY + 1)]
    while edges[-1] < (s.count.max() if len(s.count) else 0):
        edges.append(edges[-1] * 2)
    text, item, level, weight = [], [], [], []
    for k, e in enumerate(edges):
        least = e if k < UNARY else edges[k - 1] + 1
        on = s.count >= least
        text.append(s.text[on])
        item.append(s.item[on])
        level.append(np.full(int(on.sum()), k, np.uint64))
        weight.append(np.full(int(on.sum()), 1.0 if k < UNARY else float(e - edges[k - 1])))
    return tuple(map(np.concatenate, (text, item, level, weight)))


def _named(item: np.ndarray, tag: np.ndarray) -> np.ndarray:
    """One 64-bit name of an item of at most 48 bits and a tag; larger tags may share names, which only adds."""
    return (item << np.uint64(16)) | np.minimum(tag.astype(np.uint64), np.uint64(0xFFFF))


def similar_pairs(x: _Side, y: _Side, measure: Measure) -> tuple[np.ndarray, np.ndarray]:
    """Marks of the pairs of two blocks that are similar, and of those that a look at both texts must decide.

    With equal counts an item adds count / (union of counts) to the probability Jaccard similarity;
    an item whose counts differ adds at most its lesser share. So it lies between two sums over
    products, and only pairs around the bound are left open.
    """
    n, m = len(x.n), len(y.n)
    common = _product((x.text, x.item, np.ones(len(x.item))), (y.text, y.item, np.ones(len(y.item))), n, m)
    linked = 100 * common >= measure.percent * (x.n[:, None] + y.n[None] - common)
    linked &= (x.n > 0)[:, None] & (y.n > 0)[None]
    open_ = np.zeros((n, m), bool)
    if measure.counted and ((x.count > 1).any() or (y.count > 1).any()):
        ux, uy = _unary(x), _unary(y)
        lesser = _product((ux[0], _named(ux[1], ux[2]), np.ones(len(ux[0]))), (uy[0], _named(uy[1], uy[2]), uy[3]), n, m)
        equal = _product((x.text, _named(x.item, x.count), x.count), (y.text, _named(y.item, y.count), np.ones(len(y.item))), n, m)
        total = x.total[:, None] + y.total[None]
        least = np.maximum(np.minimum(x.total[:, None], y.total[None]), 1)
        most = np.minimum(lesser, least)
        upper = equal / np.maximum(total - most, 1) + np.maximum(most - equal, 0) / least
        uneven_x = np.bincount(x.text[x.count > 1], minlength=n) > 0
        uneven_y = np.bincount(y.text[y.count > 1], minlength=m) > 0
        open_ = ~linked & (uneven_x[:, None] | uneven_y[None]) & (100 * upper >= measure.percent - 1e-3)
    return linked, open_


def _meet(measure: Measure):
    """Links of a block of texts outside a main component with a block of others near it."""
    def run(key: tuple[pa.Scalar, ...], outside: pa.Table, others: pa.Table) -> pa.Table:
        x, y = outside.to_pydict(), others.to_pydict()
        one, two = [], []
        if x["row"] and y["row"]:
            linked, open_ = similar_pairs(_Side(x["ids"], x["counts"], measure),
                                          _Side(y["ids"], y["counts"], measure), measure)
            row_x, row_y, comp_x, comp_y = (np.array(s[c]) for c in ("row", "comp") for s in (x, y))
            wanted = (comp_x[:, None] != comp_y[None]) & (np.array(y["inner"])[None] | (row_y[None] > row_x[:, None]))
            names, at = np.unique(comp_y, return_inverse=True)
            for i, r in enumerate(row_x.tolist()):
                known = np.zeros(len(names), bool)  # one link to a component is enough
                j = np.flatnonzero(linked[i] & wanted[i])
                first = j[np.unique(at[j], return_index=True)[1]]
                known[at[first]] = True
                one += [r] * len(first)
                two += row_y[first].tolist()
                for k in np.flatnonzero(open_[i] & wanted[i]).tolist():
                    if not known[at[k]] and measure.similar(x["ids"][i], y["ids"][k], x["counts"][i], y["counts"][k]):
                        known[at[k]] = True
                        one.append(r)
                        two.append(int(row_y[k]))
        return pa.table([pa.array(one, pa.int64()), pa.array(two, pa.int64())], ["one", "two"])
    return run


def _verify(measure: Measure):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                good = [measure.similar(*v) for v in zip(
                    *(b.column(c).to_pylist() for c in ("ids", "ids2", "counts", "counts2")), strict=True)]
                yield b.select(["one", "two"]).filter(pa.array(good, pa.bool_()))
    return run


def _links(pairs: DataFrame, profiles: DataFrame, measure: Measure, name: str) -> DataFrame:
    """The pairs (one, two) that are similar; each side's profile is fetched by its row."""
    pairs = cut(pairs, f"{name}-pairs")
    held = filter_of(pairs.select(F.col("one").alias("row")).union(pairs.select("two")), "row")
    own = profiles.select("row", "ids", "counts").mapInArrow(
        possible(held, "row"), "row long, ids binary, counts binary")
    # merged at every size: the pairs grow with the data, and AQE can split a hot leader
    both = (pairs.hint("merge").join(own.withColumnRenamed("row", "one"), "one").hint("merge")
            .join(own.toDF("two", "ids2", "counts2"), "two"))
    return cut(both.mapInArrow(_verify(measure), "one long, two long"), name)


def components(links: DataFrame) -> DataFrame:
    """row, comp (its smallest connected row) of every row of the stored ``links`` (one, two).

    Rows are contracted to their least neighbours until no link is left.
    """
    edges = links.select(F.col("one").alias("a"), F.col("two").alias("b")).where("a <> b")
    ways = edges.union(edges.select("b", "a"))
    found = ways.select(F.col("a").alias("row"), F.col("a").alias("comp")).distinct()
    while True:
        least = cut(ways.groupBy("a").agg(F.min("b").alias("m")).where("m < a"), "least")
        if least.isEmpty():
            return cut(found, "components")
        found = found.join(least.toDF("comp", "m"), "comp", "left").select("row", F.coalesce("m", "comp").alias("comp"))
        moved = (edges.join(least, "a", "left").select(F.coalesce("m", "a").alias("a"), "b")
                 .join(least.toDF("b", "m"), "b", "left").select("a", F.coalesce("m", "b").alias("b")))
        edges = cut(moved.where("a <> b").distinct(), "edges")
        ways = edges.union(edges.select("b", "a"))


def _joined(comp: DataFrame, links: DataFrame) -> DataFrame:
    """``comp`` (row, comp) after more links; rows that are in no link yet may be missing in it."""
    end = comp.toDF("one", "c1"), comp.toDF("two", "c2")
    between = cut(links.join(end[0], "one", "left").join(end[1], "two", "left")
                  .select(F.coalesce("c1", "one").alias("one"), F.coalesce("c2", "two").alias("two"))
                  .where("one <> two").distinct(), "between")
    if between.isEmpty():
        return comp
    more = components(between)
    known = comp.join(more.toDF("comp", "to"), "comp", "left").select("row", F.coalesce("to", "comp").alias("comp"))
    new = more.join(comp.select("row"), "row", "left_anti")
    return cut(known.unionByName(new), "joined")


def shared_buckets(each: DataFrame) -> DataFrame:
    """The rows of the stored ``each`` (row, bucket, ...) whose bucket holds others too, with c, how many it holds."""
    sizes = each.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    # the stored side is unique, so AQE can split a hot bucket on the other
    return cut(each.join(cut(sizes, "buckets").hint("merge"), "bucket"), "shared")


def _near(members: DataFrame, comp: DataFrame) -> DataFrame:
    """main, row, comp of the members of buckets that hold several components; main is the bucket's largest."""
    named = cut(members.join(comp.hint("merge"), "row", "left").select(
        "bucket", "row", F.coalesce("comp", "row").alias("comp")), "named")
    sizes = named.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("bucket").agg(F.max(F.struct("n", "comp")).alias("x"), F.count(F.lit(1)).alias("k")).where("k > 1")
    main = cut(main.select("bucket", F.col("x.comp").alias("main")), "main")
    return cut(named.join(main.hint("merge"), "bucket").select("main", "row", "comp").distinct(), "near")


def connect(shared: DataFrame, profiles: DataFrame, measure: Measure, known: DataFrame | None = None) -> DataFrame:
    """row, comp of the rows that are similar to another, directly or by others.

    ``shared`` is stored: row, bucket, c, as from ``shared_buckets``. ``profiles`` has row, ids, counts.
    ``known`` are links (one, two) that are found already.
    """
    # the text that others were copied from keeps to the large buckets: it leads them
    central = shared.groupBy("row").agg(F.sum("c").alias("c"))
    members = cut(shared.select("row", "bucket").join(central.hint("merge"), "row"), "members")
    lead = cut(members.groupBy("bucket").agg(F.max(F.struct("c", (-F.col("row")).alias("r"))).alias("x")), "leaders")
    pairs = members.join(lead.hint("merge"), "bucket").select(
        F.col("row").alias("one"), (-F.col("x.r")).alias("two")).where("one <> two").distinct()
    links = _links(pairs, profiles, measure, "links")
    comp = components(links if known is None else links.unionByName(known))
    near = _near(members, comp)
    return comp if near.isEmpty() else _joined(comp, _rest_links(near, profiles, measure))


def _rest_links(near: DataFrame, profiles: DataFrame, measure: Measure) -> DataFrame:
    """Links between the rows outside a main component and all that share a bucket of it with them.

    ``near`` is stored: main, row, comp. Rows are dealt by main component, in blocks of BLOCK by BLOCK rows, so a
    task holds no more than two blocks; what goes out is links, never candidates.
    """
    held = filter_of(near.select("row"), "row")
    own = profiles.select("row", "ids", "counts").mapInArrow(
        possible(held, "row"), "row long, ids binary, counts binary")
    sizes = near.groupBy("main").agg(
        F.ceil(F.count_if(F.col("comp") != F.col("main")) / BLOCK).alias("n_i"),
        F.ceil(F.count(F.lit(1)) / BLOCK).alias("n_j")).where("n_i > 0")
    both = (near.hint("merge").join(own, "row").join(cut(sizes, "near-sizes"), "main")
            .withColumn("inner", F.col("comp") == F.col("main")))
    both = cut(both, "near-profiles")

    def blocks(df: DataFrame, mine: str, all_: str) -> DataFrame:
        """Every row in its own block of one kind, beside all blocks of the other kind."""
        of, other = {"i": ("n_i", "n_j"), "j": ("n_j", "n_i")}[mine]
        return df.select(
            "main", F.pmod(F.xxhash64("row"), F.col(of)).alias(mine),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(all_),
            "row", "comp", "inner", "ids", "counts")

    left, right = blocks(both.where("not inner"), "i", "j"), blocks(both, "j", "i")
    right = right.toDF(*right.columns)  # columns of their own, so that the sides can be told apart
    met = left.groupBy("main", "i", "j").cogroup(right.groupBy("main", "i", "j")).applyInArrow(
        _meet(measure), "one long, two long")
    return cut(met, "near-links")

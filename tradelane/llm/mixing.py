"""Mixing sources to target weights by Pfair scheduling.

A source is cut into blocks of equal size. With weight q/P, block j of a source is released at slot
floor(j*P/q) and due by slot ceil((j+1)*P/q); in each slot the released block that is due earliest
goes. Every block then meets its deadline, so at any time each source is less than one block away
from its share. Release times and deadlines repeat with period P, so one period is scheduled and every
block of the table is placed by arithmetic.

More than FAN sources are scheduled as a tree: groups of sources share out the slots first, by the sums
of their weights, then the members of each group share out its slots, each group in a row of its own.
All levels use the releases and deadlines in the slots of the whole. A group that keeps to its own
has, between any two times, at least as many slots as its members have blocks that must go there, so
every member keeps to its own as well: less than one block away, as if all had been scheduled at once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .tables import column, cut, whole

BLOCK = 200_000  # characters; each document counts one more
PERIOD = 1000  # slots at least
LEAST = 50  # slots of the lightest source, so that rounding changes a weight by 1 % at most,
EACH = 100  # ... unless that takes more slots than so many a source; then the lightest have one slot each
FAN = 64  # sources or groups that are scheduled in one row, on average
CHUNK = 512  # slots whose owners are gathered before they are put to the others
ALPHA = 0.5  # default weights: size of the source to this power
BUCKET_ROWS = 10_000


def default_weights(sizes: DataFrame, alpha: float = ALPHA) -> DataFrame:
    return sizes.select("source", F.pow(F.col("size").cast("double"), F.lit(alpha)).alias("weight"))


def _earliest_due(members: Column, times: Column, period: int) -> Column:
    """Who gets each of the slots ``times``: place among ``members`` (structs with q) and how many it had before."""
    def step(acc, t):
        open_ = F.transform(members, lambda x, i: F.when(
            (F.get(acc["done"], i) < x["q"]) & (F.floor(F.get(acc["done"], i) * F.lit(period) / x["q"]) <= t),
            F.struct(F.ceil((F.get(acc["done"], i) + 1) * F.lit(period) / x["q"]).alias("due"), i.alias("i"))))
        chosen = F.array(F.array_min(open_)["i"])  # bound to a name, so that it is worked out once
        return F.get(F.transform(chosen, lambda k: F.struct(
            F.transform(acc["done"], lambda d, i: d + (i == k).cast("long")).alias("done"),
            F.concat(acc["out"], F.array(F.struct(t.alias("slot"), k.alias("i"), F.get(acc["done"], k).alias("nth")))).alias("out"))), 0)

    none = F.array().cast("array<struct<slot:int,i:int,nth:bigint>>")
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(times) - 1) / CHUNK).cast("int")),
                         lambda k: F.slice(times, k * CHUNK + 1, F.lit(CHUNK)))

    def chunk(acc, some):
        done = F.array(F.aggregate(some, F.struct(acc["done"].alias("done"), none.alias("out")), step))
        return F.get(F.transform(done, lambda x: F.struct(
            x["done"].alias("done"), F.concat(acc["out"], x["out"]).alias("out"))), 0)

    start = F.struct(F.transform(members, lambda x: F.lit(0).cast("long")).alias("done"), none.alias("out"))
    return F.aggregate(chunks, start, chunk)["out"]


def slots(weights: DataFrame, period: int = PERIOD, fan: int = FAN) -> DataFrame:
    """One period of the schedule: source, nth (block of the source in the period), slot, q, period.

    ``weights`` has source and weight, one row per source; sources with weight 0 or null get none. The
    period grows with the lightest weight. Ties go by the order of the names (of the groups first).
    """
    own = cut(weights.where("weight > 0").select("source", "weight"), "mix-weights")
    of = own.agg(F.sum("weight").alias("all"), F.min("weight").alias("least"), F.count(F.lit(1)).alias("n")).first()
    if not of.n:
        return own.select("source", *(F.lit(0).cast(t).alias(c) for c, t in (
            ("nth", "long"), ("slot", "int"), ("q", "int"), ("period", "int"))))
    asked = max(period, min(math.ceil(LEAST * of["all"] / of.least), EACH * of.n))
    groups = 1 if of.n <= fan else -(-of.n // fan)
    q = F.greatest(F.lit(1), F.round(F.col("weight") / F.lit(of["all"]) * asked).cast("int"))
    members = cut(own.select(F.pmod(F.xxhash64("source"), F.lit(groups)).alias("parent"), F.col("source").alias("child"),
                             q.alias("q")), "mix-sources")
    whole_ = members.agg(F.sum("q")).first()[0]  # the period in the end
    tree = [members]
    while groups > 1:
        groups = 1 if groups <= fan else -(-groups // fan)
        tree.append(tree[-1].groupBy("parent").agg(F.sum("q").cast("int").alias("q")).select(
            F.pmod("parent", F.lit(groups)).alias("parent"), F.col("parent").alias("child"), "q"))
    times = own.sparkSession.range(1).select(F.col("id").alias("parent"), F.sequence(F.lit(0), F.lit(whole_ - 1)).alias("times"))
    for level in reversed(tree):
        one = level.groupBy("parent").agg(F.sort_array(F.collect_list(F.struct("child", "q"))).alias("members"))
        # stored, so that nothing is worked out anew for each slot
        one = cut(one.join(times, "parent"), "mix-groups")
        dealt = one.select("members", F.explode(_earliest_due(F.col("members"), F.col("times"), whole_)).alias("x")).select(
            F.get("members", F.col("x.i"))["child"].alias("child"), F.get("members", F.col("x.i"))["q"].alias("q"),
            F.col("x.slot").alias("slot"), F.col("x.nth").alias("nth"))
        dealt = cut(dealt, "mix-dealt")
        times = dealt.groupBy("child").agg(F.sort_array(F.collect_list("slot")).alias("times")).withColumnRenamed("child", "parent")
    return dealt.select(F.col("child").alias("source"), "nth", "slot", "q", F.lit(whole_).cast("int").alias("period"))


def schedule(docs: DataFrame, weights: DataFrame | None = None, block: int = BLOCK, period: int = PERIOD,
             id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row: kept (all columns of ``docs``), doc_id, source, key, size, block, slot, in_mix.

    Within a source documents follow each other by the MD5 of their id; a document belongs to the
    block in which it starts, and one longer than a block takes the slots of several. In order of
    slot, then key, the sources stand in their target weights until the first of them is used up
    (``in_mix``); all rows are kept, so after that the others go on alone in theirs. A null source
    is the source ''; sources without a weight have a null slot and come last. Null and empty texts count
    one character. Rows that repeat follow each other; an empty table gives no rows.
    """
    text = F.coalesce(column(text_col, "kept"), F.lit(""))
    rows = docs.select(whole(docs)).select(
        "kept", column(id_col, "kept").cast("long").alias("doc_id"),
        F.coalesce(column(source_col, "kept"), F.lit("")).alias("source"),
        F.md5(F.coalesce(column(id_col, "kept").cast("string"), F.lit(""))).alias("key"),
        (F.length(text) + 1).cast("long").alias("size"))
    digits = max(1, math.ceil(math.log(max(docs.count(), 1) / BUCKET_ROWS, 16))) if BUCKET_ROWS else 1
    rows = rows.withColumn("bucket", F.substring("key", 1, digits))

    parts = cut(rows.groupBy("source", "bucket").agg(F.sum("size").alias("size")), "mix-parts")
    before = F.sum("size").over(W.partitionBy("source").orderBy("bucket")
                                .rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("size")
    sizes = parts.groupBy("source").agg(F.sum("size").alias("size"))
    weights = default_weights(sizes) if weights is None else weights.select(
        F.coalesce("source", F.lit("")).alias("source"), F.col("weight").cast("double").alias("weight"))
    present = sizes.join(weights, "source")
    plan = slots(present.select("source", "weight"), period)
    per_source = plan.select("source", "q", "period").distinct()
    # what rows need of their source comes with their bucket, so that none are dealt by source alone
    offsets = parts.select("source", "bucket", before.alias("before")).join(per_source, "source", "left")

    # the first slot in which a source has no block left
    ends = (sizes.join(per_source, "source")
            .withColumn("nb", F.ceil(F.col("size") / block))
            .withColumn("nth", F.col("nb") % F.col("q"))
            .join(plan.select("source", "nth", "slot"), ["source", "nth"])
            .agg(F.min(F.expr("slot + (nb div q) * period")).alias("horizon")))
    horizon = ends.first().horizon or 0

    inner = W.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(
        W.unboundedPreceding, W.currentRow)
    placed = (rows.withColumn("inside", F.sum("size").over(inner) - F.col("size"))
              .join(cut(offsets, "mix-offsets"), ["source", "bucket"])
              .withColumn("block", F.expr(f"(before + inside) div {block}"))
              .withColumn("nth", F.col("block") % F.col("q"))
              .join(plan.select("source", "nth", "slot"), ["source", "nth"], "left")
              .withColumn("slot", F.expr("slot + (block div q) * period")))
    return placed.select("kept", "doc_id", "source", "key", "size", "block", "slot",
                         F.coalesce(F.col("slot") < horizon, F.lit(False)).alias("in_mix"))


def mixed(docs: DataFrame, weights: DataFrame | None = None, **settings) -> DataFrame:
    """The rows of ``docs`` in mixed order, over range partitions; columns as they are."""
    placed = schedule(docs, weights, **settings).withColumn("last", F.col("slot").isNull())
    order = ["last", "slot", "key", "doc_id", "size"]
    return (placed.repartitionByRange(*order).sortWithinPartitions(*order)
            .select(*(column(c, "kept").alias(c) for c in docs.columns)))

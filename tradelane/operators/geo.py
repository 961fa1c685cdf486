"""Place and route lookup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import dims
from ..functions.common import sql_text
from ..session import scratch_path, stored


def locate_bbox(df: DataFrame, boxes: Sequence[tuple] = tuple(dims.LOCATION_BOXES),
                lat: str = "latitude", lon: str = "longitude", out: str = "port_guess",
                otherwise: str | None = "Unknown") -> DataFrame:
    """Label of the first box holding the point, bounds included.

    For a few dozen boxes: comparisons in generated code, no join and no shuffle.
    Corners may be given in any order.
    """
    steps = " ".join(
        f"WHEN `{lat}` BETWEEN {min(a, b)}D AND {max(a, b)}D "
        f"AND `{lon}` BETWEEN {min(c, d)}D AND {max(c, d)}D THEN {sql_text(label)}"
        for label, a, b, c, d in boxes)
    last = "NULL" if otherwise is None else sql_text(otherwise)
    return df.withColumn(out, F.expr(f"CASE {steps} ELSE {last} END"))


def box_leaves(boxes: DataFrame, leaf_boxes: int = 64, size: float = 16.0, levels: int = 14) -> DataFrame:
    """Boxes by the leaves of a quad tree that is as deep as they are dense.

    A cell is ``size`` degrees wide on level 0 and half as wide on each further one. In every cell the
    boxes behind the first one that covers it whole are left out, as no point can get that far; a cell
    that more than ``leaf_boxes`` others only touch is cut into four, down to ``levels``. So piles of large
    boxes end where the topmost covers a cell, and dense places get small cells. One row per box
    and leaf: level, y, x, priority, label and the box.
    """
    spark = boxes.sparkSession
    now = boxes.select("priority", "label", *(
        f(F.col(a), F.col(b)).cast("double").alias(c) for c, f, a, b in (
            ("lat_min", F.least, "lat_min", "lat_max"), ("lat_max", F.greatest, "lat_min", "lat_max"),
            ("lon_min", F.least, "lon_min", "lon_max"), ("lon_max", F.greatest, "lon_min", "lon_max"))))
    own = now.columns
    leaves = None
    for level in range(levels + 1):
        width = size / 2 ** level  # a power of two, so that cells meet exactly

        def cells(low: str, high: str, parent: str) -> Column:
            first, last = F.floor(F.col(low) / width), F.floor(F.col(high) / width)
            if level:
                first, last = F.greatest(first, F.col(parent) * 2), F.least(last, F.col(parent) * 2 + 1)
            return F.explode(F.when(first <= last, F.sequence(first, last)))

        placed = (now.withColumn("_y", cells("lat_min", "lat_max", "y"))
                  .withColumn("_x", cells("lon_min", "lon_max", "x"))
                  .select(F.lit(level).alias("level"), F.col("_y").alias("y"), F.col("_x").alias("x"), *own))
        covers = ((F.col("lat_min") <= F.col("y") * width) & (F.col("lat_max") >= (F.col("y") + 1) * width)
                  & (F.col("lon_min") <= F.col("x") * width) & (F.col("lon_max") >= (F.col("x") + 1) * width))
        rank = F.struct("priority", "label")
        top = placed.groupBy("y", "x").agg(F.min(F.when(covers, rank)).alias("_top"))
        reached = placed.join(top, ["y", "x"]).where(F.col("_top").isNull() | (rank <= F.col("_top"))).drop("_top")
        full = reached.groupBy("y", "x").agg(F.count_if(~covers).alias("_n")).withColumn(
            "_split", F.lit(level < levels) & (F.col("_n") > leaf_boxes)).select("y", "x", "_split")
        path = scratch_path(spark, f"box-cells-{level}")
        reached.join(full, ["y", "x"]).select(*placed.columns, "_split").write.parquet(path)
        stored = spark.read.parquet(path)
        done = stored.where("not _split").drop("_split")
        leaves = done if leaves is None else leaves.unionByName(done)
        now = stored.where("_split").select("y", "x", *own)
        if now.isEmpty():
            return leaves
    return leaves


def locate_grid(df: DataFrame, boxes: DataFrame, size: float = 16.0, lat: str = "latitude",
                lon: str = "longitude", out: str = "port_guess",
                otherwise: str | None = "Unknown", leaf_boxes: int = 64, levels: int = 14) -> DataFrame:
    """``locate_bbox`` for box tables too long for an expression.

    A point is in one leaf (``box_leaves``) at most. The boxes of a leaf come as one row, in order of priority, then
    label, and each level that has leaves is joined by equality, so points are not multiplied, and not dealt anew
    where the leaves are few. A leaf that even at the last level has many more than ``leaf_boxes`` keeps a row
    per box, and its points meet them one by one: no row holds more than ``leaf_boxes`` and the one that covers the leaf.
    Points without a place, or with one that is not a number, get ``otherwise``.
    """
    leaves = box_leaves(boxes, leaf_boxes, size, levels)
    cell = ["level", "y", "x"]
    box = F.struct("priority", "label", "lat_min", "lat_max", "lon_min", "lon_max")
    counts = leaves.groupBy(*cell).agg(F.count("*").alias("_n"))
    few = F.col("_n") <= leaf_boxes + 1
    packed = leaves.join(counts.where(few), cell).groupBy(*cell).agg(F.array_sort(F.collect_list(box)).alias("_boxes"))
    packed = stored(packed.withColumn("_deep", F.lit(False)).unionByName(counts.where(~few).select(
        *cell, F.lit(None).cast(packed.schema["_boxes"].dataType).alias("_boxes"), F.lit(True).alias("_deep"))), "box-leaves")
    used = sorted(packed.groupBy("level").agg(F.max("_deep").alias("deep")).collect())  # levels + 1 at most
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row"), F.col(lat).alias("_lat"),
                     F.col(lon).alias("_lon"))
    at = [[F.floor(F.col(c) * (2 ** n / size)) for c in ("_lat", "_lon")] for n, _ in used]
    for (n, _), (y, x) in zip(used, at, strict=True):
        own = packed.where(F.col("level") == n).select(
            F.col("y").alias("_y"), F.col("x").alias("_x"), F.col("_boxes").alias(f"_boxes{n}"), F.col("_deep").alias(f"_deep{n}"))
        rows = rows.join(own, (y == F.col("_y")) & (x == F.col("_x")), "left").drop("_y", "_x")

    def label(found: Column) -> Column:
        return F.coalesce(found["label"], F.lit(otherwise)).alias(out)

    kept = [F.col(f"_row.`{c}`").alias(c) for c in df.columns if c != out]
    if not used:
        return rows.select(*kept, F.lit(otherwise).cast("string").alias(out))
    of_leaf = F.coalesce(*(F.col(f"_boxes{n}") for n, _ in used))
    first = F.get(F.filter(of_leaf, lambda b: F.col("_lat").between(b["lat_min"], b["lat_max"])
                           & F.col("_lon").between(b["lon_min"], b["lon_max"])), F.lit(0))
    deep = F.coalesce(*(F.col(f"_deep{n}") for n, _ in used), F.lit(False))
    if not any(d for _, d in used):
        return rows.select(*kept, label(first))
    leaf = F.coalesce(*(F.when(F.col(f"_deep{n}"), F.struct(F.lit(n).alias("level"), y.alias("y"), x.alias("x")))
                        for (n, _), (y, x) in zip(used, at, strict=True)))
    piles = leaves.select(F.struct(*cell).alias("_leaf"), "priority", "label", "lat_min", "lat_max", "lon_min", "lon_max")
    holds = (F.col("_lat").between(F.col("lat_min"), F.col("lat_max"))
             & F.col("_lon").between(F.col("lon_min"), F.col("lon_max")))
    met = (rows.where(deep).select("_row", "_lat", "_lon", leaf.alias("_leaf"), F.monotonically_increasing_id().alias("_id"))
           .join(piles, "_leaf", "left").groupBy("_id").agg(
               F.any_value("_row").alias("_row"), F.min(F.when(holds, F.struct("priority", "label"))).alias("_first")))
    return rows.where(~deep).select(*kept, label(first)).unionAll(met.select(*kept, label(F.col("_first"))))


def is_strait(df: DataFrame, column: str = "port_guess", out: str = "is_strait",
              names: Sequence[str] = tuple(dims.STRAIT_LABELS)) -> DataFrame:
    return df.withColumn(out, F.coalesce(F.col(column).isin(list(names)), F.lit(False)))


def map_route(df: DataFrame, column: str = "port_guess", out: str = "route",
              places: Mapping[str, str] = dims.PLACE_TO_ROUTE) -> DataFrame:
    """Route of the first place whose name the label contains, ignoring case."""
    steps = " ".join(
        f"WHEN contains(lower(`{column}`), {sql_text(place.lower())}) THEN {sql_text(route)}"
        for place, route in places.items())
    return df.withColumn(out, F.expr(f"CASE {steps} ELSE {sql_text(dims.UNMAPPED_ROUTE)} END"))

"""Last value seen earlier, per key (vessel positions take the static data known so far)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


BUCKET_ROWS = 1_000_000  # of one key in one task


def balanced_buckets(df: DataFrame, key: str, time: str, rows: int = BUCKET_ROWS, cell: str = "minute",
                     out: str = "_bucket") -> DataFrame:
    """``df`` with a bucket number per key, rising with ``time``, of about ``rows`` rows each.

    The buckets come from each key's own histogram: its rows are counted per ``cell`` of time, combined
    before they are dealt, and the cells of a key are put together until ``rows`` are reached. So a
    bucket holds ``rows`` and what one cell has beyond that at most, however hot the key; its cells are as
    many as the calendar has. Keys with no more rows than that are one bucket and need no cells, so the table
    that is joined is that of the hot keys only.
    """
    cells = df.groupBy(key, F.date_trunc(cell, time).alias("_cell")).agg(F.count("*").alias("_n"))
    upto = Window.partitionBy(key).orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    split = (cells.join(cells.groupBy(key).agg(F.sum("_n").alias("_all")).where(F.col("_all") > rows), key)
             .withColumn("_before", F.sum("_n").over(upto) - F.col("_n"))
             .select(key, "_cell", F.floor(F.col("_before") / rows).alias(out)))
    return (df.withColumn("_cell", F.date_trunc(cell, time)).join(split, [key, "_cell"], "left")
            .withColumn(out, F.coalesce(out, F.lit(0).cast("long"))).drop("_cell"))


def carry_last(df: DataFrame, key: str, order: Sequence[str], bucket: Column, value: str,
               out: str) -> DataFrame:
    """Last non-null ``value`` at or before each row of the same key.

    Work is split by key and bucket, which rises in ``order``, so a key with a third of all rows is
    spread over its buckets. Only one summary row per key and bucket is carried
    over from bucket to bucket.
    """
    df = df.withColumn("_bucket", bucket)
    inside = (Window.partitionBy(key, "_bucket").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # last value of every bucket, then of all the buckets before it
    ends = df.groupBy(key, "_bucket").agg(F.max_by(
        value, F.when(F.col(value).isNotNull(), F.struct(*order))).alias("_end"))
    before = (Window.partitionBy(key).orderBy("_bucket")
              .rowsBetween(Window.unboundedPreceding, -1))
    carried = ends.select(key, "_bucket",
                          F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    return (
        df.withColumn("_inside", F.last(value, ignorenulls=True).over(inside))
        .join(carried, [key, "_bucket"], "left")
        .withColumn(out, F.coalesce("_inside", "_carried"))
        .drop("_bucket", "_inside", "_carried")
    )


STATIC_FIELDS = ("ship_name", "imo", "call_sign", "destination", "vessel_type", "eta")


def enrich_static(messages: DataFrame, key: str = "mmsi",
                  order: Sequence[str] = ("event_time_utc", "message_id"),
                  bucket: Column | None = None,
                  fields: Sequence[str] = STATIC_FIELDS, rows: int = BUCKET_ROWS) -> DataFrame:
    """Position messages with the static fields of the vessel's last earlier static message.

    A static message never fills positions that came before it. Work is split by vessel
    and buckets of about ``rows`` of its own messages unless a time ``bucket`` is given.
    """
    static = F.struct(*[F.col(f) for f in fields])
    df = messages.withColumn("_static", F.when(F.col("message_type") == "ShipStaticData", static))
    if bucket is None:
        df, bucket = balanced_buckets(df, key, order[0], rows, out="_part"), F.col("_part")
    df = carry_last(df, key, order, bucket, "_static", "_seen").drop("_part")
    df = df.where("message_type = 'PositionReport'")
    # a position keeps the name it carries itself when no static name is known
    filled = {f: (F.coalesce(F.nullif(F.col("_seen")["ship_name"], F.lit("")), F.col(f))
                  if f == "ship_name" else F.col("_seen")[f]) for f in fields}
    return df.withColumns(filled).drop("_static", "_seen")

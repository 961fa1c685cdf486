"""Time series operators.

A series with one row per date is as long as the calendar (365 rows a year), so
its ordered window runs over a bounded number of rows whatever the size of the
tables behind it. Series without such a bound use ``rolling_bucketed``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import market
from ..functions.common import pct_change, round_half_up
from ..session import scratch_path
from .cleaning import date_parts


def _last_rows(order: str, n: int) -> WindowSpec:
    return Window.orderBy(order).rowsBetween(-(n - 1), 0)


def rolling_mean(value: Column, order: str, n: int, min_rows: int = 1,
                 digits: int = 2) -> Column:
    """Mean of the last ``n`` rows, null below ``min_rows`` values."""
    w = _last_rows(order, n)
    mean = round_half_up(F.avg(value).over(w), digits)
    return mean if min_rows <= 1 else F.when(F.count(value).over(w) >= min_rows, mean)


def enrich_index(df: DataFrame, date: str = "date", value: str = "bdi_value") -> DataFrame:
    """Changes, rolling means, flags and date parts of a daily index (one row per date)."""
    v = F.col(value)
    change = round_half_up(pct_change(v, F.lag(v).over(Window.orderBy(date))), 4)
    df = df.withColumns({
        "daily_change_pct": change,
        "rolling_7d_avg": rolling_mean(v, date, 7),
        "rolling_30d_avg": rolling_mean(v, date, 30),
        "rolling_90d_avg": rolling_mean(v, date, 90),
    })
    # the windows above already ordered the dates in one place; whole-series figures add no scan
    whole = Window.partitionBy()
    mean, std = F.avg(value).over(whole), F.stddev_samp(value).over(whole)
    df = df.withColumns({
        "above_long_avg": v > mean,
        "is_outlier": F.coalesce(F.abs(v - mean) > 3 * std, F.lit(False)),
        "is_spike": F.coalesce(F.col("daily_change_pct") > 5, F.lit(False)),
        "is_drop": F.coalesce(F.col("daily_change_pct") < -5, F.lit(False)),
    })
    return date_parts(df, date)


def enrich_fuel(df: DataFrame, date: str = "date",
                value: str = "brent_usd_per_bbl") -> DataFrame:
    """Rolling means, pressure score, signal and ship-fuel estimate of a daily price."""
    v = F.col(value)
    df = df.withColumns({
        "brent_7d_avg": rolling_mean(v, date, 7),
        "brent_30d_avg": rolling_mean(v, date, 30, min_rows=5),
    })
    pressure = round_half_up(pct_change(v, F.col("brent_30d_avg")), 2)
    df = df.withColumn("fuel_pressure_score", F.coalesce(pressure, F.lit(0.0)))
    df = df.withColumns({
        "fuel_signal": market.fuel_signal(F.col("fuel_pressure_score")),
        "vlsfo_est_usd_per_mt": round_half_up(v * 7.1, 2),
    })
    return date_parts(df, date, ("year", "month", "weekday"))


def with_position(df: DataFrame, order: Sequence[str], out: str = "position") -> DataFrame:
    """Exact 1..n position in a total order without sorting everything in one task.

    The rows are dealt to ranges of the order once, sorted there and written; a place is its number
    in its range and the rows of the ranges before, of which there are few.
    """
    sort = [F.col(c).asc_nulls_last() for c in order]
    number = F.monotonically_increasing_id()  # partition * 2**33 + place in it
    dealt = df.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("_number", number)
    path = scratch_path(df.sparkSession, "position")
    dealt.write.parquet(path)
    dealt = df.sparkSession.read.schema(dealt.schema).parquet(path).withColumns({
        "_range": F.shiftright("_number", 33), "_place": F.col("_number") - F.shiftleft(F.shiftright("_number", 33), 33)})
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = dealt.groupBy("_range").agg(F.count("*").alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (dealt.join(offsets, "_range").withColumn(out, F.col("_before") + F.col("_place") + 1)
            .drop("_number", "_range", "_place", "_before"))


def rolling_bucketed(df: DataFrame, order: Sequence[str], lookback: int, columns: Callable[[WindowSpec], Mapping[str, Column]],
                     chunk_rows: int = 1_000_000) -> DataFrame:
    """Ordered-window columns over one long series, in chunks.

    Every chunk also receives the last ``lookback`` rows of the chunk before it,
    so frames reaching back at most that far give the same result as one window.
    """
    if lookback > chunk_rows:
        raise ValueError("a chunk must hold at least the look-back rows")
    home = F.floor((F.col("position") - 1) / chunk_rows)
    tail = F.pmod(F.col("position") - 1, F.lit(chunk_rows)) >= chunk_rows - lookback
    spread = (
        with_position(df, order)
        .withColumn("_home", home)
        .withColumn("_chunk", F.explode(F.when(tail, F.array("_home", F.col("_home") + 1))
                                        .otherwise(F.array("_home"))))
    )
    w = Window.partitionBy("_chunk").orderBy("position")
    return (spread.withColumns(dict(columns(w)))
            .where("_chunk = _home").drop("_chunk", "_home"))

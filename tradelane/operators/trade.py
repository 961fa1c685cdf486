"""Trade operators that look at other rows of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import money_sum, pct_change, round_half_up


def flag_outlier_grouped(df: DataFrame, group: str = "hs_code", value: str = "trade_value_usd",
                         k: float = 3.0, out: str = "is_outlier") -> DataFrame:
    """More than ``k`` sample deviations from the group mean.

    Group statistics are combined map-side and joined back, so a group that holds
    most of the rows is never gathered in one task as a window would do.
    """
    stats = df.groupBy(F.col(group).alias("_group")).agg(
        F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_std"))
    far = F.abs(F.col(value) - F.col("_mean")) > k * F.col("_std")
    return (df.join(stats, df[group] == stats["_group"], "left")
            .withColumn(out, F.coalesce(far, F.lit(False)))
            .drop("_group", "_mean", "_std"))


def flag_outlier_global(df: DataFrame, value: str = "bdi_value", k: float = 3.0,
                        out: str = "is_outlier") -> DataFrame:
    stats = df.agg(F.struct(F.avg(value).alias("m"), F.stddev_samp(value).alias("s"))).scalar()
    far = F.abs(F.col(value) - stats["m"]) > k * stats["s"]
    return df.withColumn(out, F.coalesce(far, F.lit(False)))


def trade_balance(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Export and import totals per key and their difference; a missing side is zero."""
    flow, value = F.col("flow_direction"), F.col("trade_value_usd")
    sums = df.groupBy(*keys).agg(
        F.coalesce(money_sum(F.when(flow == "Export", value)), F.lit(0.0)).alias("export_usd"),
        F.coalesce(money_sum(F.when(flow == "Import", value)), F.lit(0.0)).alias("import_usd"))
    return sums.withColumn("trade_balance_usd",
                           round_half_up(F.col("export_usd") - F.col("import_usd"), 2))


def add_trade_balance(df: DataFrame, keys: Sequence[str] = ("reporter_iso", "partner_iso",
                                                            "hs_code", "year")) -> DataFrame:
    balance = trade_balance(df, keys).select(*keys, "trade_balance_usd")
    return df.join(balance, list(keys), "left")


def yoy_growth(df: DataFrame, keys: Sequence[str] = ("reporter_iso", "partner_iso",
                                                     "flow_direction", "hs_code"),
               out: str = "yoy_growth_pct") -> DataFrame:
    """Percent change against the previous row of the series, by year.

    Rows are unique per key and year, so a series is as long as the calendar.
    Leaving ``hs_code`` out of ``keys`` compares neighbouring commodities.
    """
    order = [c for c in ("year", "hs_code") if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*order)
    value = F.col("trade_value_usd")
    return df.withColumn(out, round_half_up(pct_change(value, F.lag(value).over(w)), 2))


def top_commodity_mode(df: DataFrame) -> DataFrame:
    """Most frequent commodity per reporter; the first name in order wins a tie."""
    counts = df.groupBy("reporter_iso", "commodity_name").agg(F.count("*").alias("n"))
    return counts.groupBy("reporter_iso").agg(
        F.min_by("commodity_name", F.struct(-F.col("n"), "commodity_name")).alias("top_commodity"))

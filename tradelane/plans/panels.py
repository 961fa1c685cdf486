"""Tables behind the dashboard panels and the exploratory figures (no drawing)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import dims

from ..functions.common import ladder, money_sum, round_half_up, strip
from ..operators.cleaning import dedupe_first, dedupe_latest, latest_snapshot
from ..operators.quality import exact_quantiles
from .marts import BILLION, TRILLION

VALUE = "trade_value_usd"


def _equals(df: DataFrame, **wanted) -> DataFrame:
    for column, value in wanted.items():
        if value is not None:
            df = df.where(F.col(column) == value)
    return df


def _years(df: DataFrame, y0: int | None, y1: int | None, year: Column) -> DataFrame:
    if y0 is not None:
        df = df.where(year >= y0)
    return df if y1 is None else df.where(year <= y1)


def _newest_values(series: DataFrame, n: int, value: str = "bdi_value") -> DataFrame:
    """One row: the last ``n`` values of a daily series as an array, newest first."""
    last = series.select("date", value).orderBy(F.desc("date")).limit(n)
    ordered = F.sort_array(F.collect_list(F.struct("date", F.col(value).alias("v"))), asc=False)
    return last.agg(ordered["v"].alias("_v"))


def _delta(values: Column, back: int) -> Column:
    """Newest value against ``back`` rows earlier; zero for a series of that length or less."""
    return F.when(F.size(values) > back + 1, values[0] - values[back]).otherwise(0.0)


# live page -------------------------------------------------------------------

def vessel_snapshot(vessels: DataFrame, category: str | None = None,
                    location: str | None = None) -> DataFrame:
    """Newest day: vessels, moving, tankers, cargo and the exact median position."""
    day = _equals(latest_snapshot(vessels), vessel_category=category, port_guess=location)
    placed = day.where("latitude is not null and longitude is not null")
    mid = exact_quantiles(placed, ["latitude", "longitude"], (0.5,))
    here = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    return day.agg(
        F.count_distinct(F.when(here, F.col("mmsi"))).alias("vessels_tracked"),
        F.count_if("is_moving").alias("moving"),
        F.count_if(F.col("vessel_category") == "Tanker").alias("tankers"),
        F.count_if(F.col("vessel_category") == "Cargo").alias("cargo_ships"),
    ).withColumns({
        "median_latitude": round_half_up(F.lit(mid[("latitude", 0.5)]).cast("double"), 6),
        "median_longitude": round_half_up(F.lit(mid[("longitude", 0.5)]).cast("double"), 6),
    })


def fuel_delta(fuel: DataFrame, days: int = 90) -> DataFrame:
    """Newest price and its change against the eighth-newest row of the last ``days`` rows."""
    price = "brent_usd_per_bbl"
    last = fuel.orderBy(F.desc("date")).limit(days)
    newest = F.sort_array(F.collect_list(F.struct("date", F.col(price).alias("v"),
                                                  F.col("fuel_signal").alias("s"))), asc=False)
    rows, n = F.col("_r"), F.size("_r")
    before = F.when(n > 8, F.try_element_at(rows, F.lit(8))["v"]).otherwise(
        F.try_element_at(rows, n)["v"])
    return last.agg(newest.alias("_r")).where(n > 0).select(
        rows[0]["date"].alias("date"), round_half_up(rows[0]["v"], 2).alias("brent_price"),
        rows[0]["s"].alias("fuel_signal"),
        round_half_up(rows[0]["v"] - before, 2).alias("delta_7d"))


def news_top(news: DataFrame, n: int = 8) -> DataFrame:
    return news.orderBy(F.desc("risk_score"), F.desc("pub_date"), "title").limit(n).select(
        "pub_date", "title", "risk_level", "risk_score", "relevant_routes")


def route_impact_panel(current: DataFrame, alerts: DataFrame) -> DataFrame:
    flagged = alerts.agg(F.count_if("deviation_flag")).scalar()
    return (current.where(F.col("route") != dims.UNMAPPED_ROUTE)
            .select("route", "status", "route_impact_score", "traffic_vs_history_pct",
                    "fuel_signal", "news_risk_score", flagged.alias("active_alerts"))
            .orderBy(F.desc("route_impact_score"), "route"))


# summary page ----------------------------------------------------------------

def exec_kpis(index: DataFrame, signals: DataFrame, weather: DataFrame, straits: DataFrame,
              trade: DataFrame, vessels: DataFrame, trillion: float = TRILLION,
              tiebreak: Sequence[str] = ()) -> DataFrame:
    """One row with the headline numbers; every part is a scalar of its own table."""
    base = _newest_values(index, 7)
    day = latest_snapshot(weather).agg(F.struct(
        F.count_if("port_risk_flag").alias("risk"), F.count("*").alias("n"))).scalar()
    now = dedupe_latest(latest_snapshot(straits), ["strait_name"], "fetched_at", tiebreak)
    points = now.agg(F.struct(F.count_if(F.col("disruption_score") >= 40).alias("risk"),
                              F.count("*").alias("n"))).scalar()
    exports = trade.where("flow_direction = 'Export'").agg(money_sum(F.col(VALUE))).scalar()
    ships = latest_snapshot(vessels).agg(F.count_distinct("mmsi")).scalar()
    signal = signals.agg(F.max_by("market_signal", "date")).scalar()
    return base.select(
        round_half_up(F.col("_v")[0], 0).alias("bdi"),
        round_half_up(_delta(F.col("_v"), 5), 0).alias("bdi_delta_5d"),
        day["risk"].alias("ports_at_risk"), day["n"].alias("ports_total"),
        points["risk"].alias("straits_elevated"), points["n"].alias("straits_total"),
        round_half_up(exports / F.lit(trillion), 1).alias("total_export_trillion"),
        ships.alias("vessels_tracked"), signal.alias("bdi_signal"))


def port_alerts_top(port_trade: DataFrame, n: int = 8) -> DataFrame:
    alert = F.col("business_alert")
    return (port_trade.where(alert.startswith("🔴") | alert.startswith("🟠")
                             | alert.startswith("🟡"))
            .orderBy("alert_priority", F.desc_nulls_last("total_B"), "port_name").limit(n)
            .select("port_name", "country_iso", "beaufort_number", "total_B", "business_alert"))


# strait and route pages --------------------------------------------------------

def strait_kpis(monitor: DataFrame) -> DataFrame:
    score = F.coalesce("disruption_score", F.lit(0))
    return monitor.agg(
        F.count("*").alias("straits_monitored"),
        F.count_if(score >= 60).alias("critical"), F.count_if(score >= 40).alias("high"),
        F.coalesce(F.sum(F.when(score >= 40, F.col("trade_pct_global"))), F.lit(0))
        .alias("trade_pct_at_risk"),
        F.coalesce(F.sum(F.when(score >= 40, F.col("oil_pct_global"))), F.lit(0))
        .alias("oil_pct_at_risk"))


def route_kpis(disruption: DataFrame) -> DataFrame:
    status = F.col("overall_status")
    return disruption.agg(
        F.count("*").alias("routes_monitored"),
        F.count_if(status.contains("DISRUPTED")).alias("disrupted"),
        F.count_if(status.contains("WATCH")).alias("watched"),
        round_half_up(F.avg("strait_disruption_score"), 1).alias("avg_strait_score"))


# index page ------------------------------------------------------------------

def index_kpis(index: DataFrame, y0: int | None = None, y1: int | None = None) -> DataFrame:
    df = _years(index, y0, y1, F.col("year"))
    v = "bdi_value"
    last = _newest_values(df, 7).scalar()
    return df.agg(
        F.max(v).alias("_hi"), F.min(v).alias("_lo"), F.avg(v).alias("_avg"),
        F.count_if("is_spike").alias("spikes"), F.count_if("is_drop").alias("drops"),
    ).select(
        round_half_up(last[0], 0).alias("current_bdi"),
        round_half_up(_delta(last, 5), 0).alias("delta_5d"),
        round_half_up("_hi", 0).alias("period_high"), round_half_up("_lo", 0).alias("period_low"),
        round_half_up("_avg", 0).alias("period_avg"), "spikes", "drops")


def signal_timeline(signals: DataFrame, y0: int | None = None, y1: int | None = None) -> DataFrame:
    return _years(signals, y0, y1, F.col("year")).select("date", "bdi_value", "market_signal")


def spikes_by_year(index: DataFrame) -> DataFrame:
    return index.groupBy("year").agg(F.count_if("is_spike").alias("spikes"),
                                     F.count_if("is_drop").alias("drops"))


def month_mean(index: DataFrame) -> DataFrame:
    return index.groupBy("month").agg(
        F.date_format(F.make_date(F.lit(2024), F.col("month"), F.lit(1)), "MMM")
        .alias("month_name"), round_half_up(F.avg("bdi_value"), 0).alias("avg_bdi"))


def signal_days(signals: DataFrame) -> DataFrame:
    return signals.groupBy("market_signal", "charter_recommendation").agg(
        F.count("*").alias("days"))


# trade page ------------------------------------------------------------------

def trade_filter(trade: DataFrame, y0: int | None = None, y1: int | None = None,
                 hs: Sequence[int] | None = None, flow: str | None = None) -> DataFrame:
    df = _equals(_years(trade, y0, y1, F.col("year")), flow_direction=flow)
    return df if not hs else df.where(F.col("hs_code").isin(list(hs)))


def trade_kpis(trade: DataFrame, trillion: float = TRILLION) -> DataFrame:
    flow, value = F.col("flow_direction"), F.col(VALUE)
    return trade.agg(
        round_half_up(money_sum(value) / F.lit(trillion), 1).alias("total_trillion"),
        F.count_distinct("reporter_iso").alias("countries"),
        round_half_up(F.try_divide(money_sum(F.when(flow == "Export", value)),
                             money_sum(F.when(flow == "Import", value))), 2)
        .alias("export_import_ratio"))


def top_exporters(trade: DataFrame, n: int = 15, trillion: float = TRILLION) -> DataFrame:
    return (trade.where("flow_direction = 'Export'").groupBy("reporter_country")
            .agg(money_sum(F.col(VALUE)).alias("_v"))
            .orderBy(F.desc("_v"), "reporter_country").limit(n)
            .select("reporter_country", round_half_up(F.col("_v") / F.lit(trillion), 4).alias("val_T")))


def balance_extremes(trade: DataFrame, n: int = 8, trillion: float = TRILLION) -> DataFrame:
    """The n largest and the n smallest trade balances."""
    flow, value = F.col("flow_direction"), F.col(VALUE)
    balance = (F.coalesce(money_sum(F.when(flow == "Export", value)), F.lit(0.0))
               - F.coalesce(money_sum(F.when(flow == "Import", value)), F.lit(0.0)))
    by_country = trade.groupBy("reporter_country").agg(
        round_half_up(balance / F.lit(trillion), 4).alias("balance_T"))
    top = by_country.orderBy(F.desc("balance_T"), "reporter_country").limit(n)
    low = by_country.orderBy("balance_T", "reporter_country").limit(n)
    return top.withColumn("side", F.lit("top")).unionByName(low.withColumn("side", F.lit("bottom")))


def trade_by_year(trade: DataFrame, billion: float = BILLION) -> DataFrame:
    return trade.groupBy("year", "hs_code", "commodity_name").agg(
        round_half_up(money_sum(F.col(VALUE)) / F.lit(billion), 2).alias("val_B"))


def bdi_trade_year(bdi_trade: DataFrame) -> DataFrame:
    return bdi_trade.dropDuplicates(["year"]).select(
        "year", "avg_bdi", "export_value_trillion", "bdi_yoy_pct", "trade_yoy_pct",
        "correlation_signal")


def yoy_heatmap(trade: DataFrame, years: Sequence[int], n: int = 20) -> DataFrame:
    """Mean growth per year of the n largest exporters, one column per year."""
    exports = trade.where("flow_direction = 'Export'")
    top = (exports.groupBy("reporter_country").agg(money_sum(F.col(VALUE)).alias("v"))
           .orderBy(F.desc("v"), "reporter_country").limit(n))
    return (exports.join(top, "reporter_country", "left_semi")
            .groupBy("reporter_country").pivot("year", list(years))
            .agg(round_half_up(F.avg("yoy_growth_pct"), 2))
            .withColumnsRenamed({str(y): f"y{y}" for y in years}))


# port page -------------------------------------------------------------------

# Sort choices of the port table.
PORT_SORTS = {"Risk priority": ("alert_priority", True), "Wind speed": ("wind_speed_ms", False),
              "Trade exposure": ("total_B", False), "Port rank": ("port_rank", True)}


def port_table(port_trade: DataFrame, show: str = "All", sort: str = "Risk priority") -> DataFrame:
    df = port_trade
    if show == "At-risk only":
        df = df.where("port_risk_flag")
    elif show == "Normal only":
        df = df.where("not port_risk_flag")
    elif show == "Top 10 by trade":
        df = df.orderBy(F.desc_nulls_last("total_B"), "port_name").limit(10)
    column, ascending = PORT_SORTS[sort]
    order = F.asc_nulls_last(column) if ascending else F.desc_nulls_last(column)
    return df.orderBy(order, "port_name")


def port_kpis(weather_now: DataFrame, port_trade: DataFrame) -> DataFrame:
    exposed = port_trade.agg(F.coalesce(F.sum(F.when(
        F.col("port_risk_flag"), F.round(F.col("total_B") * 100).cast("long"))), F.lit(0)) / 100
    ).scalar()
    return weather_now.agg(
        F.count_distinct("port_name").alias("ports_monitored"),
        F.count_if("port_risk_flag").alias("at_risk"),
        round_half_up(F.avg("wind_speed_ms"), 1).alias("avg_wind"),
        round_half_up(F.avg("temp_c"), 1).alias("avg_temp"),
    ).withColumn("trade_at_risk_B", round_half_up(exposed, 0))


def weather_counts(weather: DataFrame) -> DataFrame:
    return weather.groupBy("weather_main").agg(F.count("*").alias("count"))


# vessel page -----------------------------------------------------------------

def vessel_filter(vessels: DataFrame, category: str | None = None, speed: str | None = None,
                  location: str | None = None, min_speed: float = 0.0) -> DataFrame:
    df = _equals(vessels, vessel_category=category, speed_category=speed, port_guess=location)
    return df.where(F.coalesce("sog_knots", F.lit(0.0)) >= min_speed)


def vessel_kpis(vessels: DataFrame, **filters) -> DataFrame:
    """Messages, vessels and speed of the filtered rows; moving and tankers of all rows."""
    whole = vessels.agg(F.struct(
        F.count_if("is_moving").alias("moving"),
        F.count_if(F.col("vessel_category") == "Tanker").alias("tankers"))).scalar()
    return vessel_filter(vessels, **filters).agg(
        F.count("*").alias("messages"), F.count_distinct("mmsi").alias("unique_vessels"),
        round_half_up(F.avg("sog_knots"), 1).alias("avg_speed"),
    ).withColumns({"moving_vessels": whole["moving"], "tankers": whole["tankers"]})


def congested_top(port_risk: DataFrame, n: int = 6) -> DataFrame:
    return port_risk.orderBy(F.desc("vessel_count"), "port_name", F.desc("fetched_at"),
                             F.desc("event_id")).limit(n).select(
        "port_name", "vessel_count", "beaufort_number", "congestion_weather_risk")


def category_counts(vessels: DataFrame) -> DataFrame:
    return vessels.where(F.col("vessel_category") != "Unknown").groupBy(
        F.col("vessel_category").alias("category")).agg(F.count("*").alias("count"))


def speed_counts(vessels: DataFrame) -> DataFrame:
    """Counts in the fixed class order; absent classes are left out."""
    rank = ladder([(F.col("category") == c, i) for i, c in enumerate(dims.SPEED_ORDER)], None)
    return (vessels.groupBy(F.col("speed_category").alias("category"))
            .agg(F.count("*").alias("count")).withColumn("position", rank)
            .where("position is not null").orderBy("position"))


def destinations(vessels: DataFrame, n: int = 15) -> DataFrame:
    d = F.col("destination")
    return (vessels.where(d.isNotNull() & (strip(d) != "") & ~d.startswith("@"))
            .groupBy(F.upper(strip(d)).alias("destination")).agg(F.count("*").alias("count"))
            .orderBy(F.desc("count"), "destination").limit(n))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width counts between the column's own minimum and maximum; empty bins stay."""
    values = df.select(F.col(column).alias("x")).where("x is not null")
    ends = values.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    width = (F.col("e.hi") - F.col("e.lo")) / bins
    counts = (
        values.withColumn("e", ends)
        .withColumn("bin", F.when(F.col("e.hi") > F.col("e.lo"), F.least(
            F.floor((F.col("x") - F.col("e.lo")) / width), F.lit(bins - 1))).otherwise(F.lit(0)))
        .groupBy("bin").agg(F.count("*").alias("count"))
    )
    edges = df.sparkSession.range(bins).select(F.col("id").alias("bin")).withColumn("e", ends)
    return edges.join(counts, "bin", "left").select(
        "bin", round_half_up(F.col("e.lo") + F.col("bin") * width, 6).alias("bin_start"),
        F.coalesce("count", F.lit(0)).alias("count"))


def speed_hist(vessels: DataFrame, bins: int = 30) -> DataFrame:
    return histogram(vessels.where("sog_knots > 0.5"), "sog_knots", bins)


def change_hist(index: DataFrame, bins: int = 80) -> DataFrame:
    return histogram(index, "daily_change_pct", bins)


def daily_vessels(vessels: DataFrame) -> DataFrame:
    """Distinct vessels per day over the whole history, with the mean of the days."""
    per_day = vessels.groupBy("fetch_date").agg(F.count_distinct("mmsi").alias("vessels"))
    return per_day.withColumn("avg_vessels", round_half_up(per_day.agg(F.avg("vessels")).scalar(), 1))


def daily_by_category(vessels: DataFrame) -> DataFrame:
    shown = F.col("vessel_category").isin("Cargo", "Tanker", "Passenger", "Fishing")
    return vessels.where(shown).groupBy("fetch_date", "vessel_category").agg(
        F.count_distinct("mmsi").alias("count"))


def daily_speed(vessels: DataFrame) -> DataFrame:
    return vessels.where("sog_knots > 0.5").groupBy("fetch_date").agg(
        round_half_up(F.avg("sog_knots"), 4).alias("avg_speed"))


# cross-source page -------------------------------------------------------------

def pivot_by_commodity(df: DataFrame, value: str,
                       names: Sequence[str] = (*dims.HS_NAMES.values(), "Other")) -> DataFrame:
    """Mean value per year, one column per commodity name."""
    return (df.groupBy("year").pivot("commodity_name", list(names))
            .agg(round_half_up(F.avg(value), 4)).orderBy("year"))


def burden_pivot(burden: DataFrame) -> DataFrame:
    return pivot_by_commodity(burden, "freight_burden_index")


def share_pivot(concentration: DataFrame) -> DataFrame:
    return pivot_by_commodity(concentration, "china_share_pct")


def sensitivity_list(burden: DataFrame) -> DataFrame:
    return burden.select("commodity_name", "bdi_sensitivity").distinct()


def share_latest(concentration: DataFrame) -> DataFrame:
    return dedupe_first(concentration, ["commodity_name"],
                        [F.desc("year"), F.col("hs_code")]).select(
        "commodity_name", "year", "china_share_pct", "supply_concentration",
        "disruption_exposure_B")


def strait_trend(trend: DataFrame) -> DataFrame:
    """Traffic of the key straits over time."""
    return trend.where(F.col("strait_name").isin(dims.KEY_STRAITS)).select(
        "fetch_date", "strait_name", "total_vessels", "tanker_count", "cargo_count")


def strait_trend_latest(trend: DataFrame) -> DataFrame:
    """Last non-null value of every column per key strait."""
    columns = ("total_vessels", "tanker_count", "cargo_count", "avg_speed_knots", "pct_moving")
    return trend.where(F.col("strait_name").isin(dims.KEY_STRAITS)).groupBy("strait_name").agg(
        F.max("fetch_date").alias("fetch_date"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("fetch_date"))).alias(c)
          for c in columns])


# exploratory figures -------------------------------------------------------------

def bdi_trade_corr(index: DataFrame, trade: DataFrame, trillion: float = TRILLION) -> DataFrame:
    """Pearson r of the yearly index mean and yearly exports."""
    means = index.groupBy("year").agg(F.avg("bdi_value").alias("b"))
    exports = trade.where("flow_direction = 'Export'").groupBy("year").agg(
        (money_sum(F.col(VALUE)) / F.lit(trillion)).alias("t"))
    return means.join(exports, "year").agg(round_half_up(F.corr("b", "t"), 6).alias("pearson_r"),
                                           F.count("*").alias("years"))


def moving_share(vessels: DataFrame) -> DataFrame:
    return vessels.agg(F.floor(F.avg(F.col("is_moving").cast("double")) * 100)
                       .alias("moving_pct"))

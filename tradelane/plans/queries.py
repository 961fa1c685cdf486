"""The twenty-one analytical queries.

Every query takes DataFrames, so it runs on warehouse tables and on freshly built
marts alike. Values of one-row results are read as scalar subqueries, so no query
needs a cross join; every ordering is total, so limits are repeatable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import dims
from ..functions import market
from ..functions.common import ladder, money_sum, pct_change, round_half_up
from ..operators.cleaning import dedupe_latest, latest_snapshot
from .marts import BILLION, TRILLION
from .routes import route_dim

# Geopolitical words from least to most severe.
GEO_ORDER = ["Low", "Medium", "High", "Very High"]


def newest_year(df: DataFrame) -> DataFrame:
    """Rows of the newest year of a table with one row per year and commodity."""
    newest = F.max("year").over(Window.partitionBy())
    return df.withColumn("_newest", newest).where("year = _newest").drop("_newest")


def q01_top_exporters(trade: DataFrame, n: int = 10, billion: float = BILLION) -> DataFrame:
    total = round_half_up(money_sum(F.col("trade_value_usd")) / F.lit(billion), 2)
    return (trade.where("flow_direction = 'Export'")
            .groupBy(F.col("reporter_country").alias("exporter"))
            .agg(total.alias("total_value_billion_usd"))
            .orderBy(F.desc("total_value_billion_usd"), "exporter").limit(n))


def q02_monthly_index(index: DataFrame) -> DataFrame:
    v = "bdi_value"
    return index.groupBy("month").agg(
        F.date_format(F.make_date(F.lit(2024), F.col("month"), F.lit(1)), "MMMM")
        .alias("month_name"),
        round_half_up(F.avg(v), 0).alias("avg_bdi"), round_half_up(F.min(v), 0).alias("min_bdi"),
        round_half_up(F.max(v), 0).alias("max_bdi"), round_half_up(F.stddev_samp(v), 0).alias("bdi_std_dev"),
        F.count("*").alias("trading_days")).orderBy("month")


def view_trade_balance(trade: DataFrame, billion: float = BILLION) -> DataFrame:
    """Balance per reporter, commodity and year over the whole table."""
    flow, value = F.col("flow_direction"), F.col("trade_value_usd")
    sums = trade.groupBy("reporter_country", "reporter_iso",
                         F.col("hs_code").cast("string").alias("hs_code"), "commodity", "year").agg(
        F.coalesce(money_sum(F.when(flow == "Export", value)), F.lit(0.0)).alias("_exp"),
        F.coalesce(money_sum(F.when(flow == "Import", value)), F.lit(0.0)).alias("_imp"))
    unit = F.lit(billion)
    return sums.select(
        "reporter_country", "reporter_iso", "hs_code", "commodity", "year",
        round_half_up(F.col("_exp") / unit, 2).alias("exports_B"),
        round_half_up(F.col("_imp") / unit, 2).alias("imports_B"),
        round_half_up((F.col("_exp") - F.col("_imp")) / unit, 2).alias("balance_B"),
        market.trade_position(F.col("_exp"), F.col("_imp")).alias("trade_position"))


def create_view_trade_balance(trade: DataFrame, name: str = "v_trade_balance", billion: float = BILLION) -> None:
    """The balance as a view for SQL."""
    view_trade_balance(trade, billion).createOrReplaceTempView(name)


def q03_trade_balance(trade: DataFrame, n: int = 50, billion: float = BILLION) -> DataFrame:
    size = F.abs("trade_balance_B")
    view = view_trade_balance(trade.where(F.col("hs_code").isNotNull()), billion)
    return (view.withColumn("hs_code", F.col("hs_code").cast("int"))
            .withColumnRenamed("balance_B", "trade_balance_B").where(size > 0)
            .orderBy(size.desc(), "reporter_iso", "hs_code", "year").limit(n))


def q04_index_trade_yoy(index: DataFrame, trade: DataFrame,
                        trillion: float = TRILLION) -> DataFrame:
    by_year = index.groupBy("year").agg(
        round_half_up(F.avg("bdi_value"), 2).alias("avg_bdi"),
        round_half_up(F.stddev_samp("bdi_value"), 2).alias("bdi_volatility"),
        F.count_if("is_spike").alias("spikes"), F.count_if("is_drop").alias("drops"))
    exports = trade.where("flow_direction = 'Export'").groupBy("year").agg(
        round_half_up(money_sum(F.col("trade_value_usd")) / F.lit(trillion), 3)
        .alias("trade_trillion_usd"))
    years = Window.orderBy("year")  # one row per year

    def yoy(name: str):
        return round_half_up(pct_change(F.col(name), F.lag(name).over(years)), 2)

    return by_year.join(exports, "year", "left").withColumns({
        "bdi_yoy_change_pct": yoy("avg_bdi"),
        "trade_yoy_change_pct": yoy("trade_trillion_usd"),
    }).orderBy("year")


def q05_bearish_signals(index: DataFrame, from_year: int = 2015, n: int = 50) -> DataFrame:
    v = F.col("bdi_value")
    days = Window.orderBy("date")  # one row per date
    signals = index.where(F.col("year") >= from_year).withColumns({
        "below_avg_last_10d": F.count_if(v < F.col("rolling_7d_avg")).over(
            days.rowsBetween(-9, 0)),
        "signal": market.trend_signal(v, F.col("rolling_7d_avg"), F.col("rolling_30d_avg"),
                                      F.col("daily_change_pct")),
        "_week_ago": F.lag("bdi_value", 7).over(days),
    })
    return signals.where("signal <> 'NEUTRAL'").select(
        "date", "year", "bdi_value",
        round_half_up("daily_change_pct", 2).alias("change_pct"),
        round_half_up("rolling_7d_avg", 0).alias("avg_7d"),
        round_half_up("rolling_30d_avg", 0).alias("avg_30d"),
        "signal", "below_avg_last_10d",
        round_half_up(pct_change(v, F.col("_week_ago")), 2).alias("change_vs_7d_ago_pct"),
    ).orderBy(F.desc("date")).limit(n)


def q06_port_weather_trade(weather: DataFrame, trade: DataFrame, from_year: int = 2020,
                           billion: float = BILLION,
                           tiebreak: Sequence[str] = ("fetched_at",)) -> DataFrame:
    """Every reading of the newest day beside the recent exports of its country."""
    value = F.col("trade_value_usd")
    exports = trade.where((F.col("flow_direction") == "Export")
                          & (F.col("year") >= from_year)).groupBy(
        F.col("reporter_iso").alias("country_iso"), "reporter_country").agg(
            round_half_up(money_sum(value) / F.lit(billion), 2).alias("total_trade_B"))
    risk, force, total = F.col("port_risk_flag"), F.col("beaufort_number"), F.col("total_trade_B")
    return latest_snapshot(weather).join(exports, "country_iso", "left").select(
        *tiebreak, "port_name", "country_iso", "port_rank", "weather_main", "beaufort_number",
        "beaufort_desc", round_half_up("wind_speed_ms", 1).alias("wind_ms"),
        ladder([(risk, "High risk"), (force >= 5, "Moderate risk")], "Normal")
        .alias("operational_status"),
        "port_risk_flag", "fetch_date",
        F.coalesce(total, F.lit(0.0)).alias("country_trade_B"),
        ladder([(risk & (total > 100), "High-value port at risk — monitor closely"),
                (risk, "Port at risk — low trade exposure"),
                ((force >= 5) & (total > 200), "Fresh breeze at major port — watch conditions")],
               "Normal operations").alias("business_alert"),
    ).orderBy(F.desc("port_risk_flag"), F.desc("country_trade_B"), "port_name",
              *tiebreak).drop(*tiebreak)


def q07_strait_today(monitor: DataFrame) -> DataFrame:
    return monitor.select(
        "strait_name", "region", "connects", "beaufort_number", "beaufort_desc",
        "disruption_score", "risk_level", "geopolitical_risk",
        F.col("trade_pct_global").alias("pct_world_trade_through"),
        F.col("oil_pct_global").alias("pct_world_oil_through"),
        round_half_up(F.col("trade_pct_global") / 100 * 25000, 0).alias("est_daily_trade_at_risk_B"),
        "reroute_note", "risk_notes").orderBy(F.desc("disruption_score"), "strait_name")


def q08_index_today(signals: DataFrame, n: int = 10) -> DataFrame:
    return signals.orderBy(F.desc("date")).limit(n).select(
        "date", "bdi_value", round_half_up("daily_change_pct", 2).alias("daily_change_pct"),
        round_half_up("rolling_7d_avg", 0).alias("avg_7d"),
        round_half_up("rolling_30d_avg", 0).alias("avg_30d"),
        round_half_up("rolling_90d_avg", 0).alias("avg_90d"),
        "market_signal", "charter_recommendation",
        F.col("is_spike").cast("int").alias("is_spike"),
        F.col("is_drop").cast("int").alias("is_drop"))


def q09_route_briefing(disruption: DataFrame) -> DataFrame:
    status = F.col("overall_status")
    rank = ladder([(status == "🔴 DISRUPTED", 1), (status == "🟡 WATCH", 2),
                   (status == "🟢 CLEAR", 3)], 4)
    return disruption.orderBy(rank, F.desc("strait_disruption_score"), "route").select(
        "route", "overall_status", "strait", "strait_disruption_score", "geopolitical_risk",
        "commodities_affected", "origin_ports_at_risk", "dest_ports_at_risk",
        F.col("alt_route").alias("alternative_if_disrupted"), "route_notes",
        *[c for c in disruption.columns if c == "last_updated"])


def q10_port_alerts(port_trade: DataFrame, n: int = 20) -> DataFrame:
    return port_trade.orderBy("alert_priority", F.desc_nulls_last("total_B"), "port_name").limit(
        n).select(
        "port_name", "country_iso", "port_rank", "beaufort_number", "beaufort_desc",
        "wind_speed_ms", "weather_main", F.col("port_risk_flag").cast("string").alias("at_risk"),
        round_half_up("export_B", 1).alias("export_B"), round_half_up("import_B", 1).alias("import_B"),
        round_half_up("total_B", 1).alias("total_trade_B"), "trade_position", "business_alert",
        "fetch_date")


def q11_commodity_burden(burden: DataFrame) -> DataFrame:
    return burden.select(
        "year", "commodity_name", round_half_up("export_B", 2).alias("export_value_B"),
        round_half_up("avg_bdi", 0).alias("avg_bdi"),
        round_half_up("bdi_volatility", 0).alias("bdi_volatility"),
        round_half_up("freight_burden_index", 4).alias("freight_burden_index"), "bdi_sensitivity",
        F.col("is_cheapest_freight_year").cast("string").alias("cheapest_freight_year"),
    ).orderBy(F.desc("year"), F.desc("freight_burden_index"), "commodity_name")


def q12_net_exporters(exporters: DataFrame, n: int = 20, billion: float = BILLION) -> DataFrame:
    unit = F.lit(billion)
    return exporters.where("is_net_exporter").orderBy(F.desc("export_usd"), "reporter_iso").limit(
        n).select(
        "reporter_country", "reporter_iso", round_half_up(F.col("export_usd") / unit, 1).alias("export_B"),
        round_half_up(F.col("import_usd") / unit, 1).alias("import_B"),
        round_half_up("trade_balance_B", 1).alias("trade_balance_B"),
        F.col("is_net_exporter").cast("string").alias("is_net_exporter"),
        "top_export_commodity", F.col("port_name").alias("primary_port"), "beaufort_number",
        "weather_impact", *[c for c in exporters.columns if c == "last_updated"])


def q13_booking(seasonal: DataFrame, burden: DataFrame) -> DataFrame:
    """Every month beside every freight-sensitive commodity: the twelve months are one array."""
    months = seasonal.withColumns({
        "cheapest_rank": F.rank().over(Window.orderBy("avg_bdi")),  # twelve rows
        "avg_0": round_half_up("avg_bdi", 0),
    })
    calendar = months.agg(F.struct(F.collect_list(F.struct(
        "month", "month_name", "avg_0", "freight_level", "cheapest_rank", "booking_advice"))
        .alias("months"), F.max("avg_0").alias("peak"))).scalar()
    newest = F.max("year").over(Window.partitionBy())  # one row per year and commodity
    recent = burden.withColumn("_newest", newest).where("year >= _newest - 2").groupBy(
        "commodity_name", "bdi_sensitivity").agg(round_half_up(F.avg("export_B"), 1).alias("avg_export_B"))
    return (
        recent.where(F.col("bdi_sensitivity").contains("High"))
        .withColumn("_c", calendar)
        .select("commodity_name", "avg_export_B", "bdi_sensitivity",
                F.col("_c.peak").alias("_peak"), F.inline("_c.months"))
        .select("month_name", F.col("avg_0").alias("avg_bdi"), "freight_level",
                F.col("cheapest_rank").alias("freight_cheapness_rank"), "booking_advice",
                "commodity_name", "avg_export_B", "bdi_sensitivity",
                round_half_up((F.col("_peak") - F.col("avg_0")) / F.col("_peak") * 100, 1)
                .alias("pct_saving_vs_peak_month"))
        .orderBy("commodity_name", "freight_cheapness_rank", "month_name")
    )


def q14_china_risk(concentration: DataFrame, port_trade: DataFrame,
                   focus_weather: str = "CN", billion: float = BILLION, listed: int = 10) -> DataFrame:
    risk = F.col("port_risk_flag")
    status = port_trade.where(F.col("country_iso") == focus_weather).agg(F.struct(
        F.max("beaufort_number").alias("bf"), F.bool_or(risk).alias("risk"),
        F.count_if(risk).alias("n"))).scalar()
    # a report of the worst ports; risk_port_count has the number of all, q14_ports_at_risk their names
    worst = (port_trade.where((F.col("country_iso") == focus_weather) & risk)
             .orderBy(F.desc("beaufort_number"), "port_name").limit(listed)
             .agg(F.array_join(F.array_sort(F.collect_list("port_name")), ", ")).scalar())
    unit, share = F.lit(billion), F.col("china_share_pct")
    out = newest_year(concentration).select(
        "commodity_name", round_half_up(share, 1).alias("china_share_pct"),
        round_half_up(F.col("china_export_usd") / unit, 1).alias("china_export_B"),
        round_half_up(F.col("world_export_usd") / unit, 1).alias("world_export_B"),
        "supply_concentration",
        round_half_up("disruption_exposure_B", 1).alias("disruption_exposure_B"),
        status["bf"].alias("china_max_beaufort_today"),
        status["risk"].alias("china_port_at_risk_today"),
        F.nullif(worst, F.lit("")).alias("china_ports_at_risk"), status["n"].alias("risk_port_count"))
    at_risk = F.col("china_port_at_risk_today")
    return out.withColumn("supply_risk_alert", ladder([
        (at_risk & (share > 40), "🔴 CRITICAL — China dominates AND ports at risk"),
        (at_risk & (share > 20), "🟠 HIGH — Significant China share AND ports at risk"),
        (share > 40, "🟡 WATCH — High China concentration (weather normal today)"),
    ], "🟢 NORMAL")).orderBy(F.desc("china_share_pct"), "commodity_name")


def q14_ports_at_risk(port_trade: DataFrame, focus_weather: str = "CN") -> DataFrame:
    """Every port at risk behind ``q14_china_risk``, one row each."""
    return (port_trade.where((F.col("country_iso") == focus_weather) & F.col("port_risk_flag"))
            .select("port_name", "beaufort_number").orderBy(F.desc("beaufort_number"), "port_name"))


def q15_corridor(monitor: DataFrame, port_trade: DataFrame,
                 straits: Sequence[str] = ("Bab el-Mandeb", "Suez Canal", "Strait of Gibraltar"),
                 origins: Sequence[str] = ("Shanghai", "Ningbo-Zhoushan", "Shenzhen", "Busan"),
                 destinations: Sequence[str] = ("Rotterdam", "Antwerp", "Hamburg")) -> DataFrame:
    """One row for the corridor; ``highest_geo_risk`` is the alphabetic maximum."""
    name, risk = F.col("port_name"), F.col("port_risk_flag")
    at_risk = port_trade.agg(F.struct(
        F.count_if(risk & name.isin(list(origins))).alias("o"),
        F.count_if(risk & name.isin(list(destinations))).alias("d"))).scalar()
    score = F.col("disruption_score")
    line = F.concat("strait_name", F.lit(": "), score.cast("string"), F.lit("/100 ("),
                    "risk_level", F.lit(")"))
    parts = F.array_sort(F.collect_list(F.struct((-score).alias("k"), "strait_name",
                                                 line.alias("line"))))
    rank = F.array_position(F.array(*[F.lit(g) for g in GEO_ORDER]), F.col("geopolitical_risk"))
    rows = monitor.where(F.col("strait_name").isin(list(straits))).agg(
        F.count("*").alias("_n"),
        round_half_up(F.avg(score), 1).alias("avg_strait_score"), F.max(score).alias("worst_strait_score"),
        F.max("geopolitical_risk").alias("highest_geo_risk"),
        F.max_by("geopolitical_risk", rank).alias("highest_geo_risk_ordinal"),
        F.array_join(parts["line"], " | ").alias("strait_breakdown"),
        F.sum("trade_pct_global").alias("total_trade_pct_through_straits"),
    ).where("_n > 0").drop("_n").withColumns({
        "route": F.lit("Asia → Europe (via Suez)"),
        "origin_ports_at_risk": at_risk["o"], "dest_ports_at_risk": at_risk["d"],
    })
    worst, n = F.col("worst_strait_score"), F.col("origin_ports_at_risk")
    return rows.withColumns({
        "route_status": ladder([
            ((worst >= 60) | (n >= 2),
             "🔴 ROUTE DISRUPTED — Consider Cape of Good Hope rerouting"),
            ((worst >= 40) | (n >= 1), "🟡 ROUTE UNDER WATCH — Monitor conditions closely"),
        ], "🟢 ROUTE CLEAR — Normal transit expected"),
        "alternative_route": F.lit("Cape of Good Hope (+14 days, ~+$1M/voyage)"),
    })


def q16_double_risk(signals: DataFrame, concentration: DataFrame, burden: DataFrame,
                    billion: float = BILLION) -> DataFrame:
    now = signals.orderBy(F.desc("date")).limit(30).agg(F.struct(
        F.max_by(F.struct("date", "bdi_value", "market_signal", "charter_recommendation",
                          "rolling_90d_avg"), "date").alias("last"),
        F.count_if(F.col("market_signal") == "BEARISH").alias("bear"),
        F.count_if(F.col("market_signal") == "BULLISH").alias("bull"))).scalar()
    last, recent = now["last"], now
    means = burden.groupBy("commodity_name", "bdi_sensitivity").agg(
        round_half_up(F.avg("freight_burden_index"), 4).alias("freight_burden_index"))
    unit = F.lit(billion)
    out = newest_year(concentration).join(means, "commodity_name").select(
        last["date"].alias("signal_date"), last["bdi_value"].alias("bdi_value"),
        last["market_signal"].alias("market_signal"),
        round_half_up(pct_change(last["bdi_value"], last["rolling_90d_avg"]), 1)
        .alias("bdi_pct_vs_90d_avg"),
        last["charter_recommendation"].alias("charter_recommendation"),
        recent["bear"].alias("bearish_days_30d"), recent["bull"].alias("bullish_days_30d"),
        "commodity_name", "china_share_pct", "supply_concentration",
        round_half_up(F.col("china_export_usd") / unit, 2).alias("china_export_B"),
        round_half_up(F.col("world_export_usd") / unit, 2).alias("world_export_B"),
        F.col("china_port_risk_today").cast("string").alias("china_port_risk"),
        "bdi_sensitivity", "freight_burden_index")
    weak = F.col("market_signal").isin("BEARISH", "OVERSOLD")
    strong = F.col("market_signal").isin("BULLISH", "OVERBOUGHT")
    dominant = F.col("china_share_pct") > 40
    return out.withColumn("compounded_risk_signal", ladder([
        (weak & dominant & (F.col("china_port_risk") == "true"),
         "🔴 TRIPLE RISK: BDI weak + China dominates + China ports disrupted"),
        (weak & dominant, "🟠 DOUBLE RISK: BDI weak + China dominates this commodity"),
        (weak & F.col("bdi_sensitivity").contains("High"),
         "🟡 FREIGHT RISK: BDI weak and commodity is freight-cost-sensitive"),
        (strong & dominant,
         "🟡 DEMAND SIGNAL: BDI rising and China dominates — watch for price impact"),
    ], "🟢 NO COMPOUNDED RISK SIGNAL")).orderBy(F.desc("china_share_pct"), "commodity_name")


def q17_fuel_today(fuel: DataFrame, n: int = 10) -> DataFrame:
    return fuel.orderBy(F.desc("date")).limit(n).select(
        "date", F.col("brent_usd_per_bbl").alias("brent_price"),
        F.col("brent_30d_avg").alias("thirty_day_avg"), "fuel_pressure_score", "fuel_signal",
        round_half_up("vlsfo_est_usd_per_mt", 2).alias("est_ship_fuel_per_tonne"))


def q18_risk_news(news: DataFrame, n: int = 100) -> DataFrame:
    return (news.where(F.col("risk_level").isin("HIGH", "MEDIUM"))
            .orderBy(F.desc("risk_score"), F.desc("pub_date"), "title").limit(n)
            .select("pub_date", "title", "source_name", "risk_level", "risk_score",
                    "relevant_routes"))


def q19_route_impact(current: DataFrame) -> DataFrame:
    return current.select(
        "event_date", "route", "current_vessels", "baseline_avg_vessels",
        "traffic_vs_history_pct", "speed_gap_knots", "fuel_signal", "news_risk_score",
        "route_impact_score", "status").orderBy(F.desc("route_impact_score"), "route")


def q20_pressure(fuel: DataFrame, signals: DataFrame) -> DataFrame:
    """Newest fuel row beside the newest index row."""
    last = signals.agg(F.max_by(F.struct("bdi_value", "market_signal", "rolling_90d_avg"),
                                "date")).scalar()
    out = fuel.orderBy(F.desc("date")).limit(1).select(
        "brent_usd_per_bbl", "fuel_signal", "fuel_pressure_score",
        last["bdi_value"].alias("bdi_value"), last["market_signal"].alias("bdi_signal"),
        (last["bdi_value"] > last["rolling_90d_avg"]).alias("above_long_avg"))
    fuel_word, index_word = F.col("fuel_signal"), F.col("bdi_signal")
    up, down = index_word.isin("BULLISH", "OVERBOUGHT"), index_word.isin("BEARISH", "OVERSOLD")
    return out.withColumn("combined_shipping_signal", ladder([
        (fuel_word.isin("HIGH", "ELEVATED") & up, "DOUBLE PRESSURE — Lock in contracts now"),
        ((fuel_word == "HIGH") | up, "SINGLE PRESSURE — Monitor closely"),
        ((fuel_word == "LOW") & down, "OPPORTUNITY — Cheap freight + cheap fuel"),
    ], "NORMAL — Standard conditions"))


def q21_route_matrix(current: DataFrame, straits: DataFrame,
                     routes: Sequence[str] = tuple(dims.ROUTES),
                     tiebreak: Sequence[str] = ("fetched_at",)) -> DataFrame:
    """Routes beside the newest reading of every strait of the newest day that starts like the route.

    A strait is tested against the few route names in place and then meets its routes by
    equality. Routes without any such strait follow with a score of zero.
    """
    name = F.lower("strait_name")
    tests = [F.when(name.startswith(r.split(" ")[0].lower()), F.lit(r)) for r in routes]
    newest = dedupe_latest(latest_snapshot(straits), ["strait_name"], "fetched_at", tiebreak)
    hits = newest.select(
        "disruption_score", "geopolitical_risk", *tiebreak,
        F.explode(F.array_compact(F.array(*tests))).alias("route"))
    unmatched = route_dim(straits.sparkSession, routes).join(
        hits.select("route").distinct(), "route", "left_anti")
    rows = hits.unionByName(unmatched, allowMissingColumns=True)
    rows = rows.join(current, "route").withColumns({
        "strait_disruption_score": F.coalesce("disruption_score", F.lit(0)),
        "geopolitical_risk": F.coalesce("geopolitical_risk", F.lit("Unknown")),
    })
    traffic, impact = F.col("traffic_vs_history_pct"), F.col("route_impact_score")
    return rows.select(
        *tiebreak, "route", "route_impact_score", "status", "current_vessels",
        round_half_up(traffic, 1).alias("traffic_vs_history_pct"), "fuel_signal",
        round_half_up("news_risk_score", 0).alias("news_risk"),
        "strait_disruption_score", "geopolitical_risk",
        round_half_up(impact * 0.4 + F.col("strait_disruption_score") * 0.4
                + F.coalesce("news_risk_score", F.lit(0.0)) * 0.2, 1)
        .alias("composite_risk_score"),
        ladder([
            (traffic < -30,
             "WARNING: Severe traffic drop — rerouting likely already occurring"),
            (impact >= 60, "ALERT: Critical combined pressure on route"),
            ((F.col("fuel_signal") == "HIGH") & (F.col("news_risk_score") >= 60),
             "CAUTION: High fuel cost + elevated news risk"),
        ], "Normal operating conditions").alias("risk_interpretation"),
    ).orderBy(F.desc("composite_risk_score"), "route", *tiebreak).drop(*tiebreak)

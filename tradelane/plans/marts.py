"""The eleven analytical tables.

Each is a function of cleaned DataFrames. Trade is reduced to its few grouping
keys before anything is joined; readings are reduced to one row per port or strait.
``BILLION`` and ``TRILLION`` are arguments so that smaller data keeps its thresholds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import dims
from ..functions import market, ports, weather
from ..functions.common import cents_sum, money_sum, pct_change, round_half_up, usd
from ..operators.cleaning import dedupe_first, dedupe_latest
from ..operators.series import rolling_mean

BILLION = 1e9
TRILLION = 1e12

# Columns of the signal table, in order.
SIGNAL_COLUMNS = ["date", "year", "bdi_value", "daily_change_pct", "rolling_7d_avg",
                  "rolling_30d_avg", "rolling_90d_avg", "is_spike", "is_drop", "market_signal",
                  "charter_recommendation"]

# Port reading columns kept in the port tables.
PORT_COLUMNS = ["port_name", "country_iso", "port_rank", "temp_c", "wind_speed_ms",
                "beaufort_number", "beaufort_desc", "port_risk_flag", "low_visibility",
                "weather_main", "weather_desc", "visibility_m", "humidity_pct", "fetch_date",
                "fetched_at"]


def _exports(trade: DataFrame) -> DataFrame:
    return trade.where("flow_direction = 'Export'")


def _stamp(df: DataFrame, run_date) -> DataFrame:
    return df if run_date is None else df.withColumn("last_updated", F.lit(run_date))


def latest_ports(weather_df: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    return dedupe_latest(weather_df, ["port_name"], "fetch_date", ["fetched_at", *tiebreak])


def latest_straits(straits: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    return dedupe_latest(straits, ["strait_name"], "fetch_date", ["fetched_at", *tiebreak])


def index_by_year(index: DataFrame) -> DataFrame:
    return index.groupBy("year").agg(
        round_half_up(F.avg("bdi_value"), 2).alias("avg_bdi"),
        F.max("bdi_value").alias("max_bdi"),
        F.min("bdi_value").alias("min_bdi"),
        round_half_up(F.stddev_samp("bdi_value"), 2).alias("bdi_volatility"),
        F.count_if("is_spike").alias("spike_days"),
        F.count_if("is_drop").alias("drop_days"),
        F.count("bdi_value").alias("trading_days"),
    )


def bdi_trade(index: DataFrame, trade: DataFrame, trillion: float = TRILLION,
              run_date=None) -> DataFrame:
    """Freight index and exports by year."""
    # one shuffle of the large table, to one row per year, code and reporter
    base = _exports(trade).groupBy("year", "hs_code", "reporter_iso").agg(
        cents_sum(F.col("trade_value_usd")).alias("v"))
    by_code = base.groupBy("year", "hs_code").agg(F.sum("v").alias("v"))
    dominant = by_code.groupBy("year").agg(
        F.max_by("hs_code", F.struct("v", -F.col("hs_code"))).alias("dominant_hs"))
    by_year = base.groupBy("year").agg(
        usd(F.sum("v")).alias("export_value_usd"),
        F.count_distinct("reporter_iso").alias("unique_countries"),
        F.count_distinct("hs_code").alias("commodity_count"),
    ).withColumn("export_value_trillion", round_half_up(F.col("export_value_usd") / F.lit(trillion), 3))
    joined = index_by_year(index).join(by_year, "year", "inner").join(dominant, "year", "left")

    years = Window.orderBy("year")  # one row per year

    def yoy(name: str) -> Column:
        return round_half_up(pct_change(F.col(name), F.lag(name).over(years)), 2)

    out = joined.withColumns({
        "dominant_commodity": market.commodity_name(F.col("dominant_hs")),
        "bdi_yoy_pct": yoy("avg_bdi"),
        "trade_yoy_pct": yoy("export_value_trillion"),
    }).withColumns({
        "correlation_signal": market.correlation_signal(F.col("bdi_yoy_pct"),
                                                        F.col("trade_yoy_pct")),
        "freight_intensity": round_half_up(
            F.try_divide(F.col("avg_bdi"), F.col("export_value_trillion") * 1000), 4),
    })
    return _stamp(out.orderBy("year"), run_date)


def country_totals(trade: DataFrame, billion: float = BILLION) -> DataFrame:
    """Exports, imports and position per country; a country with one side has 0 on the other.

    Same rows as a full outer join of both sides, in one pass.
    """
    value, flow = F.col("trade_value_usd"), F.col("flow_direction")
    sums = trade.where(flow.isin("Export", "Import")).groupBy("reporter_iso").agg(
        F.coalesce(money_sum(F.when(flow == "Export", value)), F.lit(0.0)).alias("total_export_usd"),
        F.coalesce(money_sum(F.when(flow == "Import", value)), F.lit(0.0)).alias("total_import_usd"))
    unit = F.lit(billion)
    return sums.withColumn(
        "total_trade_usd", F.col("total_export_usd") + F.col("total_import_usd")).withColumns({
            "export_B": round_half_up(F.col("total_export_usd") / unit, 2),
            "import_B": round_half_up(F.col("total_import_usd") / unit, 2),
            "total_B": round_half_up(F.col("total_trade_usd") / unit, 2),
            "trade_position": market.trade_position(F.col("total_export_usd"),
                                                    F.col("total_import_usd")),
        })


def to_iso3(df: DataFrame, crosswalk: DataFrame | None) -> DataFrame:
    """Add ``trade_iso``: the weather country code in the trade table's notation."""
    if crosswalk is None:
        return df.withColumn("trade_iso", F.col("country_iso"))
    codes = crosswalk.select(F.col("iso2").alias("country_iso"), F.col("iso3").alias("trade_iso"))
    return df.join(codes, "country_iso", "left")


def port_risk_trade(weather_df: DataFrame, trade: DataFrame, crosswalk: DataFrame | None = None,
                    billion: float = BILLION, tiebreak: Sequence[str] = (),
                    run_date=None) -> DataFrame:
    """Latest weather of every port beside the trade of its country."""
    latest = latest_ports(weather_df, tiebreak)
    latest = to_iso3(latest.select(*[c for c in PORT_COLUMNS if c in latest.columns]), crosswalk)
    totals = country_totals(trade, billion).withColumnRenamed("reporter_iso", "trade_iso")
    out = latest.join(totals, "trade_iso", "left").drop("trade_iso")
    out = out.withColumn("alert_priority", ports.alert_priority(
        F.col("port_risk_flag"), F.col("total_B"), F.col("beaufort_number")))
    out = out.withColumn("business_alert", ports.port_alert(F.col("alert_priority")))
    return _stamp(out.orderBy("alert_priority", F.desc_nulls_last("total_B"), "port_name"),
                  run_date)


def strait_monitor(straits: DataFrame, seaborne_trillion: float = 25,
                   tiebreak: Sequence[str] = (), run_date=None) -> DataFrame:
    """Latest reading per strait with the trade that depends on it."""
    out = latest_straits(straits, tiebreak)
    out = out.withColumn("est_trade_through_B", round_half_up(
        F.col("trade_pct_global") / 100 * F.lit(seaborne_trillion) * 1000, 0))
    out = out.withColumns({
        "daily_trade_at_risk_B": round_half_up(F.col("est_trade_through_B") / 365, 1),
        "reroute_note": weather.reroute_note(F.col("strait_name")),
        "combined_risk": weather.risk_badge(F.col("risk_level")),
    })
    return _stamp(out.orderBy(F.desc("disruption_score"), "strait_name"), run_date)


def commodity_bdi(index: DataFrame, trade: DataFrame, billion: float = BILLION,
                  run_date=None) -> DataFrame:
    """Freight burden per commodity and year."""
    by_code = _exports(trade).groupBy("year", "hs_code").agg(
        money_sum(F.col("trade_value_usd")).alias("trade_value_usd"))
    years = index_by_year(index).select("year", "avg_bdi", "bdi_volatility", "spike_days")
    # one row per year
    years = years.withColumn("_cheapest", F.min_by("year", F.struct("avg_bdi", "year")).over(
        Window.partitionBy()))
    out = by_code.withColumn("export_B", round_half_up(F.col("trade_value_usd") / F.lit(billion), 2))
    out = out.join(years, "year", "inner").withColumns({
        "commodity_name": market.commodity_name(F.col("hs_code")),
        "freight_burden_index": round_half_up(F.col("avg_bdi") / (F.col("export_B") + 0.01), 4),
        "bdi_sensitivity": market.freight_sensitivity(F.col("hs_code")),
        "is_cheapest_freight_year": F.col("year") == F.col("_cheapest"),
    }).drop("_cheapest")
    return _stamp(out.orderBy("commodity_name", "hs_code", "year"), run_date)


def bdi_signals(index: DataFrame) -> DataFrame:
    """Daily market signal; rolling columns are computed when the input lacks them."""
    v = F.col("bdi_value")
    missing = {f"rolling_{n}d_avg": rolling_mean(v, "date", n, digits=10)
               for n in (7, 30, 90) if f"rolling_{n}d_avg" not in index.columns}
    if "daily_change_pct" not in index.columns:
        missing["daily_change_pct"] = pct_change(v, F.lag(v).over(Window.orderBy("date")))
    df = index.withColumns(missing) if missing else index
    df = df.withColumn("market_signal", market.market_signal(
        v, F.col("rolling_7d_avg"), F.col("rolling_30d_avg"), F.col("rolling_90d_avg"),
        F.col("daily_change_pct")))
    df = df.withColumn("charter_recommendation", market.charter_advice(F.col("market_signal")))
    return df.select(*[c for c in SIGNAL_COLUMNS if c in df.columns])


def net_exporter_risk(trade: DataFrame, weather_df: DataFrame,
                      crosswalk: DataFrame | None = None, billion: float = BILLION,
                      tiebreak: Sequence[str] = (), run_date=None) -> DataFrame:
    """Countries by exports with their main commodity and the weather at their main port."""
    value = F.col("trade_value_usd")
    codes = trade.where(F.col("flow_direction").isin("Export", "Import")).groupBy(
        "flow_direction", "reporter_iso", "reporter_country", "hs_code").agg(
            cents_sum(value).alias("v"))
    exports = codes.where("flow_direction = 'Export'").groupBy(
        "reporter_iso", "reporter_country").agg(usd(F.sum("v")).alias("export_usd"))
    imports = codes.where("flow_direction = 'Import'").groupBy("reporter_iso").agg(
        usd(F.sum("v")).alias("import_usd"))
    named = codes.where("flow_direction = 'Export'").groupBy(
        "reporter_iso", market.commodity_name(F.col("hs_code")).alias("commodity_name")).agg(
            F.sum("v").alias("v"))
    # a tie goes to the first name in order
    top = dedupe_first(named, ["reporter_iso"], [F.desc("v"), F.col("commodity_name")]).select(
        "reporter_iso", F.col("commodity_name").alias("top_export_commodity"))

    out = exports.join(imports, "reporter_iso", "full_outer").fillna(
        0.0, subset=["export_usd", "import_usd"])
    out = out.withColumns({
        "trade_balance_B": round_half_up((F.col("export_usd") - F.col("import_usd")) / F.lit(billion), 2),
        "is_net_exporter": F.col("export_usd") > F.col("import_usd"),
    }).join(top, "reporter_iso", "left")

    main_port = dedupe_first(weather_df, ["country_iso"], [
        F.asc("port_rank"), *[F.desc(c) for c in ("fetched_at", *tiebreak)]])
    main_port = to_iso3(main_port.select(
        "country_iso", "port_name", "port_rank", "beaufort_number", "beaufort_desc",
        "port_risk_flag", "wind_speed_ms", "weather_main", "fetch_date"), crosswalk)
    out = out.join(main_port.withColumnRenamed("trade_iso", "reporter_iso"), "reporter_iso", "left")
    out = out.withColumn("weather_impact", ports.weather_impact(F.col("port_risk_flag"),
                                                                F.col("beaufort_number")))
    return _stamp(out.orderBy(F.desc("export_usd"), "reporter_iso"), run_date)


def seasonal_freight(index: DataFrame, run_date=None) -> DataFrame:
    """Index level per calendar month."""
    v = "bdi_value"
    monthly = index.groupBy("month").agg(
        round_half_up(F.avg(v), 1).alias("avg_bdi"), round_half_up(F.min(v), 1).alias("min_bdi"),
        round_half_up(F.max(v), 1).alias("max_bdi"), round_half_up(F.stddev_samp(v), 1).alias("std_bdi"),
        F.count(v).alias("count_obs"))
    # twelve rows: an exact percentile is cheap here
    cuts = F.percentile("avg_bdi", F.array(F.lit(0.33), F.lit(0.67))).over(Window.partitionBy())
    out = monthly.withColumn("_cuts", cuts).withColumns({
        "month_name": F.date_format(F.make_date(F.lit(2024), "month", F.lit(1)), "MMM"),
        "freight_level": market.freight_level(F.col("avg_bdi"), F.col("_cuts")[0],
                                              F.col("_cuts")[1]),
        "booking_advice": market.booking_advice(F.col("month")),
    }).drop("_cuts")
    return _stamp(out.orderBy("month"), run_date)


def china_concentration(trade: DataFrame, weather_df: DataFrame, index: DataFrame,
                        focus_country: str = "CHN", focus_weather: str = "CN",
                        billion: float = BILLION, run_date=None) -> DataFrame:
    """Share of one country in the exports of every commodity, with its port weather."""
    value = F.col("trade_value_usd")
    sums = _exports(trade).groupBy("year", "hs_code").agg(
        money_sum(value).alias("world_export_usd"),
        F.coalesce(money_sum(F.when(F.col("reporter_iso") == focus_country, value)), F.lit(0.0))
        .alias("china_export_usd"))
    wind = weather_df.where(F.col("country_iso") == focus_weather).agg(F.struct(
        F.coalesce(F.bool_or("port_risk_flag"), F.lit(False)).alias("risk"),
        F.coalesce(F.max("beaufort_number"), F.lit(0)).alias("bf"))).scalar()
    newest = index.agg(F.max_by("bdi_value", "date")).scalar()
    share = F.try_divide(F.col("china_export_usd"), F.col("world_export_usd")) * 100
    out = sums.withColumns({
        "commodity_name": market.commodity_name(F.col("hs_code")),
        "china_share_pct": round_half_up(share, 1),
        "china_port_risk_today": wind["risk"],
        "china_max_beaufort": wind["bf"],
        "current_bdi": newest,
    }).withColumns({
        "supply_concentration": market.supply_concentration(F.col("china_share_pct")),
        "disruption_exposure_B": round_half_up(
            F.col("china_export_usd") / F.lit(billion) * (F.col("china_max_beaufort") / 12), 2),
    })
    return _stamp(out, run_date)


def vessel_counts(vessels: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Traffic per group: distinct vessels, tanker and cargo rows, moving rows, mean speed."""
    return vessels.groupBy(*keys).agg(
        F.count_distinct("mmsi").alias("vessels"),
        F.count_if(F.col("vessel_category") == "Tanker").alias("tanker_count"),
        F.count_if(F.col("vessel_category") == "Cargo").alias("cargo_count"),
        F.count_if("is_moving").alias("moving_count"),
        round_half_up(F.avg("sog_knots"), 1).alias("avg_speed_knots"),
    )


def vessel_port_risk(vessels: DataFrame, weather_df: DataFrame, run_date=None) -> DataFrame:
    """Traffic per place beside every weather reading of the port of that name."""
    density = vessel_counts(vessels, ["port_guess"]).withColumnsRenamed(
        {"port_guess": "port_name", "vessels": "vessel_count"})
    out = weather_df.join(density, "port_name", "inner")
    return _stamp(out.withColumn("congestion_weather_risk", ports.congestion_risk(
        F.col("vessel_count"), F.col("beaufort_number"), F.col("visibility_m"))), run_date)


def route_disruption(straits: DataFrame, weather_df: DataFrame, routes: DataFrame,
                     tiebreak: Sequence[str] = (), run_date=None) -> DataFrame:
    """Morning overview: every route with its strait and the ports at risk at both ends."""
    ends = routes.select(F.explode(F.array_distinct(F.concat("origin_ports", "dest_ports"))).alias("port_name"))
    at_risk = (
        latest_ports(weather_df.join(ends.distinct(), "port_name", "left_semi"), tiebreak)
        .where("port_risk_flag").agg(F.collect_set("port_name")).scalar()
    )  # at most the ports that the routes name
    now = latest_straits(straits, tiebreak).select(
        F.col("strait_name").alias("strait"), "disruption_score", "risk_level",
        "geopolitical_risk", "beaufort_number")
    out = routes.join(now, "strait", "left").withColumns({
        "_origin": F.array_intersect("origin_ports", at_risk),
        "_dest": F.array_intersect("dest_ports", at_risk),
    })
    any_port = (F.size("_origin") > 0) | (F.size("_dest") > 0)

    def listed(names: Column) -> Column:
        return F.when(F.size(names) > 0, F.array_join(names, ", ")).otherwise("None")

    status = ports.route_status(F.col("risk_level"), F.col("geopolitical_risk"), any_port)
    out = out.select(
        "route",
        F.coalesce("strait", F.lit("None")).alias("strait"),
        F.coalesce("disruption_score", F.lit(0)).alias("strait_disruption_score"),
        F.coalesce("risk_level", F.lit("Unknown")).alias("strait_risk_level"),
        F.coalesce("geopolitical_risk", F.lit("Unknown")).alias("geopolitical_risk"),
        F.coalesce("beaufort_number", F.lit(0)).alias("strait_beaufort"),
        listed(F.col("_origin")).alias("origin_ports_at_risk"),
        listed(F.col("_dest")).alias("dest_ports_at_risk"),
        status.alias("overall_status"),
        F.array_join(F.transform("hs_codes", market.commodity_name), ", ")
        .alias("commodities_affected"),
        "route_notes",
        F.coalesce("alt_strait", F.lit("None")).alias("alt_route"),
    )
    return _stamp(out.orderBy(ports.route_status_rank(F.col("overall_status")), "route"), run_date)


def strait_daily(vessels: DataFrame) -> DataFrame:
    """Traffic per strait and day."""
    return vessel_counts(vessels.where("is_strait"), ["fetch_date", "port_guess"])


def strait_vessel_trend(vessels: DataFrame, run_date=None) -> DataFrame:
    """Daily traffic per strait over the whole history, from positions or the stored ``strait_daily``."""
    out = vessels if "moving_count" in vessels.columns else strait_daily(vessels)
    out = out.withColumnsRenamed({"port_guess": "strait_name", "vessels": "total_vessels"})
    return _stamp(out.withColumn("pct_moving", round_half_up(
        F.col("moving_count") / F.greatest("total_vessels", F.lit(1)) * 100, 1)), run_date)

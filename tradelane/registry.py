"""Every operator, table, query and panel by name, over one data folder.

``queries()`` gives callables ``(spark, sf_dir) -> DataFrame``. Dates and times are
given as text so that results can be compared with another engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import dims
from .functions import market, parsing, ports, weather
from .functions.common import safe_ratio
from .operators import asof, cleaning, combine, geo, news, quality, series, terms, trade
from .plans import marts, panels, queries as sqlq, routes
from .sources import readers
from .standin import (BILLION, FOCUS_COUNTRY, NEWS_KEYWORDS, NEWS_ROUTES, TRILLION, Standin)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

TIE = ["event_id"]


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text."""
    out = {}
    for name, kind in df.dtypes:
        if kind == "date":
            out[name] = F.date_format(name, "yyyy-MM-dd")
        elif kind.startswith("timestamp"):
            out[name] = F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return df.withColumns(out) if out else df


def query(name: str):
    def register(build: Callable[[Standin], DataFrame]) -> Callable[[Standin], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(Standin(spark, sf_dir)))
        run.__name__, run.__doc__ = name, build.__doc__
        _QUERIES[name] = run
        return build
    return register


def queries() -> dict[str, Query]:
    from . import registry_io, registry_rules  # noqa: F401 - both register their queries
    return dict(_QUERIES)


# Shared marts at the stand-in's scale -------------------------------------------

def m_bdi_trade(s: Standin) -> DataFrame:
    return marts.bdi_trade(s.bdi_daily, s.trade_flows, TRILLION)


def m_port_trade(s: Standin) -> DataFrame:
    return marts.port_risk_trade(s.port_weather, s.trade_flows, None, BILLION, TIE)


def m_monitor(s: Standin) -> DataFrame:
    return marts.strait_monitor(s.strait_conditions, tiebreak=TIE)


def m_burden(s: Standin) -> DataFrame:
    return marts.commodity_bdi(s.bdi_daily, s.trade_flows, BILLION)


def m_signals(s: Standin) -> DataFrame:
    return marts.bdi_signals(s.bdi_daily)


def m_exporters(s: Standin) -> DataFrame:
    return marts.net_exporter_risk(s.trade_flows, s.port_weather, None, BILLION, TIE)


def m_seasonal(s: Standin) -> DataFrame:
    return marts.seasonal_freight(s.bdi_daily)


def m_china(s: Standin) -> DataFrame:
    return marts.china_concentration(s.trade_flows, s.port_weather, s.bdi_daily, FOCUS_COUNTRY,
                                     FOCUS_COUNTRY, BILLION)


def port_named_vessels(s: Standin) -> DataFrame:
    """Positions whose place is the port of the same number, so that both sides meet."""
    names = s.port_weather_rows.groupBy((F.col("port_rank") - 1).cast("long").alias("mmsi")).agg(
        F.min("port_name").alias("port_guess"))
    return s.vessels.drop("port_guess").join(names, "mmsi")


def m_vessel_port(s: Standin) -> DataFrame:
    return marts.vessel_port_risk(port_named_vessels(s), s.port_weather)


def m_disruption(s: Standin) -> DataFrame:
    return marts.route_disruption(s.strait_conditions, s.port_weather,
                                  dims.route_definitions(s.spark), TIE)


def m_trend(s: Standin) -> DataFrame:
    return marts.strait_vessel_trend(s.vessels_daily)


def m_current(s: Standin) -> DataFrame:
    return routes.current_vs_historical(s.vessels_daily, s.fuel, s.news)


# Cleaning -------------------------------------------------------------------------

@query("drop_columns")
def _(s):
    return cleaning.drop_columns(s.trade_raw)


@query("rename_columns")
def _(s):
    return cleaning.rename_columns(s.trade_raw)


@query("drop_all_null_columns")
def _(s):
    return cleaning.drop_all_null_columns(s.settle_trade().trade_raw)


@query("drop_null_required")
def _(s):
    return cleaning.drop_null_required(s.trade_raw, ["primaryValue"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "primaryValue")


@query("fill_constant")
def _(s):
    return cleaning.fill_constant(cleaning.rename_columns(s.trade_raw)).select(
        "l_orderkey", "l_linenumber", "l_partkey", "net_weight_kg", "quantity", "transport_mode",
        "weight_estimated")


def _gusty(s: Standin) -> DataFrame:
    gap = F.pmod("event_id", F.lit(3)) == 0
    return s.port_weather_rows.withColumns({
        "wind_gust_ms": F.when(~gap, F.col("wind_speed_ms") * 1.5),
        "visibility_m": F.when(~gap, F.col("visibility_m")),
        "rain_1h_mm": F.when(~gap, F.lit(0.25)), "snow_1h_mm": F.lit(None).cast("double"),
    })


@query("fill_from_column")
def _(s):
    return cleaning.fill_from_column(_gusty(s)).select("event_id", "wind_speed_ms", "wind_gust_ms")


@query("clean_weather")
def _(s):
    return cleaning.clean_weather(_gusty(s)).select(
        "event_id", "port_name", "wind_gust_ms", "visibility_m", "rain_1h_mm", "snow_1h_mm",
        "beaufort_number", "beaufort_desc", "port_risk_flag", "low_visibility", "fetch_date",
        "fetch_year", "fetch_month", "source", "data_type", "granularity")


@query("zero_to_null")
def _(s):
    typed = cleaning.parse_numeric_text(cleaning.rename_columns(s.index_raw, cleaning.INDEX_NAMES),
                                        ["bdi_open", "bdi_high", "bdi_low"])
    return cleaning.zero_to_null(typed).select("date", "bdi_open", "bdi_high", "bdi_low")


@query("parse_numeric_text")
def _(s):
    named = cleaning.rename_columns(s.index_raw, cleaning.INDEX_NAMES)
    return cleaning.parse_numeric_text(named, ["bdi_value", "bdi_volume", "bdi_change_pct"]).select(
        "date", "bdi_value", "bdi_volume", "bdi_change_pct")


@query("parse_date_text")
def _(s):
    return cleaning.parse_date_text(
        cleaning.rename_columns(s.index_raw, cleaning.INDEX_NAMES)).select("date")


@query("clean_index")
def _(s):
    return cleaning.clean_index(s.index_raw)


@query("dedupe_first")
def _(s):
    return s.trade_unique.select(*cleaning.TRADE_KEY, "trade_value_usd", "l_orderkey")


@query("dedupe_exact")
def _(s):
    """Whole rows with a nested column; every fifth row comes twice."""
    rows = s.table("lineitem").select("l_orderkey", "l_linenumber", F.struct(
        "l_partkey", F.array("l_suppkey").alias("l_suppkeys")).alias("part"))
    twice = rows.unionAll(rows.where("l_orderkey % 5 = 0"))
    return cleaning.dedupe_exact(twice).select("l_orderkey", "l_linenumber", F.col("part.l_partkey").alias("l_partkey"),
                                               F.get("part.l_suppkeys", 0).alias("l_suppkey"))


@query("dedupe_latest")
def _(s):
    return s.vessels_daily.select("mmsi", "fetch_date", "event_id", "sog_knots", "port_guess")


@query("latest_snapshot")
def _(s):
    return cleaning.latest_snapshot(s.port_weather_rows).select(
        "port_name", "event_id", "fetch_date", "wind_speed_ms")


@query("standardize_text")
def _(s):
    return cleaning.standardize_text(cleaning.rename_columns(s.trade_raw)).select(
        "l_orderkey", "l_linenumber", "l_partkey", "reporter_iso", "partner_iso",
        "reporter_country", "flow_direction")


@query("coerce_numeric")
def _(s):
    typed = cleaning.coerce_numeric(cleaning.rename_columns(s.trade_raw),
                                    {"hs_code": "int", "year": "int"})
    return typed.select("l_orderkey", "l_linenumber", "l_partkey", "hs_code", "year")


@query("clean_trade")
def _(s):
    order = [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                "l_shipdate", "trade_value_usd")]
    return cleaning.clean_trade(s.trade_raw, order).select(
        *cleaning.TRADE_KEY, "trade_value_usd", "net_weight_kg", "transport_mode", "quantity",
        "weight_estimated", "value_per_kg", "decade", "trade_value_trillion", "source",
        "data_type", "granularity")


@query("null_out_of_range")
def _(s):
    wide = s.vessel_rows.withColumns({"latitude": F.col("latitude") * 2,
                                      "longitude": F.col("longitude") * 2})
    return cleaning.null_out_of_range(wide).select("event_id", "latitude", "longitude")


@query("filter_hs")
def _(s):
    return cleaning.filter_hs(s.trade_flows).groupBy("hs_code").agg(F.count("*").alias("n"))


@query("flag_outlier_grouped")
def _(s):
    flagged = trade.flag_outlier_grouped(s.trade_rows, k=1.5)
    return flagged.where("is_outlier").select("l_orderkey", "l_linenumber", "l_partkey", "hs_code",
                                              "trade_value_usd")


@query("flag_outlier_global")
def _(s):
    return trade.flag_outlier_global(s.index_daily, k=2.0).select("date", "is_outlier")


@query("add_trade_balance")
def _(s):
    return trade.add_trade_balance(s.trade_rows).select(
        "l_orderkey", "l_linenumber", "l_partkey", "flow_direction", "trade_balance_usd")


@query("safe_ratio")
def _(s):
    return s.trade_rows.select("l_orderkey", "l_linenumber", "l_partkey", safe_ratio(
        F.col("trade_value_usd"), F.col("net_weight_kg"), 4).alias("value_per_kg"))


@query("decade_bucket")
def _(s):
    return cleaning.decade_bucket(s.trade_flows).groupBy("decade").agg(F.count("*").alias("n"))


@query("date_parts")
def _(s):
    stamped = cleaning.date_parts(s.vessel_rows, "event_time_utc",
                                  ("year", "month", "quarter", "day", "hour", "weekday"))
    return stamped.select("event_id", "year", "month", "quarter", "day", "hour", "weekday")


@query("tag_source")
def _(s):
    import datetime as dt
    tagged = cleaning.tag_source(s.fuel_raw, "EIA_RBRTE_API", "fuel_price", "daily",
                                 dt.date(2026, 1, 31))
    return tagged.select("date", "source", "data_type", "granularity", "fetch_date")


@query("scale_unit")
def _(s):
    return cleaning.scale_unit(s.trade_rows, unit=1e4).select(
        "l_orderkey", "l_linenumber", "l_partkey", "trade_value_trillion")


@query("yoy_growth")
def _(s):
    return trade.yoy_growth(s.trade_unique).select(
        "reporter_iso", "hs_code", "flow_direction", "year", "yoy_growth_pct")


@query("yoy_growth_mixed")
def _(s):
    """The literal variant: neighbouring commodities of a reporter follow each other."""
    return trade.yoy_growth(s.trade_unique, ("reporter_iso", "partner_iso", "flow_direction")).select(
        "reporter_iso", "hs_code", "flow_direction", "year", "yoy_growth_pct")


@query("map_code")
def _(s):
    named = cleaning.map_code(s.trade_flows, "hs_code", dims.HS_NAMES, "Other", "label")
    named = cleaning.map_code(named, "hs_code", dims.HS_SENSITIVITY, "Unknown", "sensitivity")
    return named.groupBy("hs_code", "label", "sensitivity").agg(F.count("*").alias("n"))


def _coded(s: Standin) -> DataFrame:
    """Positions with ship type codes over the whole code range."""
    code = F.pmod(F.col("event_id") * 7, F.lit(101)).cast("int")
    return s.vessel_rows.withColumn("vessel_type", F.when(code != 100, code)).withColumn(
        "sog_knots", F.when(F.pmod("event_id", F.lit(11)) != 0, F.col("sog_knots")))


_DECODED = ("event_id", "vessel_type", "vessel_type_name", "vessel_category", "speed_category",
            "nav_status_name", "is_moving")


@query("decode_vessels_daily")
def _(s):
    return cleaning.vessel_derived(_coded(s)).select(*_DECODED)


@query("decode_vessels_capture")
def _(s):
    return cleaning.vessel_derived(_coded(s), "capture").select(*_DECODED)


@query("beaufort")
def _(s):
    return cleaning.weather_derived(s.port_weather_rows, long_hurricane=True).select(
        "event_id", "wind_speed_ms", "visibility_m", "beaufort_number", "beaufort_desc",
        "port_risk_flag", "low_visibility")


@query("unix_to_hhmm")
def _(s):
    seconds = F.unix_seconds(F.col("event_time_utc").cast("timestamp"))
    return s.vessel_rows.select("event_id", parsing.unix_to_hhmm(
        F.when(F.pmod("event_id", F.lit(9)) != 0, F.pmod(F.col("event_id") * 977, F.lit(900000))))
        .alias("hhmm"), F.date_format("event_time_utc", "HH:mm").alias("clock"))


@query("clean_news")
def _(s):
    return s.news.select("doc_id", "title", "description", "source_name", "url", "pub_date",
                         "risk_level", "risk_score", "relevant_routes")


@query("classify_news")
def _(s):
    return news.classify_news(s.articles, keywords=NEWS_KEYWORDS, routes=NEWS_ROUTES).select(
        "doc_id", "risk_hits", "risk_level", "risk_score", "relevant_routes")


@query("classify_news_lists")
def _(s):
    """The library's own word and route lists over every document."""
    return news.classify_news(s.articles).select("doc_id", "risk_hits", "relevant_routes")


@query("classify_news_terms")
def _(s):
    """Words of ``benchmark`` as tables of terms: long ones are risks, those of five letters name a route."""
    words = s.table("benchmark").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), 0)).alias("w"))
    known = words.select(F.lower("w").alias("term")).distinct()
    place = F.pmod(F.ascii("term"), F.lit(3))
    routes = known.where("length(term) = 5").select(
        "term", place.alias("place"), F.concat(F.lit("Route "), place).alias("route"))
    return terms.classify_by_terms(s.articles, "doc_id", known.where("length(term) >= 6"), routes).select(
        "doc_id", "risk_hits", "relevant_routes")


@query("union_sources")
def _(s):
    flow = F.when(F.col("flow_direction") == "Export", 1).otherwise(0)
    flows = s.trade_unique.select(
        F.lit("un_comtrade").alias("source"), F.make_date("year", F.lit(1), F.lit(1)).alias("date"),
        (F.substring("reporter_iso", 2, 2).cast("long") * 1000 + F.col("hs_code") * 2 + flow)
        .alias("row_key"), "reporter_iso", "trade_value_usd")
    index = s.index_daily.select(F.lit("investing_bdi_csv").alias("source"), "date",
                                 F.lit(0).cast("long").alias("row_key"), "bdi_value")
    readings = s.port_weather_rows.select(
        F.lit(None).cast("string").alias("source"), F.col("fetch_date").alias("date"),
        F.col("event_id").alias("row_key"), "port_name", "wind_speed_ms")
    seen = s.vessel_rows.select(
        F.lit("aisstream").alias("source"),
        F.when(F.pmod("event_id", F.lit(50)) != 0, F.col("fetch_date")).alias("date"),
        F.col("event_id").alias("row_key"), "mmsi", "sog_knots")
    return combine.union_sources([flows, index, readings, seen], "row_key")


@query("validate")
def _(s):
    rules = {"null_value": F.col("trade_value_usd").isNull(),
             "null_reporter": F.col("reporter_iso").isNull(),
             "negative_value": F.coalesce(F.col("trade_value_usd") < 0, F.lit(False)),
             "null_weight": F.col("net_weight_kg").isNull()}
    return quality.validate(s.trade_rows, rules, {"duplicate_key": cleaning.TRADE_KEY})


@query("null_profile")
def _(s):
    return quality.null_profile(s.trade_raw)


@query("quality_report")
def _(s):
    s.settle_trade()
    after = trade.flag_outlier_grouped(s.trade_unique, k=1.5)
    return quality.quality_report(s.trade_rows, after)


@query("describe_stats")
def _(s):
    return quality.describe_stats(
        s.trade_rows.select(F.col("trade_value_usd"), "net_weight_kg"),
        ["trade_value_usd", "net_weight_kg"])


@query("rolling_bucketed")
def _(s):
    """A seven-row mean, change and position over every event in time order."""
    v = F.col("value")

    def columns(w):
        return {"mean_7": F.round(F.avg(v).over(w.rowsBetween(-6, 0)), 4),
                "previous": F.lag(v).over(w)}

    return series.rolling_bucketed(
        s.table("events"), ["ts", "event_id"], 7, columns,
        chunk_rows=4096).select("event_id", "position", "mean_7", "previous")


# Places, scores and rules -----------------------------------------------------------

@query("locate_bbox")
def _(s):
    return geo.locate_bbox(s.vessel_rows).select("event_id", "port_guess")


def _supplier_boxes(s: Standin) -> DataFrame:
    """One box of 12 by 20 degrees per supplier."""
    key = F.col("s_suppkey")
    lat = F.pmod(key * 53, F.lit(6500)) / 100 - 10
    lon = F.pmod(key * 277, F.lit(27000)) / 100 - 125
    return s.table("supplier").select(
        key.alias("priority"), F.col("s_name").alias("label"), lat.alias("lat_min"),
        (lat + 12).alias("lat_max"), lon.alias("lon_min"), (lon + 20).alias("lon_max"))


@query("locate_grid")
def _(s):
    return geo.locate_grid(s.vessel_rows, _supplier_boxes(s)).select("event_id", "port_guess")


@query("is_strait")
def _(s):
    return s.vessels.groupBy("is_strait", "port_guess").agg(F.count("*").alias("n"))


@query("map_route")
def _(s):
    return geo.map_route(s.vessels).groupBy("port_guess", "route").agg(F.count("*").alias("n"))


@query("strait_disruption")
def _(s):
    return s.strait_conditions.select(
        "event_id", "strait_name", "beaufort_number", "visibility_m", "disruption_score",
        "risk_level", weather.score_band(F.col("disruption_score"), "route").alias("band"),
        weather.risk_badge(F.col("risk_level")).alias("combined_risk"),
        weather.reroute_note(F.col("strait_name")).alias("reroute_note"))


@query("enrich_index")
def _(s):
    return s.bdi_daily


@query("enrich_fuel")
def _(s):
    return s.fuel


@query("market_signal")
def _(s):
    return m_signals(s).select("date", "market_signal", "charter_recommendation")


@query("congestion_risk")
def _(s):
    rows = s.port_weather.withColumn("vessels", F.pmod("event_id", F.lit(70)))
    return rows.select("event_id", ports.congestion_risk(
        F.col("vessels"), F.col("beaufort_number"), F.col("visibility_m")).alias("risk"))


@query("port_alert")
def _(s):
    rows = s.port_weather.withColumn("trade", F.pmod("event_id", F.lit(700)).cast("double"))
    rank = ports.alert_priority(F.col("port_risk_flag"), F.col("trade"), F.col("beaufort_number"))
    return rows.select("event_id", rank.alias("alert_priority"),
                       ports.port_alert(rank).alias("business_alert"))


@query("correlation_signal")
def _(s):
    move = F.col("daily_change_pct")
    rows = s.bdi_daily.withColumn("other", F.lag("daily_change_pct").over(
        series.Window.orderBy("date")))
    return rows.select("date", market.correlation_signal(move / 5, F.col("other") / 5)
                       .alias("correlation_signal"))


@query("supply_concentration")
def _(s):
    share = F.pmod(F.col("event_id") * 13, F.lit(100)).cast("double")
    return s.vessel_rows.select("event_id", market.supply_concentration(share).alias("level"))


# As-of ------------------------------------------------------------------------------

def vessel_messages(events: DataFrame) -> DataFrame:
    """Events as vessel messages: every sign-up is a static message, the rest positions."""
    static = F.col("event_type") == "signup"
    k = F.get_json_object("props", "$.k").cast("int")

    def said(value, kind="string"):
        return F.when(static, value.cast(kind))

    return events.select(
        F.col("event_id").alias("message_id"), F.col("user_id").alias("mmsi"),
        F.col("ts").alias("event_time_utc"),
        F.when(static, "ShipStaticData").otherwise("PositionReport").alias("message_type"),
        said(F.concat(F.lit("SHIP "), k.cast("string"))).alias("ship_name"),
        said(F.col("event_id") + 9000000, "long").alias("imo"),
        said(F.concat(F.lit("C"), k.cast("string"))).alias("call_sign"),
        said(F.concat(F.lit("PORT "), F.pmod(k, F.lit(9)).cast("string"))).alias("destination"),
        said(k, "int").alias("vessel_type"), F.lit(None).cast("string").alias("eta"),
        F.when(~static, F.col("value") / 10).alias("sog_knots"))


_ENRICHED = ("message_id", "mmsi", "sog_knots", "ship_name", "imo", "call_sign", "destination",
             "vessel_type")


@query("enrich_static")
def _(s):
    # few rows a bucket, so that the vessels of every scale are split
    return asof.enrich_static(vessel_messages(s.table("events")), rows=20).select(*_ENRICHED)


# Routes and marts -------------------------------------------------------------------

@query("route_daily")
def _(s):
    return routes.route_daily(s.vessels_daily).withColumn("avg_speed", F.round("avg_speed", 6))


@query("route_baselines")
def _(s):
    return routes.route_baselines(s.vessels_daily)


@query("current_vs_historical")
def _(s):
    return m_current(s)


@query("current_vs_historical_exact")
def _(s):
    """News matched by whole route names, today left out of the baseline, score capped."""
    return routes.current_vs_historical(s.vessels_daily, s.fuel, s.news, match="exact", cap=True,
                                        exclude_current=True)


@query("route_deviation_alerts")
def _(s):
    return routes.route_deviation_alerts(m_current(s))


@query("route_chokepoint_watch")
def _(s):
    return routes.route_chokepoint_watch(dims.route_config(s.spark), s.strait_conditions,
                                         s.port_weather, TIE)


query("mart_bdi_trade")(m_bdi_trade)
query("mart_strait_monitor")(lambda s: m_monitor(s).drop("fetched_at"))
query("mart_port_risk_trade")(lambda s: m_port_trade(s).drop("fetched_at"))
query("mart_commodity_bdi")(m_burden)
query("mart_bdi_signals")(m_signals)
query("mart_net_exporter_risk")(m_exporters)
query("mart_seasonal_freight")(m_seasonal)
query("mart_china_concentration")(m_china)
query("mart_route_disruption")(m_disruption)
query("mart_strait_vessel_trend")(m_trend)
query("top_commodity_mode")(lambda s: trade.top_commodity_mode(s.trade_flows))


@query("mart_vessel_port_risk")
def _(s):
    return m_vessel_port(s).select(
        "port_name", "event_id", "vessel_count", "tanker_count", "cargo_count", "moving_count",
        "avg_speed_knots", "beaufort_number", "visibility_m", "congestion_weather_risk")


# Queries ------------------------------------------------------------------------------

query("q01_top_exporters")(lambda s: sqlq.q01_top_exporters(s.trade_flows, billion=BILLION))
query("q02_monthly_index")(lambda s: sqlq.q02_monthly_index(s.bdi_daily))
query("q03_trade_balance")(lambda s: sqlq.q03_trade_balance(s.trade_flows, billion=BILLION))
query("q04_index_trade_yoy")(
    lambda s: sqlq.q04_index_trade_yoy(s.bdi_daily, s.trade_flows, TRILLION))
query("q05_bearish_signals")(lambda s: sqlq.q05_bearish_signals(s.bdi_daily, 1998))
query("q06_port_weather_trade")(
    lambda s: sqlq.q06_port_weather_trade(s.port_weather, s.trade_flows, 1998, BILLION))
query("q07_strait_today")(lambda s: sqlq.q07_strait_today(m_monitor(s)))
query("q08_index_today")(lambda s: sqlq.q08_index_today(m_signals(s)))
query("q09_route_briefing")(lambda s: sqlq.q09_route_briefing(m_disruption(s)))
query("q10_port_alerts")(lambda s: sqlq.q10_port_alerts(m_port_trade(s)))
query("q11_commodity_burden")(lambda s: sqlq.q11_commodity_burden(m_burden(s)))
query("q12_net_exporters")(lambda s: sqlq.q12_net_exporters(m_exporters(s), billion=BILLION))
query("q13_booking")(lambda s: sqlq.q13_booking(m_seasonal(s), m_burden(s)))
query("q14_china_risk")(
    lambda s: sqlq.q14_china_risk(m_china(s), m_port_trade(s), FOCUS_COUNTRY, BILLION))
query("q14_ports_at_risk")(lambda s: sqlq.q14_ports_at_risk(m_port_trade(s), FOCUS_COUNTRY))
query("q15_corridor")(lambda s: sqlq.q15_corridor(m_monitor(s), m_port_trade(s)))
query("q16_double_risk")(
    lambda s: sqlq.q16_double_risk(m_signals(s), m_china(s), m_burden(s), BILLION))
query("q17_fuel_today")(lambda s: sqlq.q17_fuel_today(s.fuel))
query("q18_risk_news")(lambda s: sqlq.q18_risk_news(s.news))
query("q19_route_impact")(lambda s: sqlq.q19_route_impact(m_current(s)))
query("q20_pressure")(lambda s: sqlq.q20_pressure(s.fuel, m_signals(s)))
query("q21_route_matrix")(lambda s: sqlq.q21_route_matrix(
    m_current(s), s.strait_conditions, tiebreak=("fetched_at", "event_id")))


@query("view_trade_balance")
def _(s):
    """Through SQL on the view."""
    sqlq.create_view_trade_balance(s.trade_flows, "v_trade_balance", BILLION)
    return s.spark.sql("SELECT * FROM v_trade_balance")


@query("src_route_config")
def _(s):
    """Every strait that a route passes, with the readings of its newest day."""
    legs = readers.src_route_config(s.spark).select("route_name", F.explode("primary_chokepoints").alias("strait_name"))
    seen = s.strait_conditions.groupBy("strait_name").agg(F.count("*").alias("readings"),
                                                          F.max("disruption_score").alias("worst_score"))
    return legs.join(seen, "strait_name", "left")


query("row_counts")(lambda s: quality.row_counts({
    "trade_flows": s.trade_flows, "bdi_daily": s.index_daily, "port_weather": s.port_weather_rows,
    "vessel_movements": s.vessel_rows, "shipping_news": s.articles}))

# Panels --------------------------------------------------------------------------------

query("dash_vessel_snapshot")(lambda s: panels.vessel_snapshot(s.vessels))
query("dash_fuel_delta")(lambda s: panels.fuel_delta(s.fuel))
query("dash_news_top8")(lambda s: panels.news_top(s.news))
query("dash_route_impact")(lambda s: panels.route_impact_panel(
    m_current(s), routes.route_deviation_alerts(m_current(s))))
query("dash_exec_kpis")(lambda s: panels.exec_kpis(
    s.bdi_daily, m_signals(s), s.port_weather, s.strait_conditions, s.trade_flows, s.vessels,
    TRILLION, TIE))
query("dash_port_alerts")(lambda s: panels.port_alerts_top(m_port_trade(s)))
query("dash_strait_kpis")(lambda s: panels.strait_kpis(m_monitor(s)))
query("dash_route_kpis")(lambda s: panels.route_kpis(m_disruption(s)))
query("dash_index_kpis")(lambda s: panels.index_kpis(s.bdi_daily, 1996, 1999))
query("dash_signal_timeline")(lambda s: panels.signal_timeline(m_signals(s), 1996, 1999))
query("dash_spikes_by_year")(lambda s: panels.spikes_by_year(s.bdi_daily))
query("dash_month_mean")(lambda s: panels.month_mean(s.bdi_daily))
query("dash_signal_days")(lambda s: panels.signal_days(m_signals(s)))
query("dash_trade_kpis")(lambda s: panels.trade_kpis(
    panels.trade_filter(s.trade_flows, 1996, 2000, (10, 26, 27)), TRILLION))
query("dash_top_exporters")(lambda s: panels.top_exporters(s.trade_flows, trillion=TRILLION))
query("dash_balance_extremes")(lambda s: panels.balance_extremes(s.trade_flows, trillion=TRILLION))
query("dash_trade_by_year")(lambda s: panels.trade_by_year(s.trade_flows, BILLION))
query("dash_bdi_trade_year")(lambda s: panels.bdi_trade_year(m_bdi_trade(s)))
query("dash_yoy_heatmap")(lambda s: panels.yoy_heatmap(
    trade.yoy_growth(s.trade_unique), range(1995, 2002)))
query("dash_port_table")(lambda s: panels.port_table(
    m_port_trade(s), "At-risk only", "Wind speed").select(
        "port_name", "wind_speed_ms", "total_B", "business_alert"))
query("dash_port_table_top10")(lambda s: panels.port_table(
    m_port_trade(s), "Top 10 by trade", "Port rank").select("port_name", "port_rank", "total_B"))
query("dash_port_kpis")(lambda s: panels.port_kpis(
    cleaning.latest_snapshot(s.port_weather), m_port_trade(s)))
query("dash_weather_counts")(lambda s: panels.weather_counts(s.port_weather_rows))
query("dash_vessel_filter")(lambda s: panels.vessel_kpis(s.vessels, category="Cargo",
                                                         min_speed=1.0))
query("dash_congested_top6")(lambda s: panels.congested_top(m_vessel_port(s)))
query("dash_value_counts")(lambda s: panels.category_counts(s.vessels))
query("dash_speed_counts")(lambda s: panels.speed_counts(s.vessels))
query("dash_destinations")(lambda s: panels.destinations(s.vessels))
query("dash_speed_hist")(lambda s: panels.speed_hist(s.vessels))
query("dash_change_hist")(lambda s: panels.change_hist(s.bdi_daily))
query("dash_daily_vessels")(lambda s: panels.daily_vessels(s.vessels_daily))
query("dash_daily_by_category")(lambda s: panels.daily_by_category(s.vessels))
query("dash_daily_speed")(lambda s: panels.daily_speed(s.vessels))
query("dash_burden_pivot")(lambda s: panels.burden_pivot(m_burden(s)))
query("dash_share_pivot")(lambda s: panels.share_pivot(m_china(s)))
query("dash_sensitivity_list")(lambda s: panels.sensitivity_list(m_burden(s)))
query("dash_share_latest")(lambda s: panels.share_latest(m_china(s)))
query("dash_strait_trend")(lambda s: panels.strait_trend(m_trend(s)))
query("dash_strait_trend_latest")(lambda s: panels.strait_trend_latest(m_trend(s)))
query("eda_bdi_trade_corr")(lambda s: panels.bdi_trade_corr(s.index_daily.withColumn(
    "year", F.year("date")), s.trade_flows, TRILLION))
query("eda_moving_share")(lambda s: panels.moving_share(s.vessels))

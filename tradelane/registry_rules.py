"""Single rules over whole tables, one query per rule."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from . import dims
from .functions import market, ports, vessels, weather
from .registry import _coded, query
from .session import scratch_path
from .sources import readers, sinks


@query("decode_vessel_type")
def _(s):
    return _coded(s).select("event_id", vessels.vessel_type_name(F.col("vessel_type"))
                            .alias("vessel_type_name"))


@query("decode_nav_status")
def _(s):
    code = F.col("navigational_status")
    return s.vessel_rows.select("event_id", vessels.nav_status_name(code).alias("daily"),
                                vessels.nav_status_name(code, "capture").alias("capture"))


@query("vessel_category_by_name")
def _(s):
    name = vessels.vessel_type_name(F.col("vessel_type"))
    return _coded(s).select("event_id", vessels.category_by_name(name).alias("category"))


@query("vessel_category_by_code")
def _(s):
    return _coded(s).select("event_id", vessels.category_by_code(F.col("vessel_type"))
                            .alias("category"))


@query("speed_category")
def _(s):
    sog = F.col("sog_knots")
    return _coded(s).select("event_id", vessels.speed_category(sog).alias("daily"),
                            vessels.speed_category(sog, dims.SPEED_CUTS_CAPTURE).alias("capture"))


@query("is_moving")
def _(s):
    sog = F.col("sog_knots")
    return _coded(s).select("event_id", vessels.is_moving(sog).alias("daily"),
                            vessels.is_moving(sog, "capture").alias("capture"))


@query("weather_flags")
def _(s):
    return s.port_weather.select("event_id", "port_risk_flag", "low_visibility")


@query("reroute_note")
def _(s):
    return s.strait_rows.select("event_id", weather.reroute_note(F.col("strait_name"))
                                .alias("reroute_note"))


@query("combined_risk")
def _(s):
    return s.strait_conditions.select("event_id", weather.risk_badge(F.col("risk_level"))
                                      .alias("combined_risk"))


@query("score_band")
def _(s):
    return s.strait_conditions.select("event_id", *[
        weather.score_band(F.col("disruption_score"), card).alias(card)
        for card in ("summary", "strait", "route")])


@query("freight_level")
def _(s):
    v = F.col("bdi_value")
    return s.index_daily.select(F.col("date"), market.freight_level(
        v, F.lit(200000.0), F.lit(300000.0)).alias("freight_level"))


@query("booking_advice")
def _(s):
    return s.index_daily.select("date", market.booking_advice(F.month("date")).alias("advice"))


@query("route_status")
def _(s):
    level = F.when(F.pmod("event_id", F.lit(5)) != 0, F.col("risk_level"))
    port = F.pmod("event_id", F.lit(2)) == 0
    return s.strait_conditions.select("event_id", ports.route_status(
        level, F.col("geopolitical_risk"), port).alias("status"))


def _gaps(s):
    """Traffic gap, speed gap, fuel pressure and news risk made from every strait reading."""
    return s.strait_conditions.select(
        "event_id", (F.col("visibility_m") / 100 - 50).alias("tg"),
        (F.col("wind_speed_ms") - 5).alias("sg"), F.col("temp_c").alias("fp"),
        F.col("humidity_pct").cast("double").alias("nr"))


@query("route_impact")
def _(s):
    parts = [F.col(c) for c in ("tg", "sg", "fp", "nr")]
    score = ports.route_impact(*parts)
    return _gaps(s).select("event_id", score.alias("score"),
                           ports.route_impact(*parts, cap=True).alias("capped"),
                           ports.impact_status(score).alias("status"))


@query("deviation_alerts")
def _(s):
    reason = ports.deviation_reason(F.col("tg"), F.col("sg"), F.col("nr"), F.col("fp"))
    return _gaps(s).select("event_id", reason.alias("reason")).where("reason is not null")


@query("src_table")
def _(s):
    """A saved table with upper-case names, read with the columns asked for."""
    rows = s.vessel_rows.select("event_id", "mmsi", "sog_knots")
    name = f"vessel_table_{uuid.uuid4().hex[:8]}"
    rows.toDF(*[c.upper() for c in rows.columns]).write.option(
        "path", scratch_path(s.spark, name)).saveAsTable(name)
    return readers.src_table(s.spark, name, ["event_id", "sog_knots"])


@query("sink_csv")
def _(s):
    path = scratch_path(s.spark, "csv")
    sinks.sink_csv(s.vessel_rows.select("event_id", "mmsi", "sog_knots"), path)
    return s.spark.read.schema("event_id long, mmsi long, sog_knots double").option(
        "header", True).csv(path)

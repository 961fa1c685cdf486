"""Route tables: traffic today against history, with fuel and news pressure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import dims
from ..functions import ports
from ..functions.common import round_half_up
from ..operators.geo import map_route
from .marts import latest_ports, latest_straits


def route_dim(spark: SparkSession, routes: Sequence[str] = tuple(dims.ROUTES)) -> DataFrame:
    return dims.local_table(spark, [(r,) for r in routes], "route string")


def _routed(vessels: DataFrame) -> DataFrame:
    return vessels if "route" in vessels.columns else map_route(vessels)


def route_daily(vessels: DataFrame) -> DataFrame:
    """Per route and day: distinct vessels, mean speed, tanker and cargo rows."""
    return _routed(vessels).groupBy("route", "fetch_date").agg(
        F.count_distinct("mmsi").alias("daily_vessels"),
        F.avg("sog_knots").alias("avg_speed"),
        F.count_if(F.col("vessel_category") == "Tanker").alias("tanker_count"),
        F.count_if(F.col("vessel_category") == "Cargo").alias("cargo_count"),
    )


def _route_figures(vessels: DataFrame, exclude_current: bool,
                   routes: Sequence[str]) -> DataFrame:
    """Per route: history means and the newest day, from one pass over the positions.

    The positions become one row per route and day; everything else works on those, which may also be
    given as they are stored (``route_daily``).
    The newest day is that of all positions, also those outside the routes.
    """
    whole = Window.partitionBy()  # over one row per route and day, or per route
    stored = "daily_vessels" in vessels.columns
    daily = (vessels if stored else route_daily(vessels)).withColumns({
        "_last": F.struct("fetch_date", "daily_vessels", "avg_speed", "tanker_count"),
        "_past": (F.col("fetch_date") < F.max("fetch_date").over(whole) if exclude_current
                  else F.lit(True)),
    })

    def past(name: str):
        return F.when(F.col("_past"), F.col(name))

    figures = daily.groupBy("route").agg(
        round_half_up(F.avg(past("daily_vessels")), 1).alias("baseline_avg_vessels"),
        round_half_up(F.avg(past("avg_speed")), 2).alias("baseline_avg_speed"),
        F.count(past("fetch_date")).alias("days_of_history"),
        F.max("_last").alias("_last"))
    figures = route_dim(vessels.sparkSession, routes).join(figures, "route", "full_outer")
    figures = figures.withColumn("event_date", F.max(F.col("_last.fetch_date")).over(whole))
    today = F.col("_last.fetch_date") == F.col("event_date")
    return (figures.withColumn("_today", F.when(today, F.col("_last"))).drop("_last")
            .where(F.col("route").isin(list(routes)))
            .fillna(0, subset=["baseline_avg_vessels", "baseline_avg_speed", "days_of_history"]))


def route_baselines(vessels: DataFrame, exclude_current: bool = False,
                    routes: Sequence[str] = tuple(dims.ROUTES)) -> DataFrame:
    """Mean of the daily figures per reported route; a route without traffic has zeros."""
    return _route_figures(vessels, exclude_current, routes).select(
        "route", "baseline_avg_vessels", "baseline_avg_speed", "days_of_history")


def news_by_route(news: DataFrame, routes: Sequence[str] = tuple(dims.ROUTES),
                  match: str = "first_word") -> DataFrame:
    """Highest risk score and number of articles per route.

    ``first_word``: the article's route text contains the first word of the route,
    ignoring case (so ``Strait`` of any strait counts). ``exact``: the route itself is
    in the article's list. Each article is tested against the few route names in
    place, so the news table is read once and reduced before any shuffle.
    """
    if match == "exact":
        listed = F.split("relevant_routes", ", ")
        tests = [F.when(F.array_contains(listed, r), F.lit(r)) for r in routes]
    else:
        low = F.lower("relevant_routes")
        tests = [F.when(low.contains(r.split(" ")[0].lower()), F.lit(r)) for r in routes]
    tagged = news.select("risk_score", F.explode(F.array_compact(F.array(*tests))).alias("route"))
    return tagged.groupBy("route").agg(F.max("risk_score").alias("news_risk"),
                                       F.count("*").alias("news_article_count"))


def current_vs_historical(vessels: DataFrame, fuel: DataFrame, news: DataFrame,
                          match: str = "first_word", cap: bool = False,
                          exclude_current: bool = False,
                          routes: Sequence[str] = tuple(dims.ROUTES)) -> DataFrame:
    """Newest day per route against its baseline, with the impact score."""
    last_fuel = fuel.agg(F.max_by(F.struct("fuel_pressure_score", "fuel_signal"), "date")).scalar()
    df = _route_figures(vessels, exclude_current, routes).join(
        news_by_route(news, routes, match), "route", "left")
    pressure = F.coalesce(last_fuel["fuel_pressure_score"], F.lit(0.0))
    df = df.select(
        "event_date", "route",
        F.coalesce("_today.daily_vessels", F.lit(0)).alias("current_vessels"),
        F.coalesce("_today.avg_speed", F.lit(0.0)).alias("_cs"),
        F.coalesce("_today.tanker_count", F.lit(0)).alias("current_tankers"),
        "baseline_avg_vessels", "baseline_avg_speed",
        pressure.alias("_fuel"),
        F.coalesce(last_fuel["fuel_signal"], F.lit("NORMAL")).alias("fuel_signal"),
        F.coalesce(F.col("news_risk").cast("double"), F.lit(0.0)).alias("_news"),
        F.coalesce("news_article_count", F.lit(0)).alias("news_article_count"),
    )
    traffic = ports.traffic_gap_pct(F.col("current_vessels"), F.col("baseline_avg_vessels"))
    speed = F.col("_cs") - F.col("baseline_avg_speed")
    df = df.withColumns({
        "current_avg_speed": round_half_up("_cs", 2),
        "traffic_vs_history_pct": round_half_up(traffic, 1),
        "speed_gap_knots": round_half_up(speed, 2),
        "fuel_pressure_score": round_half_up("_fuel", 2),
        "news_risk_score": round_half_up("_news", 1),
        "route_impact_score": ports.route_impact(traffic, speed, F.col("_fuel"), F.col("_news"),
                                                 cap),
    }).drop("_cs", "_fuel", "_news")
    return df.withColumn("status", ports.impact_status(F.col("route_impact_score")))


def route_deviation_alerts(current: DataFrame) -> DataFrame:
    """Routes that deviate, with the first reason that applies."""
    reason = ports.deviation_reason(F.col("traffic_vs_history_pct"), F.col("speed_gap_knots"),
                                    F.col("news_risk_score"), F.col("fuel_pressure_score"))
    return (current.withColumn("deviation_reason", reason)
            .where(F.col("deviation_reason").isNotNull())
            .withColumn("deviation_flag", F.lit(True)))


def route_chokepoint_watch(config: DataFrame, straits: DataFrame, weather_df: DataFrame,
                           tiebreak: Sequence[str] = ()) -> DataFrame:
    """Per configured route and chokepoint: the latest strait score and watched ports at risk."""
    points = config.select("route_name", "alternative_route", "extra_days_if_disrupted",
                           "extra_cost_per_voyage_usd",
                           F.explode_outer("primary_chokepoints").alias("strait_name"))
    now = latest_straits(straits, tiebreak).select("strait_name", "disruption_score", "risk_level")
    watch = config.select("route_name", F.explode_outer("watch_ports").alias("port_name"))
    flags = latest_ports(weather_df, tiebreak).select("port_name", "port_risk_flag")
    ports_at_risk = watch.join(flags, "port_name", "left").groupBy("route_name").agg(
        F.count("port_name").alias("watch_ports"),
        F.count_if("port_risk_flag").alias("watch_ports_at_risk"))
    return (points.join(now, "strait_name", "left").join(ports_at_risk, "route_name", "left"))

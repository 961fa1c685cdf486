"""Registered queries for sources, sinks and streams.

Each one derives files from the benchmark tables, writes them below the shared
scratch folder, and reads them back through the source under test.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import cleaning, geo
from .plans import routes
from .registry import query, vessel_messages
from .session import scratch_path
from .sources import readers, sinks
from .standin import Standin, vessel_rows
from .streaming import vessels as stream

RUN_DATE = dt.date(2024, 2, 1)


# files made from the benchmark tables ------------------------------------------------

def weather_lines(s: Standin) -> DataFrame:
    """Port readings as nested service responses."""
    return response_lines(s.port_weather_rows, "port_name")


def response_lines(rows: DataFrame, place: str) -> DataFrame:
    gap = F.pmod("event_id", F.lit(3)) == 0
    seconds = F.pmod(F.col("event_id") * 977, F.lit(900000))
    return rows.select(
        F.col(place).alias("place"),
        F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("fetched_at"),
        F.struct(F.col("temp_c").alias("temp"), (F.col("temp_c") - 1).alias("feels_like"),
                 F.col("humidity_pct").alias("humidity"), F.lit(1013).alias("pressure"))
        .alias("main"),
        F.struct(F.col("wind_speed_ms").alias("speed"),
                 F.when(~gap, F.col("wind_speed_ms") * 2).alias("gust"),
                 F.pmod("event_id", F.lit(360)).cast("int").alias("deg")).alias("wind"),
        F.when(~gap, F.col("visibility_m")).alias("visibility"),
        F.array(F.struct(F.col("weather_main").alias("main"),
                         F.lower("weather_main").alias("description"))).alias("weather"),
        F.struct(F.pmod("event_id", F.lit(100)).cast("int").alias("all")).alias("clouds"),
        F.struct(F.when(~gap, F.lit(0.5)).alias("1h")).alias("rain"),
        F.struct(seconds.alias("sunrise"), F.when(~gap, seconds).alias("sunset")).alias("sys"))


def ais_lines(events: DataFrame) -> DataFrame:
    """Vessel messages as JSON text under both spellings of their fields; some are cut off."""
    places = vessel_rows(events).select(F.col("event_id").alias("message_id"), "latitude",
                                        "longitude", "navigational_status")
    m = vessel_messages(events).join(places, "message_id")
    time = F.date_format("event_time_utc", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("time_utc")
    kind = F.col("message_type").alias("MessageType")
    even = F.to_json(F.struct(
        kind, F.struct(F.col("mmsi").alias("MMSI"), F.col("latitude"), F.col("longitude"), time)
        .alias("MetaData"),
        F.struct(F.struct(F.col("sog_knots").alias("Sog"),
                          F.col("navigational_status").alias("NavigationalStatus"))
                 .alias("PositionReport")).alias("Message")))
    odd = F.to_json(F.struct(
        kind, F.struct(F.col("mmsi").alias("UserID"), F.col("latitude").alias("Latitude"),
                       F.col("longitude").alias("Longitude"), time).alias("Metadata"),
        F.struct(F.struct(F.col("sog_knots").alias("SpeedOverGround"),
                          F.col("navigational_status").alias("NavigationalStatus"))
                 .alias("PositionReport")).alias("Message")))
    static = F.to_json(F.struct(
        kind, F.struct(F.col("mmsi").alias("MMSI"), F.col("ship_name").alias("ShipName"), time)
        .alias("MetaData"),
        F.struct(F.struct(F.col("imo").alias("ImoNumber"), F.col("call_sign").alias("CallSign"),
                          F.col("destination").alias("Destination"),
                          F.col("vessel_type").alias("Type")).alias("ShipStaticData"))
        .alias("Message")))
    line = (F.when(F.pmod("message_id", F.lit(97)) == 0, F.lit('{"MessageType": "Posi'))
            .when(F.col("message_type") == "ShipStaticData", static)
            .when(F.pmod("message_id", F.lit(2)) == 0, even).otherwise(odd))
    return m.select(line.alias("value"))


_AIS = ("message_type", "mmsi", "ship_name", "imo", "call_sign", "latitude", "longitude",
        "sog_knots", "navigational_status", "destination", "vessel_type", "event_time_utc",
        "malformed")


def landed(s: Standin, name: str, lines: DataFrame, fmt: str = "json") -> str:
    path = scratch_path(s.spark, name)
    if fmt == "csv":
        sinks.sink_csv(lines, path)
    else:
        lines.write.format(fmt).save(path)
    return path


# sources -----------------------------------------------------------------------------

@query("src_trade_csv")
def _(s):
    """A download in three folders of files, named after each of the patterns."""
    folder = scratch_path(s.spark, "trade")
    third = F.pmod("l_orderkey", F.lit(3))
    for i, name in enumerate(("TradeData_1.csv", "un_comtrade_2.csv", "comtrade_3.csv")):
        sinks.sink_csv(s.trade_raw.where(third == i), f"{folder}/{name}")
    sinks.sink_csv(s.fuel_raw, f"{folder}/fuel.csv")  # no trade file
    return readers.src_trade_csv(s.spark, folder).select(
        "reporterISO", "cmdCode", "flowDesc", "refYear", "primaryValue", "motDesc", "l_orderkey",
        "l_linenumber", "l_partkey")


@query("src_index_csv")
def _(s):
    raw = readers.src_index_csv(s.spark, landed(s, "index", s.index_raw, "csv"))
    return cleaning.clean_index(raw)


@query("src_weather_json")
def _(s):
    return readers.src_weather_json(s.spark, landed(s, "weather", weather_lines(s))).select(
        "port_name", "country_iso", "port_rank", "lat", "lon", "fetched_at", "temp_c",
        "feels_like_c", "humidity_pct", "pressure_hpa", "wind_speed_ms", "wind_gust_ms", "wind_deg",
        "visibility_m", "weather_main", "weather_desc", "cloudiness_pct", "rain_1h_mm",
        "snow_1h_mm", "sunrise_utc", "sunset_utc", "beaufort_number", "port_risk_flag",
        "low_visibility", "fetch_date", "fetch_year", "fetch_month")


@query("src_strait_json")
def _(s):
    return readers.src_strait_json(
        s.spark, landed(s, "straits", response_lines(s.strait_rows, "strait_name"))).select(
        "strait_name", "region", "geopolitical_risk", "trade_pct_global", "fetched_at", "temp_c",
        "wind_speed_ms", "wind_gust_ms", "visibility_m", "beaufort_number", "weather_risk_flag",
        "disruption_score", "risk_level", "fetch_date")


@query("src_ais_jsonl")
def _(s):
    path = landed(s, "ais", ais_lines(s.table("events")), "text")
    return readers.src_ais_jsonl(s.spark, path).select(*_AIS)


@query("src_fuel_json")
def _(s):
    """One response per month, with prices as text and a bad row each."""
    row = F.struct(F.date_format("date", "yyyy-MM-dd").alias("period"),
                   F.col("brent_usd_per_bbl").cast("string").alias("value"))
    bad = F.array(F.struct(F.lit("2000-01-01").alias("period"), F.lit("n/a").alias("value")))
    by_month = s.fuel_raw.groupBy(F.date_trunc("month", "date").alias("m")).agg(
        F.struct(F.concat(F.collect_list(row), bad).alias("data")).alias("response"))
    return readers.src_fuel_json(s.spark, landed(s, "fuel", by_month.drop("m")))


@query("src_news_json")
def _(s):
    """Every document as one response of one article."""
    article = F.struct("title", "description", "publishedAt", "url",
                       F.struct(F.col("source_name").alias("name")).alias("source"))
    return readers.src_news_json(s.spark, landed(
        s, "news", s.articles.select(F.array(article).alias("articles"))))


def _index_csv(s: Standin) -> str:
    cols = ("date", "bdi_value", "bdi_open", "bdi_high", "bdi_low", "bdi_volume",
            "bdi_change_pct", "daily_change_pct", "rolling_7d_avg", "rolling_30d_avg",
            "rolling_90d_avg", "above_long_avg", "is_spike", "is_drop", "is_outlier", "year",
            "month", "quarter", "weekday", "source", "data_type", "granularity")
    full = cleaning.tag_source(s.bdi_daily, "investing_bdi_csv", "freight_index", "daily")
    for c in ("bdi_open", "bdi_high", "bdi_low", "bdi_volume", "bdi_change_pct"):
        full = full.withColumn(c, F.lit(None).cast("double"))
    path = scratch_path(s.spark, "bdi-clean")
    sinks.sink_csv(full.select(*cols), path)
    return path


@query("src_clean_csv")
def _(s):
    return readers.src_clean_csv(s.spark, _index_csv(s), "bdi_daily").select(
        "date", "bdi_value", "daily_change_pct", "is_spike", "year", "weekday", "source")


@query("src_fallback")
def _(s):
    """The static file when the daily one is missing, and the daily one when both are there."""
    path, small = _index_csv(s), scratch_path(s.spark, "bdi-daily")
    sinks.sink_csv(s.spark.read.option("header", True).csv(path).where("year % 2 = 0"), small)
    missing = readers.src_fallback(s.spark, path + "-missing", path, "bdi_daily")
    there = readers.src_fallback(s.spark, small, path, "bdi_daily")
    return missing.withColumn("branch", F.lit("static")).unionByName(
        there.withColumn("branch", F.lit("daily"))).select("branch", "date", "bdi_value", "is_spike")


# sinks -------------------------------------------------------------------------------

@query("sink_append")
def _(s):
    """Two appends, the second with a column more; then one day is rewritten."""
    path = scratch_path(s.spark, "history")
    rows = s.port_weather_rows.select("event_id", "port_name", "wind_speed_ms", "fetch_date",
                                      "temp_c")
    split = F.col("fetch_date") < F.lit("2024-01-16").cast("date")
    sinks.sink_append(rows.where(split).drop("temp_c"), path)
    sinks.sink_append(rows.where(~split), path)
    sinks.sink_replace_days(rows.where("fetch_date = date'2024-01-20'"), path)
    return sinks.read_history(s.spark, path)


@query("sink_merge_days")
def _(s):
    """Two landings of the same days, the second with late rows and some repeated ones."""
    path = scratch_path(s.spark, "merged")
    rows = s.port_weather_rows.select("event_id", "port_name", "fetched_at", "wind_speed_ms", "fetch_date")
    late = F.pmod("event_id", F.lit(3)) == 0
    for part in (rows.where(~late), rows.where(late | (F.pmod("event_id", F.lit(5)) == 0))):
        sinks.sink_merge_days(part, path, ["event_id"], [F.col("fetched_at").desc()])
    return sinks.read_history(s.spark, path, rows.schema)


@query("sink_overwrite")
def _(s):
    path = scratch_path(s.spark, "table")
    sinks.sink_overwrite(s.fuel_raw, path)
    sinks.sink_overwrite(s.fuel_raw.where("false"), path)  # an empty frame changes nothing
    return s.spark.read.parquet(path)


@query("sink_publish")
def _(s):
    """A table in the catalog, then a newer version of it, in buckets of the vessel."""
    table, folder = f"t{uuid.uuid4().hex}", scratch_path(s.spark, "published")
    rows = s.vessel_rows.select("event_id", "mmsi", "sog_knots", "fetch_date")
    for part in (rows.where("event_id % 2 = 0"), rows):
        sinks.sink_publish(part, table, folder, ["mmsi"], 8)
    return s.spark.table(table)


@query("src_newest_day")
def _(s):
    """The newest day of a history that is partitioned by day, found by the names of its folders."""
    path = scratch_path(s.spark, "days")
    rows = s.port_weather_rows.select("port_name", "event_id", "wind_speed_ms", "fetch_date")
    sinks.sink_append(rows, path)
    return sinks.read_newest(s.spark, path, rows.schema)


@query("sink_raw_json")
def _(s):
    path = scratch_path(s.spark, "raw")
    sinks.sink_raw_json(s.vessel_rows.select("event_id", "mmsi", "sog_knots"), path, RUN_DATE)
    return s.spark.read.schema("event_id long, mmsi long, sog_knots double, dt date").json(path)


@query("table_snapshot")
def _(s):
    """Snapshots of three days; the one past its fourteen days is gone."""
    path = scratch_path(s.spark, "snap")
    for age in (20, 14, 0):
        day = RUN_DATE - dt.timedelta(days=age)
        sinks.table_snapshot(s.fuel_raw, path, day)
    return (s.spark.read.parquet(path).groupBy(F.col("snap_date").cast("string").alias("snap_date"))
            .agg(F.count("*").alias("rows")))


@query("table_snapshot_published")
def _(s):
    """Snapshots of a published table over three days, without copies; the one past its fourteen days is gone."""
    table, folder = f"t{uuid.uuid4().hex}", scratch_path(s.spark, "published")
    rows = s.vessel_rows.select("event_id", "mmsi", "sog_knots", "fetch_date")
    kept = {}
    for age, part in ((20, rows.where("event_id % 2 = 0")), (14, rows.where("event_id % 3 = 0")), (0, rows)):
        day = RUN_DATE - dt.timedelta(days=age)
        sinks.sink_publish(part, table, folder, ["mmsi"], 8, keep=1)
        kept[f"{day:%Y%m%d}"] = sinks.snapshot_published(s.spark, table, folder, day, keep=1)
    days = sinks.published_snapshots(s.spark, folder)
    each = [s.spark.table(kept[d]).select(F.lit(d).alias("snap_date"), "mmsi") for d in sorted(days)]
    return reduce(DataFrame.unionAll, each).groupBy("snap_date").agg(
        F.count("*").alias("rows"), F.count_distinct("mmsi").alias("vessels"))


# streams -----------------------------------------------------------------------------

def landed_events(s: Standin, parts: int = 4) -> DataFrame:
    """The events as a stream of one file after another, in the order of their ids."""
    root, events = scratch_path(s.spark, "events"), s.table("events")
    first, last = events.agg(F.min("event_id"), F.max("event_id")).first()
    part = F.floor((F.col("event_id") - (first or 0)) * parts / ((last or 0) - (first or 0) + 1))
    for i in range(parts):
        events.where(part == i).coalesce(1).write.parquet(f"{root}/p{i}")
    return (s.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
            .parquet(f"{root}/*"))


def _finished(s: Standin, name: str, df: DataFrame) -> DataFrame:
    out = scratch_path(s.spark, name)
    stream.run_available(df, out, out + "-checkpoint")
    return s.spark.read.schema(df.schema).parquet(out)


def _merged(s: Standin, name: str, partial: Callable[[DataFrame], DataFrame],
            merge: Callable[[DataFrame], DataFrame], finish: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    out = scratch_path(s.spark, name)
    return stream.run_merged(stream_positions(s), out, out + "-checkpoint", partial, merge, finish)


def stream_positions(s: Standin) -> DataFrame:
    """The events in four batches; in each of them days are open and others come late."""
    events = landed_events(s).withColumn("ts", F.col("ts").cast("timestamp"))
    df = cleaning.vessel_derived(vessel_rows(events))
    return geo.map_route(geo.is_strait(geo.locate_bbox(df)))


@query("stream_ais_source")
def _(s):
    path = landed(s, "ais", ais_lines(s.table("events")), "text")
    df = stream.stream_ais_source(s.spark, path)
    return _finished(s, "stream-ais", df.select(*_AIS))


@query("stream_filter_type")
def _(s):
    path = landed(s, "ais", ais_lines(s.table("events")), "text")
    df = stream.stream_filter_type(stream.stream_ais_source(s.spark, path))
    return _finished(s, "stream-filtered", df.select("message_type", "mmsi", "latitude", "longitude",
                                                     "event_time_utc"))


@query("stream_dedupe_daily")
def _(s):
    out = _merged(s, "stream-daily", lambda df: stream.daily_partial(df, ["event_id", "sog_knots", "port_guess"]),
                  stream.daily_merge, stream.daily_finish)
    return out.select("mmsi", F.to_date("day.start").alias("fetch_date"), "event_id", "sog_knots",
                      "port_guess")


@query("stream_strait_counts")
def _(s):
    return stream.strait_counts(_merged(
        s, "stream-straits", lambda df: stream.daily_partial(df, ["port_guess", "is_strait", "is_moving"]),
        stream.daily_merge, stream.daily_finish))


@query("stream_route_activity")
def _(s):
    daily = _merged(s, "stream-routes", stream.route_partial, stream.route_merge)
    baseline = routes.route_baselines(s.vessels_daily)
    return stream.route_windows(daily, 7, baseline).withColumn("avg_speed", F.round("avg_speed", 6))


@query("route_windows_approx")
def _(s):
    """Vessels per route and window from mergeable sketches of four batches, beside the exact numbers."""
    positions = geo.map_route(s.vessels)
    batches = [stream.route_sketches(positions.where(f"event_id % 4 = {i}")) for i in range(4)]
    about = stream.approx_route_windows(stream.merge_sketches(reduce(DataFrame.unionAll, batches)))
    exact = stream.route_windows(stream.route_merge(stream.route_partial(positions)))
    both = about.withColumnRenamed("vessels", "about").join(
        exact.select("window_start", "route", "vessels"), ["window_start", "route"])
    return both.select("window_start", "route", "messages", F.round("avg_speed", 6).alias("avg_speed"), "vessels",
                       (F.abs(F.col("about") - F.col("vessels")) <= 1 + 0.049 * F.col("vessels")).alias("within"))


@query("stream_upsert_history")
def _(s):
    """The events in four batches, and once more under a new checkpoint."""
    out = scratch_path(s.spark, "stream-history")
    source = landed_events(s).withColumn("ts", F.col("ts").cast("timestamp"))
    rows = vessel_rows(source).select("event_id", "mmsi", "sog_knots", "fetch_date")
    for i in range(2):
        stream.stream_upsert_history(rows, out, f"{out}-checkpoint-{i}", ["event_id"], [F.col("event_id")])
    return sinks.read_history(s.spark, out, rows.schema)


@query("stream_enrich_static")
def _(s):
    """Four batches, each of which finds the static messages of the ones before."""
    out = scratch_path(s.spark, "stream-static")
    source = landed_events(s).withColumn("ts", F.col("ts").cast("timestamp"))
    stream.stream_enrich_static(vessel_messages(source), out, out + "-checkpoint")
    return s.spark.read.parquet(out).select(
        "message_id", "mmsi", "sog_knots", "ship_name", "imo", "call_sign", "destination",
        "vessel_type")

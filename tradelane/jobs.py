"""The daily jobs: landed files to source tables, route tables and marts.

    spark-submit -m tradelane.jobs --landing DIR --warehouse DIR --run-date 2024-02-01

Order: sources, daily figures, routes, marts. Each table is a folder below the warehouse. Histories
(port weather, strait conditions, vessel movements) are merged by key: late rows join the
day they belong to, and running a day again changes nothing. The daily figures of routes and
straits are stored per day, and only days with new rows are worked out again; what is built on
them reads one row per route or strait and day. Everything else is rebuilt.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import dims
from .operators import asof, cleaning, geo, news, series, trade
from .plans import marts, routes
from .session import get_session
from .sources import readers, sinks

# key of each history, and the column whose newest value wins
HISTORIES = {"port_weather": (["port_name", "fetched_at"], "fetched_at"),
             "strait_conditions": (["strait_name", "fetched_at"], "fetched_at"),
             "vessel_movements": (["mmsi", "fetch_date"], "event_time_utc")}
# figures per day that are stored beside the history they are made of
DAILY = {"vessel_movements": {"route_daily": routes.route_daily, "strait_daily": marts.strait_daily}}
POSITION = readers.POSITION


def vessel_rejects(messages: DataFrame) -> DataFrame:
    """Messages that are broken or name no vessel: no key to find their static data by."""
    return messages.where(F.col("malformed") | F.col("mmsi").isNull()).drop(POSITION)


def vessel_movements(messages: DataFrame, run_date: dt.date) -> DataFrame:
    """Typed messages to the last enriched, labelled position per vessel and day."""
    df = messages.where(~F.col("malformed") & F.col("mmsi").isNotNull()).withColumns({
        "message_id": F.col(POSITION),  # messages of one second follow each other as in their file
        "capture_utc": F.lit(run_date).cast("timestamp"),
    })
    df = df.withColumn("event_time_utc", F.coalesce("event_time_utc", "capture_utc"))
    df = cleaning.null_out_of_range(asof.enrich_static(df))
    df = df.where("latitude is not null and longitude is not null")
    df = geo.is_strait(geo.locate_bbox(cleaning.vessel_derived(df)))
    df = df.withColumn("fetch_date", F.to_date("event_time_utc"))
    df = cleaning.dedupe_latest(df, ["mmsi", "fetch_date"], "event_time_utc", ["message_id"])
    df = cleaning.date_parts(df, "event_time_utc", ("year", "month", "day", "hour"))
    return cleaning.tag_source(df.drop("malformed", "message_id", POSITION), "aisstream",
                               "vessel_movement", "event")


def trade_flows(raw: DataFrame) -> DataFrame:
    """Cleaned trade rows with outlier flag, balance and growth."""
    df = cleaning.clean_trade(raw, [F.col(POSITION)]).drop(POSITION)
    df = trade.yoy_growth(trade.add_trade_balance(trade.flag_outlier_grouped(df)))
    return cleaning.with_commodity_name(cleaning.drop_all_null_columns(
        df, ["qty_unit", "value_per_kg", "isGrossWgtEstimated"]))


def sources(spark: SparkSession, landing: str, run_date: dt.date) -> dict[str, DataFrame]:
    """Every source table as far as its files have landed."""
    out: dict[str, DataFrame] = {}

    def have(name: str) -> bool:
        return readers.path_exists(spark, f"{landing}/{name}")

    if have("trade"):
        out["trade_flows"] = trade_flows(readers.src_trade_csv(spark, f"{landing}/trade",
                                                                  position=True))
    if have("index"):
        raw = readers.src_index_csv(spark, f"{landing}/index", position=True)
        daily = cleaning.dedupe_first(cleaning.clean_index(raw), ["date"], [F.col(POSITION)])
        out["bdi_daily"] = cleaning.tag_source(series.enrich_index(daily.drop(POSITION)), "investing_bdi_csv",
                                               "freight_index", "daily")
    if have("port_weather"):
        out["port_weather"] = readers.src_weather_json(spark, f"{landing}/port_weather")
    if have("straits"):
        out["strait_conditions"] = readers.src_strait_json(spark, f"{landing}/straits")
    if have("ais"):
        messages = readers.src_ais_jsonl(spark, f"{landing}/ais", position=True)
        out["vessel_movements"] = vessel_movements(messages, run_date)
        out["vessel_rejects"] = vessel_rejects(messages)
    if have("fuel"):
        fuel = cleaning.dedupe_first(readers.src_fuel_json(spark, f"{landing}/fuel", position=True),
                                     ["date"], [F.col(POSITION)]).drop(POSITION)
        out["fuel_prices_daily"] = cleaning.tag_source(series.enrich_fuel(fuel), "EIA_RBRTE_API",
                                                       "fuel_price", "daily", run_date)
    if have("news"):
        articles = readers.src_news_json(spark, f"{landing}/news")
        out["shipping_news"] = news.clean_news(articles, ["publishedAt", "url", "description"]) \
            .drop("publishedAt", "route_list", "risk_hits").withColumn("fetch_date", F.lit(run_date))
    return out


def route_tables(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Route tables, when there are vessels, fuel and news."""
    if not {"vessel_movements", "fuel_prices_daily", "shipping_news"} <= set(t):
        return {}
    daily = t.get("route_daily", t["vessel_movements"])
    current = routes.current_vs_historical(daily, t["fuel_prices_daily"], t["shipping_news"])
    return {"route_baselines": routes.route_baselines(daily),
            "analysis_current_vs_historical": current,
            "route_deviation_alerts": routes.route_deviation_alerts(current)}


def mart_tables(t: dict[str, DataFrame], run_date: dt.date) -> dict[str, DataFrame]:
    """Every mart whose inputs exist."""
    spark = next(iter(t.values())).sparkSession
    iso = dims.iso_crosswalk(spark)
    stamp = {"run_date": run_date}
    trade_, index, wx = (t.get(n) for n in ("trade_flows", "bdi_daily", "port_weather"))
    straits, ships = t.get("strait_conditions"), t.get("vessel_movements")
    out: dict[str, DataFrame] = {}
    if index is not None and trade_ is not None:
        out["analysis_bdi_trade"] = marts.bdi_trade(index, trade_, **stamp)
        out["analysis_commodity_bdi"] = marts.commodity_bdi(index, trade_, **stamp)
        out["analysis_seasonal_freight"] = marts.seasonal_freight(index, **stamp)
    if index is not None:
        out["analysis_bdi_signals"] = marts.bdi_signals(index)
    if wx is not None and trade_ is not None:
        out["analysis_port_risk_trade"] = marts.port_risk_trade(wx, trade_, iso, **stamp)
        out["analysis_net_exporter_risk"] = marts.net_exporter_risk(trade_, wx, iso, **stamp)
        if index is not None:
            out["analysis_china_concentration"] = marts.china_concentration(
                trade_, wx, index, **stamp)
    if straits is not None:
        out["analysis_strait_monitor"] = marts.strait_monitor(straits, **stamp)
        if wx is not None:
            out["analysis_route_disruption"] = marts.route_disruption(
                straits, wx, dims.route_definitions(spark), **stamp)
    if ships is not None:
        out["analysis_strait_vessel_trend"] = marts.strait_vessel_trend(t.get("strait_daily", ships), **stamp)
        if wx is not None:
            out["analysis_vessel_port_risk"] = marts.vessel_port_risk(
                ships.drop("source", "data_type", "granularity"), wx, **stamp)
    return out


def run(spark: SparkSession, landing: str, warehouse: str, run_date: dt.date) -> list[str]:
    """All jobs of one day; returns the names of the tables written."""
    written, tables = [], {}
    for name, df in sources(spark, landing, run_date).items():
        path, days = f"{warehouse}/{name}", []
        if name in HISTORIES:
            keys, newest = HISTORIES[name]
            days = sinks.sink_merge_days(df, path, keys, [F.col(newest).desc_nulls_last()])
        else:
            sinks.sink_overwrite(df, path, skip_empty=False)
        written.append(name)
        # later steps read what was written, whole histories included
        tables[name] = sinks.read_history(spark, path, df.schema)
        for daily, build in DAILY.get(name, {}).items():
            tables[daily] = sinks.refresh_days(tables[name], f"{warehouse}/{daily}", days, build)
            written.append(daily)
    for step in (route_tables(tables), mart_tables(tables, run_date) if tables else {}):
        for name, df in step.items():
            if sinks.sink_overwrite(df, f"{warehouse}/{name}"):
                written.append(name)
    return written


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("--landing", required=True)
    args.add_argument("--warehouse", required=True)
    args.add_argument("--run-date", required=True, type=dt.date.fromisoformat)
    opts = args.parse_args()
    for name in run(get_session("tradelane-daily"), opts.landing, opts.warehouse, opts.run_date):
        print(name)


if __name__ == "__main__":
    main()

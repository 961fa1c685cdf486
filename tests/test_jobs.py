"""The daily jobs end to end on files made from the smallest data."""

import datetime as dt

from pyspark.sql import functions as F

from tradelane import jobs
from tradelane.registry_io import ais_lines, weather_lines
from tradelane.sources import sinks
from tradelane.standin import Standin


def land(spark, sf_dir, root):
    s = Standin(spark, sf_dir)
    named = F.when(F.col("reporterISO") == " n07 ", "CHN").otherwise(F.col("reporterISO"))
    raw = s.trade_raw.withColumn("reporterISO", named)
    for i, name in enumerate(("TradeData_1.csv", "comtrade_2.csv", "un_comtrade_3.csv")):
        sinks.sink_csv(raw.where(F.pmod("l_orderkey", F.lit(3)) == i).repartition(2), f"{root}/trade/{name}")
    sinks.sink_csv(s.index_raw, f"{root}/index")
    weather_lines(s).write.json(f"{root}/port_weather")
    weather_lines(s).withColumn("place", F.when(F.col("place") == "Singapore", "Suez Canal")
                                .otherwise(F.lit("Strait of Hormuz"))).write.json(f"{root}/straits")
    ais_lines(s.table("events")).write.text(f"{root}/ais")
    price = F.struct(F.col("date").cast("string").alias("period"),
                     F.col("brent_usd_per_bbl").cast("string").alias("value"))
    s.fuel_raw.select(F.struct(F.array(price).alias("data")).alias("response")).write.json(f"{root}/fuel")
    s.articles.select(F.array(F.struct("title", "description", "publishedAt", "url", F.struct(
        F.col("source_name").alias("name")).alias("source"))).alias("articles")).write.json(f"{root}/news")


def test_daily_run(spark, sf_dir, tmp_path):
    landing, warehouse = str(tmp_path / "landing"), str(tmp_path / "warehouse")
    land(spark, sf_dir, landing)
    run_date = dt.date(2024, 2, 1)
    written = jobs.run(spark, landing, warehouse, run_date)
    assert len([n for n in written if n.startswith("analysis_")]) == 12
    assert {"route_baselines", "trade_flows", "shipping_news"} <= set(written)

    def read(name):
        return spark.read.parquet(f"{warehouse}/{name}")

    ships = read("vessel_movements")
    assert ships.count() == ships.dropDuplicates(["mmsi", "fetch_date"]).count() > 0
    assert ships.where("ship_name like 'SHIP%'").count() > 0
    shares = read("analysis_china_concentration")
    assert shares.where("china_share_pct > 0").count() > 0
    ports = read("analysis_port_risk_trade").where("country_iso = 'CN'")
    assert ports.where("total_B is not null").count() == ports.count() > 0
    from tradelane.plans import marts, routes
    for name, full in (("route_baselines", routes.route_baselines(ships)),
                       ("route_daily", routes.route_daily(ships)), ("strait_daily", marts.strait_daily(ships))):
        stored = read(name)
        assert sorted(map(str, stored.select(*full.columns).collect())) == sorted(map(str, full.collect())), name
    before = sorted(map(str, ships.collect()))
    late = jobs.sources(spark, landing, run_date)["vessel_movements"]
    late = late.where("mmsi % 2 = 0").withColumn("mmsi", F.col("mmsi") + 10**9)  # further vessels of old days
    keys, newest = jobs.HISTORIES["vessel_movements"]
    for _ in range(2):  # a repeat changes nothing
        sinks.sink_merge_days(late, f"{warehouse}/vessel_movements", keys, [F.col(newest).desc()])
    spark.catalog.clearCache()
    after = spark.read.parquet(f"{warehouse}/vessel_movements")
    assert sorted(map(str, after.where("mmsi < 1000000000").select(*ships.columns).collect())) == before
    assert after.where("mmsi >= 1000000000").count() == late.count() > 0


def test_nothing_landed(spark, tmp_path):
    assert jobs.run(spark, str(tmp_path / "none"), str(tmp_path / "w"), dt.date(2024, 2, 1)) == []


def test_daily_figures_follow_late_rows(spark, tmp_path):
    """Only days with new rows are read and written, and the figures are those of a full build."""
    from tradelane.plans import marts, routes

    def rows(days, first):
        return spark.createDataFrame(
            [(first + i, dt.date(2024, 1, d), 1.0 * i, "Cargo" if i % 2 else "Tanker", "Strait of Malacca", True, bool(i % 3))
             for d in days for i in range(5)],
            "mmsi long, fetch_date date, sog_knots double, vessel_category string, port_guess string, is_strait boolean, "
            "is_moving boolean").withColumn("event_time_utc", F.col("fetch_date").cast("timestamp"))

    history, files = str(tmp_path / "h"), {}
    for k, new in enumerate((rows([1, 2, 3], 0), rows([4], 0), rows([2], 100), rows([2], 100))):
        days = sinks.sink_merge_days(new, history, ["mmsi", "fetch_date"], [F.col("event_time_utc").desc()])
        whole = sinks.read_history(spark, history, new.schema)
        for name, build in jobs.DAILY["vessel_movements"].items():
            stored = sinks.refresh_days(whole, str(tmp_path / name), days, build)
            full = build(whole)
            assert sorted(map(str, stored.select(*full.columns).collect())) == sorted(map(str, full.collect()))
        now = {p.parent.name: p.name for p in (tmp_path / "route_daily").glob("*/*.parquet")}
        assert {d for d in now if now[d] != files.get(d)} == {f"fetch_date={d}" for d in days}
        files = now
    assert len(files) == 4
    assert routes.route_baselines(sinks.refresh_days(whole, str(tmp_path / "route_daily"), [], routes.route_daily)).collect() \
        == routes.route_baselines(whole).collect()
    assert marts.strait_vessel_trend(whole).count() == 4

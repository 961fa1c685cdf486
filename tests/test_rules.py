"""Rules at their edges: values on both sides of every limit, and null."""

import pytest
from pyspark.sql import functions as F

from tradelane import dims
from tradelane.functions import common, market, news, parsing, ports, vessels, weather
from tradelane.operators import series


def rows(spark, data, ddl):
    return spark.createDataFrame(data, ddl)


def apply(spark, values, kind, rule):
    df = rows(spark, [(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", rule(F.col("x")).alias("y")).orderBy("i").collect()]


def test_beaufort(spark):
    wind = [0.29, 0.3, 13.89, 13.9, 32.69, 32.7, None]
    force = apply(spark, wind, "double", weather.beaufort_number)
    assert force == [0, 1, 6, 7, 11, 12, None]
    names = apply(spark, [0, 12, None], "int", weather.beaufort_name)
    assert names == ["Calm", "Hurricane", None]
    assert apply(spark, [12], "int", lambda c: weather.beaufort_name(c, True)) == ["Hurricane force"]
    assert apply(spark, [999, 1000, None], "int", weather.low_visibility) == [True, False, None]
    assert apply(spark, [6, 7], "int", weather.gale_risk) == [False, True]


@pytest.mark.parametrize("geo,force,vis,score,level", [
    ("Low", 3, 4999, 23, "Moderate"), ("Low", 3, 5000, 18, "Normal"), ("Medium", 0, 999, 20, "Moderate"),
    ("Low", 3, 999, 28, "Moderate"), ("High", 2, 4999, 42, "High"), ("High", 2, 9000, 37, "Moderate"),
    ("Very High", 3, 9000, 58, "High"), ("Very High", 3, 4999, 63, "Critical"),
    ("Very High", 12, 10, 100, "Critical"), ("Odd", 1, 9000, 6, "Normal"),
])
def test_strait_score(spark, geo, force, vis, score, level):
    df = rows(spark, [(geo, force, vis)], "g string, f int, v int")
    s = weather.disruption_score(F.col("g"), F.col("f"), F.col("v"))
    got = df.select(s.alias("s"), weather.disruption_level(s).alias("l")).first()
    assert (got.s, got.l) == (score, level)


@pytest.mark.parametrize("v,d7,d30,d90,chg,want", [
    (10.0, 9.0, 9.0, 10.0, 2.1, "BULLISH"), (10.0, 9.0, 9.0, 10.0, 2.0, "NEUTRAL"),
    (8.0, 9.0, 9.0, 8.0, -2.1, "BEARISH"), (8.0, 9.0, 9.0, 8.0, -2.0, "NEUTRAL"),
    (12.0, 12.0, 12.0, 10.0, None, "OVERBOUGHT"), (8.0, 8.0, 8.0, 10.0, None, "OVERSOLD"),
    (8.5, 8.0, 8.0, 10.0, None, "NEUTRAL"), (11.4, 11.0, 11.0, 10.0, None, "NEUTRAL"),
])
def test_market_signal(spark, v, d7, d30, d90, chg, want):
    df = rows(spark, [(v, d7, d30, d90, chg)], "v double, a double, b double, c double, d double")
    assert df.select(market.market_signal(*[F.col(c) for c in "vabcd"])).first()[0] == want


def test_fuel_needs_five_rows(spark):
    data = [(f"2024-01-{d:02d}", 100.0 if d < 6 else 200.0) for d in range(1, 8)]
    df = rows(spark, data, "d string, brent_usd_per_bbl double").select(
        F.to_date("d").alias("date"), "brent_usd_per_bbl")
    out = [r for r in series.enrich_fuel(df).orderBy("date").collect()]
    assert [r.brent_30d_avg for r in out[:5]] == [None] * 4 + [100.0]
    assert [r.fuel_signal for r in out] == ["NORMAL"] * 5 + ["HIGH", "HIGH"]
    assert out[5].fuel_pressure_score == round((200 - 116.67) / 116.67 * 100, 2)
    assert apply(spark, [10.0, 10.01, 3.0, 3.01, -3.0, -2.99], "double", market.fuel_signal) == [
        "ELEVATED", "HIGH", "NORMAL", "ELEVATED", "LOW", "NORMAL"]


@pytest.mark.parametrize("text,hits,level,score", [
    ("calm seas", 0, "LOW", 10), ("an attack", 1, "MEDIUM", 48), ("attack attack", 1, "MEDIUM", 48),
    ("attack and strike", 2, "MEDIUM", 56), ("attack, strike, war", 3, "HIGH", 75),
    ("attack strike war missile drone blockade", 6, "HIGH", 90),
    ("attack strike war missile drone blockade halt", 7, "HIGH", 90), ("a warning", 1, "MEDIUM", 48),
])
def test_news_score(spark, text, hits, level, score):
    h = news.keyword_hits(F.lit(text))
    got = spark.range(1).select(h.alias("h"), news.risk_level(h).alias("l"),
                                news.risk_score(h).alias("s")).first()
    assert (got.h, got.l, got.s) == (hits, level, score)


def test_news_whole_words_and_routes(spark):
    one = spark.range(1)
    assert one.select(news.keyword_hits(F.lit("a warning"), whole_word=True)).first()[0] == 0
    assert one.select(news.keyword_hits(F.lit("the war."), whole_word=True)).first()[0] == 1
    routes = one.select(news.matched_routes(F.lit("suez and gulf"))).first()[0]
    assert routes == ["Asia-Europe via Suez", "Strait of Hormuz"]


def test_parse_number(spark):
    texts = ["2,030.00", "1.75%", "12K", "1.5K", "3M", "", "abc", None, "NaN"]
    assert apply(spark, texts, "string", parsing.parse_number) == [
        2030.0, 1.75, 12000.0, 1500.0, 3000000.0, None, None, None, None]


def test_text_and_dates(spark):
    assert apply(spark, [" re-export ", "EXPORT", "o'neil x", None], "string", parsing.title_case) == [
        "Re-Export", "Export", "O'Neil X", None]
    dates = apply(spark, ["03/31/2024", "13/45/2020", None], "string", parsing.parse_date)
    assert [str(d) if d else None for d in dates] == ["2024-03-31", None, None]
    assert apply(spark, [0, 59, 3600, 86399, 86400, None], "long", parsing.unix_to_hhmm) == [
        None, "00:00", "01:00", "23:59", "00:00", None]
    assert apply(spark, [1999, 2000, 2025], "int", parsing.decade) == [1990, 2000, 2020]
    assert apply(spark, ["5", "x", "nan", None], "string", parsing.to_number) == [5.0, None, None, None]


def test_rounding_is_decimal(spark):
    got = apply(spark, [1.005, 0.285, -1.005, 2.5, None], "double",
                lambda c: common.round_half_up(c, 2))
    assert got == [1.01, 0.29, -1.01, 2.5, None]


def test_vessel_codes(spark):
    assert apply(spark, [None, 0, 29, 30, 35, 36, 50, 59, 69, 70, 80, 89, 90], "int",
                 vessels.category_by_code) == [
        "Unknown", "Unknown", "Other", "Fishing", "Fishing", "Other", "Tug / Support",
        "Tug / Support", "Passenger", "Cargo", "Tanker", "Tanker", "Other"]
    assert apply(spark, [None, 70, 75], "int", vessels.vessel_type_name) == [
        "Unknown", "Cargo vessel", "Type 75"]
    assert apply(spark, [None, 5, 9], "int", vessels.nav_status_name) == [
        "Not reported", "Moored", "Unknown"]
    assert apply(spark, [None, 9, 16], "int", lambda c: vessels.nav_status_name(c, "capture")) == [
        "Not reported", "Reserved (HSC)", "Status 16"]
    assert apply(spark, [None, 0.49, 0.5, 3.0, 10.0], "double", vessels.speed_category) == [
        "Unknown", "Stationary", "Slow / manoeuvring", "Transit", "Cruising"]
    assert apply(spark, [None, 0.3, 0.31], "double",
                 lambda c: vessels.is_moving(c, "capture")) == [False, False, True]


@pytest.mark.parametrize("risk,trade,force,want", [
    (True, 500.1, 7, 1), (True, 500.0, 7, 2), (True, 100.0, 7, 3), (True, None, 7, 3),
    (False, 200.1, 5, 4), (False, 200.0, 5, 5), (None, 900.0, 4, 5), (None, None, None, 5),
])
def test_port_alert(spark, risk, trade, force, want):
    df = rows(spark, [(risk, trade, force)], "r boolean, t double, f int")
    got = df.select(ports.alert_priority(F.col("r"), F.col("t"), F.col("f"))).first()[0]
    assert got == want


@pytest.mark.parametrize("n,force,vis,word", [
    (51, 6, 9000, "HIGH"), (51, 5, 4999, "MODERATE"), (31, 0, 4999, "MODERATE"),
    (30, 7, 10, "WEATHER"), (51, 5, 0, "CONGESTION"), (51, 5, None, "CONGESTION"), (50, 6, 5000, "NORMAL"),
])
def test_congestion(spark, n, force, vis, word):
    df = rows(spark, [(n, force, vis)], "n int, f int, v int")
    assert word in df.select(ports.congestion_risk(F.col("n"), F.col("f"), F.col("v"))).first()[0]


@pytest.mark.parametrize("level,geo,port,want", [
    ("Critical", "Low", False, "DISRUPTED"), ("Normal", "Very High", False, "DISRUPTED"),
    ("Moderate", "Low", False, "WATCH"), ("Normal", "Low", True, "WATCH"), (None, None, True, "WATCH"),
    ("Normal", "Low", False, "CLEAR"), (None, None, False, "CLEAR"), ("Odd", "Low", False, "UNKNOWN"),
])
def test_route_status(spark, level, geo, port, want):
    df = rows(spark, [(level, geo, port)], "l string, g string, p boolean")
    assert want in df.select(ports.route_status(F.col("l"), F.col("g"), F.col("p"))).first()[0]


def test_route_impact(spark):
    df = rows(spark, [(0, 0.0, 0.0, -2.0, 0.0), (0, 400.0, -30.0, 20.0, 90.0), (3, 0.0, 1.0, 0.0, 0.0)],
              "cv int, base double, sg double, fuel double, news double")
    gap = ports.traffic_gap_pct(F.col("cv"), F.col("base"))
    parts = (gap, F.col("sg"), F.col("fuel"), F.col("news"))
    got = df.select(ports.route_impact(*parts).alias("a"),
                    ports.route_impact(*parts, cap=True).alias("b")).collect()
    assert [r.a for r in got] == [-0.6, 223.0, 0.0]
    assert [r.b for r in got] == [0.0, 100.0, 0.0]


def test_other_ladders(spark):
    assert apply(spark, [50.1, 50.0, 30.0, 15.0, None], "double", market.supply_concentration) == [
        "Critical (>50%)", "High (30-50%)", "Moderate (15-30%)", "Low (<15%)", "Low (<15%)"]
    assert apply(spark, ["Strait of Hormuz", "Bab el-Mandeb", "Strait of Dover"], "string",
                 weather.reroute_note)[2] == "Alternative routing possible"
    assert apply(spark, [10, 99, None], "int", market.commodity_name) == ["Cereals", "Other", "Other"]
    assert apply(spark, ["BULLISH", "?"], "string", market.charter_advice) == [
        dims.CHARTER_ADVICE["BULLISH"], None]
    assert [apply(spark, [s], "int", weather.score_band)[0][0] for s in (60, 59, 39, 19)] == list("⚠⚡👁✓")

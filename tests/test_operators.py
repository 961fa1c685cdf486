"""Operators against brute force on small frames."""

import datetime as dt
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradelane import dims, schemas
from tradelane.operators import asof, cleaning, combine, geo, news, quality, series, terms, trade
from tradelane.plans import marts, routes
from tradelane.sources import readers, sinks


def test_exact_quantiles_match_numpy(spark):
    random.seed(1)
    values = [random.choice([0.0, 1e6, random.expovariate(1e-3)]) for _ in range(5000)] + [1e12]
    df = spark.createDataFrame([(float(v), 7.0 if v else None) for v in values],
                               "a double, b double").repartition(7)
    got = quality.exact_quantiles(df, ["a", "b"], (0.0, 0.25, 0.5, 0.75, 1.0), keep=10, size=200)
    for p in (0.0, 0.25, 0.5, 0.75, 1.0):
        assert got[("a", p)] == pytest.approx(np.quantile(values, p), rel=1e-12)
        assert got[("b", p)] == 7.0
    assert quality.exact_quantiles(df.where("false"), ["a"], (0.5,)) == {("a", 0.5): None}


@pytest.mark.parametrize("chunk", [6, 10, 1000])
def test_rolling_bucketed(spark, chunk):
    random.seed(2)
    data = [(i, random.randrange(8), float(random.randrange(100))) for i in range(120)]
    df = spark.createDataFrame(data, "id int, t int, v double").repartition(5)
    out = series.rolling_bucketed(
        df, ["t", "id"], 6,
        lambda w: {"s": F.sum("v").over(w.rowsBetween(-5, 0)), "p": F.lag("v", 6).over(w)},
        chunk_rows=chunk).collect()
    ordered = sorted(data, key=lambda r: (r[1], r[0]))
    assert len(out) == len(data)
    for r in out:
        i = r.position - 1
        assert ordered[i][0] == r.id
        assert r.s == sum(x[2] for x in ordered[max(0, i - 5):i + 1])
        assert r.p == (ordered[i - 6][2] if i >= 6 else None)


def test_rolling_bucketed_rejects_short_chunks(spark):
    with pytest.raises(ValueError):
        series.rolling_bucketed(spark.range(3), ["id"], 5, lambda w: {}, chunk_rows=4)


@pytest.mark.parametrize("width", [1, 10, 1000])
def test_carry_last_with_a_hot_key(spark, width):
    random.seed(3)
    data = [(i, 1 if random.random() < 0.4 else random.randrange(6), random.randrange(300),
             f"s{i}" if random.random() < 0.2 else None) for i in range(400)]
    df = spark.createDataFrame(data, "id int, k int, t int, s string").repartition(6)
    out = asof.carry_last(df, "k", ["t", "id"], F.floor(F.col("t") / width), "s", "last")
    want, seen = {}, {}
    for i, k, t, s in sorted(data, key=lambda r: (r[2], r[0])):
        seen[k] = s or seen.get(k)
        want[i] = seen[k]
    assert {r.id: r["last"] for r in out.collect()} == want


def test_row_numbers_are_dense_and_ordered(spark):
    random.seed(4)
    a = [("a", dt.date(2024, 1, 1), i) for i in range(300)]  # one hot group
    b = [(random.choice(["b", None]), random.choice([None, dt.date(2024, 1, 2)]), i)
         for i in range(60)]
    frames = [spark.createDataFrame(x, "source string, date date, row_key long") for x in (a, b)]
    rows = combine.union_sources(frames, "row_key").orderBy("row_id").collect()
    assert [r.row_id for r in rows] == list(range(1, 361))
    keys = [(r.source, r.date is None, r.date or dt.date.min, r.row_key) for r in rows]
    assert keys == sorted(keys)


def test_boxes_first_match_and_corners(spark):
    points = [(1, 26.0, 55.0), (2, 22.0, 50.0), (3, 0.5, 103.0), (4, 80.0, 0.0), (5, None, 10.0),
              (6, 51.0, 3.2), (7, 53.0, 6.0)]
    df = spark.createDataFrame(points, "id int, latitude double, longitude double")
    want = {1: "Strait of Hormuz", 2: "Strait of Hormuz", 3: "Strait of Malacca", 4: "Unknown",
            5: "Unknown", 6: "Strait of Dover", 7: "Rotterdam"}
    assert {r.id: r.port_guess for r in geo.locate_bbox(df).collect()} == want
    grid = geo.locate_grid(df, dims.location_boxes(spark))
    assert {r.id: r.port_guess for r in grid.collect()} == want
    small = geo.locate_grid(df, dims.location_boxes(spark), leaf_boxes=1)
    assert {r.id: r.port_guess for r in small.collect()} == want
    flipped = [("x", 10.0, 0.0, 10.0, 0.0)]
    one = spark.createDataFrame([(5.0, 5.0)], "latitude double, longitude double")
    assert geo.locate_bbox(one, flipped, otherwise=None).first().port_guess == "x"


def test_route_mapping(spark):
    df = spark.createDataFrame([("Port of SINGAPORE",), ("Mumbai",), (None,)], "port_guess string")
    assert [r.route for r in geo.map_route(df).collect()] == [
        "Asia-Europe via Suez", "Unmapped / Other", "Unmapped / Other"]


def test_snapshot_differs_from_latest_per_key(spark):
    df = spark.createDataFrame([("a", "2024-01-01", 1), ("a", "2024-01-02", 2), ("b", "2024-01-01", 3),
                                ("a", "2024-01-02", 4)], "p string, d string, n int")
    df = df.withColumn("fetch_date", F.to_date("d"))
    assert sorted(r.n for r in cleaning.latest_snapshot(df).collect()) == [2, 4]
    latest = cleaning.dedupe_latest(df, ["p"], "fetch_date", ["n"])
    assert sorted(r.n for r in latest.collect()) == [3, 4]


def test_outliers_of_lonely_and_equal_groups(spark):
    data = [(1, 5.0), (2, 3.0), (2, 3.0), (None, 9.0)] + [(3, 1.0)] * 30 + [(3, 500.0)]
    df = spark.createDataFrame(data, "hs_code int, trade_value_usd double")
    out = trade.flag_outlier_grouped(df).where("is_outlier").collect()
    assert [(r.hs_code, r.trade_value_usd) for r in out] == [(3, 500.0)]


def test_news_cleaning(spark):
    long = "x" * 301
    data = [(1, " A strike ", "d", "2024-01-02T00:00:00Z"), (2, "A strike", "e", "2024-01-03T00:00:00Z"),
            (3, "", "", "2024-01-01T00:00:00Z"), (4, "[Removed]", "", "2024-01-01T00:00:00Z"),
            (5, None, "", "2024-01-01T00:00:00Z"), (6, "bad date", "", "soon"),
            (7, long, "y" * 501 + " war", "2024-01-01T00:00:00Z")]
    df = spark.createDataFrame(data, "n int, title string, description string, publishedAt string")
    df = df.withColumns({"url": F.lit(None).cast("string"), "source_name": F.lit(None).cast("string")})
    out = {r.n: r for r in news.clean_news(df, ["n"]).collect()}
    assert sorted(out) == [1, 7]
    assert out[1].risk_level == "MEDIUM" and out[1].source_name == "unknown"
    assert len(out[7].title) == 301 and len(out[7].description) == 505
    assert out[7].risk_level == "MEDIUM"  # the word stands at the very end


def test_one_sided_countries(spark):
    data = [("A", "X", "Export", 10, 5e9), ("B", "Y", "Import", 10, 7e9), ("C", "Z", "Re-Export", 10, 1e9)]
    df = spark.createDataFrame(data, "reporter_iso string, reporter_country string, "
                                     "flow_direction string, hs_code int, trade_value_usd double")
    out = {r.reporter_iso: r for r in marts.country_totals(df).collect()}
    assert set(out) == {"A", "B"}
    assert (out["A"].import_B, out["B"].export_B, out["B"].trade_position) == (0.0, 0.0, "Net Importer")
    wx = spark.createDataFrame([("a", "A", 1, 7, "n", True, 14.0, "w", dt.date(2024, 1, 1), 1)],
                               "port_name string, country_iso string, port_rank int, beaufort_number int, "
                               "beaufort_desc string, port_risk_flag boolean, wind_speed_ms double, "
                               "weather_main string, fetch_date date, fetched_at int")
    net = {r.reporter_iso: r for r in marts.net_exporter_risk(df, wx).collect()}
    assert net["A"].weather_impact == "Port disruption active"
    assert net["B"].weather_impact == "Normal operations" and net["B"].reporter_country is None


def test_iso_crosswalk(spark):
    df = spark.createDataFrame([("CN",), ("XX",)], "country_iso string")
    out = {r.country_iso: r.trade_iso for r in marts.to_iso3(df, dims.iso_crosswalk(spark)).collect()}
    assert out == {"CN": "CHN", "XX": None}


def test_routes_without_traffic_or_news(spark):
    vessels = spark.createDataFrame([(1, "Tokyo", dt.date(2024, 1, 1), 5.0, "Cargo"),
                                     (1, "Nowhere", dt.date(2024, 1, 2), 5.0, "Cargo")],
                                    "mmsi int, port_guess string, fetch_date date, sog_knots double, "
                                    "vessel_category string")
    fuel = schemas.empty(spark, "fuel_prices_daily")
    articles = schemas.empty(spark, "shipping_news")
    out = {r.route: r for r in routes.current_vs_historical(vessels, fuel, articles).collect()}
    assert set(out) == set(dims.ROUTES)
    assert all(r.event_date == dt.date(2024, 1, 2) for r in out.values())
    pacific = out["Trans-Pacific"]
    assert (pacific.current_vessels, pacific.baseline_avg_vessels) == (0, 1.0)
    assert pacific.traffic_vs_history_pct == -100.0 and pacific.speed_gap_knots == -5.0
    assert out["Black Sea"].route_impact_score == 0.0 and out["Black Sea"].fuel_signal == "NORMAL"
    alerts = {r.route: r.deviation_reason for r in routes.route_deviation_alerts(
        routes.current_vs_historical(vessels, fuel, articles)).collect()}
    assert alerts == {"Trans-Pacific": "Traffic drop"}


def test_missing_sources_are_empty(spark, tmp_path):
    missing = readers.src_clean_csv(spark, str(tmp_path / "none.csv"), "bdi_daily")
    assert missing.isEmpty() and "bdi_value" in missing.columns
    assert readers.src_table(spark, "no_such_table", schema_of="shipping_news").isEmpty()
    with pytest.raises(FileNotFoundError):
        readers.src_trade_csv(spark, str(tmp_path))


def test_all_trade_files_in_latin1(spark, tmp_path):
    for name, country in (("TradeData_1.csv", "Chile"), ("un_comtrade_2.csv", "Côte d'Ivoire"), ("fuel.csv", "no")):
        (tmp_path / name).write_bytes(f"reporterDesc,refYear\n{country},2020\n".encode("latin-1"))
    (tmp_path / "comtrade_3.csv").write_text("refYear,reporterDesc,motDesc\n2021,Peru,Sea\n2021,Peru,Air\n")
    rows = readers.src_trade_csv(spark, str(tmp_path), position=True)
    got = [(r.reporterDesc, r.refYear, r.motDesc) for r in rows.orderBy("_position").collect()]
    assert got == [("Chile", "2020", None), ("Peru", "2021", "Sea"), ("Peru", "2021", "Air"),
                   ("Côte d'Ivoire", "2020", None)]
    newest = readers.src_trade_csv(spark, str(tmp_path), newest_only=True)
    assert [r.reporterDesc for r in newest.collect()] == ["Côte d'Ivoire"]


def test_only_other_files_are_no_trade(spark, tmp_path):
    (tmp_path / "fuel.csv").write_text("date\n2020\n")
    with pytest.raises(FileNotFoundError):
        readers.src_trade_csv(spark, str(tmp_path))


def test_late_rows_join_their_day(spark, tmp_path):
    path = str(tmp_path / "h")

    def land(rows):
        df = spark.createDataFrame(rows, "k int, t int, v string, d string")
        sinks.sink_merge_days(df.withColumn("fetch_date", F.to_date("d")).drop("d"), path, ["k", "fetch_date"],
                              [F.col("t").desc()])

    land([(k, 5, "old", "2024-02-01") for k in range(100)])
    second = [(0, 9, "newer", "2024-02-01"), (1, 1, "older", "2024-02-01"), (200, 5, "late", "2024-02-01"),
              (0, 1, "next", "2024-02-02")]
    for _ in range(2):  # a repeat changes nothing
        land(second)
        rows = {(r.k, str(r.fetch_date)): r.v for r in sinks.read_history(spark, path).collect()}
        assert len(rows) == 102 and rows[(0, "2024-02-01")] == "newer" and rows[(1, "2024-02-01")] == "old"
        assert rows[(200, "2024-02-01")] == "late" and rows[(0, "2024-02-02")] == "next"


@pytest.mark.parametrize("extra", [[float("nan")] * 3, [float("inf")] * 2, [float("-inf"), 1e308], [1e300, None]])
def test_exact_quantiles_with_odd_values(spark, extra):
    values = [float(i % 997) for i in range(6000)] + extra
    df = spark.createDataFrame([(v,) for v in values], "a double").repartition(3)
    real = sorted(v for v in values if v is not None and v == v)
    got = quality.exact_quantiles(df, ["a"], (0.0, 0.25, 0.5, 1.0), keep=50, size=200)
    for p in (0.0, 0.25, 0.5, 1.0):
        at = (len(real) - 1) * p
        low, high = real[int(at)], real[min(int(at) + 1, len(real) - 1)]
        assert got[("a", p)] == (low if low == high or at == int(at) else low + (high - low) * (at - int(at)))


def test_places_outside_the_dimension_stay(spark, tmp_path):
    (tmp_path / "w.json").write_text(
        '{"place": "Nowhere", "fetched_at": "2024-01-01T00:00:00Z", "wind": {"speed": 3.0}}\n'
        '{"place": "Home", "fetched_at": "2024-01-01T00:00:00Z", "wind": {"speed": 4.0}}\n')
    own = spark.createDataFrame([("Home", "HM", 1, 1.0, 2.0)],
                                "port_name string, country_iso string, port_rank int, lat double, lon double")
    rows = {r.port_name: r for r in readers.src_weather_json(spark, str(tmp_path), own).collect()}
    assert rows["Home"].country_iso == "HM" and rows["Nowhere"].country_iso is None
    assert rows["Nowhere"].beaufort_number is not None


def test_own_routes_find_their_ports_at_risk(spark):
    wx = spark.createDataFrame(
        [(p, True, "2024-01-01", 9) for p in ("Tokyo", "Osaka", "Rotterdam")],
        "port_name string, port_risk_flag boolean, d string, beaufort_number int").withColumns(
        {"fetch_date": F.to_date("d"), "fetched_at": F.to_timestamp("d")})
    straits = spark.createDataFrame([("S", 10, "Normal", "Low", 3, "2024-01-01")],
        "strait_name string, disruption_score int, risk_level string, geopolitical_risk string, "
        "beaufort_number int, d string").withColumns({"fetch_date": F.to_date("d"), "fetched_at": F.to_timestamp("d")})
    own = spark.createDataFrame([("Mine", ["Tokyo"], ["Osaka"], "S", None, [2709], "n")],
        "route string, origin_ports array<string>, dest_ports array<string>, strait string, "
        "alt_strait string, hs_codes array<int>, route_notes string")
    r = marts.route_disruption(straits, wx, own).first()
    assert (r.origin_ports_at_risk, r.dest_ports_at_risk) == ("Tokyo", "Osaka")


def test_long_descriptions_are_classified_whole(spark):
    text = "quiet " * 300 + "attack piracy houthi"
    df = spark.createDataFrame([("t", text, "2024-01-01T00:00:00", "u", "s")],
                               "title string, description string, publishedAt string, url string, source_name string")
    row = news.clean_news(df, keywords=["attack", "piracy", "houthi"]).first()
    assert row.risk_level == "HIGH" and row.description == text
    assert len(news.clean_news(df, stored={"description": 500}).first().description) == 500


def test_repeated_day_is_replaced(spark, tmp_path):
    path = str(tmp_path / "h")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "n int, d string")
    df = df.select("n", F.to_date("d").alias("fetch_date"))
    sinks.sink_append(df, path)
    for _ in range(2):
        sinks.sink_replace_days(df.where("n = 2").withColumn("n", F.lit(5)), path)
    assert sorted(r.n for r in sinks.read_history(spark, path).collect()) == [1, 5]
    assert not sinks.sink_overwrite(df.where("false"), path)


def test_many_boxes_against_all_of_them(spark):
    """100,000 boxes: most small and in one place, some that cover whole cells, piles of equal ones."""
    r = np.random.default_rng(4)
    n = 100_000
    lat, lon = np.where(r.random((2, n)) < 0.7, r.normal(20, 1.5, (2, n)), r.uniform(-80, 80, (2, n)))
    wide = np.where(r.random(n) < 0.002, 30.0, r.exponential(0.05, n))
    lat[:300], lon[:300], wide[:300] = 20.0, 20.0, 0.5
    priority = r.permutation(n // 2).repeat(2)  # ties are settled by the label
    box = np.stack([lat, lat + wide, lon, lon + wide])
    boxes = spark.createDataFrame(
        [(int(p), f"b{i}", *map(float, b)) for i, (p, b) in enumerate(zip(priority, box.T, strict=True))],
        "priority int, label string, lat_min double, lat_max double, lon_min double, lon_max double")
    points = np.concatenate([r.normal(20, 2, (300, 2)), r.uniform(-85, 85, (100, 2)), box[[0, 2], :50].T, box[[1, 3], 300:350].T])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(points)] + [(-1, None, 1.0)],
                               "id int, latitude double, longitude double")
    leaves = geo.box_leaves(boxes)
    assert leaves.count() < 12 * n and leaves.select("level").distinct().count() > 3
    assert not any(f.dataType.typeName() == "array" for f in leaves.schema)
    got = {x.id: x.port_guess for x in geo.locate_grid(df, boxes).collect()}
    labels = np.array([f"b{i}" for i in range(n)])
    for i, (a, b) in enumerate(points):
        hit = np.flatnonzero((box[0] <= a) & (a <= box[1]) & (box[2] <= b) & (b <= box[3]))
        want = min(((priority[j], labels[j]) for j in hit), default=(0, "Unknown"))[1]
        assert got[i] == want, i
    assert got[-1] == "Unknown" and len(got) == len(points) + 1


def test_terms_of_a_table(spark):
    rnd = random.Random(8)
    texts = ["".join(rnd.choice("abcde É'.%_\\") for _ in range(rnd.randint(0, 60))) for _ in range(80)]
    texts += [None, "", "a", "ab", "Red Sea", "red seas", "Ütter"]
    own = {"".join(rnd.choice("abcde'.%\\É") for _ in range(rnd.randint(1, 5))) for _ in range(150)}
    own |= {"red sea", "RED SEA", "", "ab", "ütter", "nowhere at all"}
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    table = spark.createDataFrame([(t,) for t in own] + [(None,)], "term string")
    got = {(r.id, r.term) for r in terms.match_terms(df, table, "id", "text").collect()}
    assert got == {(i, t.lower()) for i, x in enumerate(texts) if x for t in own if t and t.lower() in x.lower()}
    word = {(r.id, r.term) for r in terms.match_terms(df, table.where("term ilike 'red sea'"), "id", "text",
                                                      whole_word=True).collect()}
    assert word == {(texts.index("Red Sea"), "red sea")}
    assert terms.match_terms(df, table.limit(0), "id", "text").count() == 0


def test_a_hundred_thousand_terms_meet_by_equality(spark):
    table = spark.range(100_000).selectExpr("concat('term ', id, ' x') AS term")
    df = spark.createDataFrame([(i, f"first TERM {i * 7} x, then term {i + 5} x and term {i}") for i in range(60)],
                               "id int, text string")
    found = terms.match_terms(df, table, "id", "text")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
    assert {(r.id, r.term) for r in found.collect()} == {(i, f"term {k} x") for i in range(60) for k in (i * 7, i + 5)}


def test_points_are_not_dealt_anew_to_find_their_box(spark):
    rnd = random.Random(5)
    boxes = [(i, f"B{i}", y := rnd.uniform(-20, 20), y + 3, x := rnd.uniform(-20, 20), x + 3) for i in range(30)]
    pile = [(100 + i, f"P{i}", 50.01, 50.02 + i / 1000, 50.01, 50.02) for i in range(20)]  # beyond what a leaf may hold
    points = [(i, rnd.uniform(-25, 25), rnd.uniform(-25, 25)) for i in range(300)]
    points += [(1000 + i, 50.0 + i / 700, 50.015) for i in range(40)] + [(2000, None, 1.0), (2001, float("nan"), 50.0)]
    df = spark.createDataFrame(points, "id int, latitude double, longitude double")
    schema = "priority int, label string, lat_min double, lat_max double, lon_min double, lon_max double"
    for table in (boxes, boxes + pile):
        found = geo.locate_grid(df, spark.createDataFrame(table, schema), leaf_boxes=4, levels=6)
        assert {r.id: r.port_guess for r in found.collect()} == {i: next((
            b[1] for b in table if lat is not None and b[2] <= lat <= b[3] and b[4] <= lon <= b[5]), "Unknown") for i, lat, lon in points}
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert ("Aggregate [_id" in plan) == (table != boxes)


@pytest.mark.parametrize("name", ["drop_all_null_columns", "quality_report"])
def test_trade_rows_are_joined_once(spark, name):
    """What passes over the rows several times reads them as they were written."""
    from tradelane import registry
    found = registry.queries()[name](spark, "/root/testdata/sf0.001")
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_plain_terms_are_looked_up_in_the_distinct_words(spark):
    texts = ["Pineapple apples", "apple", "an app-le", "Ä7x a7X", None, "über-Übergang", "apple apple " * 50]
    own = ["apple", "APPLE", "pp", "7x", "übergang", "p-l", "e a"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    table = spark.createDataFrame([(t,) for t in own], "term string")
    got = [(r.id, r.term) for r in terms.match_terms(df, table, "id", "text").collect()]
    assert len(got) == len(set(got)) and set(got) == {
        (i, t.lower()) for i, x in enumerate(texts) if x for t in own if t.lower() in x.lower()}
    plain = table.where("not contains(term, '-') and not contains(term, ' ')")
    word = {(r.id, r.term) for r in terms.match_terms(df, plain, "id", "text", whole_word=True).collect()}
    assert word == {(1, "apple"), (5, "übergang"), (6, "apple")}
    plan = terms.match_terms(df, plain, "id", "text")._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "contains(" not in plan and "transform(" not in plan  # no text is cut into runs of characters or read again


def test_balanced_buckets_split_a_hot_vessel(spark):
    """A third of all rows under one number: no bucket holds more than its rows and one cell."""
    start = dt.datetime(2024, 1, 1)
    rows = [(i, 0 if i % 3 == 0 else 1 + i % 50, start + dt.timedelta(seconds=(i * 7919) % 20_000 * (1 if i % 2 else 30)),
             "ShipStaticData" if i % 11 == 0 else "PositionReport", f"N{i}" if i % 11 == 0 else None)
            for i in range(6000)]
    df = spark.createDataFrame(rows, "message_id long, mmsi long, event_time_utc timestamp, message_type string, "
                                     "ship_name string").withColumns({f: F.lit(None).cast("string") for f in (
                                         "imo", "call_sign", "destination", "vessel_type", "eta")})
    cells = Counter((r[1], r[2].replace(second=0)) for r in rows)
    split = asof.balanced_buckets(df, "mmsi", "event_time_utc", rows=100)
    sizes = {(r.mmsi, r._bucket): r["count"] for r in split.groupBy("mmsi", "_bucket").count().collect()}
    assert max(sizes.values()) <= 100 + max(cells.values()) and len([k for k in sizes if k[0] == 0]) > 15
    got = {r.message_id: r.ship_name for r in asof.enrich_static(df, rows=100).collect()}
    last, want = {}, {}
    for i, vessel, _, kind, name in sorted(rows, key=lambda r: (r[2], r[0])):
        if kind == "ShipStaticData":
            last[vessel] = name
        else:
            want[i] = last.get(vessel)
    assert got == want


def test_newest_day_reads_one_folder(spark, tmp_path):
    df = spark.range(50).selectExpr("id", "date_add(date'2024-01-28', cast(id % 7 as int)) AS fetch_date")
    path = str(tmp_path / "history")
    sinks.sink_append(df.union(spark.sql("SELECT 99L, CAST(NULL AS DATE)")), path)
    newest = sinks.read_newest(spark, path, df.schema)
    assert sinks.newest_partition(spark, path) == "2024-02-03"
    assert sorted(r.id for r in newest.collect()) == list(range(6, 50, 7))
    read = newest.select(F.col("_metadata.file_path").alias("f")).distinct().collect()
    assert all("2024-02-03" in r.f for r in read)
    assert "PartitionFilters: [isnotnull(fetch_date" in newest._jdf.queryExecution().toString()
    assert sinks.read_newest(spark, str(tmp_path), df.schema).count() == 0


def test_merges_read_no_footers_and_leave_nothing(spark, tmp_path):
    from tradelane.session import scratch_root
    path = str(tmp_path / "merged")
    left = set(sinks.folders(spark, scratch_root(spark), "merge-"))
    first = spark.createDataFrame([(1, "2024-01-01", 1.0)], "id int, fetch_date string, a double")
    sinks.sink_merge_days(first, path, ["id"], [F.col("id")])
    sinks.sink_merge_days(first.selectExpr("id + 1 AS id", "fetch_date", "'x' AS b"), path, ["id"], [F.col("id")])
    assert [f.name for f in sinks.merged_schema(spark, path, first)] == ["id", "fetch_date", "a", "b"]
    rows = sinks.read_history(spark, path, sinks.merged_schema(spark, path, first)).orderBy("id").collect()
    assert [(r.id, r.a, r.b) for r in rows] == [(1, 1.0, None), (2, None, "x")]
    assert set(sinks.folders(spark, scratch_root(spark), "merge-")) == left


def test_published_table_is_never_missing(spark, tmp_path):
    folder, rows = str(tmp_path / "versions"), spark.range(100).selectExpr("id % 7 AS mmsi", "id")
    sinks.sink_publish(rows, "published", folder, ["mmsi"], 4)
    before = spark.table("published")
    assert before.count() == 100
    sinks.sink_publish(rows.where("id < 10"), "published", folder, ["mmsi"], 4)
    assert spark.table("published").count() == 10 and len(sinks.folders(spark, folder, "version=")) == 2
    sinks.sink_publish(rows.where("id < 5").withColumn("more", F.lit(1)), "published", folder, ["mmsi"], 4)
    assert spark.table("published").columns == ["mmsi", "id", "more"]
    assert len(sinks.folders(spark, folder, "version=")) == 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (spark.table("published").groupBy("mmsi").count(),
                   spark.table("published").join(spark.table("published").selectExpr("mmsi", "id AS other"), "mmsi")):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE published")


def test_snapshots_of_a_published_table_copy_nothing(spark, tmp_path):
    folder, rows = str(tmp_path / "versions"), spark.range(100).selectExpr("id % 7 AS mmsi", "id")
    first = dt.date(2024, 1, 1)

    def day(i):
        return first + dt.timedelta(days=i)

    def versions():
        return set(sinks.folders(spark, folder, "version="))

    sinks.sink_publish(rows, "shot", folder, ["mmsi"], 4, keep=1)
    whole = versions()
    old = sinks.snapshot_published(spark, "shot", folder, day(0), keep=1)
    for n in (10, 20, 30):
        sinks.sink_publish(rows.where(f"id < {n}"), "shot", folder, ["mmsi"], 4, keep=1)
    assert whole < versions() and len(versions()) == 2  # what a snapshot names stays, others go
    assert spark.table(old).count() == 100 and spark.table("shot").count() == 30
    again = sinks.snapshot_published(spark, "shot", folder, day(10), keep=1)
    sinks.sink_publish(rows.where("id < 40").withColumn("more", F.lit(1)), "shot", folder, ["mmsi"], 4, keep=1)
    assert spark.table(again).columns == ["mmsi", "id"] and spark.table(again).count() == 30
    assert sinks.snapshot_published(spark, "shot", folder, day(10), keep=1) == again  # in place of the first
    assert spark.table(again).columns == ["mmsi", "id", "more"] and spark.table(again).count() == 40
    assert len(versions()) == 2 and set(sinks.published_snapshots(spark, folder)) == {"20240101", "20240111"}
    plan = spark.table(again).groupBy("mmsi").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # in the buckets of the table
    last = sinks.snapshot_published(spark, "shot", folder, day(15), keep=1)
    assert not spark.catalog.tableExists(old) and spark.catalog.tableExists(again) and len(versions()) == 1
    for name in ("shot", again, last):
        spark.sql(f"DROP TABLE {name}")


def test_overwrite_puts_the_old_table_back(spark, tmp_path):
    path = str(tmp_path / "table")
    assert sinks.sink_overwrite(spark.range(3), path)
    assert sinks.sink_overwrite(spark.range(4), path) and spark.read.parquet(path).count() == 4
    assert not sinks.sink_overwrite(spark.range(0), path) and spark.read.parquet(path).count() == 4
    assert sorted(p.name for p in tmp_path.iterdir()) == ["table"]

"""Independent SQL for every registered query that SQL can express.

``TABLES`` holds named subqueries; a query text is prefixed with the ones it uses.
"""

from __future__ import annotations

import re

from tradelane import dims
from tradelane.standin import BILLION, FOCUS_COUNTRY, NEWS_KEYWORDS, NEWS_ROUTES, TRILLION


def q(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def r(x: str, n: int) -> str:
    """Round half away from zero on the decimal form of a double."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,9)), {n}) AS DOUBLE)"


def rows(values, names: str) -> str:
    def cell(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return q(v)
        if isinstance(v, list):
            return "[" + ", ".join(cell(x) for x in v) + "]"
        if isinstance(v, float):
            return f"CAST({v!r} AS DOUBLE)"
        return str(v)
    body = ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in values)
    return f"SELECT * FROM (VALUES {body}) AS v({names})"


def case(pairs, otherwise="NULL") -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in pairs) + f" ELSE {otherwise} END"


def usd(expr: str) -> str:
    return f"CAST(sum(CAST({expr} AS DECIMAL(18,2))) AS DOUBLE)"


B, T = f"CAST({BILLION} AS DOUBLE)", f"CAST({TRILLION} AS DOUBLE)"
TS = "%Y-%m-%d %H:%M:%S.%f"

HS_CASE = case([(f"hs_code = {k}", q(v)) for k, v in dims.HS_NAMES.items()], "'Other'")
SENS_CASE = case([(f"hs_code = {k}", q(v)) for k, v in dims.HS_SENSITIVITY.items()], "'Unknown'")
BF = "CASE WHEN wind_speed_ms IS NULL THEN NULL ELSE " + " + ".join(
    f"CAST(wind_speed_ms >= {x} AS INT)" for x in dims.BEAUFORT_LIMITS) + " END"


def bf_name(last: str) -> str:
    names = dims.BEAUFORT_NAMES[:-1] + [last]
    return "[" + ", ".join(q(n) for n in names) + "][beaufort_number + 1]"


WX = """value / 10 AS wind_speed_ms, CAST((event_id * 53) % 11000 AS INT) AS visibility_m,
  CAST(event_id % 400 AS DOUBLE) / 10 - 5 AS temp_c, CAST(event_id % 101 AS INT) AS humidity_pct,
  CASE event_type WHEN 'view' THEN 'Clear' WHEN 'click' THEN 'Clouds' WHEN 'purchase' THEN 'Rain'
    WHEN 'signup' THEN 'Mist' WHEN 'error' THEN 'Thunderstorm' END AS weather_main"""

BOX_CASE = case([(f"latitude BETWEEN {a} AND {b} AND longitude BETWEEN {c} AND {d}", q(n))
                 for n, a, b, c, d in dims.LOCATION_BOXES], "'Unknown'")
ROUTE_CASE = case([(f"contains(lower(port_guess), {q(k.lower())})", q(v))
                   for k, v in dims.PLACE_TO_ROUTE.items()], q(dims.UNMAPPED_ROUTE))
HITS = " + ".join(f"CAST(contains(txt, {q(w)}) AS INT)" for w in NEWS_KEYWORDS)
NEWS_MATCH = "concat_ws(', ', " + ", ".join(
    f"CASE WHEN {' OR '.join(f'contains(txt, {q(w)})' for w in ws)} THEN {q(n)} END"
    for n, ws in NEWS_ROUTES.items()) + ")"
SPEED = ("CASE WHEN sog_knots IS NULL THEN 'Unknown' WHEN sog_knots < {} THEN 'Stationary' "
         "WHEN sog_knots < {} THEN 'Slow / manoeuvring' WHEN sog_knots < {} THEN 'Transit' "
         "ELSE 'Cruising' END")
CATEGORY = ("CASE WHEN vessel_type IS NULL OR vessel_type = 0 THEN 'Unknown' "
            "WHEN vessel_type BETWEEN 70 AND 79 THEN 'Cargo' WHEN vessel_type BETWEEN 80 AND 89 "
            "THEN 'Tanker' WHEN vessel_type BETWEEN 60 AND 69 THEN 'Passenger' WHEN vessel_type "
            "BETWEEN 30 AND 35 THEN 'Fishing' WHEN vessel_type BETWEEN 50 AND 59 THEN "
            "'Tug / Support' ELSE 'Other' END")
NAV = case([(f"navigational_status = {k}", q(v)) for k, v in dims.NAV_STATUS_DAILY.items()],
           "CASE WHEN navigational_status IS NULL THEN 'Not reported' ELSE 'Unknown' END")
SIGNAL = ("CASE WHEN bdi_value > rolling_7d_avg AND bdi_value > rolling_30d_avg AND "
          "daily_change_pct > 2 THEN 'BULLISH' WHEN bdi_value < rolling_7d_avg AND bdi_value < "
          "rolling_30d_avg AND daily_change_pct < -2 THEN 'BEARISH' WHEN bdi_value > "
          "rolling_90d_avg * CAST(1.15 AS DOUBLE) THEN 'OVERBOUGHT' WHEN bdi_value < "
          "rolling_90d_avg * CAST(0.85 AS DOUBLE) THEN 'OVERSOLD' ELSE 'NEUTRAL' END")
ADVICE = case([(f"market_signal = {q(k)}", q(v)) for k, v in dims.CHARTER_ADVICE.items()])
NOTE = case([
    ("contains(strait_name, 'Hormuz')", q("Cape of Good Hope or Suez (adds ~7 days, +$300K/voyage)")),
    ("contains(strait_name, 'Suez') OR contains(strait_name, 'Bab el-Mandeb')",
     q("Cape of Good Hope (adds ~14 days, +$1M/voyage est.)")),
    ("contains(strait_name, 'Malacca')", q("Lombok or Sunda Strait (adds ~2 days)")),
    ("contains(strait_name, 'Bosphorus')", q("No alternative — Black Sea landlocked")),
    ("contains(strait_name, 'Gibraltar')", q("No practical alternative for Mediterranean access")),
], q("Alternative routing possible"))
BADGE = ("CASE risk_level WHEN 'Critical' THEN '🔴 CRITICAL' WHEN 'High' THEN '🟠 HIGH' "
         "WHEN 'Moderate' THEN '🟡 MODERATE' ELSE '🟢 NORMAL' END")
PRIORITY = ("CASE WHEN coalesce(port_risk_flag, false) AND coalesce({t}, 0) > 500 THEN 1 WHEN "
            "coalesce(port_risk_flag, false) AND coalesce({t}, 0) > 100 THEN 2 WHEN "
            "coalesce(port_risk_flag, false) THEN 3 WHEN coalesce(beaufort_number, 0) >= 5 AND "
            "coalesce({t}, 0) > 200 THEN 4 ELSE 5 END")
ALERT = ("['🔴 CRITICAL — High-value port at risk', '🟠 HIGH — Major port at risk', "
         "'🟡 MODERATE — Port at risk, lower trade', '🟡 WATCH — Fresh breeze at major port', "
         "'🟢 NORMAL — Operations unaffected'][alert_priority]")
CONGEST = ("CASE WHEN {v} > 50 AND beaufort_number >= 6 THEN '🔴 HIGH — Dense traffic + strong winds' "
           "WHEN {v} > 30 AND coalesce(nullif(visibility_m, 0), 10000) < 5000 THEN "
           "'🟠 MODERATE — Dense traffic + limited visibility' WHEN beaufort_number >= 7 THEN "
           "'🟡 WEATHER — Near-gale conditions' WHEN {v} > 50 THEN "
           "'🟡 CONGESTION — High vessel density' ELSE '🟢 NORMAL' END")
CORR = ("CASE WHEN {a} > 2 AND {b} > 2 THEN 'Both rising' WHEN {a} < -2 AND {b} < -2 THEN "
        "'Both falling' WHEN {a} > 5 AND {b} < 0 THEN 'BDI up, trade down (freight squeeze)' "
        "WHEN {a} < -5 AND {b} > 0 THEN 'BDI down, trade up (cheap shipping)' ELSE "
        "'Neutral / mixed' END")
CONC = ("CASE WHEN {s} > 50 THEN 'Critical (>50%)' WHEN {s} > 30 THEN 'High (30-50%)' WHEN {s} > 15 "
        "THEN 'Moderate (15-30%)' ELSE 'Low (<15%)' END")
MONTHS = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'][month]"


def yoy(x: str) -> str:
    lag = f"lag({x}) OVER (ORDER BY year)"
    return r(f"({x} - {lag}) / nullif({lag}, 0) * 100", 2)


def counts(keys: str, source: str) -> str:
    return f"""SELECT {keys}, count(DISTINCT mmsi) AS vessels,
      count(*) FILTER (vessel_category = 'Tanker') AS tanker_count,
      count(*) FILTER (vessel_category = 'Cargo') AS cargo_count,
      count(*) FILTER (is_moving) AS moving_count, {r('avg(sog_knots)', 1)} AS avg_speed_knots
      FROM {source} GROUP BY ALL"""


def roll(n: int, expr: str = "bdi_value") -> str:
    return r(f"avg({expr}) OVER (ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)", 2)


TABLES = {
    "trade_rows": """SELECT concat('N', lpad(CAST(c_nationkey AS VARCHAR), 2, '0')) AS reporter_iso,
        n_name AS reporter_country, 'W00' AS partner_iso,
        CASE p_type WHEN 'ECONOMY' THEN 10 WHEN 'LARGE' THEN 26 WHEN 'MEDIUM' THEN 27
          WHEN 'PROMO' THEN 72 WHEN 'SMALL' THEN 89 ELSE 99 END AS hs_code,
        CASE WHEN l_returnflag = 'R' THEN 'Import' ELSE 'Export' END AS flow_direction,
        CAST(year(o_orderdate) AS INT) AS year, l_extendedprice AS trade_value_usd,
        CASE WHEN l_quantity > 1 THEN l_quantity END AS net_weight_kg,
        l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey""",
    "trade_flows": f"SELECT *, {HS_CASE} AS commodity_name FROM trade_rows",
    "trade_unique": """SELECT * FROM trade_rows QUALIFY row_number() OVER (
        PARTITION BY reporter_iso, partner_iso, hs_code, flow_direction, year
        ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, trade_value_usd) = 1""",
    "trade_raw": """SELECT 'C' AS "typeCode", 'A' AS "freqCode",
        concat(' ', lower(reporter_iso), ' ') AS "reporterISO",
        concat(reporter_country, ' ') AS "reporterDesc", 'w00' AS "partnerISO",
        CASE WHEN l_linenumber = 7 AND hs_code = 99 THEN 'n/a' ELSE CAST(hs_code AS VARCHAR) END
          AS "cmdCode",
        CASE WHEN l_linenumber = 5 THEN ' re-export' ELSE lower(flow_direction) END AS "flowDesc",
        CAST(year AS VARCHAR) AS "refYear",
        CASE WHEN net_weight_kg IS NULL OR net_weight_kg < 50 THEN trade_value_usd END
          AS "primaryValue",
        net_weight_kg AS "netWgt", CASE WHEN l_linenumber <> 1 THEN 'Sea' END AS "motDesc",
        CASE WHEN l_linenumber <> 2 THEN net_weight_kg END AS qty,
        CASE WHEN l_linenumber <> 3 THEN false END AS "isNetWgtEstimated",
        CAST(NULL AS VARCHAR) AS "qtyUnitAbbr", l_orderkey, l_linenumber, l_partkey, l_suppkey,
        strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS l_shipdate
      FROM trade_rows""",
    "index_daily": f"""SELECT CAST(o_orderdate AS DATE) AS date,
        {usd('o_totalprice')} / count(*) AS bdi_value FROM orders GROUP BY 1""",
    "index_raw": """SELECT CASE WHEN day(date) = 29 THEN NULL ELSE date END AS date,
        CASE WHEN day(date) <> 30 THEN p END AS price, CASE WHEN day(date) % 5 <> 0 THEN p END AS open,
        p AS high, CASE day(date) % 5 WHEN 0 THEN 1500.0::DOUBLE WHEN 1 THEN 12000.0::DOUBLE
          WHEN 2 THEN 3000000.0::DOUBLE END AS volume, CAST(day(date) AS DOUBLE) + 0.25 AS change
      FROM (SELECT date, floor(bdi_value * 100) / 100 AS p FROM index_daily)""",
    "bdi_change": f"""SELECT *, {r("(bdi_value - lag(bdi_value) OVER (ORDER BY date)) / "
        "nullif(lag(bdi_value) OVER (ORDER BY date), 0) * 100", 4)} AS daily_change_pct,
        {roll(7)} AS rolling_7d_avg, {roll(30)} AS rolling_30d_avg, {roll(90)} AS rolling_90d_avg
      FROM index_daily""",
    "bdi_daily": """SELECT b.*, bdi_value > m AS above_long_avg,
        coalesce(daily_change_pct > 5, false) AS is_spike,
        coalesce(daily_change_pct < -5, false) AS is_drop,
        coalesce(abs(bdi_value - m) > 3 * s, false) AS is_outlier, CAST(year(date) AS INT) AS year,
        CAST(month(date) AS INT) AS month, CAST(quarter(date) AS INT) AS quarter,
        dayname(date) AS weekday
      FROM bdi_change b, (SELECT avg(bdi_value) AS m, stddev_samp(bdi_value) AS s FROM index_daily)""",
    "fuel_raw": f"""SELECT CAST(l_shipdate AS DATE) AS date,
        {usd('l_extendedprice')} / sum(l_quantity) / 20 AS brent_usd_per_bbl
      FROM lineitem GROUP BY 1""",
    "fuel_avg": f"""SELECT *, {roll(7, 'brent_usd_per_bbl')} AS brent_7d_avg,
        CASE WHEN count(*) OVER (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) >= 5
          THEN {roll(30, 'brent_usd_per_bbl')} END AS brent_30d_avg FROM fuel_raw""",
    "fuel_score": f"""SELECT *, coalesce({r("(brent_usd_per_bbl - brent_30d_avg) / brent_30d_avg "
        "* 100", 2)}, 0) AS fuel_pressure_score FROM fuel_avg""",
    "fuel": f"""SELECT *, CASE WHEN fuel_pressure_score > 10 THEN 'HIGH' WHEN fuel_pressure_score > 3
        THEN 'ELEVATED' WHEN fuel_pressure_score > -3 THEN 'NORMAL' ELSE 'LOW' END AS fuel_signal,
        {r('brent_usd_per_bbl * CAST(7.1 AS DOUBLE)', 2)} AS vlsfo_est_usd_per_mt,
        CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month,
        dayname(date) AS weekday FROM fuel_score""",
    "vessel_rows": """SELECT event_id, user_id AS mmsi, ts AS event_time_utc,
        CAST(ts AS DATE) AS fetch_date, value / 10 AS sog_knots,
        CASE event_type WHEN 'view' THEN 70 WHEN 'click' THEN 80 WHEN 'purchase' THEN 60
          WHEN 'signup' THEN 30 END AS vessel_type,
        CAST((event_id * 37) % 6500 AS DOUBLE) / 100 - 10 AS latitude,
        CAST((event_id * 91) % 27000 AS DOUBLE) / 100 - 125 AS longitude,
        k % 17 AS navigational_status,
        CASE k % 10 WHEN 0 THEN '' WHEN 1 THEN '@@@@' WHEN 2 THEN NULL
          ELSE concat(' Port ', k, ' ') END AS destination
      FROM (SELECT *, CAST(props->>'$.k' AS INT) AS k FROM events)""",
    "vessels": f"""SELECT *, port_guess IN ({', '.join(q(x) for x in dims.STRAIT_LABELS)}) AS is_strait
      FROM (SELECT *, {BOX_CASE} AS port_guess, {CATEGORY} AS vessel_category,
        {SPEED.format(0.5, 3.0, 10.0)} AS speed_category,
        coalesce(sog_knots, 0) >= 0.5 AS is_moving, {NAV} AS nav_status_name FROM vessel_rows)""",
    "vessels_daily": """SELECT * FROM vessels QUALIFY row_number() OVER (
        PARTITION BY mmsi, fetch_date ORDER BY event_time_utc DESC, event_id DESC) = 1""",
    "port_names": "SELECT [" + ", ".join(q(p[0]) for p in dims.PORTS) + "] AS names",
    "port_rows": f"""SELECT CASE WHEN user_id < 100 THEN names[user_id + 1]
          ELSE concat(names[user_id % 100 + 1], ' #', user_id // 100) END AS port_name,
        concat('N', lpad(CAST(coalesce(s_nationkey, user_id % 25) AS VARCHAR), 2, '0')) AS country_iso,
        CAST(user_id + 1 AS INT) AS port_rank, CAST(ts AS DATE) AS fetch_date,
        ts AS fetched_at, event_id, {WX}
      FROM events LEFT JOIN supplier ON user_id = s_suppkey CROSS JOIN port_names""",
    "port_weather": f"""SELECT *, {bf_name('Hurricane')} AS beaufort_desc,
        beaufort_number >= 7 AS port_risk_flag, visibility_m < 1000 AS low_visibility
      FROM (SELECT *, {BF} AS beaufort_number FROM port_rows)""",
    "strait_dim": rows([(i, *s) for i, s in enumerate(dims.STRAITS)],
                       "strait_no, " + ", ".join(dims.STRAIT_COLUMNS)),
    "strait_rows": f"""SELECT d.* EXCLUDE (strait_no), e.* FROM (
        SELECT user_id % 8 AS no, CAST(ts AS DATE) AS fetch_date, ts AS fetched_at, event_id, {WX}
        FROM events) e JOIN strait_dim d ON d.strait_no = e.no""",
    "strait_conditions": f"""SELECT *, CASE WHEN disruption_score >= 60 THEN 'Critical'
          WHEN disruption_score >= 40 THEN 'High' WHEN disruption_score >= 20 THEN 'Moderate'
          ELSE 'Normal' END AS risk_level
      FROM (SELECT *, {bf_name('Hurricane')} AS beaufort_desc,
        beaufort_number >= 7 AS weather_risk_flag, visibility_m < 1000 AS low_visibility,
        CAST(least(100, CASE geopolitical_risk WHEN 'Very High' THEN 40 WHEN 'High' THEN 25
          WHEN 'Medium' THEN 10 ELSE 0 END + least(beaufort_number * 6, 60)
          + CASE WHEN visibility_m < 1000 THEN 10 WHEN visibility_m < 5000 THEN 5 ELSE 0 END) AS INT)
          AS disruption_score
      FROM (SELECT *, {BF} AS beaufort_number FROM strait_rows))""",
    "articles": """SELECT doc_id, text AS title, concat_ws(' ', lang, source) AS description,
        source AS source_name, concat('https://example.com/', doc_id) AS url,
        CASE WHEN doc_id <> 13 THEN TIMESTAMP '2024-01-01' + to_minutes(CAST(doc_id AS INT)) END
          AS pub_date FROM documents""",
    "classified": f"""SELECT *, CASE WHEN hits >= 3 THEN 'HIGH' WHEN hits >= 1 THEN 'MEDIUM'
          ELSE 'LOW' END AS risk_level,
        CAST(CASE WHEN hits >= 3 THEN least(90, 60 + hits * 5) WHEN hits >= 1 THEN 40 + hits * 8
          ELSE 10 END AS INT) AS risk_score,
        CASE WHEN found = '' THEN 'General' ELSE found END AS relevant_routes
      FROM (SELECT *, {HITS} AS hits, {NEWS_MATCH} AS found
        FROM (SELECT *, lower(concat(title, ' ', description)) AS txt FROM articles))""",
    "news": """SELECT * FROM (
        SELECT * FROM classified WHERE title NOT IN ('', '[Removed]')
        QUALIFY row_number() OVER (PARTITION BY title ORDER BY doc_id) = 1)
      WHERE pub_date IS NOT NULL""",
    # marts
    "index_year": f"""SELECT year, {r('avg(bdi_value)', 2)} AS avg_bdi, max(bdi_value) AS max_bdi,
        min(bdi_value) AS min_bdi, {r('stddev_samp(bdi_value)', 2)} AS bdi_volatility,
        count(*) FILTER (is_spike) AS spike_days, count(*) FILTER (is_drop) AS drop_days,
        count(bdi_value) AS trading_days FROM bdi_daily GROUP BY year""",
    "exports": "SELECT * FROM trade_flows WHERE flow_direction = 'Export'",
    "trade_year": f"""SELECT year, {usd('trade_value_usd')} AS export_value_usd,
        count(DISTINCT reporter_iso) AS unique_countries, count(DISTINCT hs_code) AS commodity_count,
        {r(usd('trade_value_usd') + ' / ' + T, 3)} AS export_value_trillion
      FROM exports GROUP BY year""",
    "dominant": f"""SELECT year, hs_code AS dominant_hs, {HS_CASE} AS dominant_commodity FROM (
        SELECT year, hs_code, {usd('trade_value_usd')} AS v FROM exports GROUP BY ALL)
      QUALIFY row_number() OVER (PARTITION BY year ORDER BY v DESC, hs_code) = 1""",
    "mart_bdi_trade": f"""SELECT *, {CORR.format(a='bdi_yoy_pct', b='trade_yoy_pct')}
          AS correlation_signal,
        {r('avg_bdi / nullif(export_value_trillion * 1000, 0)', 4)} AS freight_intensity
      FROM (SELECT *, {yoy('avg_bdi')} AS bdi_yoy_pct, {yoy('export_value_trillion')} AS trade_yoy_pct
        FROM index_year JOIN trade_year USING (year) LEFT JOIN dominant USING (year))""",
    "exp_country": f"""SELECT reporter_iso, {usd('trade_value_usd')} AS total_export_usd FROM exports
      GROUP BY 1""",
    "imp_country": f"""SELECT reporter_iso, {usd('trade_value_usd')} AS total_import_usd
      FROM trade_flows WHERE flow_direction = 'Import' GROUP BY 1""",
    "country_totals": f"""SELECT *, {r('total_export_usd / ' + B, 2)} AS "export_B",
        {r('total_import_usd / ' + B, 2)} AS "import_B", {r('total_trade_usd / ' + B, 2)} AS "total_B",
        CASE WHEN total_export_usd > total_import_usd THEN 'Net Exporter' ELSE 'Net Importer' END
          AS trade_position
      FROM (SELECT *, total_export_usd + total_import_usd AS total_trade_usd FROM (
        SELECT reporter_iso, coalesce(total_export_usd, 0) AS total_export_usd,
          coalesce(total_import_usd, 0) AS total_import_usd
        FROM exp_country FULL OUTER JOIN imp_country USING (reporter_iso)))""",
    "ports_now": """SELECT * FROM port_weather QUALIFY row_number() OVER (PARTITION BY port_name
        ORDER BY fetch_date DESC, fetched_at DESC, event_id DESC) = 1""",
    "straits_now": """SELECT * FROM strait_conditions QUALIFY row_number() OVER (
        PARTITION BY strait_name ORDER BY fetch_date DESC, fetched_at DESC, event_id DESC) = 1""",
    "mart_port_risk_trade": f"""SELECT *, {ALERT} AS business_alert FROM (
        SELECT *, {PRIORITY.format(t='"total_B"')} AS alert_priority FROM (
          SELECT port_name, country_iso, port_rank, temp_c, wind_speed_ms, beaufort_number,
            beaufort_desc, port_risk_flag, low_visibility, weather_main, visibility_m, humidity_pct,
            fetch_date, c.* EXCLUDE (reporter_iso)
          FROM ports_now LEFT JOIN country_totals c ON reporter_iso = country_iso))""",
    "mart_strait_monitor": f"""SELECT s.* EXCLUDE (no, fetched_at),
        {r('CAST(trade_pct_global AS DOUBLE) / 100 * 25 * 1000', 0)} AS "est_trade_through_B",
        {r('round(CAST(trade_pct_global AS DOUBLE) / 100 * 25 * 1000) / 365', 1)}
          AS "daily_trade_at_risk_B", {NOTE} AS reroute_note, {BADGE} AS combined_risk
      FROM straits_now s""",
    "mart_commodity_bdi": f"""SELECT *, {r('avg_bdi / ("export_B" + CAST(0.01 AS DOUBLE))', 4)}
          AS freight_burden_index, {SENS_CASE} AS bdi_sensitivity, {HS_CASE} AS commodity_name,
        year = (SELECT year FROM index_year ORDER BY avg_bdi, year LIMIT 1)
          AS is_cheapest_freight_year
      FROM (SELECT year, hs_code, {usd('trade_value_usd')} AS trade_value_usd,
          {r(usd('trade_value_usd') + ' / ' + B, 2)} AS "export_B" FROM exports GROUP BY 1, 2)
      JOIN (SELECT year, avg_bdi, bdi_volatility, spike_days FROM index_year) USING (year)""",
    "mart_bdi_signals": f"""SELECT *, {ADVICE} AS charter_recommendation FROM (
        SELECT date, year, bdi_value, daily_change_pct, rolling_7d_avg, rolling_30d_avg,
          rolling_90d_avg, is_spike, is_drop, {SIGNAL} AS market_signal FROM bdi_daily)""",
    "top_export": f"""SELECT reporter_iso, commodity_name AS top_export_commodity FROM (
        SELECT reporter_iso, commodity_name, {usd('trade_value_usd')} AS v FROM exports GROUP BY 1, 2)
      QUALIFY row_number() OVER (PARTITION BY reporter_iso ORDER BY v DESC, commodity_name) = 1""",
    "main_port": """SELECT country_iso, port_name, port_rank, beaufort_number, beaufort_desc,
        port_risk_flag, wind_speed_ms, weather_main, fetch_date FROM port_weather
      QUALIFY row_number() OVER (PARTITION BY country_iso
        ORDER BY port_rank, fetched_at DESC, event_id DESC) = 1""",
    "mart_net_exporter_risk": f"""SELECT b.*, {r(f'(export_usd - import_usd) / {B}', 2)}
          AS "trade_balance_B", export_usd > import_usd AS is_net_exporter, top_export_commodity,
        p.*, CASE WHEN coalesce(port_risk_flag, false) THEN 'Port disruption active'
          WHEN coalesce(beaufort_number, 0) >= 5 THEN 'Moderate conditions'
          ELSE 'Normal operations' END AS weather_impact
      FROM (SELECT reporter_iso, reporter_country, coalesce(export_usd, 0) AS export_usd,
          coalesce(total_import_usd, 0) AS import_usd
        FROM (SELECT reporter_iso, reporter_country, {usd('trade_value_usd')} AS export_usd
          FROM exports GROUP BY 1, 2) FULL OUTER JOIN imp_country USING (reporter_iso)) b
      LEFT JOIN top_export USING (reporter_iso) LEFT JOIN main_port p ON country_iso = reporter_iso""",
    "months": f"""SELECT month, {r('avg(bdi_value)', 1)} AS avg_bdi, {r('min(bdi_value)', 1)} AS min_bdi,
        {r('max(bdi_value)', 1)} AS max_bdi, {r('stddev_samp(bdi_value)', 1)} AS std_bdi,
        count(*) AS count_obs FROM bdi_daily GROUP BY month""",
    "mart_seasonal_freight": f"""SELECT m.*, {MONTHS} AS month_name,
        CASE WHEN avg_bdi > hi THEN 'Expensive (high demand)' WHEN avg_bdi < lo
          THEN 'Cheap (low demand)' ELSE 'Moderate' END AS freight_level,
        CASE WHEN month IN (9, 10, 11) THEN 'Book ahead — pre-holiday restocking demand'
          WHEN month IN (2, 3) THEN 'Cheapest window — post-Chinese-New-Year lull'
          ELSE 'Moderate — check spot rates' END AS booking_advice
      FROM months m, (SELECT quantile_cont(avg_bdi, 0.33) AS lo, quantile_cont(avg_bdi, 0.67) AS hi
        FROM months)""",
    "mart_china_concentration": f"""SELECT c.*, risk AS china_port_risk_today,
        bf AS china_max_beaufort, (SELECT bdi_value FROM bdi_daily ORDER BY date DESC LIMIT 1)
          AS current_bdi, {CONC.format(s='china_share_pct')} AS supply_concentration,
        {r(f'china_export_usd / {B} * (CAST(bf AS DOUBLE) / 12)', 2)} AS "disruption_exposure_B"
      FROM (SELECT *, {HS_CASE} AS commodity_name,
          {r('china_export_usd / nullif(world_export_usd, 0) * 100', 1)} AS china_share_pct
        FROM (SELECT year, hs_code, {usd('trade_value_usd')} AS world_export_usd,
          coalesce({usd(f"CASE WHEN reporter_iso = {q(FOCUS_COUNTRY)} THEN trade_value_usd END")}, 0)
            AS china_export_usd FROM exports GROUP BY 1, 2)) c,
      (SELECT coalesce(bool_or(port_risk_flag), false) AS risk, coalesce(max(beaufort_number), 0) AS bf
        FROM port_weather WHERE country_iso = {q(FOCUS_COUNTRY)})""",
    "named_vessels": """SELECT v.* EXCLUDE (port_guess), p.port_name AS port_guess FROM vessels v
      JOIN (SELECT DISTINCT port_name, port_rank - 1 AS no FROM port_rows) p ON p.no = v.mmsi""",
    "mart_vessel_port_risk": f"""SELECT port_name, event_id, vessels AS vessel_count, tanker_count,
        cargo_count, moving_count, avg_speed_knots, beaufort_number, visibility_m,
        {CONGEST.format(v='vessels')} AS congestion_weather_risk, fetched_at
      FROM port_weather JOIN ({counts('port_guess', 'named_vessels')}) d ON d.port_guess = port_name""",
    "route_dim": rows(dims.ROUTE_DEFINITIONS,
                      "route, origin_ports, dest_ports, strait, alt_strait, hs_codes, route_notes"),
    "risky": "SELECT list(port_name) AS names FROM ports_now WHERE port_risk_flag",
    "mart_route_disruption": f"""SELECT route, coalesce(strait, 'None') AS strait,
        coalesce(disruption_score, 0) AS strait_disruption_score,
        coalesce(risk_level, 'Unknown') AS strait_risk_level,
        coalesce(geopolitical_risk, 'Unknown') AS geopolitical_risk,
        coalesce(beaufort_number, 0) AS strait_beaufort,
        CASE WHEN len(o) = 0 THEN 'None' ELSE array_to_string(o, ', ') END AS origin_ports_at_risk,
        CASE WHEN len(d) = 0 THEN 'None' ELSE array_to_string(d, ', ') END AS dest_ports_at_risk,
        CASE WHEN risk_level IN ('Critical', 'High') OR geopolitical_risk = 'Very High'
            THEN '🔴 DISRUPTED' WHEN risk_level = 'Moderate' OR len(o) > 0 OR len(d) > 0
            THEN '🟡 WATCH' WHEN risk_level = 'Normal' OR risk_level IS NULL THEN '🟢 CLEAR'
            ELSE '⚪ UNKNOWN' END AS overall_status,
        array_to_string([{HS_CASE} for hs_code in hs_codes], ', ') AS commodities_affected,
        route_notes, coalesce(alt_strait, 'None') AS alt_route
      FROM (SELECT r.*, list_filter(origin_ports, lambda p: list_contains(names, p)) AS o,
          list_filter(dest_ports, lambda p: list_contains(names, p)) AS d FROM route_dim r, risky) r
      LEFT JOIN straits_now s ON s.strait_name = r.strait""",
    "mart_strait_vessel_trend": f"""SELECT fetch_date, port_guess AS strait_name,
        vessels AS total_vessels, tanker_count, cargo_count, moving_count, avg_speed_knots,
        {r('CAST(moving_count AS DOUBLE) / greatest(vessels, 1) * 100', 1)} AS pct_moving
      FROM ({counts('fetch_date, port_guess', '(SELECT * FROM vessels_daily WHERE is_strait)')})""",
    "routed": f"SELECT *, {ROUTE_CASE} AS route FROM vessels_daily",
    "all_routed": f"SELECT *, {ROUTE_CASE} AS route FROM vessels",
    "route_daily": """SELECT route, fetch_date, count(DISTINCT mmsi) AS daily_vessels,
        avg(sog_knots) AS avg_speed, count(*) FILTER (vessel_category = 'Tanker') AS tanker_count,
        count(*) FILTER (vessel_category = 'Cargo') AS cargo_count FROM routed GROUP BY ALL""",
    "cfg": rows([(c[0], c[2], c[3], c[6], c[7], c[10]) for c in dims.ROUTE_CONFIG],
                "route_name, points, alternative_route, extra_days_if_disrupted, "
                "extra_cost_per_voyage_usd, ports"),
    "routes": rows([(x,) for x in dims.ROUTES], "route"),
    "route_baselines": f"""SELECT route, coalesce({r('avg(daily_vessels)', 1)}, 0)
          AS baseline_avg_vessels, coalesce({r('avg(avg_speed)', 2)}, 0) AS baseline_avg_speed,
        count(fetch_date) AS days_of_history FROM routes LEFT JOIN route_daily USING (route)
      GROUP BY route""",
    "baselines_past": f"""SELECT route, coalesce({r('avg(daily_vessels)', 1)}, 0)
          AS baseline_avg_vessels, coalesce({r('avg(avg_speed)', 2)}, 0) AS baseline_avg_speed
      FROM routes LEFT JOIN (SELECT * FROM route_daily WHERE fetch_date <
        (SELECT max(fetch_date) FROM vessels_daily)) USING (route) GROUP BY route""",
    "route_today": """SELECT route, count(DISTINCT mmsi) AS cv, avg(sog_knots) AS cs,
        count(*) FILTER (vessel_category = 'Tanker') AS ct FROM routed
      WHERE fetch_date = (SELECT max(fetch_date) FROM vessels_daily) GROUP BY route""",
}


def current(baseline: str, news_match: str, cap: bool) -> str:
    impact = r("greatest(0, tg * CAST(-0.4 AS DOUBLE)) + greatest(0, sg * -5) "
               "+ fp * CAST(0.3 AS DOUBLE) + nr * CAST(0.3 AS DOUBLE)", 1)
    if cap:
        impact = f"greatest(0, least(100, {impact}))"
    return f"""SELECT *, CASE WHEN route_impact_score >= 60 THEN 'CRITICAL' WHEN route_impact_score >= 30
        THEN 'ELEVATED' ELSE 'NORMAL' END AS status
      FROM (SELECT (SELECT max(fetch_date) FROM vessels_daily) AS event_date, route,
        cv AS current_vessels, {r('cs', 2)} AS current_avg_speed, ct AS current_tankers,
        baseline_avg_vessels, baseline_avg_speed, {r('tg', 1)} AS traffic_vs_history_pct,
        {r('sg', 2)} AS speed_gap_knots, {r('fp', 2)} AS fuel_pressure_score, fuel_signal,
        {r('nr', 1)} AS news_risk_score, nc AS news_article_count, {impact} AS route_impact_score
      FROM (SELECT *, (cv - baseline_avg_vessels) / greatest(baseline_avg_vessels, 1) * 100 AS tg,
          cs - baseline_avg_speed AS sg FROM (
        SELECT b.*, coalesce(cv, 0) AS cv, coalesce(cs, 0) AS cs, coalesce(ct, 0) AS ct,
          f.fuel_pressure_score AS fp, f.fuel_signal,
          CAST(coalesce((SELECT max(risk_score) FROM news n WHERE {news_match}), 0) AS DOUBLE) AS nr,
          (SELECT count(*) FROM news n WHERE {news_match}) AS nc
        FROM {baseline} b LEFT JOIN route_today USING (route),
          (SELECT * FROM fuel ORDER BY date DESC LIMIT 1) f)))"""


FIRST_WORD = "contains(lower(n.relevant_routes), lower(split_part(b.route, ' ', 1)))"
WHOLE = "list_contains(string_split(n.relevant_routes, ', '), b.route)"
TABLES["current_vs_historical"] = current("route_baselines", FIRST_WORD, False)
TABLES["deviations"] = """SELECT *, true AS deviation_flag FROM (SELECT *,
    CASE WHEN traffic_vs_history_pct < -20 THEN 'Traffic drop' WHEN speed_gap_knots < -2
      THEN 'Speed drop' WHEN news_risk_score >= 70 THEN 'News risk' WHEN fuel_pressure_score > 10
      THEN 'Fuel spike' END AS deviation_reason FROM current_vs_historical)
  WHERE deviation_reason IS NOT NULL"""


def with_tables(sql: str) -> str:
    """Prefix the subqueries that a text needs, in dependency order."""
    order: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name, body in TABLES.items():
            if name not in seen and re.search(rf"(?<![\w.'\"]){name}(?![\w'\"])", text):
                seen.add(name)
                visit(body)
                order.append(name)

    visit(sql)
    if not order:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({TABLES[n]})" for n in order) + "\n" + sql


def oracle_sql() -> dict[str, str]:
    from .oracle_io import QUERIES_IO
    from .oracle_queries import QUERIES
    from .oracle_rules import QUERIES_RULES
    texts = QUERIES | QUERIES_IO | QUERIES_RULES
    return {name: with_tables(sql) for name, sql in texts.items()}

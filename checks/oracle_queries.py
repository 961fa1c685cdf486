"""SQL text per query name (see ``oracle.TABLES`` for the named subqueries)."""

from __future__ import annotations

from tradelane import dims
from tradelane.functions.weather import _BANDS

from .fixed import GEO_ORDER, NEWS_WORDS, ROUTE_WORDS
from .oracle import (ALERT, B, BADGE, CONC, CONGEST, CORR, FIRST_WORD, HS_CASE, NOTE, PRIORITY,
                     ROUTE_CASE, SENS_CASE, SPEED, T, TABLES, TS, WHOLE, bf_name, case, counts, current, q,
                     r, usd, yoy)

D = "CAST({} AS VARCHAR)"
ID3 = "l_orderkey, l_linenumber, l_partkey"


def day(column: str) -> str:
    return f"CAST({column} AS VARCHAR) AS {column}"


def stamp(column: str) -> str:
    return f"strftime({column}, '{TS}') AS {column}"


def nulls(columns) -> str:
    parts = [f"""SELECT '{c}' AS column_name, count(*) FILTER ("{c}" IS NULL) AS nulls,
      {r(f'CAST(count(*) FILTER ("{c}" IS NULL) AS DOUBLE) / count(*) * 100', 1)} AS null_pct
      FROM trade_raw""" for c in columns]
    return " UNION ALL ".join(parts)


def stats(columns) -> str:
    parts = [f"""SELECT '{c}' AS column_name, count({c}) AS count, {r(f'avg({c})', 2)} AS mean,
      {r(f'stddev_samp({c})', 2)} AS std, {r(f'min({c})', 2)} AS min,
      {r(f'quantile_cont({c}, 0.25)', 2)} AS q25, {r(f'quantile_cont({c}, 0.5)', 2)} AS q50,
      {r(f'quantile_cont({c}, 0.75)', 2)} AS q75, {r(f'max({c})', 2)} AS max
      FROM trade_rows""" for c in columns]
    return " UNION ALL ".join(parts)


def hist(source: str, column: str, bins: int) -> str:
    return f"""SELECT bin, {r(f'lo + bin * ((hi - lo) / {bins})', 6)} AS bin_start,
      coalesce(n, 0) AS count
    FROM range({bins}) g(bin), (SELECT min({column}) AS lo, max({column}) AS hi FROM {source})
    LEFT JOIN (SELECT least(CAST(floor(({column} - lo) / ((hi - lo) / {bins})) AS BIGINT), {bins - 1})
        AS b, count(*) AS n
      FROM {source}, (SELECT min({column}) AS lo, max({column}) AS hi FROM {source})
      WHERE {column} IS NOT NULL GROUP BY 1) ON b = bin"""


def pivot(source: str, value: str) -> str:
    cells = ", ".join(f"""{r(f"avg(CASE WHEN commodity_name = {q(n)} THEN {value} END)", 4)}
      AS "{n}" """ for n in (*dims.HS_NAMES.values(), "Other"))
    return f"SELECT year, {cells} FROM {source} GROUP BY year"


RAW_RENAMED = """"typeCode", "freqCode", "reporterISO" AS reporter_iso, "reporterDesc" AS reporter_country,
  "partnerISO" AS partner_iso, "cmdCode" AS hs_code, "flowDesc" AS flow_direction, "refYear" AS year,
  "primaryValue" AS trade_value_usd, "netWgt" AS net_weight_kg, "motDesc" AS transport_mode,
  qty AS quantity, "isNetWgtEstimated" AS weight_estimated, "qtyUnitAbbr" AS qty_unit,
  l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate"""
RAW_COLUMNS = ["typeCode", "freqCode", "reporterISO", "reporterDesc", "partnerISO", "cmdCode",
               "flowDesc", "refYear", "primaryValue", "netWgt", "motDesc", "qty",
               "isNetWgtEstimated", "qtyUnitAbbr", "l_orderkey", "l_linenumber", "l_partkey",
               "l_suppkey", "l_shipdate"]
FLOW_TITLE = ("CASE WHEN l_linenumber = 5 THEN 'Re-Export' ELSE "
              "concat(upper(substr(\"flowDesc\", 1, 1)), substr(\"flowDesc\", 2)) END")
GUSTY = """(SELECT *, CASE WHEN event_id % 3 <> 0 THEN wind_speed_ms * CAST(1.5 AS DOUBLE) END AS gust,
  CASE WHEN event_id % 3 <> 0 THEN visibility_m END AS vis FROM port_weather)"""
CODED = """(SELECT * EXCLUDE (vessel_type, sog_knots), CASE WHEN (event_id * 7) % 101 <> 100
    THEN CAST((event_id * 7) % 101 AS INT) END AS vessel_type,
  CASE WHEN event_id % 11 <> 0 THEN sog_knots END AS sog_knots FROM vessel_rows)"""
TYPE_NAME = ("coalesce(" + case([(f"vessel_type = {k}", q(v))
                                 for k, v in dims.VESSEL_TYPE_NAMES.items()])
             + ", concat('Type ', CAST(vessel_type AS VARCHAR)))")
TYPE_NAME = f"CASE WHEN vessel_type IS NULL THEN 'Unknown' ELSE {TYPE_NAME} END"
BY_NAME = case([(f"contains(lower(vessel_type_name), {q(w)})", q(c))
                for w, c in dims.VESSEL_NAME_WORDS], "'Other'")
NAV_CAPTURE = case([(f"navigational_status = {k}", q(v))
                    for k, v in dims.NAV_STATUS_CAPTURE.items()],
                   "concat('Status ', CAST(navigational_status AS VARCHAR))")
NAV_DAILY = case([(f"navigational_status = {k}", q(v)) for k, v in dims.NAV_STATUS_DAILY.items()],
                 "'Unknown'")
BY_CODE = ("CASE WHEN vessel_type IS NULL OR vessel_type = 0 THEN 'Unknown' WHEN vessel_type // 10 = 7 "
           "THEN 'Cargo' WHEN vessel_type // 10 = 8 THEN 'Tanker' WHEN vessel_type // 10 = 6 THEN "
           "'Passenger' WHEN vessel_type BETWEEN 30 AND 35 THEN 'Fishing' WHEN vessel_type // 10 = 5 "
           "THEN 'Tug / Support' ELSE 'Other' END")
STATIC = """(SELECT event_id AS message_id, user_id AS mmsi, ts, event_type = 'signup' AS st,
    CAST(props->>'$.k' AS INT) AS k, value FROM events)"""
MSG = f"""(SELECT *, last_value(CASE WHEN st THEN message_id END IGNORE NULLS) OVER (PARTITION BY mmsi
    ORDER BY ts, message_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM {STATIC})"""
AT_RISK_VIEW = """(SELECT * FROM mart_port_risk_trade WHERE country_iso = 'N07')"""
RECENT = "(SELECT * FROM mart_bdi_signals ORDER BY date DESC LIMIT 30)"
LAST = "(SELECT * FROM mart_bdi_signals ORDER BY date DESC LIMIT 1)"
LAST_FUEL = "(SELECT * FROM fuel ORDER BY date DESC LIMIT 1)"
COUNTRY_YOY = """(SELECT *, lag(trade_value_usd) OVER (PARTITION BY reporter_iso, partner_iso,
    flow_direction, hs_code ORDER BY year) AS old FROM trade_unique)"""
CARD = _BANDS["route"]
BALANCE = (f"coalesce({usd(chr(39).join(['CASE WHEN flow_direction = ', 'Export', ' THEN trade_value_usd END']))}, 0)"
           f" - coalesce({usd(chr(39).join(['CASE WHEN flow_direction = ', 'Import', ' THEN trade_value_usd END']))}, 0)")
EXP = f"coalesce({usd(chr(39).join(['CASE WHEN flow_direction = ', 'Export', ' THEN trade_value_usd END']))}, 0)"
IMP = f"coalesce({usd(chr(39).join(['CASE WHEN flow_direction = ', 'Import', ' THEN trade_value_usd END']))}, 0)"
TABLES["by_country"] = f"""SELECT reporter_country, {r(f'({BALANCE}) / {T}', 4)} AS "balance_T"
  FROM trade_flows GROUP BY 1"""
BALANCE_VIEW = f"""SELECT reporter_country, reporter_iso, hs_code, commodity_name AS commodity, year,
  {r(f'{EXP} / {B}', 2)} AS "exports_B", {r(f'{IMP} / {B}', 2)} AS "imports_B",
  {r(f'({BALANCE}) / {B}', 2)} AS balance,
  CASE WHEN {EXP} > {IMP} THEN 'Net Exporter' ELSE 'Net Importer' END AS trade_position
  FROM trade_flows GROUP BY ALL"""
VALUE_COUNT = "count(*) AS count"

QUERIES = {
    # cleaning
    "drop_columns": "SELECT * EXCLUDE (\"typeCode\", \"freqCode\") FROM trade_raw",
    "rename_columns": f"SELECT {RAW_RENAMED} FROM trade_raw",
    "drop_all_null_columns": "SELECT * EXCLUDE (\"qtyUnitAbbr\") FROM trade_raw",
    "drop_null_required": f"""SELECT {ID3}, "primaryValue" FROM trade_raw
      WHERE "primaryValue" IS NOT NULL""",
    "fill_constant": f"""SELECT {ID3}, coalesce("netWgt", 0) AS net_weight_kg,
      coalesce(qty, 0) AS quantity, coalesce("motDesc", 'Not specified') AS transport_mode,
      coalesce("isNetWgtEstimated", true) AS weight_estimated FROM trade_raw""",
    "fill_from_column": f"""SELECT event_id, wind_speed_ms,
      coalesce(gust, wind_speed_ms) AS wind_gust_ms FROM {GUSTY}""",
    "clean_weather": f"""SELECT event_id, port_name, coalesce(gust, wind_speed_ms) AS wind_gust_ms,
      coalesce(vis, 10000) AS visibility_m,
      CASE WHEN event_id % 3 <> 0 THEN CAST(0.25 AS DOUBLE) ELSE 0 END AS rain_1h_mm,
      CAST(0 AS DOUBLE) AS snow_1h_mm, beaufort_number, beaufort_desc, port_risk_flag,
      coalesce(vis, 10000) < 1000 AS low_visibility, {day('fetch_date')},
      CAST(year(fetch_date) AS INT) AS fetch_year, CAST(month(fetch_date) AS INT) AS fetch_month,
      'openweathermap' AS source, 'port_weather' AS data_type, 'daily' AS granularity FROM {GUSTY}""",
    "zero_to_null": """SELECT coalesce(strftime(date, '%m/%d/%Y'), '13/45/2020') AS date,
      open AS bdi_open, high AS bdi_high, CAST(NULL AS DOUBLE) AS bdi_low FROM index_raw""",
    "parse_numeric_text": """SELECT coalesce(strftime(date, '%m/%d/%Y'), '13/45/2020') AS date,
      price AS bdi_value, volume AS bdi_volume, change AS bdi_change_pct FROM index_raw""",
    "parse_date_text": f"SELECT {day('date')} FROM index_raw WHERE date IS NOT NULL",
    "clean_index": f"""SELECT {day('date')}, price AS bdi_value, open AS bdi_open, high AS bdi_high,
      CAST(NULL AS DOUBLE) AS bdi_low, coalesce(volume, 0) AS bdi_volume, change AS bdi_change_pct
      FROM index_raw WHERE date IS NOT NULL AND price IS NOT NULL""",
    "dedupe_first": """SELECT reporter_iso, partner_iso, hs_code, flow_direction, year,
      trade_value_usd, l_orderkey FROM trade_unique""",
    "dedupe_exact": "SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem",
    "src_route_config": """SELECT route_name, strait_name, readings, worst_score
      FROM (SELECT route_name, unnest(points) AS strait_name FROM cfg)
      LEFT JOIN (SELECT strait_name, count(*) AS readings, max(disruption_score) AS worst_score
        FROM strait_conditions GROUP BY 1) USING (strait_name)""",
    "dedupe_latest": f"""SELECT mmsi, {day('fetch_date')}, event_id, sog_knots, port_guess
      FROM vessels_daily""",
    "latest_snapshot": f"""SELECT port_name, event_id, {day('fetch_date')}, wind_speed_ms
      FROM port_rows WHERE fetch_date = (SELECT max(fetch_date) FROM port_rows)""",
    "standardize_text": f"""SELECT {ID3}, upper(trim("reporterISO")) AS reporter_iso,
      'W00' AS partner_iso, trim("reporterDesc") AS reporter_country,
      {FLOW_TITLE} AS flow_direction FROM trade_raw""",
    "coerce_numeric": f"""SELECT {ID3}, TRY_CAST("cmdCode" AS INT) AS hs_code,
      CAST("refYear" AS INT) AS year FROM trade_raw""",
    "clean_trade": f"""SELECT reporter_iso, partner_iso, hs_code, flow_direction, year, trade_value_usd,
      w AS net_weight_kg, transport_mode, quantity, weight_estimated,
      CASE WHEN w > 0 THEN {r('trade_value_usd / w', 4)} END AS value_per_kg,
      CAST(year // 10 * 10 AS INT) AS decade,
      {r('trade_value_usd / CAST(1e12 AS DOUBLE)', 4)} AS trade_value_trillion,
      'un_comtrade' AS source, 'trade_flow' AS data_type, 'annual' AS granularity
      FROM (SELECT upper(trim("reporterISO")) AS reporter_iso, 'W00' AS partner_iso,
        TRY_CAST("cmdCode" AS INT) AS hs_code, {FLOW_TITLE} AS flow_direction,
        CAST("refYear" AS INT) AS year, "primaryValue" AS trade_value_usd,
        coalesce("netWgt", 0) AS w, coalesce("motDesc", 'Not specified') AS transport_mode,
        coalesce(qty, 0) AS quantity, coalesce("isNetWgtEstimated", true) AS weight_estimated,
        l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate
        FROM trade_raw WHERE "primaryValue" IS NOT NULL)
      QUALIFY row_number() OVER (PARTITION BY reporter_iso, partner_iso, hs_code, flow_direction, year
        ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, trade_value_usd) = 1""",
    "null_out_of_range": """SELECT event_id, CASE WHEN latitude * 2 BETWEEN -90 AND 90
      THEN latitude * 2 END AS latitude, CASE WHEN longitude * 2 BETWEEN -180 AND 180
      THEN longitude * 2 END AS longitude FROM vessel_rows""",
    "filter_hs": "SELECT hs_code, count(*) AS n FROM trade_rows WHERE hs_code <> 99 GROUP BY 1",
    "flag_outlier_grouped": f"""SELECT {ID3}, hs_code, trade_value_usd FROM trade_rows
      QUALIFY abs(trade_value_usd - avg(trade_value_usd) OVER (PARTITION BY hs_code))
        > 1.5 * stddev_samp(trade_value_usd) OVER (PARTITION BY hs_code)""",
    "flag_outlier_global": f"""SELECT {day('date')},
      abs(bdi_value - avg(bdi_value) OVER ()) > 2 * stddev_samp(bdi_value) OVER () AS is_outlier
      FROM index_daily""",
    "add_trade_balance": f"""SELECT {ID3}, flow_direction, trade_balance_usd FROM trade_rows
      JOIN (SELECT reporter_iso, partner_iso, hs_code, year, {r(BALANCE, 2)} AS trade_balance_usd
        FROM trade_rows GROUP BY ALL) USING (reporter_iso, partner_iso, hs_code, year)""",
    "safe_ratio": f"""SELECT {ID3}, {r('trade_value_usd / net_weight_kg', 4)} AS value_per_kg
      FROM trade_rows""",
    "decade_bucket": "SELECT CAST(year // 10 * 10 AS INT) AS decade, count(*) AS n FROM trade_rows GROUP BY 1",
    "date_parts": """SELECT event_id, CAST(year(event_time_utc) AS INT) AS year,
      CAST(month(event_time_utc) AS INT) AS month, CAST(quarter(event_time_utc) AS INT) AS quarter,
      CAST(day(event_time_utc) AS INT) AS day, CAST(hour(event_time_utc) AS INT) AS hour,
      dayname(event_time_utc) AS weekday FROM vessel_rows""",
    "tag_source": f"""SELECT {day('date')}, 'EIA_RBRTE_API' AS source, 'fuel_price' AS data_type,
      'daily' AS granularity, '2026-01-31' AS fetch_date FROM fuel_raw""",
    "scale_unit": f"""SELECT {ID3}, {r('trade_value_usd / CAST(1e4 AS DOUBLE)', 4)}
      AS trade_value_trillion FROM trade_rows""",
    "yoy_growth": f"""SELECT reporter_iso, hs_code, flow_direction, year,
      {r('(trade_value_usd - old) / nullif(old, 0) * 100', 2)} AS yoy_growth_pct
      FROM {COUNTRY_YOY}""",
    "yoy_growth_mixed": f"""SELECT reporter_iso, hs_code, flow_direction, year,
      {r('(trade_value_usd - old) / nullif(old, 0) * 100', 2)} AS yoy_growth_pct
      FROM (SELECT *, lag(trade_value_usd) OVER (PARTITION BY reporter_iso, partner_iso,
        flow_direction ORDER BY year, hs_code) AS old FROM trade_unique)""",
    "map_code": f"""SELECT hs_code, {HS_CASE} AS label, {SENS_CASE} AS sensitivity, count(*) AS n
      FROM trade_rows GROUP BY ALL""",
    "decode_vessels_daily": f"""SELECT event_id, vessel_type,
      CASE WHEN coalesce(vessel_type, 0) = 0 THEN 'Unknown' ELSE CAST(vessel_type AS VARCHAR) END
        AS vessel_type_name, {BY_CODE} AS vessel_category, {SPEED.format(0.5, 3, 10)} AS speed_category,
      {NAV_DAILY} AS nav_status_name, coalesce(sog_knots, 0) >= 0.5 AS is_moving FROM {CODED}""",
    "decode_vessels_capture": f"""SELECT *, {BY_NAME} AS vessel_category FROM (
      SELECT event_id, vessel_type, {TYPE_NAME} AS vessel_type_name,
        {SPEED.format(0.3, 3, 12)} AS speed_category, {NAV_CAPTURE} AS nav_status_name,
        coalesce(sog_knots, 0) > 0.3 AS is_moving FROM {CODED})""",
    "beaufort": f"""SELECT event_id, wind_speed_ms, visibility_m, beaufort_number,
      {bf_name('Hurricane force')} AS beaufort_desc, port_risk_flag, low_visibility
      FROM port_weather""",
    "unix_to_hhmm": """SELECT event_id, CASE WHEN event_id % 9 <> 0 AND (event_id * 977) % 900000 <> 0
      THEN strftime(make_timestamp(((event_id * 977) % 900000) * 1000000), '%H:%M') END AS hhmm,
      strftime(event_time_utc, '%H:%M') AS clock FROM vessel_rows""",
    "clean_news": f"""SELECT doc_id, title, description, source_name, url, {stamp('pub_date')},
      risk_level, risk_score, relevant_routes FROM news""",
    "classify_news": """SELECT doc_id, hits AS risk_hits, risk_level, risk_score, relevant_routes
      FROM classified""",
    "classify_news_lists": f"""SELECT doc_id, {' + '.join(f"CAST(contains(txt, {q(w)}) AS INT)" for w in NEWS_WORDS)}
        AS risk_hits, coalesce(nullif(concat_ws(', ', {', '.join(
          f"CASE WHEN {' OR '.join(f'contains(txt, {q(w)})' for w in words)} THEN {q(route)} END"
          for route, words in ROUTE_WORDS)}), ''), 'General') AS relevant_routes
      FROM (SELECT doc_id, lower(concat(title, ' ', description)) AS txt FROM articles)""",
    "classify_news_terms": """SELECT * FROM (WITH t AS (SELECT DISTINCT lower(w) AS term FROM (
        SELECT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS w FROM benchmark)),
      txt AS (SELECT doc_id, lower(concat(title, ' ', description)) AS txt FROM articles),
      hit AS (SELECT doc_id, term FROM txt, t WHERE length(term) >= 5 AND contains(txt, term)),
      n AS (SELECT doc_id, CAST(count(*) AS INT) AS hits FROM hit WHERE length(term) >= 6 GROUP BY doc_id),
      ro AS (SELECT doc_id, string_agg(route, ', ' ORDER BY route) AS routes FROM (
        SELECT DISTINCT doc_id, concat('Route ', ascii(term) % 3) AS route FROM hit WHERE length(term) = 5) GROUP BY doc_id)
      SELECT doc_id, coalesce(hits, 0) AS risk_hits, coalesce(routes, 'General') AS relevant_routes
      FROM txt LEFT JOIN n USING (doc_id) LEFT JOIN ro USING (doc_id))""",
    "union_sources": f"""SELECT * REPLACE (CAST(date AS VARCHAR) AS date),
      row_number() OVER (ORDER BY source, date NULLS LAST, row_key) AS row_id FROM (
      SELECT 'un_comtrade' AS source, make_date(year, 1, 1) AS date,
        CAST(substr(reporter_iso, 2, 2) AS BIGINT) * 1000 + hs_code * 2
          + CASE WHEN flow_direction = 'Export' THEN 1 ELSE 0 END AS row_key,
        reporter_iso, trade_value_usd, CAST(NULL AS DOUBLE) AS bdi_value,
        CAST(NULL AS VARCHAR) AS port_name, CAST(NULL AS DOUBLE) AS wind_speed_ms,
        CAST(NULL AS BIGINT) AS mmsi, CAST(NULL AS DOUBLE) AS sog_knots FROM trade_unique
      UNION ALL BY NAME SELECT 'investing_bdi_csv' AS source, date, 0 AS row_key, bdi_value
        FROM index_daily
      UNION ALL BY NAME SELECT 'unknown' AS source, fetch_date AS date, event_id AS row_key, port_name,
        wind_speed_ms FROM port_rows
      UNION ALL BY NAME SELECT 'aisstream' AS source, CASE WHEN event_id % 50 <> 0 THEN fetch_date END
        AS date, event_id AS row_key, mmsi, sog_knots FROM vessel_rows)""",
    "validate": """SELECT 'null_value' AS rule, count(*) FILTER (trade_value_usd IS NULL) AS failures
        FROM trade_rows
      UNION ALL SELECT 'null_reporter', count(*) FILTER (reporter_iso IS NULL) FROM trade_rows
      UNION ALL SELECT 'negative_value', count(*) FILTER (trade_value_usd < 0) FROM trade_rows
      UNION ALL SELECT 'null_weight', count(*) FILTER (net_weight_kg IS NULL) FROM trade_rows
      UNION ALL SELECT 'duplicate_key', (SELECT count(*) FROM trade_rows)
        - (SELECT count(*) FROM trade_unique)""",
    "null_profile": nulls(RAW_COLUMNS),
    "describe_stats": stats(["trade_value_usd", "net_weight_kg"]),
    "quality_report": f"""SELECT (SELECT count(*) FROM trade_rows) AS rows_before,
      (SELECT count(*) FROM trade_rows WHERE net_weight_kg IS NULL) AS nulls_before,
      count(*) AS rows_after, count(*) FILTER (net_weight_kg IS NULL) AS nulls_after,
      count(*) FILTER (far) AS outliers,
      array_to_string(list_sort(list(DISTINCT year)), ', ') AS years,
      count(DISTINCT reporter_iso) AS reporters,
      array_to_string(list_sort(list(DISTINCT hs_code)), ', ') AS hs_codes,
      min(trade_value_usd) AS min_value, max(trade_value_usd) AS max_value,
      {r('avg(trade_value_usd)', 2)} AS mean_value,
      (SELECT count(*) FROM trade_rows) - count(*) AS rows_removed,
      {r('quantile_cont(trade_value_usd, 0.5)', 2)} AS median_value
      FROM (SELECT *, coalesce(abs(trade_value_usd - avg(trade_value_usd) OVER w)
        > 1.5 * stddev_samp(trade_value_usd) OVER w, false) AS far FROM trade_unique
        WINDOW w AS (PARTITION BY hs_code))""",
    "rolling_bucketed": f"""SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS position,
      {r('avg(value) OVER (ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 4)} AS mean_7,
      lag(value) OVER (ORDER BY ts, event_id) AS previous FROM events""",
    # places and rules
    "locate_bbox": "SELECT event_id, port_guess FROM vessels",
    "locate_grid": """SELECT event_id, coalesce(min_by(s_name, s_suppkey), 'Unknown') AS port_guess
      FROM vessel_rows LEFT JOIN (SELECT s_suppkey, s_name,
          CAST((s_suppkey * 53) % 6500 AS DOUBLE) / 100 - 10 AS a,
          CAST((s_suppkey * 277) % 27000 AS DOUBLE) / 100 - 125 AS b FROM supplier)
        ON latitude BETWEEN a AND a + 12 AND longitude BETWEEN b AND b + 20 GROUP BY event_id""",
    "is_strait": "SELECT is_strait, port_guess, count(*) AS n FROM vessels GROUP BY ALL",
    "map_route": f"SELECT port_guess, {ROUTE_CASE} AS route, count(*) AS n FROM vessels GROUP BY ALL",
    "strait_disruption": f"""SELECT event_id, strait_name, beaufort_number, visibility_m,
      disruption_score, risk_level, CASE WHEN disruption_score >= 60 THEN {q(CARD[0])}
        WHEN disruption_score >= 40 THEN {q(CARD[1])} WHEN disruption_score >= 20 THEN {q(CARD[2])}
        ELSE {q(CARD[3])} END AS band, {BADGE} AS combined_risk, {NOTE} AS reroute_note
      FROM strait_conditions""",
    "enrich_index": f"SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM bdi_daily",
    "enrich_fuel": f"SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM fuel",
    "market_signal": f"""SELECT {day('date')}, market_signal, charter_recommendation
      FROM mart_bdi_signals""",
    "congestion_risk": f"""SELECT event_id, {CONGEST.format(v='(event_id % 70)')} AS risk
      FROM port_weather""",
    "port_alert": f"""SELECT event_id, alert_priority, {ALERT} AS business_alert FROM (
      SELECT *, {PRIORITY.format(t='(event_id % 700)')} AS alert_priority FROM port_weather)""",
    "correlation_signal": f"""SELECT {day('date')}, {CORR.format(a='(m / 5)', b='(o / 5)')}
      AS correlation_signal FROM (SELECT date, daily_change_pct AS m,
        lag(daily_change_pct) OVER (ORDER BY date) AS o FROM bdi_daily)""",
    "supply_concentration": f"""SELECT event_id, {CONC.format(s='((event_id * 13) % 100)')} AS level
      FROM vessel_rows""",
    "enrich_static": f"""SELECT m.message_id, m.mmsi, m.value / 10 AS sog_knots,
      concat('SHIP ', s.k) AS ship_name, s.message_id + 9000000 AS imo, concat('C', s.k) AS call_sign,
      concat('PORT ', s.k % 9) AS destination, s.k AS vessel_type
      FROM {MSG} m JOIN {STATIC} s ON s.message_id = m.sid WHERE NOT m.st
      UNION ALL SELECT message_id, mmsi, value / 10, NULL, NULL, NULL, NULL, NULL
      FROM {MSG} WHERE NOT st AND sid IS NULL""",
    # routes
    "route_daily": f"""SELECT * REPLACE ({r('avg_speed', 6)} AS avg_speed,
      CAST(fetch_date AS VARCHAR) AS fetch_date) FROM route_daily""",
    "route_baselines": "SELECT * FROM route_baselines",
    "current_vs_historical": """SELECT * REPLACE (CAST(event_date AS VARCHAR) AS event_date)
      FROM current_vs_historical""",
    "current_vs_historical_exact": f"""SELECT * REPLACE (CAST(event_date AS VARCHAR) AS event_date)
      FROM ({current('baselines_past', WHOLE, True)})""",
    "route_deviation_alerts": """SELECT * REPLACE (CAST(event_date AS VARCHAR) AS event_date)
      FROM deviations""",
    # marts
    "mart_bdi_trade": "SELECT * FROM mart_bdi_trade",
    "mart_port_risk_trade": "SELECT * REPLACE (CAST(fetch_date AS VARCHAR) AS fetch_date) FROM mart_port_risk_trade",
    "mart_strait_monitor": "SELECT * REPLACE (CAST(fetch_date AS VARCHAR) AS fetch_date) FROM mart_strait_monitor",
    "mart_commodity_bdi": "SELECT * FROM mart_commodity_bdi",
    "mart_bdi_signals": "SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM mart_bdi_signals",
    "mart_net_exporter_risk": "SELECT * REPLACE (CAST(fetch_date AS VARCHAR) AS fetch_date) FROM mart_net_exporter_risk",
    "mart_seasonal_freight": "SELECT * FROM mart_seasonal_freight",
    "mart_china_concentration": "SELECT * FROM mart_china_concentration",
    "mart_vessel_port_risk": "SELECT * EXCLUDE (fetched_at) FROM mart_vessel_port_risk",
    "mart_route_disruption": "SELECT * FROM mart_route_disruption",
    "mart_strait_vessel_trend": "SELECT * REPLACE (CAST(fetch_date AS VARCHAR) AS fetch_date) FROM mart_strait_vessel_trend",
    "top_commodity_mode": """SELECT reporter_iso, commodity_name AS top_commodity FROM (
      SELECT reporter_iso, commodity_name, count(*) AS n FROM trade_flows GROUP BY 1, 2)
      QUALIFY row_number() OVER (PARTITION BY reporter_iso ORDER BY n DESC, commodity_name) = 1""",
    # queries
    "q01_top_exporters": f"""SELECT reporter_country AS exporter,
      {r(usd('trade_value_usd') + ' / ' + B, 2)} AS total_value_billion_usd FROM exports GROUP BY 1
      ORDER BY total_value_billion_usd DESC, exporter LIMIT 10""",
    "q02_monthly_index": f"""SELECT month, monthname(make_date(2024, month, 1)) AS month_name,
      {r('avg(bdi_value)', 0)} AS avg_bdi, {r('min(bdi_value)', 0)} AS min_bdi,
      {r('max(bdi_value)', 0)} AS max_bdi, {r('stddev_samp(bdi_value)', 0)} AS bdi_std_dev,
      count(*) AS trading_days FROM bdi_daily GROUP BY month""",
    "q03_trade_balance": f"""SELECT * RENAME (balance AS "trade_balance_B") FROM ({BALANCE_VIEW})
      WHERE abs(balance) > 0 ORDER BY abs(balance) DESC, reporter_iso, hs_code, year LIMIT 50""",
    "q04_index_trade_yoy": f"""SELECT year, avg_bdi, bdi_volatility, spike_days AS spikes,
      drop_days AS drops, export_value_trillion AS trade_trillion_usd,
      {yoy('avg_bdi')} AS bdi_yoy_change_pct, {yoy('export_value_trillion')} AS trade_yoy_change_pct
      FROM index_year LEFT JOIN trade_year USING (year)""",
    "q05_bearish_signals": f"""SELECT CAST(date AS VARCHAR) AS date, year, bdi_value,
      {r('daily_change_pct', 2)} AS change_pct, {r('rolling_7d_avg', 0)} AS avg_7d,
      {r('rolling_30d_avg', 0)} AS avg_30d, signal, below_avg_last_10d,
      {r('(bdi_value - ago) / nullif(ago, 0) * 100', 2)} AS change_vs_7d_ago_pct
      FROM (SELECT *, count(CASE WHEN bdi_value < rolling_7d_avg THEN 1 END) OVER (ORDER BY date
          ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS below_avg_last_10d,
        lag(bdi_value, 7) OVER (ORDER BY date) AS ago,
        CASE WHEN bdi_value < rolling_7d_avg AND bdi_value < rolling_30d_avg AND daily_change_pct < -2
          THEN 'BEARISH' WHEN bdi_value > rolling_7d_avg AND bdi_value > rolling_30d_avg
          AND daily_change_pct > 2 THEN 'BULLISH' ELSE 'NEUTRAL' END AS signal
        FROM bdi_daily WHERE year >= 1998) b
      WHERE signal <> 'NEUTRAL' ORDER BY b.date DESC LIMIT 50""",
    "q06_port_weather_trade": f"""SELECT port_name, w.country_iso, port_rank, weather_main,
      beaufort_number, beaufort_desc, {r('wind_speed_ms', 1)} AS wind_ms,
      CASE WHEN port_risk_flag THEN 'High risk' WHEN beaufort_number >= 5 THEN 'Moderate risk'
        ELSE 'Normal' END AS operational_status, port_risk_flag, {day('fetch_date')},
      coalesce(t, 0) AS "country_trade_B",
      CASE WHEN port_risk_flag AND t > 100 THEN 'High-value port at risk — monitor closely'
        WHEN port_risk_flag THEN 'Port at risk — low trade exposure'
        WHEN beaufort_number >= 5 AND t > 200 THEN 'Fresh breeze at major port — watch conditions'
        ELSE 'Normal operations' END AS business_alert
      FROM port_weather w LEFT JOIN (SELECT reporter_iso, {r(usd('trade_value_usd') + ' / ' + B, 2)}
        AS t FROM exports WHERE year >= 1998 GROUP BY 1) ON reporter_iso = country_iso
      WHERE fetch_date = (SELECT max(fetch_date) FROM port_weather)""",
    "q07_strait_today": f"""SELECT strait_name, region, connects, beaufort_number, beaufort_desc,
      disruption_score, risk_level, geopolitical_risk, trade_pct_global AS pct_world_trade_through,
      oil_pct_global AS pct_world_oil_through,
      {r('CAST(trade_pct_global AS DOUBLE) / 100 * 25000', 0)} AS "est_daily_trade_at_risk_B",
      reroute_note, risk_notes FROM mart_strait_monitor""",
    "q08_index_today": f"""SELECT CAST(date AS VARCHAR) AS date, bdi_value,
      {r('daily_change_pct', 2)} AS daily_change_pct, {r('rolling_7d_avg', 0)} AS avg_7d,
      {r('rolling_30d_avg', 0)} AS avg_30d, {r('rolling_90d_avg', 0)} AS avg_90d, market_signal,
      charter_recommendation, CAST(is_spike AS INT) AS is_spike, CAST(is_drop AS INT) AS is_drop
      FROM mart_bdi_signals m ORDER BY m.date DESC LIMIT 10""",
    "q09_route_briefing": """SELECT route, overall_status, strait, strait_disruption_score,
      geopolitical_risk, commodities_affected, origin_ports_at_risk, dest_ports_at_risk,
      alt_route AS alternative_if_disrupted, route_notes FROM mart_route_disruption""",
    "q10_port_alerts": f"""SELECT port_name, country_iso, port_rank, beaufort_number, beaufort_desc,
      wind_speed_ms, weather_main, CAST(port_risk_flag AS VARCHAR) AS at_risk,
      {r('"export_B"', 1)} AS "export_B", {r('"import_B"', 1)} AS "import_B",
      {r('"total_B"', 1)} AS "total_trade_B", trade_position, business_alert, {day('fetch_date')}
      FROM mart_port_risk_trade m ORDER BY alert_priority, m."total_B" DESC NULLS LAST, port_name
      LIMIT 20""",
    "q11_commodity_burden": f"""SELECT year, commodity_name, "export_B" AS "export_value_B",
      {r('avg_bdi', 0)} AS avg_bdi, {r('bdi_volatility', 0)} AS bdi_volatility, freight_burden_index,
      bdi_sensitivity, CAST(is_cheapest_freight_year AS VARCHAR) AS cheapest_freight_year
      FROM mart_commodity_bdi""",
    "q12_net_exporters": f"""SELECT reporter_country, reporter_iso, {r(f'export_usd / {B}', 1)} AS "export_B",
      {r(f'import_usd / {B}', 1)} AS "import_B", {r('"trade_balance_B"', 1)} AS "trade_balance_B",
      CAST(is_net_exporter AS VARCHAR) AS is_net_exporter, top_export_commodity,
      port_name AS primary_port, beaufort_number, weather_impact FROM mart_net_exporter_risk m
      WHERE m.is_net_exporter ORDER BY export_usd DESC, reporter_iso LIMIT 20""",
    "q13_booking": f"""SELECT month_name, {r('m.avg_bdi', 0)} AS avg_bdi, freight_level,
      rnk AS freight_cheapness_rank, booking_advice, commodity_name, "avg_export_B", bdi_sensitivity,
      {r(f"(max({r('m.avg_bdi', 0)}) OVER () - {r('m.avg_bdi', 0)}) / max({r('m.avg_bdi', 0)}) OVER () * 100", 1)}
        AS pct_saving_vs_peak_month
      FROM (SELECT *, rank() OVER (ORDER BY avg_bdi) AS rnk FROM mart_seasonal_freight) m CROSS JOIN
      (SELECT commodity_name, bdi_sensitivity, {r('avg("export_B")', 1)} AS "avg_export_B"
        FROM mart_commodity_bdi WHERE year >= (SELECT max(year) - 2 FROM mart_commodity_bdi)
        GROUP BY 1, 2) c WHERE bdi_sensitivity LIKE '%High%'""",
    "q14_china_risk": f"""SELECT *, CASE WHEN china_port_at_risk_today AND china_share_pct > 40
        THEN '🔴 CRITICAL — China dominates AND ports at risk'
        WHEN china_port_at_risk_today AND china_share_pct > 20
        THEN '🟠 HIGH — Significant China share AND ports at risk' WHEN china_share_pct > 40
        THEN '🟡 WATCH — High China concentration (weather normal today)' ELSE '🟢 NORMAL' END
        AS supply_risk_alert
      FROM (SELECT commodity_name, china_share_pct, {r(f'china_export_usd / {B}', 1)} AS "china_export_B",
        {r(f'world_export_usd / {B}', 1)} AS "world_export_B", supply_concentration,
        {r('"disruption_exposure_B"', 1)} AS "disruption_exposure_B",
        (SELECT max(beaufort_number) FROM {AT_RISK_VIEW}) AS china_max_beaufort_today,
        (SELECT bool_or(port_risk_flag) FROM {AT_RISK_VIEW}) AS china_port_at_risk_today,
        (SELECT string_agg(port_name, ', ' ORDER BY port_name) FROM (SELECT port_name FROM {AT_RISK_VIEW}
          WHERE port_risk_flag ORDER BY beaufort_number DESC, port_name LIMIT 10)) AS china_ports_at_risk,
        (SELECT count(*) FROM {AT_RISK_VIEW} WHERE port_risk_flag) AS risk_port_count
        FROM mart_china_concentration
        WHERE year = (SELECT max(year) FROM mart_china_concentration))""",
    "q14_ports_at_risk": f"SELECT port_name, beaufort_number FROM {AT_RISK_VIEW} WHERE port_risk_flag",
    "q15_corridor": f"""SELECT *, CASE WHEN worst_strait_score >= 60 OR origin_ports_at_risk >= 2
        THEN '🔴 ROUTE DISRUPTED — Consider Cape of Good Hope rerouting'
        WHEN worst_strait_score >= 40 OR origin_ports_at_risk >= 1
        THEN '🟡 ROUTE UNDER WATCH — Monitor conditions closely'
        ELSE '🟢 ROUTE CLEAR — Normal transit expected' END AS route_status,
      'Cape of Good Hope (+14 days, ~+$1M/voyage)' AS alternative_route
      FROM (SELECT 'Asia → Europe (via Suez)' AS route,
        {r('avg(disruption_score)', 1)} AS avg_strait_score, max(disruption_score) AS worst_strait_score,
        string_agg(concat(strait_name, ': ', disruption_score, '/100 (', risk_level, ')'), ' | '
          ORDER BY disruption_score DESC, strait_name) AS strait_breakdown,
        max(geopolitical_risk) AS highest_geo_risk, arg_max(geopolitical_risk,
          list_position([{', '.join(q(w) for w in GEO_ORDER)}], geopolitical_risk)) AS highest_geo_risk_ordinal,
        CAST(sum(trade_pct_global) AS BIGINT) AS total_trade_pct_through_straits,
        (SELECT count(*) FROM mart_port_risk_trade WHERE port_risk_flag AND port_name IN
          ('Shanghai', 'Ningbo-Zhoushan', 'Shenzhen', 'Busan')) AS origin_ports_at_risk,
        (SELECT count(*) FROM mart_port_risk_trade WHERE port_risk_flag AND port_name IN
          ('Rotterdam', 'Antwerp', 'Hamburg')) AS dest_ports_at_risk
        FROM mart_strait_monitor
        WHERE strait_name IN ('Bab el-Mandeb', 'Suez Canal', 'Strait of Gibraltar'))""",
    "q16_double_risk": f"""SELECT CAST(l.date AS VARCHAR) AS signal_date, l.bdi_value, l.market_signal,
      {r('(l.bdi_value - l.rolling_90d_avg) / nullif(l.rolling_90d_avg, 0) * 100', 1)}
        AS bdi_pct_vs_90d_avg, l.charter_recommendation, bear AS bearish_days_30d,
      bull AS bullish_days_30d, c.commodity_name, china_share_pct, supply_concentration,
      {r(f'china_export_usd / {B}', 2)} AS "china_export_B", {r(f'world_export_usd / {B}', 2)}
        AS "world_export_B", CAST(china_port_risk_today AS VARCHAR) AS china_port_risk,
      s.bdi_sensitivity, s.f AS freight_burden_index,
      CASE WHEN l.market_signal IN ('BEARISH', 'OVERSOLD') AND china_share_pct > 40
          AND china_port_risk_today
        THEN '🔴 TRIPLE RISK: BDI weak + China dominates + China ports disrupted'
        WHEN l.market_signal IN ('BEARISH', 'OVERSOLD') AND china_share_pct > 40
        THEN '🟠 DOUBLE RISK: BDI weak + China dominates this commodity'
        WHEN l.market_signal IN ('BEARISH', 'OVERSOLD') AND s.bdi_sensitivity LIKE '%High%'
        THEN '🟡 FREIGHT RISK: BDI weak and commodity is freight-cost-sensitive'
        WHEN l.market_signal IN ('BULLISH', 'OVERBOUGHT') AND china_share_pct > 40
        THEN '🟡 DEMAND SIGNAL: BDI rising and China dominates — watch for price impact'
        ELSE '🟢 NO COMPOUNDED RISK SIGNAL' END AS compounded_risk_signal
      FROM {LAST} l CROSS JOIN (SELECT count(*) FILTER (market_signal = 'BEARISH') AS bear,
        count(*) FILTER (market_signal = 'BULLISH') AS bull FROM {RECENT})
      CROSS JOIN (SELECT * FROM mart_china_concentration
        WHERE year = (SELECT max(year) FROM mart_china_concentration)) c
      JOIN (SELECT commodity_name, bdi_sensitivity, {r('avg(freight_burden_index)', 4)} AS f
        FROM mart_commodity_bdi GROUP BY 1, 2) s USING (commodity_name)""",
    "q17_fuel_today": f"""SELECT CAST(date AS VARCHAR) AS date, brent_usd_per_bbl AS brent_price,
      brent_30d_avg AS thirty_day_avg, fuel_pressure_score, fuel_signal,
      vlsfo_est_usd_per_mt AS est_ship_fuel_per_tonne FROM fuel f ORDER BY f.date DESC LIMIT 10""",
    "q18_risk_news": f"""SELECT {stamp('pub_date')}, title, source_name, risk_level, risk_score,
      relevant_routes FROM news n WHERE risk_level IN ('HIGH', 'MEDIUM')
      ORDER BY risk_score DESC, n.pub_date DESC, title LIMIT 100""",
    "q19_route_impact": """SELECT CAST(event_date AS VARCHAR) AS event_date, route, current_vessels,
      baseline_avg_vessels, traffic_vs_history_pct, speed_gap_knots, fuel_signal, news_risk_score,
      route_impact_score, status FROM current_vs_historical""",
    "q20_pressure": f"""SELECT brent_usd_per_bbl, fuel_signal, fuel_pressure_score, bdi_value,
      market_signal AS bdi_signal, bdi_value > rolling_90d_avg AS above_long_avg,
      CASE WHEN fuel_signal IN ('HIGH', 'ELEVATED') AND market_signal IN ('BULLISH', 'OVERBOUGHT')
        THEN 'DOUBLE PRESSURE — Lock in contracts now'
        WHEN fuel_signal = 'HIGH' OR market_signal IN ('BULLISH', 'OVERBOUGHT')
        THEN 'SINGLE PRESSURE — Monitor closely'
        WHEN fuel_signal = 'LOW' AND market_signal IN ('BEARISH', 'OVERSOLD')
        THEN 'OPPORTUNITY — Cheap freight + cheap fuel' ELSE 'NORMAL — Standard conditions' END
        AS combined_shipping_signal FROM {LAST_FUEL} f CROSS JOIN {LAST} l""",
    "q21_route_matrix": f"""SELECT route, route_impact_score, status, current_vessels,
      traffic_vs_history_pct, fuel_signal, {r('news_risk_score', 0)} AS news_risk,
      coalesce(disruption_score, 0) AS strait_disruption_score,
      coalesce(geopolitical_risk, 'Unknown') AS geopolitical_risk,
      {r("route_impact_score * CAST(0.4 AS DOUBLE) + coalesce(disruption_score, 0) * "
         "CAST(0.4 AS DOUBLE) + coalesce(news_risk_score, 0) * CAST(0.2 AS DOUBLE)", 1)}
        AS composite_risk_score,
      CASE WHEN traffic_vs_history_pct < -30
        THEN 'WARNING: Severe traffic drop — rerouting likely already occurring'
        WHEN route_impact_score >= 60 THEN 'ALERT: Critical combined pressure on route'
        WHEN fuel_signal = 'HIGH' AND news_risk_score >= 60
        THEN 'CAUTION: High fuel cost + elevated news risk' ELSE 'Normal operating conditions' END
        AS risk_interpretation
      FROM current_vs_historical c LEFT JOIN (SELECT * FROM strait_conditions
        WHERE fetch_date = (SELECT max(fetch_date) FROM strait_conditions)
        QUALIFY row_number() OVER (PARTITION BY strait_name ORDER BY fetched_at DESC, event_id DESC) = 1) s
      ON lower(s.strait_name) LIKE lower(split_part(c.route, ' ', 1) || '%')""",
    "view_trade_balance": f"""SELECT * REPLACE (CAST(hs_code AS VARCHAR) AS hs_code)
      RENAME (balance AS "balance_B") FROM ({BALANCE_VIEW})""",
    "row_counts": """SELECT 'trade_flows' AS tbl, count(*) AS rows FROM trade_rows
      UNION ALL SELECT 'bdi_daily', count(*) FROM index_daily
      UNION ALL SELECT 'port_weather', count(*) FROM port_rows
      UNION ALL SELECT 'vessel_movements', count(*) FROM vessel_rows
      UNION ALL SELECT 'shipping_news', count(*) FROM articles""",
    # panels
    "dash_vessel_snapshot": f"""SELECT count(DISTINCT mmsi) AS vessels_tracked,
      count(*) FILTER (is_moving) AS moving, count(*) FILTER (vessel_category = 'Tanker') AS tankers,
      count(*) FILTER (vessel_category = 'Cargo') AS cargo_ships,
      {r('median(latitude)', 6)} AS median_latitude, {r('median(longitude)', 6)} AS median_longitude
      FROM vessels WHERE fetch_date = (SELECT max(fetch_date) FROM vessels)""",
    "dash_fuel_delta": f"""SELECT CAST(f.date AS VARCHAR) AS date, {r('brent_usd_per_bbl', 2)} AS brent_price,
      fuel_signal, {r('brent_usd_per_bbl - (SELECT brent_usd_per_bbl FROM fuel ORDER BY date DESC LIMIT 1 OFFSET 7)', 2)}
        AS delta_7d FROM {LAST_FUEL} f""",
    "dash_news_top8": f"""SELECT {stamp('pub_date')}, title, risk_level, risk_score, relevant_routes
      FROM news n ORDER BY risk_score DESC, n.pub_date DESC, title LIMIT 8""",
    "dash_route_impact": """SELECT route, status, route_impact_score, traffic_vs_history_pct,
      fuel_signal, news_risk_score, (SELECT count(*) FROM deviations) AS active_alerts
      FROM current_vs_historical""",
    "dash_exec_kpis": f"""SELECT {r('l.bdi_value', 0)} AS bdi,
      {r('l.bdi_value - (SELECT bdi_value FROM bdi_daily ORDER BY date DESC LIMIT 1 OFFSET 5)', 0)}
        AS bdi_delta_5d,
      (SELECT count(*) FILTER (port_risk_flag) FROM port_weather WHERE fetch_date =
        (SELECT max(fetch_date) FROM port_weather)) AS ports_at_risk,
      (SELECT count(*) FROM port_weather WHERE fetch_date =
        (SELECT max(fetch_date) FROM port_weather)) AS ports_total,
      (SELECT count(*) FROM straits_now WHERE disruption_score >= 40 AND fetch_date =
        (SELECT max(fetch_date) FROM straits_now)) AS straits_elevated,
      (SELECT count(*) FROM straits_now WHERE fetch_date =
        (SELECT max(fetch_date) FROM straits_now)) AS straits_total,
      (SELECT {r(usd('trade_value_usd') + ' / ' + T, 1)} FROM exports) AS total_export_trillion,
      (SELECT count(DISTINCT mmsi) FROM vessels WHERE fetch_date =
        (SELECT max(fetch_date) FROM vessels)) AS vessels_tracked,
      l.market_signal AS bdi_signal FROM {LAST} l""",
    "dash_port_alerts": """SELECT port_name, country_iso, beaufort_number, "total_B", business_alert
      FROM mart_port_risk_trade WHERE alert_priority < 5
      ORDER BY alert_priority, "total_B" DESC NULLS LAST, port_name LIMIT 8""",
    "dash_strait_kpis": """SELECT count(*) AS straits_monitored,
      count(*) FILTER (disruption_score >= 60) AS critical,
      count(*) FILTER (disruption_score >= 40) AS high,
      CAST(coalesce(sum(trade_pct_global) FILTER (disruption_score >= 40), 0) AS BIGINT)
        AS trade_pct_at_risk,
      CAST(coalesce(sum(oil_pct_global) FILTER (disruption_score >= 40), 0) AS BIGINT) AS oil_pct_at_risk
      FROM straits_now""",
    "dash_route_kpis": f"""SELECT count(*) AS routes_monitored,
      count(*) FILTER (overall_status LIKE '%DISRUPTED%') AS disrupted,
      count(*) FILTER (overall_status LIKE '%WATCH%') AS watched,
      {r('avg(strait_disruption_score)', 1)} AS avg_strait_score FROM mart_route_disruption""",
    "dash_index_kpis": f"""SELECT {r('arg_max(bdi_value, date)', 0)} AS current_bdi,
      {r("arg_max(bdi_value, date) - (SELECT bdi_value FROM bdi_daily WHERE year BETWEEN 1996 AND 1999 "
         "ORDER BY date DESC LIMIT 1 OFFSET 5)", 0)} AS delta_5d,
      {r('max(bdi_value)', 0)} AS period_high, {r('min(bdi_value)', 0)} AS period_low,
      {r('avg(bdi_value)', 0)} AS period_avg, count(*) FILTER (is_spike) AS spikes,
      count(*) FILTER (is_drop) AS drops FROM bdi_daily WHERE year BETWEEN 1996 AND 1999""",
    "dash_signal_timeline": f"""SELECT {day('date')}, bdi_value, market_signal FROM mart_bdi_signals
      WHERE year BETWEEN 1996 AND 1999""",
    "dash_spikes_by_year": """SELECT year, count(*) FILTER (is_spike) AS spikes,
      count(*) FILTER (is_drop) AS drops FROM bdi_daily GROUP BY year""",
    "dash_month_mean": f"""SELECT month, substr(monthname(make_date(2024, month, 1)), 1, 3) AS month_name,
      {r('avg(bdi_value)', 0)} AS avg_bdi FROM bdi_daily GROUP BY month""",
    "dash_signal_days": """SELECT market_signal, charter_recommendation, count(*) AS days
      FROM mart_bdi_signals GROUP BY ALL""",
    "dash_trade_kpis": f"""SELECT {r(usd('trade_value_usd') + ' / ' + T, 1)} AS total_trillion,
      count(DISTINCT reporter_iso) AS countries, {r(f'{EXP} / nullif({IMP}, 0)', 2)}
        AS export_import_ratio
      FROM trade_flows WHERE year BETWEEN 1996 AND 2000 AND hs_code IN (10, 26, 27)""",
    "dash_top_exporters": f"""SELECT reporter_country, {r(f'v / {T}', 4)} AS "val_T" FROM (
      SELECT reporter_country, {usd('trade_value_usd')} AS v FROM exports GROUP BY 1)
      ORDER BY v DESC, reporter_country LIMIT 15""",
    "dash_balance_extremes": """(SELECT *, 'top' AS side FROM by_country
        ORDER BY "balance_T" DESC, reporter_country LIMIT 8)
      UNION ALL (SELECT *, 'bottom' FROM by_country ORDER BY "balance_T", reporter_country LIMIT 8)""",
    "dash_trade_by_year": f"""SELECT year, hs_code, commodity_name,
      {r(usd('trade_value_usd') + ' / ' + B, 2)} AS "val_B" FROM trade_flows GROUP BY ALL""",
    "dash_bdi_trade_year": """SELECT year, avg_bdi, export_value_trillion, bdi_yoy_pct, trade_yoy_pct,
      correlation_signal FROM mart_bdi_trade""",
    "dash_yoy_heatmap": "SELECT reporter_country, " + ", ".join(
        r(f"avg(CASE WHEN year = {y} THEN g END)", 2) + f" AS y{y}" for y in range(1995, 2002))
        + f""" FROM (SELECT reporter_country, year,
        {r('(trade_value_usd - old) / nullif(old, 0) * 100', 2)} AS g FROM {COUNTRY_YOY}
        WHERE flow_direction = 'Export') WHERE reporter_country IN (SELECT reporter_country FROM (
          SELECT reporter_country, {usd('trade_value_usd')} AS v FROM trade_unique
          WHERE flow_direction = 'Export' GROUP BY 1 ORDER BY v DESC, reporter_country LIMIT 20))
      GROUP BY reporter_country""",
    "dash_port_table": """SELECT port_name, wind_speed_ms, "total_B", business_alert
      FROM mart_port_risk_trade WHERE port_risk_flag""",
    "dash_port_table_top10": """SELECT port_name, port_rank, "total_B" FROM mart_port_risk_trade
      ORDER BY "total_B" DESC NULLS LAST, port_name LIMIT 10""",
    "dash_port_kpis": f"""SELECT count(DISTINCT port_name) AS ports_monitored,
      count(*) FILTER (port_risk_flag) AS at_risk, {r('avg(wind_speed_ms)', 1)} AS avg_wind,
      {r('avg(temp_c)', 1)} AS avg_temp,
      (SELECT {r('coalesce(sum(CAST("total_B" AS DECIMAL(18,2))), 0)', 0)} FROM mart_port_risk_trade
        WHERE port_risk_flag) AS "trade_at_risk_B"
      FROM port_weather WHERE fetch_date = (SELECT max(fetch_date) FROM port_weather)""",
    "dash_weather_counts": "SELECT weather_main, count(*) AS count FROM port_rows GROUP BY 1",
    "dash_vessel_filter": f"""SELECT count(*) AS messages, count(DISTINCT mmsi) AS unique_vessels,
      {r('avg(sog_knots)', 1)} AS avg_speed,
      (SELECT count(*) FROM vessels WHERE is_moving) AS moving_vessels,
      (SELECT count(*) FROM vessels WHERE vessel_category = 'Tanker') AS tankers
      FROM vessels WHERE vessel_category = 'Cargo' AND coalesce(sog_knots, 0) >= 1""",
    "dash_congested_top6": """SELECT port_name, vessel_count, beaufort_number, congestion_weather_risk
      FROM mart_vessel_port_risk ORDER BY vessel_count DESC, port_name, fetched_at DESC, event_id DESC
      LIMIT 6""",
    "dash_value_counts": """SELECT vessel_category AS category, count(*) AS count FROM vessels
      WHERE vessel_category <> 'Unknown' GROUP BY 1""",
    "dash_speed_counts": """SELECT speed_category AS category, count(*) AS count,
      CASE speed_category WHEN 'Stationary' THEN 0 WHEN 'Slow / manoeuvring' THEN 1 WHEN 'Transit'
        THEN 2 WHEN 'Cruising' THEN 3 ELSE 4 END AS position FROM vessels GROUP BY 1""",
    "dash_destinations": """SELECT upper(trim(destination)) AS destination, count(*) AS count
      FROM vessels WHERE destination IS NOT NULL AND trim(destination) <> ''
        AND NOT starts_with(destination, '@') GROUP BY 1
      ORDER BY count(*) DESC, upper(trim(destination)) LIMIT 15""",
    "dash_speed_hist": hist("(SELECT sog_knots FROM vessels WHERE sog_knots > 0.5)", "sog_knots", 30),
    "dash_change_hist": hist("bdi_daily", "daily_change_pct", 80),
    "dash_daily_vessels": f"""SELECT {day('fetch_date')}, vessels, {r('avg(vessels) OVER ()', 1)} AS avg_vessels
      FROM (SELECT fetch_date, count(DISTINCT mmsi) AS vessels FROM vessels_daily GROUP BY 1)""",
    "dash_daily_by_category": """SELECT CAST(v.fetch_date AS VARCHAR) AS fetch_date, vessel_category,
      count(DISTINCT mmsi) AS count FROM vessels v
      WHERE vessel_category IN ('Cargo', 'Tanker', 'Passenger', 'Fishing') GROUP BY ALL""",
    "dash_daily_speed": f"""SELECT CAST(v.fetch_date AS VARCHAR) AS fetch_date,
      {r('avg(sog_knots)', 4)} AS avg_speed FROM vessels v WHERE sog_knots > 0.5 GROUP BY ALL""",
    "dash_burden_pivot": pivot("mart_commodity_bdi", "freight_burden_index"),
    "dash_share_pivot": pivot("mart_china_concentration", "china_share_pct"),
    "dash_sensitivity_list": "SELECT DISTINCT commodity_name, bdi_sensitivity FROM mart_commodity_bdi",
    "dash_share_latest": """SELECT commodity_name, year, china_share_pct, supply_concentration,
      "disruption_exposure_B" FROM mart_china_concentration QUALIFY row_number() OVER (
      PARTITION BY commodity_name ORDER BY year DESC, hs_code) = 1""",
    "dash_strait_trend": f"""SELECT {day('fetch_date')}, strait_name, total_vessels, tanker_count,
      cargo_count FROM mart_strait_vessel_trend
      WHERE strait_name IN ({', '.join(q(x) for x in dims.KEY_STRAITS)})""",
    "dash_strait_trend_latest": f"""SELECT strait_name, CAST(max(fetch_date) AS VARCHAR) AS fetch_date,
      arg_max(total_vessels, fetch_date) AS total_vessels, arg_max(tanker_count, fetch_date)
        AS tanker_count, arg_max(cargo_count, fetch_date) AS cargo_count,
      arg_max(avg_speed_knots, fetch_date) AS avg_speed_knots, arg_max(pct_moving, fetch_date)
        AS pct_moving FROM mart_strait_vessel_trend
      WHERE strait_name IN ({', '.join(q(x) for x in dims.KEY_STRAITS)}) GROUP BY 1""",
    "eda_bdi_trade_corr": f"""SELECT {r('corr(b, t)', 6)} AS pearson_r, count(*) AS years FROM
      (SELECT year, avg(bdi_value) AS b FROM bdi_daily GROUP BY 1) JOIN
      (SELECT year, {usd('trade_value_usd')} / {T} AS t FROM exports GROUP BY 1) USING (year)""",
    "eda_moving_share": """SELECT CAST(floor(avg(CAST(is_moving AS DOUBLE)) * 100) AS BIGINT) AS moving_pct
      FROM vessels""",
    "route_chokepoint_watch": """SELECT p.route_name, alternative_route, extra_days_if_disrupted,
      extra_cost_per_voyage_usd, p.strait_name, disruption_score, risk_level, watch_ports,
      watch_ports_at_risk
      FROM (SELECT route_name, alternative_route, extra_days_if_disrupted, extra_cost_per_voyage_usd,
          unnest(CASE WHEN len(points) = 0 THEN [NULL] ELSE points END) AS strait_name FROM cfg) p
      LEFT JOIN straits_now s ON s.strait_name = p.strait_name
      LEFT JOIN (SELECT route_name, count(w) AS watch_ports, count(*) FILTER (port_risk_flag)
          AS watch_ports_at_risk
        FROM (SELECT route_name, unnest(CASE WHEN len(ports) = 0 THEN [NULL] ELSE ports END) AS w
          FROM cfg) LEFT JOIN ports_now ON port_name = w GROUP BY 1) x ON x.route_name = p.route_name""",
}

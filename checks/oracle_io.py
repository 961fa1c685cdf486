"""SQL for the registered sources, sinks and streams."""

from __future__ import annotations

from tradelane import dims

from .oracle import TABLES, r, rows
from .oracle_queries import QUERIES, STATIC, day, stamp

TABLES["port_dim"] = rows([(n, c, i + 1, lat, lon) for i, (n, c, lat, lon) in enumerate(dims.PORTS)],
                          "port_name, country_iso, port_rank, lat, lon")
GAP = "event_id % 3 <> 0"
MESSAGES = f"""(SELECT s.*, v.latitude, v.longitude, v.navigational_status, message_id % 97 = 0 AS bad
  FROM {STATIC} s JOIN vessel_rows v ON v.event_id = s.message_id)"""


def said(value: str, when: str) -> str:
    return f"CASE WHEN NOT bad AND {when} THEN {value} END"


AIS = f"""SELECT {said("CASE WHEN st THEN 'ShipStaticData' ELSE 'PositionReport' END", 'true')}
    AS message_type, {said('mmsi', 'true')} AS mmsi, {said("concat('SHIP ', k)", 'st')} AS ship_name,
  {said('message_id + 9000000', 'st')} AS imo, {said("concat('C', k)", 'st')} AS call_sign,
  {said('latitude', 'NOT st')} AS latitude, {said('longitude', 'NOT st')} AS longitude,
  {said('value / 10', 'NOT st')} AS sog_knots,
  {said('navigational_status', 'NOT st')} AS navigational_status,
  {said("concat('PORT ', k % 9)", 'st')} AS destination, {said('k', 'st')} AS vessel_type,
  {said("strftime(ts, '%Y-%m-%d %H:%M:%S.%f')", 'true')} AS event_time_utc, bad AS malformed
  FROM {MESSAGES}"""

QUERIES_IO = {
    "src_trade_csv": """SELECT "reporterISO", "cmdCode", "flowDesc", "refYear",
      CAST("primaryValue" AS VARCHAR) AS "primaryValue", "motDesc",
      CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
      CAST(l_partkey AS VARCHAR) AS l_partkey FROM trade_raw""",
    "src_index_csv": QUERIES["clean_index"],
    "src_weather_json": f"""SELECT p.port_name, d.country_iso, d.port_rank, d.lat, d.lon,
      {stamp('fetched_at')}, temp_c, temp_c - 1 AS feels_like_c, humidity_pct, 1013 AS pressure_hpa,
      wind_speed_ms, CASE WHEN {GAP} THEN wind_speed_ms * 2 ELSE wind_speed_ms END AS wind_gust_ms,
      CAST(event_id % 360 AS INT) AS wind_deg,
      CASE WHEN {GAP} THEN visibility_m ELSE 10000 END AS visibility_m, weather_main,
      lower(weather_main) AS weather_desc, CAST(event_id % 100 AS INT) AS cloudiness_pct,
      CASE WHEN {GAP} THEN CAST(0.5 AS DOUBLE) ELSE 0 END AS rain_1h_mm,
      CAST(0 AS DOUBLE) AS snow_1h_mm, CASE WHEN (event_id * 977) % 900000 <> 0 THEN
        strftime(make_timestamp((event_id * 977) % 900000 * 1000000), '%H:%M') END AS sunrise_utc,
      CASE WHEN {GAP} AND (event_id * 977) % 900000 <> 0 THEN
        strftime(make_timestamp((event_id * 977) % 900000 * 1000000), '%H:%M') END AS sunset_utc,
      beaufort_number, port_risk_flag, {GAP} AND low_visibility AS low_visibility,
      {day('fetch_date')}, CAST(year(p.fetch_date) AS INT) AS fetch_year,
      CAST(month(p.fetch_date) AS INT) AS fetch_month
      FROM port_weather p LEFT JOIN port_dim d ON d.port_name = p.port_name""",
    "src_strait_json": f"""SELECT *, CASE WHEN disruption_score >= 60 THEN 'Critical'
        WHEN disruption_score >= 40 THEN 'High' WHEN disruption_score >= 20 THEN 'Moderate'
        ELSE 'Normal' END AS risk_level
      FROM (SELECT strait_name, region, geopolitical_risk, trade_pct_global, {stamp('fetched_at')}, temp_c,
        wind_speed_ms, CASE WHEN {GAP} THEN wind_speed_ms * 2 ELSE wind_speed_ms END AS wind_gust_ms,
        visibility_m, beaufort_number, beaufort_number >= 7 AS weather_risk_flag,
        CAST(least(100, CASE geopolitical_risk WHEN 'Very High' THEN 40 WHEN 'High' THEN 25
          WHEN 'Medium' THEN 10 ELSE 0 END + least(beaufort_number * 6, 60)
          + CASE WHEN visibility_m < 1000 THEN 10 WHEN visibility_m < 5000 THEN 5 ELSE 0 END) AS INT)
          AS disruption_score, {day('fetch_date')}
      FROM (SELECT * REPLACE (CAST(CASE WHEN {GAP} THEN visibility_m ELSE 10000 END AS INT) AS visibility_m)
        FROM strait_conditions))""",
    "src_ais_jsonl": AIS,
    "src_fuel_json": "SELECT CAST(date AS VARCHAR) AS date, brent_usd_per_bbl FROM fuel_raw",
    "src_news_json": """SELECT title, description, coalesce(strftime(pub_date, '%Y-%m-%dT%H:%M:%S'),
      'not a date') AS "publishedAt", url, source_name FROM articles""",
    "src_clean_csv": f"""SELECT {day('date')}, bdi_value, daily_change_pct, is_spike, year, weekday,
      'investing_bdi_csv' AS source FROM bdi_daily""",
    "src_fallback": f"""SELECT 'static' AS branch, {day('date')}, bdi_value, is_spike FROM bdi_daily UNION ALL
      SELECT 'daily', {day('date')}, bdi_value, is_spike FROM bdi_daily WHERE year % 2 = 0""",
    "sink_merge_days": f"""SELECT event_id, port_name, {stamp('fetched_at')}, wind_speed_ms,
      {day('fetch_date')} FROM port_rows""",
    "sink_append": f"""SELECT event_id, port_name, wind_speed_ms, CASE WHEN fetch_date >=
      DATE '2024-01-16' THEN temp_c END AS temp_c, {day('fetch_date')} FROM port_rows""",
    "sink_overwrite": "SELECT CAST(date AS VARCHAR) AS date, brent_usd_per_bbl FROM fuel_raw",
    "sink_raw_json": """SELECT event_id, mmsi, sog_knots, '2024-02-01' AS dt FROM vessel_rows""",
    "table_snapshot": """SELECT d AS snap_date, count(*) AS rows FROM fuel_raw,
      (VALUES ('20240201'), ('20240118')) AS v(d) GROUP BY 1""",
    "table_snapshot_published": """SELECT '20240118' AS snap_date, count(*) AS rows, count(DISTINCT mmsi) AS vessels
        FROM vessel_rows WHERE event_id % 3 = 0 HAVING count(*) > 0
      UNION ALL SELECT '20240201', count(*), count(DISTINCT mmsi) FROM vessel_rows HAVING count(*) > 0""",
    "stream_ais_source": AIS,
    "stream_filter_type": f"""SELECT message_type, mmsi, latitude, longitude, event_time_utc FROM ({AIS})
      WHERE message_type IS NOT NULL""",
    "stream_dedupe_daily": f"""SELECT mmsi, {day('fetch_date')}, event_id, sog_knots, port_guess
      FROM vessels_daily v""",
    "stream_strait_counts": """SELECT CAST(v.fetch_date AS VARCHAR) AS fetch_date,
      port_guess AS strait_name, count(*) AS vessels, count(*) FILTER (is_moving) AS moving
      FROM vessels_daily v WHERE is_strait GROUP BY ALL""",
    "stream_route_activity": f"""SELECT CAST(w AS VARCHAR) AS window_start, a.route, messages, avg_speed,
        vessels, b.v AS baseline_avg_vessels,
        {r('(CAST(vessel_days AS DOUBLE) / 7 - b.v) / nullif(b.v, 0) * 100', 1)} AS vessels_vs_baseline_pct
      FROM (SELECT CAST(v.fetch_date - CAST(i AS INT) AS DATE) AS w, route, count(*) AS messages,
          {r('avg(sog_knots)', 6)} AS avg_speed, count(DISTINCT mmsi) AS vessels,
          count(DISTINCT (mmsi, v.fetch_date)) AS vessel_days
        FROM (SELECT * FROM all_routed) v, range(7) g(i) GROUP BY ALL) a
      LEFT JOIN (SELECT route, baseline_avg_vessels AS v FROM route_baselines) b USING (route)""",
    "route_windows_approx": f"""SELECT CAST(v.fetch_date - CAST(i AS INT) AS VARCHAR) AS window_start, route,
        count(*) AS messages, {r('avg(sog_knots)', 6)} AS avg_speed, count(DISTINCT mmsi) AS vessels, true AS within
      FROM (SELECT * FROM all_routed) v, range(7) g(i) GROUP BY ALL""",
    "sink_publish": f"SELECT event_id, mmsi, sog_knots, {day('fetch_date')} FROM vessel_rows",
    "src_newest_day": QUERIES["latest_snapshot"],
    "stream_upsert_history": f"""SELECT event_id, mmsi, sog_knots, {day('fetch_date')}
      FROM vessel_rows""",
    "stream_enrich_static": QUERIES["enrich_static"],
}

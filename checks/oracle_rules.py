"""SQL for the single-rule queries."""

from __future__ import annotations

from tradelane.functions.weather import _BANDS

from .oracle import BADGE, NOTE, SPEED, q, r
from .oracle_queries import BY_CODE, BY_NAME, CODED, NAV_CAPTURE, NAV_DAILY, TYPE_NAME


def band(card: str) -> str:
    top, high, some, calm = (q(x) for x in _BANDS[card])
    return (f"CASE WHEN disruption_score >= 60 THEN {top} WHEN disruption_score >= 40 THEN {high} "
            f"WHEN disruption_score >= 20 THEN {some} ELSE {calm} END AS {card}")


GAPS = """(SELECT event_id, CAST(visibility_m AS DOUBLE) / 100 - 50 AS tg, wind_speed_ms - 5 AS sg,
  temp_c AS fp, CAST(humidity_pct AS DOUBLE) AS nr FROM strait_conditions)"""
SCORE = r("greatest(0, tg * CAST(-0.4 AS DOUBLE)) + greatest(0, sg * -5) + fp * CAST(0.3 AS DOUBLE) "
          "+ nr * CAST(0.3 AS DOUBLE)", 1)

QUERIES_RULES = {
    "decode_vessel_type": f"SELECT event_id, {TYPE_NAME} AS vessel_type_name FROM {CODED}",
    "decode_nav_status": f"""SELECT event_id, {NAV_DAILY} AS daily, {NAV_CAPTURE} AS capture
      FROM vessel_rows""",
    "vessel_category_by_name": f"""SELECT event_id, {BY_NAME} AS category FROM (
      SELECT event_id, {TYPE_NAME} AS vessel_type_name FROM {CODED})""",
    "vessel_category_by_code": f"SELECT event_id, {BY_CODE} AS category FROM {CODED}",
    "speed_category": f"""SELECT event_id, {SPEED.format(0.5, 3, 10)} AS daily,
      {SPEED.format(0.3, 3, 12)} AS capture FROM {CODED}""",
    "is_moving": f"""SELECT event_id, coalesce(sog_knots, 0) >= 0.5 AS daily,
      coalesce(sog_knots, 0) > 0.3 AS capture FROM {CODED}""",
    "weather_flags": """SELECT event_id, wind_speed_ms >= 13.9 AS port_risk_flag,
      visibility_m < 1000 AS low_visibility FROM port_rows""",
    "reroute_note": f"SELECT event_id, {NOTE} AS reroute_note FROM strait_rows",
    "combined_risk": f"SELECT event_id, {BADGE} AS combined_risk FROM strait_conditions",
    "score_band": f"""SELECT event_id, {band('summary')}, {band('strait')}, {band('route')}
      FROM strait_conditions""",
    "freight_level": """SELECT CAST(date AS VARCHAR) AS date, CASE WHEN bdi_value > 300000
      THEN 'Expensive (high demand)' WHEN bdi_value < 200000 THEN 'Cheap (low demand)'
      ELSE 'Moderate' END AS freight_level FROM index_daily""",
    "booking_advice": """SELECT CAST(date AS VARCHAR) AS date,
      CASE WHEN month(index_daily.date) BETWEEN 9 AND 11
      THEN 'Book ahead — pre-holiday restocking demand' WHEN month(index_daily.date) IN (2, 3)
      THEN 'Cheapest window — post-Chinese-New-Year lull' ELSE 'Moderate — check spot rates' END
      AS advice FROM index_daily""",
    "route_status": """SELECT event_id, CASE WHEN lvl IN ('Critical', 'High') OR
      geopolitical_risk = 'Very High' THEN '🔴 DISRUPTED' WHEN lvl = 'Moderate' OR event_id % 2 = 0
      THEN '🟡 WATCH' ELSE '🟢 CLEAR' END AS status FROM (SELECT *, CASE WHEN event_id % 5 <> 0
      THEN risk_level END AS lvl FROM strait_conditions)""",
    "route_impact": f"""SELECT *, greatest(0, least(100, score)) AS capped, CASE WHEN score >= 60 THEN
      'CRITICAL' WHEN score >= 30 THEN 'ELEVATED' ELSE 'NORMAL' END AS status
      FROM (SELECT event_id, {SCORE} AS score FROM {GAPS})""",
    "deviation_alerts": f"""SELECT * FROM (SELECT event_id, CASE WHEN tg < -20 THEN 'Traffic drop'
      WHEN sg < -2 THEN 'Speed drop' WHEN nr >= 70 THEN 'News risk' WHEN fp > 10 THEN 'Fuel spike' END
      AS reason FROM {GAPS}) WHERE reason IS NOT NULL""",
    "src_table": "SELECT event_id, sog_knots FROM vessel_rows",
    "sink_csv": "SELECT event_id, mmsi, sog_knots FROM vessel_rows",
}

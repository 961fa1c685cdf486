"""Port, congestion and route rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import ladder, round_half_up

# Alert text by priority 1..5.
PORT_ALERTS = ["🔴 CRITICAL — High-value port at risk", "🟠 HIGH — Major port at risk",
               "🟡 MODERATE — Port at risk, lower trade", "🟡 WATCH — Fresh breeze at major port",
               "🟢 NORMAL — Operations unaffected"]

# Route status by sort rank 0..3.
ROUTE_STATES = ["🔴 DISRUPTED", "🟡 WATCH", "🟢 CLEAR", "⚪ UNKNOWN"]


def alert_priority(at_risk: Column, trade_b: Column, force: Column) -> Column:
    """1 worst to 5 normal; missing trade or wind counts as zero, a missing flag as no risk."""
    risk = F.coalesce(at_risk, F.lit(False))
    trade = F.coalesce(trade_b, F.lit(0.0))
    return ladder([(risk & (trade > 500), 1), (risk & (trade > 100), 2), (risk, 3),
                   ((F.coalesce(force, F.lit(0)) >= 5) & (trade > 200), 4)], 5)


def port_alert(priority: Column) -> Column:
    return F.get(F.array(*[F.lit(t) for t in PORT_ALERTS]), priority - 1)


def weather_impact(at_risk: Column, force: Column) -> Column:
    return ladder([(F.coalesce(at_risk, F.lit(False)), "Port disruption active"),
                   (F.coalesce(force, F.lit(0)) >= 5, "Moderate conditions")], "Normal operations")


def congestion_risk(vessels: Column, force: Column, visibility_m: Column) -> Column:
    """No visibility value (or 0) is read as a clear 10 km."""
    bf = F.coalesce(force, F.lit(0))
    vis = F.coalesce(F.when(visibility_m != 0, visibility_m), F.lit(10000))
    return ladder([
        ((vessels > 50) & (bf >= 6), "🔴 HIGH — Dense traffic + strong winds"),
        ((vessels > 30) & (vis < 5000), "🟠 MODERATE — Dense traffic + limited visibility"),
        (bf >= 7, "🟡 WEATHER — Near-gale conditions"),
        (vessels > 50, "🟡 CONGESTION — High vessel density"),
    ], "🟢 NORMAL")


def route_status(strait_level: Column, geo_risk: Column, any_port_at_risk: Column) -> Column:
    """Null strait columns mean there is no strait reading for the route."""
    return ladder([
        (strait_level.isin("Critical", "High") | (geo_risk == "Very High"), ROUTE_STATES[0]),
        ((strait_level == "Moderate") | any_port_at_risk, ROUTE_STATES[1]),
        ((strait_level == "Normal") | strait_level.isNull(), ROUTE_STATES[2]),
    ], ROUTE_STATES[3])


def route_status_rank(status: Column) -> Column:
    return ladder([(status == name, rank) for rank, name in enumerate(ROUTE_STATES)], 9)


def traffic_gap_pct(current: Column, baseline: Column) -> Column:
    return (current - baseline) / F.greatest(baseline, F.lit(1.0)) * 100


def route_impact(traffic_gap: Column, speed_gap: Column, fuel_pressure: Column, news_risk: Column,
                 cap: bool = False) -> Column:
    score = round_half_up(F.greatest(F.lit(0.0), traffic_gap * -0.4)
                    + F.greatest(F.lit(0.0), speed_gap * -5.0)
                    + fuel_pressure * 0.3 + news_risk * 0.3, 1)
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), score)) if cap else score


def impact_status(score: Column) -> Column:
    return ladder([(score >= 60, "CRITICAL"), (score >= 30, "ELEVATED")], "NORMAL")


def deviation_reason(traffic_gap: Column, speed_gap: Column, news_risk: Column,
                     fuel_pressure: Column) -> Column:
    """Null when nothing deviates."""
    return ladder([(traffic_gap < -20, "Traffic drop"), (speed_gap < -2, "Speed drop"),
                   (news_risk >= 70, "News risk"), (fuel_pressure > 10, "Fuel spike")], None)

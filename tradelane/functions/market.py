"""Freight index, fuel and trade classification rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..dims import CHARTER_ADVICE, HS_NAMES, HS_SENSITIVITY
from .common import code_label, ladder


def market_signal(value: Column, avg7: Column, avg30: Column, avg90: Column, change: Column) -> Column:
    """A missing change counts as no move."""
    return ladder([
        ((value > avg7) & (value > avg30) & (change > 2), "BULLISH"),
        ((value < avg7) & (value < avg30) & (change < -2), "BEARISH"),
        (value > avg90 * 1.15, "OVERBOUGHT"),
        (value < avg90 * 0.85, "OVERSOLD"),
    ], "NEUTRAL")


def trend_signal(value: Column, avg7: Column, avg30: Column, change: Column) -> Column:
    """The three-way form used by the signal query."""
    return ladder([
        ((value < avg7) & (value < avg30) & (change < -2), "BEARISH"),
        ((value > avg7) & (value > avg30) & (change > 2), "BULLISH"),
    ], "NEUTRAL")


def charter_advice(signal: Column) -> Column:
    return ladder([(signal == name, text) for name, text in CHARTER_ADVICE.items()], None)


def correlation_signal(index_yoy: Column, trade_yoy: Column) -> Column:
    return ladder([
        ((index_yoy > 2) & (trade_yoy > 2), "Both rising"),
        ((index_yoy < -2) & (trade_yoy < -2), "Both falling"),
        ((index_yoy > 5) & (trade_yoy < 0), "BDI up, trade down (freight squeeze)"),
        ((index_yoy < -5) & (trade_yoy > 0), "BDI down, trade up (cheap shipping)"),
    ], "Neutral / mixed")


def freight_level(monthly_avg: Column, q33: Column, q67: Column) -> Column:
    return ladder([(monthly_avg > q67, "Expensive (high demand)"),
                   (monthly_avg < q33, "Cheap (low demand)")], "Moderate")


def booking_advice(month: Column) -> Column:
    return ladder([
        (month.isin(9, 10, 11), "Book ahead — pre-holiday restocking demand"),
        (month.isin(2, 3), "Cheapest window — post-Chinese-New-Year lull"),
    ], "Moderate — check spot rates")


def fuel_signal(pressure: Column) -> Column:
    return ladder([(pressure > 10, "HIGH"), (pressure > 3, "ELEVATED"), (pressure > -3, "NORMAL")],
                  "LOW")


def supply_concentration(share_pct: Column) -> Column:
    return ladder([(share_pct > 50, "Critical (>50%)"), (share_pct > 30, "High (30-50%)"),
                   (share_pct > 15, "Moderate (15-30%)")], "Low (<15%)")


def commodity_name(hs_code: Column) -> Column:
    return F.coalesce(code_label(hs_code, HS_NAMES), F.lit("Other"))


def freight_sensitivity(hs_code: Column) -> Column:
    return F.coalesce(code_label(hs_code, HS_SENSITIVITY), F.lit("Unknown"))


def trade_position(exports: Column, imports: Column) -> Column:
    return F.when(exports > imports, "Net Exporter").otherwise("Net Importer")

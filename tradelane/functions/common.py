"""Small Column helpers shared by the rules."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACE = " \t\n\r\f\v"


def ladder(steps: Iterable[tuple[Column, object]], otherwise: object) -> Column:
    """First true condition wins; a null condition falls through."""
    out = None
    for condition, value in steps:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return F.lit(otherwise) if out is None else out.otherwise(otherwise)


def sql_text(text: str) -> str:
    """A string literal for ``F.expr``; long tables are shorter to send as one expression."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def code_label(code: Column, names: Mapping[int, str]) -> Column:
    """Label of a code, null when unknown. A literal map: one lookup per row."""
    pairs = ", ".join(f"{key}, {sql_text(name)}" for key, name in names.items())
    return F.try_element_at(F.expr(f"map({pairs})"), code)


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends; text without any is left untouched."""
    # looking at the two ends costs the same for any length
    edge = text.startswith(_SPACE[0]) | text.endswith(_SPACE[0])
    for c in _SPACE[1:]:
        edge = edge | text.startswith(c) | text.endswith(c)
    return F.when(edge, F.trim(text, F.lit(_SPACE))).otherwise(text)


def round_half_up(value: Column | str, digits: int) -> Column:
    """Round on the decimal form of a double, half away from zero.

    Rounding the binary value directly would send ``x.xx5`` up or down depending on
    how it was computed; nine decimals absorb that.
    """
    column = F.col(value) if isinstance(value, str) else value
    return F.round(column.cast("decimal(38,9)"), digits).cast("double")


def safe_ratio(a: Column, b: Column, digits: int | None = None) -> Column:
    """``a / b`` where ``b`` is above zero, else null."""
    ratio = F.when(b > 0, F.try_divide(a, b))
    return ratio if digits is None else round_half_up(ratio, digits)


def pct_change(new: Column, old: Column) -> Column:
    """Percent change; null when the old value is null or zero."""
    return F.try_divide(new - old, old) * 100


def cents_sum(value: Column) -> Column:
    """Sum of two-decimal amounts as whole cents.

    Longs add up the same whatever the partitioning; an overflow raises.
    """
    return F.sum(F.round(value * 100).cast("long"))


def usd(cents: Column, unit: float = 1.0) -> Column:
    return cents / F.lit(100.0 * unit)


def money_sum(value: Column, unit: float = 1.0) -> Column:
    """Sum of two-decimal amounts in dollars (or in ``unit`` dollars)."""
    return usd(cents_sum(value), unit)

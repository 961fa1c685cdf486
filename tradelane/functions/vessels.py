"""AIS code and speed rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import dims
from .common import code_label, ladder


def vessel_type_name(code: Column) -> Column:
    whole = code.cast("int")
    return F.coalesce(code_label(whole, dims.VESSEL_TYPE_NAMES),
                      F.concat(F.lit("Type "), whole.cast("string")), F.lit("Unknown"))


def nav_status_name(code: Column, variant: str = "daily") -> Column:
    """Daily job: a missing code is 15, an unknown one ``Unknown``. Capture: keeps the number."""
    whole = code.cast("int")
    if variant == "daily":
        return F.coalesce(code_label(F.coalesce(whole, F.lit(15)), dims.NAV_STATUS_DAILY),
                          F.lit("Unknown"))
    return F.coalesce(code_label(whole, dims.NAV_STATUS_CAPTURE),
                      F.concat(F.lit("Status "), whole.cast("string")), F.lit("Not reported"))


def category_by_name(type_name: Column) -> Column:
    low = F.lower(type_name)
    return ladder([(low.contains(word), label) for word, label in dims.VESSEL_NAME_WORDS], "Other")


def category_by_code(code: Column) -> Column:
    """Null and 0 are unknown."""
    steps = [(code.isNull() | (code == 0), "Unknown")]
    steps += [(code.between(first, last), label) for first, last, label in dims.VESSEL_CODE_RANGES]
    return ladder(steps, "Other")


def speed_category(sog: Column, cuts: Sequence[float] = tuple(dims.SPEED_CUTS_DAILY)) -> Column:
    steps = [(sog.isNull(), "Unknown")]
    steps += [(sog < cut, label) for cut, label in zip(cuts, dims.SPEED_LABELS)]
    return ladder(steps, dims.SPEED_LABELS[-1])


def is_moving(sog: Column, variant: str = "daily") -> Column:
    speed = F.coalesce(sog, F.lit(0.0))
    return speed >= 0.5 if variant == "daily" else speed > 0.3

"""Text to typed values. Bad input gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import strip


def parse_number(text: Column) -> Column:
    """``2,030.00`` -> 2030.0, ``1.75%`` -> 1.75, ``1.5K`` -> 1500.0, ``3M`` -> 3000000.0."""
    plain = F.upper(strip(F.regexp_replace(text.cast("string"), "[,%]", "")))
    scale = F.when(plain.endswith("K"), 1e3).when(plain.endswith("M"), 1e6).otherwise(1.0)
    number = F.regexp_replace(plain, "[KM]$", "").try_cast("double")
    return F.when(~F.isnan(number), number * scale)


def parse_date(text: Column, fmt: str = "MM/dd/yyyy") -> Column:
    return F.to_date(F.try_to_timestamp(text, F.lit(fmt)))


def to_number(value: Column, dtype: str = "double") -> Column:
    """Unparseable text and NaN become null."""
    if dtype == "boolean":
        return value.try_cast("boolean")
    if dtype != "double":
        return value.try_cast("double").try_cast(dtype)
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def title_case(text: Column) -> Column:
    """Capital after every non-letter, so ``re-export`` gives ``Re-Export``."""
    low = F.lower(strip(text))
    words = F.split(low, "(?<=[^\\p{L}])")
    by_word = F.array_join(F.transform(words, lambda w: F.initcap(w)), "")
    # most values are plain words, which need no splitting
    return F.when(low.rlike("[^\\p{L} ]"), by_word).otherwise(F.initcap(low))


def unix_to_hhmm(seconds: Column) -> Column:
    """UTC clock time of unix seconds; null and 0 give null."""
    inside = F.pmod(seconds, F.lit(86400))
    hour = F.floor(inside / 3600).cast("string")
    minute = F.floor(F.pmod(inside, F.lit(3600)) / 60).cast("string")
    return F.when(seconds != 0, F.concat(F.lpad(hour, 2, "0"), F.lit(":"), F.lpad(minute, 2, "0")))


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def nullif_zero(value: Column) -> Column:
    return F.when(value != 0, value)


def within(value: Column, low: float, high: float) -> Column:
    """The value when inside the closed range, else null."""
    return F.when(value.between(low, high), value)

"""Cleaning, projection and deduplication operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import dims
from ..functions import common, parsing, vessels, weather

# Raw trade columns that carry no analysis value.
TRADE_DROP = ["typeCode", "freqCode", "refPeriodId", "refMonth", "partner2Code", "partner2ISO",
              "partner2Desc", "classificationCode", "classificationSearchCode",
              "isOriginalClassification", "customsCode", "customsDesc", "mosCode",
              "legacyEstimationFlag", "isReported", "isAggregate", "grossWgt", "altQtyUnitCode",
              "altQtyUnitAbbr", "altQty", "isAltQtyEstimated"]

# Raw to clean names of the trade file and of the index file.
TRADE_NAMES = {
    "reporterISO": "reporter_iso", "reporterDesc": "reporter_country",
    "reporterCode": "reporter_code", "flowCode": "flow_code", "flowDesc": "flow_direction",
    "partnerCode": "partner_code", "partnerISO": "partner_iso", "partnerDesc": "partner_country",
    "cmdCode": "hs_code", "cmdDesc": "commodity", "aggrLevel": "aggregation_level",
    "isLeaf": "is_leaf", "motCode": "transport_mode_code", "motDesc": "transport_mode",
    "qtyUnitCode": "qty_unit_code", "qtyUnitAbbr": "qty_unit", "qty": "quantity",
    "isQtyEstimated": "qty_estimated", "netWgt": "net_weight_kg",
    "isNetWgtEstimated": "weight_estimated", "cifvalue": "cif_value_usd",
    "fobvalue": "fob_value_usd", "primaryValue": "trade_value_usd", "refYear": "year",
    "period": "period",
}
INDEX_NAMES = {"Date": "date", "Price": "bdi_value", "Open": "bdi_open", "High": "bdi_high",
               "Low": "bdi_low", "Vol.": "bdi_volume", "Change %": "bdi_change_pct"}

# What a missing optional trade or weather field becomes.
TRADE_DEFAULTS = {"net_weight_kg": 0.0, "quantity": 0.0, "transport_mode": "Not specified",
                  "weight_estimated": True}
WEATHER_DEFAULTS = {"visibility_m": 10000, "rain_1h_mm": 0.0, "snow_1h_mm": 0.0}

# Types of the trade columns that are not text.
TRADE_TYPES = {
    "year": "int", "period": "int", "reporter_code": "int", "partner_code": "int",
    "hs_code": "int", "aggregation_level": "int", "transport_mode_code": "int",
    "qty_unit_code": "int", "quantity": "double", "net_weight_kg": "double",
    "cif_value_usd": "double", "fob_value_usd": "double", "trade_value_usd": "double",
    "is_leaf": "boolean", "qty_estimated": "boolean", "weight_estimated": "boolean",
}

TRADE_KEY = ["reporter_iso", "partner_iso", "hs_code", "flow_direction", "year"]


def _present(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [c for c in names if c in df.columns]


def drop_columns(df: DataFrame, names: Sequence[str] = tuple(TRADE_DROP)) -> DataFrame:
    return df.drop(*names)


def rename_columns(df: DataFrame, names: Mapping[str, str] = TRADE_NAMES) -> DataFrame:
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def drop_all_null_columns(df: DataFrame, candidates: Sequence[str] | None = None) -> DataFrame:
    """Drop columns without any value: one pass, one row of counts back."""
    names = _present(df, candidates or df.columns)
    if not names:
        return df
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in names]).first().asDict()
    return df.drop(*[c for c, n in counts.items() if n == 0])


def drop_null_required(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.dropna(subset=_present(df, names))


def fill_constant(df: DataFrame, values: Mapping[str, object] = TRADE_DEFAULTS) -> DataFrame:
    return df.fillna({c: v for c, v in values.items() if c in df.columns})


def fill_from_column(df: DataFrame, target: str = "wind_gust_ms",
                     other: str = "wind_speed_ms") -> DataFrame:
    return df.withColumn(target, F.coalesce(target, other))


def zero_to_null(df: DataFrame,
                 names: Sequence[str] = ("bdi_open", "bdi_high", "bdi_low")) -> DataFrame:
    return df.withColumns({c: parsing.nullif_zero(F.col(c)) for c in _present(df, names)})


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in a given total order.

    The rank filter is applied before the shuffle as well (group limit), so a hot
    key sends one row per input partition.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def dedupe_exact(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def dedupe_latest(df: DataFrame, keys: Sequence[str], ts: str,
                  tiebreak: Sequence[str] = ()) -> DataFrame:
    order = [F.col(c).desc_nulls_last() for c in [ts, *tiebreak]]
    return dedupe_first(df, keys, order)


def latest_snapshot(df: DataFrame, date_col: str = "fetch_date") -> DataFrame:
    """Rows of the newest date in the whole table.

    The newest date is a one-value subquery, resolved before the scan it filters.
    """
    newest = df.agg(F.max(F.to_date(date_col))).scalar()
    return df.where(F.to_date(date_col) == newest)


def standardize_text(df: DataFrame, upper: Sequence[str] = ("reporter_iso", "partner_iso"),
                     title: Sequence[str] = ("flow_direction",),
                     trim: Sequence[str] = ("reporter_country", "partner_country", "commodity"),
                     ) -> DataFrame:
    out: dict[str, Column] = {}
    for c in _present(df, trim):
        out[c] = common.strip(F.col(c).cast("string"))
    for c in _present(df, upper):
        out[c] = F.upper(common.strip(F.col(c).cast("string")))
    for c in _present(df, title):
        out[c] = parsing.title_case(F.col(c).cast("string"))
    return df.withColumns(out)


def parse_numeric_text(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({c: parsing.parse_number(F.col(c)) for c in _present(df, names)})


def parse_date_text(df: DataFrame, name: str = "date", fmt: str = "MM/dd/yyyy") -> DataFrame:
    """Bad dates become null and their rows are dropped."""
    return df.withColumn(name, parsing.parse_date(F.col(name), fmt)).dropna(subset=[name])


def coerce_numeric(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: parsing.to_number(F.col(c), t) for c, t in types.items()
                           if c in df.columns})


def null_out_of_range(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return df.withColumns({lat: parsing.within(F.col(lat), -90, 90),
                           lon: parsing.within(F.col(lon), -180, 180)})


def filter_hs(df: DataFrame, codes: Sequence[int] = tuple(dims.HS_NAMES),
              column: str = "hs_code") -> DataFrame:
    return df.where(F.col(column).isin(list(codes)))


def decade_bucket(df: DataFrame, year: str = "year", out: str = "decade") -> DataFrame:
    return df.withColumn(out, parsing.decade(F.col(year)))


def date_parts(df: DataFrame, column: str = "date",
               parts: Sequence[str] = ("year", "month", "quarter", "weekday")) -> DataFrame:
    c = F.col(column)
    makers = {"year": F.year, "month": F.month, "quarter": F.quarter, "day": F.dayofmonth,
              "hour": F.hour, "weekday": lambda x: F.date_format(x, "EEEE")}
    return df.withColumns({p: makers[p](c) for p in parts})


def tag_source(df: DataFrame, source: str, data_type: str, granularity: str,
               run_date: dt.date | None = None) -> DataFrame:
    """Constant tags; the run date is always an argument, never the wall clock."""
    tags = {"source": F.lit(source), "data_type": F.lit(data_type),
            "granularity": F.lit(granularity)}
    if run_date is not None:
        tags["fetch_date"] = F.lit(run_date)
    return df.withColumns(tags)


def scale_unit(df: DataFrame, source: str = "trade_value_usd", out: str = "trade_value_trillion",
               unit: float = 1e12, digits: int = 4) -> DataFrame:
    return df.withColumn(out, common.round_half_up(F.col(source) / F.lit(unit), digits))


def map_code(df: DataFrame, column: str, names: Mapping[int, str], default: str,
             out: str) -> DataFrame:
    return df.withColumn(out, F.coalesce(common.code_label(F.col(column), names), F.lit(default)))


def with_commodity_name(df: DataFrame, column: str = "hs_code") -> DataFrame:
    return map_code(df, column, dims.HS_NAMES, "Other", "commodity_name")


def clean_trade(raw: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Raw trade rows to ``trade_flows`` without the columns that need other rows."""
    df = rename_columns(drop_columns(raw))
    # what decides which rows stay is cleaned first, the rest of the kept rows afterwards
    early = {*TRADE_KEY, "trade_value_usd"}
    df = coerce_numeric(df, {c: t for c, t in TRADE_TYPES.items() if c in early})
    df = drop_null_required(df, ["trade_value_usd"])
    df = df.withColumn("trade_value_usd", common.round_half_up("trade_value_usd", 2))
    df = dedupe_first(standardize_text(df, trim=()), _present(df, TRADE_KEY), order)
    df = coerce_numeric(df, {c: t for c, t in TRADE_TYPES.items() if c not in early})
    df = standardize_text(fill_constant(df), upper=(), title=())
    df = df.withColumn("value_per_kg", common.safe_ratio(
        F.col("trade_value_usd"), F.col("net_weight_kg"), 4))
    df = scale_unit(decade_bucket(df))
    return tag_source(df, "un_comtrade", "trade_flow", "annual")


def clean_index(raw: DataFrame) -> DataFrame:
    """Raw index rows to one typed row per line with a value and a date."""
    df = rename_columns(raw, INDEX_NAMES)
    df = parse_numeric_text(df, ["bdi_value", "bdi_open", "bdi_high", "bdi_low", "bdi_volume",
                                 "bdi_change_pct"])
    df = zero_to_null(df)
    df = fill_constant(drop_null_required(df, ["bdi_value"]), {"bdi_volume": 0.0})
    return parse_date_text(df)


def weather_derived(df: DataFrame, long_hurricane: bool = False) -> DataFrame:
    """Beaufort force and name, gale and visibility flags."""
    df = df.withColumn("beaufort_number", weather.beaufort_number(F.col("wind_speed_ms")))
    return df.withColumns({
        "beaufort_desc": weather.beaufort_name(F.col("beaufort_number"), long_hurricane),
        "port_risk_flag": weather.gale_risk(F.col("beaufort_number")),
        "low_visibility": weather.low_visibility(F.col("visibility_m")),
    })


def clean_weather(df: DataFrame) -> DataFrame:
    df = fill_constant(fill_from_column(df), WEATHER_DEFAULTS)
    df = weather_derived(df)
    df = df.withColumns({"fetch_date": F.to_date("fetched_at"), "fetch_year": F.year("fetched_at"),
                         "fetch_month": F.month("fetched_at")})
    return tag_source(df, "openweathermap", "port_weather", "daily")


def strait_derived(df: DataFrame) -> DataFrame:
    """Weather columns and the disruption score of strait readings."""
    df = weather_derived(df).withColumnRenamed("port_risk_flag", "weather_risk_flag")
    df = df.withColumn("disruption_score", weather.disruption_score(
        F.col("geopolitical_risk"), F.col("beaufort_number"), F.col("visibility_m")))
    return df.withColumn("risk_level", weather.disruption_level(F.col("disruption_score")))


def vessel_derived(df: DataFrame, variant: str = "daily") -> DataFrame:
    """Decoded codes, speed class and category; ``variant`` is ``daily`` or ``capture``."""
    sog, code = F.col("sog_knots"), F.col("vessel_type")
    if variant == "daily":
        names = {
            "vessel_type_name": F.when(code.isNull() | (code == 0), "Unknown")
            .otherwise(code.cast("int").cast("string")),
            "vessel_category": vessels.category_by_code(code),
            "speed_category": vessels.speed_category(sog),
        }
    else:
        names = {
            "vessel_type_name": vessels.vessel_type_name(code),
            "vessel_category": vessels.category_by_name(vessels.vessel_type_name(code)),
            "speed_category": vessels.speed_category(sog, dims.SPEED_CUTS_CAPTURE),
        }
    names["nav_status_name"] = vessels.nav_status_name(F.col("navigational_status"), variant)
    names["is_moving"] = vessels.is_moving(sog, variant)
    return df.withColumns(names)

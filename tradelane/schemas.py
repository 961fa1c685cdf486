"""Column types per table (DDL). A missing optional source is an empty frame of its type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "trade_flows": "year int, period int, reporter_code int, reporter_iso string, "
                   "reporter_country string, flow_code string, flow_direction string, "
                   "partner_code int, partner_iso string, partner_country string, hs_code int, "
                   "commodity string, aggregation_level int, is_leaf boolean, "
                   "transport_mode_code int, transport_mode string, qty_unit_code int, "
                   "quantity double, qty_estimated boolean, net_weight_kg double, "
                   "weight_estimated boolean, cif_value_usd double, fob_value_usd double, "
                   "trade_value_usd double, is_outlier boolean, trade_balance_usd double, "
                   "decade int, trade_value_trillion double, yoy_growth_pct double, "
                   "source string, data_type string, granularity string",
    "bdi_daily": "date date, bdi_value double, bdi_open double, bdi_high double, bdi_low double, "
                 "bdi_volume double, bdi_change_pct double, daily_change_pct double, "
                 "rolling_7d_avg double, rolling_30d_avg double, rolling_90d_avg double, "
                 "above_long_avg boolean, is_spike boolean, is_drop boolean, is_outlier boolean, "
                 "year int, month int, quarter int, weekday string, source string, "
                 "data_type string, granularity string",
    "port_weather": "port_name string, country_iso string, port_rank int, lat double, lon double, "
                    "fetched_at timestamp, temp_c double, feels_like_c double, humidity_pct int, "
                    "pressure_hpa int, wind_speed_ms double, wind_gust_ms double, wind_deg int, "
                    "visibility_m int, weather_main string, weather_desc string, "
                    "cloudiness_pct int, rain_1h_mm double, snow_1h_mm double, "
                    "sunrise_utc string, sunset_utc string, beaufort_number int, "
                    "beaufort_desc string, port_risk_flag boolean, low_visibility boolean, "
                    "fetch_date date, fetch_year int, fetch_month int, source string, "
                    "data_type string, granularity string",
    "strait_conditions": "strait_name string, lat double, lon double, region string, "
                         "connects string, trade_pct_global int, oil_pct_global int, "
                         "key_routes string, geopolitical_risk string, risk_notes string, "
                         "fetch_date date, fetched_at timestamp, temp_c double, humidity_pct int, "
                         "pressure_hpa int, wind_speed_ms double, wind_gust_ms double, "
                         "wind_deg int, visibility_m int, weather_main string, "
                         "weather_desc string, cloudiness_pct int, rain_1h_mm double, "
                         "beaufort_number int, beaufort_desc string, weather_risk_flag boolean, "
                         "low_visibility boolean, disruption_score int, risk_level string, "
                         "source string, data_type string, granularity string",
    "vessel_movements": "event_time_utc timestamp, capture_utc timestamp, fetch_date date, "
                        "message_type string, mmsi long, ship_name string, imo long, "
                        "call_sign string, latitude double, longitude double, sog_knots double, "
                        "speed_category string, is_moving boolean, cog_degrees double, "
                        "true_heading int, navigational_status int, nav_status_name string, "
                        "destination string, eta string, vessel_type int, "
                        "vessel_type_name string, vessel_category string, port_guess string, "
                        "is_strait boolean, source string, data_type string, granularity string, "
                        "year int, month int, day int, hour int",
    "fuel_prices_daily": "date date, brent_usd_per_bbl double, brent_7d_avg double, "
                         "brent_30d_avg double, fuel_pressure_score double, fuel_signal string, "
                         "vlsfo_est_usd_per_mt double, year int, month int, weekday string, "
                         "fetch_date date, source string",
    "shipping_news": "pub_date timestamp, title string, description string, source_name string, "
                     "url string, risk_level string, risk_score int, relevant_routes string, "
                     "fetch_date date, source_api string",
}

# One weather response: nested objects as the service returns them.
OBSERVATION = (
    "main struct<temp: double, feels_like: double, humidity: int, pressure: int>, "
    "wind struct<speed: double, gust: double, deg: int>, visibility int, "
    "weather array<struct<main: string, description: string>>, clouds struct<all: int>, "
    "rain struct<`1h`: double>, snow struct<`1h`: double>, "
    "sys struct<sunrise: long, sunset: long>"
)
WEATHER_FILE = f"place string, fetched_at timestamp, {OBSERVATION}"
FUEL_FILE = "response struct<data: array<struct<period: string, value: string>>>"
NEWS_FILE = ("articles array<struct<title: string, description: string, publishedAt: string, "
             "url: string, source: struct<name: string>>>")


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[table])

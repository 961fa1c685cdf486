"""Readers of landed files and tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dims, schemas
from ..functions import parsing
from ..operators.cleaning import (WEATHER_DEFAULTS, clean_weather, fill_constant,
                                  fill_from_column, strait_derived, tag_source)

# File name patterns of a trade download.
TRADE_PATTERNS = ["TradeData*.csv", "un_comtrade*.csv", "comtrade*.csv"]

POSITION = "_position"


def file_position() -> Column:
    """Where a row stands in its files: path, block, and number within the block as it is read."""
    return F.struct("_metadata.file_path", "_metadata.file_block_start",
                    F.monotonically_increasing_id().alias("row"))


def _placed(df: DataFrame, position: bool) -> DataFrame:
    return df.withColumn(POSITION, file_position()) if position else df


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(str(f.getPath()) for f in found) if found is not None else []


def path_exists(spark: SparkSession, path: str) -> bool:
    return bool(_glob(spark, path))


def _by_header(spark: SparkSession, files: list[str]) -> list[list[str]]:
    """The files in groups of equal first lines, in the order of their names."""
    lines = spark.read.option("encoding", "ISO-8859-1").text(files).select(
        "value", F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    # one row per file comes back
    heads = lines.where("block = 0").groupBy("path").agg(F.min_by("value", "row").alias("head")).collect()
    groups: dict[str, list[str]] = {}
    for r in sorted(heads, key=lambda r: r.path):
        groups.setdefault(r["head"], []).append(r.path)
    return list(groups.values())


def src_trade_csv(spark: SparkSession, folder: str,
                  patterns: Sequence[str] = tuple(TRADE_PATTERNS), newest_only: bool = False,
                  position: bool = False) -> DataFrame:
    """Every file or folder of files that matches a pattern; every column as text.

    Files may differ in their columns, which are matched by name. ``newest_only`` reads the last
    one in name order only. ``position`` adds where in its file a row stands.
    """
    files = sorted({f for pattern in patterns for f in _glob(spark, f"{folder}/{pattern}")},
                   key=lambda f: f.rsplit("/", 1)[-1])
    if not files:
        raise FileNotFoundError(f"no trade file in {folder}")
    parts = [_placed(spark.read.option("header", True).option("encoding", "ISO-8859-1").csv(group), position)
             for group in _by_header(spark, files[-1:] if newest_only else files)]
    if not parts:
        raise ValueError(f"only empty trade files in {folder}")
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def src_index_csv(spark: SparkSession, path: str, position: bool = False) -> DataFrame:
    """Index download as text columns; ``clean_index`` types them."""
    return _placed(spark.read.option("header", True).csv(path), position)


def _observation() -> dict[str, Column]:
    """Flat weather columns of one response."""
    first = F.try_element_at("weather", F.lit(1))
    return {
        "temp_c": F.col("main.temp"), "feels_like_c": F.col("main.feels_like"),
        "humidity_pct": F.col("main.humidity"), "pressure_hpa": F.col("main.pressure"),
        "wind_speed_ms": F.col("wind.speed"), "wind_gust_ms": F.col("wind.gust"),
        "wind_deg": F.col("wind.deg"), "visibility_m": F.col("visibility"),
        "weather_main": first["main"], "weather_desc": first["description"],
        "cloudiness_pct": F.col("clouds.all"), "rain_1h_mm": F.col("rain.1h"),
        "snow_1h_mm": F.col("snow.1h"),
        "sunrise_utc": parsing.unix_to_hhmm(F.col("sys.sunrise")),
        "sunset_utc": parsing.unix_to_hhmm(F.col("sys.sunset")),
    }


def _weather_lines(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema(schemas.WEATHER_FILE).json(path)
    return raw.select("place", "fetched_at", *[c.alias(n) for n, c in _observation().items()])


def src_weather_json(spark: SparkSession, path: str, ports: DataFrame | None = None) -> DataFrame:
    """Landed port readings to ``port_weather`` rows.

    ``ports`` is a dimension of any size with ``port_name``; a place that is not in it stays, with
    nulls for what the dimension would tell.
    """
    ports = (dims.ports(spark) if ports is None else ports).withColumnRenamed("port_name", "place")
    rows = _weather_lines(spark, path).join(ports, "place", "left").withColumnRenamed("place", "port_name")
    return clean_weather(rows)


def src_strait_json(spark: SparkSession, path: str, straits: DataFrame | None = None) -> DataFrame:
    """Landed strait readings to ``strait_conditions`` rows with their score; unknown places stay."""
    straits = (dims.straits(spark) if straits is None else straits).withColumnRenamed("strait_name", "place")
    rows = _weather_lines(spark, path).join(straits, "place", "left").withColumnRenamed(
        "place", "strait_name")
    rows = strait_derived(fill_constant(fill_from_column(rows), WEATHER_DEFAULTS))
    rows = rows.withColumn("fetch_date", F.to_date("fetched_at"))
    return tag_source(rows, "openweathermap", "strait_conditions", "daily")


def parse_ais(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row per vessel message, also for text that is no valid message.

    The payload is found under the message's own type name. Fields that come under
    several names take the first one present. Works on batch and streaming frames.
    """
    pairs = "map<string,string>"
    df = lines.withColumn("_top", F.from_json(column, pairs))
    df = df.withColumns({
        "message_type": F.try_element_at("_top", F.lit("MessageType")),
        "_meta": F.from_json(F.coalesce(F.try_element_at("_top", F.lit("MetaData")),
                                        F.try_element_at("_top", F.lit("Metadata"))), pairs),
        "_body": F.from_json(F.try_element_at("_top", F.lit("Message")),
                             f"map<string,{pairs}>"),
    }).withColumn("_body", F.try_element_at("_body", F.col("message_type")))

    def first(*places: tuple[str, str]) -> Column:
        return F.coalesce(*[F.try_element_at(f"_{where}", F.lit(name)) for where, name in places])

    def number(value: Column, kind: str = "double") -> Column:
        return parsing.to_number(value, kind)

    return df.select(
        *[c for c in lines.columns if c != column],
        "message_type",
        number(first(("meta", "MMSI"), ("meta", "UserID"), ("body", "UserID")), "long")
        .alias("mmsi"),
        first(("meta", "ShipName"), ("body", "Name")).alias("ship_name"),
        number(first(("meta", "IMO"), ("body", "ImoNumber")), "long").alias("imo"),
        first(("body", "CallSign")).alias("call_sign"),
        number(first(("meta", "latitude"), ("meta", "Latitude"), ("body", "Latitude")))
        .alias("latitude"),
        number(first(("meta", "longitude"), ("meta", "Longitude"), ("body", "Longitude")))
        .alias("longitude"),
        number(first(("body", "Sog"), ("body", "SpeedOverGround"))).alias("sog_knots"),
        number(first(("body", "Cog"), ("body", "CourseOverGround"))).alias("cog_degrees"),
        number(first(("body", "TrueHeading")), "int").alias("true_heading"),
        number(first(("body", "NavigationalStatus")), "int").alias("navigational_status"),
        first(("body", "Destination")).alias("destination"),
        first(("body", "Eta")).alias("eta"),
        number(first(("body", "Type"), ("body", "TypeOfShipAndCargo")), "int")
        .alias("vessel_type"),
        F.try_to_timestamp(first(("meta", "time_utc"), ("meta", "time"), ("meta", "Timestamp")))
        .alias("event_time_utc"),
        F.col("message_type").isNull().alias("malformed"),
    )


def src_ais_jsonl(spark: SparkSession, path: str, position: bool = False) -> DataFrame:
    return parse_ais(_placed(spark.read.text(path), position))


def src_fuel_json(spark: SparkSession, path: str, position: bool = False) -> DataFrame:
    """Price rows of every landed response; rows without a date or a number are dropped."""
    raw = _placed(spark.read.schema(schemas.FUEL_FILE).json(path), position)
    own = [POSITION] if position else []
    rows = raw.select(*own, F.posexplode("response.data").alias("nth", "x"))
    place = [F.struct(POSITION, "nth").alias(POSITION)] if position else []
    return rows.select(
        F.to_date(F.try_to_timestamp("x.period")).alias("date"),
        parsing.to_number(F.col("x.value")).alias("brent_usd_per_bbl"), *place,
    ).dropna(subset=["date", "brent_usd_per_bbl"])


def src_news_json(spark: SparkSession, path: str) -> DataFrame:
    """Article rows of every landed response, ready for ``clean_news``."""
    raw = spark.read.schema(schemas.NEWS_FILE).json(path)
    return raw.select(F.inline("articles")).select(
        "title", "description", "publishedAt", "url", F.col("source.name").alias("source_name"))


def src_clean_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A cleaned CSV with its fixed types; a missing file is an empty frame."""
    if not path_exists(spark, path):
        return schemas.empty(spark, table)
    return (spark.read.schema(schemas.SCHEMAS[table]).option("header", True)
            .option("nanValue", "nan").csv(path))


def src_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None,
              schema_of: str | None = None) -> DataFrame:
    """A warehouse table with lower-case names; a missing one is empty if its type is known."""
    try:
        df = spark.table(name)
    except AnalysisException:
        if schema_of is None:
            raise
        df = schemas.empty(spark, schema_of)
    df = df.toDF(*[c.lower() for c in df.columns])
    return df.select(*columns) if columns else df


def src_fallback(spark: SparkSession, primary: str, secondary: str, table: str) -> DataFrame:
    """The daily file when it is there, else the static one."""
    return src_clean_csv(spark, primary if path_exists(spark, primary) else secondary, table)


def src_route_config(spark: SparkSession) -> DataFrame:
    return dims.route_config(spark)

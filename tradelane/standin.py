"""Domain tables as lazy views over the benchmark's Parquet tables.

The benchmark has no trade, weather or vessel tables, so each one is derived here
from TPC-H-like tables, ``events`` and ``documents``, always over the whole table.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import dims
from .functions.common import money_sum
from .operators import cleaning, geo, series
from .operators.news import clean_news
from .session import stored

# Dollars per "billion" and "trillion" that suit the size of the stand-in trade.
BILLION = 1e5
TRILLION = 1e8

# Words with known hits in the stand-in documents.
NEWS_KEYWORDS = ["tion", "ment", "heit", "free", "license", "apache", "token"]
NEWS_ROUTES = {
    "Asia-Europe via Suez": ["tion"],
    "Strait of Hormuz": ["ment", "free"],
    "Strait of Malacca": ["token"],
    "Black Sea": ["heit"],
    "Trans-Pacific": ["license", "apache"],
    "North Sea / Dover": ["ing ", "the "],
}

# Event type to ship type code and to weather word.
VESSEL_CODES = {"view": 70, "click": 80, "purchase": 60, "signup": 30}
WEATHER_WORDS = {"view": "Clear", "click": "Clouds", "purchase": "Rain", "signup": "Mist",
                 "error": "Thunderstorm"}

FOCUS_COUNTRY = "N07"


def _case(column: str, names: dict, otherwise=None):
    out = None
    for key, value in names.items():
        test = F.col(column) == key
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(otherwise)


def _country(key: str):
    return F.concat(F.lit("N"), F.lpad(F.col(key).cast("string"), 2, "0"))


# Column types of the benchmark tables, so that no read has to infer them.
TABLE_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
              "props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "benchmark": "item_id long, text string",
}


class Standin:
    """Lazy domain tables of one data folder. Nothing is cached or collected, or stored unless ``settle_trade`` is called."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.schema(TABLE_SCHEMAS[name]).parquet(
                f"{self.dir}/{name}.parquet")
        return self._tables[name]

    # trade -----------------------------------------------------------------
    @cached_property
    def trade_rows(self) -> DataFrame:
        """One trade row per line item, with the keys that give the rows an order."""
        codes = {"ECONOMY": 10, "LARGE": 26, "MEDIUM": 27, "PROMO": 72, "SMALL": 89}
        nation = self.table("nation")
        # what a line item needs of its order and part is made first, so that line items are dealt twice only
        orders = self.table("orders").join(
            self.table("customer"), F.col("o_custkey") == F.col("c_custkey")).select(
                "o_orderkey", F.year("o_orderdate").alias("year"), "c_nationkey")
        part = self.table("part").select("p_partkey", _case("p_type", codes, 99).alias("hs_code"))
        return (
            self.table("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(part, F.col("l_partkey") == F.col("p_partkey"))
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                _country("c_nationkey").alias("reporter_iso"),
                F.col("n_name").alias("reporter_country"),
                F.lit("W00").alias("partner_iso"),
                "hs_code",
                F.when(F.col("l_returnflag") == "R", "Import").otherwise("Export")
                .alias("flow_direction"),
                "year",
                F.col("l_extendedprice").alias("trade_value_usd"),
                F.when(F.col("l_quantity") > 1, F.col("l_quantity")).alias("net_weight_kg"),
                "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
            )
        )

    def settle_trade(self) -> Standin:
        """The trade rows written once, for a query that goes over them several times."""
        self.trade_rows = stored(self.trade_rows, "trade-rows")
        return self

    @cached_property
    def trade_flows(self) -> DataFrame:
        df = self.trade_rows.drop("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                  "l_shipdate")
        return cleaning.with_commodity_name(df).withColumn("commodity", F.col("commodity_name"))

    @cached_property
    def trade_raw(self) -> DataFrame:
        """Trade rows the way a download has them: raw names, text codes, gaps."""
        no = F.col("l_linenumber")
        return self.trade_rows.select(
            F.lit("C").alias("typeCode"), F.lit("A").alias("freqCode"),
            F.concat(F.lit(" "), F.lower("reporter_iso"), F.lit(" ")).alias("reporterISO"),
            F.concat("reporter_country", F.lit(" ")).alias("reporterDesc"),
            F.lit("w00").alias("partnerISO"),
            F.when((no == 7) & (F.col("hs_code") == 99), "n/a")
            .otherwise(F.col("hs_code").cast("string")).alias("cmdCode"),
            F.when(no == 5, " re-export").otherwise(F.lower("flow_direction")).alias("flowDesc"),
            F.col("year").cast("string").alias("refYear"),
            F.when(F.col("net_weight_kg").isNull() | (F.col("net_weight_kg") < 50),
                   F.col("trade_value_usd")).alias("primaryValue"),
            F.col("net_weight_kg").alias("netWgt"),
            F.when(no != 1, "Sea").alias("motDesc"),
            F.when(no != 2, F.col("net_weight_kg")).alias("qty"),
            F.when(no != 3, F.lit(False)).alias("isNetWgtEstimated"),
            F.lit(None).cast("string").alias("qtyUnitAbbr"),
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
        )

    TRADE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
                   "trade_value_usd")

    @cached_property
    def trade_unique(self) -> DataFrame:
        """First line item per trade key, as the cleaned trade table has it."""
        return cleaning.dedupe_first(self.trade_rows, cleaning.TRADE_KEY,
                                     [F.col(c) for c in self.TRADE_ORDER])

    # daily series ------------------------------------------------------------
    @cached_property
    def index_daily(self) -> DataFrame:
        return (self.table("orders").groupBy(F.to_date("o_orderdate").alias("date"))
                .agg((money_sum(F.col("o_totalprice")) / F.count("*")).alias("bdi_value")))

    @cached_property
    def index_raw(self) -> DataFrame:
        """The index as downloaded text: thousands commas, percent signs, K and M volumes."""
        cents = F.floor(F.col("bdi_value") * 100)
        price = F.concat(F.format_number(F.floor(cents / 100), 0), F.lit("."),
                         F.lpad(F.pmod(cents, F.lit(100)).cast("string"), 2, "0"))
        day = F.dayofmonth("date")
        volume = _case("_d5", {0: "1.5K", 1: "12K", 2: "3M", 3: "", 4: "abc"})
        return self.index_daily.withColumns({"_d5": F.pmod(day, F.lit(5)), "_p": price}).select(
            F.when(day == 29, "13/45/2020").otherwise(F.date_format("date", "MM/dd/yyyy"))
            .alias("Date"),
            F.when(day != 30, F.col("_p")).alias("Price"),
            F.when(F.col("_d5") == 0, "0").otherwise(F.col("_p")).alias("Open"),
            F.col("_p").alias("High"), F.lit("0").alias("Low"), volume.alias("Vol."),
            F.concat(day.cast("string"), F.lit(".25%")).alias("Change %"))

    @cached_property
    def bdi_daily(self) -> DataFrame:
        return series.enrich_index(self.index_daily)

    @cached_property
    def fuel_raw(self) -> DataFrame:
        price = money_sum(F.col("l_extendedprice")) / F.sum("l_quantity") / 20
        return (self.table("lineitem").groupBy(F.to_date("l_shipdate").alias("date"))
                .agg(price.alias("brent_usd_per_bbl")))

    @cached_property
    def fuel(self) -> DataFrame:
        return series.enrich_fuel(self.fuel_raw)

    # vessels -----------------------------------------------------------------
    @cached_property
    def vessel_rows(self) -> DataFrame:
        return vessel_rows(self.table("events"))

    @cached_property
    def vessels(self) -> DataFrame:
        """Decoded positions of every event, labelled with a place."""
        df = geo.locate_bbox(cleaning.vessel_derived(self.vessel_rows))
        return geo.is_strait(df)

    @cached_property
    def vessels_daily(self) -> DataFrame:
        """Last position per vessel and day."""
        return cleaning.dedupe_latest(self.vessels, ["mmsi", "fetch_date"], "event_time_utc",
                                      ["event_id"])

    # weather -----------------------------------------------------------------
    @cached_property
    def port_weather_rows(self) -> DataFrame:
        """A reading per event; the supplier of the user's number gives the country, if there is one."""
        supplier = self.table("supplier").select("s_suppkey", "s_nationkey")
        events = self.table("events")
        names = F.array(*[F.lit(p[0]) for p in dims.PORTS])
        key = F.col("user_id")
        base = F.get(names, F.pmod(key, F.lit(100)).cast("int"))
        turn = F.floor(key / 100).cast("string")
        rows = events.join(supplier, key == F.col("s_suppkey"), "left").withColumn(
            "s_nationkey", F.coalesce("s_nationkey", F.pmod(key, F.lit(25)).cast("int")))
        return rows.select(
            F.when(key < 100, base).otherwise(F.concat(base, F.lit(" #"), turn))
            .alias("port_name"),
            _country("s_nationkey").alias("country_iso"),
            (key + 1).cast("int").alias("port_rank"),
            F.to_date("ts").alias("fetch_date"), F.col("ts").alias("fetched_at"), "event_id",
            *_weather_columns())

    @cached_property
    def port_weather(self) -> DataFrame:
        return cleaning.weather_derived(self.port_weather_rows)

    @cached_property
    def strait_rows(self) -> DataFrame:
        dim = dims.local_table(
            self.spark, [(i, *s) for i, s in enumerate(dims.STRAITS)],
            "strait_no int, strait_name string, lat double, lon double, region string, "
            "connects string, trade_pct_global int, oil_pct_global int, key_routes string, "
            "geopolitical_risk string, risk_notes string")
        events = self.table("events").select(
            F.pmod("user_id", F.lit(8)).cast("int").alias("strait_no"),
            F.to_date("ts").alias("fetch_date"), F.col("ts").alias("fetched_at"), "event_id",
            *_weather_columns())
        return events.join(F.broadcast(dim), "strait_no").drop("strait_no")

    @cached_property
    def strait_conditions(self) -> DataFrame:
        return cleaning.strait_derived(self.strait_rows)

    # news --------------------------------------------------------------------
    @cached_property
    def articles(self) -> DataFrame:
        """Every document as an article: the whole text is the title."""
        minutes = F.lit("2024-01-01T00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
            mins=F.col("doc_id").cast("int"))
        return self.table("documents").select(
            "doc_id", F.col("text").alias("title"),
            F.concat_ws(" ", "lang", "source").alias("description"), "source",
            F.when(F.col("doc_id") == 13, "not a date").otherwise(
                F.date_format(minutes, "yyyy-MM-dd'T'HH:mm:ss")).alias("publishedAt"),
            F.col("source").alias("source_name"),
            F.concat(F.lit("https://example.com/"), F.col("doc_id").cast("string")).alias("url"))

    @cached_property
    def news(self) -> DataFrame:
        return clean_news(self.articles, order=("doc_id",), keywords=NEWS_KEYWORDS,
                          routes=NEWS_ROUTES)


def _weather_columns() -> list:
    """Weather readings of one event."""
    return [
        (F.col("value") / 10).alias("wind_speed_ms"),
        F.pmod(F.col("event_id") * 53, F.lit(11000)).cast("int").alias("visibility_m"),
        (F.pmod("event_id", F.lit(400)) / 10 - 5).alias("temp_c"),
        F.pmod("event_id", F.lit(101)).cast("int").alias("humidity_pct"),
        _case("event_type", WEATHER_WORDS).alias("weather_main"),
    ]


def vessel_rows(events: DataFrame) -> DataFrame:
    """One position per event; works on a batch or a streaming frame."""
    k = F.get_json_object("props", "$.k").cast("int")
    digit = F.pmod(k, F.lit(10))
    destination = (F.when(digit == 0, "").when(digit == 1, "@@@@").when(digit == 2, None)
                   .otherwise(F.concat(F.lit(" Port "), k.cast("string"), F.lit(" "))))
    return events.select(
        "event_id", F.col("user_id").alias("mmsi"), F.col("ts").alias("event_time_utc"),
        F.to_date("ts").alias("fetch_date"), (F.col("value") / 10).alias("sog_knots"),
        _case("event_type", VESSEL_CODES).cast("int").alias("vessel_type"),
        (F.pmod(F.col("event_id") * 37, F.lit(6500)) / 100 - 10).alias("latitude"),
        (F.pmod(F.col("event_id") * 91, F.lit(27000)) / 100 - 125).alias("longitude"),
        F.pmod(k, F.lit(17)).alias("navigational_status"), destination.alias("destination"))

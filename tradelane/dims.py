"""Ports, straits, boxes, code maps, keyword lists and routes.

Everything here is data that results depend on, so it is stated as plain text.
The helpers at the end turn the tables into small DataFrames; their size is the
length of the list beside them, so broadcasting them is always safe.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Ports by container throughput (rank order, country ISO-2, lat, lon).
PORTS = [
    ("Shanghai", "CN", 31.2304, 121.4737),
    ("Singapore", "SG", 1.2966, 103.8006),
    ("Ningbo-Zhoushan", "CN", 29.8683, 121.5440),
    ("Shenzhen", "CN", 22.5431, 114.0579),
    ("Guangzhou", "CN", 23.1291, 113.2644),
    ("Busan", "KR", 35.1796, 129.0756),
    ("Tianjin", "CN", 39.3434, 117.3616),
    ("Hong Kong", "HK", 22.3193, 114.1694),
    ("Rotterdam", "NL", 51.9225, 4.4792),
    ("Dubai", "AE", 24.9965, 55.0272),
    ("Port Klang", "MY", 3.0000, 101.4000),
    ("Antwerp", "BE", 51.2194, 4.4025),
    ("Xiamen", "CN", 24.4798, 118.0894),
    ("Los Angeles", "US", 33.7290, -118.262),
    ("Hamburg", "DE", 53.5753, 10.0153),
    ("Long Beach", "US", 33.7548, -118.2164),
    ("Tanjung Pelepas", "MY", 1.3634, 103.5521),
    ("Kaohsiung", "TW", 22.6273, 120.3014),
    ("Dalian", "CN", 38.9140, 121.6147),
    ("New York", "US", 40.6943, -74.1239),
    ("Tanjung Priok", "ID", -6.1000, 106.8800),
    ("Colombo", "LK", 6.9271, 79.8612),
    ("Valencia", "ES", 39.4561, -0.3230),
    ("Laem Chabang", "TH", 13.0800, 100.8800),
    ("Algeciras", "ES", 36.1408, -5.4531),
    ("Ho Chi Minh City", "VN", 10.7769, 106.7009),
    ("Bremen/Bremerhaven", "DE", 53.5396, 8.5809),
    ("Jawaharlal Nehru", "IN", 18.9500, 72.9500),
    ("Qingdao", "CN", 36.0671, 120.3826),
    ("Felixstowe", "GB", 51.9500, 1.3500),
    ("Tanjung Pelepas 2", "MY", 1.3500, 103.5500),
    ("Manila", "PH", 14.5764, 120.9653),
    ("Lianyungang", "CN", 34.7500, 119.4400),
    ("Tokyo", "JP", 35.6262, 139.7736),
    ("Yokohama", "JP", 35.4437, 139.6380),
    ("Osaka", "JP", 34.6540, 135.4300),
    ("Nagoya", "JP", 35.0500, 136.8833),
    ("Kobe", "JP", 34.6901, 135.1956),
    ("Suzhou", "CN", 31.3100, 120.6200),
    ("Wuhan", "CN", 30.5928, 114.3055),
    ("Jebel Ali", "AE", 24.9994, 55.0540),
    ("Salalah", "OM", 16.9400, 54.0000),
    ("Piraeus", "GR", 37.9417, 23.6464),
    ("Genoa", "IT", 44.4056, 8.9463),
    ("Barcelona", "ES", 41.3700, 2.1600),
    ("Marseille", "FR", 43.2965, 5.3698),
    ("Le Havre", "FR", 49.4938, 0.1077),
    ("Gioia Tauro", "IT", 38.4300, 15.8900),
    ("Ambarli", "TR", 40.9500, 28.6900),
    ("Istanbul", "TR", 41.0082, 28.9784),
    ("Mersin", "TR", 36.8000, 34.6333),
    ("Haifa", "IL", 32.8191, 34.9983),
    ("Alexandria", "EG", 31.2001, 29.9187),
    ("Damietta", "EG", 31.4167, 31.8167),
    ("Casablanca", "MA", 33.5731, -7.5898),
    ("Mombasa", "KE", -4.0500, 39.6700),
    ("Durban", "ZA", -29.8587, 31.0218),
    ("Lagos", "NG", 6.4500, 3.4000),
    ("Abidjan", "CI", 5.3167, -4.0333),
    ("Dakar", "SN", 14.6928, -17.4467),
    ("Santos", "BR", -23.9608, -46.3336),
    ("Buenos Aires", "AR", -34.6037, -58.3816),
    ("Cartagena", "CO", 10.3910, -75.4794),
    ("Colon", "PA", 9.3500, -79.9000),
    ("Callao", "PE", -12.0500, -77.1500),
    ("Vancouver", "CA", 49.2827, -123.1207),
    ("Montreal", "CA", 45.5017, -73.5673),
    ("Baltimore", "US", 39.2904, -76.6122),
    ("Savannah", "US", 32.0835, -81.0998),
    ("Norfolk", "US", 36.8508, -76.2859),
    ("Seattle", "US", 47.6062, -122.3321),
    ("Tacoma", "US", 47.2529, -122.4443),
    ("Houston", "US", 29.7604, -95.3698),
    ("Miami", "US", 25.7617, -80.1918),
    ("Incheon", "KR", 37.4563, 126.7052),
    ("Gwangyang", "KR", 34.9000, 127.7000),
    ("Chittagong", "BD", 22.3569, 91.7832),
    ("Karachi", "PK", 24.8607, 67.0011),
    ("Mumbai", "IN", 18.9667, 72.8333),
    ("Chennai", "IN", 13.0827, 80.2707),
    ("Mundra", "IN", 22.8390, 69.7220),
    ("Vizag", "IN", 17.6868, 83.2185),
    ("Colombo 2", "LK", 6.9500, 79.8700),
    ("Klang 2", "MY", 2.9900, 101.3900),
    ("Penang", "MY", 5.4164, 100.3327),
    ("Batam", "ID", 1.0456, 104.0305),
    ("Surabaya", "ID", -7.2575, 112.7521),
    ("Bangkok", "TH", 13.7563, 100.5018),
    ("Haiphong", "VN", 20.8449, 106.6881),
    ("Da Nang", "VN", 16.0544, 108.2022),
    ("Guangzhou Nansha", "CN", 22.7600, 113.5800),
    ("Yingkou", "CN", 40.6600, 122.2300),
    ("Rizhao", "CN", 35.4200, 119.5300),
    ("Nanjing", "CN", 32.0603, 118.7969),
    ("Chongqing", "CN", 29.5630, 106.5516),
    ("Taichung", "TW", 24.1477, 120.6736),
    ("Keelung", "TW", 25.1276, 121.7392),
    ("Tauranga", "NZ", -37.6878, 176.1651),
    ("Melbourne", "AU", -37.8136, 144.9631),
    ("Sydney", "AU", -33.8688, 151.2093),
]

# ISO-3166 two-letter to three-letter codes of the port countries.
ISO2_TO_ISO3 = {
    "AE": "ARE", "AR": "ARG", "AU": "AUS", "BD": "BGD", "BE": "BEL", "BR": "BRA", "CA": "CAN",
    "CI": "CIV", "CN": "CHN", "CO": "COL", "DE": "DEU", "EG": "EGY", "ES": "ESP", "FR": "FRA",
    "GB": "GBR", "GR": "GRC", "HK": "HKG", "ID": "IDN", "IL": "ISR", "IN": "IND", "IT": "ITA",
    "JP": "JPN", "KE": "KEN", "KR": "KOR", "LK": "LKA", "MA": "MAR", "MY": "MYS", "NG": "NGA",
    "NL": "NLD", "NZ": "NZL", "OM": "OMN", "PA": "PAN", "PE": "PER", "PH": "PHL", "PK": "PAK",
    "SG": "SGP", "SN": "SEN", "TH": "THA", "TR": "TUR", "TW": "TWN", "US": "USA", "VN": "VNM",
    "ZA": "ZAF",
}

# Straits (name, lat, lon, region, connects, trade %, oil %, routes, geo risk, notes).
STRAITS = [
    ("Strait of Hormuz", 26.5679, 56.2580, "Middle East", "Persian Gulf → Arabian Sea", 20, 20,
     "Persian Gulf oil → Asia/Europe", "High",
     "~20% global oil trade; Iran-Saudi tensions; US-Iran friction"),
    ("Strait of Malacca", 1.2500, 103.8200, "Southeast Asia", "Indian Ocean → South China Sea", 25, 15,
     "Middle East/Europe → China/Japan/Korea", "Medium",
     "Busiest strait globally; piracy risk; Singapore alternative"),
    ("Suez Canal", 30.5234, 32.3511, "Middle East / Africa", "Red Sea → Mediterranean", 12, 8,
     "Asia/Middle East → Europe", "High",
     "Houthi attacks forcing Cape of Good Hope rerouting since late 2023"),
    ("Bab el-Mandeb", 12.5842, 43.4298, "Red Sea / Yemen", "Red Sea → Gulf of Aden", 10, 6,
     "Suez Canal approach from south", "Very High",
     "Houthi missile/drone attacks on commercial vessels; major rerouting"),
    ("Strait of Gibraltar", 35.9727, -5.5715, "Europe / Africa", "Atlantic Ocean → Mediterranean", 10, 5,
     "Atlantic ↔ Mediterranean / Northern Europe ↔ Asia via Suez", "Low",
     "Weather risk in winter; high traffic density"),
    ("Bosphorus Strait", 41.1237, 29.0532, "Turkey / Black Sea", "Black Sea → Mediterranean", 4, 3,
     "Russia/Ukraine grain and oil → Europe", "High",
     "Russia-Ukraine war; Black Sea grain exports; Turkish transit control"),
    ("Strait of Dover", 51.0960, 1.4220, "Northern Europe", "English Channel → North Sea", 8, 2,
     "UK/North Europe ↔ Atlantic/Mediterranean", "Low",
     "Busiest shipping lane by vessel count; fog and winter weather risk"),
    ("Lombok Strait", -8.7717, 115.7542, "Southeast Asia", "Indian Ocean → Java Sea", 3, 2,
     "Malacca alternative for deep-draft vessels (VLCCs)", "Low",
     "VLCC alternative to Malacca; deeper water allows fully laden supertankers"),
]
STRAIT_COLUMNS = ["strait_name", "lat", "lon", "region", "connects", "trade_pct_global",
                  "oil_pct_global", "key_routes", "geopolitical_risk", "risk_notes"]

# Labelled boxes in priority order (label, lat min, lat max, lon min, lon max).
LOCATION_BOXES = [
    ("Strait of Hormuz", 22.0, 30.0, 50.0, 60.0),
    ("Strait of Malacca", -2.0, 5.0, 98.0, 106.0),
    ("Suez Canal", 27.0, 33.0, 29.0, 37.0),
    ("Bab el-Mandeb", 8.0, 16.0, 40.0, 50.0),
    ("Strait of Gibraltar", 34.0, 38.0, -8.0, -1.0),
    ("Bosphorus Strait", 39.0, 43.0, 26.0, 32.0),
    ("Strait of Dover", 49.5, 52.5, -2.0, 3.5),
    ("Lombok Strait", -9.5, -5.0, 114.0, 118.5),
    ("Red Sea", 12.0, 28.0, 32.0, 44.0),
    ("Arabian Sea", 5.0, 25.0, 50.0, 75.0),
    ("Shanghai", 29.5, 32.5, 120.0, 123.0),
    ("Singapore", 0.0, 2.5, 102.5, 105.0),
    ("Shenzhen", 21.0, 24.0, 112.5, 115.5),
    ("Busan", 33.5, 36.5, 127.5, 130.5),
    ("Hong Kong", 21.0, 23.5, 113.0, 115.5),
    ("Rotterdam", 50.5, 53.0, 3.0, 6.0),
    ("Dubai", 23.5, 26.5, 53.5, 57.0),
    ("Los Angeles", 32.0, 35.0, -120.0, -117.0),
    ("New York", 39.0, 41.5, -75.5, -73.0),
    ("Tokyo", 34.5, 36.5, 139.0, 141.5),
    ("Mumbai", 18.0, 20.5, 72.0, 74.0),
]
BOX_COLUMNS = ["label", "lat_min", "lat_max", "lon_min", "lon_max"]

# Box labels that count as straits.
STRAIT_LABELS = ["Strait of Hormuz", "Strait of Malacca", "Suez Canal", "Bab el-Mandeb",
                 "Strait of Gibraltar", "Bosphorus Strait", "Strait of Dover", "Lombok Strait",
                 "Red Sea", "Arabian Sea"]

# The six straits shown in the traffic trend panel.
KEY_STRAITS = ["Strait of Hormuz", "Strait of Malacca", "Suez Canal", "Bab el-Mandeb",
               "Bosphorus Strait", "Strait of Gibraltar"]

# Beaufort limits (m/s, lower bound of force 1..12) and names of force 0..12.
BEAUFORT_LIMITS = [0.3, 1.6, 3.4, 5.5, 8.0, 10.8, 13.9, 17.2, 20.8, 24.5, 28.5, 32.7]
BEAUFORT_NAMES = ["Calm", "Light air", "Light breeze", "Gentle breeze", "Moderate breeze",
                  "Fresh breeze", "Strong breeze", "Near gale", "Gale", "Strong gale", "Storm",
                  "Violent storm", "Hurricane"]
HURRICANE_LONG_NAME = "Hurricane force"

# Points added per geopolitical risk word.
GEO_POINTS = {"Very High": 40, "High": 25, "Medium": 10, "Low": 0}

# AIS ship type codes, long decode table.
VESSEL_TYPE_NAMES = {
    0: "Not available", 9: "Helicopter", 13: "SAR aircraft", 20: "Wing in ground",
    24: "Pilot vessel", 25: "SAR vessel", 26: "Tug", 27: "Port tender",
    28: "Vessel (anti-pollution)", 29: "Law enforcement", 30: "Fishing vessel",
    31: "Towing vessel", 32: "Towing (long/wide)", 33: "Dredger", 34: "Dive ops vessel",
    35: "Military vessel", 36: "Sailing vessel", 37: "Pleasure craft", 40: "High-speed craft",
    41: "High-speed craft", 50: "Pilot vessel", 51: "SAR vessel", 52: "Tug", 53: "Port tender",
    54: "Anti-pollution vessel", 55: "Law enforcement", 57: "Medical transport",
    58: "Non-combatant ship", 59: "Passenger ferry", 60: "Passenger ship", 61: "Passenger ship",
    62: "Passenger ship", 63: "Passenger ship", 69: "Passenger ship (other)",
    70: "Cargo vessel", 71: "Cargo vessel (hazmat A)", 72: "Cargo vessel (hazmat B)",
    73: "Cargo vessel (hazmat C)", 74: "Cargo vessel (hazmat D)", 77: "Cargo vessel",
    79: "Cargo vessel (other)", 80: "Tanker", 81: "Tanker (hazmat A)", 82: "Tanker (hazmat B)",
    83: "Tanker (hazmat C)", 84: "Tanker (hazmat D)", 89: "Tanker (other)",
    90: "Other vessel type", 99: "Other vessel type",
}

# AIS navigational status, daily job and one-off capture variants.
NAV_STATUS_DAILY = {
    0: "Under way using engine", 1: "At anchor", 2: "Not under command",
    3: "Restricted manoeuvrability", 4: "Constrained by draught", 5: "Moored", 6: "Aground",
    7: "Engaged in fishing", 8: "Under way sailing", 15: "Not reported",
}
NAV_STATUS_CAPTURE = {
    0: "Under way using engine", 1: "At anchor", 2: "Not under command",
    3: "Restricted manoeuvrability", 4: "Constrained by draught", 5: "Moored", 6: "Aground",
    7: "Engaged in fishing", 8: "Under way sailing", 9: "Reserved (HSC)", 10: "Reserved (WIG)",
    11: "Power-driven vessel towing astern", 12: "Power-driven vessel pushing ahead",
    13: "Reserved", 14: "AIS SART active", 15: "Not defined",
}

# Ship type code ranges (first, last, category).
VESSEL_CODE_RANGES = [(70, 79, "Cargo"), (80, 89, "Tanker"), (60, 69, "Passenger"),
                      (30, 35, "Fishing"), (50, 59, "Tug / Support")]

# Words looked for in a ship type name, first match wins.
VESSEL_NAME_WORDS = [("tanker", "Tanker"), ("cargo", "Cargo"), ("tug", "Tug / Support"),
                     ("fishing", "Fishing"), ("passenger", "Passenger"), ("pilot", "Pilot / SAR"),
                     ("sar", "Pilot / SAR"), ("unknown", "Unknown")]

# Speed classes (upper limits in knots) of the daily job and of the capture.
SPEED_LABELS = ["Stationary", "Slow / manoeuvring", "Transit", "Cruising"]
SPEED_CUTS_DAILY = [0.5, 3.0, 10.0]
SPEED_CUTS_CAPTURE = [0.3, 3.0, 12.0]
SPEED_ORDER = SPEED_LABELS + ["Unknown"]

# HS chapters and their freight sensitivity.
HS_NAMES = {10: "Cereals", 26: "Ores & slag", 27: "Mineral fuels", 72: "Iron & steel",
            89: "Ships & boats"}
HS_SENSITIVITY = {10: "High (bulk, BDI-direct)", 26: "High (bulk, BDI-direct)",
                  27: "Medium (tanker, BDTI-related)", 72: "High (bulk/break-bulk)",
                  89: "Low (vessel itself)"}

# Advice per market signal.
CHARTER_ADVICE = {
    "BULLISH": "Lock in long-term charter now — rates rising",
    "BEARISH": "Use spot market — avoid long-term charter",
    "OVERBOUGHT": "Rates above long-term avg — consider hedging",
    "OVERSOLD": "Rates below long-term avg — good entry for charters",
    "NEUTRAL": "Monitor — no clear directional signal",
}

# Risk words and route words looked for in news.
RISK_KEYWORDS = ["attack", "strike", "missile", "drone", "blockade", "sanction", "conflict",
                 "tension", "war", "military", "reroute", "divert", "halt", "closure",
                 "disruption", "crisis", "threat"]
ROUTE_KEYWORDS = {
    "Asia-Europe via Suez": ["suez", "red sea", "bab el-mandeb", "aden", "houthi"],
    "Strait of Hormuz": ["hormuz", "persian gulf", "arabian gulf", "iran", "gulf"],
    "Strait of Malacca": ["malacca", "singapore", "indonesia"],
    "Black Sea": ["black sea", "ukraine", "russia", "bosphorus", "grain"],
    "Trans-Pacific": ["pacific", "us west coast", "china", "transpacific"],
    "North Sea / Dover": ["dover", "north sea", "english channel", "rotterdam"],
}

# Place label to route, first contained name wins; and the routes reported on.
PLACE_TO_ROUTE = {
    "Singapore": "Asia-Europe via Suez", "Shanghai": "Asia-Europe via Suez",
    "Shenzhen": "Asia-Europe via Suez", "Hong Kong": "Asia-Europe via Suez",
    "Busan": "Asia-Europe via Suez", "Rotterdam": "Asia-Europe via Suez",
    "Antwerp": "Asia-Europe via Suez", "Hamburg": "North Sea / Dover",
    "Strait of Dover": "North Sea / Dover", "Strait of Gibraltar": "Asia-Europe via Suez",
    "Suez Canal": "Asia-Europe via Suez", "Bab el-Mandeb": "Asia-Europe via Suez",
    "Strait of Malacca": "Asia-Europe via Suez", "Strait of Hormuz": "Strait of Hormuz",
    "Dubai": "Strait of Hormuz", "Bosphorus Strait": "Black Sea", "Los Angeles": "Trans-Pacific",
    "New York": "Trans-Pacific", "Tokyo": "Trans-Pacific",
}
UNMAPPED_ROUTE = "Unmapped / Other"
ROUTES = ["Asia-Europe via Suez", "Strait of Hormuz", "Black Sea", "Trans-Pacific",
          "North Sea / Dover"]

# Routes of the disruption overview
# (route, origin ports, destination ports, strait, alternative strait, HS chapters, notes).
ROUTE_DEFINITIONS = [
    ("Asia → Europe (Suez)", ["Shanghai", "Ningbo-Zhoushan", "Shenzhen"],
     ["Rotterdam", "Antwerp", "Hamburg"], "Suez Canal", "Bab el-Mandeb", [72, 89, 10],
     "Main Asia-Europe container route; 14 days via Suez"),
    ("Middle East Oil → Asia", ["Dubai"], ["Shanghai", "Singapore", "Busan"],
     "Strait of Hormuz", "Strait of Malacca", [27],
     "Persian Gulf → Malacca → East Asia VLCC route"),
    ("Asia intra-regional", ["Singapore", "Port Klang", "Tanjung Pelepas"],
     ["Hong Kong", "Shanghai", "Busan"], "Strait of Malacca", "Lombok Strait", [72, 10, 26],
     "Southeast Asia feeder and transhipment routes"),
    ("Atlantic / Europe ↔ Mediterranean", ["Hamburg", "Antwerp", "Rotterdam"],
     ["Dubai", "Singapore"], "Strait of Gibraltar", None, [72, 89],
     "Northern Europe ↔ Mediterranean / onward to Suez"),
    ("Black Sea Grain Exports", [], ["Rotterdam", "Hamburg", "Antwerp"], "Bosphorus Strait",
     None, [10], "Ukraine/Russia grain exports via Black Sea; war impact"),
    ("Trans-Pacific (Asia → US West Coast)", ["Shanghai", "Ningbo-Zhoushan", "Busan"],
     ["Los Angeles", "Long Beach"], None, None, [72, 89, 26],
     "No strait — open Pacific; port congestion is main risk"),
]

# Route configuration (columns as in ROUTE_CONFIG_SCHEMA).
ROUTE_CONFIG = [
    ("Asia-Europe via Suez", "Asia-Europe",
     ["Strait of Malacca", "Bab el-Mandeb", "Suez Canal", "Strait of Gibraltar"],
     "Asia-Europe via Cape of Good Hope", 10500, 28, 14, 1000000,
     ["East Asia", "Southeast Asia"], ["Mediterranean", "Northern Europe"],
     ["Singapore", "Shanghai", "Rotterdam", "Hamburg", "Antwerp"],
     ["Containers", "Iron & steel", "Cereals"]),
    ("Strait of Hormuz", "Gulf-Asia", ["Strait of Hormuz", "Strait of Malacca"],
     "None (no viable alternative for most tankers)", 6200, 18, 7, 300000,
     ["Persian Gulf", "Gulf of Oman"], ["South Asia", "East Asia", "Europe"],
     ["Dubai", "Jebel Ali", "Fujairah", "Singapore"], ["Mineral fuels", "LNG", "Crude oil"]),
    ("Black Sea", "Black Sea", ["Bosphorus Strait"],
     "Overland rail or alternative European ports", 2800, 8, 0, 0,
     ["Black Sea ports", "Ukraine", "Russia"], ["Mediterranean", "Northern Europe"], [],
     ["Cereals", "Mineral fuels", "Iron & steel"]),
    ("Trans-Pacific", "Trans-Pacific", [], "Via Suez (adds 15 days)", 6500, 20, 0, 0,
     ["East Asia", "Southeast Asia"], ["US West Coast", "US East Coast"],
     ["Shanghai", "Los Angeles", "Long Beach", "New York"],
     ["Containers", "Iron & steel", "Ships & boats"]),
    ("North Sea / Dover", "Northern Europe", ["Strait of Dover"],
     "North of Scotland (adds 3 days)", 900, 3, 3, 50000,
     ["Northern Europe"], ["Atlantic", "Mediterranean"], ["Rotterdam", "Hamburg", "Antwerp"],
     ["Containers", "Iron & steel"]),
]
ROUTE_CONFIG_SCHEMA = (
    "route_name string, route_group string, primary_chokepoints array<string>, "
    "alternative_route string, baseline_distance_nm int, baseline_duration_days int, "
    "extra_days_if_disrupted int, extra_cost_per_voyage_usd int, origin_regions array<string>, "
    "destination_regions array<string>, watch_ports array<string>, key_commodities array<string>"
)


def local_table(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A literal table; the optimizer sees its rows and size."""
    schema = StructType.fromDDL(ddl)
    names = schema.fieldNames()
    table = pa.Table.from_pylist([dict(zip(names, row)) for row in rows],
                                 schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema)


def ports(spark: SparkSession) -> DataFrame:
    rows = [(n, c, i + 1, lat, lon) for i, (n, c, lat, lon) in enumerate(PORTS)]
    return local_table(
        spark, rows, "port_name string, country_iso string, port_rank int, lat double, lon double")


def straits(spark: SparkSession) -> DataFrame:
    return local_table(
        spark, STRAITS,
        "strait_name string, lat double, lon double, region string, connects string, "
        "trade_pct_global int, oil_pct_global int, key_routes string, geopolitical_risk string, "
        "risk_notes string")


def location_boxes(spark: SparkSession) -> DataFrame:
    rows = [(i, *box) for i, box in enumerate(LOCATION_BOXES)]
    return local_table(
        spark, rows, "priority int, label string, lat_min double, lat_max double, lon_min double, "
              "lon_max double")


def iso_crosswalk(spark: SparkSession) -> DataFrame:
    return local_table(spark, list(ISO2_TO_ISO3.items()), "iso2 string, iso3 string")


def route_definitions(spark: SparkSession) -> DataFrame:
    return local_table(
        spark, ROUTE_DEFINITIONS,
        "route string, origin_ports array<string>, dest_ports array<string>, strait string, "
        "alt_strait string, hs_codes array<int>, route_notes string")


def route_config(spark: SparkSession) -> DataFrame:
    return local_table(spark, ROUTE_CONFIG, ROUTE_CONFIG_SCHEMA)

"""Fixed values that results depend on, stated for the checks on their own."""

# Risk words of news, and route words.
NEWS_WORDS = ["attack", "strike", "missile", "drone", "blockade", "sanction", "conflict", "tension", "war",
              "military", "reroute", "divert", "halt", "closure", "disruption", "crisis", "threat"]
ROUTE_WORDS = [
    ("Asia-Europe via Suez", ["suez", "red sea", "bab el-mandeb", "aden", "houthi"]),
    ("Strait of Hormuz", ["hormuz", "persian gulf", "arabian gulf", "iran", "gulf"]),
    ("Strait of Malacca", ["malacca", "singapore", "indonesia"]),
    ("Black Sea", ["black sea", "ukraine", "russia", "bosphorus", "grain"]),
    ("Trans-Pacific", ["pacific", "us west coast", "china", "transpacific"]),
    ("North Sea / Dover", ["dover", "north sea", "english channel", "rotterdam"]),
]

# Order of the geopolitical words, from the lowest.
GEO_ORDER = ["Low", "Medium", "High", "Very High"]

"""Wind, visibility and strait risk rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..dims import BEAUFORT_LIMITS, BEAUFORT_NAMES, GEO_POINTS, HURRICANE_LONG_NAME
from .common import ladder


def beaufort_number(wind_ms: Column) -> Column:
    """How many force limits the wind has reached: 0 to 12, null for no wind value."""
    steps = [(wind_ms < limit, force) for force, limit in enumerate(BEAUFORT_LIMITS)]
    return F.when(wind_ms.isNotNull(), ladder(steps, 12)).cast("int")


def beaufort_name(force: Column, long_hurricane: bool = False) -> Column:
    names = BEAUFORT_NAMES[:-1] + [HURRICANE_LONG_NAME if long_hurricane else BEAUFORT_NAMES[-1]]
    return F.get(F.array(*[F.lit(n) for n in names]), force)


def gale_risk(force: Column) -> Column:
    return force >= 7


def low_visibility(visibility_m: Column) -> Column:
    return visibility_m < 1000


def disruption_score(geo_risk: Column, force: Column, visibility_m: Column) -> Column:
    """0..100: geopolitical points, six per Beaufort force (60 at most), poor visibility."""
    geo = ladder([(geo_risk == word, points) for word, points in GEO_POINTS.items()], 0)
    wind = F.least(force * 6, F.lit(60))
    haze = F.when(visibility_m < 1000, 10).when(visibility_m < 5000, 5).otherwise(0)
    return F.least(F.lit(100), geo + wind + haze).cast("int")


def disruption_level(score: Column) -> Column:
    return ladder([(score >= 60, "Critical"), (score >= 40, "High"), (score >= 20, "Moderate")],
                  "Normal")


def risk_badge(level: Column) -> Column:
    return ladder([(level == "Critical", "🔴 CRITICAL"), (level == "High", "🟠 HIGH"),
                   (level == "Moderate", "🟡 MODERATE")], "🟢 NORMAL")


# Sentence shown per score band, by card.
_BANDS = {
    "summary": ["⚠ Critical risk — monitor for routing changes",
                "⚡ Elevated risk — factor into shipping plans",
                "ℹ Moderate conditions", "✓ Normal operating conditions"],
    "strait": ["⚠ Critical risk — significant disruption likely, consider rerouting",
               "⚡ Elevated risk — monitor closely and factor into routing decisions",
               "ℹ Moderate conditions", "✓ Normal conditions"],
    "route": ["⚠ Critical — rerouting expected, significant cost and time impact",
              "⚡ Elevated risk — factor into logistics planning",
              "👁 Monitor — conditions above normal", "✓ Normal operating conditions"],
}


def score_band(score: Column, card: str = "route") -> Column:
    top, high, some, calm = _BANDS[card]
    return ladder([(score >= 60, top), (score >= 40, high), (score >= 20, some)], calm)


def reroute_note(strait: Column) -> Column:
    """Alternative to a strait, by words in its name."""
    return ladder([
        (strait.contains("Hormuz"), "Cape of Good Hope or Suez (adds ~7 days, +$300K/voyage)"),
        (strait.contains("Suez") | strait.contains("Bab el-Mandeb"),
         "Cape of Good Hope (adds ~14 days, +$1M/voyage est.)"),
        (strait.contains("Malacca"), "Lombok or Sunda Strait (adds ~2 days)"),
        (strait.contains("Bosphorus"), "No alternative — Black Sea landlocked"),
        (strait.contains("Gibraltar"), "No practical alternative for Mediterranean access"),
    ], "Alternative routing possible")

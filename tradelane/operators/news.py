"""News cleaning and classification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import dims
from ..functions import news
from ..functions.common import strip
from .cleaning import dedupe_first


def classify_news(df: DataFrame, title: str = "title", description: str = "description",
                  keywords: Sequence[str] = tuple(dims.RISK_KEYWORDS),
                  routes: Mapping[str, Sequence[str]] = dims.ROUTE_KEYWORDS,
                  whole_word: bool = False) -> DataFrame:
    """Risk level, score and routes from the whole title and description."""
    text = F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")),
                               F.coalesce(description, F.lit(""))))
    df = df.withColumn("_text", text).withColumns({
        "risk_hits": news.keyword_hits(F.col("_text"), keywords, whole_word),
        "route_list": news.matched_routes(F.col("_text"), routes, whole_word),
    })
    return df.withColumns({
        "risk_level": news.risk_level(F.col("risk_hits")),
        "risk_score": news.risk_score(F.col("risk_hits")),
        "relevant_routes": F.when(F.size("route_list") > 0, F.array_join("route_list", ", "))
        .otherwise("General"),
    }).drop("_text")


def clean_news(articles: DataFrame, order: Sequence[str] = (),
               keywords: Sequence[str] = tuple(dims.RISK_KEYWORDS),
               routes: Mapping[str, Sequence[str]] = dims.ROUTE_KEYWORDS,
               stored: Mapping[str, int] | None = None) -> DataFrame:
    """Unique, dated, classified articles.

    The first article of equal titles is kept in ``order`` (arrival columns). Whole titles and
    descriptions are classified; ``stored`` may give a number of characters to which ``title``,
    ``description`` or ``url`` are shortened afterwards. A kept article with a bad date is dropped.
    Whole titles are compared by their SHA-256.
    """
    df = articles.withColumn("title", strip(F.col("title")))
    df = df.where((F.col("title") != "") & (F.col("title") != "[Removed]"))
    df = df.withColumn("description", F.coalesce("description", F.lit("")))
    df = classify_news(df, keywords=keywords, routes=routes)
    df = df.withColumns({
        "_key": F.sha2("title", 256),
        "pub_date": F.try_to_timestamp("publishedAt"),
        "url": F.coalesce("url", F.lit("")),
        "source_name": F.coalesce("source_name", F.lit("unknown")),
        "source_api": F.lit("newsapi.org"),
    })
    df = df.withColumns({c: F.substring(c, 1, n) for c, n in (stored or {}).items()})
    df = dedupe_first(df, ["_key"], [F.col(c) for c in order] or [F.col("publishedAt")])
    return df.drop("_key").dropna(subset=["pub_date"])


def newest_first(news_df: DataFrame, tiebreak: Sequence[str] = ("url",)) -> DataFrame:
    """Articles in the order in which they are shown."""
    return news_df.orderBy(F.desc("pub_date"), *tiebreak)

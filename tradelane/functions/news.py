"""Keyword rules for news text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..dims import RISK_KEYWORDS, ROUTE_KEYWORDS


def contains_word(text: Column, word: str, whole_word: bool = False) -> Column:
    if whole_word:
        return F.regexp_like(text, F.lit(rf"(?<![\p{{L}}\p{{N}}])\Q{word}\E(?![\p{{L}}\p{{N}}])"))
    return text.contains(word)


def keyword_hits(text: Column, words: Sequence[str] = tuple(RISK_KEYWORDS),
                 whole_word: bool = False) -> Column:
    """Number of distinct words contained in lower-case text."""
    hits = [F.when(contains_word(text, w, whole_word), 1).otherwise(0) for w in words]
    return sum(hits[1:], hits[0])


def risk_level(hits: Column) -> Column:
    return F.when(hits >= 3, "HIGH").when(hits >= 1, "MEDIUM").otherwise("LOW")


def risk_score(hits: Column) -> Column:
    return (F.when(hits >= 3, F.least(F.lit(90), hits * 5 + 60))
            .when(hits >= 1, hits * 8 + 40).otherwise(10)).cast("int")


def matched_routes(text: Column, routes: Mapping[str, Sequence[str]] = ROUTE_KEYWORDS,
                   whole_word: bool = False) -> Column:
    """Routes with any of their words in the text, in table order."""
    found = []
    for name, words in routes.items():
        tests = [contains_word(text, w, whole_word) for w in words]
        hit = tests[0]
        for test in tests[1:]:
            hit = hit | test
        found.append(F.when(hit, F.lit(name)))
    return F.array_except(F.array(*found), F.array(F.lit(None).cast("string")))

"""Union of the cleaned sources with stable row numbers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .series import with_position


def union_sources(frames: Sequence[DataFrame], row_key: str) -> DataFrame:
    """Union by name, numbered from 1 in (source, date, row key) order, missing dates last.

    ``row_key`` is a number unique inside its source.
    """
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    df = df.withColumn("source", F.coalesce("source", F.lit("unknown")))
    return with_position(df, ["source", "date", row_key], "row_id")

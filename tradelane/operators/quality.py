"""Data quality operators."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.common import round_half_up
from ..session import stored


def validate(df: DataFrame, rules: Mapping[str, Column],
             unique: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """One row per rule with the number of rows that break it.

    Row rules share one pass; each uniqueness rule counts surplus rows per key.
    """
    counts = df.agg(*[F.count_if(c).alias(name) for name, c in rules.items()])
    rows = [F.struct(F.lit(name).alias("rule"), F.col(name).alias("failures")) for name in rules]
    parts = [counts.select(F.inline(F.array(*rows)))]
    for name, keys in (unique or {}).items():
        surplus = df.groupBy(*keys).agg((F.count("*") - 1).alias("n"))
        parts.append(surplus.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures"))
                     .select(F.lit(name).alias("rule"), "failures"))
    return reduce(DataFrame.unionByName, parts)


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count and percent per column, one pass."""
    names = list(columns or df.columns)
    counts = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c)
                                                  for c in names])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls"),
                     round_half_up(F.try_divide(F.col(c), F.col("_rows")) * 100, 1).alias("null_pct"))
            for c in names]
    return counts.select(F.inline(F.array(*rows)))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("tbl"), "rows")
             for name, df in tables.items()]
    return reduce(DataFrame.unionAll, parts)


def _numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles, NaN as null."""
    return df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])


SKETCH = 4096  # size of the quantile sketches


def _rank_error(size: int) -> float:
    """Of the rank, as a share of the rows: three times the error a sketch has with 99 % confidence."""
    return 3 * 2.296 / size ** 0.9021


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    keep: int = 4096, size: int = SKETCH) -> dict[tuple[str, float], float | None]:
    """Exact linear-interpolated quantiles of long columns; NaN counts as null.

    A mergeable KLL sketch, made in the pass that counts the rows, brackets the row at a rank; the next
    pass counts the rows of the pieces around the bracket by plain comparisons and moves into the one
    that holds the rank, with a sketch of its rows, until at most ``keep`` rows are left. The ends of
    a bracket are pieces of their own, so far values, infinities and ties do not matter. All ranks
    of all columns share a pass; no column is ever sorted or gathered as a whole. The columns are
    kept on the executors between passes, where a lost part is recomputed.
    """
    return _summary(df, columns, probs, keep, size)[1]


def _summary(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
             keep: int = 4096, size: int = SKETCH) -> tuple[list[dict], dict[tuple[str, float], float | None]]:
    """Count, least, greatest, mean and deviation per column, and the quantiles, in one computation."""
    kept = _numbers(df, columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        names = {"n": F.count, "lo": F.min, "hi": F.max, "mean": F.avg, "std": F.stddev_samp,
                 "sketch": lambda c: _sketch(F.col(c), F.lit(True), size)}
        row = kept.agg(*[f(c).alias(f"{k}{i}") for i, c in enumerate(columns) for k, f in names.items()]).first()
        first = [{k: row[f"{k}{i}"] for k in names} for i in range(len(columns))]
        return first, _narrow(kept, list(columns), first, probs, keep, size)
    finally:
        kept.unpersist()


def _sketch(x: Column, where: Column, size: int) -> Column:
    """A sketch of the finite values; null if there are none."""
    finite = where & (F.abs(x) < float("inf"))
    return F.when(F.count_if(finite) > 0, F.kll_sketch_agg_double(F.when(finite, x), size))


def _around(spark: SparkSession, asked: list[tuple[bytes, float]], error: float) -> list[tuple[float, float]]:
    """Of each sketch the values that bracket a rank (as a share)."""
    if not asked:
        return []
    cells = [F.kll_sketch_get_quantile_double(F.lit(bytes(sketch)), F.lit(min(max(r + e, 0.0), 1.0)))
             for sketch, r in asked for e in (-error, error)]
    found = spark.range(1).select(F.array(*cells)).first()[0]
    return list(zip(found[::2], found[1::2], strict=True))


def _narrow(df: DataFrame, cols: list[str], first: list[dict], probs: Sequence[float],
            keep: int, size: int) -> dict[tuple[str, float], float | None]:
    brackets: dict[tuple[str, int], dict] = {}
    for c, of in zip(cols, first, strict=True):
        for p in probs if of["n"] else ():
            for rank in {math.floor((of["n"] - 1) * p), math.ceil((of["n"] - 1) * p)}:
                brackets[(c, rank)] = {"lo": of["lo"], "hi": of["hi"], "below": 0, "rows": of["n"], "sketch": of["sketch"]}

    while wide := [k for k, b in brackets.items() if b["rows"] > keep and b["lo"] < b["hi"]]:
        sketched = [k for k in wide if brackets[k]["sketch"] is not None]
        guessed = dict(zip(sketched, _around(df.sparkSession, [
            (brackets[k]["sketch"], (k[1] - brackets[k]["below"] + 0.5) / brackets[k]["rows"]) for k in sketched],
            _rank_error(size)), strict=True))
        # ranks of one column with the same bracket are looked for together
        place = {k: (k[0], brackets[k]["lo"], *guessed.get(k, (brackets[k]["lo"], brackets[k]["hi"])), brackets[k]["hi"])
                 for k in wide}
        places, aggs = sorted(set(place.values())), []
        for t, (c, lo, a, b, hi) in enumerate(places):
            x = F.col(c)
            inner = (x > lo) & (x < hi)
            pieces = [x == lo, inner & (x < a), inner & x.between(a, b), inner & (x > b), x == hi]
            aggs.append(F.struct(F.array(*(F.struct(
                F.count_if(w).alias("n"), F.min(F.when(w, x)).alias("lo"), F.max(F.when(w, x)).alias("hi"))
                for w in pieces)).alias("pieces"), _sketch(x, pieces[2], size).alias("sketch")).alias(f"p{t}"))
        counted = df.agg(*aggs).first()
        for key in wide:
            found, bracket = counted[places.index(place[key])], brackets[key]
            below = bracket["below"]
            for i, piece in enumerate(found["pieces"]):
                if key[1] < below + piece["n"]:
                    brackets[key] = {"lo": piece["lo"], "hi": piece["hi"], "below": below, "rows": piece["n"],
                                     "sketch": found["sketch"] if i == 2 else None}
                    break
                below += piece["n"]

    if short := [k for k, b in brackets.items() if b["lo"] < b["hi"]]:
        places = sorted({(k[0], brackets[k]["lo"], brackets[k]["hi"]) for k in short})
        cells = [F.when(F.col(c).between(lo, hi), F.struct(F.lit(t).alias("t"), F.col(c).alias("x")))
                 for t, (c, lo, hi) in enumerate(places)]
        values = df.select(F.inline(F.array_compact(F.array(*cells)))).groupBy("t", "x").count().collect()
        for key in short:
            t, below = places.index((key[0], brackets[key]["lo"], brackets[key]["hi"])), brackets[key]["below"]
            for r in sorted((r for r in values if r["t"] == t), key=lambda r: r["x"]):
                below += r["count"]
                if key[1] < below:
                    brackets[key] = {"lo": r["x"], "hi": r["x"]}
                    break

    out: dict[tuple[str, float], float | None] = {}
    for c, of in zip(cols, first, strict=True):
        for p in probs:
            if not of["n"]:
                out[(c, p)] = None
                continue
            pos = (of["n"] - 1) * p
            a = brackets[(c, math.floor(pos))]["lo"]
            b = brackets[(c, math.ceil(pos))]["lo"]
            out[(c, p)] = a if a == b else a + (b - a) * (pos - math.floor(pos))
    return out


def describe_stats(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """count, mean, std, min, quartiles and max per column, one row each; NaN counts as null."""
    first, q = _summary(df, columns, (0.25, 0.5, 0.75))

    def rounded(value: float | None, name: str) -> Column:
        return round_half_up(F.lit(value).cast("double"), digits).alias(name)

    rows = [F.struct(
        F.lit(c).alias("column_name"), F.lit(of["n"]).cast("long").alias("count"),
        rounded(of["mean"], "mean"), rounded(of["std"], "std"), rounded(of["lo"], "min"),
        rounded(q[(c, 0.25)], "q25"), rounded(q[(c, 0.5)], "q50"), rounded(q[(c, 0.75)], "q75"),
        rounded(of["hi"], "max")) for c, of in zip(columns, first, strict=True)]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def quality_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: sizes and nulls before and after, outliers, coverage, value range.

    ``after`` is stored, as its median takes passes of its own.
    """
    after = stored(after, "quality-rows")

    def nulls(df: DataFrame) -> Column:
        return sum((F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns), F.lit(0))

    was = before.agg(F.struct(F.count("*").alias("rows"), nulls(before).alias("nulls"))).scalar()
    median = exact_quantiles(after, ["trade_value_usd"], (0.5,))[("trade_value_usd", 0.5)]

    def listed(column: str) -> Column:
        return F.array_join(F.array_sort(F.collect_set(column)), ", ")

    value = "trade_value_usd"
    return after.agg(
        F.count("*").alias("rows_after"), nulls(after).alias("nulls_after"),
        F.count_if("is_outlier").alias("outliers"), listed("year").alias("years"),
        F.count_distinct("reporter_iso").alias("reporters"), listed("hs_code").alias("hs_codes"),
        F.min(value).alias("min_value"), F.max(value).alias("max_value"),
        round_half_up(F.avg(value), 2).alias("mean_value"),
    ).select(was["rows"].alias("rows_before"), was["nulls"].alias("nulls_before"), "*",
             (was["rows"] - F.col("rows_after")).alias("rows_removed"),
             round_half_up(F.lit(median).cast("double"), 2).alias("median_value"))

r"""Repeated runs of lines, found by prefix doubling over line ids; later copies are deleted.

Documents are sequences of line ids (blank lines are not part of them). The suffixes of all sequences
are ranked by their first 1, 2, 3, 6, 12, ... lines: the rank by twice as many lines is that of the pair
of two ranks, its own and that of the suffix so many lines on, sorted over all distinct pairs. Suffixes of
one rank stand together in that order and share at least so many lines, so they are an interval of that
longest common prefix. Only suffixes that share their rank with others go on, until none does, so a
step costs what is still repeated, and there are as many as the longest repeated run has binary digits.

Every suffix that is not the first of its interval marks as many lines as the interval has. The marks
of a document that touch or overlap are its maximal repeated runs, which are deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .tables import column, cut, numbered, of_numbered

MIN_LINES = 3  # a repeated run of so many lines counts,
LONG_LINE = 40  # and so does a single line of so many characters
BLANK = " \t\n\x0b\f\r"


def _split(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_table(docs: DataFrame, long_line: int) -> DataFrame:
    """One row per line that is not blank: row, doc_id, at (among these), raw (among all), x, y (its id), long."""
    each = F.transform(_split(F.col("text")), lambda x, i: F.struct(x.alias("line"), i.alias("raw")))
    real = F.filter(each, lambda x: F.length(F.btrim(x["line"], F.lit(BLANK))) > 0)
    each = docs.select("row", "doc_id", F.posexplode(real).alias("at", "line"))
    return each.select("row", "doc_id", "at", F.col("line.raw").alias("raw"),
                       *(F.xxhash64(F.lit(seed), F.col("line.line")).alias(c) for seed, c in ((1, "x"), (2, "y"))),
                       (F.length("line.line") >= long_line).alias("long"))


def _intervals(suffixes: DataFrame, name: str) -> DataFrame:
    """The suffixes that share their pair x, y with others: its rank among all pairs, and whether an earlier one has it."""
    found = (suffixes.groupBy("x", "y")
             .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "row", "at")).alias("first"))
             .where("n > 1").drop("n"))
    # numbers rise over sorted ranges, so they are ranks; gaps between them do not matter
    ranked = found.repartitionByRange("x", "y").sortWithinPartitions("x", "y").withColumn(
        "rank", F.monotonically_increasing_id())
    # the stored side is unique, so AQE can split a hot pair on the other; merged at every size
    shared = suffixes.join(cut(ranked, f"{name}-intervals").hint("merge"), ["x", "y"])
    later = F.struct("doc_id", "row", "at") != F.col("first")
    return cut(shared.select(*(c for c in suffixes.columns if c not in ("x", "y")), "rank", later.alias("later")), name)


def repeated_lines(docs: DataFrame, min_lines: int = MIN_LINES, long_line: int = LONG_LINE) -> DataFrame:
    """Lines to delete, as row, at and ``raw`` place: later copies of repeated runs.

    ``docs`` has row (unique), doc_id and text. The copy with the smallest doc_id, then row, then
    place is the first; null ids come before all.
    """
    single = _intervals(cut(line_table(docs, long_line), "lines"), "suffixes-1")
    active, length = single, 1
    marks = single.select("row", "at", "raw", F.when(F.col("later") & (F.col("long") | F.lit(min_lines == 1)), F.col("at"))
                          .alias("end"))
    while True:
        step = min(length, min_lines - length) if length < min_lines else length
        ahead = F.lead(F.struct("at", "rank"), step).over(W.partitionBy("row").orderBy("at"))
        # a line between that nobody shares makes the place differ: no run of this length there
        pairs = (active.withColumn("next", ahead).where(F.col("next.at") == F.col("at") + step)
                 .select("row", "doc_id", "at", F.col("rank").alias("x"), F.col("next.rank").alias("y")))
        length += step
        active = _intervals(cut(pairs, f"pairs-{length}"), f"suffixes-{length}")
        if active.isEmpty():
            break
        if length >= min_lines:
            marks = marks.unionByName(active.where("later").select("row", "at", (F.col("at") + (length - 1)).alias("end")),
                                      allowMissingColumns=True)
    reached = F.max("end").over(W.partitionBy("row").orderBy("at").rangeBetween(W.unboundedPreceding, 0))
    return (marks.withColumn("reached", reached).where("raw is not null and reached >= at").select("row", "at", "raw"))


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, long_line: int = LONG_LINE,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` without the lines of later copies; three more columns at the end.

    ``n_lines`` counts the lines that are not blank, ``n_removed`` those of them deleted, ``longest_run`` the
    lines of the longest maximal run that is deleted; blank lines stay. All other columns, whatever their
    names, come back as they are. Null and empty texts have no lines; long ones are read whole. Of rows that
    repeat, the first keeps its lines. An empty table gives no rows. ``docs`` is read once and written
    with the numbers of its rows.
    """
    rows = numbered(docs)
    lines = repeated_lines(of_numbered(rows, id_col, text_col), min_lines, long_line)
    gone = lines.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "raw"))).alias("x"))  # as long as its document
    step = lambda run, x: F.struct(  # noqa: E731 - the length of the run that ends here, and the longest so far
        x["at"].alias("at"), F.when(x["at"] == run["at"] + 1, run["n"] + 1).otherwise(1).alias("n"),
        F.greatest(run["most"], F.when(x["at"] == run["at"] + 1, run["n"] + 1).otherwise(1)).alias("most"))
    start = F.struct(F.lit(-2).alias("at"), F.lit(0).alias("n"), F.lit(0).alias("most"))
    gone = gone.select("row", F.transform("x", lambda x: x["raw"]).alias("gone"),
                       F.aggregate("x", start, step, lambda run: run["most"]).alias("longest"))
    text = column(text_col, "kept")
    both = rows.join(cut(gone, "gone").hint("merge"), "row", "left").withColumn("lines", _split(F.coalesce(text, F.lit(""))))
    between = F.transform(
        F.sequence(F.lit(0), F.size("gone")),
        lambda i: F.struct(F.when(i > 0, F.get("gone", i - 1) + 1).otherwise(0).alias("a"),
                           F.coalesce(F.get("gone", i), F.size("lines")).alias("b")))
    rest = F.flatten(F.transform(F.filter(between, lambda r: r["b"] > r["a"]),
                                 lambda r: F.slice("lines", r["a"] + 1, r["b"] - r["a"])))
    cleaned = F.when(F.col("gone").isNull(), text).otherwise(F.array_join(rest, "\n"))
    real = F.size(F.filter("lines", lambda x: F.length(F.btrim(x, F.lit(BLANK))) > 0))
    columns = [(cleaned if c == text_col else column(c, "kept")).alias(c) for c in docs.columns]
    return both.select(*columns, real.cast("long").alias("n_lines"),
                       F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
                       F.coalesce("longest", F.lit(0)).cast("long").alias("longest_run"))

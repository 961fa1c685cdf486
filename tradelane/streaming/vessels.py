"""Vessel messages as a stream.

Sources are landed files. Aggregations carry a watermark, so state is bounded and a
day is final once the watermark has passed it; days still open are given out as well and
marked. Stateful aggregations leave out rows later than that; ``run_merged`` keeps them all by
merging partial results of the batches. Sinks go through ``foreachBatch`` and write under the batch id or merge by key, so
that a repeated batch changes nothing.
"""

from __future__ import annotations

import json
import warnings
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import DateType, DecimalType, IntegerType, IntegralType, StructField, StructType, TimestampType

from ..functions.common import round_half_up
from ..operators.asof import STATIC_FIELDS
from ..operators.cleaning import dedupe_latest
from ..sources.readers import parse_ais, path_exists
from ..session import scratch_path
from ..sources.sinks import exists, folders, read_text, remove, sink_merge_days, sink_replace_days, write_text

TIME = "event_time_utc"


def stream_ais_source(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Landed JSON lines as typed messages; broken lines stay, marked ``malformed``."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(path)
    return parse_ais(lines)


def stream_filter_type(df: DataFrame) -> DataFrame:
    """Positions with a place, and static messages."""
    placed = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    return df.where(((F.col("message_type") == "PositionReport") & placed)
                    | (F.col("message_type") == "ShipStaticData"))


def stream_dedupe_daily(df: DataFrame, columns: Sequence[str], tiebreak: str = "event_id",
                        delay: str = "1 hour") -> DataFrame:
    """Last position per vessel and day."""
    last = F.max_by(F.struct(TIME, *columns), F.struct(TIME, tiebreak)).alias("_last")
    return (df.withWatermark(TIME, delay)
            .groupBy("mmsi", F.window(TIME, "1 day").alias("day")).agg(last)
            .select("mmsi", "day", F.col("_last.*")))


def daily_partial(df: DataFrame, columns: Sequence[str], tiebreak: str = "event_id") -> DataFrame:
    """Last position per vessel and day of one batch, with what decides between batches."""
    return (df.groupBy("mmsi", F.window(TIME, "1 day").alias("day"))
            .agg(F.max_by(F.struct(TIME, *columns), F.struct(TIME, tiebreak)).alias("_last"),
                 F.max(F.struct(TIME, tiebreak)).alias("_key"), F.max(TIME).alias("seen")))


def daily_merge(parts: DataFrame) -> DataFrame:
    """Partial rows of several batches as one per vessel and day."""
    return parts.groupBy("mmsi", "day").agg(
        F.max_by("_last", "_key").alias("_last"), F.max("_key").alias("_key"), F.max("seen").alias("seen"))


def daily_finish(parts: DataFrame) -> DataFrame:
    return parts.select("mmsi", "day", F.col("_last.*"), "seen")


def route_partial(df: DataFrame) -> DataFrame:
    """Messages and speed per route, vessel and day of one batch."""
    return (df.groupBy("route", "mmsi", F.window(TIME, "1 day").alias("day"))
            .agg(F.count("*").alias("messages"), F.sum("sog_knots").alias("speed_sum"),
                 F.count("sog_knots").alias("speeds"), F.max(TIME).alias("seen")))


def route_merge(parts: DataFrame) -> DataFrame:
    return parts.groupBy("route", "mmsi", "day").agg(
        *(F.sum(c).alias(c) for c in ("messages", "speed_sum", "speeds")), F.max("seen").alias("seen"))


def strait_counts(daily: DataFrame) -> DataFrame:
    """Exact vessels per strait and day, from the daily last positions that a stream has written."""
    return (daily.where("is_strait")
            .groupBy(F.to_date("day.start").alias("fetch_date"), F.col("port_guess").alias("strait_name"))
            .agg(F.count("*").alias("vessels"), F.count_if("is_moving").alias("moving")))


def stream_route_activity(df: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Messages and speed per route, vessel and day: what windows of any length are made of."""
    return (df.withWatermark(TIME, delay)
            .groupBy("route", "mmsi", F.window(TIME, "1 day").alias("day"))
            .agg(F.count("*").alias("messages"), F.sum("sog_knots").alias("speed_sum"),
                 F.count("sog_knots").alias("speeds")))


def route_windows(daily: DataFrame, days: int = 7, baseline: DataFrame | None = None) -> DataFrame:
    """Sliding windows of whole days: messages, mean speed, exact vessels; with the ``baseline``
    (of ``route_baselines``) also how far the vessels a day are from it, in percent."""
    first = F.to_date("day.start")
    spread = daily.withColumn("window_start", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(days - 1)), lambda i: F.date_sub(first, i))))
    # one row per vessel first, so that the distinct count needs no set of all vessels
    vessel = spread.groupBy("window_start", "route", "mmsi").agg(
        F.sum("messages").alias("m"), F.sum("speed_sum").alias("s"), F.sum("speeds").alias("n"),
        F.count("*").alias("days"))
    out = vessel.groupBy("window_start", "route").agg(
        F.sum("m").alias("messages"), F.try_divide(F.sum("s"), F.sum("n")).alias("avg_speed"),
        F.count("*").alias("vessels"), F.sum("days").alias("_vessel_days"))
    if baseline is not None:
        usual = baseline.select("route", "baseline_avg_vessels")
        a_day = F.col("_vessel_days") / days
        out = out.join(usual, "route", "left").withColumn("vessels_vs_baseline_pct", round_half_up(
            F.try_divide(a_day - F.col("baseline_avg_vessels"), F.col("baseline_avg_vessels")) * 100, 1))
    return out.drop("_vessel_days")


HLL_SIZE = 12  # log2 of a sketch's cells: 1.6 % standard error


def route_sketches(df: DataFrame, size: int = HLL_SIZE) -> DataFrame:
    """One row per route and day: messages, speed and a mergeable sketch of the vessels.

    A row is as wide as its sketch (4 KB at most), whatever the number of vessels.
    """
    return (df.groupBy("route", F.to_date(TIME).alias("day"))
            .agg(F.count("*").alias("messages"), F.sum("sog_knots").alias("speed_sum"),
                 F.count("sog_knots").alias("speeds"), F.hll_sketch_agg("mmsi", size).alias("vessels")))


def merge_sketches(parts: DataFrame) -> DataFrame:
    """Sketches of several batches as one per route and day."""
    return parts.groupBy("route", "day").agg(
        *(F.sum(c).alias(c) for c in ("messages", "speed_sum", "speeds")), F.hll_union_agg("vessels").alias("vessels"))


def approx_route_windows(daily: DataFrame, days: int = 7) -> DataFrame:
    """``route_windows`` from ``route_sketches``: only a route's days are spread over windows, no vessel is.

    ``vessels`` is within three standard errors (4.9 % with the default size) of the exact number with 99.7 %
    confidence, and exact while few vessels are about; the other columns are exact.
    """
    spread = daily.withColumn("window_start", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(days - 1)), lambda i: F.date_sub("day", i))))
    return spread.groupBy("window_start", "route").agg(
        F.sum("messages").alias("messages"), F.try_divide(F.sum("speed_sum"), F.sum("speeds")).alias("avg_speed"),
        F.hll_sketch_estimate(F.hll_union_agg("vessels")).alias("vessels"))


def _with_batch(df: DataFrame) -> StructType:
    return StructType([*df.schema, StructField("batch", IntegerType())])


def run_complete(df: DataFrame, out: str, checkpoint: str, keys: Sequence[str], end: str) -> DataFrame:
    """Process what has landed and stop; every window is given out, open ones as they stand.

    Each micro-batch writes the rows it changed under its id, so a repeat replaces them. The result
    has the newest state per key and ``final``: the watermark has passed ``end``.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    query = (df.writeStream.outputMode("update").foreachBatch(write)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    if late := late_rows(query):
        warnings.warn(f"{late} rows came after the watermark and are not in {out}", stacklevel=2)
    spark = df.sparkSession
    mark = (query.lastProgress or {}).get("eventTime", {}).get("watermark")
    if not path_exists(spark, f"{out}/batch=*"):
        return spark.createDataFrame([], df.schema).withColumn("final", F.lit(False))
    newest = dedupe_latest(spark.read.schema(_with_batch(df)).parquet(out), keys, "batch").drop("batch")
    return newest.withColumn("final", F.coalesce(F.col(end) <= F.lit(mark).cast("timestamp"), F.lit(False)))


def run_merged(df: DataFrame, out: str, checkpoint: str, partial: Callable[[DataFrame], DataFrame],
               merge: Callable[[DataFrame], DataFrame], finish: Callable[[DataFrame], DataFrame] | None = None,
               delay: str = "1 hour") -> DataFrame:
    """Process what has landed and stop; rows of every batch count, however late they come.

    Each micro-batch writes its ``partial`` rows (with ``day`` and ``seen``, their newest time) under its id, so
    a repeat replaces them. Then they are merged into a table partitioned by day: only the days that have new
    rows are read and written, and the batches go, so a run costs what is new to it and not what has ever
    landed. ``merge`` adds partial rows up and gives out partial rows; ``finish`` makes the result of them.
    ``final``: the newest time of all less ``delay`` has passed the day; later rows still change it.

    Every day remembers the last batch that is in it, so merging a batch again after a failure changes
    nothing. A new ``checkpoint`` reads all that has landed again, and so begins a new table.
    """
    spark = df.sparkSession
    batches, days, state = f"{out}/batches", f"{out}/days", f"{out}/_state.json"

    def write(batch: DataFrame, batch_id: int) -> None:
        partial(batch).write.mode("overwrite").parquet(f"{batches}/batch={batch_id}")

    query = (df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    known = json.loads(read_text(spark, state) or "{}")
    if known.get("query") != str(query.id):
        if known:
            remove(spark, days)
        known = {"query": str(query.id), "upto": -1, "seen": None}
    new = [n for n in folders(spark, batches, "batch=") if int(n.partition("=")[2]) > known["upto"]]
    rows = partial(df)
    if new:
        schema = StructType([*rows.schema, StructField("batch", IntegerType())])
        parts = spark.read.schema(schema).parquet(batches).where(F.col("batch") > known["upto"])
        known = _compact(parts, days, merge, known)
        write_text(spark, state, json.dumps(known))
    for name in new:  # all of them are done: a batch that is run again would have ended the query
        remove(spark, f"{batches}/{name}")
    merged = _days(spark, days, rows.schema)
    mark = F.lit(known["seen"]).cast("timestamp") - F.expr(f"INTERVAL {delay}")
    done = merged.drop("day_start", "upto")
    done = finish(done) if finish else done
    return done.withColumn("final", F.coalesce(F.col("day.end") <= mark, F.lit(False))).drop("seen")


def _days(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    whole = StructType([*schema, StructField("upto", IntegerType()), StructField("day_start", DateType())])
    return spark.read.schema(whole).parquet(path) if exists(spark, path) else spark.createDataFrame([], whole)


def _compact(parts: DataFrame, path: str, merge: Callable[[DataFrame], DataFrame], known: dict) -> dict:
    """Add the partial rows (with ``batch``) to the days they belong to."""
    spark = parts.sparkSession
    columns = [c for c in parts.columns if c != "batch"]
    new = parts.withColumn("day_start", F.to_date("day.start"))
    seen = new.agg(F.max("batch").alias("batch"), F.max("seen").cast("string").alias("seen"),
                   F.collect_set("day_start").alias("days")).first()  # as many as the calendar has
    if seen.batch is None:
        return known
    whole = _days(spark, path, parts.drop("batch").schema)
    old = whole.where(F.col("day_start").isin(seen.days))
    held = old.groupBy("day_start").agg(F.max("upto").alias("held"))
    fresh = (new.join(held, "day_start", "left").where(F.coalesce(F.col("batch") > F.col("held"), F.lit(True)))
             .select(*columns, "day_start"))
    both = fresh.unionByName(old.select(*columns, "day_start"))
    staged = scratch_path(spark, "days")
    merged = merge(both.drop("day_start")).withColumns({
        "upto": F.lit(seen.batch), "day_start": F.to_date("day.start")})
    merged.write.parquet(staged)
    sink_replace_days(spark.read.schema(merged.schema).parquet(staged), path, "day_start")
    remove(spark, staged)
    newest = max(x for x in (known["seen"], seen.seen) if x is not None) if seen.seen or known["seen"] else None
    return known | {"upto": int(seen.batch), "seen": newest}


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after the watermark and were left out, as far as the query remembers."""
    return sum(op.get("numRowsDroppedByWatermark", 0)
               for p in query.recentProgress for op in p.get("stateOperators", []))


def run_available(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Process what has landed and stop; finished rows are appended as Parquet."""
    query = (df.writeStream.format("parquet").outputMode("append")
             .option("path", out).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def stream_upsert_history(df: DataFrame, out: str, checkpoint: str, keys: Sequence[str],
                          order: Sequence[Column], partition: str = "fetch_date") -> StreamingQuery:
    """Merge every micro-batch into the days of the history.

    A repeated batch, also one of a new checkpoint, finds its keys there and changes nothing.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        sink_merge_days(batch, out, keys, order, partition)

    query = (df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


class _LastStatic(StatefulProcessor):
    """Static messages of a group of vessels, and of each position the one that was valid at its time.

    The state is a list with a row per vessel and change of its static fields. All vessels of a group are worked on
    at once, in columns. With ``keep_us`` a timer of event time removes what a later change of the same vessel
    has replaced for longer than that.
    """

    def __init__(self, fields: Sequence[str], columns: Sequence[str], keep_us: int | None):
        self.fields, self.columns, self.keep_us = list(fields), list(columns), keep_us
        self.kept = [_VESSEL, _AT, _ID, *self.fields]

    def init(self, handle) -> None:
        self.handle = handle
        values = ", ".join(f"`{f}` string" for f in self.fields)
        self.known = handle.getListState("known", f"`{_VESSEL}` string, `{_AT}` long, `{_ID}` long, {values}")

    def _older(self) -> pd.DataFrame:
        return pd.DataFrame(list(self.known.get()), columns=self.kept, dtype=object)

    def _replaced(self, known: pd.DataFrame) -> pd.Series:
        """When the next change of the same vessel came; ``known`` is in order."""
        same = known[_VESSEL].eq(known[_VESSEL].shift(-1)) | (known[_VESSEL].isna() & known[_VESSEL].shift(-1).isna())
        same.iloc[-1:] = False
        return known[_AT].shift(-1).where(same, _NEVER).astype("int64")

    def _store(self, known: pd.DataFrame, older: int, watermark_ms: int) -> None:
        """Write ``known`` (in order, with the row it was, counted from the ``older`` ones); add if no older row went."""
        if self.keep_us is not None and len(known):
            known = known[self._replaced(known) > watermark_ms * 1000 - self.keep_us]
        was = known["was"].to_numpy(np.int64)
        rows = known[self.kept].astype(object).where(known[self.kept].notna(), None)
        if older and (was < older).sum() == older:
            if len(new := rows[was >= older]):
                self.known.appendList([tuple(r) for r in new.itertuples(index=False)])
        else:
            self.known.put([tuple(r) for r in rows.itertuples(index=False)])
        if self.keep_us is not None and len(known):
            next_ = self._replaced(known)
            if (next_ < _NEVER).any():
                due = (int(next_.min()) + self.keep_us) // 1000 + 1
                if due > watermark_ms and due not in set(self.handle.listTimers()):
                    self.handle.registerTimer(due)

    def _order(self, known: pd.DataFrame) -> pd.DataFrame:
        known["was"] = np.arange(len(known))
        return known.sort_values([_VESSEL, _AT, _ID], kind="stable", ignore_index=True)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        static = batch[_STATIC].to_numpy(bool)
        older = self._older()
        known = self._order(pd.concat([older, batch.loc[static, self.kept].astype(object)], ignore_index=True))
        if len(known):
            compared = known[[_VESSEL, *self.fields]]
            before = compared.shift()
            same = (compared.fillna("").eq(before.fillna("")) & compared.isna().eq(before.isna())).all(axis=1)
            same.iloc[0] = False
            known = known[~same].reset_index(drop=True)
        seen = batch[~static].reset_index(drop=True)
        if len(seen):
            # places of the positions among the static messages of their vessel, by time, then number
            vessel = pd.factorize(pd.concat([known[_VESSEL], seen[_VESSEL]]), use_na_sentinel=False)[0]
            at = np.concatenate([known[_AT].to_numpy(np.int64), seen[_AT].to_numpy(np.int64)])
            number = np.concatenate([known[_ID].to_numpy(np.int64), seen[_ID].to_numpy(np.int64)])
            order = np.lexsort((np.arange(len(at)), number, at, vessel))
            last = np.empty(len(at), np.int64)
            # the last static message before, in the order; of another vessel, it is none
            place = np.maximum.accumulate(np.where(order < len(known), np.arange(len(at)), -1))
            found = np.where(place >= 0, order[place], -1)
            last[order] = np.where((found >= 0) & (vessel[found] == vessel[order]), found, -1)
            valid = last[len(known):]
            for f in self.fields:
                found = np.append(known[f].to_numpy(object), None)[valid]
                if f == "ship_name":
                    own = seen[f].to_numpy(object)
                    found = np.where(pd.isna(found) | (found == ""), own, found)
                seen[f] = found
            yield seen[self.columns]
        if static.any():
            self._store(known, len(older), self._now(timerValues))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        older = self._older()
        self._store(self._order(older), len(older), self._now(timerValues))
        yield from ()

    def _now(self, timerValues) -> int:
        return 0 if self.keep_us is None else timerValues.getCurrentWatermarkInMs()

    def close(self) -> None:
        pass


# rows reach the state as named tuples, which have no names with a leading underscore
_AT, _ID, _STATIC, _PART, _VESSEL, _GROUP = "at__", "id__", "static__", "part__", "vessel__", "group__"
_NEVER = 2**62
GROUPS = 64  # of vessels, whose changes share a state


def enrich_static_stream(messages: DataFrame, order: Sequence[str] = (TIME, "message_id"), parts: int = 8,
                         keep_days: int | None = None, delay: str = "1 hour",
                         fields: Sequence[str] = STATIC_FIELDS, groups: int = GROUPS) -> DataFrame:
    """Positions of a stream with the vessel's last earlier static message, from keyed state.

    The state holds a row per vessel and change of its static fields, so that a late position finds the
    one that was valid at its time. Vessels are dealt to ``groups``, each of which is one state and one call of
    Python a batch, whatever the number of vessels; a batch costs what its own rows and the changes of their
    groups cost, and only new changes are written. More vessels than some hundred thousand want more
    groups; a checkpoint keeps the number it began with. A group's positions are dealt to ``parts`` states, each of which gets all
    its static messages, so a vessel with a third of all rows is not one task. Nothing is forgotten
    unless ``keep_days`` are given: then rows more than ``delay`` late are left out, and a timer
    of event time removes changes that were replaced so many days before the watermark.

    A position takes what has come up to its batch and is not revised afterwards. Null times and numbers come
    before all others; vessels without a number are one.
    """
    types = {f.name: f.dataType for f in messages.schema}
    # pandas has no whole numbers with nulls, so such columns travel as text
    whole = [c for c, t in types.items() if isinstance(t, (IntegralType, DecimalType)) or c in fields]
    times = [c for c, t in types.items() if isinstance(t, (TimestampType, DateType))]
    static = F.coalesce(F.col("message_type") == "ShipStaticData", F.lit(False))
    df = messages if keep_days is None else messages.withWatermark(order[0], delay)
    df = df.where(static | (F.col("message_type") == "PositionReport")).withColumns({
        _AT: F.coalesce(F.unix_micros(order[0]), F.lit(-_NEVER)),
        _ID: F.coalesce(F.col(order[1]).cast("long"), F.lit(-_NEVER)),
        _STATIC: static,
        _PART: F.explode(F.when(static, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(
            F.array(F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int")))),
        _VESSEL: F.col("mmsi").cast("string"),
        _GROUP: F.pmod(F.xxhash64(F.col("mmsi").cast("string")), F.lit(groups)).cast("int")})
    sent = [*(F.col(c).cast("string").alias(c) if c in whole else
              F.unix_micros(F.col(c).cast("timestamp")).cast("string").alias(c) if c in times else F.col(c)
              for c in types), _AT, _ID, _STATIC, _PART, _VESSEL, _GROUP]
    event_time = [] if keep_days is None else [F.col(order[0]).alias("event_time__")]
    out = ", ".join(f"`{c}` {'string' if c in whole or c in times else t.simpleString()}" for c, t in types.items())
    keep_us = None if keep_days is None else keep_days * 86_400_000_000
    found = df.select(*sent, *event_time).groupBy(_GROUP, _PART).transformWithStateInPandas(
        _LastStatic(fields, list(types), keep_us), out, "append", "None" if keep_days is None else "EventTime")
    return found.select(*(F.timestamp_micros(F.col(c).cast("long")).cast(t).alias(c) if c in times
                          else F.col(c).cast(t).alias(c) for c, t in types.items()))


def stream_enrich_static(messages: DataFrame, out: str, checkpoint: str, **settings) -> StreamingQuery:
    """``enrich_static_stream`` of what has landed, appended to ``out`` as Parquet.

    Its state is in the checkpoint, so the next run goes on from there.
    """
    spark = messages.sparkSession
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        return run_available(enrich_static_stream(messages, **settings), out, checkpoint)
    finally:
        spark.conf.set(name, before)

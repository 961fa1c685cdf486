"""Streams against their batch form, over several micro-batches."""

from pyspark.sql import functions as F

from tradelane.operators import asof
from tradelane.registry import vessel_messages
from tradelane.standin import TABLE_SCHEMAS, vessel_rows
from tradelane.streaming import vessels as stream

KEEP = ("message_id", "mmsi", "ship_name", "imo", "destination", "vessel_type")


def landed_in_order(spark, sf_dir, tmp_path, parts=3):
    """Events as one file per time slice, read one file per batch."""
    events = spark.read.schema(TABLE_SCHEMAS["events"]).parquet(f"{sf_dir}/events.parquet")
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    step = 1000 // parts + 1
    for i in range(parts):
        part = events.where((F.col("event_id") >= i * step) & (F.col("event_id") < (i + 1) * step))
        part.coalesce(1).write.parquet(str(tmp_path / "in" / f"p{i}"))
    source = (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
              .parquet(str(tmp_path / "in" / "*")))
    return events, source


def test_enrich_static_across_batches(spark, sf_dir, tmp_path):
    events, source = landed_in_order(spark, sf_dir, tmp_path)
    out = str(tmp_path / "out")
    query = stream.stream_enrich_static(vessel_messages(source), out, str(tmp_path / "ck"))
    assert query.lastProgress["batchId"] >= 2
    got = spark.read.parquet(out).select(*KEEP)
    want = asof.enrich_static(vessel_messages(events)).select(*KEEP)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_history_is_written_once(spark, sf_dir, tmp_path):
    events, source = landed_in_order(spark, sf_dir, tmp_path)
    rows = vessel_rows(source).select("event_id", "fetch_date")
    out = str(tmp_path / "out")
    for ck in ("ck", "ck", "new"):  # nothing new, then everything again under a new checkpoint
        stream.stream_upsert_history(rows, out, str(tmp_path / ck), ["event_id"], [F.col("event_id")])
    ids = [r.event_id for r in spark.read.parquet(out).collect()]
    assert len(ids) == len(set(ids)) == events.count()


def test_daily_last_position_over_batches(spark, sf_dir, tmp_path):
    events, source = landed_in_order(spark, sf_dir, tmp_path)
    df = stream.stream_dedupe_daily(vessel_rows(source), ["event_id"], delay="40 days")
    rows = stream.run_complete(df, str(tmp_path / "out"), str(tmp_path / "ck"), ["mmsi", "day"], "day.end").collect()
    got = {(r.mmsi, r.day.start.date()): r.event_id for r in rows}
    assert len(got) == len(rows)
    want = {}
    for r in vessel_rows(events).orderBy("event_time_utc").collect():
        want[(r.mmsi, r.fetch_date)] = r.event_id
    assert got == want and not all(r.final for r in rows)


def test_late_positions_find_the_static_of_their_time(spark, tmp_path):
    """An old static message is remembered, and a late position takes the one before it."""
    def land(i, rows):
        spark.createDataFrame(rows, SCHEMA).withColumn("event_time_utc", F.to_timestamp("t")).drop("t") \
            .coalesce(1).write.parquet(str(tmp_path / "in" / f"p{i}"))

    SCHEMA = ("message_id long, mmsi long, t string, message_type string, ship_name string, imo long, "
              "call_sign string, destination string, vessel_type int, eta string")
    static = lambda i, t, name: (i, 1, t, "ShipStaticData", name, i, None, None, None, None)
    seen = lambda i, t: (i, 1, t, "PositionReport", None, None, None, None, None, None)
    land(0, [static(1, "2024-01-01", "OLD")])
    land(1, [seen(2, "2024-02-20"), static(3, "2024-02-21", "NEW")])
    land(2, [seen(4, "2024-02-22")])
    land(3, [seen(5, "2024-02-19")])
    schema = spark.read.parquet(str(tmp_path / "in" / "p0")).schema
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    out = str(tmp_path / "out")
    stream.stream_enrich_static(source, out, str(tmp_path / "ck"))
    assert {r.message_id: r.ship_name for r in spark.read.parquet(out).collect()} == {2: "OLD", 4: "NEW", 5: "OLD"}


def test_rows_of_closed_days_are_merged(spark, tmp_path):
    """Files out of time order, one a batch: days that are long closed still change."""
    schema = "event_id long, mmsi long, t string, route string, sog_knots double"
    files = [[(1, 1, "2024-01-01 10:00", "A", 1.0)], [(2, 1, "2024-03-01 10:00", "A", 2.0)],
             [(3, 1, "2024-01-01 12:00", "A", 3.0), (4, 2, "2024-01-02 09:00", "B", None)],
             [(5, 1, "2024-01-01 08:00", "A", 5.0)], [(6, 1, "2024-03-02 10:00", "A", 6.0)]]
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, schema).withColumn("event_time_utc", F.to_timestamp("t")).drop("t") \
            .coalesce(1).write.parquet(str(tmp_path / "in" / f"p{i}"))
    source = (spark.readStream.schema(spark.read.parquet(str(tmp_path / "in" / "p0")).schema)
              .option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*")))
    last = stream.run_merged(source, str(tmp_path / "d"), str(tmp_path / "dc"),
                             lambda df: stream.daily_partial(df, ["sog_knots"]), stream.daily_merge,
                             stream.daily_finish).collect()
    assert {(r.mmsi, str(r.day.start.date())): (r.sog_knots, r.final) for r in last} == {
        (1, "2024-01-01"): (3.0, True), (1, "2024-03-01"): (2.0, True), (2, "2024-01-02"): (None, True),
        (1, "2024-03-02"): (6.0, False)}
    got = stream.run_merged(source, str(tmp_path / "r"), str(tmp_path / "rc"),
                            stream.route_partial, stream.route_merge).collect()
    assert {(r.route, str(r.day.start.date())): (r.messages, r.speed_sum, r.speeds) for r in got} == {
        ("A", "2024-01-01"): (3, 9.0, 3), ("A", "2024-03-01"): (1, 2.0, 1), ("B", "2024-01-02"): (1, None, 0),
        ("A", "2024-03-02"): (1, 6.0, 1)}


def test_runs_merge_only_the_days_they_touch(spark, tmp_path):
    """Four runs, the later ones with late rows: days without news keep their files, batches do not stay."""
    schema = "event_id long, mmsi long, t string, route string, sog_knots double"
    runs = [[(1, 1, "2024-01-01 10:00", "A", 1.0), (2, 1, "2024-01-02 10:00", "A", 2.0)],
            [(3, 2, "2024-01-03 10:00", "B", 3.0)],
            [(4, 1, "2024-01-01 09:00", "A", 4.0)], []]
    out, files = str(tmp_path / "out"), {}

    def days():
        return {p.parent.name: p.name for p in (tmp_path / "out" / "days").glob("*/*.parquet")}

    def run(checkpoint="ck"):
        source = (spark.readStream.schema(spark.read.parquet(str(tmp_path / "in" / "p0")).schema)
                  .option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*")))
        got = stream.run_merged(source, out, str(tmp_path / checkpoint), stream.route_partial, stream.route_merge)
        return {(r.route, str(r.day.start.date())): (r.messages, r.speed_sum, r.final) for r in got.collect()}

    for i, rows in enumerate(runs):
        if rows:
            spark.createDataFrame(rows, schema).withColumn("event_time_utc", F.to_timestamp("t")).drop("t") \
                .coalesce(1).write.parquet(str(tmp_path / "in" / f"p{i}"))
        before, got = files, run()
        files = days()
        changed = {d for d in files if files[d] != before.get(d)}
        assert changed == {f"day_start={r[2][:10]}" for r in rows}, i
        assert not list((tmp_path / "out" / "batches").glob("batch=*"))
    want = {("A", "2024-01-01"): (2, 5.0, True), ("A", "2024-01-02"): (1, 2.0, True), ("B", "2024-01-03"): (1, 3.0, False)}
    assert got == want
    assert run("new") == want  # all again under a new checkpoint


def test_a_batch_that_is_merged_again_changes_nothing(spark, tmp_path):
    rows = spark.createDataFrame([("A", 1, "2024-01-01 10:00", 1.0)], "route string, mmsi long, t string, sog_knots double")
    parts = stream.route_partial(rows.withColumn("event_time_utc", F.to_timestamp("t"))).withColumn("batch", F.lit(3))
    known, path = {"upto": 2, "seen": None}, str(tmp_path / "days")
    for _ in range(2):  # as after a failure before the state was written
        assert stream._compact(parts, path, stream.route_merge, known)["upto"] == 3
    assert [(r.messages, r.upto) for r in spark.read.parquet(path).collect()] == [(1, 3)]


MESSAGE = ("message_id long, mmsi long, t string, message_type string, ship_name string, imo long, "
           "call_sign string, destination string, vessel_type int, eta string, sog_knots double")


def land_messages(spark, tmp_path, i, rows):
    spark.createDataFrame(rows, MESSAGE).withColumn("event_time_utc", F.to_timestamp("t")).drop("t") \
        .coalesce(1).write.parquet(str(tmp_path / "in" / f"p{i}"))


def test_keyed_state_goes_on_after_a_restart(spark, tmp_path):
    """Six batches in two runs; a third of all rows is one vessel's, and positions come late."""
    def message(i):
        vessel = None if i % 17 == 5 else 0 if i % 3 == 0 else i % 7 + 1
        static = i % 4 == 0
        name = ["", None, f"SHIP {i % 5}"][i % 3] if static else ("OWN" if i % 2 else None)
        day = i // 20 if static or i % 5 else max(0, i // 20 - 4)  # some positions are days late
        return (i, vessel, f"2024-01-{day + 1:02d} {i % 24:02d}:00:00", "ShipStaticData" if static else "PositionReport", name,
                2**60 + i if static and i % 8 else None, f"C{i % 2}" if static else None, None, i % 90 if static else None, None,
                None if static else i / 10)
    batches = [[message(i) for i in range(b * 60, b * 60 + 60)] for b in range(6)]
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    for run in (range(3), range(3, 6)):
        for b in run:
            land_messages(spark, tmp_path, b, batches[b])
        source = (spark.readStream.schema(spark.read.parquet(str(tmp_path / "in" / "p0")).schema)
                  .option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*")))
        stream.stream_enrich_static(source, out, ck, parts=3)
    known, want = [], {}
    for rows in batches:
        known += [r for r in rows if r[3] == "ShipStaticData"]
        for r in rows:
            if r[3] != "ShipStaticData":
                before = [k for k in known if k[1] == r[1] and (k[2], k[0]) <= (r[2], r[0])]
                k = max(before, key=lambda k: (k[2], k[0]), default=None)
                want[r[0]] = (r[1], k[4] or r[4], k[5], k[6], k[8], r[10]) if k else (r[1], r[4], None, None, None, r[10])
    got = spark.read.parquet(out)
    assert {r.message_id: (r.mmsi, r.ship_name, r.imo, r.call_sign, r.vessel_type, r.sog_knots)
            for r in got.collect()} == want
    assert got.schema["imo"].dataType.typeName() == "long" and got.count() == len(want)


def test_timers_forget_what_was_replaced_long_ago(spark, tmp_path):
    static = lambda i, v, t, name: (i, v, t, "ShipStaticData", name, i, None, None, None, None, None)
    seen = lambda i, v, t: (i, v, t, "PositionReport", None, None, None, None, None, None, 1.0)
    files = [[static(1, 1, "2024-01-01 00:00:00", "A"), static(2, 1, "2024-01-03 00:00:00", "B")],
             [static(3, 1, "2024-01-04 00:00:00", "B"), seen(4, 1, "2024-01-02 12:00:00")],
             [seen(5, 2, "2024-01-20 00:00:00")], [seen(6, 1, "2024-01-21 00:00:00")], [seen(7, 2, "2024-01-22 00:00:00")]]
    for i, rows in enumerate(files):
        land_messages(spark, tmp_path, i, rows)
    source = (spark.readStream.schema(spark.read.parquet(str(tmp_path / "in" / "p0")).schema)
              .option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*")))
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    stream.stream_enrich_static(source, out, ck, parts=1, keep_days=5, delay="3 days")
    assert {r.message_id: r.ship_name for r in spark.read.parquet(out).collect()} == {4: "A", 5: None, 6: "B", 7: None}
    kept = spark.read.format("statestore").option("stateVarName", "known").load(ck)
    assert kept.count() == 1  # B, once, however often it was said; A went by a timer


def test_vessels_share_states(spark, tmp_path):
    """Two hundred vessels are two states, so that calls of Python do not grow with the vessels."""
    for b in range(2):
        rows = [(1000 * b + i, i % 200, f"2024-01-0{b + 1} {i // 40:02d}:00:00", "ShipStaticData" if i < 200 and (b or i % 3) else "PositionReport",
                 f"S{i}" if i < 200 and b == 0 and i % 3 else "N" if i < 200 and b else None, None, None, None, None, None, 1.0) for i in range(400)]
        land_messages(spark, tmp_path, b, rows)
    source = (spark.readStream.schema(spark.read.parquet(str(tmp_path / "in" / "p0")).schema)
              .option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*")))
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    stream.stream_enrich_static(source, out, ck, parts=1, groups=2)
    got = {r.message_id: r.ship_name for r in spark.read.parquet(out).collect()}
    want = {i: f"S{i % 200}" if i % 200 % 3 else None for i in range(400) if i >= 200 or i % 3 == 0}
    assert got == want | {1000 + i: "N" for i in range(200, 400)}
    known = spark.read.format("statestore").option("stateVarName", "known").load(ck)
    assert known.select("key").distinct().count() == 2 and known.count() == 200 + sum(1 for i in range(200) if i % 3)


def test_sketches_of_batches_are_near_the_exact_numbers(spark):
    rows = spark.range(60_000).selectExpr(
        "concat('R', id % 2) AS route", "id % 17011 AS mmsi", "CAST(id % 5 AS DOUBLE) AS sog_knots",
        "timestamp'2024-01-01' + make_dt_interval(CAST(id % 9 AS INT)) AS event_time_utc")
    parts = [stream.route_sketches(rows.where(f"id % 3 = {i}")) for i in range(3)]
    about = stream.approx_route_windows(stream.merge_sketches(parts[0].unionAll(parts[1]).unionAll(parts[2])))
    exact = {(r.window_start, r.route): r for r in stream.route_windows(stream.route_partial(rows)).collect()}
    got = about.collect()
    assert len(got) == len(exact) == 30
    for r in got:
        e = exact[(r.window_start, r.route)]
        assert r.messages == e.messages and abs(r.avg_speed - e.avg_speed) < 1e-9
        assert abs(r.vessels - e.vessels) <= 0.049 * e.vessels

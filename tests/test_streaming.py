"""Streaming = batch on closed windows, restart from checkpoint, dead letters,
stream z-score, source options."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from trackstream.operators import anomaly, clean, trends, windows
from trackstream.plans import compose as P
from trackstream.schema import PipelineConfig
from trackstream.sources import messages as M
from trackstream.sources.streams import MESSAGE_SCHEMA, kafka_options, read_stream
from trackstream.streaming import runner as R

HALF = "2024-01-15 00:00:00"
CFG = PipelineConfig(window="1 day", watermark="10 minutes")


@pytest.fixture(scope="module")
def landed(spark):
    import tempfile
    root = tempfile.mkdtemp(prefix="ts-stream-")
    msgs = M.messages_from_flights(P.flights(spark, SF_SMALL))
    msgs.filter(F.col("timestamp") < HALF).coalesce(1).write.parquet(root + "/in/p1")
    msgs.filter((F.col("timestamp") >= HALF) | F.col("timestamp").isNull()) \
        .coalesce(1).write.parquet(root + "/in/p2")
    # the batch side reads the landed files, exactly what the stream consumed
    return root, spark.read.parquet(root + "/in/*")


def _batch_valid(msgs):
    parsed = M.good_records(M.envelope(msgs), keep_wrong_type=False)
    c = clean.clean_events(parsed)
    return c.filter("data_quality = 'valid'")


def test_stream_equals_batch(spark, landed):
    root, msgs = landed
    raw = read_stream(spark, "files", path=root + "/in/*", schema=MESSAGE_SCHEMA,
                      max_per_trigger=1)
    layout = R.StreamLayout(root + "/out", root + "/ckpt")
    R.run_stream(spark, raw, layout, CFG, stream_z=False, trigger="availableNow", wait=True)
    p = spark.read.parquet(layout.table("processed"))
    # exact duplicates are simultaneous, so within-watermark dedup agrees with
    # the batch dedup except for rows whose position time is NULL
    stream_ids = {r.event_id for r in p.filter("event_id IS NOT NULL").collect()}
    batch = _batch_valid(msgs)
    batch_ids = {r.event_id for r in batch.filter("time_position IS NOT NULL").collect()}
    keyed = {r.event_id for r in p.join(batch.select("event_id", "time_position"), "event_id")
             .filter("time_position IS NOT NULL").collect()}
    assert batch_ids == keyed
    assert p.count() == len(stream_ids)          # no duplicates
    dead = {r.reason: r["count"] for r in spark.read.parquet(layout.table("dead_letters"))
            .groupBy("reason").count().collect()}
    assert set(dead) == {"malformed_json", "null_value", "wrong_type", "missing_key",
                         "unreadable_time"}

    # closed windows equal the batch windows over the same processed table
    w = spark.read.parquet(layout.table("windows"))
    wm = p.agg(F.max("event_time")).first()[0]
    import datetime as dt
    closed = F.col("window_end") <= F.lit(wm - dt.timedelta(minutes=10))
    bw = windows.window_stats(p.drop("query_id", "batch_id"), duration="1 day").filter(closed)
    cols = ["window_start", "icao24", "flight_events", "avg_velocity", "flight_behavior"]
    a = sorted(tuple(r) for r in w.filter(closed).select(*cols).collect())
    b = sorted(tuple(r) for r in bw.select(*cols).collect())
    assert a == b and len(a) > 0
    # trend labels equal the batch trends over the same closed windows
    tcols = cols + ["prev_avg_velocity", "prev_avg_altitude", "velocity_trend",
                    "altitude_trend", "trend_summary"]
    bt = trends.calculate_trends(bw)
    assert sorted(map(str, w.filter(closed).select(*tcols).collect())) == \
        sorted(map(str, bt.select(*tcols).collect()))

    # every usable message takes one route: dead letters or the processed feed
    def ids(df):
        return {r[0] for r in df.select("event_id").dropna().collect()}
    wrong = M.parse_payload(M.unwrap_nested_json(
        spark.read.parquet(layout.table("dead_letters")).filter("reason = 'wrong_type'")
        .select("value")))
    assert ids(wrong) and not ids(wrong) & ids(p)

    # Every dashboard report recomputes over the whole landed tables
    from trackstream.streaming.sinks import refresh_reports
    reps = refresh_reports(spark, layout.table("processed"), layout.table("windows"))
    assert reps["kpi_summary"].first().total_events == p.count()
    assert reps["latest_events"].count() == 50
    for name, df in reps.items():
        df.collect()

    # Sliding windows on the stream equal the batch sliding windows
    cfg_s = PipelineConfig(window="1 day", slide="12 hours", watermark="10 minutes")
    slayout = R.StreamLayout(root + "/sout", root + "/sckpt")
    schema = spark.read.parquet(layout.table("processed")).schema
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    import shutil
    shutil.copytree(layout.table("processed"), slayout.table("processed"))
    R.start_windows(spark, slayout, schema, cfg_s, trigger="availableNow").awaitTermination()
    sw = spark.read.parquet(slayout.table("windows")).filter(closed)
    bsw = windows.sliding_stats(p.drop("query_id", "batch_id"), duration="1 day", slide="12 hours") \
        .filter(closed)
    a = sorted(tuple(r) for r in sw.select(*cols).collect())
    b = sorted(tuple(r) for r in bsw.select(*cols).collect())
    assert a == b and len(a) > len(set((x[1]) for x in a))


def test_restart_from_checkpoint(spark, landed):
    import shutil
    import tempfile
    root, _ = landed
    work = tempfile.mkdtemp(prefix="ts-restart-")
    shutil.copytree(root + "/in/p1", work + "/in/p1")
    layout = R.StreamLayout(work + "/out", work + "/ckpt")
    raw = read_stream(spark, "files", path=work + "/in/*", schema=MESSAGE_SCHEMA)
    R.start_processed(raw, layout, CFG, trigger="availableNow").awaitTermination()
    first = spark.read.parquet(layout.table("processed")).count()
    shutil.copytree(root + "/in/p2", work + "/in/p2")
    raw = read_stream(spark, "files", path=work + "/in/*", schema=MESSAGE_SCHEMA)
    q = R.start_processed(raw, layout, CFG, trigger="availableNow")
    q.awaitTermination()
    p = spark.read.parquet(layout.table("processed"))
    assert p.count() > first
    assert p.count() == p.select("event_id").distinct().count()
    assert R.progress_metrics(q)["batchId"] is not None
    seen = [pr.get("observedMetrics", {}).get("quality") for pr in q.recentProgress]
    seen = [m for m in seen if m]
    assert seen and all(int(m["rows"]) == int(m["valid"]) + int(m["invalid"]) for m in seen)


@pytest.mark.parametrize("per_key", [False, True])
def test_stream_zscore_equals_batch(spark, landed, per_key):
    """Every row of every closed window has the batch z-score, fleet-wide or per
    entity, and comes out once."""
    import datetime as dt
    import tempfile
    root, _ = landed
    work = tempfile.mkdtemp(prefix="ts-z-")
    layout = R.StreamLayout(work + "/out", work + "/ckpt")
    raw = read_stream(spark, "files", path=root + "/in/*", schema=MESSAGE_SCHEMA,
                      max_per_trigger=1)
    cfg = PipelineConfig(window="1 day", watermark="10 minutes", zscore_window="1 day",
                         zscore_per_key=per_key, zscore_threshold=1.5)
    R.run_stream(spark, raw, layout, cfg, trigger="availableNow", wait=True)
    rows = spark.read.parquet(layout.table("landed"))
    upto = rows.agg(F.max("event_time")).first()[0] - dt.timedelta(minutes=10)
    closed = rows.filter(F.window("event_time", "1 day").end <= F.lit(upto))
    batch = anomaly.zscore_anomalies(closed.filter("reject_reason is null"), threshold=1.5,
                                     window_duration="1 day", per_key=per_key)
    cols = ["event_id", "icao24", "event_time", F.round("velocity_zscore", 9),
            F.round("altitude_zscore", 9), "is_stat_anomaly"]

    def text(df):
        return sorted(map(str, df.select(*cols).collect()))
    p = spark.read.parquet(layout.table("processed"))
    assert text(p) == text(batch.filter("data_quality = 'valid'")) and p.count() > 300
    bad = spark.read.parquet(layout.table("invalid"))
    assert bad.count() == closed.filter("data_quality <> 'valid'").count() > 0
    # The windows count anomalies that are there
    w = spark.read.parquet(layout.table("windows"))
    want = p.filter(F.window("event_time", "1 day").end <= F.lit(
        p.agg(F.max("event_time")).first()[0] - dt.timedelta(minutes=10)))
    assert w.agg(F.sum("anomaly_count")).first()[0] == want.filter("is_stat_anomaly").count() > 0


def test_zscore_state_is_moments_only(spark, landed):
    """The streaming aggregate keeps no rows."""
    root, _ = landed
    raw = read_stream(spark, "files", path=root + "/in/*", schema=MESSAGE_SCHEMA)
    plan = anomaly.window_moments(R.cleaned_stream(raw, CFG))
    text = plan._jdf.queryExecution().analyzed().toString()
    assert "collect_list" not in text and "stddev_samp" in text


def test_new_checkpoint_appends(spark, landed):
    """Other messages with a new checkpoint on existing tables are all published
    beside the old rows, by every query, in append and update mode."""
    import tempfile
    root, _ = landed
    work = tempfile.mkdtemp(prefix="ts-fresh-")

    def run(part, ckpt):
        raw = read_stream(spark, "files", path=f"{root}/in/{part}", schema=MESSAGE_SCHEMA)
        layout = R.StreamLayout(work + "/out", f"{work}/{ckpt}")
        R.start_processed(raw, layout, CFG, trigger="availableNow").awaitTermination()
        R.start_dead_letters(raw, layout, CFG, trigger="availableNow").awaitTermination()
        schema = R.processed_schema(raw, CFG)
        R.start_windows(spark, layout, schema, CFG, trigger="availableNow").awaitTermination()
        R.start_window_updates(spark, layout, schema, CFG,
                               trigger="availableNow").awaitTermination()
        return {t: spark.read.parquet(layout.table(t)).count()
                for t in ("processed", "invalid", "dead_letters")}

    first, both = run("p1", "c1"), run("p2", "c2")
    alone = {}
    for part in ("p1", "p2"):
        raw = read_stream(spark, "files", path=f"{root}/in/{part}", schema=MESSAGE_SCHEMA)
        layout = R.StreamLayout(f"{work}/alone-{part}", f"{work}/ckpt-{part}")
        R.start_processed(raw, layout, CFG, trigger="availableNow").awaitTermination()
        R.start_dead_letters(raw, layout, CFG, trigger="availableNow").awaitTermination()
        alone[part] = {t: spark.read.parquet(layout.table(t)).count() for t in first}
    assert first == alone["p1"] and all(n > 0 for n in alone["p2"].values())
    assert both == {t: first[t] + alone["p2"][t] for t in first}
    # newest versions of the windows hold the rows of both runs
    p = spark.read.parquet(work + "/out/processed")
    cols = ["window_start", "icao24", "flight_events", "avg_velocity"]
    want = sorted(map(str, windows.window_stats(p, duration="1 day").select(*cols).collect()))
    got = R.latest_windows(spark, work + "/out/window_updates").select(*cols).collect()
    assert sorted(map(str, got)) == want
    closed = R.latest_windows(spark, work + "/out/windows").select(*cols).collect()
    assert closed and {str(r) for r in closed} <= set(want)


def test_ledger_heals_and_refuses(spark, landed):
    """A job lost between the rename and the ledger entry adds nothing when it runs
    again; a scored query without its checkpoint does not publish its rows twice."""
    import shutil
    import tempfile
    from trackstream.streaming.ledger import Ledger
    root, _ = landed
    work = tempfile.mkdtemp(prefix="ts-ledger-")
    ledger = Ledger(spark, work + "/out")
    df = spark.range(10).withColumn("at", F.timestamp_seconds("id"))
    assert ledger.publish(df, "t", "q1", 0, time_col="at")
    assert not ledger.publish(spark.range(5), "t", "q1", 0)
    shutil.rmtree(work + "/out/_ledger")
    assert not ledger.publish(df, "t", "q1", 0, time_col="at")
    assert ledger.publish(df, "t", "q2", 0, time_col="at")
    assert [(r.query_id, r.rows) for r in ledger.entries("t").orderBy("query_id").collect()] == \
        [("q1", 10), ("q2", 10)]
    import datetime as dt
    lo = dt.datetime.fromtimestamp(4)
    assert ledger.read_between("t", "q1", df.schema, "at", lo, lo + dt.timedelta(seconds=3)).count() == 3
    assert spark.read.parquet(work + "/out/t").count() == 20

    layout = R.StreamLayout(work + "/s", work + "/ckpt")
    raw = read_stream(spark, "files", path=root + "/in/*", schema=MESSAGE_SCHEMA)
    schema = R.landed_schema(raw, CFG)
    with pytest.raises(ValueError):
        R.start_scored(spark, layout, schema, CFG, trigger="availableNow")
    R.start_landed(raw, layout, CFG, trigger="availableNow").awaitTermination()
    R.start_scored(spark, layout, schema, CFG, trigger="availableNow").awaitTermination()
    rows = spark.read.parquet(layout.table("processed")).count()
    shutil.rmtree(layout.checkpoint("scored"))
    with pytest.raises(ValueError):
        R.start_scored(spark, layout, schema, CFG, trigger="availableNow")
    assert spark.read.parquet(layout.table("processed")).count() == rows > 0


def test_trend_state_expires(spark):
    """The state of an entity that is silent for longer than the expiry is gone, under
    availableNow too, and its next window has no history."""
    import datetime as dt
    import tempfile
    work = tempfile.mkdtemp(prefix="ts-exp-")
    t0 = dt.datetime(2024, 1, 1)

    def rows(key, minutes):
        return [(key, t0 + dt.timedelta(minutes=m), float(100 + m), 1000.0) for m in minutes]
    schema = "icao24 string, event_time timestamp, avg_velocity double, avg_altitude double"
    # 'gone' stops early; 'back' pauses; 'on' goes on
    feed = [rows("gone", [1]) + rows("back", [2]) + rows("on", [3, 13, 23]),
            rows("on", [33, 63, 93, 123, 153]), rows("back", [165]) + rows("on", [170]),
            rows("on", [200])]
    for part in feed:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(work + "/in")
    src = (spark.readStream.schema(spark.read.parquet(work + "/in").schema)
           .option("maxFilesPerTrigger", 1).parquet(work + "/in").withWatermark("event_time", "5 minutes"))
    win = src.groupBy(F.window("event_time", "10 minutes").alias("window"), "icao24").agg(
        F.avg("avg_velocity").alias("avg_velocity"), F.avg("avg_altitude").alias("avg_altitude"))
    win = win.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                     F.window_time("window").alias("window_time"), "icao24", "avg_velocity",
                     "avg_altitude")
    from trackstream.streaming.stateful import ROCKSDB_PROVIDER, stream_trends
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    q = (stream_trends(win, expiry="40 minutes").writeStream.format("parquet")
         .option("path", work + "/out").option("checkpointLocation", work + "/ckpt")
         .trigger(availableNow=True).start())
    assert q.awaitTermination(240)
    got = spark.read.parquet(work + "/out")
    batch = win_batch(spark, work + "/in").filter(F.col("window_end") <= F.lit(
        t0 + dt.timedelta(minutes=195)))
    cols = ["window_start", "icao24", "prev_avg_velocity", "velocity_trend", "trend_summary"]
    want = trends.calculate_trends(batch, max_gap="40 minutes").select(*cols)
    assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, want.collect()))
    labels = {(r.icao24, r.window_start): r.velocity_trend for r in got.collect()}
    assert labels["back", t0 + dt.timedelta(minutes=160)] == "no_history"
    state = (spark.read.format("statestore").option("operatorId", 0).option("stateVarName", "prev")
             .load(work + "/ckpt"))
    held = {r.key[0] for r in state.select("key").collect()}
    assert "gone" not in held and "on" in held


def win_batch(spark, path):
    g = spark.read.parquet(path).groupBy(F.window("event_time", "10 minutes").alias("w"), "icao24").agg(
        F.avg("avg_velocity").alias("avg_velocity"), F.avg("avg_altitude").alias("avg_altitude"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "icao24", "avg_velocity", "avg_altitude")


def test_sliding_windows_copy_panes_not_rows(spark):
    """Event rows are aggregated into panes before anything is copied to windows."""
    df = P.valid_features(spark, SF_SMALL)
    plan = windows.sliding_stats(df, duration="1 hour", slide="15 minutes")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    lines = text.splitlines()
    expand = next(i for i, x in enumerate(lines) if "Expand" in x)
    assert any("Aggregate" in x for x in lines[expand + 1:])
    assert sum("Expand" in x for x in lines) == 1
    # every row is in four windows, of an odd slide too
    assert plan.agg(F.sum("flight_events")).first()[0] == 4 * df.count()
    odd = windows.sliding_stats(df, duration="1 hour", slide="25 minutes").filter(
        "icao24 is not null")
    by_row = df.groupBy(F.window("event_time", "1 hour", "25 minutes").alias("w"), "icao24").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("velocity"), 6).alias("v"),
        F.round(F.stddev_samp("velocity"), 6).alias("s"))
    assert sorted(map(str, odd.select("window_start", "icao24", "flight_events",
                                      F.round("avg_velocity", 6).alias("v"),
                                      F.round("velocity_variance", 6).alias("s")).collect())) == \
        sorted(map(str, by_row.select(F.col("w.start").alias("window_start"), "icao24",
                                      F.col("n").alias("flight_events"), "v", "s").collect()))


def test_range_rejects_reach_the_invalid_table(spark, landed):
    """B1: rows out of range land in the invalid table with their reason, and none
    in the processed table."""
    import tempfile
    root, msgs = landed
    work = tempfile.mkdtemp(prefix="ts-rej-")
    raw = read_stream(spark, "files", path=root + "/in/*", schema=MESSAGE_SCHEMA,
                      max_per_trigger=1)
    layout = R.StreamLayout(work + "/out", work + "/ckpt")
    R.start_processed(raw, layout, CFG, trigger="availableNow").awaitTermination()
    parsed = M.good_records(M.envelope(msgs), keep_wrong_type=False)
    # rows with a position time: on the others the batch dedup goes over days
    rows = clean.clean_with_rejects(parsed).filter("time_position is not null")
    want = {r[0]: r[1] for r in rows.filter("reject_reason is not null").groupBy("reject_reason")
            .count().collect()}
    bad = spark.read.parquet(layout.table("invalid"))
    got = {r[0]: r[1] for r in bad.filter("reject_reason is not null").groupBy("reject_reason")
           .count().collect()}
    assert want and set(want) <= set(got) and all(got[k] >= n for k, n in want.items())
    assert bad.filter("data_quality != 'invalid'").count() == 0
    ranges = "abs(latitude) <= 90 and abs(longitude) <= 180 and velocity between 0 and 1000"
    assert spark.read.parquet(layout.table("processed")).filter(f"not ({ranges})").count() == 0


def test_update_mode_windows(spark, landed):
    """K3 update mode: the newest version of every window equals the batch
    window over the same rows (open windows included)."""
    import tempfile
    root, msgs = landed
    work = tempfile.mkdtemp(prefix="ts-upd-")
    layout = R.StreamLayout(work + "/out", work + "/ckpt")
    raw = read_stream(spark, "files", path=root + "/in/*", schema=MESSAGE_SCHEMA,
                      max_per_trigger=1)
    R.start_processed(raw, layout, CFG, trigger="availableNow").awaitTermination()
    p = spark.read.parquet(layout.table("processed"))
    R.start_window_updates(spark, layout, p.schema, CFG,
                           trigger="availableNow").awaitTermination()
    latest = R.latest_windows(spark, layout.table("window_updates"))
    batch = windows.window_stats(p.drop("query_id", "batch_id"), duration="1 day")
    cols = ["window_start", "icao24", "flight_events", "avg_velocity"]
    assert sorted(tuple(r) for r in latest.select(*cols).collect()) == \
        sorted(tuple(r) for r in batch.select(*cols).collect())


def test_replayed_batch_leaves_outputs_unchanged(spark, landed):
    """A batch that committed its output but not its checkpoint entry runs
    again; the tables, closed windows and window updates stay the same."""
    import shutil
    import tempfile
    root, _ = landed
    work = tempfile.mkdtemp(prefix="ts-replay-")
    raw = read_stream(spark, "files", path=root + "/in/*", schema=MESSAGE_SCHEMA,
                      max_per_trigger=1)

    def run(layout):
        q = R.start_processed(raw, layout, CFG, trigger="availableNow")
        q.awaitTermination()
        p = spark.read.parquet(layout.table("processed"))
        R.start_windows(spark, layout, p.schema, CFG, trigger="availableNow").awaitTermination()
        R.start_window_updates(spark, layout, p.schema, CFG,
                               trigger="availableNow").awaitTermination()
        cols = ["window_start", "icao24", "flight_events", "avg_velocity"]
        frames = {"windows": spark.read.parquet(layout.table("windows")).select(*cols),
                  "updates": R.latest_windows(spark, layout.table("window_updates")).select(*cols)}
        for t in ("processed", "invalid"):
            frames[t] = spark.read.parquet(layout.table(t)).select("icao24", "batch_id")
        return ({k: sorted(map(str, f.collect())) for k, f in frames.items()},
                sorted(p.inputFiles()), [x["batchId"] for x in q.recentProgress
                                         if x["numInputRows"]])

    before = run(R.StreamLayout(work + "/out", work + "/ckpt"))
    last = before[2][-1]
    log = work + "/ckpt/processed/"

    def later(folder, names):
        number = {n: n.strip(".").split(".")[0] for n in names}
        first = {log + "commits": last, log + "offsets": last + 1}.get(folder)
        return [n for n, k in number.items() if first is not None and k.isdigit()
                and int(k) >= first]
    shutil.copytree(work + "/ckpt", work + "/ckpt2", ignore=later)
    after = run(R.StreamLayout(work + "/out", work + "/ckpt2"))
    assert after[2] == [last]                            # the last batch of rows ran again
    assert after[:2] == before[:2]
    assert sum(map(len, before[0].values())) > 0


def test_late_rows_dropped_and_counted(spark, landed):
    """Rows older than the watermark are dropped and show up in the
    query progress (the later half arrives first, then the earlier half)."""
    import os
    import shutil
    import tempfile
    import time as _t
    root, _ = landed
    work = tempfile.mkdtemp(prefix="ts-late-")
    os.makedirs(work + "/in")
    shutil.copytree(root + "/in/p2", work + "/in/a", copy_function=shutil.copy)
    _t.sleep(1.1)
    shutil.copytree(root + "/in/p1", work + "/in/b", copy_function=shutil.copy)
    layout = R.StreamLayout(work + "/out", work + "/ckpt")
    raw = read_stream(spark, "files", path=work + "/in/*", schema=MESSAGE_SCHEMA,
                      max_per_trigger=1)
    R.start_processed(raw, layout, CFG, trigger="availableNow").awaitTermination()
    p = spark.read.parquet(layout.table("processed"))
    # the second batch is judged against the first batch's late-event
    # watermark (still the initial one), so the dedup keeps it; the windows
    # query reads the two batches one file at a time and drops it there
    assert p.filter(F.col("event_time") < HALF).count() > 0
    q = R.start_windows(spark, layout, p.schema, CFG, trigger="availableNow",
                        max_files_per_trigger=1)
    q.awaitTermination()
    dropped = sum(int(op.get("numRowsDroppedByWatermark", 0))
                  for pr in q.recentProgress for op in pr.get("stateOperators", []))
    assert dropped > 0
    w = spark.read.parquet(layout.table("windows"))
    assert w.filter(F.col("window_start") < HALF).count() == 0


def test_both_feeds_have_their_own_caps(spark, landed):
    """The processed and the windowed feed, each read in bounded steps."""
    import tempfile
    from trackstream.sources.streams import read_both
    root, _ = landed
    work = tempfile.mkdtemp(prefix="ts-both-")
    one, two = read_both(spark, {"kind": "files", "path": root + "/in/*", "schema": MESSAGE_SCHEMA,
                                 "max_per_trigger": 1},
                         {"kind": "files", "path": root + "/in/p1", "schema": MESSAGE_SCHEMA})
    steps = []
    for name, df in (("a", one), ("b", two)):
        q = (df.writeStream.format("parquet").option("path", f"{work}/{name}")
             .option("checkpointLocation", f"{work}/c{name}").trigger(availableNow=True).start())
        q.awaitTermination()
        steps.append(sum(1 for p in q.recentProgress if p["numInputRows"]))
    assert steps == [2, 1]
    assert spark.read.parquet(work + "/a").count() == spark.read.parquet(root + "/in/*").count()


def test_kafka_options():
    o = kafka_options("flight-raw-data", "broker:9092", max_offsets=100)
    assert o["subscribe"] == "flight-raw-data" and o["startingOffsets"] == "earliest"
    assert o["failOnDataLoss"] == "false" and o["maxOffsetsPerTrigger"] == "100"
    with pytest.raises(ValueError):
        read_stream(None, "kafka")


def test_console_monitor(spark, landed):
    """K5: the console monitor runs on a stream."""
    from trackstream.streaming.sinks import console_monitor
    root, _ = landed
    raw = read_stream(spark, "files", path=root + "/in/*", schema=MESSAGE_SCHEMA)
    plan = R.processed_stream(raw, CFG).withColumn("ml_is_anomaly", F.lit(False))
    q = console_monitor(plan, rows=3)
    q.processAllAvailable()
    q.stop()
    assert q.lastProgress is not None


def test_job_publishes_keyed_messages_and_logs_progress(spark, landed):
    """K2-K4/K7: every published row is sent once, keyed, under an id that a repeated
    attempt keeps; G11: the logged totals equal the tables."""
    import json
    import shutil
    import tempfile
    import time as _t
    from trackstream import schema as S
    from trackstream.streaming.metrics import ProgressLog, metrics
    from trackstream.streaming.publish import Topics, broker_options, to_broker
    root, _ = landed
    work = tempfile.mkdtemp(prefix="ts-pub-")
    sent = {}

    def send(df, topic):
        sent.setdefault(topic, []).extend(df.collect())
    topics = Topics(send)
    raw = read_stream(spark, "files", path=root + "/in/*", schema=MESSAGE_SCHEMA, max_per_trigger=1)
    layout = R.StreamLayout(work + "/out", work + "/ckpt")
    log = ProgressLog(spark, work + "/out")
    spark.streams.addListener(log)
    try:
        R.run_stream(spark, raw, layout, CFG, topics=topics, stream_z=False,
                     trigger="availableNow", wait=True)
        tables = {t: spark.read.parquet(layout.table(t)) for t in ("processed", "invalid", "windows")}
        rows = {t: df.count() for t, df in tables.items()}
        assert {t: len(x) for t, x in sent.items()} == {
            S.PROCESSED_TOPIC: rows["processed"], S.INVALID_OUT_TOPIC: rows["invalid"],
            S.AGGREGATED_TOPIC: rows["windows"]}
        one = sent[S.AGGREGATED_TOPIC][0]
        assert set(json.loads(one.value)) <= set(S.AGGREGATE_COLUMNS) and one.key
        ids = {r.headers[0].value for r in sent[S.AGGREGATED_TOPIC]}
        assert len(ids) == rows["windows"]
        for _ in range(60):                              # events arrive on a thread of their own
            m = metrics(spark, work + "/out")
            got = {r.query: r for r in m.groupBy("query").agg(
                F.sum("input_rows").alias("n"), F.sum(F.col("observed")["quality.valid"]).alias("valid"),
                F.sum(F.col("observed")["quality.invalid"]).alias("invalid")).collect()}
            if {"processed", "windows"} <= set(got) and got["windows"].n == rows["processed"]:
                break
            _t.sleep(0.5)
        assert (got["processed"].valid, got["processed"].invalid) == (rows["processed"], rows["invalid"])
    finally:
        spark.streams.removeListener(log)
    # an attempt that was lost after sending sends the same ids again
    before = {r.headers[0].value for r in sent[S.INVALID_OUT_TOPIC]}
    shutil.rmtree(work + "/out/_ledger/invalid")
    last = max(int(x) for x in __import__("os").listdir(work + "/ckpt/processed/commits") if x.isdigit())
    for f in (f"commits/{last}", f"commits/.{last}.crc"):
        __import__("os").remove(f"{work}/ckpt/processed/{f}")
    R.start_processed(raw, layout, CFG, topics=topics, trigger="availableNow").awaitTermination()
    assert {r.headers[0].value for r in sent[S.INVALID_OUT_TOPIC]} == before
    assert spark.read.parquet(layout.table("invalid")).count() == rows["invalid"]
    assert broker_options("b:9092", "t", {"kafka.acks": "all"}) == {
        "kafka.bootstrap.servers": "b:9092", "topic": "t", "kafka.acks": "all"}
    assert callable(to_broker("b:9092"))


def test_messages_are_parsed_once_a_row(spark):
    """filters behind the parse do not write its expressions again."""
    from trackstream.operators import clean
    texts = ['{"value":"{\\"icao24\\":\\"a1\\"}"}', '{"\\u0076alue":"{\\"icao24\\":\\"a2\\"}"}',
             '{"icao24":"value"}', "{'value':'{\"icao24\":\"a3\"}'}", '{"icao24":"a\\n4"}',
             '[{"value":"{}"}]', "value", "", None, '{"icao24":"a5","latitude":"value"}']
    msgs = spark.createDataFrame([(x,) for x in texts], "value string")
    plain = msgs.select(F.coalesce(F.get_json_object("value", "$.value"), "value")).collect()
    assert [r[0] for r in M.unwrap_nested_json(msgs).collect()] == [r[0] for r in plain]
    good = M.good_records(msgs, keep_wrong_type=False)
    assert [r[0] for r in good.select("icao24").collect()] == ["a1", "a2", "value", "a3", "a\n4"]
    for df in (clean.drop_missing_critical(clean.parse_event_time(good)),
               M.dead_letters(msgs, critical={"missing_key": F.col("icao24").isNull()})):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1 and plan.count("get_json_object(") == 1


def test_the_feed_is_landed_in_order_of_time_and_whole(spark, tmp_path):
    """slices follow each other, and every message is in one of them."""
    from conftest import SF_SMALL
    from trackstream.plans import compose, stream_queries as Q
    path = str(tmp_path / "feed")
    made = []
    kept, Q.scratch_path = Q.scratch_path, lambda s, name: made.append(name) or str(tmp_path / name)
    try:
        Q.land_feed(spark, SF_SMALL, path)
    finally:
        Q.scratch_path = kept
    assert made == ["messages"]                 # columns, not checkpointed rows
    want = M.messages_from_flights(compose.flights(spark, SF_SMALL))
    got = spark.read.schema(MESSAGE_SCHEMA).parquet(path)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()

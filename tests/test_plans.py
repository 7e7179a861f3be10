"""Plan-shape checks: the scale properties the operators rely on."""

from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from trackstream.operators import anomaly, clean, reports, windows
from trackstream.plans import compose as P


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_is_pruned(spark):
    plan = _plan(P.flights(spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" \
        in plan


def test_dedup_limits_before_the_shuffle(spark):
    plan = _plan(clean.dedup_events(clean.parse_event_time(P.flights(spark, SF_SMALL))))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_window_stats_aggregate_partially(spark):
    plan = _plan(windows.window_stats(P.valid_features(spark, SF_SMALL), duration="1 day"))
    assert "partial_count" in plan and "partial_min_by" in plan


def _jobs(spark) -> int:
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


def test_one_scan_and_no_job_while_a_plan_is_built(spark):
    """Statistics of a table beside its rows read the same shuffle."""
    v = P.valid_features(spark, SF_MID)          # a table that no other test caches
    before = _jobs(spark)
    frames = {"z": anomaly.zscore_anomalies(v, window_duration="1 day"),
              "histogram": reports.velocity_histogram(v), "scaled": reports.standardize(v)}
    assert _jobs(spark) == before
    for name, df in frames.items():
        df.collect()
        final = _plan(df).split("== Initial Plan ==")[0]
        assert final.count("FileScan") == 1, name
        assert "BroadcastExchange" in final and "ReusedExchange" in final, name


def test_zscore_join_without_broadcast_equals(spark):
    """Statistics too large to broadcast: the shuffle join gives the same rows."""
    v = P.valid_features(spark, SF_SMALL)

    def rows(df):
        return sorted(map(str, df.select("event_id", "velocity_zscore", "altitude_zscore").collect()))
    want = rows(anomaly.zscore_anomalies(v, window_duration="1 day"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = anomaly.zscore_anomalies(v, window_duration="1 day")
        assert "SortMergeJoin" in _plan(df) and rows(df) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_transitions_scan_and_shuffle_events_once(spark):
    """Segment ends are ordered by entity, the rest of the rows stay in their segment."""
    from trackstream.operators import features
    df = features.state_transitions(P.valid_features(spark, SF_MID))
    df.collect()
    final = _plan(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_required_and_optional_columns(spark):
    """V10, V11."""
    import pytest
    df = spark.range(1).withColumn("velocity", F.lit(1.0))
    reports.require_columns(df, ["id", "velocity"])
    with pytest.raises(ValueError, match="Missing required columns: .'heading'"):
        reports.require_columns(df, ["velocity", "heading"])
    assert reports.present_columns(df, ["heading", "velocity", "id"]) == ["velocity", "id"]


def test_configure_keeps_the_callers_settings(spark):
    from trackstream.session import configure
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    configure(spark)
    assert spark.conf.get(key) == before and spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_top_k_is_take_ordered(spark):
    plan = _plan(reports.top_countries(P.valid_features(spark, SF_SMALL)))
    assert "TakeOrderedAndProject" in plan


def test_hot_key_results_stay_whole(spark):
    """A key holding a third of all rows: dedup, windows and top-k keep every
    row (no caps or sampling) and agree with the unskewed totals."""
    from pyspark.sql import functions as F
    v = P.valid_features(spark, SF_SMALL)
    hot = v.withColumn("icao24", F.when(F.col("event_id") % 3 == 0, F.lit("hot000"))
                       .otherwise(F.col("icao24")))
    w = windows.window_stats(hot, duration="1 day")
    assert w.agg(F.sum("flight_events")).first()[0] == v.count()
    top = reports.top_aircraft(hot, k=1).first()
    assert top.icao24 == "hot000" and top.events == hot.filter("icao24 = 'hot000'").count()


def test_a_large_row_group_is_dealt_to_many_tasks(spark, tmp_path):
    """a file of as many splits as cores, whose rows all lie in one row group."""
    from trackstream.sources import adapter
    n = 4 * adapter.EVENTS_PER_TASK + 1
    path = str(tmp_path / "events.parquet")
    spark.range(n).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts",
        "id % 500 AS user_id", "CAST(id % 90 AS DOUBLE) AS value").coalesce(1).write.parquet(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        assert spark.read.parquet(path).rdd.getNumPartitions() >= 4
        sizes = P.bursts(spark, str(tmp_path)).groupBy(F.spark_partition_id()).agg(
            F.countDistinct(F.expr("event_id div 100"))).collect()
        assert len(sizes) == 5 and max(s[1] for s in sizes) <= adapter.EVENTS_PER_TASK
        flights = P.flights(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
        assert len(flights) == 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)

"""Invariants of the distributed isolation forest (no SQL oracle exists)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from trackstream.operators import forest
from trackstream.plans import compose as P


@pytest.fixture(scope="module")
def fitted(spark):
    v = P.valid_features(spark, SF_SMALL).cache()
    m = forest.fit_isolation_forest(v, n_trees=50)
    return v, m


def test_node_table_bounded(fitted):
    _, m = fitted
    assert m.nodes["tree_id"].nunique() == 50
    assert len(m.nodes) <= 50 * (2 * 256 - 1)
    assert (m.nodes.groupby("tree_id")["node_id"].min() == 0).all()


def test_scores_in_range_and_share(fitted):
    v, m = fitted
    s = forest.score_frame(v, m)
    row = s.agg(F.min("ml_anomaly_score").alias("lo"), F.max("ml_anomaly_score").alias("hi"),
                F.avg(F.col("ml_is_anomaly").cast("double")).alias("share")).first()
    assert 0.0 <= row.lo and row.hi <= 1.0
    assert 0.0 < row.share < 0.05


def test_scores_independent_of_partitioning(fitted):
    v, m = fitted
    a = {r.event_id: r.ml_anomaly_score for r in forest.score_frame(v, m).collect()}
    b = {r.event_id: r.ml_anomaly_score
         for r in forest.score_frame(v.repartition(7), m).collect()}
    assert a == b


def test_fit_is_deterministic(spark, fitted):
    v, m = fitted
    m2 = forest.fit_isolation_forest(v.repartition(3), n_trees=50)
    cols = ["tree_id", "node_id", "feature", "threshold"]
    a = m.nodes.sort_values(cols[:2])[cols].to_numpy()
    b = m2.nodes.sort_values(cols[:2])[cols].to_numpy()
    assert np.array_equal(a, b)


def test_store_is_by_content(spark, scratch):
    """One fit for the same rows and parameters; another row or parameter is another model."""
    import os
    v = P.valid_features(spark, SF_SMALL)
    one = forest.fit_isolation_forest(v, n_trees=5, store=scratch)
    again = forest.fit_isolation_forest(v.repartition(5), n_trees=5, store=scratch)
    assert len(os.listdir(scratch)) == 1 and forest.model_metadata(one) == forest.model_metadata(again)
    assert one.nodes.sort_values(["tree_id", "node_id"]).reset_index(drop=True).equals(
        again.nodes.sort_values(["tree_id", "node_id"]).reset_index(drop=True))
    forest.fit_isolation_forest(v, n_trees=6, store=scratch)
    forest.fit_isolation_forest(v.filter("event_id <> 7"), n_trees=5, store=scratch)
    changed = v.withColumn("velocity", F.when(F.col("event_id") == 7, 1.5).otherwise(F.col("velocity")))
    forest.fit_isolation_forest(changed, n_trees=5, store=scratch)
    assert len(os.listdir(scratch)) == 4


def test_planted_outlier_scores_high(spark, fitted):
    v, m = fitted
    planted = spark.createDataFrame(
        [(-1, 900.0, 45000.0, 60.0, 3, 2)],
        "event_id long, velocity double, baro_altitude double, vertical_rate double, "
        "hour int, day_of_week int")
    cols = ["event_id", "velocity", "baro_altitude", "vertical_rate", "hour", "day_of_week"]
    both = v.select(*cols).unionByName(planted)
    s = forest.score_frame(both.withColumn("icao24", F.lit("x")), m)
    r = s.filter("event_id = -1").first()
    assert r.ml_is_anomaly and r.ml_anomaly_score > 0.9
    assert "extreme_speed" in r.ml_anomaly_reason


def test_model_roundtrip(spark, fitted, scratch):
    v, m = fitted
    forest.save_model(spark, m, scratch + "/model")
    m2 = forest.load_model(spark, scratch + "/model")
    assert m2.threshold == m.threshold and len(m2.nodes) == len(m.nodes)
    assert forest.load_model(spark, scratch + "/missing") is None
    assert forest.model_info(spark, None).first().loaded is False
    assert forest.model_info(spark, m).first().n_trees == 50


def test_split_is_exact_in_every_class(fitted):
    v, _ = fitted
    s = forest.train_test_split(v, label_col="flight_phase")
    rows = s.groupBy("flight_phase").agg(
        F.count("*").alias("n"), F.sum((F.col("split") == "test").cast("int")).alias("t")).collect()
    assert len(rows) > 1
    assert all(r.t == int(0.2 * r.n + 0.5) for r in rows)


@pytest.mark.parametrize("sf", [SF_SMALL, "/root/testdata/sf0.1"])
def test_feed_without_ids(spark, sf):
    """Row identity does not need an id: all trees are grown, the split holds."""
    v = P.valid_features(spark, sf).withColumn("event_id", F.lit(None).cast("long"))
    m = forest.fit_isolation_forest(v, n_trees=20)
    assert m.nodes["tree_id"].nunique() == 20
    sizes = m.nodes[m.nodes["node_id"] == 0]["size"]
    assert sizes.min() >= 200 and sizes.max() <= 256
    share = forest.train_test_split(v).agg(
        F.avg((F.col("split") == "test").cast("double"))).first()[0]
    assert abs(share - 0.2) < 0.001


def test_equal_rows_are_told_apart(spark):
    """A thousand equal rows fill a tree's sample like any others."""
    one = spark.range(1000).selectExpr(
        "CAST(NULL AS LONG) event_id", "'x' icao24", "200.0D velocity", "9000.0D baro_altitude",
        "0.0D vertical_rate", "3 hour", "2 day_of_week")
    m = forest.fit_isolation_forest(one, n_trees=10)
    assert m.train_rows == 1000 and m.nodes["tree_id"].nunique() == 10
    assert m.effective_psi() == 256


def test_calibrates_on_all_rows(spark):
    """Over a million rows: minimum, maximum and the 0.99 quantile of all of them."""
    v = spark.range(1_100_000).selectExpr(
        "id event_id", "CAST(id % 977 AS DOUBLE) velocity", "CAST(id % 12007 AS DOUBLE) baro_altitude",
        "CAST(id % 31 AS DOUBLE) vertical_rate", "CAST(id % 24 AS INT) hour",
        "CAST(id % 7 AS INT) + 1 day_of_week")
    m = forest.fit_isolation_forest(v, n_trees=5, psi=64)
    raw = v.select(forest.raw_score_column(m, spark, m.features).alias("r"))
    lo, hi, over = raw.agg(F.min("r"), F.max("r"),
                           F.avg((F.col("r") > m.threshold).cast("double"))).first()
    assert (lo, hi) == (m.raw_min, m.raw_max)
    assert over <= 0.01 + 2e-4


def test_unreadable_model_stops_the_job(spark, scratch):
    spark.range(1).selectExpr("'not json' AS meta").write.parquet(scratch + "/bad/meta")
    with pytest.raises(Exception):
        forest.load_model(spark, scratch + "/bad")


def test_batch_flow_with_and_without_model(spark, fitted):
    """The whole reference flow in batch: clean -> features -> z-score ->
    split -> score -> windows -> trends (U4/U5 both ways)."""
    from trackstream.schema import PipelineConfig
    _, m = fitted
    raw = P.flights(spark, SF_SMALL)
    cfg = PipelineConfig(window="1 day", zscore_window="1 day")
    out = P.batch_flow(raw, cfg, model=m)
    proc = out["processed"]
    assert proc.count() == P.valid_features(spark, SF_SMALL).count()
    r = proc.agg(F.min("ml_anomaly_score"), F.max("ml_anomaly_score")).first()
    assert 0.0 <= r[0] <= r[1] <= 1.0
    assert out["trends"].count() == out["windows"].count()
    assert out["windows"].select("trend_summary").distinct().first()[0] == "not_calculated"
    assert out["invalid"].count() > 0
    fb = P.batch_flow(raw, cfg, model=None)["processed"]
    assert fb.filter("ml_anomaly_reason != 'model_unavailable'").count() == 0


def test_batch_flow_keeps_range_rejects(spark):
    from trackstream.operators import clean
    from trackstream.schema import PipelineConfig
    raw = P.flights(spark, SF_SMALL)
    cfg = PipelineConfig(window="1 day", zscore_window="1 day")
    out = P.batch_flow(raw, cfg)
    rows = clean.clean_with_rejects(raw)
    want = {(r.event_id, r.reject_reason) for r in rows.filter(
        "reject_reason is not null or data_quality = 'invalid'").collect()}
    invalid = out["invalid"].select("event_id", "reject_reason", "data_quality").collect()
    assert {(r.event_id, r.reject_reason) for r in invalid} == want and len(invalid) == len(want)
    assert {r.data_quality for r in invalid} == {"invalid"}
    assert len([1 for _, reason in want if reason]) > 0
    assert out["processed"].count() + len(invalid) == rows.count()
    # the processed rows are the same as before
    valid = {r.event_id for r in P.valid_features(spark, SF_SMALL).collect()}
    assert "reject_reason" not in out["processed"].columns
    assert {r.event_id for r in out["processed"].select("event_id").collect()} == valid


def test_flat_walk_equals_a_walk_node_by_node():
    """scores from the flat arrays are those of single rows walked down each tree."""
    import numpy as np
    import pandas as pd
    from trackstream.operators import forest
    rng, frames = np.random.default_rng(5), []
    for tree in range(19):
        grown = forest.build_tree(rng.normal(size=(64, 3)).round(1), rng, 6)
        nodes = pd.DataFrame(grown, columns=["node_id", "feature", "threshold", "left", "right",
                                             "size", "depth"])
        nodes.insert(0, "tree_id", tree)
        frames.append(nodes)
    model = forest.ForestModel(["a", "b", "c"], 19, 64, 0.1, 1, pd.concat(frames))
    x = rng.normal(size=(200, 3)).round(1)
    want = []
    for row in x:
        total = 0.0
        for nodes in frames:
            at = nodes.iloc[0]
            while at.feature >= 0:
                at = nodes.iloc[int(at.right if row[int(at.feature)] >= at.threshold else at.left)]
            total += at.depth + forest.average_path_length([at["size"]])[0]
        want.append(2.0 ** (-(total / 19) / forest.average_path_length([64])[0]))
    assert np.allclose(forest.raw_scores(model.compile(), x), want, rtol=1e-12)


def test_the_split_is_made_once_for_fit_and_evaluation(spark, monkeypatch):
    """both read the written split, not the flow behind it."""
    from conftest import SF_SMALL
    from trackstream.operators import forest
    from trackstream.plans import model_queries as Q
    seen = []
    kept = forest.fit_isolation_forest
    monkeypatch.setattr(forest, "fit_isolation_forest", lambda df, **kw: seen.append(df) or kept(df, **kw))
    report = Q.q_forest_evaluation(spark, SF_SMALL)
    for df in (seen[0], report):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan and "Join" not in plan.replace("JoinType", "")
    rows = spark.read.format("parquet").load(f"{SF_SMALL}/events.parquet").count()
    assert 0 < report.agg({"support": "sum"}).first()[0] < rows

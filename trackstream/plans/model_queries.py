"""Model queries (isolation forest).  Not SQL-expressible (random trees,
vectorised traversal), so they have no oracle SQL; tests check invariants:
scores in [0, 1], flagged share near the contamination, scores independent
of partitioning, planted outliers above the threshold."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackstream import schema as S
from trackstream.operators import forest, reports
from trackstream.plans import compose as P
from trackstream.plans.catalog import round_doubles
from trackstream.session import checkpoint_dir, scratch_path


def _fit(spark, d):
    """The forest of the valid rows of this input: fitted once for the same rows and
    parameters in an application."""
    v = P.valid_features(spark, d)
    return v, forest.fit_isolation_forest(v, store=f"{checkpoint_dir(spark)}/models")


def q_iforest_nodes(spark, d):
    _, m = _fit(spark, d)
    return spark.createDataFrame(m.nodes, schema=forest.NODE_SCHEMA)


def q_ml_score(spark, d):
    v, m = _fit(spark, d)
    return round_doubles(forest.score_frame(v, m).select("event_id", "ml_anomaly_score"))


def q_ml_flags(spark, d):
    v, m = _fit(spark, d)
    return round_doubles(forest.score_frame(v, m).select(
        "event_id", "icao24", "ml_anomaly_score", "ml_is_anomaly", "ml_anomaly_reason"))


def q_model_info(spark, d):
    _, m = _fit(spark, d)
    return forest.model_info(spark, m)


def q_model_facts(spark, d):
    """What must hold of any forest fitted to this input, counted over all its trees, nodes
    and rows (M1, U1, U2, U3, U6)."""
    v, m = _fit(spark, d)
    path = scratch_path(spark, "model")
    forest.save_model(spark, m, path)
    again = forest.load_model(spark, path)
    nodes = spark.read.parquet(path + "/nodes").groupBy("tree_id").agg(
        F.count(F.lit(1)).alias("k"), F.max("size").alias("root"))
    psi = min(m.psi, m.train_rows)
    trees = nodes.agg(F.count(F.lit(1)).alias("a"), F.count_if(F.col("root") >= 0.9 * psi).alias("b"),
                      F.count_if(F.col("k") <= 2 * psi - 1).alias("c")).first()
    raw = forest.raw_score_column(m, spark, m.features)
    s = forest.score_frame(v.withColumn("raw", raw), again).agg(
        F.count_if(F.col("ml_anomaly_score").between(0.0, 1.0)).alias("scored"),
        F.count_if(F.col("ml_is_anomaly") == (F.col("raw") > F.lit(m.threshold))).alias("follow"),
        F.count("ml_anomaly_reason").alias("reasons"),
        F.count_if("ml_is_anomaly").alias("flagged"))
    near = F.abs(F.col("flagged") - m.contamination * m.train_rows) <= 0.005 * m.train_rows + 1
    same = forest.model_metadata(m) == forest.model_metadata(again)
    facts = [("train rows", F.lit(m.train_rows)), ("trees", F.lit(trees.a)),
             ("features", F.lit(len(m.features))), ("trees of a full sample", F.lit(trees.b)),
             ("trees within their node bound", F.lit(trees.c)),
             ("rows scored between 0 and 1", F.col("scored")),
             ("rows whose flag follows the threshold", F.col("follow")),
             ("rows with a reason", F.col("reasons")),
             ("flagged share near the contamination", near.cast("long")),
             ("model tables read back", F.lit(int(same)))]
    return s.select(F.explode(F.array(*[F.struct(F.lit(k).alias("fact"), x.cast("long").alias("amount"))
                                        for k, x in facts])).alias("f")).select("f.*")


def q_train_test_split(spark, d):
    v = P.valid_features(spark, d)
    return forest.train_test_split(v, label_col="flight_phase", id_cols=["event_id"]).select(
        "event_id", "flight_phase", "split")


def q_forest_evaluation(spark, d):
    """M4: fit on the train split, evaluate on the test split against the
    rule-based label (any anomaly rule fires at full score)."""
    # the fit and the evaluation read the split, which is written once
    v = forest.stored(forest.train_test_split(P.valid_features(spark, d)).select(
        *forest.IDENTITY, *S.MODEL_FEATURES, "split"))
    m = forest.fit_isolation_forest(v.filter(F.col("split") == "train"))
    test = forest.score_frame(v.filter(F.col("split") == "test"), m)
    from trackstream.functions.expressions import anomaly_reason
    test = test.withColumn("rule_label", anomaly_reason("velocity", "baro_altitude",
                                                         "vertical_rate", F.lit(1.0))
                           != F.lit("statistical_anomaly"))
    return round_doubles(reports.classification_report(test, label_col="rule_label",
                                                       pred_col="ml_is_anomaly"))


MODEL_QUERIES = {
    "iforest_nodes": q_iforest_nodes,
    "ml_score": q_ml_score,
    "ml_flags": q_ml_flags,
    "model_info": q_model_info,
    "model_facts": q_model_facts,
    "train_test_split": q_train_test_split,
    "forest_evaluation": q_forest_evaluation,
}

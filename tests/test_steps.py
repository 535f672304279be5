import tempfile

from tests.conftest import SF


def test_gold_train_score_steps(spark):
    import registry as R
    from voltchurn.plans import pipeline

    base = tempfile.mkdtemp(prefix="vc-steps-")
    pipeline.write_layers({"gold_master": R._gold(spark, SF)}, f"{base}/gold")
    metrics = pipeline.run_train_step(spark, f"{base}/gold", f"{base}/model", "E1_lifecycle_market",
                                      "logistic_regression")
    assert 0.0 <= metrics["roc_auc"] <= 1.0 and "threshold" in metrics
    from voltchurn.plans import model as M

    model, meta = M.load_model(f"{base}/model")
    assert model.stages[-1].getProbabilityCol() == "calibrated"      # the calibrated pipeline is what is saved
    again = pipeline.run_evaluate_step(spark, f"{base}/gold", f"{base}/model", f"{base}/evaluated")
    assert all(abs(again[k] - metrics[k]) < 1e-9 for k in ("roc_auc", "pr_auc", "tp", "fp", "fn", "tn"))
    assert again["approved"] == (again["pr_auc"] >= 0.70)
    path = pipeline.run_score_step(spark, f"{base}/gold", f"{base}/model", f"{base}/scored")
    scored = spark.read.parquet(path)
    assert scored.count() == spark.read.parquet(f"{base}/gold/gold_master").count()
    assert spark.read.parquet(f"{base}/scored/recommendations").count() == scored.count()
    # the scores are the calibrated ones: near the churn rate on average, unlike balanced raw scores
    gold = spark.read.parquet(f"{base}/gold/gold_master")
    rate = gold.agg({"churn": "avg"}).first()[0]
    assert abs(scored.agg({"churn_proba": "avg"}).first()[0] - rate) < 0.1


def test_grid_search_by_average_precision(spark):
    from pyspark.sql import functions as F

    from voltchurn.plans import model as M

    rows = [(str(i), int(i % 4 == 0), float(i % 4 == 0) * 2 + (i % 5) * 0.3) for i in range(120)]
    df = spark.createDataFrame(rows, "customer_id string, churn int, f double")
    cv = M.grid_search(df, ["f"], "logistic_regression", {"regParam": [0.0, 0.1]}, folds=3, parallelism=1)
    assert len(cv.avgMetrics) == 2 and max(cv.avgMetrics) > 0.5
    folds = M.stratified_folds(df, "churn", 3).groupBy("fold", "churn").count().collect()
    assert {r.fold for r in folds} == {0, 1, 2}
    assert F is not None

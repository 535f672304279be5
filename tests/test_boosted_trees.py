"""Boosted trees: column sampling and early stopping."""

import random

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from voltchurn.plans import model

FEATURES = [f"x{i}" for i in range(10)]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    data = []
    for i in range(600):
        x = [rng.gauss(0, 1) for _ in FEATURES]
        churn = int(x[0] + 0.3 * x[1] + 0.3 * rng.gauss(0, 1) > 0)      # one column tells nearly all
        data.append((f"c{i}", *x, churn))
    return spark.createDataFrame(data, "customer_id string, " + ", ".join(f"{f} double" for f in FEATURES) + ", churn int").cache()


def test_trees_choose_among_a_share_of_the_columns(rows):
    sampled = model.fit(rows, FEATURES, "gbt", maxIter=12)
    every = model.fit(rows, FEATURES, "gbt", maxIter=12, featureSubsetStrategy="all")
    assert sampled.stages[-1].getFeatureSubsetStrategy() == "0.7"
    used = model.tree_columns(sampled)
    assert len(used) == 12 and all(len(u) <= 0.7 * len(FEATURES) for u in used)
    # without sampling every tree's first split takes the telling column; with it some cannot
    roots = lambda m: [t.toDebugString.split("feature ")[1].split(" ")[0] for t in m.stages[-1].trees]
    assert set(roots(every)) == {"0"} and len(set(roots(sampled))) > 1


def test_rounds_end_when_held_out_rows_gain_no_more(rows):
    stopped = model.fit(rows, FEATURES, "gbt", validation_share=0.25, maxIter=40, stepSize=0.5, validationTol=0.01)
    whole = model.fit(rows, FEATURES, "gbt", maxIter=40, stepSize=0.5)
    assert whole.stages[-1].getNumTrees == 40 and 1 <= stopped.stages[-1].getNumTrees < 40
    scored = model.predict_proba(stopped, rows.drop("churn"), FEATURES).collect()
    assert len(scored) == 600 and all(0 <= r["proba"] <= 1 for r in scored)
    again = model.fit(rows, FEATURES, "gbt", validation_share=0.25, maxIter=40, stepSize=0.5, validationTol=0.01)
    assert again.stages[-1].getNumTrees == stopped.stages[-1].getNumTrees


def test_rows_are_dealt_over_the_cores(spark, monkeypatch):
    monkeypatch.setattr(model, "ROWS_A_TASK", (10, 500))
    parts = lambda n: model.spread_rows(spark.range(n).coalesce(1)).rdd.getNumPartitions()
    cores = spark.sparkContext.defaultParallelism
    assert [parts(n) for n in (0, 9, 25, 600)] == [1, 1, min(2, cores), min(60, cores)]
    assert parts(500 * cores + 1) == 2 * cores
    assert model.spread_rows(spark.range(77)).count() == 77


def test_boosting_gets_vectors_that_are_kept_and_dealt(spark, rows, monkeypatch):
    monkeypatch.setattr(model, "ROWS_A_TASK", (10, 500), raising=False)
    seen, fit = [], model.GBTClassifier.fit

    def spy(self, dataset, *a):
        seen.append((dataset.rdd.getNumPartitions(), dataset.is_cached, dataset.columns))
        return fit(self, dataset, *a)

    monkeypatch.setattr(model.GBTClassifier, "fit", spy)
    model.fit(rows.coalesce(1), FEATURES, "gbt", maxIter=1)
    model.fit(rows.coalesce(1), FEATURES, "gbt", maxIter=1, validation_share=0.25)
    assert seen == [(min(60, spark.sparkContext.defaultParallelism), True, ["features", "churn", "weight"]),
                    (min(45, spark.sparkContext.defaultParallelism), True, ["features", "churn", "weight", "_held"])]


def test_trees_are_those_of_one_pipeline(spark, rows):
    one = rows.coalesce(1)
    got = model.fit(one, FEATURES, "gbt", maxIter=5)
    tr = model.class_weights(one).withColumn("churn", F.col("churn").cast("double"))
    want = Pipeline(stages=[*model.preprocessing_stages(tr, FEATURES, False), model.estimator("gbt", maxIter=5)]).fit(tr)
    assert [t.toDebugString.split("\n", 1)[1] for t in got.stages[-1].trees] == [t.toDebugString.split("\n", 1)[1] for t in want.stages[-1].trees]
    assert [type(s) for s in got.stages] == [type(s) for s in want.stages]

"""Balanced ranges, several quantiles at once, and splits that keep every row."""

import pytest
from pyspark.sql import functions as F

from voltchurn.operators import stats as S
from voltchurn.plans import model


def sizes(df):
    return sorted(r["count"] for r in df.groupBy("_bk").count().collect())


@pytest.mark.parametrize("far", [1e12, -1e12])
def test_an_outlier_leaves_the_ranges_balanced(spark, far):
    df = spark.range(20_000).select(F.lit("f").alias("g"), (100 + F.col("id") / 1e6).alias("v")).unionByName(
        spark.createDataFrame([("f", far)], "g string, v double"))
    got = sizes(S.with_range_bucket(df, ["g"], "v", 16))
    assert len(got) == 16 and got[-1] <= 2 * 20_001 / 16


def test_groups_of_different_magnitude_share_the_ranges(spark):
    df = spark.range(30_000).select((F.col("id") % 2).alias("g"), F.when(F.col("id") % 2 == 0, F.col("id") * 1e-9).otherwise(F.col("id") * 1e9).alias("v"))
    got = sizes(S.with_range_bucket(df, ["g"], "v", 12))
    assert len(got) == 12 and got[-1] <= 2 * 30_000 / 12
    cum = S.prefix_sums(df.withColumn("one", F.lit(1)), ["g"], "v", ["one"], buckets=12)
    assert {r.g: r.top for r in cum.groupBy("g").agg(F.max("one_cum").alias("top")).collect()} == {0: 15_000, 1: 15_000}
    assert cum.groupBy("g", "one_cum").count().where("count > 1").isEmpty()


def test_many_ranks_for_many_groups(spark):
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    rows = [("hot", float((v * 37) % 5003)) for v in range(5003)] + [("hot", 1e12)] + [("b", 5.0), ("b", 5.0), ("b", None), ("c", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.x, r.y) for r in S.grouped_quantiles(df, ["g"], {"x": F.col("v"), "y": -F.col("v")}, probs).collect()}
    want = {r.g: (r.x, r.y) for r in df.where("g IS NOT NULL AND v IS NOT NULL").groupBy("g").agg(
        F.percentile("v", probs).alias("x"), F.percentile(-F.col("v"), probs).alias("y")).collect()}
    assert got.keys() == want.keys() == {"hot", "b"}
    for g in want:
        for k in (0, 1):
            assert list(got[g][k]) == pytest.approx(list(want[g][k]), rel=1e-12)
    whole = S.grouped_quantiles(df, [], {"x": F.col("v")}, probs).collect()
    assert len(whole) == 1 and list(whole[0].x) == pytest.approx(list(df.agg(F.percentile("v", probs)).first()[0]), rel=1e-12)
    assert [r.x for r in S.grouped_quantiles(df.where("false"), [], {"x": F.col("v")}, probs).collect()] == [None]


def test_reports_do_not_hold_a_group_in_one_map(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("v"), (F.col("id") % 3 == 0).cast("int").alias("churn"))
    for out in (S.describe(df, "v", ["g"]), S.with_quantile_bins(df, "v"), S.calibration_curve(df.withColumn("p", F.col("v") / 500), "churn", "p"),
                S.rate_by(df, ["g"], medians={"m": "v"})):
        assert "percentile(" not in out._jdf.queryExecution().toString().lower()
    d = {r.g: r for r in S.describe(df, "v", ["g"]).collect()}
    assert d[0].p50 == 249.0 and d[1].p25 == 125.5 and list(d[0].asDict()) == ["g", "count", "mean", "std", "min", "p25", "p50", "p75", "max"]
    assert {r.g: r.m for r in S.rate_by(df, ["g"], medians={"m": "v"}).collect()} == {0: 249.0, 1: 250.0}


def test_splits_keep_null_and_repeated_keys(spark):
    rows = [(f"c{i}", i % 4 == 0) for i in range(80)] + [("c1", False)] * 5 + [(None, True)] * 3 + [("x", None)] * 10
    df = spark.createDataFrame(rows, "customer_id string, y boolean").select("customer_id", F.col("y").cast("int").alias("churn"))
    split = model.stratified_split(df, "churn", 0.2)
    assert split.drop("is_test").exceptAll(df).isEmpty() and df.exceptAll(split.drop("is_test")).isEmpty()
    assert {r.churn: r.n for r in split.where("is_test").groupBy("churn").agg(F.count("*").alias("n")).collect()} == {0: 13, 1: 5, None: 2}
    folds = model.stratified_folds(df, "churn", 5)
    assert folds.count() == len(rows)
    assert max(r.n for r in folds.groupBy("churn", "fold").agg(F.count("*").alias("n")).collect()) == 13

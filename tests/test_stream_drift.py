"""Drift of a stream batch by batch, and types before the model matrix."""

import os
import tempfile

from pyspark.sql import functions as F

from voltchurn.plans import drift, model
from voltchurn.streaming import jobs


def rows(spark, n, shift=0.0):
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("feature"),
                                 (F.when(F.col("id") % 50 == 7, None).otherwise((F.col("id") * 7) % 40) + F.lit(shift)).cast("double").alias("value"))


def as_dict(df):
    return {r["feature"]: tuple(r[c] for c in ("ks_statistic", "n_ref", "n_cur", "p_value", "drifted")) for r in df.collect()}


def test_batches_add_up_to_the_batch_job(spark):
    base = tempfile.mkdtemp(prefix="vc-drift-")
    ref, cur = rows(spark, 400), rows(spark, 300, 3.0)
    cur.repartition(3).write.parquet(f"{base}/in")
    stream = jobs.read_stream(spark, f"{base}/in", cur.schema, max_files_per_trigger=1)
    last = as_dict(jobs.drift_stream(stream, ref, f"{base}/state"))
    assert last == as_dict(drift.drift_long(ref, cur)) and set(last) == {"a", "b"}
    assert spark.read.parquet(f"{base}/state/reports").select("batch").distinct().count() == 3


def test_a_repeated_batch_counts_once(spark):
    base = tempfile.mkdtemp(prefix="vc-drift-")
    ref, one, two = rows(spark, 200), rows(spark, 90, 1.0), rows(spark, 60, 5.0)
    state = jobs.DriftState(spark, base, ref)
    state.update(one, 0)
    state.update(two, 1)
    first = as_dict(state.reports(spark).where("batch = 1"))
    state.update(two, 1)                           # the batch is run again after a failure
    assert as_dict(state.reports(spark).where("batch = 1")) == first == as_dict(drift.drift_long(ref, one.unionByName(two)))
    assert as_dict(state.reports(spark).where("batch = 0")) == as_dict(drift.drift_long(ref, one))
    state.update(one.where("false"), 2)            # an empty batch changes nothing
    assert as_dict(state.reports(spark).where("batch = 2")) == first
    assert os.path.isdir(f"{base}/counts/batch=2")


def test_types_before_the_matrix(spark):
    df = spark.createDataFrame([(True, None, "x", 1, 2.5), (None, False, None, None, None)], "b boolean, c boolean, s string, i int, d double") \
        .withColumns({"m": F.lit("1.250").cast("decimal(9,3)"), "weird.name": F.col("b")})
    out = model.normalize_types(df)
    assert dict(out.dtypes) == {"b": "tinyint", "c": "tinyint", "s": "string", "i": "int", "d": "double", "m": "double", "weird.name": "tinyint"}
    assert [tuple(r) for r in out.collect()] == [(1, None, "x", 1, 2.5, 1.25, 1), (None, 0, None, None, None, 1.25, None)]
    assert dict(model.normalize_types(df, ["c"]).dtypes)["b"] == "boolean"


def test_importance_and_versions(spark):
    data = spark.createDataFrame([(f"c{i}", float(i % 2), float((i * 7) % 5), "xy"[i % 2], i % 2) for i in range(60)],
                                 "customer_id string, tells double, noise double, s string, churn int")
    fitted = model.fit(data, ["tells", "noise"], "random_forest", numTrees=20)
    top = model.feature_importance(fitted, data, ["tells", "noise"], top=1).collect()
    assert len(top) == 1 and "tells" in top[0]["feature"] and top[0]["importance"] > 0.5
    v = spark.createDataFrame([(k, "Approved" if k in (2, 4) else "Pending", f"2024-01-0{min(k, 5)}") for k in range(1, 8)], "version int, status string, created_at string")
    assert [r.version for r in model.newest_versions(v, 3).collect()] == [7, 6, 5]
    assert [r.version for r in model.champion(v).collect()] == [4]

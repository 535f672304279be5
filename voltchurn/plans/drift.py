"""Drift monitoring (Q2-Q8, U5): reference snapshots, KS drift, summaries, the drift job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltchurn.constants import DRIFT_P_THRESHOLD, KEY
from voltchurn.operators.stats import attach_scalar, kolmogorov_sf, ks_from_counts, ks_from_long, ks_p_value, ks_statistic, with_group_quantiles

NUMERIC = {"double", "float", "int", "bigint", "smallint", "tinyint"}


def numeric_features(df: DataFrame, exclude: Sequence[str] = (KEY,)) -> list[str]:
    return [f for f, t in df.dtypes if t in NUMERIC and f not in exclude]


def _with_p_value(d: DataFrame, p_threshold: float, exact: bool) -> DataFrame:
    """KS rows with p-value (``exact``: the exact law for small samples) and drifted flag."""
    n_ref, n_cur = F.col("n_ref"), F.col("n_cur")
    p = ks_p_value(F.col("ks_statistic"), n_ref, n_cur) if exact else \
        kolmogorov_sf(F.col("ks_statistic"), n_ref.cast("double"), n_cur.cast("double"))
    return d.withColumn("p_value", p).withColumn("drifted", F.col("p_value") < p_threshold)


def feature_drift(reference: DataFrame, current: DataFrame, features: Sequence[str] | None = None,
                  p_threshold: float = DRIFT_P_THRESHOLD, exact: bool = True) -> DataFrame:
    """Q2: per numeric feature present on both sides: KS D, p-value, drifted flag.

    Features with no non-missing value on either side are skipped.  The p-value
    is exact for samples of 10,000 values at most (``exact=False``: never).
    """
    feats = [f for f in (features or numeric_features(current))
             if f in reference.columns and f in current.columns
             and dict(reference.dtypes)[f] in NUMERIC]
    return _with_p_value(ks_statistic(reference, current, feats), p_threshold, exact)


def prediction_drift(reference: DataFrame, current: DataFrame, col: str = "churn_proba",
                     p_threshold: float = DRIFT_P_THRESHOLD, exact: bool = True) -> DataFrame:
    """Q3: KS on the score column; an empty side gives D 0, p 1, not drifted."""
    fd = feature_drift(reference.select(col), current.select(col), [col], p_threshold, exact)
    # a global aggregate always yields one row; an empty side leaves it NULL -> defaults
    return fd.agg(F.lit(col).alias("feature"),
                  F.coalesce(F.max("ks_statistic"), F.lit(0.0)).alias("ks_statistic"),
                  F.coalesce(F.max("p_value"), F.lit(1.0)).alias("p_value"),
                  F.coalesce(F.max("drifted"), F.lit(False)).alias("drifted"))


def drift_summary(feature_results: DataFrame, prediction_result: DataFrame) -> DataFrame:
    """Q4: any drift, number of drifted features and the summary text (one row)."""
    f = feature_results.agg(
        F.count_if("drifted").alias("n_features_drifted"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("drifted"), F.col("feature")))), ", ")
        .alias("_names"))
    p = prediction_result.select(F.col("drifted").alias("_pd"), F.col("ks_statistic").alias("_pks"))
    j = attach_scalar(f, p)
    lines = F.array_compact(F.array(
        F.when(F.col("n_features_drifted") > 0, F.concat(F.lit("Feature drift detected in: "), F.col("_names"))),
        F.when(F.col("_pd"), F.format_string("Prediction drift: KS=%.4f", F.col("_pks")))))
    text = F.when(F.size(lines) > 0, F.array_join(lines, "\n")).otherwise(F.lit("No drift detected."))
    return j.select(((F.col("n_features_drifted") > 0) | F.col("_pd")).alias("any_drift"),
                    F.col("n_features_drifted").cast("long").alias("n_features_drifted"),
                    text.alias("summary"))


def reference_snapshot(df: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """Long ``(feature, value)`` table of every non-missing numeric value."""
    feats = [f for f in (features or numeric_features(df)) if f in df.columns]
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in feats)
    return (df.selectExpr(f"stack({len(feats)}, {stack}) AS (feature, value)")
            .filter(F.col("value").isNotNull() & ~F.isnan("value")))


def reference_stats(snapshot: DataFrame) -> DataFrame:
    """Q5: mean, sample std, exact quartiles and count per feature of a snapshot."""
    stats = snapshot.groupBy("feature").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.count(F.lit(1)).alias("count"))
    q = with_group_quantiles(stats, snapshot, ["feature"], {"_q": F.col("value")}, [0.25, 0.5, 0.75])
    return q.select("feature", "mean", "std", *[F.col("_q")[k].alias(n) for k, n in enumerate(("q25", "q50", "q75"))], "count")


def snapshot_as_wide(snapshot: DataFrame) -> DataFrame:
    """U5 in long form: a snapshot is already one (feature, value) row per value, no padding."""
    return snapshot


def drift_long(reference: DataFrame, current: DataFrame, p_threshold: float = DRIFT_P_THRESHOLD,
               exact: bool = True) -> DataFrame:
    """Q2 on long ``(feature, value)`` samples: D, p-value as in ``feature_drift``, drifted flag."""
    return _with_p_value(ks_from_long(reference, current), p_threshold, exact)


def value_counts_long(rows: DataFrame) -> DataFrame:
    """``(feature, value, n)`` of the non-missing values of long rows; sums of such tables describe all their rows."""
    return rows.select("feature", F.col("value").cast("double").alias("value")) \
        .where(F.col("value").isNotNull() & ~F.isnan("value")).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def drift_of_counts(reference: DataFrame, current: DataFrame, p_threshold: float = DRIFT_P_THRESHOLD,
                    exact: bool = True) -> DataFrame:
    """Q2 from two ``value_counts_long`` tables, as ``drift_long`` of the rows they count."""
    both = reference.select("feature", "value", F.col("n").alias("c0"), F.lit(0).alias("c1")).unionByName(
        current.select("feature", "value", F.lit(0).alias("c0"), F.col("n").alias("c1")))
    counts = both.groupBy("feature", "value").agg(F.sum("c0").cast("double").alias("c0"), F.sum("c1").cast("double").alias("c1"))
    return _with_p_value(ks_from_counts(counts), p_threshold, exact)


def drift_from_snapshot(snapshot: DataFrame, current: DataFrame, p_threshold: float = DRIFT_P_THRESHOLD,
                        exclude: Sequence[str] = (KEY, "churn_proba")) -> DataFrame:
    """Q2 against a saved long snapshot."""
    feats = [f for f in numeric_features(current) if f not in exclude]
    return drift_long(snapshot.filter(F.col("feature").isin(feats)), reference_snapshot(current, feats),
                      p_threshold)


def drift_metrics(summary: DataFrame) -> DataFrame:
    """Q8: metric rows (DriftDetected 0/1, FeaturesDrifted n)."""
    return summary.select(F.explode(F.array(
        F.struct(F.lit("DriftDetected").alias("metric"), F.col("any_drift").cast("double").alias("value")),
        F.struct(F.lit("FeaturesDrifted").alias("metric"), F.col("n_features_drifted").cast("double")
                 .alias("value")))).alias("m")).select("m.*")


def run_drift_job(spark, scored: DataFrame, reference_path: str, out_path: str,
                  p_threshold: float = DRIFT_P_THRESHOLD) -> DataFrame:
    """Q7: first run saves the snapshot and reports no drift; later runs compare and write the report."""
    from voltchurn.sources.io import path_exists

    if not path_exists(spark, reference_path):
        reference_snapshot(scored, [f for f in numeric_features(scored)]).write.mode("overwrite").parquet(
            reference_path)
        summary = spark.createDataFrame([(False, 0, "Baseline saved; no comparison on first run.")],
                                        "any_drift boolean, n_features_drifted long, summary string")
    else:
        snap = spark.read.parquet(reference_path)
        fd = drift_from_snapshot(snap.filter(F.col("feature") != "churn_proba"), scored, p_threshold)
        pref = snap.filter(F.col("feature") == "churn_proba").select(F.col("value").alias("churn_proba"))
        pdrift = prediction_drift(pref, scored.select("churn_proba"), "churn_proba", p_threshold) \
            if "churn_proba" in scored.columns else None
        if pdrift is None:
            pdrift = spark.createDataFrame([("churn_proba", 0.0, 1.0, False)],
                                           "feature string, ks_statistic double, p_value double, drifted boolean")
        summary = drift_summary(fd, pdrift)
    summary.write.mode("overwrite").json(out_path)
    return summary


def load_reference(spark, path: str) -> DataFrame:
    """Q6: a saved long ``(feature, value)`` reference snapshot."""
    return spark.read.parquet(path)

"""Model matrix, split, training, calibration, scoring.

Training uses MLlib estimators on the distributed gold table; evaluation,
thresholds and calibration curves are DataFrame aggregations from
``operators.stats``.  No step collects rows to the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltchurn.constants import (
    CATEGORICAL_DEFAULT_COLS,
    CATEGORICAL_DEFAULT_VALUE,
    FLAG_PREFIXES,
    FLAG_SUFFIXES,
    KEY,
    NUMERIC_SENTINEL_COLS,
    NUMERIC_SENTINEL_VALUE,
    RISK_EDGES,
    RISK_LABELS,
    TARGET_RECALL,
)
from voltchurn.functions.exprs import clip_lower0, cut
from voltchurn.operators.frames import cut_lineage
from voltchurn.session import scratch_path
from voltchurn.operators.stats import (
    attach_scalar,
    confusion_metrics,
    grouped_quantile,
    pick_threshold,
    prefix_sums,
    ranking_metrics,
    total_of,
)

NUMERIC = {"double", "float", "int", "bigint", "smallint", "tinyint", "boolean"}


# ---------------------------------------------------------------- M1 ----

def flag_columns(columns: Sequence[str]) -> list[str]:
    """Columns the reference treats as 0/1 flags by name (prefix / suffix rule)."""
    return [c for c in columns if c.startswith(FLAG_PREFIXES) or c.endswith(FLAG_SUFFIXES)]


def normalize_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """types that preprocessing can take, by the schema: booleans become 0/1 bytes, decimals doubles,
    fixed-length and collated strings plain ones.  NULLs stay; other types and columns are not touched."""
    def plain(name: str, kind: T.DataType):
        if isinstance(kind, T.BooleanType):
            return F.col(f"`{name}`").cast("tinyint")
        if isinstance(kind, T.DecimalType):
            return F.col(f"`{name}`").cast("double")
        if isinstance(kind, (T.CharType, T.VarcharType)) or isinstance(kind, T.StringType) and kind != T.StringType():
            return F.col(f"`{name}`").cast("string")
        return None

    wanted = set(columns if columns is not None else df.columns)
    casts = {f.name: c for f in df.schema.fields if f.name in wanted and (c := plain(f.name, f.dataType)) is not None}
    return df.withColumns(casts) if casts else df


def model_matrix(gold: DataFrame, features: Sequence[str], label: str = "churn",
                 legacy_flag_fill: bool = True) -> DataFrame:
    """M1: structural fills, then ``(customer_id, label, *available features)``.

    NULL recency -> 9999 days; NULL interaction strings -> "no_interaction";
    NULL flags -> 0.  ``legacy_flag_fill`` reproduces the name rule (which
    also zero-fills e.g. ``months_to_renewal``); otherwise only integer flag
    columns are filled.
    """
    gold = normalize_types(gold)
    cols = set(gold.columns)
    fills = {c: NUMERIC_SENTINEL_VALUE for c in NUMERIC_SENTINEL_COLS if c in cols}
    fills.update({c: CATEGORICAL_DEFAULT_VALUE for c in CATEGORICAL_DEFAULT_COLS if c in cols})
    dtypes = dict(gold.dtypes)
    for c in flag_columns(gold.columns):
        if c in fills:
            continue
        if legacy_flag_fill or dtypes[c] in ("int", "bigint"):
            fills[c] = 0 if dtypes[c] in NUMERIC else "0"
    g = gold
    for c, v in fills.items():
        if dtypes[c] in NUMERIC and not isinstance(v, str):
            g = g.withColumn(c, F.coalesce(F.col(c), F.lit(v).cast(dtypes[c])))
        elif dtypes[c] == "string":
            g = g.withColumn(c, F.coalesce(F.col(c), F.lit(str(v))))
    avail = [f for f in features if f in cols]
    return g.select(KEY, label, *avail)


def missing_features(gold: DataFrame, features: Sequence[str]) -> list[str]:
    return [f for f in features if f not in gold.columns]


# ---------------------------------------------------------------- M2 ----

def _hash_ranked(df: DataFrame, label: str, seed: int, key: str) -> DataFrame:
    """``df`` with ``_pos``: the row's place (from 1) in its class by a hash of key and seed.

    The hash is the first 60 bits of md5("key:seed"), so other engines can repeat
    it; a null key counts as empty.  Places come from ``prefix_sums``, which
    carries the rows: none is joined back, so null and repeated keys stay, each
    row with a place of its own.
    """
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    bits = F.conv(F.substring(F.md5(F.concat(name, F.lit(f":{seed}"))), 1, 15), 16, 10).cast("long")
    placed = prefix_sums(df.withColumns({"_h": bits, "_one": F.lit(1)}), [label], "_h", ["_one"])
    return placed.withColumnRenamed("_one_cum", "_pos").drop("_h", "_one")


def stratified_split(df: DataFrame, label: str = "churn", test_size: float = 0.20, seed: int = 42,
                     key: str = KEY, col: str = "is_test") -> DataFrame:
    """M2: exact stratified split: per class the round(test_size * n) rows with the smallest
    hash of key and seed go to test.  Depends on the rows alone, not on how they are partitioned
    (rows that share a key may change places among themselves).  A null label is a class of its own.
    """
    ranked = _hash_ranked(df, label, seed, key)
    n = ranked.groupBy(F.col(label).alias("_label")).agg(F.max("_pos").alias("_n"))
    return ranked.join(n, F.col(label).eqNullSafe(F.col("_label"))) \
        .withColumn(col, F.col("_pos") <= F.round(F.col("_n") * test_size)).drop("_label", "_n", "_pos")


def stratified_folds(df: DataFrame, label: str = "churn", k: int = 5, seed: int = 42, key: str = KEY,
                     col: str = "fold") -> DataFrame:
    """Stratified fold ids (0..k-1) by hash position within each class, for ``foldCol``."""
    return _hash_ranked(df, label, seed, key).withColumn(col, ((F.col("_pos") - 1) % k).cast("int")).drop("_pos")


# ---------------------------------------------------------------- M3/M4 ----

def split_types(df: DataFrame, features: Sequence[str]) -> tuple[list[str], list[str]]:
    d = dict(df.dtypes)
    num = [f for f in features if d[f] in NUMERIC]
    cat = [f for f in features if d[f] == "string"]
    return num, cat


def preprocessing_stages(df: DataFrame, features: Sequence[str], scale_numeric: bool = True):
    """M3: median imputation (+ scaling) for numbers, 'missing' + one-hot for strings."""
    num, cat = split_types(df, features)
    stages = []
    num_out = [f"{c}__imp" for c in num]
    if num:
        stages.append(Imputer(inputCols=num, outputCols=num_out, strategy="median"))
    cat_idx = [f"{c}__idx" for c in cat]
    cat_vec = [f"{c}__ohe" for c in cat]
    if cat:
        stages.append(StringIndexer(inputCols=cat, outputCols=cat_idx, handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=cat_idx, outputCols=cat_vec, handleInvalid="keep",
                                    dropLast=False))
    stages.append(VectorAssembler(inputCols=num_out, outputCol="num_vec", handleInvalid="keep"))
    num_col = "num_vec"
    if scale_numeric and num:
        stages.append(StandardScaler(inputCol="num_vec", outputCol="num_scaled", withMean=True, withStd=True))
        num_col = "num_scaled"
    stages.append(VectorAssembler(inputCols=[num_col] + cat_vec, outputCol="features"))
    return stages


def fill_missing_strings(df: DataFrame, features: Sequence[str]) -> DataFrame:
    _, cat = split_types(df, features)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit("missing")) for c in cat}) if cat else df


def class_weights(df: DataFrame, label: str = "churn", col: str = "weight") -> DataFrame:
    """'balanced' weights: n / (2 * n_class) per row."""
    n = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    tot = total_of(df, "_n")
    return attach_scalar(df.join(F.broadcast(n), label), tot).withColumn(
        col, F.col("_n") / (2.0 * F.col("_nc"))).drop("_nc", "_n")


#: share of the columns that boosted trees choose among at each split
COLUMN_SHARE = 0.7

#: rows of one task of a tree level: fewer are not worth its start, more than the second not its memory
ROWS_A_TASK = (30_000, 500_000)


class PlainLogisticRegression(LogisticRegression):
    """Logistic regression whose fitted model leaves its training summary behind.

    The summary keeps the session, which cannot be sent to tasks any more once
    the session has observed a metric; scoring with such a model then fails.  So
    the model is saved to the shared folder and read back, without a summary.
    """

    def _fit(self, dataset):
        path = scratch_path(dataset.sparkSession, f"logistic-{uuid.uuid4().hex}")
        super()._fit(dataset).write().save(path)
        return LogisticRegressionModel.load(path)


class PlainRandomForest(RandomForestClassifier):
    """Random forest whose fitted model leaves its training summary behind (as ``PlainLogisticRegression``)."""

    def _fit(self, dataset):
        path = scratch_path(dataset.sparkSession, f"forest-{uuid.uuid4().hex}")
        super()._fit(dataset).write().save(path)
        return RandomForestClassificationModel.load(path)


def estimator(name: str, label: str = "churn", seed: int = 42, **params):
    """M4: model catalogue (MLlib), with the reference's sizes unless ``params`` says otherwise."""
    if name == "logistic_regression":
        return PlainLogisticRegression(labelCol=label, weightCol="weight", maxIter=params.get("maxIter", 1000),
                                       regParam=params.get("regParam", 0.0))
    if name == "random_forest":
        return PlainRandomForest(labelCol=label, weightCol="weight", numTrees=params.get("numTrees", 300),
                                 maxDepth=params.get("maxDepth", 8), seed=seed)
    if name == "gbt":
        return GBTClassifier(labelCol=label, weightCol="weight", maxIter=params.get("maxIter", 600),
                             maxDepth=params.get("maxDepth", 3), stepSize=params.get("stepSize", 0.02),
                             subsamplingRate=params.get("subsamplingRate", 0.8),
                             featureSubsetStrategy=str(params.get("featureSubsetStrategy", COLUMN_SHARE)),
                             validationTol=params.get("validationTol", 0.01), seed=seed)
    raise ValueError(f"Unknown model: {name}")


def spread_rows(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly: a partition a core (or some, of at most ``ROWS_A_TASK`` rows), fewer for few rows.

    After a shuffle partitions are merged by their bytes, which tells nothing of the work that follows:
    900,000 narrow rows came in two partitions, for hundreds of rounds.
    """
    rows, (least, most) = df.count(), ROWS_A_TASK
    parts = max(1, min(df.sparkSession.sparkContext.defaultParallelism, rows // least))
    return df.repartition(parts * max(1, -(-rows // (parts * most))))


def fit(train: DataFrame, features: Sequence[str], model_name: str = "gbt", label: str = "churn",
        validation_share: float = 0.0, key: str = KEY, **params) -> PipelineModel:
    """Fit preprocessing + estimator on the training rows.

    Logistic regression takes the ridge penalty of C = 1 (regParam = 1 / rows).
    With ``validation_share`` boosted trees stop early: that stratified share of
    the rows is kept out of the trees, and rounds end once its loss falls by less
    than ``validationTol``.  ``maxIter`` is then the most rounds.
    """
    early = validation_share > 0 and model_name == "gbt"
    if early:
        train = stratified_split(train, label, validation_share, key=key, col="_held")
    if model_name == "gbt":
        train = spread_rows(train)
    # iterative estimators re-read their input many times: materialise it once
    tr = cut_lineage(class_weights(fill_missing_strings(train, features), label)
                     .withColumn(label, F.col(label).cast("double")))
    if model_name == "logistic_regression" and "regParam" not in params:
        params["regParam"] = 1.0 / max(tr.count(), 1)
    last = estimator(model_name, label, **params)
    if early:
        last = last.setValidationIndicatorCol("_held")
    stages = preprocessing_stages(tr, features, scale_numeric=model_name == "logistic_regression")
    if model_name == "gbt":                       # reads its vectors three times before it keeps its own form of them
        prep = Pipeline(stages=stages).fit(tr)
        vectors = prep.transform(tr).select("features", label, "weight", *["_held"] * early).persist(StorageLevel.DISK_ONLY)
        try:
            vectors.count()                       # by all cores: the first look at a row would else fill one partition alone
            model = PipelineModel(stages=[*prep.stages, last.fit(vectors)])
        finally:
            vectors.unpersist()
    else:
        model = Pipeline(stages=stages + [last]).fit(tr)
    if early:                                     # scoring needs no such column
        model.stages[-1].clear(model.stages[-1].getParam("validationIndicatorCol"))
    return model


def tree_columns(model: PipelineModel) -> list[set[int]]:
    """The columns (places in the assembled vector) that each tree of a boosted model splits on."""
    import re

    return [{int(c) for c in re.findall(r"feature (\d+)", tree.toDebugString)} for tree in model.stages[-1].trees]


def _transformed(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    return model.transform(fill_missing_strings(df, features).withColumn("weight", F.lit(1.0)))


def predict_proba(model: PipelineModel, df: DataFrame, features: Sequence[str], out: str = "proba") -> DataFrame:
    """Positive-class probability as a double column (model output columns dropped).

    A calibrated model (``with_calibrator``) gives its calibrated probability.
    """
    column = model.stages[-1].getProbabilityCol()
    return _transformed(model, df, features).select(*[F.col(c) for c in df.columns], vector_to_array(column)[1].alias(out))


def baseline_scores(df: DataFrame, train: DataFrame, strategy: str = "most_frequent", label: str = "churn",
                    seed: int = 42, out: str = "proba") -> DataFrame:
    """M5: majority class (constant) or class-prior random scores."""
    prior = train.agg(F.avg(F.col(label).cast("double")).alias("_prior"))
    j = attach_scalar(df, prior)
    if strategy == "most_frequent":
        return j.withColumn(out, F.when(F.col("_prior") > 0.5, 1.0).otherwise(0.0)).drop("_prior")
    # a uniform draw per key (60 bits of md5("key:seed:draw")), the same however the rows are partitioned
    name = F.coalesce(F.col(KEY).cast("string"), F.lit(""))
    draw = F.conv(F.substring(F.md5(F.concat(name, F.lit(f":{seed}:draw"))), 1, 15), 16, 10).cast("long").cast("double") / float(1 << 60)
    return j.withColumn(out, (draw < F.col("_prior")).cast("double")).drop("_prior")


# ---------------------------------------------------------------- M6 ----

def calibrator_stages(val_transformed: DataFrame, label: str = "churn") -> list:
    """M6: fitted sigmoid calibration of ``probability``: slice its positive part, one-feature logistic regression."""
    pick = VectorSlicer(inputCol="probability", outputCol="_score", indices=[1])
    lr = PlainLogisticRegression(featuresCol="_score", labelCol=label, regParam=0.0, maxIter=100, predictionCol="_cal_pred",
                            probabilityCol="calibrated", rawPredictionCol="_cal_raw")
    return Pipeline(stages=[pick, lr]).fit(val_transformed.withColumn(label, F.col(label).cast("double"))).stages


def with_calibrator(model: PipelineModel, stages: Sequence) -> PipelineModel:
    """One pipeline of preprocessing, model and calibration, to be saved and scored as a whole."""
    return PipelineModel(stages=[*model.stages, *stages])


# ---------------------------------------------------------------- M8/M9 ----

def evaluate(scored: DataFrame, threshold, label: str = "churn", score: str = "proba") -> DataFrame:
    """M8: one row of ROC-AUC, AP and the confusion metrics at ``threshold``."""
    rm = ranking_metrics(scored, label, score)
    cm = confusion_metrics(scored, label, score, threshold)
    return attach_scalar(rm.select("roc_auc", "pr_auc"), cm)


def run_experiment(train: DataFrame, test: DataFrame, features: Sequence[str], model_name: str = "gbt",
                   label: str = "churn", target_recall: float = TARGET_RECALL, seed: int = 42, **params) -> dict:
    """M9: fit on train; calibrate and pick the threshold on rows held out of a fit; evaluate on test.

    A model fitted without a stratified 25 % validation part scores that part;
    those scores fit the calibrator and, calibrated, give the threshold.  The
    model fitted on all of train with that calibrator behind it is what is
    evaluated, returned and saved.  The two fits need nothing of each other and
    run side by side: boosting is a chain of short jobs, which one chain alone
    leaves most cores waiting for.  Returns fitted pipelines and small result
    DataFrames (nothing collected).
    """
    parts = cut_lineage(stratified_split(train, label, 0.25, seed, col="_is_val"))
    sub, val = parts.filter(~F.col("_is_val")).drop("_is_val"), spread_rows(parts.filter("_is_val").drop("_is_val"))
    both = ThreadPoolExecutor(1)
    whole = both.submit(inheritable_thread_target(lambda: fit(train, features, model_name, label, **params)))
    try:
        sub_model = fit(sub, features, model_name, label, **params)
    finally:
        both.shutdown(wait=True)
    held = cut_lineage(_transformed(sub_model, val, features).select(label, "probability"))
    stages = calibrator_stages(held, label)
    val_scored = cut_lineage(predict_proba(with_calibrator(sub_model, stages), val, features))
    thr = pick_threshold(val_scored, label, "proba", target_recall)
    raw = whole.result()
    model = with_calibrator(raw, stages)
    test_scored = cut_lineage(attach_scalar(predict_proba(model, spread_rows(test), features), thr.select("threshold")))
    metrics = evaluate(test_scored, F.col("threshold"), label)
    return {"model": model, "uncalibrated": raw, "threshold": thr, "metrics": metrics, "model_name": model_name,
            "test_scored": test_scored}


# ---------------------------------------------------------------- M13/M14 ----

def risk_tier(col: str = "churn_proba"):
    """[0, .4) Low, [.4, .6) Medium, [.6, .8) High, [.8, 1.01) Critical."""
    return cut(col, RISK_EDGES, RISK_LABELS, right=False)


def score_frame(df: DataFrame, threshold: float, proba_col: str = "proba", label: str = "churn") -> DataFrame:
    """M13 + M14 on one frame that already holds the raw probability next to the
    business columns: proba (4 dp, half-even), prediction, expected loss, tier."""
    biz = [c for c in ("avg_monthly_margin", "total_margin_2024", "segment") if c in df.columns]
    out = df.select(KEY, F.col(label).alias("churn_actual") if label in df.columns
                    else F.lit(None).cast("int").alias("churn_actual"),
                    F.bround(F.col(proba_col), 4).alias("churn_proba"), *biz)
    out = out.withColumn("churn_pred", (F.col("churn_proba") >= threshold).cast("int"))
    if "avg_monthly_margin" in biz:
        out = out.withColumn("expected_monthly_loss",
                             F.bround(F.col("churn_proba") * clip_lower0("avg_monthly_margin"), 2))
    out = out.withColumn("risk_tier", risk_tier("churn_proba"))
    cols = [KEY, "churn_actual", "churn_proba", "churn_pred", *biz,
            *(["expected_monthly_loss"] if "avg_monthly_margin" in biz else []), "risk_tier"]
    return out.select(*cols)


def score_customers(scores: DataFrame, gold: DataFrame, threshold: float, proba_col: str = "proba",
                    label: str = "churn") -> DataFrame:
    """M13 + M14: ``scores`` (customer_id, raw probability) joined to the business columns of
    ``gold``, then ``score_frame``."""
    biz = [c for c in ("avg_monthly_margin", "total_margin_2024", "segment", label) if c in gold.columns]
    s = scores.select(KEY, F.col(proba_col).alias("_proba"))
    return score_frame(s.join(gold.select(KEY, *biz), KEY, "left"), threshold, "_proba", label)


def rank_scored(scored: DataFrame) -> DataFrame:
    """Highest probability first, customer id as tie-break."""
    return scored.orderBy(F.desc("churn_proba"), KEY)


def tier_summary(scored: DataFrame) -> DataFrame:
    """Per risk tier: customers, flagged, mean probability, margin, expected loss."""
    return scored.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("churn_pred").cast("long").alias("flagged"),
        F.avg("churn_proba").alias("avg_proba"), F.avg("avg_monthly_margin").alias("avg_margin"),
        F.avg("expected_monthly_loss").alias("avg_expected_loss"))


def flagged_by_segment(scored: DataFrame) -> DataFrame:
    """Flagged customers per segment: count, mean probability, total expected loss."""
    return scored.filter(F.col("churn_pred") == 1).groupBy("segment").agg(
        F.count(F.lit(1)).alias("flagged"), F.avg("churn_proba").alias("avg_proba"),
        F.coalesce(F.sum("expected_monthly_loss"), F.lit(0.0)).alias("total_expected_loss"))


def feature_importance(model: PipelineModel, sample: DataFrame, features: Sequence[str], top: int = 20) -> DataFrame:
    """Importances (trees) or |coefficients| (linear) with names after encoding, top ``top``.

    Names come from the assembled vector's ML attributes; the result is a
    small DataFrame (one row per encoded feature).
    """
    last = [st for st in model.stages if st.hasParam("featuresCol") and st.getFeaturesCol() == "features"][-1]
    out = model.transform(fill_missing_strings(sample.limit(1), features).withColumn("weight", F.lit(1.0)))
    attrs = out.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    names = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    imp = getattr(last, "featureImportances", None)
    vals = imp.toArray() if imp is not None else abs(last.coefficients.toArray())
    ss = sample.sparkSession
    rows = [(names.get(i, f"f{i}"), float(v)) for i, v in enumerate(vals)]
    df = ss.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature").limit(top)


def save_model(model: PipelineModel, path: str, metadata: dict) -> None:
    """Model directory + one JSON metadata record beside it."""
    from pyspark.sql import SparkSession

    model.write().overwrite().save(f"{path}/model")
    ss = SparkSession.getActiveSession()
    ss.createDataFrame([(json.dumps(metadata, default=str),)], "metadata string").coalesce(1).write.mode(
        "overwrite").text(f"{path}/metadata")


def load_model(path: str) -> tuple[PipelineModel, dict]:
    from pyspark.sql import SparkSession

    ss = SparkSession.getActiveSession()
    meta = json.loads(ss.read.text(f"{path}/metadata").first()[0])
    return PipelineModel.load(f"{path}/model"), meta


def champion(versions: DataFrame) -> DataFrame:
    """Newest approved model version (one row)."""
    return versions.filter(F.col("status") == "Approved").orderBy(F.desc("created_at"), F.desc("version")).limit(1)


def newest_versions(versions: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` newest model versions, newest first (a top-k list)."""
    return versions.orderBy(F.desc("created_at"), F.desc("version")).limit(n)


def promotion_decision(metrics: DataFrame, min_ap: float = 0.70) -> DataFrame:
    """Approve when AP >= ``min_ap``."""
    return metrics.select("pr_auc", "roc_auc", (F.col("pr_auc") >= min_ap).alias("approved"),
                          F.lit(min_ap).alias("pr_auc_threshold"))


def break_even(gold: DataFrame, outreach_cost: float, precision: float, label: str = "churn") -> DataFrame:
    """Revenue at risk per churner (median margin x median tenure) vs outreach cost."""
    med = grouped_quantile(gold.filter(F.col(label) == 1), [], {
        "median_margin": F.col("avg_monthly_margin"), "median_tenure": F.col("tenure_months")}, 0.5)
    return med.select("*", (F.col("median_margin") * F.col("median_tenure")).alias("value_per_churner"),
                      (F.lit(outreach_cost) / (F.col("median_margin") * F.col("median_tenure")))
                      .alias("break_even_precision"),
                      (F.lit(precision) >= F.lit(outreach_cost) / (F.col("median_margin") * F.col("median_tenure")))
                      .alias("worth_it"))


# ---------------------------------------------------------------- M10/M11 ----

class AveragePrecisionEvaluator:
    """AP (step rule) as an MLlib evaluator, computed with DataFrame aggregates."""

    def __new__(cls, label: str = "churn"):
        from pyspark.ml.evaluation import Evaluator

        class _AP(Evaluator):
            def _evaluate(self, dataset):
                scored = dataset.select(F.col(label).cast("int").alias("_y"),
                                        vector_to_array("probability")[1].alias("_p"))
                return float(ranking_metrics(scored, "_y", "_p").first()["pr_auc"])

            def isLargerBetter(self):
                return True

        return _AP()


def grid_search(train: DataFrame, features: Sequence[str], model_name: str, grid: dict, label: str = "churn",
                folds: int = 5, seed: int = 42, parallelism: int = 2):
    """K-fold stratified grid search scored by AP.

    Folds are exact per class (hash positions, ``stratified_folds``) and passed
    to ``CrossValidator`` through ``foldCol``.
    """
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    data = cut_lineage(class_weights(fill_missing_strings(
        stratified_folds(train, label, folds, seed), features), label).withColumn(label, F.col(label).cast("double")))
    est = estimator(model_name, label, seed)
    pipe = Pipeline(stages=preprocessing_stages(data, features, model_name == "logistic_regression") + [est])
    pg = ParamGridBuilder()
    for name, values in grid.items():
        pg = pg.addGrid(est.getParam(name), values)
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=pg.build(), evaluator=AveragePrecisionEvaluator(label),
                        foldCol="fold", parallelism=parallelism, seed=seed)
    return cv.fit(data)


def experiment_ladder(train: DataFrame, test: DataFrame, experiments: dict, models: Sequence[str],
                      label: str = "churn", target_recall: float = TARGET_RECALL) -> DataFrame:
    """M10 + U2 + T9: every (feature set, model) pair -> one metrics row, best AP first.

    Tree models take the features without the cross strings, as in training.
    The loop is over configurations (a handful), each a distributed fit; no
    data passes through the driver.
    """
    from voltchurn.plans.features import tree_feature_list

    out = None
    for exp_name, feats in experiments.items():
        for m in models:
            use = feats if m == "logistic_regression" else tree_feature_list(feats)
            res = run_experiment(train, test, use, m, label, target_recall)
            row = res["metrics"].select(F.lit(exp_name).alias("experiment"), F.lit(m).alias("model"), "*")
            out = row if out is None else out.unionByName(row)
    return out.orderBy(F.desc("pr_auc"), F.desc("roc_auc"))

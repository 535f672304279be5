"""Layer wiring (G10, G12): raw tables -> bronze -> silver -> gold."""

from __future__ import annotations

from pyspark.sql import DataFrame

from voltchurn.operators.frames import cut_lineage
from voltchurn.plans import bronze, enrich, gold, silver


def bronze_layer(raw: dict[str, DataFrame], scorer=None, validate: bool = True,
                 interaction_id: str | None = None) -> dict[str, DataFrame]:
    """Both bronze tables; ``interaction_id`` names a unique column of the interactions, if they have one."""
    bc = bronze.customer(raw["churn"], raw["attributes"], raw["contracts"], raw["interactions"],
                         enrich=lambda df: enrich.enrich_interactions(df, scorer=scorer), interaction_id=interaction_id)
    bcm = bronze.customer_month(raw["consumption"], prices=raw.get("prices"), costs=raw.get("costs"),
                                province_lookup=raw.get("attributes"), validate=validate)
    return {"bronze_customer": bc, "bronze_customer_month": bcm}


class LazyLayers:
    """Layer tables by name, each built at its first use."""

    def __init__(self, builders: dict):
        self.builders, self._built = builders, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self.builders[name]()
        return self._built[name]


def silver_builders(b, segments: DataFrame | None = None) -> dict:
    """What builds each silver table from the bronze tables ``b``.

    Imputation reads only the segment column of the customer table, so the
    optimizer drops the interaction join (and its text work) from that plan.  It
    cannot where interactions were fetched by id; then ``segments`` gives a
    customer table without that join.
    """
    base = b["bronze_customer"] if segments is None else segments
    return {
        "silver_customer": lambda: silver.silver_customer(b["bronze_customer"]),
        "silver_customer_month": lambda: silver.compute_margins(silver.impute_prices(
            b["bronze_customer_month"], silver.silver_customer(base))),
    }


def silver_layer(b: dict[str, DataFrame], materialise: bool = False) -> dict[str, DataFrame]:
    """Silver tables.  ``materialise`` checkpoints the customer table for callers that reuse it
    many times; a single downstream use does not need it."""
    out = {name: build() for name, build in silver_builders(b).items()}
    if materialise:
        out["silver_customer"] = cut_lineage(out["silver_customer"])
    return out


def gold_layer(s: dict[str, DataFrame], as_of) -> DataFrame:
    return gold.gold_master(s["silver_customer"], s["silver_customer_month"], as_of)


def layers(raw: dict[str, DataFrame], as_of, scorer=None) -> dict[str, DataFrame]:
    """All layers as lazy DataFrames (nothing is computed here)."""
    b = bronze_layer(raw, scorer)
    s = silver_layer(b)
    return {**b, **s, "gold_master": gold_layer(s, as_of)}


def write_layers(frames: dict[str, DataFrame], out_dir: str, names=None) -> dict[str, str]:
    """Materialise layers as parquet, each read back so later layers start from files.

    Writing a layer and reading it back is the lineage cut: an executor lost
    later recomputes from the written files, not from the raw scans.
    """
    paths = {}
    for name, df in frames.items():
        if names and name not in names:
            continue
        p = f"{out_dir.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(p)
        paths[name] = p
    return paths


# ------------------------------------------------------------- job steps ----

def run_bronze_step(spark, raw_dir: str, out_dir: str, scorer=None) -> dict[str, str]:
    """Raw files -> bronze parquet (customer, customer-month)."""
    from voltchurn.sources import io

    raw = io.load_raw_datasets(spark, raw_dir)
    raw["consumption"] = io.load_or_convert_consumption(spark, raw_dir)
    return write_layers(bronze_layer(raw, scorer), out_dir)


def run_silver_step(spark, bronze_dir: str, out_dir: str) -> dict[str, str]:
    """Bronze parquet -> silver parquet."""
    b = {n: spark.read.parquet(f"{bronze_dir.rstrip('/')}/{n}") for n in ("bronze_customer", "bronze_customer_month")}
    return write_layers(silver_layer(b), out_dir)


def run_gold_step(spark, silver_dir: str, out_dir: str, as_of) -> dict[str, str]:
    """Silver parquet -> gold parquet (``as_of`` is required)."""
    s = {n: spark.read.parquet(f"{silver_dir.rstrip('/')}/{n}") for n in ("silver_customer", "silver_customer_month")}
    return write_layers({"gold_master": gold_layer(s, as_of)}, out_dir)


def run_train_step(spark, gold_dir: str, model_dir: str, experiment: str = "E5_full", model_name: str = "gbt",
                   **params) -> dict:
    """Gold -> fitted model + metrics record (threshold chosen on validation rows)."""
    from pyspark.sql import functions as F

    from voltchurn.plans import features as FT
    from voltchurn.plans import model as M

    g = spark.read.parquet(f"{gold_dir.rstrip('/')}/gold_master")
    feats = FT.feature_list(experiment)
    if model_name != "logistic_regression":
        feats = FT.tree_feature_list(feats)
    mm = cut_lineage(M.model_matrix(g, feats))
    split = cut_lineage(M.stratified_split(mm, "churn", 0.2, 42))
    feats = [f for f in feats if f in mm.columns]
    res = M.run_experiment(split.filter(~F.col("is_test")), split.filter("is_test"), feats, model_name, **params)
    metrics = res["metrics"].first().asDict()
    M.save_model(res["model"], model_dir, {"experiment": experiment, "features": feats, **metrics})
    return metrics


def run_evaluate_step(spark, gold_dir: str, model_dir: str, out_dir: str, min_ap: float = 0.70) -> dict:
    """Reload the saved model, evaluate it on the holdout that training left out, write the decision.

    The holdout is derived again from the keys (``stratified_split`` depends on
    nothing else), so it is the one the train step used.
    """
    from pyspark.sql import functions as F

    from voltchurn.plans import model as M

    g = spark.read.parquet(f"{gold_dir.rstrip('/')}/gold_master")
    model, meta = M.load_model(model_dir)
    feats = meta["features"]
    test = M.stratified_split(M.model_matrix(g, feats), "churn", 0.2, 42).filter("is_test").drop("is_test")
    scored = cut_lineage(M.predict_proba(model, test, feats))
    metrics = M.evaluate(scored, F.lit(float(meta["threshold"])), "churn")
    write_layers({"decision": M.promotion_decision(metrics, min_ap)}, out_dir)
    return {**metrics.first().asDict(), **spark.read.parquet(f"{out_dir.rstrip('/')}/decision").first().asDict()}


def run_score_step(spark, gold_dir: str, model_dir: str, out_dir: str) -> str:
    """Gold + saved (calibrated) model -> scored table and recommendations (parquet)."""
    from voltchurn.plans import model as M
    from voltchurn.plans import recommend as RC

    g = spark.read.parquet(f"{gold_dir.rstrip('/')}/gold_master")
    model, meta = M.load_model(model_dir)
    feats = meta["features"]
    probs = M.predict_proba(model, M.model_matrix(g, feats), feats)
    scored = M.score_customers(probs, g, float(meta["threshold"]))
    paths = write_layers({"scored_customers": scored}, out_dir)
    sc = spark.read.parquet(paths["scored_customers"])
    write_layers({"recommendations": RC.validated(RC.recommendations(sc))}, out_dir)
    return paths["scored_customers"]


def run_local_pipeline(spark, raw_dir: str, out_dir: str, as_of, model_name: str = "gbt") -> dict:
    """Bronze -> silver -> gold -> train -> score, each layer written and read back."""
    base = out_dir.rstrip("/")
    run_bronze_step(spark, raw_dir, f"{base}/bronze")
    run_silver_step(spark, f"{base}/bronze", f"{base}/silver")
    run_gold_step(spark, f"{base}/silver", f"{base}/gold", as_of)
    metrics = run_train_step(spark, f"{base}/gold", f"{base}/model", model_name=model_name)
    scored = run_score_step(spark, f"{base}/gold", f"{base}/model", f"{base}/scored")
    return {"metrics": metrics, "scored_path": scored}

import pytest
from pyspark.sql import functions as F

from voltchurn.plans import model as M
from voltchurn.plans import recommend as RC


def _scored(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, churn_proba double, risk_tier string, segment string, "
                                       "expected_monthly_loss double, avg_monthly_margin double")


def test_risk_tiers_left_closed(spark):
    df = spark.createDataFrame([(0.10,), (0.40,), (0.60,), (0.80,), (0.3999,), (1.0,)], "churn_proba double")
    got = [r.t for r in df.select(M.risk_tier().alias("t")).collect()]
    assert got == ["Low (<40%)", "Medium (40-60%)", "High (60-80%)", "Critical (>80%)", "Low (<40%)",
                   "Critical (>80%)"]


def test_recommendations_policy(spark):
    rows = [("a", 0.90, "Critical (>80%)", "SME", 50.0, 100.0), ("b", 0.45, "Medium (40-60%)", "Residential", 5.0, 10.0),
            ("c", 0.10, "Low (<40%)", None, 0.0, 5.0), ("d", 0.85, "Critical (>80%)", "Corporate", 0.0, -20.0),
            ("e", 0.70, "Unknown tier", "", 1.0, 1.0)]
    out = {r.customer_id: r for r in RC.validated(RC.recommendations(_scored(spark, rows))).collect()}
    assert out["a"].action == "offer_large" and out["a"].timing_window == "immediate"
    assert out["a"].reason_codes == ["critical_churn_risk", "churn_probability_above_80pct", "segment_sme"]
    assert out["b"].action == "offer_small" and out["b"].reason_codes == ["moderate_churn_risk", "segment_residential"]
    assert out["c"].reason_codes == ["low_risk_monitoring"] and out["c"].segment == "Unknown"
    assert out["d"].action == "no_offer"                         # negative-margin guardrail
    assert out["e"].action == "no_offer" and out["e"].timing_window == "60_90_days"


def test_contract_violation_fails_job(spark):
    reco = spark.createDataFrame([("x", 1.5, "SME", "offer_large", "immediate", 1.0, ["a"])],
                                 "customer_id string, risk_score double, segment string, action string, "
                                 "timing_window string, expected_margin_impact double, reason_codes array<string>")
    assert RC.contract_violations(reco).count() == 1
    with pytest.raises(Exception, match="contract"):
        RC.validated(reco).collect()


def test_offer_budget_and_roi(spark):
    rows = [("a", 0.9, "Critical (>80%)", "SME", 45.0, 100.0), ("c", 0.1, "Low (<40%)", "SME", 0.0, 5.0)]
    sc = _scored(spark, rows)
    reco = RC.with_recommendation(sc)
    assert {r.customer_id: r.offer_budget_eur for r in RC.offer_budget(reco).collect()} == {"a": 25.0, "c": 0.0}
    fin = {r.customer_id: r for r in RC.customer_financials(reco).collect()}
    assert (fin["a"].monthly_expected_loss, fin["a"].offer_cost) == (90.0, 25.0)
    assert (fin["a"].annual_expected_loss, fin["a"].net_saved_monthly) == (1080.0, 65.0)
    assert abs(fin["a"].roi_pct - 260.0) < 1e-9                   # percent of the cost
    assert fin["c"].roi_pct is None                               # no cost -> no ROI


def test_financials_are_neither_clipped_nor_rounded(spark):
    sc = _scored(spark, [("n", 0.33333, "Low (<40%)", "SME", 0.0, -7.77)])
    r = RC.customer_financials(RC.with_recommendation(sc)).first()
    assert r.monthly_expected_loss == 0.33333 * -7.77 and r.action == "no_offer" and r.roi_pct is None


def test_score_customers_rounding_and_loss(spark):
    scores = spark.createDataFrame([("a", 0.123449), ("b", 0.87655)], "customer_id string, proba double")
    gold = spark.createDataFrame([("a", 1, 100.0, 1200.0, "SME"), ("b", 0, -10.0, -120.0, None)],
                                 "customer_id string, churn int, avg_monthly_margin double, "
                                 "total_margin_2024 double, segment string")
    out = {r.customer_id: r for r in M.score_customers(scores, gold, 0.5).collect()}
    assert out["a"].churn_proba == 0.1234 and out["a"].expected_monthly_loss == 12.34
    assert out["b"].churn_pred == 1 and out["b"].expected_monthly_loss == 0.0     # negative margin clipped


def test_stratified_split_is_exact_and_stable(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("customer_id"),
                                  (F.col("id") % 10 == 0).cast("int").alias("churn"))
    s1 = M.stratified_split(df, "churn", 0.2, 42)
    counts = {(r.churn, r.is_test): r["count"] for r in s1.groupBy("churn", "is_test").count().collect()}
    assert counts[(1, True)] == 20 and counts[(0, True)] == 180
    s2 = M.stratified_split(df.repartition(7), "churn", 0.2, 42)
    a = {r.customer_id for r in s1.filter("is_test").collect()}
    b = {r.customer_id for r in s2.filter("is_test").collect()}
    assert a == b


def test_model_matrix_fills(spark):
    gold = spark.createDataFrame([("a", 1, None, None, None, None)],
                                 "customer_id string, churn int, last_interaction_days_ago int, "
                                 "customer_intent string, is_dual_fuel int, months_to_renewal double")
    mm = M.model_matrix(gold, ["last_interaction_days_ago", "customer_intent", "is_dual_fuel",
                               "months_to_renewal", "not_there"]).first()
    assert mm.last_interaction_days_ago == 9999 and mm.customer_intent == "no_interaction"
    assert mm.is_dual_fuel == 0 and mm.months_to_renewal == 0.0     # legacy suffix rule


def test_fit_predict_and_save_load(spark, tmp_path):
    rows = [(str(i), int(i % 4 == 0), float(i % 4 == 0) * 3 + (i % 7) * 0.1, "x" if i % 2 else "y")
            for i in range(200)]
    df = spark.createDataFrame(rows, "customer_id string, churn int, f double, c string")
    model = M.fit(df, ["f", "c"], "logistic_regression")
    p = M.predict_proba(model, df, ["f", "c"])
    r = M.evaluate(p, 0.5).first()
    assert r.roc_auc > 0.9
    M.save_model(model, str(tmp_path / "m"), {"threshold": 0.5})
    m2, meta = M.load_model(str(tmp_path / "m"))
    p2 = M.predict_proba(m2, df, ["f", "c"])
    a = {x.customer_id: x.proba for x in p.collect()}
    b = {x.customer_id: x.proba for x in p2.collect()}
    assert meta["threshold"] == 0.5 and all(abs(a[k] - b[k]) < 1e-12 for k in a)


def test_registered_boosting_is_the_library_default(spark, monkeypatch):
    import registry
    from voltchurn.plans import model

    seen = {}

    class Stop(Exception):
        pass

    class Trees:
        def __init__(self, **params):
            seen.update(params)
            raise Stop

    monkeypatch.setattr(model, "GBTClassifier", Trees)
    monkeypatch.setattr(registry, "_train_test", lambda *a: (None, None, spark.createDataFrame(
        [(i, i % 2, float(i), i % 5 == 0) for i in range(40)], "customer_id long, churn int, x double, is_test boolean"), ["x"]))
    monkeypatch.setattr(registry.FT, "tree_feature_list", lambda feats: feats)
    try:
        registry.q_model_gbt(spark, "")
    except Stop:
        pass
    assert (seen["maxIter"], seen["maxDepth"], seen["stepSize"]) == (600, 3, 0.02)

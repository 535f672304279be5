import datetime as dt

from voltchurn.plans import gold

AS_OF = "2025-01-01"


def _sc(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, contract_start_date date, next_renewal_date date, "
                                       "sales_channel string, customer_intent string, date date, churn int")


def test_bins_edges_and_flags(spark):
    d = dt.date
    rows = [("exp", d(2020, 1, 1), d(2025, 1, 1), "Own Website", "Complaint / Escalation", d(2024, 12, 1), 1),
            ("m3", d(2024, 7, 1), d(2025, 4, 2), None, None, None, 0),
            ("zero", d(2025, 1, 1), d(2025, 7, 3), "Office", "Pricing Offers", d(2025, 6, 1), 0),
            ("neg", d(2025, 2, 1), None, "Office", "Cancellation / Switch ", None, 0)]
    out = {r.customer_id: r for r in gold.customer_features(_sc(spark, rows), AS_OF).collect()}
    assert out["exp"].months_to_renewal == 0.0 and out["exp"].renewal_bucket == "expired"
    assert out["exp"].is_within_3m_of_renewal == 1 and out["exp"].is_expired_contract == 1
    assert out["m3"].months_to_renewal == 3.0 and out["m3"].renewal_bucket == "0-3m"   # right-closed
    assert out["zero"].tenure_months == 0.0 and out["zero"].tenure_bucket is None       # tenure 0 -> no bin
    assert out["neg"].tenure_bucket is None and out["neg"].renewal_bucket is None
    assert out["neg"].is_within_3m_of_renewal == 0                                      # NULL -> 999 -> 0
    assert out["m3"].is_comparison_channel is None                                      # NULL stays NULL
    assert out["exp"].is_own_website_channel == 1
    assert out["neg"].is_cancellation_intent == 1                                       # trimmed
    assert out["m3"].recent_complaint_flag == 0 and out["m3"].intent_severity_score == 0
    assert out["zero"].intent_severity_score == 1
    assert out["exp"].last_interaction_days_ago == 31
    assert out["exp"].interaction_within_3m_of_renewal == 1
    assert out["exp"].complaint_near_renewal == 1


def test_monthly_features(spark):
    rows = [("a", "2024-01", 10.0, 0.0, 5.0, 0.10, 1.0, 100.0, 0.0),
            ("a", "2024-02", 20.0, 1.0, -2.0, 0.10, 1.0, 100.0, 10.0),
            ("a", "2024-03", 30.0, 0.0, 8.0, 0.15, 1.2, 100.0, 0.0),
            ("b", "2024-01", 5.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0)]
    scm = spark.createDataFrame(rows, "customer_id string, month string, monthly_elec_kwh double, "
                                      "monthly_gas_m3 double, total_margin double, "
                                      "variable_price_tier1_eur_kwh double, elec_var_cost_eur_kwh double, "
                                      "total_revenue double, gas_revenue_variable double")
    out = {r.customer_id: r for r in gold.monthly_features(scm).collect()}
    a, b = out["a"], out["b"]
    assert a.total_elec_kwh_2024 == 60.0 and a.active_months_count == 3
    assert a.max_negative_margin == 1 and a.min_monthly_margin == -2.0
    assert a.price_update_count == 1
    assert abs(a.elec_price_trend_12m - 0.5) < 1e-12 and a.is_price_increase == 1
    assert abs(a.gas_share_of_revenue - 10.0 / 300.0) < 1e-12
    assert a.rolling_margin_trend == 0.0          # fewer than 4 months: prior window falls back to last 3
    assert b.std_monthly_elec_kwh is None         # sample std of one month
    assert b.elec_price_trend_12m == 0.0          # first price 0 -> no trend
    assert b.gas_share_of_revenue == 0.0
    assert a._dual_both == 1 and b._dual_both == 0


def test_gold_end_to_end_invariants(spark):
    from tests.conftest import SF
    from voltchurn.plans import pipeline
    from voltchurn.sources import standins as si

    raw = si.raw_tables(spark, SF)
    L = pipeline.layers(raw, "2001-06-30")
    g = L["gold_master"]
    n_label = raw["churn"].count()
    assert g.count() == n_label == g.select("customer_id").distinct().count()
    assert L["silver_customer_month"].count() == L["bronze_customer_month"].count()
    assert len([c for c in g.columns if c.endswith(("_x_renewal_bucket", "_x_sentiment", "_x_tenure_bucket",
                                                     "_x_intent"))]) >= 8
    # label preserved
    lab = {r.customer_id: r.churn for r in raw["churn"].collect()}
    assert all(lab[r.customer_id] == r.churn for r in g.select("customer_id", "churn").collect())

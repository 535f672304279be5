"""Experiment ladder, feature importance, model versions, completed runs, baselines, the whole pipeline."""

import datetime as dt
import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from voltchurn.plans import model as M
from voltchurn.plans import pipeline
from voltchurn.plans import reports as RP


@pytest.fixture(scope="module")
def customers(spark):
    rows = [(str(i), int(i % 4 == 0), float(i % 4 == 0) * 2 + (i % 5) * 0.3, float(i % 3), "web" if i % 2 else None, f"x{i % 2}")
            for i in range(240)]
    df = spark.createDataFrame(rows, "customer_id string, churn int, strong double, noise double, channel string, intent_x_sentiment string")
    return M.cut_lineage(M.stratified_split(df, "churn", 0.25))


def test_ladder_is_sorted_by_average_precision(customers):
    train, test = customers.filter(~F.col("is_test")), customers.filter("is_test")
    got = M.experiment_ladder(train, test, {"weak": ["noise", "intent_x_sentiment"], "full": ["noise", "strong", "intent_x_sentiment"]},
                              ["logistic_regression", "random_forest"]).collect()
    assert len(got) == 4 and {(r.experiment, r.model) for r in got} == {(e, m) for e in ("weak", "full") for m in ("logistic_regression", "random_forest")}
    assert [r.pr_auc for r in got] == sorted((r.pr_auc for r in got), reverse=True)
    assert got[0].experiment == "full" and got[0].pr_auc > 0.9
    assert all(r.tp + r.fp + r.fn + r.tn == test.count() for r in got)


def test_importance_names_the_encoded_inputs(customers):
    train, feats = customers.filter(~F.col("is_test")), ["noise", "strong", "channel"]
    for name in ("logistic_regression", "random_forest"):
        got = M.feature_importance(M.fit(train, feats, name, **({"numTrees": 5} if name == "random_forest" else {})), train, feats).collect()
        assert got[0].feature.startswith("num_") and got[0].feature.endswith("1") or "strong" in got[0].feature
        assert any("missing" in r.feature for r in got)                      # the level that stands for NULL
        assert [r.importance for r in got] == sorted((r.importance for r in got), reverse=True)
    assert len(M.feature_importance(M.fit(train, feats, "logistic_regression"), train, feats, top=2).collect()) == 2


def test_newest_and_champion_versions(spark):
    v = spark.createDataFrame([(k, dt.datetime(2024, 1, 1 + k // 2), "Approved" if k in (2, 3, 5) else "Rejected") for k in range(12)],
                              "version int, created_at timestamp, status string")
    assert [r.version for r in M.newest_versions(v).collect()] == list(range(11, 1, -1))
    assert [r.version for r in M.newest_versions(v, 3).collect()] == [11, 10, 9]
    assert M.champion(v).first().version == 5
    assert M.champion(v.where("status <> 'Approved'")).count() == 0


def test_kpis_count_completed_runs(spark):
    scored = spark.createDataFrame([("Critical (>80%)", 10.0), ("High (60-80%)", 5.0), ("Low (<40%)", 0.0)],
                                   "risk_tier string, expected_monthly_loss double")
    runs = spark.createDataFrame([("COMPLETED",), ("FAILED",), ("COMPLETED",), (None,)], "status string")
    got = RP.kpis(scored, runs).first()
    assert (got.scored_customers, got.critical, got.high, got.completed_runs) == (3, 1, 1, 2)
    assert got.total_expected_monthly_loss == 15.0


def test_baseline_draw_follows_the_prior_and_not_the_partitions(spark):
    df = spark.range(4000).select(F.col("id").cast("string").alias("customer_id"), (F.col("id") % 5 == 0).cast("int").alias("churn"))
    a = {r.customer_id: r.proba for r in M.baseline_scores(df, df, "stratified").collect()}
    b = {r.customer_id: r.proba for r in M.baseline_scores(df.repartition(7), df, "stratified").collect()}
    assert a == b and abs(sum(a.values()) / len(a) - 0.2) < 0.03
    assert {r.proba for r in M.baseline_scores(df, df).collect()} == {0.0}


def test_whole_pipeline_from_raw_files(spark, tmp_path):
    raw, n = tmp_path / "raw", 80
    raw.mkdir()

    def csv(name, head, lines):
        (raw / name).write_text(head + "\n" + "".join(line + "\n" for line in lines))

    csv("churn_label.csv", "customer_id,churn", [f"c{i},{int(i % 4 == 0)}" for i in range(n)])
    csv("customer_attributes.csv", "customer_id,province_code,is_industrial,contracted_power_kw,is_second_residence,sales_channel,"
        "is_high_competition_province,customer_first_activation_date,next_renewal_date",
        [f"c{i},{i % 3},{i % 2},{10 if i % 2 else 3.5},{i % 5 == 0:d},comparador,{i % 4 == 0:d},2020-01-01,2025-0{1 + i % 9}-01" for i in range(n)])
    csv("customer_contracts.csv", "customer_id,contract_start_date,next_renewal_date,last_product_change_date",
        [f"c{i},20{15 + i % 8}-01-01,2025-0{1 + i % 9}-01,2024-06-01" for i in range(n)])
    csv("price_history.csv", "customer_id,pricing_date,variable_price_tier1_eur_kwh,variable_price_tier2_eur_kwh,variable_price_tier3_eur_kwh,"
        "gas_variable_price_eur_m3,elec_fixed_fee_eur_month,gas_fixed_revenue_eur_year",
        [f"c{i},2024-0{m}-01,0.{2 + i % 4},0.2,0.1,{'' if i % 6 == 0 else 0.8},3,36" for i in range(n) for m in (1, 2)])
    csv("costs_by_province_month.csv", "province,month,elec_var_cost_eur_kwh,peaje_elec_eur_kwh,elec_fixed_cost_eur_month,"
        "gas_var_cost_eur_m3,gas_fixed_cost_eur_year", [f"{p},2024-0{m}-01,0.05,0.01,1,0.3,12" for p in range(3) for m in (1, 2)])
    csv("consumption_hourly_2024.csv", "customer_id,timestamp,consumption_elec_kwh,consumption_gas_m3",
        [f"c{i},2024-0{m}-0{d} {h:02d}:00:00,{1 + (i * 7 + h) % 5},{i % 3 * 0.1}" for i in range(n) for m in (1, 2) for d in (2, 6) for h in (3, 12)])
    (raw / "customer_interactions.json").write_text(json.dumps(
        [{"customer_id": f"c{i}", "date": f"2024-0{1 + i % 9}-10", "interaction_summary": "I want to cancel" if i % 4 == 0 else "thank you, great",
          "channel": "phone"} for i in range(0, n, 2)]))
    got = pipeline.run_local_pipeline(spark, str(raw), str(tmp_path / "out"), "2024-12-31", "logistic_regression")
    assert 0.0 <= got["metrics"]["roc_auc"] <= 1.0
    scored = spark.read.parquet(got["scored_path"])
    assert scored.count() == scored.select("customer_id").distinct().count() == n
    for layer in ("bronze/bronze_customer", "silver/silver_customer", "gold/gold_master", "scored/recommendations"):
        assert spark.read.parquet(str(tmp_path / "out" / layer)).count() == n
    assert spark.read.parquet(str(tmp_path / "out/bronze/bronze_customer_month")).count() == 2 * n


def test_forests_score_after_a_metric_was_observed(spark, customers):
    seen = Observation()
    customers.observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == 240
    model = M.fit(customers, ["noise", "strong"], "random_forest", numTrees=5)
    assert not model.stages[-1].hasSummary
    assert M.predict_proba(model, customers, ["noise", "strong"]).filter("proba > 0.5").count() > 0

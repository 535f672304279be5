import datetime as dt

import pandas as pd
from pyspark.sql import functions as F


def test_model_sentiment_hook_runs_in_arrow_batches(spark):
    from voltchurn.plans import enrich

    def scorer(texts: pd.Series) -> pd.DataFrame:
        neg = texts.str.contains("bad").astype(float)
        return pd.DataFrame({"negative": neg, "neutral": 1 - neg, "positive": 0.0 * neg})

    df = spark.createDataFrame([("a", "bad service"), ("b", "fine"), ("c", "   "), ("d", None)],
                               "customer_id string, interaction_summary string")
    out = {r.customer_id: r for r in enrich.model_sentiment(df, scorer).collect()}
    assert out["a"].sentiment_label == "negative" and out["b"].sentiment_label == "neutral"
    assert out["c"].sentiment_neg is None and out["d"].sentiment_label is None


def test_intent_priority_and_null_text(spark):
    from voltchurn.functions.text import classify_intent

    df = spark.createDataFrame([("I want to cancel because the bill is high",), ("Billing question",),
                                ("ACCOUNT was checked, no issues found",), ("nothing here",), (None,),
                                ("plans\\nfor later",)], "t string")
    got = [r.i for r in df.select(classify_intent("t").alias("i")).collect()]
    assert got == ["Cancellation / Switch", "Billing / Payment", "Account / Service Inquiry",
                   "Other / Unclassified", "Other / Unclassified", "Plan / Product Inquiry"]


def test_run_status_and_champion(spark):
    from voltchurn.plans import model as M
    from voltchurn.plans import reports as RP

    runs = spark.createDataFrame([("r1", "COMPLETED"), ("r2", "FAILED"), ("r3", "COMPLETED")],
                                 "run_id string, status string")
    assert {r.status: r.runs for r in RP.run_status_counts(runs).collect()} == {"COMPLETED": 2, "FAILED": 1}
    versions = spark.createDataFrame([(1, "Approved", dt.datetime(2024, 1, 1)), (2, "Rejected", dt.datetime(2024, 2, 1)),
                                      (3, "Approved", dt.datetime(2024, 3, 1))],
                                     "version int, status string, created_at timestamp")
    assert M.champion(versions).first().version == 3


def test_calendar_trend_and_gas_share_variants(spark):
    from voltchurn.plans import variants as VR

    scm = spark.createDataFrame([("a", "2024-07", 10.0, 1.0, 0.0, 100.0), ("a", "2024-10", 30.0, 0.0, 12.0, 100.0),
                                 ("a", "2025-02", 99.0, 0.0, 0.0, 0.0), ("b", "2024-11", 5.0, 0.0, 0.0, 0.0)],
                                "customer_id string, month string, total_margin double, gas_revenue_variable double, "
                                "gas_revenue_fixed double, total_revenue double")
    t = {r.customer_id: r.rolling_margin_trend for r in VR.calendar_margin_trend(scm, "2024-12-31").collect()}
    assert t["a"] == 20.0 and t["b"] is None          # prior window empty for b -> NULL
    g = {r.customer_id: r.gas_share_of_revenue for r in VR.gas_share_with_fixed(scm).collect()}
    assert abs(g["a"] - 2.0 / 200.0) < 1e-12 and g["b"] is None
    assert F is not None

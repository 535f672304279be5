"""Leakage audit, expected counts and the other threshold rules on literal rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from voltchurn.operators import stats as S
from voltchurn.plans import quality as Q

RENEWAL = dt.date(2024, 6, 30)
SCHEMA = ("customer_id string, churn int, has_interaction int, date date, next_renewal_date date, sentiment_label string, "
          "sentiment_neg double, sentiment_neu double, sentiment_pos double, interaction_summary string")


@pytest.fixture(scope="module")
def tagged(spark):
    def row(name, days, label, churn=1, interaction=1):
        return (name, churn, interaction, None if days is None else RENEWAL - dt.timedelta(days), RENEWAL, label, 0.8, 0.1, 0.1, "text")

    rows = [row("after", -3, "negative"), row("same", 0, "negative"), row("day", 1, "negative"), row("two", 2, "negative"),
            row("week", 7, "positive", 0), row("month", 30, "negative", 0), row("undated", None, "negative"), row("silent", None, None, 0, 0),
            row("odd", None, "neutral", 0, 0), row("stayed", -1, "negative", 0), row("unscored", 3, None)]
    return Q.tag_leakage(spark.createDataFrame(rows, SCHEMA))


def test_rows_are_tagged(tagged):
    got = {r.customer_id: (r.days_to_renewal, r.scope, r.violations) for r in tagged.collect()}
    assert got["after"] == (-3, ["all"], ["after_renewal"])
    assert got["same"] == (0, ["all", "before"], ["within_1_day"])
    assert got["week"] == (7, ["all", "before", "safe_7d"], [])
    assert got["month"] == (30, ["all", "before", "safe_7d", "safe_30d"], [])
    assert got["undated"] == (None, ["all"], ["sentiment_without_dates"])
    assert got["odd"][2] == ["sentiment_without_interaction", "sentiment_without_dates"] and got["silent"][2] == []


def test_reports(tagged):
    assert {r.customer_id for r in Q.leakage_suspicious(tagged).collect()} == {"after", "same", "day"}
    timing = {r.sentiment_label: (r.customers, r.pct_after_renewal, r.median_days_to_renewal) for r in Q.leakage_sentiment_timing(tagged).collect()}
    assert timing == {"negative": (6, pytest.approx(2 / 6), 0.5), "positive": (1, 0.0, 7.0)}
    scope = {(r.scope, r.sentiment_label): (r.customers, r.churn_rate) for r in Q.leakage_churn_by_scope(tagged).collect()}
    assert scope["all", "negative"] == (7, pytest.approx(5 / 7)) and scope["before", "negative"] == (4, 0.75)
    assert scope["safe_7d", "positive"] == (1, 0.0) and scope["safe_30d", "negative"] == (1, 0.0) and ("safe_30d", "positive") not in scope
    assert {r.violation: r.customers for r in Q.leakage_violations(tagged).collect()} == {
        "after_renewal": 2, "within_1_day": 2, "sentiment_without_interaction": 1, "sentiment_without_dates": 2}
    assert {r.metric: r.rows for r in Q.leakage_summary(tagged).collect()} == {
        "rows_total": 11, "rows_has_sentiment": 9, "rows_has_sentiment_and_dates": 7, "rows_sentiment_after_renewal": 2,
        "rows_sentiment_pre_renewal": 5, "rows_sentiment_safe_7d": 2, "rows_sentiment_safe_30d": 1}


def test_expected_counts_cover_unseen_pairs(spark):
    df = spark.createDataFrame([("a", "x")] * 6 + [("b", "y")] * 2 + [("b", "x")] * 2 + [(None, "x")], "a string, b string")
    got = {(r.a, r.b): (r.observed, r.expected) for r in S.expected_counts(df, "a", "b").collect()}
    assert got == {("a", "x"): (6, 4.8), ("a", "y"): (0, 1.2), ("b", "x"): (2, 3.2), ("b", "y"): (2, 0.8)}


def test_threshold_rules(spark):
    # by falling score: recall 1/4, 1/4, 2/4, 3/4, 3/4, 4/4
    rows = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.7, 1), (0.6, 1), (0.5, 0), (0.4, 1), (0.3, 0)], "s double, y int")
    pick = lambda mode, target=0.7: S.pick_threshold_by(rows, "y", "s", mode, target).first()[0]
    assert pick("recall") == 0.6 and pick("recall", 0.5) == 0.7 and pick("recall", 1.0) == 0.4
    assert pick("f1") == 0.4                       # 2 * (4/6) / (4/6 + 1) = 0.8 beats 0.75 at 0.6
    assert pick("recall", 1.1) == 0.4 and pick("recall_or_half", 1.1) == 0.5 and pick("recall_or_half") == 0.6
    with pytest.raises(ValueError):
        S.pick_threshold_by(rows, "y", "s", "best")
    none = rows.withColumn("y", F.lit(0))
    assert S.pick_threshold_by(none, "y", "s", "recall_or_half").first()[0] == 0.5

"""Analytical reports.

Each report is a small aggregate of the gold / silver / scored tables built
from the generic operators (``rate_by``, ``describe``, ``crosstab``, ...).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltchurn.constants import KEY
from voltchurn.functions.exprs import cut, days_between, month_start, safe_div
from voltchurn.operators.stats import (
    with_group_quantiles,
    attach_scalar,
    chi_square,
    crosstab,
    describe,
    rate_by,
    total_of,
    value_counts,
    with_quantile_bins,
)

INTERACTION_DAY_EDGES = (0.0, 30.0, 90.0, 180.0, 365.0, float("inf"))
INTERACTION_DAY_LABELS = ("0-30d", "30-90d", "90-180d", "180-365d", "365d+")


def churn_by(gold: DataFrame, dims: Sequence[str], min_group: int = 0, pct: bool = False) -> DataFrame:
    """Customers and churn rate per group."""
    return rate_by(gold, dims, "churn", min_group=min_group, pct=pct)


def margin_by(gold: DataFrame, by: Sequence[str]) -> DataFrame:
    """Distribution of average monthly margin per group (describe)."""
    return describe(gold, "avg_monthly_margin", by)


def channel_profile(gold: DataFrame) -> DataFrame:
    """Per acquisition channel: customers, churn rate, median tenure, median margin, median volatility."""
    return rate_by(gold, ["sales_channel"], medians={
        "median_tenure": "tenure_months", "median_margin": "avg_monthly_margin", "median_margin_volatility": "std_margin"})


def competition_profile(gold: DataFrame) -> DataFrame:
    """E8 + F23: competition split: medians of margins and profit at risk
    (median margin x churn rate x customers)."""
    out = rate_by(gold, ["is_high_competition_province"], medians={
        "median_margin": "avg_monthly_margin", "median_total_margin": "total_margin_2024", "median_elec_kwh": "avg_monthly_elec_kwh"})
    return out.withColumn("profit_at_risk", F.col("median_margin") * F.col("churn_rate") * F.col("customers"))


def renewal_timing(gold: DataFrame) -> DataFrame:
    """Distribution of months to renewal by churn label (describe)."""
    return describe(gold, "months_to_renewal", ["churn"])


def churn_pivot(gold: DataFrame, rows: str, cols: str, values: Sequence[str] | None = None) -> DataFrame:
    """Churn rate matrix (rows x cols); empty cells are NULL."""
    src = gold.filter(F.col(rows).isNotNull() & F.col(cols).isNotNull())
    return src.groupBy(rows).pivot(cols, list(values) if values else None).agg(
        F.avg(F.col("churn").cast("double")))


def expired_prevalence(gold: DataFrame) -> DataFrame:
    """Customers and churn rate with vs without an expired contract."""
    return rate_by(gold, ["is_expired_contract"], extra={})


def interaction_quintiles(gold: DataFrame) -> DataFrame:
    """E10 + W9: churn and interaction presence per renewal-distance quintile."""
    b = with_quantile_bins(gold, "months_to_renewal", 5, "renewal_quintile")
    return rate_by(b, ["renewal_quintile"], extra={
        "interaction_rate": F.avg(F.coalesce(F.col("has_interaction"), F.lit(0)).cast("double"))})


def interaction_timing(sc: DataFrame) -> DataFrame:
    """Churn by days from the (latest) interaction to renewal, 5 left-closed buckets."""
    d = days_between(F.col("next_renewal_date"), F.col("date"))
    src = sc.withColumn("_days", d).filter((F.col("has_interaction") == 1) & F.col("_days").isNotNull()
                                           & (F.col("_days") >= 0))
    b = src.withColumn("days_bucket", cut("_days", INTERACTION_DAY_EDGES, INTERACTION_DAY_LABELS, right=False))
    return rate_by(b, ["days_bucket"])


def pre_renewal_trend(scm: DataFrame, sc: DataFrame, measure: str = "total_margin",
                      days_per_month: float = 30.0) -> DataFrame:
    """W8 + J15: per customer, mean of ``measure`` 0-3 months before renewal minus 3-6 months before.

    Months are placed by (renewal - month start) / 30 days; (0, 3] is the near
    window, (3, 6] the earlier one; both must be present.
    """
    j = scm.select(KEY, "month", measure).join(sc.select(KEY, "next_renewal_date", "churn"), KEY)
    m = days_between(F.col("next_renewal_date"), month_start("month")) / days_per_month
    j = j.withColumn("_m", m).filter(F.col("_m").between(0, 6))
    j = j.withColumn("_w", cut("_m", (0.0, 3.0, 6.0), ("0_3m", "3_6m")))
    g = j.groupBy(KEY, "churn").agg(F.avg(F.when(F.col("_w") == "0_3m", F.col(measure))).alias("near"),
                                    F.avg(F.when(F.col("_w") == "3_6m", F.col(measure))).alias("earlier"))
    g = g.filter(F.col("near").isNotNull() & F.col("earlier").isNotNull())
    return g.withColumns({"trend": F.col("near") - F.col("earlier"),
                          "pct_change": (F.col("near") - F.col("earlier")) / (F.col("earlier") + 1e-6)})


def pre_renewal_by_churn(scm: DataFrame, sc: DataFrame, measure: str = "total_margin") -> DataFrame:
    """Describe of the pre-renewal trend by churn label."""
    return describe(pre_renewal_trend(scm, sc, measure), "trend", ["churn"])


def volatility_by_churn(scm: DataFrame, sc: DataFrame) -> DataFrame:
    """Per-customer std of monthly margin and bill, then described by churn (two-level groupBy)."""
    per = scm.groupBy(KEY).agg(F.stddev_samp("total_margin").alias("margin_std"),
                               F.stddev_samp("total_revenue").alias("bill_std"))
    return describe(per.join(sc.select(KEY, "churn"), KEY), "margin_std", ["churn"])


def intent_chi_square(gold: DataFrame) -> DataFrame:
    """E13 + A20: independence of intent and churn."""
    return chi_square(gold, "customer_intent", "churn")


def kpis(scored: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """Scored customers, critical, high, at-risk share, total expected loss (+ completed runs)."""
    one = scored.agg(
        F.count(F.lit(1)).alias("scored_customers"),
        F.count_if(F.col("risk_tier") == "Critical (>80%)").alias("critical"),
        F.count_if(F.col("risk_tier") == "High (60-80%)").alias("high"),
        F.coalesce(F.sum("expected_monthly_loss"), F.lit(0.0)).alias("total_expected_monthly_loss"))
    one = one.withColumn("at_risk_pct", F.bround(safe_div(
        (F.col("critical") + F.col("high")) * 100.0, F.col("scored_customers")), 1))
    if runs is not None:
        one = attach_scalar(one, runs.agg(F.count_if(F.col("status") == "COMPLETED").alias("completed_runs")))
    return one


def tier_counts(scored: DataFrame) -> DataFrame:
    """Customers per risk tier."""
    return value_counts(scored, "risk_tier", normalize=True, count_name="customers")


def top_risk(scored: DataFrame, n: int = 50, tier: str = "All", segment: str = "All") -> DataFrame:
    """E18 + P14 + T3: faceted top-N by probability (ties by customer id)."""
    df = scored
    if tier != "All":
        df = df.filter(F.col("risk_tier") == tier)
    if segment != "All":
        df = df.filter(F.col("segment") == segment)
    return df.orderBy(F.desc("churn_proba"), KEY).limit(n)


def facet_values(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct values of a facet."""
    return df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col)


def segment_share(gold: DataFrame) -> DataFrame:
    """Segment share in percent (1 dp)."""
    vc = value_counts(gold, "segment", normalize=True, count_name="customers")
    return vc.withColumn("share_pct", F.bround(F.col("share") * 100, 1)).drop("share")


def churn_pct_by(gold: DataFrame, dim: str) -> DataFrame:
    """Churn % by one dimension, 1 dp."""
    return rate_by(gold, [dim]).withColumn("churn_pct", F.bround(F.col("churn_rate") * 100, 1)).drop("churn_rate")


def margin_box(gold: DataFrame, by: str = "churn") -> DataFrame:
    """Five-number summary of average monthly margin per group."""
    rows = gold.filter(F.col(by).isNotNull())
    ends = rows.groupBy(by).agg(F.min("avg_monthly_margin").alias("min"), F.max("avg_monthly_margin").alias("max"))
    return with_group_quantiles(ends, rows, [by], {"_q": F.col("avg_monthly_margin")}, [0.25, 0.5, 0.75]).select(
        by, "min", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3"), "max")


def worst_months(scm: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` lowest-margin customer-months."""
    return scm.select(KEY, "month", "total_margin").orderBy("total_margin", KEY, "month").limit(n)


def worst_segment_months(scm: DataFrame, sc: DataFrame, segment: str = "Corporate", n: int = 12) -> DataFrame:
    """The ``n`` months with the lowest total margin of one segment."""
    own = scm.join(sc.filter(F.col("segment") == segment).select(KEY), KEY)
    return own.groupBy("month").agg(F.sum("total_margin").alias("total_margin")).orderBy("total_margin", "month").limit(n)


def flagged_ends(scored: DataFrame, n: int = 10, tail: bool = False) -> DataFrame:
    """T4: the ``n`` flagged customers with the most (``tail``: the least) expected loss."""
    loss = F.col("expected_monthly_loss")
    order = [loss.asc_nulls_first(), F.desc(KEY)] if tail else [loss.desc_nulls_last(), F.asc(KEY)]
    return scored.filter(F.col("churn_pred") == 1).select(KEY, "churn_proba", "expected_monthly_loss", "segment").orderBy(*order).limit(n)


def extreme_texts(sc: DataFrame, by: str = "sentiment_neg", n: int = 50) -> DataFrame:
    """T5: the ``n`` labelled interactions with the highest ``by`` score (ties by customer)."""
    cols = [KEY, "interaction_summary", "sentiment_label", "sentiment_neg", "sentiment_neu", "sentiment_pos"]
    return sc.filter(F.col("sentiment_label").isNotNull()).select(*cols).orderBy(F.desc(by), KEY).limit(n)


def margin_per_kwh(scm: DataFrame, sc: DataFrame, segment: str = "Corporate") -> DataFrame:
    """F22 + J10 + P16: margin per kWh of one segment's months that used electricity."""
    j = scm.join(sc.select(KEY, "segment"), KEY).filter(
        (F.col("segment") == segment) & (F.col("monthly_elec_kwh") > 0))
    return j.select(KEY, "month", F.try_divide(F.col("elec_margin"), F.col("monthly_elec_kwh"))
                    .alias("elec_margin_per_kwh"))


def presence_flag(customers: DataFrame, events: DataFrame, name: str = "has_event") -> DataFrame:
    """0/1 flag -- does the customer's key appear in the event table."""
    keys = events.select(KEY).distinct().withColumn(name, F.lit(1))
    return customers.join(keys, KEY, "left").withColumn(name, F.coalesce(F.col(name), F.lit(0)))


def share_positive(df: DataFrame, col: str) -> DataFrame:
    """share of rows with ``col`` > 0."""
    return df.agg(F.avg((F.col(col) > 0).cast("double")).alias(f"share_{col}_positive"))


def seeded_sample(df: DataFrame, n: int, seed: int = 42, key: str = KEY) -> DataFrame:
    """Repeatable sample of up to ``n`` rows, by hash order of the key."""
    return df.orderBy(F.xxhash64(F.col(key).cast("string"), F.lit(seed)), key).limit(n)


def unclassified_with_interaction(sc: DataFrame) -> DataFrame:
    """Customers with an interaction whose intent stayed unclassified."""
    return sc.filter((F.col("has_interaction") == 1) & (F.col("customer_intent") == "Other / Unclassified"))


def leakage_flags(sc: DataFrame) -> DataFrame:
    """Q13: share of interactions after the renewal date, churn by that flag."""
    d = days_between(F.col("date"), F.col("next_renewal_date"))
    src = sc.filter(F.col("has_interaction") == 1).withColumn("after_renewal", (d > 0).cast("int"))
    return rate_by(src, ["after_renewal"])


def total_margin_by(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """T6 (second form): summed margin per group, lowest first."""
    return df.groupBy(*by).agg(F.sum("total_margin").alias("total_margin")).orderBy("total_margin", *by)


def crosstab_report(gold: DataFrame, a: str, b: str) -> DataFrame:
    """A19 as a report."""
    return crosstab(gold, a, b)


def count_all(df: DataFrame) -> DataFrame:
    return total_of(df, "rows")


def churn_within_days_proxy(sc: DataFrame) -> DataFrame:
    """Per sentiment label, customers whose (dated) interaction fell 0-7 / 0-30 days before
    renewal and who churned, as counts and as shares of that label's churners."""
    d = days_between(F.col("next_renewal_date"), F.col("date"))
    src = sc.filter(F.col("sentiment_label").isNotNull() & F.col("date").isNotNull()
                    & F.col("next_renewal_date").isNotNull()).withColumn("_d", d)
    churned = F.col("churn") == 1
    w7 = (F.col("_d") >= 0) & (F.col("_d") <= 7) & churned
    w30 = (F.col("_d") >= 0) & (F.col("_d") <= 30) & churned
    g = src.groupBy("sentiment_label").agg(
        F.count(F.lit(1)).alias("customers_with_dates"), F.count_if(churned).alias("churners"),
        F.count_if(w7).alias("churn_within_7d_count"), F.count_if(w30).alias("churn_within_30d_count"))
    return g.withColumns({
        "churn_within_7d_pct_of_churners": F.try_divide(F.col("churn_within_7d_count").cast("double"),
                                                        F.col("churners")),
        "churn_within_30d_pct_of_churners": F.try_divide(F.col("churn_within_30d_count").cast("double"),
                                                         F.col("churners"))})


def customer_360(financials: DataFrame, customer_id: str) -> DataFrame:
    """E23 + P13: score, recommendation and financials of one customer (a point lookup).

    ``financials``: scored rows from ``recommend.customer_financials``; the key
    filter reaches the scans, nothing is joined.
    """
    return financials.filter(F.col(KEY) == customer_id).withColumn("reason_codes", F.array_join("reason_codes", "|"))


def run_status_counts(runs: DataFrame) -> DataFrame:
    """Pipeline runs per status."""
    return runs.groupBy("status").agg(F.count(F.lit(1)).alias("runs"))

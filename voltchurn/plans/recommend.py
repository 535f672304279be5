"""Retention recommendations (R1-R8): one projection over the scored table.

The reference loops over rows in Python; here the policy is column
expressions, the reason codes an array built by ``array_compact``, and the
contract checks a filter that fails the job when any row breaks them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltchurn.constants import DEFAULT_ACTION, DEFAULT_TIMING, KEY, OFFER_SHARE, TIER_ACTION, TIER_TIMING
from voltchurn.functions.exprs import clip_lower0, literal_map


def reason_codes(proba: str = "churn_proba", tier: str = "risk_tier", segment: str = "segment") -> Column:
    """Probability band, tier text, segment; ``low_risk_monitoring`` if none."""
    p = F.coalesce(F.col(proba), F.lit(0.0))
    band = (F.when(p >= 0.80, F.lit("critical_churn_risk")).when(p >= 0.60, F.lit("high_churn_risk"))
            .when(p >= 0.40, F.lit("moderate_churn_risk")))
    t = F.coalesce(F.col(tier).cast("string"), F.lit(""))
    tier_code = (F.when(t.contains("Critical"), F.lit("churn_probability_above_80pct"))
                 .when(t.contains("High"), F.lit("churn_probability_above_60pct")))
    seg = F.col(segment).cast("string")
    seg_code = F.when(seg.isNotNull() & (seg != ""), F.concat(F.lit("segment_"), F.lower(seg)))
    codes = F.array_compact(F.array(band, tier_code, seg_code))
    return F.when(F.size(codes) > 0, codes).otherwise(F.array(F.lit("low_risk_monitoring")))


RECO_COLUMNS = (KEY, "risk_score", "segment", "action", "timing_window", "expected_margin_impact", "reason_codes")


def with_recommendation(scored: DataFrame) -> DataFrame:
    """R1 + R2 + R3 + R4 beside the scored columns: action, timing, impact and reasons.

    Unknown tiers get ``no_offer`` / ``60_90_days``; a negative average margin
    forces ``no_offer`` (guardrail).  A NULL tier is read as Low, as the
    reference's default.  ``segment`` becomes ``Unknown`` where it is NULL.
    """
    tier = F.coalesce(F.col("risk_tier").cast("string"), F.lit("Low (<40%)"))
    action = F.coalesce(literal_map(tier, TIER_ACTION), F.lit(DEFAULT_ACTION))
    if "avg_monthly_margin" in scored.columns:
        action = F.when(F.coalesce(F.col("avg_monthly_margin"), F.lit(0.0)) < 0, F.lit("no_offer")).otherwise(action)
    impact = F.coalesce(F.col("expected_monthly_loss"), F.lit(0.0)) if "expected_monthly_loss" in scored.columns \
        else F.lit(0.0)
    seg = F.coalesce(F.col("segment"), F.lit("Unknown")) if "segment" in scored.columns else F.lit("Unknown")
    return scored.withColumns({
        KEY: F.col(KEY).cast("string"),
        "risk_score": F.coalesce(F.col("churn_proba"), F.lit(0.0)),
        "segment": seg,
        "action": action,
        "timing_window": F.coalesce(literal_map(tier, TIER_TIMING), F.lit(DEFAULT_TIMING)),
        "expected_margin_impact": impact,
        "reason_codes": reason_codes(),
    })


def recommendations(scored: DataFrame) -> DataFrame:
    """The recommendation table, one row per scored customer."""
    return with_recommendation(scored).select(*RECO_COLUMNS)


def contract_violations(reco: DataFrame) -> DataFrame:
    """Rows that break the contract (empty reasons, negative impact with an offer, score outside [0, 1])."""
    bad = ((F.size("reason_codes") == 0)
           | ((F.col("expected_margin_impact") < 0) & (F.col("action") != "no_offer"))
           | ~F.col("risk_score").between(0, 1))
    return reco.filter(bad)


def validated(reco: DataFrame) -> DataFrame:
    """R5 as a guard inside the job: any violating row fails it with a clear message."""
    bad = ((F.size("reason_codes") == 0)
           | ((F.col("expected_margin_impact") < 0) & (F.col("action") != "no_offer"))
           | ~F.col("risk_score").between(0, 1))
    return reco.filter(F.when(bad, F.raise_error(F.lit("recommendation violates the policy contract")))
                       .otherwise(F.lit(True)))


def _share() -> Column:
    return F.coalesce(literal_map("action", OFFER_SHARE), F.lit(0.0))


def offer_budget(recommended: DataFrame) -> DataFrame:
    """Offer budget = action share x max(average margin, 0), 2 dp.

    ``recommended``: scored rows from ``with_recommendation``, so the margin is
    at hand and nothing is joined.
    """
    return recommended.withColumn("offer_budget_eur", F.bround(_share() * clip_lower0(F.coalesce(
        F.col("avg_monthly_margin"), F.lit(0.0))), 2))


def customer_financials(recommended: DataFrame) -> DataFrame:
    """What a customer is expected to lose and what the offer saves.

    loss = churn probability x average margin (neither clipped nor rounded),
    cost = action share x average margin, net = loss - cost, per month; ROI =
    net / cost x 100, NULL without a positive cost.
    """
    margin = F.coalesce(F.col("avg_monthly_margin"), F.lit(0.0))
    out = recommended.withColumns({"monthly_expected_loss": F.col("risk_score") * margin, "offer_cost": _share() * margin})
    out = out.withColumns({"annual_expected_loss": F.col("monthly_expected_loss") * 12,
                           "net_saved_monthly": F.col("monthly_expected_loss") - F.col("offer_cost")})
    return out.withColumn("roi_pct", F.when(F.col("offer_cost") > 0, F.col("net_saved_monthly") / F.col("offer_cost") * 100))


def action_counts(reco: DataFrame) -> DataFrame:
    """Customers per action."""
    return reco.groupBy("action").agg(F.count(F.lit(1)).alias("customers"))


def top_actions(reco: DataFrame, n: int = 2) -> DataFrame:
    """The ``n`` most frequent actions (ties by name)."""
    return action_counts(reco).orderBy(F.desc("customers"), "action").limit(n)

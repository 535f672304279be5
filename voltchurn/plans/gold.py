"""Gold layer.

The reference builds five feature tiers with about fifteen group-bys and
merges on the customer key.  Here the monthly tiers (1A fuel flags, MP-core,
MP-risk) are **one** window pass (ordered by month, per customer) feeding
**one** ``groupBy(customer)``; the customer-level tiers (1A lifecycle, 2A,
2B) are projections of the one-row-per-customer silver table; a single left
join puts them together, and tier 3 is a projection on top.  That is one
shuffle of the monthly table and one of the customer table.

``as_of`` is a required date: features never depend on the day the job runs.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltchurn.constants import (
    INTENT_CANCEL,
    INTENT_COMPLAINT,
    INTENT_PRICING,
    INTENT_SEVERITY,
    KEY,
    RENEWAL_EDGES,
    RENEWAL_LABELS,
    TENURE_EDGES,
    TENURE_LABELS,
)
from voltchurn.functions.exprs import (
    cross,
    cut,
    days_between,
    flag,
    in_set_flag,
    literal_map,
    months_between_days,
    safe_div,
)

P1 = "variable_price_tier1_eur_kwh"
GAS_P = "gas_variable_price_eur_m3"
ECOST = "elec_var_cost_eur_kwh"
GCOST = "gas_var_cost_eur_m3"

CROSSES = (
    ("intent_x_renewal_bucket", "customer_intent", "renewal_bucket"),
    ("intent_x_tenure_bucket", "customer_intent", "tenure_bucket"),
    ("sentiment_x_renewal_bucket", "sentiment_label", "renewal_bucket"),
    ("intent_x_sentiment", "customer_intent", "sentiment_label"),
    ("tenure_x_renewal_bucket", "tenure_bucket", "renewal_bucket"),
    ("sales_channel_x_renewal_bucket", "sales_channel", "renewal_bucket"),
    ("has_interaction_x_renewal_bucket", "has_interaction", "renewal_bucket"),
    ("competition_x_intent", "is_high_competition_province", "customer_intent"),
)


def _date(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of.cast("date")
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.isoformat()[:10]
    return F.lit(str(as_of)).cast("date")


def _month_ordinal(month: str = "month") -> Column:
    """``yyyy-MM`` -> year * 12 + month as an integer: a fixed-width ordering key, so
    ``min_by`` / ``max_by`` stay in the hash aggregate (a string key forces a sort-based one)."""
    m = F.col(month)
    return (F.substring(m, 1, 4).try_cast("int") * 12 + F.substring(m, 6, 2).try_cast("int"))


def _first_last(x: str, order: str = "month") -> tuple[Column, Column]:
    """First / last non-NULL value of ``x`` in month order (NULL orderings are skipped)."""
    o = F.when(F.col(x).isNotNull(), _month_ordinal(order))
    return F.min_by(x, o), F.max_by(x, o)


def _rel_change(first: Column, last: Column) -> Column:
    return F.when(first > 0, (last - first) / first).otherwise(F.lit(0.0))


def monthly_features(scm: DataFrame) -> DataFrame:
    """Tiers 1A (fuel), MP-core and MP-risk: one window pass + one groupBy."""
    cols = set(scm.columns)
    w = Window.partitionBy(KEY).orderBy("month")
    win = {"_rn": F.row_number().over(w), "_cnt": F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
           # a month that the row before has not: counting them counts the distinct months
           "_new": F.col("month").isNotNull() & ~F.col("month").eqNullSafe(F.lag("month", 1).over(w))}
    if P1 in cols:
        # Change vs previous month, missing previous -> no change
        win["_chg"] = F.coalesce(F.abs(F.col(P1) - F.lag(P1, 1).over(w)) > 0.001, F.lit(False))
    m = scm.withColumns(win).withColumn("_rdesc", F.col("_cnt") - F.col("_rn"))

    def tot(c):
        return F.coalesce(F.sum(c), F.lit(0.0))

    aggs = [
        F.avg("monthly_elec_kwh").alias("avg_monthly_elec_kwh"),
        tot("monthly_elec_kwh").alias("total_elec_kwh_2024"),
        F.avg("monthly_gas_m3").alias("avg_monthly_gas_m3"),
        tot("monthly_gas_m3").alias("total_gas_m3_2024"),
        F.stddev_samp("monthly_elec_kwh").alias("std_monthly_elec_kwh"),
        F.stddev_samp("monthly_gas_m3").alias("std_monthly_gas_m3"),
        F.count_if("_new").cast("long").alias("active_months_count"),
    ]
    if "total_margin" in cols:
        aggs += [
            F.avg("total_margin").alias("avg_monthly_margin"),
            tot("total_margin").alias("total_margin_2024"),
            F.stddev_samp("total_margin").alias("std_margin"),
            F.min("total_margin").alias("min_monthly_margin"),
            F.count_if(F.col("total_margin") < 0).cast("long").alias("max_negative_margin"),
            F.avg(F.when(F.col("_rdesc") < 3, F.col("total_margin"))).alias("_last3"),
            F.avg(F.when((F.col("_rdesc") >= 3) & (F.col("_rdesc") < 6), F.col("total_margin"))).alias("_prior3"),
        ]
    if "total_revenue" in cols and "gas_revenue_variable" in cols:
        aggs += [tot("total_revenue").alias("_rev"), tot("gas_revenue_variable").alias("_gas_rev")]
    if ECOST in cols:
        f, l_ = _first_last(ECOST)
        aggs += [F.avg(ECOST).alias("province_avg_elec_cost_2024"), f.alias("_first_cost"),
                 l_.alias("_last_cost")]
    if GCOST in cols:
        aggs.append(F.avg(GCOST).alias("province_avg_gas_cost_2024"))
    if P1 in cols:
        f, l_ = _first_last(P1)
        aggs += [F.count_if("_chg").cast("long").alias("price_update_count"),
                 f.alias("_first_price"), l_.alias("_last_price"),
                 F.stddev_samp(P1).alias("elec_price_volatility_12m")]
    if GAS_P in cols:
        f, l_ = _first_last(GAS_P)
        aggs += [f.alias("_first_gas"), l_.alias("_last_gas")]
    g = m.groupBy(KEY).agg(*aggs)

    gc = set(g.columns)
    out = {
        "_has_months": F.lit(True),
        "_dual_both": ((F.col("total_elec_kwh_2024") > 0) & (F.col("total_gas_m3_2024") > 0)).cast("int"),
        "_gas_pos": F.col("total_gas_m3_2024") > 0,
    }
    if "_rev" in gc:
        out["gas_share_of_revenue"] = safe_div(F.col("_gas_rev"), F.col("_rev"))
    if "_first_price" in gc:
        out["elec_price_trend_12m"] = _rel_change(F.col("_first_price"), F.col("_last_price"))
    if "_first_gas" in gc:
        out["gas_price_trend_12m"] = _rel_change(F.col("_first_gas"), F.col("_last_gas"))
    if "_first_cost" in gc:
        out["province_elec_cost_trend"] = _rel_change(F.col("_first_cost"), F.col("_last_cost"))
    if "_first_price" in gc and "province_avg_elec_cost_2024" in gc:
        out["elec_price_vs_province_cost_spread"] = F.col("_last_price") - F.col("province_avg_elec_cost_2024")
    if "_last3" in gc:
        out["rolling_margin_trend"] = F.col("_last3") - F.coalesce(F.col("_prior3"), F.col("_last3"))
    g = g.withColumns(out)
    if "elec_price_trend_12m" in g.columns:
        g = g.withColumn("is_price_increase", flag(F.col("elec_price_trend_12m") > 0))
    return g


def customer_features(sc: DataFrame, as_of) -> DataFrame:
    """Tiers 1A (lifecycle), 2A (behaviour) and 2B (sentiment): projections, no shuffle."""
    cols = set(sc.columns)
    a = _date(as_of)
    out: dict[str, Column] = {}
    start = ("customer_first_activation_date" if "customer_first_activation_date" in cols
             else "contract_start_date" if "contract_start_date" in cols else None)
    if start:
        out["tenure_months"] = months_between_days(a, F.col(start), 0)
    if "next_renewal_date" in cols:
        out["months_to_renewal"] = months_between_days(F.col("next_renewal_date"), a, 1)
    df = sc.withColumns(out)
    out = {}
    if "months_to_renewal" in df.columns:
        out["renewal_bucket"] = cut("months_to_renewal", RENEWAL_EDGES, RENEWAL_LABELS)
        out["is_within_3m_of_renewal"] = flag(F.coalesce(F.col("months_to_renewal"), F.lit(999.0)) <= 3)
    if "tenure_months" in df.columns:
        out["tenure_bucket"] = cut("tenure_months", TENURE_EDGES, TENURE_LABELS)
    if "sales_channel" in cols:
        out["is_comparison_channel"] = flag(F.col("sales_channel") == "Comparison Website")
        out["is_own_website_channel"] = flag(F.col("sales_channel") == "Own Website")
    if "customer_intent" in cols:
        it = F.trim(F.col("customer_intent"))
        out["is_cancellation_intent"] = flag(it == INTENT_CANCEL)
        out["is_complaint_intent"] = flag(it == INTENT_COMPLAINT)
        out["recent_complaint_flag"] = in_set_flag(it, [INTENT_COMPLAINT, INTENT_CANCEL])
        out["intent_severity_score"] = F.coalesce(literal_map("customer_intent", INTENT_SEVERITY), F.lit(0))
    if "date" in cols:
        out["last_interaction_days_ago"] = days_between(a, F.col("date"))
        if "next_renewal_date" in cols:
            mt = days_between(F.col("next_renewal_date"), F.col("date")) / 30.44
            out["interaction_within_3m_of_renewal"] = F.coalesce(mt.between(0, 3), F.lit(False)).cast("int")
            out["is_interaction_within_30d_of_renewal"] = F.coalesce(mt.between(0, 1), F.lit(False)).cast("int")
    if "last_product_change_date" in cols:
        out["months_since_last_change"] = months_between_days(a, F.col("last_product_change_date"), 1)
    if "sentiment_label" in cols:
        out["is_negative_sentiment"] = flag(F.lower(F.col("sentiment_label")) == "negative")
    df = df.withColumns(out)
    if "renewal_bucket" in df.columns:
        df = df.withColumn("is_expired_contract", flag(F.col("renewal_bucket") == "expired"))
    if "recent_complaint_flag" in df.columns and "interaction_within_3m_of_renewal" in df.columns:
        df = df.withColumn("complaint_near_renewal", flag(
            (F.coalesce(F.col("recent_complaint_flag"), F.lit(0)) == 1)
            & (F.coalesce(F.col("interaction_within_3m_of_renewal"), F.lit(0)) == 1)))
    return df


def compound_features(df: DataFrame) -> DataFrame:
    """Tier 1B cross strings and tier 3 binary compounds."""
    cols = set(df.columns)
    out: dict[str, Column] = {}
    for name, a, b in CROSSES:
        if a in cols and b in cols:
            out[name] = cross(a, b)

    def one(c):
        return F.coalesce(F.col(c), F.lit(0)) == 1

    if "customer_intent" in cols:
        out["is_price_sensitive"] = flag(F.col("customer_intent") == INTENT_PRICING)
    if "renewal_bucket" in cols and "tenure_bucket" in cols:
        out["is_high_risk_lifecycle"] = (
            F.coalesce(F.col("renewal_bucket").isin("expired", "0-3m"), F.lit(False))
            & F.coalesce(F.col("tenure_bucket").isin("0-6m", "6-12m"), F.lit(False))).cast("int")
    if "is_high_competition_province" in cols and "is_within_3m_of_renewal" in cols:
        out["is_competition_x_renewal"] = flag(one("is_high_competition_province") & one("is_within_3m_of_renewal"))
    if "is_dual_fuel" in cols and "is_within_3m_of_renewal" in cols:
        out["dual_fuel_x_renewal"] = flag(one("is_dual_fuel") & one("is_within_3m_of_renewal"))
    if "is_dual_fuel" in cols and "is_high_competition_province" in cols:
        out["dual_fuel_x_competition"] = flag(one("is_dual_fuel") & one("is_high_competition_province"))
    if "is_dual_fuel" in cols and "customer_intent" in cols:
        out["dual_fuel_x_intent"] = flag(one("is_dual_fuel") & F.coalesce(
            F.col("customer_intent").isin(INTENT_CANCEL, INTENT_COMPLAINT), F.lit(False)))
    if "recent_complaint_flag" in cols and "is_negative_sentiment" in cols:
        out["complaint_x_negative_sentiment"] = flag(one("recent_complaint_flag") & one("is_negative_sentiment"))
    return df.withColumns(out)


GOLD_ORDER = (
    # tier 1A
    "months_to_renewal", "renewal_bucket", "is_within_3m_of_renewal", "tenure_months", "tenure_bucket",
    "segment", "sales_channel", "is_high_competition_province", "has_interaction", "is_second_residence",
    "is_expired_contract", "is_comparison_channel", "is_own_website_channel", "is_dual_fuel",
    # MP core
    "avg_monthly_elec_kwh", "total_elec_kwh_2024", "avg_monthly_gas_m3", "total_gas_m3_2024",
    "avg_monthly_margin", "total_margin_2024", "is_digital_channel", "portfolio_type",
    "gas_share_of_revenue", "province_avg_elec_cost_2024", "province_avg_gas_cost_2024", "price_update_count",
    # MP risk
    "std_monthly_elec_kwh", "std_monthly_gas_m3", "active_months_count", "std_margin", "min_monthly_margin",
    "max_negative_margin", "elec_price_trend_12m", "elec_price_volatility_12m", "is_price_increase",
    "gas_price_trend_12m", "province_elec_cost_trend", "elec_price_vs_province_cost_spread",
    "rolling_margin_trend",
    # 2A
    "customer_intent", "is_cancellation_intent", "is_complaint_intent", "recent_complaint_flag",
    "intent_severity_score", "last_interaction_days_ago", "interaction_within_3m_of_renewal",
    "is_interaction_within_30d_of_renewal", "complaint_near_renewal", "months_since_last_change",
    # 2B
    "sentiment_label", "sentiment_neg", "sentiment_pos", "sentiment_neu", "is_negative_sentiment",
    # 1B + 3
    *[c[0] for c in CROSSES],
    "is_price_sensitive", "is_high_risk_lifecycle", "is_competition_x_renewal", "dual_fuel_x_renewal",
    "dual_fuel_x_competition", "dual_fuel_x_intent", "complaint_x_negative_sentiment",
    "churn",
)


def gold_master(silver_customer: DataFrame, silver_customer_month: DataFrame, as_of) -> DataFrame:
    """One row per customer of ``silver_customer`` with all feature tiers."""
    cust = customer_features(silver_customer, as_of)
    mon = monthly_features(silver_customer_month)
    g = cust.join(mon, KEY, "left")
    has = F.coalesce(F.col("_has_months"), F.lit(False))
    extra = {"is_dual_fuel": F.coalesce(F.col("_dual_both"), F.lit(0))}
    if "segment" in g.columns:
        extra["portfolio_type"] = F.when(has, F.concat(
            F.coalesce(F.col("segment"), F.lit("Unknown")), F.lit("_"),
            F.when(F.col("_gas_pos"), F.lit("DualFuel")).otherwise(F.lit("SingleFuel"))))
    if "sales_channel" in g.columns:
        extra["is_digital_channel"] = F.when(has, in_set_flag("sales_channel",
                                                              ["Comparison Website", "Own Website"]))
    g = compound_features(g.withColumns(extra))
    return g.select(KEY, *[c for c in GOLD_ORDER if c in g.columns])

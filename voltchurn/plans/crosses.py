"""Crossed rate reports (E2, E4-E11, E13-E15): many crosses of one table in one pass.

A report of the notebooks is a handful of small group-bys of the same customers.
Here the crosses of a report are one aggregate over (cross, values): the table
is read once, every row is expanded to its crosses inside the scan's stage, and
partial aggregation leaves one row per group and task, so neither the number of
crosses nor a group of a third of all customers makes a shuffle large.  Medians
of all crosses come from one ``grouped_quantiles`` call.

The result is long: ``cross`` names the columns crossed, ``level_1`` to
``level_3`` hold their values as text.  Customers whose value of a crossed
column is NULL are left out of that cross, as the notebooks' group-bys do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltchurn.constants import KEY
from voltchurn.functions.exprs import cut, days_between
from voltchurn.operators.frames import cut_lineage
from voltchurn.operators.stats import grouped_quantile, quantile, with_quantile_bins
from voltchurn.plans.reports import INTERACTION_DAY_EDGES, INTERACTION_DAY_LABELS

LEVELS = 3
POWER_EDGES = (0.0, 3.5, 5.0, 8.0, 20.0)
POWER_LABELS = ("<=3.5kW", "3.5-5kW", "5-8kW", "8kW+")


def cross_name(dims: Sequence[str]) -> str:
    return " x ".join(dims)


def _expanded(df: DataFrame, crosses: Sequence[Sequence[str]], values: Sequence[str]) -> DataFrame:
    """A row per customer and cross whose columns are all known: cross, level_1.., values."""
    def row(dims):
        levels = [F.col(d).cast("string") for d in dims] + [F.lit(None).cast("string")] * (LEVELS - len(dims))
        known = F.lit(True)
        for d in dims:
            known = known & F.col(d).isNotNull()
        return F.when(known, F.struct(F.lit(cross_name(dims)).alias("cross"), *[c.alias(f"level_{k + 1}") for k, c in enumerate(levels)]))

    rows = F.explode(F.array(*[row(dims) for dims in crosses])).alias("_c")
    return df.select(rows, *values).filter(F.col("_c").isNotNull()).select("_c.*", *values)


def cross_rates(df: DataFrame, crosses: Sequence[Sequence[str]], label: str = "churn", extra: dict[str, Column] | None = None,
                medians: dict[str, str] | None = None, values: Sequence[str] = (), min_group: int = 0) -> DataFrame:
    """Customers, churners and churn rate of every group of every cross.

    ``crosses``: lists of one to three columns.  ``extra``: named aggregates over
    ``values``; ``medians``: name -> column, exact.  ``min_group`` keeps groups of
    that many customers.  A NULL label counts as a customer and not in the rate.
    """
    medians = dict(medians or {})
    keys = ["cross", *[f"level_{k + 1}" for k in range(LEVELS)]]
    kept = list(dict.fromkeys([label, *values, *medians.values()]))
    if medians:                                   # read twice: for the rates and for the medians
        df = cut_lineage(df.select(*dict.fromkeys([*[d for dims in crosses for d in dims], *kept])))
    rows = _expanded(df, crosses, kept)
    out = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("customers"), F.count_if(F.col(label) == 1).alias("churners"),
        F.avg(F.col(label).cast("double")).alias("churn_rate"), *[e.alias(n) for n, e in (extra or {}).items()])
    if min_group:
        out = out.filter(F.col("customers") >= min_group)
    if medians:
        # NULL levels (crosses of fewer columns) are a value of their own here
        named = F.concat_ws("\u0001", "cross", *[F.coalesce(F.col(k), F.lit("\u0002")) for k in keys[1:]]).alias("_group")
        q = grouped_quantile(rows.select(named, *set(medians.values())), ["_group"], {n: F.col(c) for n, c in medians.items()}, 0.5)
        out = out.withColumn("_group", named).join(q, "_group", "left").drop("_group")
    return out


def lifecycle_columns(gold: DataFrame, sc: DataFrame | None = None) -> DataFrame:
    """Gold with the buckets the crosses use: power_bucket (E5) and, with the silver
    customers, days_bucket of the interaction before the renewal (E14)."""
    out = gold
    if "contracted_power_kw" in gold.columns:
        out = out.withColumn("power_bucket", cut("contracted_power_kw", POWER_EDGES, POWER_LABELS))
    if sc is not None:
        days = days_between(F.col("next_renewal_date"), F.col("date"))
        dated = (F.col("has_interaction") == 1) & (days >= 0)
        timing = sc.select(KEY, F.when(dated, days).alias("_days")).filter(F.col("_days").isNotNull()) \
            .select(KEY, cut("_days", INTERACTION_DAY_EDGES, INTERACTION_DAY_LABELS, right=False).alias("days_bucket"))
        out = out.join(timing, KEY, "left")
    return out


def customer_medians(scm: DataFrame) -> DataFrame:
    """Per customer: median monthly electricity, gas and total margin, and the margin's and bill's spread."""
    # a customer has a row a month: the percentiles of so few values ride on the customer's aggregate
    return scm.groupBy(KEY).agg(F.stddev_samp("total_margin").alias("margin_volatility"),
                                F.stddev_samp("total_revenue").alias("bill_volatility"),
                                *[quantile(c, 0.5).alias(f"{c}_med") for c in ("elec_margin", "gas_margin", "total_margin")])


def tenure_crosses(customers: DataFrame) -> DataFrame:
    """E5: churn by renewal bucket, tenure bucket, and tenure x seven others."""
    others = ("is_within_3m_of_renewal", "sales_channel", "segment", "is_high_competition_province", "is_second_residence",
              "power_bucket", "renewal_bucket")
    return cross_rates(customers, [["renewal_bucket"], ["tenure_bucket"], *[["tenure_bucket", o] for o in others]])


def expired_crosses(customers: DataFrame) -> DataFrame:
    """E4 + E6: churn in and out of the renewal window and with an expired contract, by segment and bucket."""
    return cross_rates(customers, [["is_within_3m_of_renewal"], ["segment", "is_within_3m_of_renewal"], ["is_expired_contract"],
                                   ["renewal_bucket", "is_expired_contract"], ["segment", "is_expired_contract"]])


def market_crosses(customers: DataFrame, medians: DataFrame) -> DataFrame:
    """E7 + E8 + E9: channels, competition and dual fuel, alone and crossed, with
    median electricity, gas and total margin, margin volatility and tenure, and
    the average profit at risk (median margin x churned)."""
    src = customers.join(medians, KEY, "left").withColumn("_at_risk", F.col("total_margin_med") * F.col("churn"))
    channel, competition, dual = "sales_channel", "is_high_competition_province", "is_dual_fuel"
    near, tenure, segment = "is_within_3m_of_renewal", "tenure_bucket", "segment"
    crosses = [[channel], [channel, near], [channel, competition], [channel, tenure], [channel, segment],
               [competition], [competition, segment], [competition, near], [dual], [dual, near], [dual, competition], [dual, tenure]]
    return cross_rates(src, crosses, values=["_at_risk"], extra={"avg_profit_at_risk": F.avg("_at_risk")},
                       medians={"median_elec_margin": "elec_margin_med", "median_gas_margin": "gas_margin_med",
                                "median_total_margin": "total_margin_med", "median_margin_volatility": "margin_volatility",
                                "median_tenure": "tenure_months"})


def contact_crosses(customers: DataFrame) -> DataFrame:
    """E10 + E11 + E13 + E14 + E19: interactions, sentiment and intent against churn, both
    ways round, by renewal quintile, channel and days from interaction to renewal."""
    src = with_quantile_bins(customers, "months_to_renewal", 5, "renewal_quintile")
    crosses = [["has_interaction"], ["churn", "has_interaction"], ["renewal_quintile", "has_interaction"], ["sentiment_label"],
               ["renewal_quintile", "sentiment_label"], ["customer_intent"], ["customer_intent", "sentiment_label"],
               ["customer_intent", "sales_channel"], ["days_bucket"], ["days_bucket", "sentiment_label"], ["days_bucket", "customer_intent"]]
    return cross_rates(src, crosses, values=["has_interaction"],
                       extra={"interaction_rate": F.avg(F.coalesce(F.col("has_interaction"), F.lit(0)).cast("double"))})


def stickiness_crosses(customers: DataFrame, min_group: int = 30) -> DataFrame:
    """E15 + P15: dual fuel and competition x interaction and intent, groups of ``min_group`` and more."""
    crosses = [[a, b] for a in ("is_dual_fuel", "is_high_competition_province") for b in ("has_interaction", "customer_intent")]
    return cross_rates(customers, [*crosses, ["is_dual_fuel", "is_high_competition_province", "has_interaction"]], min_group=min_group)


def volatility_crosses(medians: DataFrame, sc: DataFrame) -> DataFrame:
    """Median margin and bill volatility by churn and by segment x churn."""
    src = medians.join(sc.select(KEY, "segment", "churn"), KEY)
    return cross_rates(src, [["churn"], ["segment", "churn"]], medians={
        "median_margin_volatility": "margin_volatility", "median_bill_volatility": "bill_volatility"})

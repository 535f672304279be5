"""Notebook variants of gold features.

The notebook builds some features differently from the production code;
each variant is a named function so choosing one is explicit.  All cut the
inputs at ``as_of`` first (no data after the snapshot, P8).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltchurn.constants import KEY
from voltchurn.functions.exprs import month_start


def _as_of(as_of):
    return F.lit(str(as_of)[:10]).cast("date")


def calendar_margin_trend(scm: DataFrame, as_of) -> DataFrame:
    """Mean margin of months in [as_of - 3 months, as_of] minus mean of
    [as_of - 6 months, as_of - 3 months); either side missing -> NULL."""
    a = _as_of(as_of)
    m = scm.select(KEY, month_start("month").alias("_m"), "total_margin").filter(F.col("_m") <= a)
    last = F.col("_m") >= F.add_months(a, -3)
    prior = (F.col("_m") >= F.add_months(a, -6)) & (F.col("_m") < F.add_months(a, -3))
    g = m.groupBy(KEY).agg(F.avg(F.when(last, F.col("total_margin"))).alias("_l"),
                           F.avg(F.when(prior, F.col("total_margin"))).alias("_p"))
    return g.filter(F.col("_l").isNotNull() | F.col("_p").isNotNull()).select(
        KEY, (F.col("_l") - F.col("_p")).alias("rolling_margin_trend"))


def gas_share_with_fixed(scm: DataFrame) -> DataFrame:
    """(gas variable revenue + fixed / 12) / total revenue; NULL when revenue <= 0."""
    gas = F.coalesce(F.col("gas_revenue_variable"), F.lit(0.0)) + F.coalesce(F.col("gas_revenue_fixed"),
                                                                              F.lit(0.0)) / 12
    g = scm.groupBy(KEY).agg(F.sum(gas).alias("_g"), F.sum("total_revenue").alias("_r"))
    return g.select(KEY, F.when(F.col("_r") > 0, F.col("_g") / F.col("_r")).alias("gas_share_of_revenue"))


def province_average_costs(costs: DataFrame, customers: DataFrame, as_of) -> DataFrame:
    """Mean cost per province (months up to ``as_of``), joined to each customer's province."""
    a = _as_of(as_of)
    c = costs.withColumn("_m", month_start("month")).filter(F.col("_m") <= a)
    prov = c.groupBy(F.col("province").cast("int").alias("province")).agg(
        F.avg(F.col("elec_var_cost_eur_kwh").cast("double")).alias("province_avg_elec_cost_2024"),
        F.avg(F.col("gas_var_cost_eur_m3").cast("double")).alias("province_avg_gas_cost_2024"))
    cust = customers.select(KEY, F.col("province_code").cast("int").alias("province"))
    # provinces: a bounded lookup, but let the optimizer / AQE pick the join side by size
    return cust.join(prov, "province", "left").select(KEY, "province_avg_elec_cost_2024",
                                                      "province_avg_gas_cost_2024")


def distinct_pricing_dates(prices: DataFrame, as_of) -> DataFrame:
    """Number of distinct pricing dates per customer up to ``as_of``."""
    d = F.col("pricing_date").try_cast("date")
    return prices.filter(d <= _as_of(as_of)).groupBy(KEY).agg(
        F.count_distinct(d).alias("price_update_count"))

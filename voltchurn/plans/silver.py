"""Silver layer.

Hierarchical price imputation runs as three dependent stages, each fused
over all six price columns:

1. one window pass per customer (ordered by month) -- forward then backward fill;
2. one grouped median per (segment, month) over rows that consumed, joined back;
3. one grouped median per month, joined back.

Level 2 sees level-1 results and level 3 sees level-2 results, as in the
reference.  Median tables have at most segments x months rows, so they are
broadcast after a size check.  A customer-month table has at most one row
per customer and month, so no window partition can grow with the hourly data.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltchurn.constants import CHANNEL_MAP, KEY, PRICE_CONSUMPTION_PAIRS
from voltchurn.functions.exprs import literal_map
from voltchurn.operators.frames import cut_lineage, ffill_bfill, pick_per_key, written
from voltchurn.operators.stats import grouped_quantile


def customer_segments(sc: DataFrame) -> DataFrame:
    """segment and residential type.

    Industrial customers below 10 kW get no segment: only exactly 10 kW (SME)
    and above 10 kW (Corporate) are mapped, as in the reference code.
    """
    ind, kw = F.col("is_industrial"), F.col("contracted_power_kw")
    seg = (F.when(ind == 0, F.lit("Residential"))
           .when((ind == 1) & (kw == 10), F.lit("SME"))
           .when((ind == 1) & (kw > 10), F.lit("Corporate")))
    res = (F.when((seg == "Residential") & (F.col("is_second_residence") == 1), F.lit("Second_Residence"))
           .when((seg == "Residential") & (F.col("is_second_residence") == 0), F.lit("Primary_Residence")))
    return sc.withColumns({"segment": seg, "residential_type": res})


def clean_channel(c) -> Column:
    """trim + lower, translate by the channel map, unmapped kept cleaned; NULL stays NULL."""
    cleaned = F.lower(F.trim(F.col(c) if isinstance(c, str) else c))
    return F.coalesce(literal_map(cleaned, CHANNEL_MAP), cleaned)


def clean_sales_channels(sc: DataFrame) -> DataFrame:
    if "sales_channel" not in sc.columns:
        return sc
    return sc.withColumn("sales_channel", clean_channel("sales_channel"))


def _num(df: DataFrame, c: str) -> Column:
    """Numeric coercion, unparseable text -> NULL, NaN -> NULL."""
    dtype = dict(df.dtypes)[c]
    x = F.col(c).try_cast("double") if dtype == "string" else F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


#: most groups whose medians are broadcast; more are joined
MOST_MAP_GROUPS = 10_000


def attach_medians(df: DataFrame, groups: list[str], value_exprs: dict[str, Column],
                   most_map_groups: int = MOST_MAP_GROUPS, asking: Column | None = None, kept: bool = False) -> DataFrame:
    """Adds the exact median of each expression over the row's group, NULLs skipped.

    The medians come from ``stats.grouped_quantile`` (no task holds a group) and
    are written down, one row per group.  Up to ``most_map_groups`` of them are
    broadcast, so ``df`` is not shuffled on the group columns; more than that are
    joined.  A row with a NULL group gets NULLs.

    ``asking`` marks the rows whose medians will be used: only their groups are
    worked out (from all of the group's rows), the rows of others get NULLs.
    ``kept``: ``df`` is read from a written table.
    """
    rows = df
    if asking is not None:
        asked = cut_lineage(df.filter(asking).select(*groups).distinct())
        if asked.limit(most_map_groups + 1).count() <= most_map_groups:
            rows = df.join(F.broadcast(asked), groups, "left_semi")
    med = cut_lineage(grouped_quantile(rows, groups, value_exprs, 0.5, kept))
    if med.limit(most_map_groups + 1).count() <= most_map_groups:
        med = F.broadcast(med)
    return df.join(med, groups, "left").select(*df.columns, *value_exprs)


def impute_prices(scm: DataFrame, silver_customer: DataFrame | None = None,
                  segment_col: str = "is_industrial", checkpoint: bool = True) -> DataFrame:
    """Three-level imputation of every price column present.

    For each (price, consumption) pair: price 0 means missing; only rows whose
    consumption is > 0 are imputed, and only those rows feed the medians.

    The level-1 result feeds both the median aggregates and the rows they are
    looked up for; it is written (into ``spark.checkpoint.dir``) and read back, so the upstream bronze plan runs once instead of once per consumer.
    """
    df = scm
    if segment_col not in df.columns and silver_customer is not None:
        seg = pick_per_key(silver_customer.select(KEY, segment_col), [KEY], [segment_col])
        df = df.join(seg, KEY, "left")
    pairs = [(p, c) for p, c in PRICE_CONSUMPTION_PAIRS if p in df.columns and c in df.columns]
    if not pairs:
        return df
    # zero -> missing, bad text -> missing
    df = df.withColumns({p: F.nullif(_num(df, p), F.lit(0.0)) for p, _ in pairs})
    mask = {p: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) > 0 for p, c in pairs}

    # level 1: customer forward/backward fill (fill source = all of the customer's rows)
    df = df.withColumns({p: F.when(mask[p] & F.col(p).isNull(), ffill_bfill(p, [KEY], ["month"]))
                         .otherwise(F.col(p)) for p, _ in pairs})
    if checkpoint:
        df = written(df, "filled")

    # level 2: segment x month median over consuming rows; level 3: national month median after level 2
    # (most prices are there by then: level 3 works out the months that still lack one)
    for level, groups in (("_m2_", [segment_col, "month"]), ("_m3_", ["month"])):
        lacking = reduce(or_, [mask[p] & F.col(p).isNull() for p, _ in pairs]) if level == "_m3_" else None
        df = attach_medians(df, groups, {f"{level}{p}": F.when(mask[p], F.col(p)) for p, _ in pairs},
                            asking=lacking, kept=checkpoint and level == "_m2_")
        df = df.withColumns({p: F.when(mask[p] & F.col(p).isNull(), F.col(f"{level}{p}"))
                             .otherwise(F.col(p)) for p, _ in pairs}).drop(*[f"{level}{p}" for p, _ in pairs])
    return df


ELEC_COLS = ("elec_kwh_tier_1_peak", "elec_kwh_tier_2_standard", "elec_kwh_tier_3_offpeak",
             "variable_price_tier1_eur_kwh", "variable_price_tier2_eur_kwh", "variable_price_tier3_eur_kwh",
             "elec_fixed_fee_eur_month", "monthly_elec_kwh",
             "elec_var_cost_eur_kwh", "peaje_elec_eur_kwh", "elec_fixed_cost_eur_month")
GAS_COLS = ("monthly_gas_m3", "gas_variable_price_eur_m3", "gas_fixed_revenue_eur_year",
            "gas_var_cost_eur_m3", "gas_fixed_cost_eur_year")


def compute_margins(scm: DataFrame) -> DataFrame:
    """electricity, gas and total P&L per customer-month.

    Inputs are coerced to numbers with missing -> 0, and those zero-filled
    inputs are part of the output (gold reads them afterwards).  Absent
    columns count as 0.
    """
    present = set(scm.columns)
    df = scm.withColumns({c: F.coalesce(_num(scm, c), F.lit(0.0)) for c in ELEC_COLS + GAS_COLS
                          if c in present})

    def g(c):
        return F.col(c) if c in present else F.lit(0.0)

    ev = (g("elec_kwh_tier_1_peak") * g("variable_price_tier1_eur_kwh")
          + g("elec_kwh_tier_2_standard") * g("variable_price_tier2_eur_kwh")
          + g("elec_kwh_tier_3_offpeak") * g("variable_price_tier3_eur_kwh"))
    df = df.withColumns({
        "elec_revenue_variable": ev,
        "elec_revenue_fixed": g("elec_fixed_fee_eur_month"),
        "elec_cost_variable": g("monthly_elec_kwh") * (g("elec_var_cost_eur_kwh") + g("peaje_elec_eur_kwh")),
        "elec_cost_fixed": g("elec_fixed_cost_eur_month"),
        "gas_revenue_variable": g("monthly_gas_m3") * g("gas_variable_price_eur_m3"),
        "gas_revenue_fixed": g("gas_fixed_revenue_eur_year") / 12,
        "gas_cost_variable": g("monthly_gas_m3") * g("gas_var_cost_eur_m3"),
        "gas_cost_fixed": g("gas_fixed_cost_eur_year") / 12,
    })
    c = F.col
    df = df.withColumns({
        "elec_margin": c("elec_revenue_variable") + c("elec_revenue_fixed")
        - c("elec_cost_variable") - c("elec_cost_fixed"),
        "gas_margin": c("gas_revenue_variable") + c("gas_revenue_fixed")
        - c("gas_cost_variable") - c("gas_cost_fixed"),
        "total_revenue": c("elec_revenue_variable") + c("elec_revenue_fixed")
        + c("gas_revenue_variable") + c("gas_revenue_fixed"),
        "total_cost": c("elec_cost_variable") + c("elec_cost_fixed")
        + c("gas_cost_variable") + c("gas_cost_fixed"),
    })
    return df.withColumn("total_margin", c("total_revenue") - c("total_cost"))


def silver_customer(bronze_customer: DataFrame) -> DataFrame:
    return clean_sales_channels(customer_segments(bronze_customer))


def silver_tables(bronze_customer: DataFrame, bronze_customer_month: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(silver_customer, silver_customer_month)."""
    sc = silver_customer(bronze_customer)
    scm = compute_margins(impute_prices(bronze_customer_month, sc))
    return sc, scm

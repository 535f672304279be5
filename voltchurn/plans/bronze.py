"""Bronze layer (A1-A4, J1-J4, P1-P5, U1): raw tables -> customer and customer-month.

Scale notes.  The hourly table is the only big input (176M rows in the
reference, unbounded here).  ``customer_month`` prunes it to four columns at
the scan, computes the tier per row inside codegen, and aggregates with
Spark's partial (map-side) sums, so the shuffle carries at most one row per
customer-month per task -- the hand-written 2M-row batching of the reference
is exactly what partial aggregation already does.  A hot customer is reduced
inside each map task, so skew cannot pile raw rows onto one reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltchurn.constants import GAS_KWH_PER_M3, KEY, TIERS
from voltchurn.functions.exprs import clip_lower0, month_key, nan_to_null, normalize_month, tariff_tier
from voltchurn.operators.frames import broadcast_if_small, guard_unique, join_new_columns, pick_by_id, pick_per_key


def _as_ts(c: str, df: DataFrame):
    dtype = dict(df.dtypes)[c]
    if dtype.startswith("timestamp"):
        return F.col(c)
    if dtype == "date":
        return F.col(c).cast("timestamp_ntz")
    return F.try_to_timestamp(F.col(c).cast("string"))


def hourly_tiers(consumption: DataFrame, elec_col: str = "consumption_elec_kwh",
                 gas_col: str = "consumption_gas_m3", ts_col: str = "timestamp") -> DataFrame:
    """P1 + P2 + P5 + F1 + F2 + F4: per-reading clean values, month and tier.

    Rows with a NULL/blank key or an unparseable time are dropped here (they
    are the quarantine; see ``quality.quarantine_counts``).
    """
    ts = _as_ts(ts_col, consumption)
    cons = consumption.select(
        F.col(KEY).cast("string").alias(KEY),
        ts.alias("ts"),
        clip_lower0(nan_to_null(F.col(elec_col).cast("double"))).alias("elec"),
        clip_lower0(nan_to_null(F.col(gas_col).cast("double"))).alias("gas"),
    ).filter(F.col(KEY).isNotNull() & (F.col(KEY) != "") & F.col("ts").isNotNull())
    return cons.select(KEY, month_key("ts").alias("month"), tariff_tier("ts").alias("tier"),
                       "elec", "gas", (F.col("gas") * GAS_KWH_PER_M3).alias("gas_kwh"))


def customer_month_consumption(consumption: DataFrame, **kw) -> DataFrame:
    """A1: 3 monthly totals + 9 tier-split sums per customer-month, one pass.

    All-NULL groups sum to 0, as in pandas.
    """
    t = hourly_tiers(consumption, **kw)

    def s(c):
        return F.coalesce(F.sum(c), F.lit(0.0))

    aggs = [s("elec").alias("monthly_elec_kwh"), s("gas").alias("monthly_gas_m3"),
            s("gas_kwh").alias("monthly_gas_kwh")]
    for prefix, src in (("elec_kwh", "elec"), ("gas_m3", "gas"), ("gas_kwh", "gas_kwh")):
        for tier in TIERS:
            aggs.append(s(F.when(F.col("tier") == tier, F.col(src)).otherwise(F.lit(0.0)))
                        .alias(f"{prefix}_{tier}"))
    return t.groupBy(KEY, "month").agg(*aggs)


def prices_by_month(prices: DataFrame, validate: bool = True) -> DataFrame:
    """Prices keyed by (customer, month); two prices in one month fail the job (trap 28)."""
    p = prices
    if "pricing_date" in p.columns:
        p = p.withColumn("month", month_key(_as_ts("pricing_date", p))).drop("pricing_date")
    if validate:
        p = guard_unique(p, [KEY, "month"], "prices")
    return p


def customer_month(consumption: DataFrame, prices: DataFrame | None = None,
                   costs: DataFrame | None = None, province_lookup: DataFrame | None = None,
                   validate: bool = True, **kw) -> DataFrame:
    """A1 + J2 + J3 + J4: the bronze customer-month table."""
    monthly = customer_month_consumption(consumption, **kw)
    if prices is not None:
        monthly = monthly.join(prices_by_month(prices, validate), [KEY, "month"], "left")
    if province_lookup is not None:
        prov = pick_per_key(province_lookup.select(KEY, "province_code"), [KEY], ["province_code"])
        monthly = monthly.join(prov, KEY, "left")
    if costs is not None and "province_code" in monthly.columns:
        c = costs.withColumn("month", normalize_month("month"))
        # provinces x months: small by construction, but check the size anyway
        c = broadcast_if_small(c.withColumnRenamed("month", "_cmonth"))
        monthly = monthly.join(
            c, (monthly["province_code"] == c["province"]) & (monthly["month"] == c["_cmonth"]), "left"
        ).drop("province", "_cmonth", "province_code")
    return monthly


def customer(churn: DataFrame, attributes: DataFrame, contracts: DataFrame,
             interactions: DataFrame, attr_order=None, contract_order=None,
             interaction_order=None, enrich=None, interaction_id: str | None = None) -> DataFrame:
    """Label LEFT attributes LEFT contracts LEFT interactions, one row per customer.

    Each side is first reduced to one row per key with an explicit order
    (the reference keeps the first row in file order, which Spark has not):
    attributes and contracts by the given order (default: earliest contract
    start), interactions by the latest date, NULL dates last.  The label
    table must be unique; a duplicate fails the job.

    ``interaction_id`` names a unique column of the interactions: the latest row
    is then chosen by id, its text fetched afterwards (``pick_by_id``), and the
    id left out of the result.  ``enrich`` (a per-row function such as intent +
    sentiment) then runs on the chosen rows alone.  Without an id it runs
    map-side, before the shuffle that picks the latest row: it is CPU-heavy, and
    there it has the parallelism of the input splits.
    """
    lab = guard_unique(churn, [KEY], "churn")
    attr = pick_per_key(attributes, [KEY], attr_order or [])
    corder = contract_order or ([c for c in ("contract_start_date",) if c in contracts.columns])
    con = pick_per_key(contracts, [KEY], corder)
    iorder = interaction_order or ([c for c in ("date",) if c in interactions.columns])
    if interaction_id:
        inter = pick_by_id(interactions, [KEY], iorder, interaction_id, latest=True).drop(interaction_id)
        inter = enrich(inter) if enrich is not None else inter
    else:
        inter = pick_per_key(enrich(interactions) if enrich is not None else interactions, [KEY], iorder, latest=True)
    out = lab
    for side in (attr, con, inter):
        out = join_new_columns(out, side)
    return out

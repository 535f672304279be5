"""Registered queries (Spark) and their DuckDB twins, keyed by name."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oracle import pipeline_sql as PS
from oracle import views as V
from voltchurn.operators.frames import cut_lineage as S_cut
from voltchurn.plans import bronze, enrich, gold, pipeline, silver
from voltchurn.sources import standins as si

AS_OF = "2001-06-30"
QUERIES: dict = {}
ORACLES: dict = {}


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    dbl = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    if not dbl:
        return df
    return df.select(*[F.round(F.col(c), places).alias(c) if c in dbl else F.col(c) for c in df.columns])


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _raw(spark, sf):
    return si.raw_tables(spark, sf, consumption="orders")


def _bronze(spark, sf):
    """Bronze tables; interactions are chosen by their id, their texts fetched afterwards."""
    raw = {**_raw(spark, sf), "interactions": si.interactions_with_id(spark, sf)}
    return pipeline.bronze_layer(raw, interaction_id="interaction_id")


def _silver(spark, sf):
    """Silver tables by name, each built when asked for (the customer table needs no readings)."""
    b = _bronze(spark, sf)
    plain = silver.silver_customer(pipeline.bronze_layer(_raw(spark, sf))["bronze_customer"])
    return pipeline.LazyLayers({**{k: (lambda v=v: v) for k, v in b.items()}, **pipeline.silver_builders(b, plain)})


def _layers(spark, sf):
    s = _silver(spark, sf)
    return pipeline.LazyLayers({**s.builders, "gold_master": lambda: pipeline.gold_layer(s, AS_OF)})


# ---------------------------------------------------------------- bronze ----

@register("bronze_tier_sums_events",
          V.with_(V.CONSUMPTION_EVENTS, *PS.monthly_consumption_ctes()) + " SELECT * FROM cm")
def q_bronze_tier_sums_events(spark, sf):
    """Hourly events -> 12 monthly sums per customer-month."""
    return bronze.customer_month_consumption(si.consumption_from_events(spark, sf))


@register("bronze_customer_month", V.with_(*PS.bronze_customer_month_ctes()) + " SELECT * FROM bcm")
def q_bronze_customer_month(spark, sf):
    """A1 + J2 (prices on customer, month) + J3 (province) + J4 (costs on province, month)."""
    raw = _raw(spark, sf)
    return bronze.customer_month(raw["consumption"], raw["prices"], raw["costs"], raw["attributes"])


@register("bronze_customer", V.with_(*PS.bronze_customer_ctes()) + " SELECT * FROM bc")
def q_bronze_customer(spark, sf):
    """J1 + X2/X3/X4: label backbone with first attributes, contract and latest enriched interaction."""
    return _bronze(spark, sf)["bronze_customer"]


# ---------------------------------------------------------------- silver ----

@register("silver_customer", V.with_(*PS.silver_customer_ctes()) + " SELECT * FROM sc")
def q_silver_customer(spark, sf):
    """F18 segments + F9 channel clean-up."""
    return _silver(spark, sf)["silver_customer"]


@register("silver_customer_month", V.with_(*PS.all_silver_ctes()) + " SELECT * FROM scm")
def q_silver_customer_month(spark, sf):
    """G8 three-level price imputation + F13 P&L."""
    return _silver(spark, sf)["silver_customer_month"]


# ------------------------------------------------------------------ gold ----

@register("gold_master", V.with_(*PS.gold_ctes(AS_OF)) + " SELECT * FROM gold")
def q_gold_master(spark, sf):
    """56 features + 8 crosses + label, one row per customer."""
    return _layers(spark, sf)["gold_master"]


# --------------------------------------------------------------- reports ----
from voltchurn.operators import stats as S  # noqa: E402
from voltchurn.plans import reports as RP  # noqa: E402

G = V.with_(*PS.gold_ctes(AS_OF))


def _gold(spark, sf):
    return _layers(spark, sf)["gold_master"]


def _rate_sql(dims, where="", having="", pct=False, src="gold"):
    d = ", ".join(dims)
    nn = " AND ".join(f"{x} IS NOT NULL" for x in dims)
    rate = "avg(CAST(churn AS DOUBLE))"
    if pct:
        rate = f"round_even({rate} * 100, 2)"
    w = f" WHERE {nn}" + (f" AND {where}" if where else "")
    h = f" HAVING {having}" if having else ""
    return f" SELECT {d}, count(*) AS customers, {rate} AS churn_rate FROM {src}{w} GROUP BY {d}{h}"


def _describe_sql(value, by, src="gold", prefix=""):
    b = ", ".join(by)
    nn = " AND ".join(f"{x} IS NOT NULL" for x in by) or "TRUE"
    return (f" SELECT {b + ', ' if b else ''}count({value}) AS {prefix}count, avg({value}) AS {prefix}mean, "
            f"stddev_samp({value}) AS {prefix}std, min({value}) AS {prefix}min, max({value}) AS {prefix}max, "
            f"quantile_cont({value}, 0.25) AS {prefix}p25, quantile_cont({value}, 0.5) AS {prefix}p50, "
            f"quantile_cont({value}, 0.75) AS {prefix}p75 FROM {src} WHERE {nn}"
            + (f" GROUP BY {b}" if b else ""))


@register("report_churn_by_renewal_bucket", G + _rate_sql(["renewal_bucket"]))
def q_churn_by_renewal(spark, sf):
    """E5 + F8: churn rate per renewal bucket."""
    return RP.churn_by(_gold(spark, sf), ["renewal_bucket"])


@register("report_churn_by_tenure_x_channel", G + _rate_sql(["tenure_bucket", "sales_channel"]))
def q_churn_by_tenure_channel(spark, sf):
    """E5: churn rate per tenure bucket x channel."""
    return RP.churn_by(_gold(spark, sf), ["tenure_bucket", "sales_channel"])


@register("report_churn_by_intent_pct", G + _rate_sql(["customer_intent"], pct=True))
def q_churn_by_intent(spark, sf):
    """Churn % (2 dp, half-even) per intent."""
    return RP.churn_by(_gold(spark, sf), ["customer_intent"], pct=True)


@register("report_dual_fuel_x_competition_min30",
          G + _rate_sql(["is_dual_fuel", "is_high_competition_province", "renewal_bucket"], having="count(*) >= 30"))
def q_dual_competition(spark, sf):
    """E9 + E15 + P15: churn per dual fuel x competition x renewal, groups of 30+ only."""
    return RP.churn_by(_gold(spark, sf), ["is_dual_fuel", "is_high_competition_province", "renewal_bucket"],
                       min_group=30)


@register("report_sentiment_churn", G + _rate_sql(["sentiment_label"]))
def q_sentiment_churn(spark, sf):
    """Churn rate per sentiment label."""
    return RP.churn_by(_gold(spark, sf), ["sentiment_label"])


@register("report_margin_by_segment_churn", G + _describe_sql("avg_monthly_margin", ["segment", "churn"]))
def q_margin_by_segment(spark, sf):
    """E1 + A16: margin distribution per segment x churn."""
    return RP.margin_by(_gold(spark, sf), ["segment", "churn"])


@register("report_renewal_timing", G + _describe_sql("months_to_renewal", ["churn"]))
def q_renewal_timing(spark, sf):
    """Months to renewal by churn label."""
    return RP.renewal_timing(_gold(spark, sf))


@register("report_channel_profile", G + """ SELECT sales_channel, count(*) AS customers,
    avg(CAST(churn AS DOUBLE)) AS churn_rate, quantile_cont(tenure_months, 0.5) AS median_tenure,
    quantile_cont(avg_monthly_margin, 0.5) AS median_margin, quantile_cont(std_margin, 0.5) AS median_margin_volatility
  FROM gold WHERE sales_channel IS NOT NULL GROUP BY sales_channel""")
def q_channel_profile(spark, sf):
    """E7 + A21: per channel customers, churn, median tenure / margin / volatility."""
    return RP.channel_profile(_gold(spark, sf))


@register("report_competition_profile", G + """ SELECT *, median_margin * churn_rate * customers AS profit_at_risk
  FROM (SELECT is_high_competition_province, count(*) AS customers, avg(CAST(churn AS DOUBLE)) AS churn_rate,
               quantile_cont(avg_monthly_margin, 0.5) AS median_margin,
               quantile_cont(total_margin_2024, 0.5) AS median_total_margin,
               quantile_cont(avg_monthly_elec_kwh, 0.5) AS median_elec_kwh
        FROM gold WHERE is_high_competition_province IS NOT NULL GROUP BY 1)""")
def q_competition(spark, sf):
    """E8 + F23: competition split with profit at risk."""
    return RP.competition_profile(_gold(spark, sf))


@register("report_churn_pivot_segment_renewal", G + """ SELECT segment,
    avg(CASE WHEN renewal_bucket = 'expired' THEN CAST(churn AS DOUBLE) END) AS "expired",
    avg(CASE WHEN renewal_bucket = '0-3m' THEN CAST(churn AS DOUBLE) END) AS "0-3m",
    avg(CASE WHEN renewal_bucket = '3-6m' THEN CAST(churn AS DOUBLE) END) AS "3-6m",
    avg(CASE WHEN renewal_bucket = '6-12m' THEN CAST(churn AS DOUBLE) END) AS "6-12m",
    avg(CASE WHEN renewal_bucket = '12m+' THEN CAST(churn AS DOUBLE) END) AS "12m+"
  FROM gold WHERE segment IS NOT NULL AND renewal_bucket IS NOT NULL GROUP BY segment""")
def q_pivot(spark, sf):
    """A18 + E6: churn-rate matrix segment x renewal bucket."""
    from voltchurn.constants import RENEWAL_LABELS

    return RP.churn_pivot(_gold(spark, sf), "segment", "renewal_bucket", RENEWAL_LABELS)


@register("report_interaction_quintiles", G + """,
  e AS (SELECT list_distinct(quantile_cont(months_to_renewal, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0])) AS _e0 FROM gold),
  e2 AS (SELECT list_sort(_e0) AS _e FROM e),
  b AS (SELECT g.*, CASE WHEN months_to_renewal IS NOT NULL AND months_to_renewal >= _e[1]
                          AND months_to_renewal <= _e[len(_e)]
                    THEN CAST(len(list_filter(list_slice(_e, 2, greatest(len(_e) - 1, 1)),
                                              lambda x: x < months_to_renewal)) AS INTEGER) END AS renewal_quintile
        FROM gold g, e2)
  SELECT renewal_quintile, count(*) AS customers, avg(CAST(churn AS DOUBLE)) AS churn_rate,
         avg(CAST(coalesce(has_interaction, 0) AS DOUBLE)) AS interaction_rate
  FROM b WHERE renewal_quintile IS NOT NULL GROUP BY 1""")
def q_quintiles(spark, sf):
    """E10 + W9: churn and interaction rate per renewal-distance quintile (qcut, duplicate edges dropped)."""
    return RP.interaction_quintiles(_gold(spark, sf))


@register("report_interaction_timing", G + """ SELECT days_bucket, count(*) AS customers,
    avg(CAST(churn AS DOUBLE)) AS churn_rate FROM (
      SELECT *, CASE WHEN _d < 30 THEN '0-30d' WHEN _d < 90 THEN '30-90d' WHEN _d < 180 THEN '90-180d'
                     WHEN _d < 365 THEN '180-365d' ELSE '365d+' END AS days_bucket
      FROM (SELECT *, date_diff('day', CAST(date AS DATE), CAST(next_renewal_date AS DATE)) AS _d FROM sc)
      WHERE has_interaction = 1 AND _d IS NOT NULL AND _d >= 0)
  GROUP BY days_bucket""")
def q_interaction_timing(spark, sf):
    """E14 + F8(right=False): churn by days from interaction to renewal."""
    return RP.interaction_timing(_silver(spark, sf)["silver_customer"])


_PRE = """,
  pr AS (SELECT m.customer_id, s.churn, m.total_margin,
                date_diff('day', CAST(m.month || '-01' AS DATE), CAST(s.next_renewal_date AS DATE)) / 30.0 AS _m
         FROM scm m JOIN sc s ON m.customer_id = s.customer_id),
  pw AS (SELECT customer_id, churn,
                avg(CASE WHEN _m > 0 AND _m <= 3 THEN total_margin END) AS near,
                avg(CASE WHEN _m > 3 AND _m <= 6 THEN total_margin END) AS earlier
         FROM pr WHERE _m BETWEEN 0 AND 6 GROUP BY customer_id, churn),
  tr AS (SELECT *, near - earlier AS trend FROM pw WHERE near IS NOT NULL AND earlier IS NOT NULL)"""


@register("report_pre_renewal_margin_trend", G + _PRE + _describe_sql("trend", ["churn"], src="tr"))
def q_pre_renewal(spark, sf):
    """E3 + W8 + J15: margin 0-3 m before renewal minus 3-6 m before, described by churn."""
    L = _silver(spark, sf)
    return RP.pre_renewal_by_churn(L["silver_customer_month"], L["silver_customer"])


@register("report_volatility_by_churn", G + """,
  per AS (SELECT customer_id, stddev_samp(total_margin) AS margin_std FROM scm GROUP BY 1),
  pv AS (SELECT per.*, sc.churn FROM per JOIN sc ON per.customer_id = sc.customer_id)"""
          + _describe_sql("margin_std", ["churn"], src="pv"))
def q_volatility(spark, sf):
    """Per-customer margin volatility described by churn."""
    L = _silver(spark, sf)
    return RP.volatility_by_churn(L["silver_customer_month"], L["silver_customer"])


@register("report_crosstab_intent_churn", G + """ SELECT
    CASE WHEN GROUPING(customer_intent) = 1 THEN 'All' ELSE customer_intent END AS customer_intent,
    CASE WHEN GROUPING(churn) = 1 THEN 'All' ELSE churn END AS churn, count(*) AS n
  FROM (SELECT customer_intent, CAST(churn AS VARCHAR) AS churn FROM gold
        WHERE customer_intent IS NOT NULL AND churn IS NOT NULL)
  GROUP BY CUBE (customer_intent, churn)""")
def q_crosstab(spark, sf):
    """Intent x churn contingency counts with All margins."""
    return RP.crosstab_report(_gold(spark, sf), "customer_intent", "churn")


@register("report_chi_square_intent_churn", G + """,
  cells AS (SELECT customer_intent AS a, CAST(churn AS VARCHAR) AS b, count(*) AS n FROM gold
            WHERE customer_intent IS NOT NULL AND churn IS NOT NULL GROUP BY 1, 2),
  r AS (SELECT a, CAST(sum(n) AS DOUBLE) AS rt FROM cells GROUP BY a),
  c AS (SELECT b, CAST(sum(n) AS DOUBLE) AS ct FROM cells GROUP BY b),
  tot AS (SELECT sum(rt) AS nn, count(*) AS nr, sum(1.0 / rt) AS ir FROM r),
  ctot AS (SELECT count(*) AS nc, sum(1.0 / ct) AS ic FROM c),
  o AS (SELECT sum(n * n / (rt * ct / nn)) AS s, max(abs(n - rt * ct / nn)) AS d
        FROM cells JOIN r USING (a) JOIN c USING (b), tot)
  SELECT CASE WHEN (nr - 1) * (nc - 1) = 1
              THEN (d - least(0.5, d)) * (d - least(0.5, d)) * nn * ir * ic ELSE s - nn END AS statistic,
         CAST((nr - 1) * (nc - 1) AS BIGINT) AS dof, CAST(nn AS BIGINT) AS n
  FROM o, tot, ctot""")
def q_chi_square(spark, sf):
    """A20 + E13: chi-square statistic and dof of intent vs churn (p-value checked in tests)."""
    return RP.intent_chi_square(_gold(spark, sf)).select("statistic", "dof", "n")


_CORR_COLS = ["avg_monthly_elec_kwh", "tenure_months", "months_to_renewal", "avg_monthly_margin",
              "price_update_count", "last_interaction_days_ago", "gas_share_of_revenue", "std_margin",
              "is_within_3m_of_renewal", "is_high_competition_province", "intent_severity_score", "sentiment_neg"]


@register("report_corr_with_churn", G + " SELECT feature, corr FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, covar_samp({c}, churn) FILTER (WHERE {c} IS NOT NULL AND churn IS NOT NULL) / "
    f"nullif(stddev_samp({c}) FILTER (WHERE {c} IS NOT NULL AND churn IS NOT NULL) * "
    f"stddev_samp(churn) FILTER (WHERE {c} IS NOT NULL AND churn IS NOT NULL), 0) AS corr FROM gold"
    for c in _CORR_COLS) + ")")
def q_corr(spark, sf):
    """Pearson correlation of numeric features with churn."""
    return S.corr_with(_gold(spark, sf), "churn", _CORR_COLS)


@register("report_segment_share", G + """ SELECT segment, customers,
    round_even(customers * 100.0 / sum(customers) OVER (), 1) AS share_pct
  FROM (SELECT segment, count(*) AS customers FROM gold WHERE segment IS NOT NULL GROUP BY 1)""")
def q_segment_share(spark, sf):
    """E19 + A17: segment share in percent."""
    return RP.segment_share(_gold(spark, sf))


@register("report_margin_box_by_churn", G + """ SELECT churn, min(avg_monthly_margin) AS min,
    quantile_cont(avg_monthly_margin, 0.25) AS q1, quantile_cont(avg_monthly_margin, 0.5) AS median,
    quantile_cont(avg_monthly_margin, 0.75) AS q3, max(avg_monthly_margin) AS max
  FROM gold WHERE churn IS NOT NULL GROUP BY churn""")
def q_margin_box(spark, sf):
    """Five-number margin summary by churn."""
    return RP.margin_box(_gold(spark, sf))


@register("report_worst_months", G + """ SELECT customer_id, month, total_margin FROM scm
  ORDER BY total_margin, customer_id, month LIMIT 20""")
def q_worst_months(spark, sf):
    """The 20 lowest-margin customer-months (a top-k report)."""
    return RP.worst_months(_silver(spark, sf)["silver_customer_month"])


@register("report_worst_corporate_months", G + """ SELECT m.month, sum(m.total_margin) AS total_margin
  FROM scm m JOIN sc s ON m.customer_id = s.customer_id WHERE s.segment = 'Corporate'
  GROUP BY m.month ORDER BY 2, 1 LIMIT 12""")
def q_worst_corporate_months(spark, sf):
    """The 12 Corporate months with the lowest total margin (a top-k report)."""
    L = _silver(spark, sf)
    return RP.worst_segment_months(L["silver_customer_month"], L["silver_customer"])


_TEXTS = """ SELECT customer_id, interaction_summary, sentiment_label, sentiment_neg, sentiment_neu, sentiment_pos
  FROM sc WHERE sentiment_label IS NOT NULL ORDER BY {} DESC, customer_id LIMIT 50"""


@register("report_most_negative_texts", G + _TEXTS.format("sentiment_neg"))
def q_most_negative(spark, sf):
    """T5: the 50 most negative interactions (a top-k report)."""
    return RP.extreme_texts(_silver(spark, sf)["silver_customer"], "sentiment_neg")


@register("report_most_positive_texts", G + _TEXTS.format("sentiment_pos"))
def q_most_positive(spark, sf):
    """T5: the 50 most positive interactions (a top-k report)."""
    return RP.extreme_texts(_silver(spark, sf)["silver_customer"], "sentiment_pos")


@register("report_segment_facets", G + " SELECT DISTINCT segment FROM sc WHERE segment IS NOT NULL")
def q_segment_facets(spark, sf):
    """The values a segment facet offers."""
    return RP.facet_values(_silver(spark, sf)["silver_customer"], "segment")


@register("report_corporate_margin_per_kwh", G + """ SELECT m.customer_id, m.month,
    m.elec_margin / m.monthly_elec_kwh AS elec_margin_per_kwh
  FROM scm m JOIN sc s ON m.customer_id = s.customer_id
  WHERE s.segment = 'Corporate' AND m.monthly_elec_kwh > 0""")
def q_margin_per_kwh(spark, sf):
    """F22 + J10 + P16: Corporate months' electricity margin per kWh."""
    L = _silver(spark, sf)
    return RP.margin_per_kwh(L["silver_customer_month"], L["silver_customer"], "Corporate")


# --------------------------------------------------------------- quality ----
from voltchurn.constants import PRICE_CONSUMPTION_PAIRS  # noqa: E402
from voltchurn.plans import quality as Q  # noqa: E402

BC_COLS = ["customer_id", "churn", "province_code", "is_industrial", "contracted_power_kw", "is_second_residence",
           "sales_channel", "is_high_competition_province", "contract_start_date", "next_renewal_date",
           "last_product_change_date", "date", "interaction_summary", "channel", "customer_intent", "has_interaction",
           "sentiment_neg", "sentiment_neu", "sentiment_pos", "sentiment_label"]
SCM_NUM = ["is_industrial", "monthly_elec_kwh", "monthly_gas_m3", "monthly_gas_kwh", "elec_kwh_tier_1_peak",
           "elec_kwh_tier_2_standard", "elec_kwh_tier_3_offpeak", "gas_m3_tier_1_peak", "gas_m3_tier_2_standard",
           "gas_m3_tier_3_offpeak", "gas_kwh_tier_1_peak", "gas_kwh_tier_2_standard", "gas_kwh_tier_3_offpeak",
           "variable_price_tier1_eur_kwh", "variable_price_tier2_eur_kwh", "variable_price_tier3_eur_kwh",
           "gas_variable_price_eur_m3", "elec_fixed_fee_eur_month", "gas_fixed_revenue_eur_year",
           "elec_var_cost_eur_kwh", "peaje_elec_eur_kwh", "elec_fixed_cost_eur_month", "gas_var_cost_eur_m3",
           "gas_fixed_cost_eur_year", "elec_revenue_variable", "elec_revenue_fixed", "elec_cost_variable",
           "elec_cost_fixed", "gas_revenue_variable", "gas_revenue_fixed", "gas_cost_variable", "gas_cost_fixed",
           "elec_margin", "gas_margin", "total_revenue", "total_cost", "total_margin"]


def _profile_sql(src, text_cols, num_cols):
    parts = []
    for c in text_cols:
        parts.append(f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
                     f"round_even(count(*) FILTER (WHERE {c} IS NULL) / count(*), 4) AS null_rate, "
                     f"CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max FROM {src}")
    for c in num_cols:
        parts.append(f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL OR isnan({c})) AS nulls, "
                     f"round_even(count(*) FILTER (WHERE {c} IS NULL OR isnan({c})) / count(*), 4) AS null_rate, "
                     f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM {src}")
    return " " + " UNION ALL ".join(parts)


@register("quality_profile_silver_month", G + _profile_sql("scm", ["customer_id", "month"], SCM_NUM))
def q_profile(spark, sf):
    """Q1 per column: nulls, null rate (4 dp), numeric min / max of silver customer-month."""
    return Q.column_profile(_silver(spark, sf)["silver_customer_month"], "silver").select(
        "column", "nulls", "null_rate", "min", "max")


def _summary_sql():
    nulls = " + ".join(f"CASE WHEN count(*) FILTER (WHERE {c} IS NULL) / count(*) > 0.5 THEN 1 ELSE 0 END"
                       for c in BC_COLS)
    return (G + f""",
  ni AS (SELECT count(*) AS row_count, {nulls} AS _ni FROM bc),
  dk AS (SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS duplicate_keys
         FROM (SELECT customer_id, count(*) AS c FROM bc GROUP BY 1 HAVING count(*) > 1))
  SELECT 'bronze' AS layer, row_count, {len(BC_COLS)} AS column_count, duplicate_keys,
         CAST(_ni + CASE WHEN row_count = 0 THEN 1 ELSE 0 END + CASE WHEN duplicate_keys > 0 THEN 1 ELSE 0 END
              AS BIGINT) AS n_issues,
         (_ni + CASE WHEN row_count = 0 THEN 1 ELSE 0 END + CASE WHEN duplicate_keys > 0 THEN 1 ELSE 0 END) = 0
           AS passed
  FROM ni, dk""")


@register("quality_summary_bronze_customer", _summary_sql())
def q_quality_summary(spark, sf):
    """Q1 summary: rows, columns, duplicate-key rows, issues, pass for bronze customer."""
    return Q.quality_summary(_bronze(spark, sf)["bronze_customer"], "bronze")


def _price_validity_sql():
    items = [("elec_tier1", *PRICE_CONSUMPTION_PAIRS[0]), ("elec_tier2", *PRICE_CONSUMPTION_PAIRS[1]),
             ("elec_tier3", *PRICE_CONSUMPTION_PAIRS[2]), ("gas_var_m3", *PRICE_CONSUMPTION_PAIRS[3])]
    parts = []
    for label, p, c in items:
        u = f"coalesce({c}, 0) > 0"
        parts.append(
            f"SELECT '{label}' AS item, '{c}' AS consumption_col, '{p}' AS price_col, "
            f"count(*) FILTER (WHERE {u}) AS rows_with_consumption, "
            f"count(*) FILTER (WHERE {p} IS NULL AND {u}) AS price_missing_where_used, "
            f"count(*) FILTER (WHERE coalesce({p}, 0) = 0 AND {u}) AS price_zero_where_used, "
            f"count(*) FILTER (WHERE ({p} IS NULL OR {p} = 0) AND {u}) AS price_missing_or_zero_where_used "
            f"FROM bcm")
    return G + " " + " UNION ALL ".join(parts)


@register("quality_price_validity", _price_validity_sql())
def q_price_validity(spark, sf):
    """Q9: prices missing / zero where consumption exists, before imputation."""
    return Q.price_validity(_bronze(spark, sf)["bronze_customer_month"])


@register("quality_remaining_missing", G + " " + " UNION ALL ".join(
    f"SELECT '{p}' AS price_col, count(*) FILTER (WHERE {p} IS NULL AND coalesce({c}, 0) > 0) AS remaining_missing "
    f"FROM scm" for p, c in PRICE_CONSUMPTION_PAIRS))
def q_remaining(spark, sf):
    """Q15: prices still missing after imputation where consumption exists."""
    return Q.remaining_missing(_silver(spark, sf)["silver_customer_month"])


@register("quality_grain_silver_month", G + """ SELECT count(*) AS rows,
    (SELECT count(*) FROM (SELECT DISTINCT customer_id, month FROM scm
                           WHERE customer_id IS NOT NULL AND month IS NOT NULL)) AS unique_keys,
    count(*) - (SELECT count(*) FROM (SELECT DISTINCT customer_id, month FROM scm
                                      WHERE customer_id IS NOT NULL AND month IS NOT NULL)) AS duplicate_rows
  FROM scm""")
def q_grain(spark, sf):
    """Q11: rows, distinct (customer, month) keys and duplicates of silver customer-month."""
    return Q.grain_report(_silver(spark, sf)["silver_customer_month"], ["customer_id", "month"])


@register("quality_min_values", G + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(min({c}) AS DOUBLE) AS min_value FROM scm"
    for c in ("monthly_elec_kwh", "monthly_gas_m3", "monthly_gas_kwh")))
def q_min_values(spark, sf):
    """Q12: minimum monthly readings (no impossible values)."""
    return Q.minimum_values(_silver(spark, sf)["silver_customer_month"])


@register("quality_negative_readings", V.with_(V.CONSUMPTION_EVENTS) + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS measure, count(*) FILTER (WHERE {c} < 0) AS negative_rows, "
    f"count(*) FILTER (WHERE {c} < 0) / count(*) AS negative_share, "
    f"coalesce(sum({c}) FILTER (WHERE {c} < 0), 0.0) AS negative_total, min({c}) AS min_value FROM consumption"
    for c in ("consumption_elec_kwh", "consumption_gas_m3")))
def q_negative(spark, sf):
    """P3 + P4: negative-reading audit of the hourly readings."""
    return Q.negative_reading_audit(si.consumption_from_events(spark, sf))


@register("quality_leakage_check", G + """ SELECT (SELECT max(month) FROM scm) AS max_month,
    max(CAST(date AS DATE)) AS max_interaction_date, avg(CAST(churn AS DOUBLE)) AS churn_share,
    count(DISTINCT customer_id) AS customers FROM sc""")
def q_leakage(spark, sf):
    """Q14: snapshot leakage check (latest month, latest interaction) and label balance."""
    L = _silver(spark, sf)
    return Q.leakage_check(L["silver_customer_month"], L["silver_customer"])


# ----------------------------------------------------------------- drift ----
from voltchurn.plans import drift as D  # noqa: E402

_SPLIT_TS = "2024-01-16"


def _events_long(spark, sf):
    e = si.table(spark, sf, "events")
    ref = e.filter(F.col("ts") < F.lit(_SPLIT_TS).cast("timestamp_ntz")).select(
        F.col("event_type").alias("feature"), "value")
    cur = e.filter(F.col("ts") >= F.lit(_SPLIT_TS).cast("timestamp_ntz")).select(
        F.col("event_type").alias("feature"), "value")
    return ref, cur


_KS_SQL = f"""WITH
  u AS (SELECT event_type AS feature, value, CASE WHEN ts < TIMESTAMP '{_SPLIT_TS}' THEN 0 ELSE 1 END AS side
        FROM events WHERE value IS NOT NULL AND NOT isnan(value)),
  cnt AS (SELECT feature, value, CAST(count(*) FILTER (WHERE side = 0) AS DOUBLE) AS c0,
                 CAST(count(*) FILTER (WHERE side = 1) AS DOUBLE) AS c1 FROM u GROUP BY 1, 2),
  sz AS (SELECT feature, sum(c0) AS n_ref, sum(c1) AS n_cur FROM cnt GROUP BY 1),
  cum AS (SELECT feature, sum(c0) OVER w AS s0, sum(c1) OVER w AS s1 FROM cnt
          WINDOW w AS (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
  d AS (SELECT cum.feature, max(abs(s0 / n_ref - s1 / n_cur)) AS ks_statistic FROM cum JOIN sz USING (feature)
        GROUP BY 1),
  r AS (SELECT d.feature, ks_statistic, n_ref, n_cur, sqrt(n_ref * n_cur / (n_ref + n_cur)) * ks_statistic AS lam
        FROM d JOIN sz USING (feature) WHERE n_ref > 0 AND n_cur > 0),
  ser AS (SELECT feature, 2.0 * sum(power(-1.0, k - 1) * exp(-2.0 * k * k * lam * lam)) AS s
          FROM r, range(1, 101) t(k) GROUP BY feature),
  res AS (SELECT r.feature, ks_statistic, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur,
                 CASE WHEN lam < 0.2 THEN 1.0 ELSE least(greatest(s, 0.0), 1.0) END AS p_value
          FROM r JOIN ser USING (feature))"""


@register("drift_events_by_type", _KS_SQL + " SELECT *, p_value < 0.01 AS drifted FROM res")
def q_drift(spark, sf):
    """Q2: two-sample KS per event type, first vs second half of the month."""
    ref, cur = _events_long(spark, sf)
    return D.drift_long(ref, cur, exact=False)


_PRED_KS = V.with_(V.LABELLED_SCORES) + """,
  p_cnt AS (SELECT score AS value, CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE) AS c0,
                   CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS c1 FROM labelled
            WHERE score IS NOT NULL AND NOT isnan(score) AND label IS NOT NULL GROUP BY 1),
  p_sz AS (SELECT sum(c0) AS n_ref, sum(c1) AS n_cur FROM p_cnt),
  p_cum AS (SELECT sum(c0) OVER w AS s0, sum(c1) OVER w AS s1 FROM p_cnt
            WINDOW w AS (ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
  p_d AS (SELECT max(abs(s0 / n_ref - s1 / n_cur)) AS ks_statistic, any_value(n_ref) AS n_ref,
                 any_value(n_cur) AS n_cur FROM p_cum, p_sz),
  p_lam AS (SELECT *, sqrt(n_ref * n_cur / (n_ref + n_cur)) * ks_statistic AS lam FROM p_d),
  pred AS (SELECT 'score' AS feature, ks_statistic, CASE WHEN lam < 0.2 THEN 1.0 ELSE least(greatest(
             (SELECT 2.0 * sum(power(-1.0, k - 1) * exp(-2.0 * k * k * lam * lam)) FROM range(1, 101) t(k)), 0.0), 1.0)
             END AS p_value FROM p_lam)"""


def _prediction_drift(spark, sf):
    # stand-in samples of one score column: documents labelled 0 against those labelled 1
    s = si.labelled_scores(spark, sf).filter("label IS NOT NULL")
    return D.prediction_drift(s.filter("label = 0").select("score"), s.filter("label = 1").select("score"), "score", exact=False)


@register("drift_prediction", _PRED_KS + " SELECT *, p_value < 0.01 AS drifted FROM pred")
def q_drift_prediction(spark, sf):
    """Q3: two-sample KS on a score column."""
    return _prediction_drift(spark, sf)


_SUMMARY = _KS_SQL + """,
  fr AS (SELECT *, p_value < 0.01 AS drifted FROM res),
  f AS (SELECT count(*) FILTER (WHERE drifted) AS n, string_agg(feature, ', ' ORDER BY feature)
               FILTER (WHERE drifted) AS names FROM fr),
  summary AS (SELECT n > 0 OR pd AS any_drift, CAST(n AS BIGINT) AS n_features_drifted,
         CASE WHEN n > 0 AND pd THEN 'Feature drift detected in: ' || names || chr(10) || line
              WHEN n > 0 THEN 'Feature drift detected in: ' || names
              WHEN pd THEN line ELSE 'No drift detected.' END AS summary
  FROM f, (SELECT p_value < 0.01 AS pd, printf('Prediction drift: KS=%.4f', ks_statistic) AS line FROM pred))"""


def _with_prediction(sql):
    return _PRED_KS + ", " + sql.strip()[len("WITH"):].strip()


def _drift_summary(spark, sf):
    ref, cur = _events_long(spark, sf)
    return D.drift_summary(D.drift_long(ref, cur, exact=False), _prediction_drift(spark, sf))


@register("drift_summary_events", _with_prediction(_SUMMARY) + " SELECT * FROM summary")
def q_drift_summary(spark, sf):
    """Q4: drift summary over the per-type KS results and the score column's."""
    return _drift_summary(spark, sf)


@register("drift_metrics", _with_prediction(_SUMMARY) + """ SELECT 'DriftDetected' AS metric, CAST(any_drift AS DOUBLE) AS value
  FROM summary UNION ALL SELECT 'FeaturesDrifted', CAST(n_features_drifted AS DOUBLE) FROM summary""")
def q_drift_metrics(spark, sf):
    """Q8: the drift summary as metric rows."""
    return D.drift_metrics(_drift_summary(spark, sf))


# --------------------------------------------------------------- metrics ----
_LAB = V.with_(V.LABELLED_SCORES) + """,
  st AS (SELECT score, CAST(sum(label) AS DOUBLE) AS pos, CAST(sum(1 - label) AS DOUBLE) AS neg FROM labelled
         WHERE score IS NOT NULL GROUP BY score),
  tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM st),
  c AS (SELECT st.*, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM st
        WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
  curve AS (SELECT score AS threshold, tp, fp, tp / (tp + fp) AS precision,
                   CASE WHEN P > 0 THEN tp / P END AS recall, P, N, pos, neg FROM c, tot)"""


@register("metrics_ap_roc", _LAB + """ SELECT sum(pos / P * precision) AS pr_auc,
    sum(pos * ((N - fp) + 0.5 * neg)) / (max(P) * max(N)) AS roc_auc FROM curve""")
def q_ap_roc(spark, sf):
    """M8: average precision (step rule) and ROC-AUC (tied ranks) of length scores vs quality labels."""
    return S.ranking_metrics(si.labelled_scores(spark, sf), "label", "score")


@register("metrics_pr_curve", _LAB + " SELECT * FROM curve")
def q_pr_curve(spark, sf):
    """Precision / recall at every distinct score."""
    return S.pr_curve(si.labelled_scores(spark, sf), "label", "score")


@register("metrics_threshold", _LAB + """,
  cand AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-12) AS f1 FROM curve
           WHERE threshold >= (SELECT max(threshold) FROM curve WHERE tp >= P)),
  v AS (SELECT threshold FROM cand WHERE recall >= 0.7 ORDER BY precision DESC, threshold ASC LIMIT 1),
  f AS (SELECT threshold FROM cand ORDER BY f1 DESC, threshold ASC LIMIT 1)
  SELECT coalesce((SELECT threshold FROM v), (SELECT threshold FROM f)) AS threshold,
         (SELECT count(*) FROM v) = 0 AS used_f1_fallback""")
def q_threshold(spark, sf):
    """M7: highest precision with recall >= 0.70 (else best F1)."""
    return S.pick_threshold(si.labelled_scores(spark, sf), "label", "score", 0.70)


@register("metrics_confusion", V.with_(V.LABELLED_SCORES) + """ SELECT *,
    CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
    CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
    CASE WHEN (CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END)
              + (CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END) > 0
         THEN 2 * (CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END)
                * (CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END)
              / ((CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END)
                 + (CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END)) ELSE 0.0 END AS f1,
    (tp + tn) / (tp + fp + fn + tn) AS accuracy, CAST(0.5 AS DOUBLE) AS threshold
  FROM (SELECT CAST(count(*) FILTER (WHERE score >= 0.5 AND label = 1) AS BIGINT) AS tp,
               CAST(count(*) FILTER (WHERE score >= 0.5 AND label = 0) AS BIGINT) AS fp,
               CAST(count(*) FILTER (WHERE score < 0.5 AND label = 1) AS BIGINT) AS fn,
               CAST(count(*) FILTER (WHERE score < 0.5 AND label = 0) AS BIGINT) AS tn FROM labelled)""")
def q_confusion(spark, sf):
    """Confusion counts and rates at threshold 0.5."""
    return S.confusion_metrics(si.labelled_scores(spark, sf), "label", "score", 0.5)


@register("metrics_calibration_curve", V.with_(V.LABELLED_SCORES) + """,
  e AS (SELECT quantile_cont(score, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS q FROM labelled)
  SELECT CAST(len(list_filter(list_slice(q, 2, 10), lambda x: x < score)) AS INTEGER) AS bin, count(*) AS n,
         avg(CAST(label AS DOUBLE)) AS prob_true, avg(score) AS prob_pred
  FROM labelled, e WHERE score IS NOT NULL GROUP BY 1""")
def q_calibration(spark, sf):
    """10 equal-frequency bins: observed rate vs mean score."""
    return S.calibration_curve(si.labelled_scores(spark, sf), "label", "score", 10)


@register("metrics_calibration_gap", V.with_(V.LABELLED_SCORES) + """,
  e AS (SELECT quantile_cont(score, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS q FROM labelled),
  b AS (SELECT len(list_filter(list_slice(q, 2, 10), lambda x: x < score)) AS bin,
               avg(CAST(label AS DOUBLE)) AS t, avg(score) AS p FROM labelled, e WHERE score IS NOT NULL GROUP BY 1)
  SELECT avg(abs(t - p)) AS mean_calibration_gap FROM b""")
def q_calibration_gap(spark, sf):
    """Mean absolute gap of the calibration curve."""
    return S.calibration_gap(S.calibration_curve(si.labelled_scores(spark, sf), "label", "score", 10))


# ------------------------------------------------ scoring and recommendations ----
from voltchurn.plans import model as M  # noqa: E402
from voltchurn.plans import recommend as RC  # noqa: E402

_SCORED = G + "," + V.MODEL_OUTPUT.strip() + """,
  scored AS (
    SELECT g.customer_id, g.churn AS churn_actual, round_even(m.proba, 4) AS churn_proba,
           CAST(round_even(m.proba, 4) >= 0.5 AS INTEGER) AS churn_pred,
           g.avg_monthly_margin, g.total_margin_2024, g.segment,
           round_even(round_even(m.proba, 4) * CASE WHEN g.avg_monthly_margin < 0 THEN 0.0
                                               ELSE g.avg_monthly_margin END, 2) AS expected_monthly_loss,
           CASE WHEN round_even(m.proba, 4) IS NULL THEN NULL
                WHEN round_even(m.proba, 4) >= 0 AND round_even(m.proba, 4) < 0.4 THEN 'Low (<40%)'
                WHEN round_even(m.proba, 4) >= 0.4 AND round_even(m.proba, 4) < 0.6 THEN 'Medium (40-60%)'
                WHEN round_even(m.proba, 4) >= 0.6 AND round_even(m.proba, 4) < 0.8 THEN 'High (60-80%)'
                WHEN round_even(m.proba, 4) >= 0.8 AND round_even(m.proba, 4) < 1.01 THEN 'Critical (>80%)' END
             AS risk_tier
    FROM model_out m LEFT JOIN gold g ON m.customer_id = g.customer_id),
  reco AS (
    SELECT customer_id, coalesce(churn_proba, 0.0) AS risk_score, coalesce(segment, 'Unknown') AS segment,
      CASE WHEN coalesce(avg_monthly_margin, 0.0) < 0 THEN 'no_offer'
           ELSE coalesce(CASE coalesce(risk_tier, 'Low (<40%)') WHEN 'Low (<40%)' THEN 'no_offer'
                  WHEN 'Medium (40-60%)' THEN 'offer_small' WHEN 'High (60-80%)' THEN 'offer_medium'
                  WHEN 'Critical (>80%)' THEN 'offer_large' END, 'no_offer') END AS action,
      coalesce(CASE coalesce(risk_tier, 'Low (<40%)') WHEN 'Low (<40%)' THEN '60_90_days'
                  WHEN 'Medium (40-60%)' THEN '30_60_days' WHEN 'High (60-80%)' THEN 'immediate'
                  WHEN 'Critical (>80%)' THEN 'immediate' END, '60_90_days') AS timing_window,
      coalesce(expected_monthly_loss, 0.0) AS expected_margin_impact,
      list_filter([CASE WHEN coalesce(churn_proba, 0.0) >= 0.8 THEN 'critical_churn_risk'
                        WHEN coalesce(churn_proba, 0.0) >= 0.6 THEN 'high_churn_risk'
                        WHEN coalesce(churn_proba, 0.0) >= 0.4 THEN 'moderate_churn_risk' END,
                   CASE WHEN contains(coalesce(risk_tier, ''), 'Critical') THEN 'churn_probability_above_80pct'
                        WHEN contains(coalesce(risk_tier, ''), 'High') THEN 'churn_probability_above_60pct' END,
                   CASE WHEN segment IS NOT NULL AND segment <> '' THEN 'segment_' || lower(segment) END],
                  lambda x: x IS NOT NULL) AS _codes
    FROM scored),
  reco2 AS (SELECT * EXCLUDE (_codes),
                   CASE WHEN len(_codes) > 0 THEN _codes ELSE ['low_risk_monitoring'] END AS reason_codes
            FROM reco)"""


def _scored(spark, sf):
    # the stand-in model output sits next to the business columns: score in one projection
    return M.score_frame(si.model_output_from_gold(_gold(spark, sf), keep_columns=True), threshold=0.5)


def _reco(spark, sf, scored=None):
    return RC.validated(RC.recommendations(scored if scored is not None else _scored(spark, sf)))


@register("scored_customers", _SCORED + " SELECT * FROM scored")
def q_scored(spark, sf):
    """M13 + M14 + F15 + F16: probability (4 dp), prediction, business columns, expected loss, tier."""
    return _scored(spark, sf)


@register("model_tier_summary", _SCORED + """ SELECT risk_tier, count(*) AS customers,
    CAST(sum(churn_pred) AS BIGINT) AS flagged, avg(churn_proba) AS avg_proba, avg(avg_monthly_margin) AS avg_margin,
    avg(expected_monthly_loss) AS avg_expected_loss FROM scored GROUP BY risk_tier""")
def q_tier_summary(spark, sf):
    """Per tier customers, flagged, mean probability / margin / loss."""
    return M.tier_summary(_scored(spark, sf))


@register("model_flagged_by_segment", _SCORED + """ SELECT segment, count(*) AS flagged, avg(churn_proba) AS avg_proba,
    coalesce(sum(expected_monthly_loss), 0.0) AS total_expected_loss FROM scored WHERE churn_pred = 1
    GROUP BY segment""")
def q_flagged(spark, sf):
    """Flagged customers by segment."""
    return M.flagged_by_segment(_scored(spark, sf))


@register("report_tier_counts", _SCORED + """ SELECT risk_tier, customers, customers / sum(customers) OVER () AS share
  FROM (SELECT risk_tier, count(*) AS customers FROM scored WHERE risk_tier IS NOT NULL GROUP BY 1)""")
def q_tier_counts(spark, sf):
    """E18 + A17: customers and share per risk tier."""
    return RP.tier_counts(_scored(spark, sf))


@register("report_kpis", _SCORED + """ SELECT *, round_even(CASE WHEN scored_customers > 0
    THEN (critical + high) * 100.0 / scored_customers ELSE 0.0 END, 1) AS at_risk_pct
  FROM (SELECT count(*) AS scored_customers, count(*) FILTER (WHERE risk_tier = 'Critical (>80%)') AS critical,
               count(*) FILTER (WHERE risk_tier = 'High (60-80%)') AS high,
               coalesce(sum(expected_monthly_loss), 0.0) AS total_expected_monthly_loss FROM scored)""")
def q_kpis(spark, sf):
    """Executive KPIs over the scored table."""
    return RP.kpis(_scored(spark, sf))


@register("report_top_risk", _SCORED + " SELECT * FROM scored ORDER BY churn_proba DESC, customer_id LIMIT 50")
def q_top_risk(spark, sf):
    """T3 + T2 + E18: the 50 highest-risk customers (a top-k report)."""
    return RP.top_risk(_scored(spark, sf), 50)


@register("reco_recommendations", _SCORED + """ SELECT * EXCLUDE (reason_codes),
    array_to_string(reason_codes, '|') AS reason_codes FROM reco2""")
def q_reco(spark, sf):
    """Action, timing, impact and reason codes per customer (contract-checked)."""
    return _reco(spark, sf).withColumn("reason_codes", F.array_join("reason_codes", "|"))


_SHARE = """CASE r.action WHEN 'offer_large' THEN 0.25 WHEN 'offer_medium' THEN 0.15
                      WHEN 'offer_small' THEN 0.05 ELSE 0.0 END"""
_FINANCIALS = _SCORED + f""",
  money AS (SELECT r.customer_id, r.action, r.timing_window, array_to_string(r.reason_codes, '|') AS reason_codes,
              r.risk_score * coalesce(s.avg_monthly_margin, 0.0) AS monthly_expected_loss,
              {_SHARE} * coalesce(s.avg_monthly_margin, 0.0) AS offer_cost
            FROM reco2 r LEFT JOIN scored s ON r.customer_id = s.customer_id),
  fin AS (SELECT *, monthly_expected_loss * 12 AS annual_expected_loss,
                 monthly_expected_loss - offer_cost AS net_saved_monthly,
                 CASE WHEN offer_cost > 0 THEN (monthly_expected_loss - offer_cost) / offer_cost * 100 END AS roi_pct
          FROM money)"""
_MONEY = ("monthly_expected_loss", "annual_expected_loss", "offer_cost", "net_saved_monthly", "roi_pct")


def _recommended(spark, sf):
    return RC.validated(RC.with_recommendation(_scored(spark, sf)))


@register("reco_offer_budget", _SCORED + f""" SELECT r.customer_id, r.action,
    round_even({_SHARE} * CASE WHEN coalesce(s.avg_monthly_margin, 0.0) < 0 THEN 0.0
                      ELSE coalesce(s.avg_monthly_margin, 0.0) END, 2) AS offer_budget_eur
  FROM reco2 r LEFT JOIN scored s ON r.customer_id = s.customer_id""")
def q_budget(spark, sf):
    """Offer budget = tier share x max(margin, 0)."""
    return RC.offer_budget(_recommended(spark, sf)).select("customer_id", "action", "offer_budget_eur")


@register("reco_financials", _FINANCIALS + f" SELECT customer_id, action, {', '.join(_MONEY)} FROM fin")
def q_financials(spark, sf):
    """Per customer expected loss, offer cost, net saved and ROI in percent."""
    return RC.customer_financials(_recommended(spark, sf)).select("customer_id", "action", *_MONEY)


@register("reco_action_counts", _SCORED + " SELECT action, count(*) AS customers FROM reco2 GROUP BY action")
def q_action_counts(spark, sf):
    """Customers per action."""
    return RC.action_counts(_reco(spark, sf))


@register("reco_top_actions", _SCORED + """ SELECT action, count(*) AS customers FROM reco2 GROUP BY action
  ORDER BY customers DESC, action LIMIT 2""")
def q_top_actions(spark, sf):
    """The two most frequent actions."""
    return RC.top_actions(_reco(spark, sf), 2)


_HASHED = V.with_(V.CHURN) + """,
  h AS (SELECT customer_id, churn, CAST('0x' || substr(md5(customer_id || ':42'), 1, 15) AS BIGINT) AS h FROM churn),
  p AS (SELECT customer_id, churn, row_number() OVER (PARTITION BY churn ORDER BY h) AS pos,
               count(*) OVER (PARTITION BY churn) AS n FROM h)"""


@register("model_split", _HASHED + " SELECT customer_id, churn, pos <= round(n * 0.2) AS is_test FROM p")
def q_split(spark, sf):
    """M2: exact stratified 80/20 split by key hash, every customer's side."""
    return M.stratified_split(si.churn_labels(spark, sf), "churn", 0.20, 42).select("customer_id", "churn", "is_test")


@register("model_folds", _HASHED + " SELECT customer_id, churn, CAST((pos - 1) % 5 AS INTEGER) AS fold FROM p")
def q_folds(spark, sf):
    """Five stratified folds by key hash, every customer's fold."""
    return M.stratified_folds(si.churn_labels(spark, sf), "churn", 5, 42).select("customer_id", "churn", "fold")


# ------------------------------------------------------------------ text ----
from voltchurn.functions import text as TX  # noqa: E402

_INTER = V.with_(V.INTERACTIONS, *PS.enriched_interactions_ctes())


@register("text_intent_documents", _INTER + """ SELECT customer_id, date, channel, customer_intent, has_interaction
  FROM inter_e""")
def q_text_intent(spark, sf):
    """X1 + X2 + X3: intent and presence flag for every interaction text (whole texts)."""
    return enrich.enrich_intent(si.interactions(spark, sf)).select(
        "customer_id", "date", "channel", "customer_intent", "has_interaction")


@register("text_sentiment_documents", _INTER + """ SELECT customer_id, date, sentiment_neg, sentiment_neu,
    sentiment_pos, sentiment_label FROM inter_e""")
def q_text_sentiment(spark, sf):
    """X4 + X5: word-list sentiment scores and arg-max label for every text."""
    return enrich.lexicon_sentiment(si.interactions(spark, sf)).select(
        "customer_id", "date", "sentiment_neg", "sentiment_neu", "sentiment_pos", "sentiment_label")


@register("text_intent_conversations", "WITH " + PS.enriched_interactions_ctes(
    "(SELECT conv_id, turn, role, text AS interaction_summary, CAST(NULL AS DATE) AS date FROM conversations)"
)[0].strip() + " SELECT conv_id, turn, role, customer_intent, has_interaction FROM inter_e0")
def q_text_conversations(spark, sf):
    """X1 on conversation turns: intent per turn."""
    c = si.table(spark, sf, "conversations").select(
        "conv_id", "turn", "role", F.col("text").alias("interaction_summary"), F.lit(None).cast("date").alias("date"))
    return enrich.enrich_intent(c).select("conv_id", "turn", "role", "customer_intent", "has_interaction")


@register("text_unclassified_audit", G + """ SELECT channel, count(*) AS customers FROM sc
  WHERE has_interaction = 1 AND customer_intent = 'Other / Unclassified' GROUP BY channel""")
def q_text_audit(spark, sf):
    """Customers with an interaction whose intent stayed unclassified, per channel."""
    return RP.unclassified_with_interaction(_silver(spark, sf)["silver_customer"]).groupBy("channel").agg(
        F.count(F.lit(1)).alias("customers"))


# ------------------------------------------------------ model training (no SQL twin) ----
from voltchurn.plans import features as FT  # noqa: E402


def _train_test(spark, sf, experiment="E5_full"):
    gold = _gold(spark, sf)
    feats = FT.feature_list(experiment)
    mm = S_cut(M.model_matrix(gold, feats))
    split = S_cut(M.stratified_split(mm, "churn", 0.2, 42))
    return gold, mm, split, [f for f in feats if f in mm.columns]


@register("model_logreg_scores")
def q_model_logreg(spark, sf):
    """M1-M4 + M13-M14: logistic regression (balanced weights) on E6 features; every customer scored."""
    gold, mm, split, feats = _train_test(spark, sf, "E6_with_strings")
    model = M.fit(split.filter(~F.col("is_test")), feats, "logistic_regression")
    probs = M.predict_proba(model, mm, feats)
    return M.score_customers(probs, gold, threshold=0.5)


@register("model_gbt_experiment")
def q_model_gbt(spark, sf):
    """M9: boosted trees on E5: calibrate, pick the threshold on validation, evaluate on test."""
    gold, mm, split, feats = _train_test(spark, sf, "E5_full")
    feats = FT.tree_feature_list(feats)
    res = M.run_experiment(split.filter(~F.col("is_test")), split.filter("is_test"), feats, "gbt")
    return res["metrics"]


@register("model_baselines")
def q_model_baselines(spark, sf):
    """M5: majority-class and class-prior baselines evaluated on the test split."""
    gold, mm, split, feats = _train_test(spark, sf, "E0_baseline")
    train, test = split.filter(~F.col("is_test")), split.filter("is_test")
    out = None
    for strat in ("most_frequent", "stratified"):
        sc_ = M.baseline_scores(test, train, strat)
        m = M.evaluate(sc_, 0.5).withColumn("model", F.lit(f"dummy_{strat}"))
        out = m if out is None else out.unionByName(m)
    return out


# ------------------------------------------------------------- streaming ----
from voltchurn.session import scratch_path  # noqa: E402
from voltchurn.streaming import jobs as ST  # noqa: E402


def _tier_sql_ntz(ts):
    return PS.tier_case(ts)


@register("stream_daily_tier_sums", V.with_(V.CONSUMPTION_EVENTS) + f""",
  r AS (SELECT customer_id, ts, CASE WHEN consumption_elec_kwh < 0 THEN 0.0 ELSE consumption_elec_kwh END AS elec,
               CASE WHEN consumption_gas_m3 < 0 THEN 0.0 ELSE consumption_gas_m3 END AS gas,
               {PS.tier_case('ts')} AS tier
        FROM consumption WHERE customer_id IS NOT NULL AND customer_id <> '' AND ts IS NOT NULL),
  d AS (SELECT customer_id, CAST(date_trunc('day', ts) AS DATE) AS day,
               coalesce(sum(elec), 0.0) AS elec_kwh, coalesce(sum(gas), 0.0) AS gas_m3,
               coalesce(sum(CASE WHEN tier = 'tier_1_peak' THEN elec ELSE 0.0 END), 0.0) AS elec_kwh_tier_1_peak,
               coalesce(sum(CASE WHEN tier = 'tier_2_standard' THEN elec ELSE 0.0 END), 0.0)
                 AS elec_kwh_tier_2_standard,
               coalesce(sum(CASE WHEN tier = 'tier_3_offpeak' THEN elec ELSE 0.0 END), 0.0)
                 AS elec_kwh_tier_3_offpeak
        FROM r GROUP BY 1, 2)
  SELECT * FROM d""")
def q_stream_daily(spark, sf):
    """ST2 (+ ST1 source): streaming daily tier sums with a 1-day watermark; every day of the
    input, the ones still open at its end included."""
    stream = si.consumption_stream_from_events(spark, sf)
    base = scratch_path(spark, f"stream-{uuid.uuid4().hex[:8]}")
    return ST.run_to_files(ST.daily_tier_sums(stream, "1 day"), ["customer_id", "day"], f"{base}/out", f"{base}/checkpoint")


# ------------------------------------------------------------ more reports ----
from voltchurn.constants import HOLIDAYS_MD, TIERS  # noqa: E402
from voltchurn.functions.exprs import is_holiday, month_key  # noqa: E402
from voltchurn.operators import frames as FR  # noqa: E402
from voltchurn.plans.gold import GOLD_ORDER  # noqa: E402

_HOL = ", ".join(str(h) for h in HOLIDAYS_MD)


@register("bronze_holiday_hours", V.with_(V.CONSUMPTION_EVENTS) + f""" SELECT customer_id,
    strftime(ts, '%Y-%m') AS month, count(*) FILTER (WHERE month(ts) * 100 + day(ts) IN ({_HOL})) AS holiday_hours
  FROM consumption WHERE customer_id IS NOT NULL AND customer_id <> '' AND ts IS NOT NULL GROUP BY 1, 2""")
def q_holiday_hours(spark, sf):
    """A3: readings that fall on a public holiday, per customer-month."""
    c = si.consumption_from_events(spark, sf)
    return (c.filter(F.col("customer_id").isNotNull() & (F.col("customer_id") != "") & F.col("timestamp").isNotNull())
            .groupBy("customer_id", month_key("timestamp").alias("month"))
            .agg(F.count_if(is_holiday("timestamp")).alias("holiday_hours")))


@register("bronze_tier_pivot", V.with_(V.CONSUMPTION_EVENTS, *PS.monthly_consumption_ctes()) + """ SELECT customer_id,
    month, coalesce(sum(elec) FILTER (WHERE tier = 'tier_1_peak'), 0.0) AS tier_1_peak,
    coalesce(sum(elec) FILTER (WHERE tier = 'tier_2_standard'), 0.0) AS tier_2_standard,
    coalesce(sum(elec) FILTER (WHERE tier = 'tier_3_offpeak'), 0.0) AS tier_3_offpeak
  FROM hourly GROUP BY 1, 2""")
def q_tier_pivot(spark, sf):
    """A4: electricity per tier as columns (all three guaranteed, empty cells 0)."""
    t = bronze.hourly_tiers(si.consumption_from_events(spark, sf))
    return t.groupBy("customer_id", "month").pivot("tier", list(TIERS)).agg(F.sum("elec")).na.fill(
        0.0, subset=list(TIERS))


@register("report_power_by_segment", G + """ SELECT segment, count(*) AS customers,
    avg(contracted_power_kw) AS mean_power, quantile_cont(contracted_power_kw, 0.5) AS median_power,
    stddev_samp(contracted_power_kw) AS std_power FROM sc WHERE segment IS NOT NULL GROUP BY segment""")
def q_power(spark, sf):
    """A25 + E16: contracted power block per segment."""
    sc = _silver(spark, sf)["silver_customer"]
    return S.rate_by(sc.withColumn("churn", F.lit(0)), ["segment"], extra={
        "mean_power": F.avg("contracted_power_kw"), "std_power": F.stddev_samp("contracted_power_kw")},
        medians={"median_power": "contracted_power_kw"}).drop("churn_rate")


@register("report_distinct_counts", G + """ SELECT count(DISTINCT customer_id) AS customers,
    count(DISTINCT month) AS months, count(*) AS rows FROM scm""")
def q_distinct(spark, sf):
    """Distinct customers and months of silver customer-month."""
    return _silver(spark, sf)["silver_customer_month"].agg(
        F.count_distinct("customer_id").alias("customers"), F.count_distinct("month").alias("months"),
        F.count(F.lit(1)).alias("rows"))


@register("report_latest_interaction", V.with_(V.INTERACTIONS) + """ SELECT customer_id, date, channel FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id
                                 ORDER BY date DESC NULLS LAST, interaction_summary DESC NULLS LAST,
                                          channel DESC NULLS LAST) AS rn
    FROM interactions) WHERE rn = 1""")
def q_latest(spark, sf):
    """W5 + W7: latest interaction per customer, undated last."""
    return FR.latest_per_key(si.interactions(spark, sf), ["date"]).select("customer_id", "date", "channel")


@register("quality_duplicate_interaction_keys", V.with_(V.INTERACTIONS) + """ SELECT customer_id, count(*) AS n_rows
  FROM interactions GROUP BY 1 HAVING count(*) > 1""")
def q_dup_keys(spark, sf):
    """U4: customers with more than one interaction row."""
    return FR.duplicate_keys(si.interactions(spark, sf), ["customer_id"])


_GOLD_COLS = ["customer_id", *GOLD_ORDER]


@register("quality_missingness_gold", G + " SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
    f"round_even(count(*) FILTER (WHERE {c} IS NULL) / count(*), 4) AS null_rate FROM gold" for c in _GOLD_COLS)
    + ") WHERE null_rate > 0.05")
def q_missingness(spark, sf):
    """Q10: gold columns missing in more than 5 % of customers."""
    return Q.missingness_scan(_gold(spark, sf), 0.05)


@register("report_leakage_flags", G + """ SELECT after_renewal, count(*) AS customers,
    avg(CAST(churn AS DOUBLE)) AS churn_rate FROM (
      SELECT *, CAST(date_diff('day', CAST(next_renewal_date AS DATE), CAST(date AS DATE)) > 0 AS INTEGER)
        AS after_renewal FROM sc WHERE has_interaction = 1)
  WHERE after_renewal IS NOT NULL GROUP BY 1""")
def q_leakage_flags(spark, sf):
    """Q13: interactions dated after the renewal date, and churn by that flag."""
    return RP.leakage_flags(_silver(spark, sf)["silver_customer"])


_SCORED_NUM = ["churn_actual", "churn_proba", "churn_pred", "avg_monthly_margin", "total_margin_2024",
               "expected_monthly_loss"]


@register("drift_reference_stats", _SCORED + " SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, avg(CAST({c} AS DOUBLE)) AS mean, stddev_samp(CAST({c} AS DOUBLE)) AS std, "
    f"quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q25, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS q50, "
    f"quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q75, count({c}) AS count FROM scored" for c in _SCORED_NUM)
    + ") WHERE count > 0")
def q_reference_stats(spark, sf):
    """Q5: reference snapshot statistics of the scored table's numeric columns."""
    sc_ = _scored(spark, sf)
    return D.reference_stats(D.reference_snapshot(sc_, _SCORED_NUM))


@register("report_break_even", G + """ SELECT *, median_margin * median_tenure AS value_per_churner,
    50.0 / (median_margin * median_tenure) AS break_even_precision,
    0.3 >= 50.0 / (median_margin * median_tenure) AS worth_it
  FROM (SELECT quantile_cont(avg_monthly_margin, 0.5) AS median_margin,
               quantile_cont(tenure_months, 0.5) AS median_tenure FROM gold WHERE churn = 1)""")
def q_break_even(spark, sf):
    """Outreach break-even precision from churners' median margin and tenure."""
    return M.break_even(_gold(spark, sf), 50.0, 0.3)


@register("report_presence_flag", G + """ SELECT has_event, count(*) AS customers FROM (
    SELECT c.customer_id, CASE WHEN i.customer_id IS NULL THEN 0 ELSE 1 END AS has_event
    FROM churn c LEFT JOIN (SELECT DISTINCT customer_id FROM interactions) i ON c.customer_id = i.customer_id)
  GROUP BY 1""")
def q_presence(spark, sf):
    """Whether each customer appears in the interaction table."""
    return RP.presence_flag(si.churn_labels(spark, sf), si.interactions(spark, sf)).groupBy("has_event").agg(
        F.count(F.lit(1)).alias("customers"))


@register("report_share_dual_fuel", G + """ SELECT avg(CAST(total_gas_m3_2024 > 0 AS DOUBLE))
    AS share_total_gas_m3_2024_positive FROM gold""")
def q_share(spark, sf):
    """share of customers with any gas consumption."""
    return RP.share_positive(_gold(spark, sf), "total_gas_m3_2024")


@register("report_drift_table", _KS_SQL + """ SELECT feature, ks_statistic, p_value,
    CASE WHEN p_value < 0.01 THEN 'Drifted' ELSE 'Stable' END AS status FROM res""")
def q_drift_table(spark, sf):
    """Drift results with a status, ranked by D."""
    ref, cur = _events_long(spark, sf)
    d = D.drift_long(ref, cur, exact=False)
    return d.select("feature", "ks_statistic", "p_value",
                    F.when(F.col("drifted"), "Drifted").otherwise("Stable").alias("status")).orderBy(
        F.desc("ks_statistic"), "feature")


# extra queries timed by bench.py after the layer builders
BENCH_EXTRA = ("scored_customers", "reco_recommendations", "drift_events_by_type", "metrics_ap_roc",
               "text_intent_documents", "text_sentiment_documents", "stream_daily_tier_sums", "model_split",
               "model_logreg_scores")


@register("report_churn_within_days_by_sentiment", G + """ SELECT *,
    CASE WHEN churners > 0 THEN CAST(churn_within_7d_count AS DOUBLE) / churners END AS churn_within_7d_pct_of_churners,
    CASE WHEN churners > 0 THEN CAST(churn_within_30d_count AS DOUBLE) / churners END
      AS churn_within_30d_pct_of_churners
  FROM (SELECT sentiment_label, count(*) AS customers_with_dates, count(*) FILTER (WHERE churn = 1) AS churners,
               count(*) FILTER (WHERE _d BETWEEN 0 AND 7 AND churn = 1) AS churn_within_7d_count,
               count(*) FILTER (WHERE _d BETWEEN 0 AND 30 AND churn = 1) AS churn_within_30d_count
        FROM (SELECT *, date_diff('day', CAST(date AS DATE), CAST(next_renewal_date AS DATE)) AS _d FROM sc
              WHERE sentiment_label IS NOT NULL AND date IS NOT NULL AND next_renewal_date IS NOT NULL)
        GROUP BY sentiment_label)""")
def q_within_days(spark, sf):
    """Churn-within-7/30-days-of-renewal proxy by sentiment label."""
    return RP.churn_within_days_proxy(_silver(spark, sf)["silver_customer"])


_C360 = "42"


@register("report_customer_360", _FINANCIALS + f"""
  SELECT s.* REPLACE (coalesce(s.segment, 'Unknown') AS segment), f.action, f.timing_window, f.reason_codes,
         {', '.join('f.' + c for c in _MONEY)}
  FROM scored s JOIN fin f ON s.customer_id = f.customer_id WHERE s.customer_id = '{_C360}'""")
def q_customer_360(spark, sf):
    """E23 + P13: one customer's score, recommendation and financials (point lookup)."""
    return RP.customer_360(RC.customer_financials(_recommended(spark, sf)), _C360).drop("risk_score", "expected_margin_impact")


_FLAGGED = """ SELECT customer_id, churn_proba, expected_monthly_loss, segment FROM scored WHERE churn_pred = 1
  ORDER BY expected_monthly_loss {} LIMIT 10"""


@register("report_flagged_head", _SCORED + _FLAGGED.format("DESC NULLS LAST, customer_id"))
def q_flagged_head(spark, sf):
    """T4: the ten flagged customers with the most revenue at risk (a top-k report)."""
    return RP.flagged_ends(_scored(spark, sf))


@register("report_flagged_tail", _SCORED + _FLAGGED.format("ASC NULLS FIRST, customer_id DESC"))
def q_flagged_tail(spark, sf):
    """T4: the ten flagged customers with the least revenue at risk (a top-k report)."""
    return RP.flagged_ends(_scored(spark, sf), tail=True)


@register("report_seeded_sample_unclassified")
def q_seeded_sample(spark, sf):
    """X7 + T7: repeatable spot-check sample (20 rows, hash order) of unclassified interactions."""
    sc = _silver(spark, sf)["silver_customer"]
    return RP.seeded_sample(RP.unclassified_with_interaction(sc).select("customer_id", "date", "channel",
                                                                        "customer_intent"), 20)


# ------------------------------------------------------- notebook variants ----
from voltchurn.plans import variants as VR  # noqa: E402

_AS_OF_D = f"DATE '{AS_OF}'"


@register("variant_calendar_margin_trend", G + f""" SELECT customer_id, _l - _p AS rolling_margin_trend FROM (
    SELECT customer_id,
      avg(CASE WHEN _m >= {_AS_OF_D} - INTERVAL 3 MONTH THEN total_margin END) AS _l,
      avg(CASE WHEN _m >= {_AS_OF_D} - INTERVAL 6 MONTH AND _m < {_AS_OF_D} - INTERVAL 3 MONTH
               THEN total_margin END) AS _p
    FROM (SELECT customer_id, CAST(month || '-01' AS DATE) AS _m, total_margin FROM scm)
    WHERE _m <= {_AS_OF_D} GROUP BY customer_id)
  WHERE _l IS NOT NULL OR _p IS NOT NULL""")
def q_calendar_trend(spark, sf):
    """W4 + P8: calendar last-3 vs prior-3 months margin trend before as_of."""
    return VR.calendar_margin_trend(_silver(spark, sf)["silver_customer_month"], AS_OF)


@register("variant_gas_share_with_fixed", G + """ SELECT customer_id,
    CASE WHEN sum(total_revenue) > 0 THEN sum(coalesce(gas_revenue_variable, 0.0)
         + coalesce(gas_revenue_fixed, 0.0) / 12) / sum(total_revenue) END AS gas_share_of_revenue
  FROM scm GROUP BY customer_id""")
def q_gas_share_fixed(spark, sf):
    """Gas share of revenue including fixed / 12, NULL without revenue."""
    return VR.gas_share_with_fixed(_silver(spark, sf)["silver_customer_month"])


@register("variant_province_average_costs", V.with_(V.COSTS, V.ATTRIBUTES) + f""",
  p AS (SELECT province, avg(elec_var_cost_eur_kwh) AS province_avg_elec_cost_2024,
               avg(gas_var_cost_eur_m3) AS province_avg_gas_cost_2024
        FROM costs WHERE CAST(month || '-01' AS DATE) <= {_AS_OF_D} GROUP BY province)
  SELECT a.customer_id, p.province_avg_elec_cost_2024, p.province_avg_gas_cost_2024
  FROM attributes a LEFT JOIN p ON a.province_code = p.province""")
def q_province_costs(spark, sf):
    """Province mean costs up to as_of, per customer."""
    return VR.province_average_costs(si.costs(spark, sf), si.attributes(spark, sf), AS_OF)


@register("variant_distinct_pricing_dates", V.with_(V.PRICES) + f""" SELECT customer_id,
    count(DISTINCT pricing_date) AS price_update_count FROM prices WHERE pricing_date <= {_AS_OF_D}
  GROUP BY customer_id""")
def q_pricing_dates(spark, sf):
    """Distinct pricing dates per customer up to as_of."""
    return VR.distinct_pricing_dates(si.prices(spark, sf), AS_OF)


# ------------------------------------------- churn-rate reports (E5/E6/E9/E13) ----
_RATE_REPORTS = {
    "report_expired_prevalence": (["is_expired_contract"], False),
    "report_churn_by_tenure_bucket": (["tenure_bucket"], False),
    "report_churn_by_portfolio": (["portfolio_type"], False),
    "report_churn_by_competition_x_renewal": (["is_high_competition_province", "renewal_bucket"], False),
    "report_churn_by_residence_x_tenure": (["is_second_residence", "tenure_bucket"], False),
    "report_churn_by_intent_x_sentiment_pct": (["customer_intent", "sentiment_label"], True),
    "report_churn_by_interaction_x_renewal": (["has_interaction", "renewal_bucket"], False),
    "report_churn_by_segment_x_channel": (["segment", "sales_channel"], False),
}


def _make_rate(dims, pct):
    def q(spark, sf):
        return RP.churn_by(_gold(spark, sf), dims, pct=pct)

    q.__doc__ = f"E5/E6/E9/E13 + A21: customers and churn rate by {' x '.join(dims)}."
    return q


for _name, (_dims, _pct) in _RATE_REPORTS.items():
    register(_name, G + _rate_sql(_dims, pct=_pct))(_make_rate(_dims, _pct))


# ------------------------------------------------- drift with the exact law ----

_DRIFT_EXACT = """WITH RECURSIVE
  u AS (SELECT c_mktsegment AS feature, c_acctbal AS value, CASE WHEN c_nationkey < 12 THEN 0 ELSE 1 END AS side FROM customer
        WHERE c_acctbal IS NOT NULL AND c_mktsegment IS NOT NULL
        UNION ALL SELECT 'discounted ' || l_linestatus, l_extendedprice, CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END FROM lineitem
        WHERE l_discount = 0.1 AND l_quantity = 50 AND l_extendedprice IS NOT NULL AND l_linestatus IS NOT NULL),
  cnt AS (SELECT feature, value, count(*) FILTER (WHERE side = 0) AS c0, count(*) FILTER (WHERE side = 1) AS c1 FROM u GROUP BY 1, 2),
  sz AS (SELECT feature, CAST(sum(c0) AS BIGINT) AS n, CAST(sum(c1) AS BIGINT) AS m FROM cnt GROUP BY 1),
  cum AS (SELECT feature, sum(c0) OVER w AS s0, sum(c1) OVER w AS s1 FROM cnt
          WINDOW w AS (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
  d AS (SELECT feature, n, m, n // gcd(n, m) AS a, m // gcd(n, m) AS b, max(abs(s0::DOUBLE / n - s1::DOUBLE / m)) AS ks
        FROM cum JOIN sz USING (feature) WHERE n > 0 AND m > 0 GROUP BY ALL),
  band AS (SELECT *, CAST(round(ks * a * m) AS BIGINT) AS h FROM d),
  paths(feature, n, m, a, b, h, s, v) AS (
    SELECT feature, n, m, a, b, h, 0::BIGINT, list_transform(range(0, n + 1), lambda i: CASE WHEN i = 0 AND h > 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END)
    FROM band WHERE greatest(n, m) <= 10000
    UNION ALL
    SELECT feature, n, m, a, b, h, s + 1, list_transform(range(0, n + 1), lambda i:
      CASE WHEN i > s + 1 OR s + 1 - i > m OR abs(i * (a + b) - (s + 1) * a) >= h THEN 1.0
           ELSE (CASE WHEN i > 0 THEN i * v[i] ELSE 0.0 END + (s + 1 - i) * v[i + 1]) / (s + 1) END)
    FROM paths WHERE s < n + m),
  exact AS (SELECT feature, v[n + 1] AS p FROM paths WHERE s = n + m),
  series AS (SELECT feature, 2.0 * sum(power(-1.0, k - 1) * exp(-2.0 * k * k * ks * ks * n * m / (n + m))) AS p
             FROM band, range(1, 101) t(k) GROUP BY feature),
  res AS (SELECT feature, ks AS ks_statistic, n AS n_ref, m AS n_cur, coalesce(e.p, least(greatest(x.p, 0.0), 1.0)) AS p_value
          FROM band JOIN series x USING (feature) LEFT JOIN exact e USING (feature))
SELECT *, p_value < 0.01 AS drifted FROM res"""


@register("drift_exact", _DRIFT_EXACT)
def q_drift_exact(spark, sf):
    """Q2 with the exact law: balances by market segment (nations below 12 against the others), prices of
    discounted full lines by line status (returned against not)."""
    c = si.table(spark, sf, "customer").where("c_acctbal IS NOT NULL AND c_mktsegment IS NOT NULL")
    li = si.table(spark, sf, "lineitem").where("l_discount = 0.1 AND l_quantity = 50 AND l_extendedprice IS NOT NULL AND l_linestatus IS NOT NULL")
    rows = c.select(F.col("c_mktsegment").alias("feature"), F.col("c_acctbal").alias("value"), (F.col("c_nationkey") < 12).alias("first")).unionByName(
        li.select(F.concat(F.lit("discounted "), "l_linestatus").alias("feature"), F.col("l_extendedprice").alias("value"),
                  (F.col("l_returnflag") == "R").alias("first")))
    return D.drift_long(rows.where("first").drop("first"), rows.where(~F.coalesce("first", F.lit(False))).drop("first"))


# ------------------------------------------------------- trained sentiment ----
from voltchurn.plans import sentiment as SM  # noqa: E402


@register("text_sentiment_model")
def q_text_sentiment_model(spark, sf):
    """Sentiment of every document by a model trained on all labelled ones (toxic: negative, good: positive,
    else neutral), saved and read back before it scores."""
    from voltchurn.session import put_on_worker_path

    put_on_worker_path(spark)
    docs = si.table(spark, sf, "documents").select("doc_id", "text")
    cls = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 1, 2).otherwise(1)
    labels = si.table(spark, sf, "labels").select("doc_id", cls.alias("class"))
    path = scratch_path(spark, f"sentiment-{uuid.uuid4().hex}")
    SM.train_sentiment(docs.join(labels, "doc_id"), "text", "class").save(spark, path)
    return SM.model_sentiment(docs, SM.SentimentModel.load(spark, path), "text").drop("text")


# ------------------------------------------------------ quarantine of raw rows ----
from voltchurn.sources import io as IO  # noqa: E402


@register("source_quarantine", """WITH c AS (SELECT 'customers' AS dataset, c_custkey % 10 AS k FROM customer),
  o AS (SELECT 'orders' AS dataset, o_orderkey % 16 AS k FROM orders),
  u AS (SELECT dataset, k IN (3, 5, 7) AS bad FROM c UNION ALL SELECT dataset, k IN (4, 6) FROM o)
  SELECT dataset, count(*) FILTER (WHERE NOT bad) AS clean_rows, count(*) FILTER (WHERE bad) AS corrupt_rows,
         CAST(count(*) FILTER (WHERE bad) AS DOUBLE) / count(*) AS corrupt_share FROM u GROUP BY dataset""")
def q_source_quarantine(spark, sf):
    """Customers exported as CSV and orders as JSON lines, rows of some keys broken on the way, read back:
    clean and quarantined rows per dataset."""
    base = scratch_path(spark, f"quarantine-{uuid.uuid4().hex}")
    k = F.col("c_custkey") % 10
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string"),
                       F.when(k == 3, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string")))
    line = F.when(k == 5, F.col("c_custkey").cast("string")).when(k == 7, F.concat(line, F.lit(",more"))).otherwise(line)
    si.table(spark, sf, "customer").select(line.alias("value")).write.text(f"{base}/customers-csv")
    k = F.col("o_orderkey") % 16
    record = F.to_json(F.struct("o_orderkey", F.when(k == 4, F.lit("much")).otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice")))
    record = F.when(k == 4, record).otherwise(F.regexp_replace(record, '"o_totalprice":"([^"]*)"', '"o_totalprice":$1'))
    record = F.when(k == 6, F.substring(record, 1, 12)).otherwise(record)
    si.table(spark, sf, "orders").select(record.alias("value")).write.text(f"{base}/orders-json")
    customers = IO.quarantine(spark, f"{base}/customers-csv", "c_custkey long, c_nationkey int, c_acctbal double", f"{base}/customers", header=False)
    orders = IO.quarantine(spark, f"{base}/orders-json", "o_orderkey long, o_totalprice double", f"{base}/orders", "json", multiline=False)
    return Q.corrupt_report({"customers": customers[0], "orders": orders[0]}, {"customers": customers[1], "orders": orders[1]})


# ------------------------------------- chi-square law, thresholds, leakage audit ----

_CELLS = G + """,
  cells AS (SELECT customer_intent AS a, CAST(churn AS VARCHAR) AS b, count(*) AS n FROM gold
            WHERE customer_intent IS NOT NULL AND churn IS NOT NULL GROUP BY 1, 2),
  r AS (SELECT a, CAST(sum(n) AS DOUBLE) AS rt FROM cells GROUP BY a),
  c AS (SELECT b, CAST(sum(n) AS DOUBLE) AS ct FROM cells GROUP BY b),
  nn AS (SELECT CAST(sum(n) AS DOUBLE) AS total FROM cells),
  pairs AS (SELECT a, b, coalesce(n, 0) AS observed, rt * ct / total AS expected
            FROM r CROSS JOIN c CROSS JOIN nn LEFT JOIN cells USING (a, b))"""


@register("report_chi_square_p_value", _CELLS + """,
  one AS (SELECT sum(CASE WHEN dof = 1 THEN power(abs(observed - expected) - least(0.5, abs(observed - expected)), 2)
                          ELSE power(observed - expected, 2) END / expected) AS statistic, any_value(dof) AS dof
          FROM pairs, (SELECT ((SELECT count(*) FROM r) - 1) * ((SELECT count(*) FROM c) - 1) AS dof))
  SELECT statistic, CAST(dof AS BIGINT) AS dof, (SELECT CAST(total AS BIGINT) FROM nn) AS n,
    least(greatest(1.0 - (SELECT sum(exp((dof / 2.0 + k) * ln(statistic / 2.0) - statistic / 2.0 - lgamma(dof / 2.0 + k + 1)))
                          FROM range(0, 3000) t(k)), 0.0), 1.0) AS p_value FROM one""")
def q_chi_square_p(spark, sf):
    """A20 + E13: chi-square test of intent against churn with its p-value."""
    return RP.intent_chi_square(_gold(spark, sf))


@register("report_expected_counts", _CELLS + " SELECT a AS customer_intent, b AS churn, observed, expected FROM pairs")
def q_expected_counts(spark, sf):
    """Expected counts of intent x churn under independence."""
    return S.expected_counts(_gold(spark, sf), "customer_intent", "churn")


_THRESHOLDS = (("recall", 0.70), ("f1", 0.70), ("recall_or_half", 0.70), ("recall", 1.10), ("recall_or_half", 1.10))


@register("metrics_threshold_variants", _LAB + """,
  f AS (SELECT threshold FROM curve ORDER BY 2 * precision * recall / (precision + recall + 1e-12) DESC, threshold LIMIT 1),
  asked(mode, target) AS (VALUES """ + ", ".join(f"('{m}', {t:.2f}::DOUBLE)" for m, t in _THRESHOLDS) + """),
  hit AS (SELECT mode, target, (SELECT max(threshold) FROM curve WHERE recall >= target) AS t FROM asked)
  SELECT mode, target, CASE mode WHEN 'f1' THEN (SELECT threshold FROM f)
    WHEN 'recall' THEN coalesce(t, (SELECT threshold FROM f)) ELSE coalesce(t, 0.5) END AS threshold FROM hit""")
def q_threshold_variants(spark, sf):
    """Thresholds by best F1 and by recall, with both fallbacks (a recall above 1 is never reached)."""
    scores, out = S_cut(si.labelled_scores(spark, sf)), None
    for mode, target in _THRESHOLDS:
        row = S.pick_threshold_by(scores, "label", "score", mode, target).select(F.lit(mode).alias("mode"), F.lit(target).alias("target"), "threshold")
        out = row if out is None else out.unionByName(row)
    return out


_LEAK = G + """,
  tg AS (SELECT *, CASE WHEN has_interaction = 1 THEN date_diff('day', CAST(date AS DATE), CAST(next_renewal_date AS DATE)) END AS d FROM sc),
  scoped AS (SELECT 'all' AS scope, * FROM tg UNION ALL SELECT 'before', * FROM tg WHERE d >= 0
             UNION ALL SELECT 'safe_7d', * FROM tg WHERE d >= 7 UNION ALL SELECT 'safe_30d', * FROM tg WHERE d >= 30)"""


def _tagged(spark, sf):
    return Q.tag_leakage(_silver(spark, sf)["silver_customer"])


@register("leakage_sentiment_timing", _LEAK + """ SELECT sentiment_label, count(customer_id) AS customers,
    avg(CASE WHEN d < 0 THEN 1.0 ELSE 0.0 END) AS pct_after_renewal, quantile_cont(CAST(d AS DOUBLE), 0.5) AS median_days_to_renewal
  FROM tg WHERE sentiment_label IS NOT NULL AND d IS NOT NULL GROUP BY 1""")
def q_leak_timing(spark, sf):
    """Q13 A: sentiment given after the renewal date."""
    return Q.leakage_sentiment_timing(_tagged(spark, sf))


@register("leakage_churn_by_scope", _LEAK + """ SELECT scope, sentiment_label, count(*) AS customers, avg(CAST(churn AS DOUBLE)) AS churn_rate
  FROM scoped WHERE sentiment_label IS NOT NULL GROUP BY ALL""")
def q_leak_scope(spark, sf):
    """Q13 B-D: churn by sentiment on all rows and under buffers of 0, 7 and 30 days."""
    return Q.leakage_churn_by_scope(_tagged(spark, sf))


@register("leakage_churn_by_channel_scope", _LEAK + """ SELECT scope, channel, sentiment_label, count(*) AS customers,
    avg(CAST(churn AS DOUBLE)) AS churn_rate FROM scoped WHERE sentiment_label IS NOT NULL AND channel IS NOT NULL GROUP BY ALL""")
def q_leak_channel(spark, sf):
    """Q13: the same by channel."""
    return Q.leakage_churn_by_scope(_tagged(spark, sf), ["channel", "sentiment_label"])


@register("leakage_violations", _LEAK + """, v AS (
  SELECT 'after_renewal' AS violation, churn FROM tg WHERE d < 0 UNION ALL SELECT 'within_1_day', churn FROM tg WHERE d BETWEEN 0 AND 1
  UNION ALL SELECT 'sentiment_without_interaction', churn FROM tg WHERE sentiment_label IS NOT NULL AND has_interaction = 0
  UNION ALL SELECT 'sentiment_without_dates', churn FROM tg WHERE sentiment_label IS NOT NULL AND d IS NULL)
  SELECT violation, count(*) AS customers, avg(CAST(churn AS DOUBLE)) AS churn_rate FROM v GROUP BY 1""")
def q_leak_violations(spark, sf):
    """Q13: rows and churn per violated rule."""
    return Q.leakage_violations(_tagged(spark, sf))


@register("leakage_suspicious_rows", _LEAK + """ SELECT customer_id, CAST(date AS DATE) AS date, CAST(next_renewal_date AS DATE) AS next_renewal_date,
    CAST(d AS INTEGER) AS days_to_renewal, sentiment_label, sentiment_neg, sentiment_neu, sentiment_pos, interaction_summary
  FROM tg WHERE sentiment_label = 'negative' AND churn = 1 AND d <= 1""")
def q_leak_suspicious(spark, sf):
    """Every suspicious row of the leakage audit."""
    return Q.leakage_suspicious(_tagged(spark, sf))


@register("leakage_summary", _LEAK + """ SELECT unnest(['rows_total', 'rows_has_sentiment', 'rows_has_sentiment_and_dates',
    'rows_sentiment_after_renewal', 'rows_sentiment_pre_renewal', 'rows_sentiment_safe_7d', 'rows_sentiment_safe_30d']) AS metric,
    unnest([count(*), count(sentiment_label), count(*) FILTER (WHERE sentiment_label IS NOT NULL AND d IS NOT NULL),
            count(*) FILTER (WHERE sentiment_label IS NOT NULL AND d < 0), count(*) FILTER (WHERE sentiment_label IS NOT NULL AND d >= 0),
            count(*) FILTER (WHERE sentiment_label IS NOT NULL AND d >= 7), count(*) FILTER (WHERE sentiment_label IS NOT NULL AND d >= 30)]) AS rows
  FROM tg""")
def q_leak_summary(spark, sf):
    """Q13: rows that each cut of the audit leaves."""
    return Q.leakage_summary(_tagged(spark, sf))


# ------------------------------------------------ drift of a stream, types ----

@register("stream_drift_events", _KS_SQL + " SELECT *, p_value < 0.01 AS drifted FROM res")
def q_stream_drift(spark, sf):
    """ST3: the events of the second half of the month arrive as files, one per micro-batch; drift per event type
    after the last one."""
    ref, cur = _events_long(spark, sf)
    base = scratch_path(spark, f"drift-{uuid.uuid4().hex}")
    cur.repartition(4, F.xxhash64("feature", "value")).write.parquet(f"{base}/arriving")
    return ST.drift_stream(ST.read_stream(spark, f"{base}/arriving", cur.schema, max_files_per_trigger=1), ref, f"{base}/state", exact=False)


@register("model_types_gold", G + """ SELECT customer_id, CAST(churn = 1 AS TINYINT) AS churned, CAST(avg_monthly_margin > 0 AS TINYINT) AS earns,
    CAST(CAST(avg_monthly_elec_kwh AS DECIMAL(18, 3)) AS DOUBLE) AS elec, segment, tenure_months FROM gold""")
def q_model_types(spark, sf):
    """flags, decimals and strings of gold in the types that preprocessing takes."""
    g = _gold(spark, sf).select("customer_id", (F.col("churn") == 1).alias("churned"), (F.col("avg_monthly_margin") > 0).alias("earns"),
                                F.col("avg_monthly_elec_kwh").cast("decimal(18,3)").alias("elec"), "segment", "tenure_months")
    return M.normalize_types(g)


# ------------------------------------------------------------ JSON and CSV ends ----

@register("source_event_props", """SELECT event_type, count(*) AS events, count(k) AS with_k, min(k) AS least, max(k) AS greatest, CAST(sum(k) AS BIGINT) AS total
  FROM (SELECT event_type, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY event_type""")
def q_event_props(spark, sf):
    """The nested records of the events' JSON column, flattened to dotted columns."""
    record = F.from_json("props", "k long")
    flat = IO.flatten(si.table(spark, sf, "events").select("event_type", record.alias("props")))
    k = F.col("`props.k`")
    return flat.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"), F.count(k).alias("with_k"), F.min(k).alias("least"),
                                          F.max(k).alias("greatest"), F.sum(k).alias("total"))


@register("source_csv_export", V.with_(V.INTERACTIONS) + """ SELECT channel, count(*) AS rows,
    count(DISTINCT customer_id) AS customers FROM interactions GROUP BY channel""")
def q_csv_export(spark, sf):
    """S16 + S7: interactions without their texts exported as CSV with a header and read back."""
    path = scratch_path(spark, f"export-{uuid.uuid4().hex}")
    IO.write_csv(si.interactions(spark, sf).select("customer_id", "channel"), path)
    return IO.read_csv(spark, path, "customer_id string, channel string").groupBy("channel").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("customer_id").alias("customers"))


# ------------------------------------------------------------- crossed reports ----
from voltchurn.plans import crosses as C  # noqa: E402

_LIFE = G + """,
  lc AS (SELECT g.*, CASE WHEN p > 0 AND p <= 3.5 THEN '<=3.5kW' WHEN p > 3.5 AND p <= 5 THEN '3.5-5kW' WHEN p > 5 AND p <= 8 THEN '5-8kW'
                          WHEN p > 8 AND p <= 20 THEN '8kW+' END AS power_bucket,
                CASE WHEN g.has_interaction = 1 AND d >= 0 THEN CASE WHEN d < 30 THEN '0-30d' WHEN d < 90 THEN '30-90d'
                     WHEN d < 180 THEN '90-180d' WHEN d < 365 THEN '180-365d' ELSE '365d+' END END AS days_bucket
         FROM gold g LEFT JOIN (SELECT customer_id, contracted_power_kw AS p,
                date_diff('day', CAST(date AS DATE), CAST(next_renewal_date AS DATE)) AS d FROM sc) s ON g.customer_id = s.customer_id),
  md AS (SELECT customer_id, quantile_cont(elec_margin, 0.5) AS elec_margin_med, quantile_cont(gas_margin, 0.5) AS gas_margin_med,
                quantile_cont(total_margin, 0.5) AS total_margin_med, stddev_samp(total_margin) AS margin_volatility,
                stddev_samp(total_revenue) AS bill_volatility FROM scm GROUP BY 1)"""


def _cross_sql(src, crosses, extra="", having=""):
    parts = []
    for dims in crosses:
        levels = [f"CAST({d} AS VARCHAR) AS level_{k + 1}" for k, d in enumerate(dims)]
        levels += [f"CAST(NULL AS VARCHAR) AS level_{k + 1}" for k in range(len(dims), 3)]
        parts.append(f"SELECT '{' x '.join(dims)}' AS \"cross\", {', '.join(levels)}, count(*) AS customers, "
                     f"count(*) FILTER (WHERE churn = 1) AS churners, avg(CAST(churn AS DOUBLE)) AS churn_rate{extra} FROM {src} "
                     f"WHERE {' AND '.join(f'{d} IS NOT NULL' for d in dims)} GROUP BY {', '.join(dims)}{having}")
    return " " + " UNION ALL ".join(parts)


def _lifecycle(spark, sf):
    L = _layers(spark, sf)
    sc = L["silver_customer"]
    gold_rows = L["gold_master"].join(sc.select("customer_id", "contracted_power_kw"), "customer_id", "left")
    return C.lifecycle_columns(gold_rows, sc)


_NEAR, _COMP, _DUAL = "is_within_3m_of_renewal", "is_high_competition_province", "is_dual_fuel"
_TENURE = [["renewal_bucket"], ["tenure_bucket"]] + [["tenure_bucket", o] for o in (
    _NEAR, "sales_channel", "segment", _COMP, "is_second_residence", "power_bucket", "renewal_bucket")]


@register("report_tenure_crosses", _LIFE + _cross_sql("lc", _TENURE))
def q_tenure_crosses(spark, sf):
    """E5: churn by renewal and tenure bucket and by tenure x window, channel, segment, competition, residence, power, renewal."""
    return C.tenure_crosses(_lifecycle(spark, sf))


@register("report_expired_crosses", G + _cross_sql("gold", [
    [_NEAR], ["segment", _NEAR], ["is_expired_contract"], ["renewal_bucket", "is_expired_contract"], ["segment", "is_expired_contract"]]))
def q_expired_crosses(spark, sf):
    """E4 + E6: churn in and out of the renewal window and with expired contracts, by segment and bucket."""
    return C.expired_crosses(_gold(spark, sf))


@register("report_market_crosses", _LIFE + ", mk AS (SELECT gold.*, md.* EXCLUDE (customer_id) FROM gold LEFT JOIN md ON gold.customer_id = md.customer_id)"
          + _cross_sql("mk", [["sales_channel"], ["sales_channel", _NEAR], ["sales_channel", _COMP], ["sales_channel", "tenure_bucket"],
                              ["sales_channel", "segment"], [_COMP], [_COMP, "segment"], [_COMP, _NEAR], [_DUAL], [_DUAL, _NEAR],
                              [_DUAL, _COMP], [_DUAL, "tenure_bucket"]], """, avg(total_margin_med * churn) AS avg_profit_at_risk,
    quantile_cont(elec_margin_med, 0.5) AS median_elec_margin, quantile_cont(gas_margin_med, 0.5) AS median_gas_margin,
    quantile_cont(total_margin_med, 0.5) AS median_total_margin, quantile_cont(margin_volatility, 0.5) AS median_margin_volatility,
    CAST(quantile_cont(tenure_months, 0.5) AS DOUBLE) AS median_tenure"""))
def q_market_crosses(spark, sf):
    """E7 + E8 + E9: channels, competition and dual fuel, alone and crossed, with margin decomposition and profit at risk."""
    L = _layers(spark, sf)
    return C.market_crosses(L["gold_master"], C.customer_medians(L["silver_customer_month"]))


@register("report_stickiness_crosses", G + _cross_sql("gold", [
    [_DUAL, "has_interaction"], [_DUAL, "customer_intent"], [_COMP, "has_interaction"], [_COMP, "customer_intent"],
    [_DUAL, _COMP, "has_interaction"]], having=" HAVING count(*) >= 30"))
def q_stickiness_crosses(spark, sf):
    """E15 + P15: dual fuel and competition x interaction and intent, groups of 30 and more."""
    return C.stickiness_crosses(_gold(spark, sf))


@register("report_volatility_crosses", _LIFE + ", vo AS (SELECT md.*, sc.segment, sc.churn FROM md JOIN sc ON md.customer_id = sc.customer_id)"
          + _cross_sql("vo", [["churn"], ["segment", "churn"]], """, quantile_cont(margin_volatility, 0.5) AS median_margin_volatility,
    quantile_cont(bill_volatility, 0.5) AS median_bill_volatility"""))
def q_volatility_crosses(spark, sf):
    """Median margin and bill volatility by churn and by segment x churn."""
    L = _silver(spark, sf)
    return C.volatility_crosses(C.customer_medians(L["silver_customer_month"]), L["silver_customer"])


@register("report_contact_crosses", _LIFE + """,
  e AS (SELECT list_distinct(quantile_cont(months_to_renewal, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0])) AS _e0 FROM lc),
  e2 AS (SELECT list_sort(_e0) AS _e FROM e),
  q AS (SELECT lc.*, CASE WHEN months_to_renewal >= _e[1] AND months_to_renewal <= _e[len(_e)]
                     THEN CAST(len(list_filter(list_slice(_e, 2, greatest(len(_e) - 1, 1)), lambda x: x < months_to_renewal)) AS INTEGER) END
               AS renewal_quintile FROM lc, e2)""" + _cross_sql("q", [
    ["has_interaction"], ["churn", "has_interaction"], ["renewal_quintile", "has_interaction"], ["sentiment_label"],
    ["renewal_quintile", "sentiment_label"], ["customer_intent"], ["customer_intent", "sentiment_label"],
    ["customer_intent", "sales_channel"], ["days_bucket"], ["days_bucket", "sentiment_label"], ["days_bucket", "customer_intent"]],
    ", avg(CAST(coalesce(has_interaction, 0) AS DOUBLE)) AS interaction_rate"))
def q_contact_crosses(spark, sf):
    """E10 + E11 + E13 + E14: interactions, sentiment and intent against churn, both ways, by quintile, channel and timing."""
    return C.contact_crosses(_lifecycle(spark, sf))


# ------------------------------------------------------- rows by id, flags, projections ----

@register("report_latest_interaction_text", V.with_(V.INTERACTIONS) + """ SELECT customer_id, date, channel, interaction_summary FROM (
    SELECT i.*, row_number() OVER (PARTITION BY customer_id ORDER BY date DESC NULLS LAST, doc_id DESC) AS rn FROM (
      SELECT d.doc_id, CAST(d.doc_id // 2 AS VARCHAR) AS customer_id, CASE WHEN d.doc_id % 10 = 9 THEN NULL
               ELSE CAST(DATE '2000-01-01' + CAST((d.doc_id * 37) % 600 AS INTEGER) AS DATE) END AS date,
             d.source AS channel, d.text AS interaction_summary FROM documents d) i) WHERE rn = 1""")
def q_latest_text(spark, sf):
    """W5 + W7 + J1: the latest interaction per customer with its whole text, chosen by id and fetched by id."""
    return FR.latest_per_key(si.interactions_with_id(spark, sf), ["date"], row_id="interaction_id").drop("interaction_id")


@register("report_column_overlap", G + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) FILTER (WHERE sc.{c} IS DISTINCT FROM gold.{c}) AS differing "
    "FROM sc JOIN gold ON sc.customer_id = gold.customer_id"
    for c in ("churn", "segment", "is_second_residence", "is_high_competition_province", "sales_channel", "has_interaction",
              "customer_intent", "sentiment_label", "sentiment_neg", "sentiment_neu", "sentiment_pos")))
def q_column_overlap(spark, sf):
    """Columns that silver customers and gold share, and on how many customers they differ."""
    L = _layers(spark, sf)
    return FR.overlap_report(L["silver_customer"], L["gold_master"])


_E, _M3 = "consumption_elec_kwh", "consumption_gas_m3"


@register("quality_negative_flags", V.with_(V.CONSUMPTION_EVENTS) + f""" SELECT customer_id, ts AS timestamp, {_E}, {_M3},
    CAST(coalesce({_E} < 0, false) AS INTEGER) AS {_E}_negative, CAST(coalesce({_M3} < 0, false) AS INTEGER) AS {_M3}_negative,
    concat_ws(',', CASE WHEN {_E} < 0 THEN '{_E}' END, CASE WHEN {_M3} < 0 THEN '{_M3}' END) AS negative_measures FROM consumption""")
def q_negative_flags(spark, sf):
    """Every hourly reading as it came, with its negative measures flagged."""
    return Q.flag_negative_readings(si.consumption_from_events(spark, sf)).select(
        "customer_id", "timestamp", _E, _M3, f"{_E}_negative", f"{_M3}_negative", "negative_measures")


@register("quality_negative_distribution", V.with_(V.CONSUMPTION_EVENTS) + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS measure, CAST({p} AS DOUBLE) AS percentile, quantile_cont({c}, {p}) FILTER (WHERE {c} < 0) AS value FROM consumption"
    for c in (_E, _M3) for p in (0.01, 0.25, 0.5, 0.75, 0.99)))
def q_negative_distribution(spark, sf):
    """Exact percentiles of the negative readings."""
    return Q.negative_distribution(si.consumption_from_events(spark, sf))


@register("features_projection", G + """ SELECT customer_id, churn, avg_monthly_elec_kwh, total_elec_kwh_2024, avg_monthly_gas_m3,
    total_gas_m3_2024, gas_share_of_revenue, price_update_count, province_avg_elec_cost_2024, province_avg_gas_cost_2024,
    std_monthly_elec_kwh, std_monthly_gas_m3, active_months_count, std_margin, min_monthly_margin, max_negative_margin,
    elec_price_trend_12m, gas_price_trend_12m, elec_price_volatility_12m, province_elec_cost_trend,
    elec_price_vs_province_cost_spread, is_price_increase, rolling_margin_trend FROM gold""")
def q_features(spark, sf):
    """The columns of the market-only experiment."""
    return FT.project(_gold(spark, sf), "E7_market_only")[0]


@register("model_matrix_gold", G + """ SELECT customer_id, churn, coalesce(months_to_renewal, 0) AS months_to_renewal, renewal_bucket,
    coalesce(is_within_3m_of_renewal, 0) AS is_within_3m_of_renewal, tenure_months, tenure_bucket,
    coalesce(is_expired_contract, 0) AS is_expired_contract, segment, sales_channel,
    coalesce(is_high_competition_province, 0) AS is_high_competition_province, coalesce(is_second_residence, 0) AS is_second_residence,
    coalesce(is_dual_fuel, 0) AS is_dual_fuel, portfolio_type, coalesce(is_digital_channel, 0) AS is_digital_channel,
    coalesce(is_comparison_channel, 0) AS is_comparison_channel, coalesce(is_own_website_channel, 0) AS is_own_website_channel FROM gold""")
def q_model_matrix(spark, sf):
    """M1 + F17: the model matrix of the baseline experiment after its structural fills."""
    return M.model_matrix(_gold(spark, sf), FT.feature_list("E0_baseline"))


@register("model_baseline_scores", _HASHED + """, r AS (SELECT *, pos <= round(n * 0.2) AS is_test FROM p),
  pr AS (SELECT avg(CAST(churn AS DOUBLE)) AS prior FROM r WHERE NOT is_test)
  SELECT customer_id, churn, CASE WHEN prior > 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE AS most_frequent,
    CASE WHEN CAST(CAST('0x' || substr(md5(customer_id || ':42:draw'), 1, 15) AS BIGINT) AS DOUBLE) / 1152921504606846976.0 < prior
         THEN 1.0 ELSE 0.0 END::DOUBLE AS stratified
  FROM r, pr WHERE is_test""")
def q_baseline_scores(spark, sf):
    """M5: the majority class and a draw by the class prior, for every customer of the test split."""
    split = S_cut(M.stratified_split(si.churn_labels(spark, sf), "churn", 0.20, 42))
    train, test = split.filter(~F.col("is_test")), split.filter("is_test").select("customer_id", "churn")
    return M.baseline_scores(M.baseline_scores(test, train, "most_frequent", out="most_frequent"), train, "stratified", out="stratified")


@register("model_importance")
def q_importance(spark, sf):
    """The twenty strongest inputs of a logistic model of the baseline experiment, by name after encoding."""
    gold_, mm, split, feats = _train_test(spark, sf, "E0_baseline")
    train = split.filter(~F.col("is_test"))
    return M.feature_importance(M.fit(train, feats, "logistic_regression"), train, feats, 20)


@register("source_partitioned_sink", "SELECT event_type, count(*) AS events, sum(value) AS total FROM events GROUP BY event_type")
def q_partitioned_sink(spark, sf):
    """S6 + S5: events written by type and read back, two columns of them."""
    path = scratch_path(spark, f"events-{uuid.uuid4().hex}")
    IO.write_parquet(si.table(spark, sf, "events").select("event_type", "user_id", "value"), path, ["event_type"])
    return IO.read_parquet(spark, path, ["event_type", "value"]).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.sum("value").alias("total"))


@register("source_report_record", ORACLES["quality_negative_readings"])
def q_report_record(spark, sf):
    """S9 + S14: a report written as JSON records and read back."""
    path = scratch_path(spark, f"report-{uuid.uuid4().hex}")
    IO.write_json_record(Q.negative_reading_audit(si.consumption_from_events(spark, sf)), path)
    return IO.read_report(spark, path)

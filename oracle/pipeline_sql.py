"""DuckDB twins for the layer builders: bronze, silver, gold."""

from __future__ import annotations

from oracle import views as V
from voltchurn.constants import HOLIDAYS_MD, PRICE_CONSUMPTION_PAIRS
from voltchurn.functions.text import INTENT_RULES, NEGATIVE_WORDS, POSITIVE_WORDS

HOL = ", ".join(str(h) for h in HOLIDAYS_MD)


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def tier_case(ts: str = "ts") -> str:
    work = f"(isodow({ts}) <= 5 AND NOT (month({ts}) * 100 + day({ts}) IN ({HOL})))"
    h = f"hour({ts})"
    return (f"CASE WHEN {work} AND (({h} >= 10 AND {h} < 14) OR ({h} >= 18 AND {h} < 22)) THEN 'tier_1_peak' "
            f"WHEN {work} AND (({h} >= 8 AND {h} < 10) OR ({h} >= 14 AND {h} < 18) OR ({h} >= 22 AND {h} < 24)) "
            f"THEN 'tier_2_standard' ELSE 'tier_3_offpeak' END")


def monthly_consumption_ctes() -> list[str]:
    hourly = f"""
hourly AS (
  SELECT customer_id, strftime(ts, '%Y-%m') AS month, {tier_case()} AS tier,
         CASE WHEN consumption_elec_kwh < 0 THEN 0.0 ELSE consumption_elec_kwh END AS elec,
         CASE WHEN consumption_gas_m3 < 0 THEN 0.0 ELSE consumption_gas_m3 END AS gas,
         (CASE WHEN consumption_gas_m3 < 0 THEN 0.0 ELSE consumption_gas_m3 END) * 11.0 AS gas_kwh
  FROM consumption
  WHERE customer_id IS NOT NULL AND customer_id <> '' AND ts IS NOT NULL)"""
    sums = ["coalesce(sum(elec), 0) AS monthly_elec_kwh", "coalesce(sum(gas), 0) AS monthly_gas_m3",
            "coalesce(sum(gas_kwh), 0) AS monthly_gas_kwh"]
    for prefix, src in (("elec_kwh", "elec"), ("gas_m3", "gas"), ("gas_kwh", "gas_kwh")):
        for t in ("tier_1_peak", "tier_2_standard", "tier_3_offpeak"):
            sums.append(f"coalesce(sum(CASE WHEN tier = '{t}' THEN {src} ELSE 0.0 END), 0) AS {prefix}_{t}")
    cm = "\ncm AS (SELECT customer_id, month, " + ", ".join(sums) + " FROM hourly GROUP BY customer_id, month)"
    return [hourly, cm]


def bronze_customer_month_ctes() -> list[str]:
    return [V.CONSUMPTION_ORDERS, V.PRICES, V.COSTS, V.ATTRIBUTES, *monthly_consumption_ctes(), """
bcm AS (
  SELECT cm.*, p.* EXCLUDE (customer_id, pricing_date, month), c.* EXCLUDE (province, month)
  FROM cm
  LEFT JOIN (SELECT *, strftime(pricing_date, '%Y-%m') AS month FROM prices) p
    ON cm.customer_id = p.customer_id AND cm.month = p.month
  LEFT JOIN (SELECT customer_id, min(province_code) AS province_code FROM attributes GROUP BY 1) a
    ON cm.customer_id = a.customer_id
  LEFT JOIN costs c ON a.province_code = c.province AND cm.month = c.month)"""]


def intent_case(t: str) -> str:
    parts = []
    for label, pats in INTENT_RULES:
        pat = "(?i)" + "|".join(f"(?:{p})" for p in pats)
        parts.append(f"WHEN regexp_matches({t}, {sql_str(pat)}) THEN {sql_str(label)}")
    return "CASE " + " ".join(parts) + " ELSE 'Other / Unclassified' END"


WS = r"^[\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}]*$"


def blank(t: str) -> str:
    return f"({t} IS NULL OR regexp_matches({t}, {sql_str(WS)}))"


def hits(t: str, words) -> str:
    vocab = "[" + ", ".join(sql_str(w) for w in words) + "]"
    return (f"len(list_filter(regexp_split_to_array(lower({t}), '[^\\p{{L}}\\p{{N}}_]+'), "
            f"lambda w: list_contains({vocab}, w)))")


def enriched_interactions_ctes(src: str = "interactions", text: str = "interaction_summary") -> list[str]:
    t = text
    return [f"""
inter_e0 AS (
  SELECT *, {intent_case(f"coalesce({t}, '')")} AS customer_intent,
         CAST((date IS NOT NULL OR NOT {blank(t)}) AS INTEGER) AS has_interaction,
         {blank(t)} AS _blank,
         {hits(t, POSITIVE_WORDS)} AS _p, {hits(t, NEGATIVE_WORDS)} AS _n
  FROM {src})""", """
inter_e AS (
  SELECT * EXCLUDE (_blank, _p, _n, _neg, _neu, _pos),
         _neg AS sentiment_neg, _neu AS sentiment_neu, _pos AS sentiment_pos,
         CASE WHEN _blank THEN NULL WHEN _neg >= _neu AND _neg >= _pos THEN 'negative'
              WHEN _neu >= _pos THEN 'neutral' ELSE 'positive' END AS sentiment_label
  FROM (SELECT *, CASE WHEN _blank THEN NULL ELSE _n / (1.0 + _p + _n) END AS _neg,
                  CASE WHEN _blank THEN NULL ELSE 1.0 / (1.0 + _p + _n) END AS _neu,
                  CASE WHEN _blank THEN NULL ELSE _p / (1.0 + _p + _n) END AS _pos
        FROM inter_e0))"""]


def bronze_customer_ctes() -> list[str]:
    return [V.CHURN, V.ATTRIBUTES, V.CONTRACTS, V.INTERACTIONS, *enriched_interactions_ctes(), """
inter_1 AS (
  SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id
                                 ORDER BY date DESC NULLS LAST, interaction_summary DESC NULLS LAST) AS _rn
    FROM inter_e) WHERE _rn = 1)""", """
bc AS (
  SELECT ch.*, a.* EXCLUDE (customer_id), k.* EXCLUDE (customer_id), i.* EXCLUDE (customer_id)
  FROM churn ch
  LEFT JOIN attributes a ON ch.customer_id = a.customer_id
  LEFT JOIN contracts k ON ch.customer_id = k.customer_id
  LEFT JOIN inter_1 i ON ch.customer_id = i.customer_id)"""]


CHANNEL_CASE = """CASE lower(trim(sales_channel))
      WHEN 'presencial_comercial' THEN 'In-Person Commercial'
      WHEN 'comparador' THEN 'Comparison Website'
      WHEN 'oficina' THEN 'Office'
      WHEN 'telemarketing' THEN 'Telemarketing'
      WHEN 'web_propia' THEN 'Own Website'
      WHEN 'desconocido' THEN 'Unknown'
      WHEN 'unknown' THEN 'Unknown'
      ELSE lower(trim(sales_channel)) END"""


def silver_customer_ctes() -> list[str]:
    return [*bronze_customer_ctes(), f"""
sc0 AS (
  SELECT *, CASE WHEN is_industrial = 0 THEN 'Residential'
                 WHEN is_industrial = 1 AND contracted_power_kw = 10 THEN 'SME'
                 WHEN is_industrial = 1 AND contracted_power_kw > 10 THEN 'Corporate' END AS segment
  FROM bc)""", f"""
sc AS (
  SELECT * REPLACE ({CHANNEL_CASE} AS sales_channel),
         CASE WHEN segment = 'Residential' AND is_second_residence = 1 THEN 'Second_Residence'
              WHEN segment = 'Residential' AND is_second_residence = 0 THEN 'Primary_Residence' END
           AS residential_type
  FROM sc0)"""]


def silver_customer_month_ctes() -> list[str]:
    pairs = PRICE_CONSUMPTION_PAIRS
    nz = ", ".join(f"nullif(CAST({p} AS DOUBLE), 0.0) AS {p}" for p, _ in pairs)
    l1 = ", ".join(
        f"CASE WHEN coalesce({c}, 0) > 0 AND {p} IS NULL THEN coalesce("
        f"last_value({p} IGNORE NULLS) OVER (PARTITION BY customer_id ORDER BY month "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
        f"first_value({p} IGNORE NULLS) OVER (PARTITION BY customer_id ORDER BY month "
        f"ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) ELSE {p} END AS {p}" for p, c in pairs)
    m2 = ", ".join(f"median(CASE WHEN coalesce({c}, 0) > 0 THEN {p} END) AS m2_{p}" for p, c in pairs)
    f2 = ", ".join(f"CASE WHEN coalesce({c}, 0) > 0 AND {p} IS NULL THEN m2_{p} ELSE {p} END AS {p}"
                   for p, c in pairs)
    m3 = ", ".join(f"median(CASE WHEN coalesce({c}, 0) > 0 THEN {p} END) AS m3_{p}" for p, c in pairs)
    f3 = ", ".join(f"CASE WHEN coalesce({c}, 0) > 0 AND {p} IS NULL THEN m3_{p} ELSE {p} END AS {p}"
                   for p, c in pairs)
    zero_cols = ["elec_kwh_tier_1_peak", "elec_kwh_tier_2_standard", "elec_kwh_tier_3_offpeak",
                 "variable_price_tier1_eur_kwh", "variable_price_tier2_eur_kwh", "variable_price_tier3_eur_kwh",
                 "elec_fixed_fee_eur_month", "monthly_elec_kwh", "elec_var_cost_eur_kwh", "peaje_elec_eur_kwh",
                 "elec_fixed_cost_eur_month", "monthly_gas_m3", "gas_variable_price_eur_m3",
                 "gas_fixed_revenue_eur_year", "gas_var_cost_eur_m3", "gas_fixed_cost_eur_year"]
    z = ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in zero_cols)
    return [*silver_customer_ctes(),
            f"""
s0 AS (SELECT b.* REPLACE ({nz}), s.is_industrial
       FROM bcm b LEFT JOIN (SELECT customer_id, min(is_industrial) AS is_industrial FROM sc GROUP BY 1) s
         ON b.customer_id = s.customer_id)""",
            f"\ns1 AS (SELECT * REPLACE ({l1}) FROM s0)",
            f"\nmed2 AS (SELECT is_industrial, month, {m2} FROM s1 WHERE is_industrial IS NOT NULL GROUP BY 1, 2)",
            f"\ns2 AS (SELECT s1.* REPLACE ({f2}) FROM s1 LEFT JOIN med2 "
            f"ON s1.is_industrial = med2.is_industrial AND s1.month = med2.month)",
            f"\nmed3 AS (SELECT month, {m3} FROM s2 GROUP BY 1)",
            f"\ns3 AS (SELECT s2.* REPLACE ({f3}) FROM s2 LEFT JOIN med3 ON s2.month = med3.month)",
            f"\ns4 AS (SELECT * REPLACE ({z}) FROM s3)",
            """
scm0 AS (
  SELECT *,
    elec_kwh_tier_1_peak * variable_price_tier1_eur_kwh + elec_kwh_tier_2_standard * variable_price_tier2_eur_kwh
      + elec_kwh_tier_3_offpeak * variable_price_tier3_eur_kwh AS elec_revenue_variable,
    elec_fixed_fee_eur_month AS elec_revenue_fixed,
    monthly_elec_kwh * (elec_var_cost_eur_kwh + peaje_elec_eur_kwh) AS elec_cost_variable,
    elec_fixed_cost_eur_month AS elec_cost_fixed,
    monthly_gas_m3 * gas_variable_price_eur_m3 AS gas_revenue_variable,
    gas_fixed_revenue_eur_year / 12 AS gas_revenue_fixed,
    monthly_gas_m3 * gas_var_cost_eur_m3 AS gas_cost_variable,
    gas_fixed_cost_eur_year / 12 AS gas_cost_fixed
  FROM s4)""", """
scm AS (
  SELECT *,
    elec_revenue_variable + elec_revenue_fixed - elec_cost_variable - elec_cost_fixed AS elec_margin,
    gas_revenue_variable + gas_revenue_fixed - gas_cost_variable - gas_cost_fixed AS gas_margin,
    elec_revenue_variable + elec_revenue_fixed + gas_revenue_variable + gas_revenue_fixed AS total_revenue,
    elec_cost_variable + elec_cost_fixed + gas_cost_variable + gas_cost_fixed AS total_cost,
    elec_revenue_variable + elec_revenue_fixed + gas_revenue_variable + gas_revenue_fixed
      - (elec_cost_variable + elec_cost_fixed + gas_cost_variable + gas_cost_fixed) AS total_margin
  FROM scm0)"""]


def all_silver_ctes() -> list[str]:
    """silver customer + bronze customer-month + silver customer-month, de-duplicated."""
    sc = silver_customer_ctes()
    bcm = [c for c in bronze_customer_month_ctes() if c not in sc]
    scm = [c for c in silver_customer_month_ctes() if c not in sc]
    return sc + bcm + scm


def gold_ctes(as_of: str) -> list[str]:
    a = f"DATE '{as_of}'"
    p1, gp, ec = "variable_price_tier1_eur_kwh", "gas_variable_price_eur_m3", "elec_var_cost_eur_kwh"

    def fl(x, n):
        return (f"arg_min({x}, month) FILTER (WHERE {x} IS NOT NULL) AS _first_{n}, "
                f"arg_max({x}, month) FILTER (WHERE {x} IS NOT NULL) AS _last_{n}")

    def rel(n):
        return f"CASE WHEN _first_{n} > 0 THEN (_last_{n} - _first_{n}) / _first_{n} ELSE 0.0 END"

    return [*all_silver_ctes(), f"""
gm0 AS (
  SELECT *,
    coalesce(abs({p1} - lag({p1}) OVER (PARTITION BY customer_id ORDER BY month)) > 0.001, false) AS _chg,
    count(*) OVER (PARTITION BY customer_id)
      - row_number() OVER (PARTITION BY customer_id ORDER BY month) AS _rdesc
  FROM scm)""", f"""
gm1 AS (
  SELECT customer_id,
    avg(monthly_elec_kwh) AS avg_monthly_elec_kwh, coalesce(sum(monthly_elec_kwh), 0) AS total_elec_kwh_2024,
    avg(monthly_gas_m3) AS avg_monthly_gas_m3, coalesce(sum(monthly_gas_m3), 0) AS total_gas_m3_2024,
    stddev_samp(monthly_elec_kwh) AS std_monthly_elec_kwh, stddev_samp(monthly_gas_m3) AS std_monthly_gas_m3,
    CAST(count(DISTINCT month) AS BIGINT) AS active_months_count,
    avg(total_margin) AS avg_monthly_margin, coalesce(sum(total_margin), 0) AS total_margin_2024,
    stddev_samp(total_margin) AS std_margin, min(total_margin) AS min_monthly_margin,
    CAST(count(*) FILTER (WHERE total_margin < 0) AS BIGINT) AS max_negative_margin,
    avg(CASE WHEN _rdesc < 3 THEN total_margin END) AS _last3,
    avg(CASE WHEN _rdesc >= 3 AND _rdesc < 6 THEN total_margin END) AS _prior3,
    coalesce(sum(total_revenue), 0) AS _rev, coalesce(sum(gas_revenue_variable), 0) AS _gas_rev,
    avg({ec}) AS province_avg_elec_cost_2024, {fl(ec, 'cost')},
    avg(gas_var_cost_eur_m3) AS province_avg_gas_cost_2024,
    CAST(count(*) FILTER (WHERE _chg) AS BIGINT) AS price_update_count, {fl(p1, 'price')},
    stddev_samp({p1}) AS elec_price_volatility_12m, {fl(gp, 'gas')}
  FROM gm0 GROUP BY customer_id)""", f"""
gm AS (
  SELECT *,
    CAST(total_elec_kwh_2024 > 0 AND total_gas_m3_2024 > 0 AS INTEGER) AS _dual_both,
    total_gas_m3_2024 > 0 AS _gas_pos,
    CASE WHEN _rev > 0 THEN _gas_rev / _rev ELSE 0.0 END AS gas_share_of_revenue,
    {rel('price')} AS elec_price_trend_12m,
    CAST({rel('price')} > 0 AS INTEGER) AS is_price_increase,
    {rel('gas')} AS gas_price_trend_12m,
    {rel('cost')} AS province_elec_cost_trend,
    _last_price - province_avg_elec_cost_2024 AS elec_price_vs_province_cost_spread,
    _last3 - coalesce(_prior3, _last3) AS rolling_margin_trend
  FROM gm1)""", f"""
gc0 AS (
  SELECT *,
    round_even(date_diff('day', CAST(contract_start_date AS DATE), {a}) / 30.44, 0) AS tenure_months,
    round_even(date_diff('day', {a}, CAST(next_renewal_date AS DATE)) / 30.44, 1) AS months_to_renewal,
    date_diff('day', CAST(next_renewal_date AS DATE), CAST(date AS DATE)) AS _neg_days_to_renewal
  FROM sc)""", f"""
gc AS (
  SELECT *,
    CASE WHEN months_to_renewal IS NULL THEN NULL WHEN months_to_renewal <= 0 THEN 'expired'
         WHEN months_to_renewal <= 3 THEN '0-3m' WHEN months_to_renewal <= 6 THEN '3-6m'
         WHEN months_to_renewal <= 12 THEN '6-12m' ELSE '12m+' END AS renewal_bucket,
    CAST(coalesce(months_to_renewal, 999.0) <= 3 AS INTEGER) AS is_within_3m_of_renewal,
    CASE WHEN tenure_months IS NULL OR tenure_months <= 0 THEN NULL WHEN tenure_months <= 6 THEN '0-6m'
         WHEN tenure_months <= 12 THEN '6-12m' WHEN tenure_months <= 24 THEN '1-2y'
         WHEN tenure_months <= 60 THEN '2-5y' ELSE '5y+' END AS tenure_bucket,
    CAST(sales_channel = 'Comparison Website' AS INTEGER) AS is_comparison_channel,
    CAST(sales_channel = 'Own Website' AS INTEGER) AS is_own_website_channel,
    CAST(trim(customer_intent) = 'Cancellation / Switch' AS INTEGER) AS is_cancellation_intent,
    CAST(trim(customer_intent) = 'Complaint / Escalation' AS INTEGER) AS is_complaint_intent,
    CAST(coalesce(trim(customer_intent) IN ('Complaint / Escalation', 'Cancellation / Switch'), false)
         AS INTEGER) AS recent_complaint_flag,
    coalesce(CASE customer_intent WHEN 'Cancellation / Switch' THEN 3 WHEN 'Complaint / Escalation' THEN 2
                                  WHEN 'Pricing Offers' THEN 1 END, 0) AS intent_severity_score,
    CAST(date_diff('day', CAST(date AS DATE), {a}) AS INTEGER) AS last_interaction_days_ago,
    CAST(coalesce(-_neg_days_to_renewal / 30.44 BETWEEN 0 AND 3, false) AS INTEGER)
      AS interaction_within_3m_of_renewal,
    CAST(coalesce(-_neg_days_to_renewal / 30.44 BETWEEN 0 AND 1, false) AS INTEGER)
      AS is_interaction_within_30d_of_renewal,
    round_even(date_diff('day', CAST(last_product_change_date AS DATE), {a}) / 30.44, 1)
      AS months_since_last_change,
    CAST(lower(sentiment_label) = 'negative' AS INTEGER) AS is_negative_sentiment
  FROM gc0)""", """
g0 AS (
  SELECT gc.*, gm.* EXCLUDE (customer_id),
    CAST(renewal_bucket = 'expired' AS INTEGER) AS is_expired_contract,
    CAST(coalesce(recent_complaint_flag, 0) = 1 AND coalesce(interaction_within_3m_of_renewal, 0) = 1
         AS INTEGER) AS complaint_near_renewal,
    coalesce(gm._dual_both, 0) AS is_dual_fuel,
    CASE WHEN gm.customer_id IS NOT NULL THEN coalesce(segment, 'Unknown') || '_'
         || CASE WHEN _gas_pos THEN 'DualFuel' ELSE 'SingleFuel' END END AS portfolio_type,
    CASE WHEN gm.customer_id IS NOT NULL THEN
         CAST(coalesce(sales_channel IN ('Comparison Website', 'Own Website'), false) AS INTEGER) END
      AS is_digital_channel
  FROM gc LEFT JOIN gm ON gc.customer_id = gm.customer_id)""", """
gold AS (
  SELECT customer_id, months_to_renewal, renewal_bucket, is_within_3m_of_renewal, tenure_months, tenure_bucket,
    segment, sales_channel, is_high_competition_province, has_interaction, is_second_residence,
    is_expired_contract, is_comparison_channel, is_own_website_channel, is_dual_fuel,
    avg_monthly_elec_kwh, total_elec_kwh_2024, avg_monthly_gas_m3, total_gas_m3_2024,
    avg_monthly_margin, total_margin_2024, is_digital_channel, portfolio_type,
    gas_share_of_revenue, province_avg_elec_cost_2024, province_avg_gas_cost_2024, price_update_count,
    std_monthly_elec_kwh, std_monthly_gas_m3, active_months_count, std_margin, min_monthly_margin,
    max_negative_margin, elec_price_trend_12m, elec_price_volatility_12m, is_price_increase,
    gas_price_trend_12m, province_elec_cost_trend, elec_price_vs_province_cost_spread, rolling_margin_trend,
    customer_intent, is_cancellation_intent, is_complaint_intent, recent_complaint_flag,
    intent_severity_score, last_interaction_days_ago, interaction_within_3m_of_renewal,
    is_interaction_within_30d_of_renewal, complaint_near_renewal, months_since_last_change,
    sentiment_label, sentiment_neg, sentiment_pos, sentiment_neu, is_negative_sentiment,
    coalesce(customer_intent, 'Unknown') || '_x_' || coalesce(renewal_bucket, 'Unknown') AS intent_x_renewal_bucket,
    coalesce(customer_intent, 'Unknown') || '_x_' || coalesce(tenure_bucket, 'Unknown') AS intent_x_tenure_bucket,
    coalesce(sentiment_label, 'Unknown') || '_x_' || coalesce(renewal_bucket, 'Unknown')
      AS sentiment_x_renewal_bucket,
    coalesce(customer_intent, 'Unknown') || '_x_' || coalesce(sentiment_label, 'Unknown') AS intent_x_sentiment,
    coalesce(tenure_bucket, 'Unknown') || '_x_' || coalesce(renewal_bucket, 'Unknown') AS tenure_x_renewal_bucket,
    coalesce(sales_channel, 'Unknown') || '_x_' || coalesce(renewal_bucket, 'Unknown')
      AS sales_channel_x_renewal_bucket,
    coalesce(CAST(has_interaction AS VARCHAR), 'Unknown') || '_x_' || coalesce(renewal_bucket, 'Unknown')
      AS has_interaction_x_renewal_bucket,
    coalesce(CAST(is_high_competition_province AS VARCHAR), 'Unknown') || '_x_'
      || coalesce(customer_intent, 'Unknown') AS competition_x_intent,
    CAST(customer_intent = 'Pricing Offers' AS INTEGER) AS is_price_sensitive,
    CAST(coalesce(renewal_bucket IN ('expired', '0-3m'), false) AND coalesce(tenure_bucket IN ('0-6m', '6-12m'), false)
         AS INTEGER) AS is_high_risk_lifecycle,
    CAST(coalesce(is_high_competition_province, 0) = 1 AND coalesce(is_within_3m_of_renewal, 0) = 1 AS INTEGER)
      AS is_competition_x_renewal,
    CAST(coalesce(is_dual_fuel, 0) = 1 AND coalesce(is_within_3m_of_renewal, 0) = 1 AS INTEGER)
      AS dual_fuel_x_renewal,
    CAST(coalesce(is_dual_fuel, 0) = 1 AND coalesce(is_high_competition_province, 0) = 1 AS INTEGER)
      AS dual_fuel_x_competition,
    CAST(coalesce(is_dual_fuel, 0) = 1
         AND coalesce(customer_intent IN ('Cancellation / Switch', 'Complaint / Escalation'), false) AS INTEGER)
      AS dual_fuel_x_intent,
    CAST(coalesce(recent_complaint_flag, 0) = 1 AND coalesce(is_negative_sentiment, 0) = 1 AS INTEGER)
      AS complaint_x_negative_sentiment,
    churn
  FROM g0)"""]

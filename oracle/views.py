"""Stand-in views in DuckDB SQL (same mapping as voltchurn.sources.standins)."""

CONSUMPTION_EVENTS = """
consumption AS (
  SELECT CAST(user_id AS VARCHAR) AS customer_id, ts AS ts,
         value - 50 AS consumption_elec_kwh,
         CASE WHEN event_type IN ('view', 'click') THEN value / 11 ELSE 0.0 END AS consumption_gas_m3
  FROM events)"""

CONSUMPTION_ORDERS = """
consumption AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS customer_id,
         o.o_orderdate + to_hours(CAST((l.l_orderkey * 7 + l.l_linenumber * 5) % 24 AS INTEGER)) AS ts,
         l.l_quantity * 10 - 40 AS consumption_elec_kwh,
         CASE WHEN l.l_linestatus = 'O' THEN l.l_tax * 100 ELSE 0.0 END AS consumption_gas_m3
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

CHURN = """
churn AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS churn
  FROM customer)"""

ATTRIBUTES = """
attributes AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS customer_id,
         c.c_nationkey AS province_code,
         CASE WHEN c.c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 1 ELSE 0 END AS is_industrial,
         CAST(CASE c.c_custkey % 4 WHEN 0 THEN 3.5 WHEN 1 THEN 5.0 WHEN 2 THEN 10.0 ELSE 50.0 END AS DOUBLE)
           AS contracted_power_kw,
         CASE WHEN c.c_custkey % 5 = 0 THEN 1 ELSE 0 END AS is_second_residence,
         CASE WHEN c.c_custkey % 11 = 0 THEN NULL
              WHEN c.c_custkey % 13 = 0 THEN 'partner_store'
              WHEN c.c_mktsegment = 'AUTOMOBILE' THEN 'comparador'
              WHEN c.c_mktsegment = 'BUILDING' THEN ' Presencial_Comercial '
              WHEN c.c_mktsegment = 'FURNITURE' THEN 'WEB_PROPIA'
              WHEN c.c_mktsegment = 'HOUSEHOLD' THEN 'telemarketing'
              ELSE 'oficina' END AS sales_channel,
         CASE WHEN n.n_regionkey IN (2, 3) THEN 1 ELSE 0 END AS is_high_competition_province
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

CONTRACTS = """
contracts AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customer_id,
         CAST(min(o_orderdate) AS DATE) AS contract_start_date,
         CAST(CAST(max(o_orderdate) AS DATE) + to_months(CAST(o_custkey % 18 AS INTEGER)) AS DATE)
           AS next_renewal_date,
         CAST(max(o_orderdate) AS DATE) AS last_product_change_date
  FROM orders GROUP BY o_custkey)"""

PRICES = """
prices_raw AS (
  SELECT o.o_custkey, strftime(o.o_orderdate, '%Y-%m') AS m,
         CAST(min(o.o_orderdate) AS DATE) AS pricing_date,
         avg(l.l_extendedprice / l.l_quantity) / 10000 AS base,
         avg(o.o_totalprice) / 20000 AS fee,
         count(*) FILTER (WHERE l.l_returnflag = 'A') AS n_a,
         count(*) FILTER (WHERE l.l_returnflag = 'R') AS n_r,
         count(*) AS n
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY o.o_custkey, strftime(o.o_orderdate, '%Y-%m')),
prices AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customer_id, pricing_date,
    CASE WHEN n_a * 2 > n THEN NULL WHEN n_r * 2 > n THEN 0.0 ELSE base * 1.25 END AS variable_price_tier1_eur_kwh,
    CASE WHEN n_a * 2 > n THEN NULL WHEN n_r * 2 > n THEN 0.0 ELSE base END AS variable_price_tier2_eur_kwh,
    CASE WHEN n_a * 2 > n THEN NULL WHEN n_r * 2 > n THEN 0.0 ELSE base * 0.75 END AS variable_price_tier3_eur_kwh,
    CASE WHEN n_a * 2 > n THEN NULL WHEN n_r * 2 > n THEN 0.0 ELSE base * 6 END AS gas_variable_price_eur_m3,
    CASE WHEN n_a * 2 > n THEN NULL WHEN n_r * 2 > n THEN 0.0 ELSE fee END AS elec_fixed_fee_eur_month,
    CASE WHEN n_a * 2 > n THEN NULL WHEN n_r * 2 > n THEN 0.0 ELSE fee * 10 END AS gas_fixed_revenue_eur_year
  FROM prices_raw)"""

COSTS = """
costs AS (
  SELECT s.s_nationkey AS province, strftime(l.l_shipdate, '%Y-%m') AS month,
         avg(l.l_discount) AS elec_var_cost_eur_kwh,
         avg(l.l_tax) / 2 AS peaje_elec_eur_kwh,
         avg(l.l_quantity) / 5 AS elec_fixed_cost_eur_month,
         avg(l.l_discount) * 4 AS gas_var_cost_eur_m3,
         avg(l.l_quantity) * 2 AS gas_fixed_cost_eur_year
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  GROUP BY s.s_nationkey, strftime(l.l_shipdate, '%Y-%m'))"""

INTERACTIONS = """
interactions AS (
  SELECT CAST(doc_id // 2 AS VARCHAR) AS customer_id,
         CASE WHEN doc_id % 10 = 9 THEN NULL
              ELSE CAST(DATE '2000-01-01' + CAST((doc_id * 37) % 600 AS INTEGER) AS DATE) END AS date,
         text AS interaction_summary,
         source AS channel
  FROM documents)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)

LABELLED_SCORES = """
labelled AS (
  SELECT d.doc_id, l.quality AS label, d.n_chars / (d.n_chars + 2000.0) AS score
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

MODEL_OUTPUT = """
model_out AS (
  SELECT customer_id,
         1.0 / (1.0 + exp(-(-2.0 + 2.5 * is_within_3m_of_renewal + 1.5 * is_high_competition_province
                            + 1.0 * coalesce(is_negative_sentiment, 0) + 1.5 * coalesce(recent_complaint_flag, 0)
                            - 0.005 * coalesce(tenure_months, 0.0)))) AS proba
  FROM gold)"""

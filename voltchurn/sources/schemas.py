"""Declared schemas of the raw tables (column names as the code uses them)."""

from pyspark.sql import types as T

S, D, I, TS, DT = T.StringType(), T.DoubleType(), T.IntegerType(), T.TimestampNTZType(), T.DateType()


def _st(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CHURN = _st(("customer_id", S), ("churn", I))
ATTRIBUTES = _st(("customer_id", S), ("province_code", I), ("is_industrial", I), ("contracted_power_kw", D),
                 ("is_second_residence", I), ("sales_channel", S), ("is_high_competition_province", I),
                 ("customer_first_activation_date", S), ("next_renewal_date", S))
CONTRACTS = _st(("customer_id", S), ("contract_start_date", S), ("next_renewal_date", S),
                ("last_product_change_date", S))
PRICES = _st(("customer_id", S), ("pricing_date", S), ("variable_price_tier1_eur_kwh", S),
             ("variable_price_tier2_eur_kwh", S), ("variable_price_tier3_eur_kwh", S),
             ("gas_variable_price_eur_m3", S), ("elec_fixed_fee_eur_month", S), ("gas_fixed_revenue_eur_year", S))
COSTS = _st(("province", I), ("month", S), ("elec_var_cost_eur_kwh", S), ("peaje_elec_eur_kwh", S),
            ("elec_fixed_cost_eur_month", S), ("gas_var_cost_eur_m3", S), ("gas_fixed_cost_eur_year", S))
INTERACTIONS = _st(("customer_id", S), ("date", S), ("interaction_summary", S), ("channel", S))
CONSUMPTION = _st(("customer_id", S), ("timestamp", S), ("consumption_elec_kwh", D), ("consumption_gas_m3", D))

RAW_FILES = {
    "churn": ("churn_label.csv", CHURN),
    "attributes": ("customer_attributes.csv", ATTRIBUTES),
    "contracts": ("customer_contracts.csv", CONTRACTS),
    "prices": ("price_history.csv", PRICES),
    "costs": ("costs_by_province_month.csv", COSTS),
    "interactions": ("customer_interactions.json", INTERACTIONS),
}

"""Fixed values the results depend on.

These are the business rules of the retention pipeline, stated once and in
their natural order.  Everything else in the library derives from them.
"""

KEY = "customer_id"

# ---------------------------------------------------------------------------
# Tariff calendar and unit conversion
# ---------------------------------------------------------------------------
# National public holidays as month * 100 + day (fixed dates only, no Easter).
HOLIDAYS_MD = (101, 106, 501, 815, 1012, 1101, 1206, 1208, 1225)
GAS_KWH_PER_M3 = 11.0
# Tier names, and the hours [start, end) of each weekday tier.
TIER_PEAK = "tier_1_peak"
TIER_STANDARD = "tier_2_standard"
TIER_OFFPEAK = "tier_3_offpeak"
TIERS = (TIER_PEAK, TIER_STANDARD, TIER_OFFPEAK)
PEAK_HOURS = ((10, 14), (18, 22))
STANDARD_HOURS = ((8, 10), (14, 18), (22, 24))

# ---------------------------------------------------------------------------
# Sales channel translation (after trim + lower case)
# ---------------------------------------------------------------------------
CHANNEL_MAP = {
    "presencial_comercial": "In-Person Commercial",
    "comparador": "Comparison Website",
    "oficina": "Office",
    "telemarketing": "Telemarketing",
    "web_propia": "Own Website",
    "desconocido": "Unknown",
    "unknown": "Unknown",
}

# ---------------------------------------------------------------------------
# Price columns and the consumption that must be > 0 for the
# price to be imputed (price column, consumption column)
# ---------------------------------------------------------------------------
PRICE_CONSUMPTION_PAIRS = (
    ("variable_price_tier1_eur_kwh", "elec_kwh_tier_1_peak"),
    ("variable_price_tier2_eur_kwh", "elec_kwh_tier_2_standard"),
    ("variable_price_tier3_eur_kwh", "elec_kwh_tier_3_offpeak"),
    ("gas_variable_price_eur_m3", "monthly_gas_m3"),
    ("elec_fixed_fee_eur_month", "monthly_elec_kwh"),
    ("gas_fixed_revenue_eur_year", "monthly_gas_m3"),
)

# ---------------------------------------------------------------------------
# Month length for month differences, renewal and tenure bins
# ---------------------------------------------------------------------------
DAYS_PER_MONTH = 30.44
RENEWAL_EDGES = (float("-inf"), 0.0, 3.0, 6.0, 12.0, float("inf"))
RENEWAL_LABELS = ("expired", "0-3m", "3-6m", "6-12m", "12m+")
TENURE_EDGES = (0.0, 6.0, 12.0, 24.0, 60.0, float("inf"))
TENURE_LABELS = ("0-6m", "6-12m", "1-2y", "2-5y", "5y+")

# ---------------------------------------------------------------------------
# Intent names, severity
# ---------------------------------------------------------------------------
INTENT_CANCEL = "Cancellation / Switch"
INTENT_COMPLAINT = "Complaint / Escalation"
INTENT_BILLING = "Billing / Payment"
INTENT_RENEWAL = "Contract Renewal"
INTENT_PRICING = "Pricing Offers"
INTENT_PLAN = "Plan / Product Inquiry"
INTENT_ACCOUNT = "Account / Service Inquiry"
INTENT_GENERAL = "General / Operational Contact"
INTENT_OTHER = "Other / Unclassified"
INTENT_SEVERITY = {INTENT_CANCEL: 3, INTENT_COMPLAINT: 2, INTENT_PRICING: 1}

# ---------------------------------------------------------------------------
# Risk tiers (left-closed) and the retention policy
# ---------------------------------------------------------------------------
RISK_EDGES = (0.0, 0.40, 0.60, 0.80, 1.01)
RISK_LABELS = ("Low (<40%)", "Medium (40-60%)", "High (60-80%)", "Critical (>80%)")
TIER_ACTION = {
    "Low (<40%)": "no_offer",
    "Medium (40-60%)": "offer_small",
    "High (60-80%)": "offer_medium",
    "Critical (>80%)": "offer_large",
}
TIER_TIMING = {
    "Low (<40%)": "60_90_days",
    "Medium (40-60%)": "30_60_days",
    "High (60-80%)": "immediate",
    "Critical (>80%)": "immediate",
}
DEFAULT_ACTION = "no_offer"
DEFAULT_TIMING = "60_90_days"
OFFER_SHARE = {"offer_large": 0.25, "offer_medium": 0.15, "offer_small": 0.05, "no_offer": 0.0}

# ---------------------------------------------------------------------------
# Model matrix fills, quality limits, drift and model gates
# ---------------------------------------------------------------------------
NUMERIC_SENTINEL_COLS = ("last_interaction_days_ago", "months_since_last_change")
NUMERIC_SENTINEL_VALUE = 9999
CATEGORICAL_DEFAULT_COLS = (
    "sentiment_label",
    "customer_intent",
    "sentiment_x_renewal_bucket",
    "intent_x_renewal_bucket",
    "intent_x_tenure_bucket",
    "intent_x_sentiment",
    "tenure_x_renewal_bucket",
    "sales_channel_x_renewal_bucket",
    "has_interaction_x_renewal_bucket",
    "competition_x_intent",
)
CATEGORICAL_DEFAULT_VALUE = "no_interaction"
FLAG_PREFIXES = ("is_", "has_", "dual_fuel_x_", "complaint_")
FLAG_SUFFIXES = ("_flag", "_intent", "_renewal", "_sentiment")
NULL_RATE_LIMITS = {"raw": 0.80, "bronze": 0.50, "silver": 0.30, "gold": 0.10}
DEFAULT_NULL_RATE_LIMIT = 0.50
DRIFT_P_THRESHOLD = 0.01
TARGET_RECALL = 0.70
PROMOTION_MIN_AP = 0.70

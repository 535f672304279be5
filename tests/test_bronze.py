import datetime as dt

import pytest
from pyspark.sql import functions as F

from voltchurn.plans import bronze
from voltchurn.functions.exprs import tariff_tier


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_tariff_tier_hours_and_calendar(spark):
    # 2024-01-03 is a Wednesday; 2024-01-06 (Saturday, also a holiday); 2024-12-25 Wednesday holiday
    rows = [(ts("2024-01-03 07:00"), "tier_3_offpeak"), (ts("2024-01-03 08:00"), "tier_2_standard"),
            (ts("2024-01-03 10:00"), "tier_1_peak"), (ts("2024-01-03 13:59"), "tier_1_peak"),
            (ts("2024-01-03 14:00"), "tier_2_standard"), (ts("2024-01-03 18:00"), "tier_1_peak"),
            (ts("2024-01-03 22:00"), "tier_2_standard"), (ts("2024-01-03 23:00"), "tier_2_standard"),
            (ts("2024-01-03 00:30"), "tier_3_offpeak"), (ts("2024-01-06 11:00"), "tier_3_offpeak"),
            (ts("2024-12-25 11:00"), "tier_3_offpeak"), (ts("2024-01-08 11:00"), "tier_1_peak"),
            (ts("2024-05-01 19:00"), "tier_3_offpeak"), (ts("2024-05-02 19:00"), "tier_1_peak")]
    df = spark.createDataFrame(rows, "t timestamp_ntz, want string")
    got = df.select(tariff_tier("t").alias("got"), "want").collect()
    assert all(r.got == r.want for r in got), got


def test_customer_month_sums_clip_and_tiers(spark):
    rows = [("c1", ts("2024-01-03 10:00"), 2.0, 1.0), ("c1", ts("2024-01-03 08:00"), -5.0, -1.0),
            ("c1", ts("2024-01-06 10:00"), 3.0, None), ("c1", ts("2024-02-01 10:00"), 1.0, 0.5),
            (None, ts("2024-01-03 10:00"), 9.0, 9.0), ("", ts("2024-01-03 10:00"), 9.0, 9.0)]
    df = spark.createDataFrame(rows, "customer_id string, timestamp timestamp_ntz, "
                                     "consumption_elec_kwh double, consumption_gas_m3 double")
    out = {(r.customer_id, r.month): r for r in bronze.customer_month_consumption(df).collect()}
    assert set(out) == {("c1", "2024-01"), ("c1", "2024-02")}
    jan = out[("c1", "2024-01")]
    assert jan.monthly_elec_kwh == 5.0          # -5 clipped to 0
    assert jan.elec_kwh_tier_1_peak == 2.0
    assert jan.elec_kwh_tier_2_standard == 0.0
    assert jan.elec_kwh_tier_3_offpeak == 3.0   # holiday + weekend -> off-peak
    assert jan.monthly_gas_m3 == 1.0            # NULL skipped, negative clipped
    assert jan.monthly_gas_kwh == 11.0


def test_duplicate_prices_in_a_month_fail(spark):
    cons = spark.createDataFrame([("c1", ts("2024-01-03 10:00"), 1.0, 0.0)],
                                 "customer_id string, timestamp timestamp_ntz, consumption_elec_kwh double, "
                                 "consumption_gas_m3 double")
    prices = spark.createDataFrame([("c1", dt.date(2024, 1, 1), 0.1), ("c1", dt.date(2024, 1, 15), 0.2)],
                                   "customer_id string, pricing_date date, variable_price_tier1_eur_kwh double")
    with pytest.raises(Exception, match="duplicate"):
        bronze.customer_month(cons, prices=prices).collect()


def test_bronze_customer_keys_and_latest_interaction(spark):
    churn = spark.createDataFrame([("a", 1), ("b", 0), ("c", 0)], "customer_id string, churn int")
    attrs = spark.createDataFrame([("a", 1, 10.0), ("b", 0, 3.0), ("b", 0, 5.0)],
                                  "customer_id string, is_industrial int, contracted_power_kw double")
    con = spark.createDataFrame([("a", dt.date(2020, 1, 1)), ("a", dt.date(2019, 1, 1))],
                                "customer_id string, contract_start_date date")
    inter = spark.createDataFrame([("a", dt.date(2024, 1, 1), "old"), ("a", dt.date(2024, 2, 1), "new"),
                                   ("a", None, "undated")],
                                  "customer_id string, date date, interaction_summary string")
    out = {r.customer_id: r for r in bronze.customer(churn, attrs, con, inter).collect()}
    assert len(out) == 3
    assert out["a"].interaction_summary == "new"
    assert out["a"].contract_start_date == dt.date(2019, 1, 1)
    assert out["b"].contracted_power_kw == 3.0
    assert out["c"].is_industrial is None


def test_duplicate_label_fails(spark):
    churn = spark.createDataFrame([("a", 1), ("a", 0)], "customer_id string, churn int")
    e = spark.createDataFrame([], "customer_id string, x int")
    with pytest.raises(Exception, match="duplicate"):
        bronze.customer(churn, e, e, e).collect()

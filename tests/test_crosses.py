"""Crossed rate reports: equal to one group-by per cross, NULLs, empty tables, plan."""

import pytest
from pyspark.sql import functions as F

from voltchurn.operators.stats import rate_by
from voltchurn.plans import crosses as C

ROWS = [("c1", "A", 1, 1, 10.0), ("c2", "A", 0, 0, 20.0), ("c3", "A", 1, 0, None), ("c4", "B", None, 1, 5.0),
        ("c5", None, 1, 1, 7.0), ("c6", "B", 0, None, 9.0), ("c7", "B", 0, 1, 9.0)]
SCHEMA = "customer_id string, segment string, flag int, churn int, margin double"


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def by_cross(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["cross"], {})[tuple(r[f"level_{k}"] for k in (1, 2, 3) if r[f"level_{k}"] is not None)] = r
    return out


def test_every_cross_equals_its_own_group_by(customers):
    crosses = [["segment"], ["flag"], ["segment", "flag"]]
    got = by_cross(C.cross_rates(customers, crosses, medians={"m": "margin"}))
    assert set(got) == {"segment", "flag", "segment x flag"}
    for dims in crosses:
        want = {tuple(str(r[d]) for d in dims): r for r in rate_by(customers, dims, medians={"m": "margin"}).collect()}
        mine = got[C.cross_name(dims)]
        assert mine.keys() == want.keys()
        for k, r in want.items():
            assert (mine[k]["customers"], mine[k]["churn_rate"], mine[k]["m"]) == (r["customers"], r["churn_rate"], r["m"])


def test_null_values_leave_their_cross_only(customers):
    got = by_cross(C.cross_rates(customers, [["segment"], ["flag"]]))
    assert sum(r["customers"] for r in got["segment"].values()) == 6      # c5 has no segment
    assert sum(r["customers"] for r in got["flag"].values()) == 6         # c4 has no flag
    assert got["segment"][("B",)]["churners"] == 2 and got["segment"][("B",)]["churn_rate"] == 1.0


def test_small_groups_and_empty_tables(customers):
    assert {r["level_1"] for r in C.cross_rates(customers, [["segment"]], min_group=4).collect()} == set()
    assert {r["level_1"] for r in C.cross_rates(customers, [["segment"]], min_group=3).collect()} == {"A", "B"}
    assert C.cross_rates(customers.limit(0), [["segment"]], medians={"m": "margin"}).count() == 0


def test_all_crosses_are_one_partial_aggregate(customers):
    df = C.cross_rates(customers, [["segment"], ["flag"], ["segment", "flag"]], values=["margin"], extra={"avg": F.avg("margin")})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_avg" in plan


def test_buckets_of_power_and_interaction_days(spark):
    gold = spark.createDataFrame([("a", 3.5), ("b", 3.6), ("c", None), ("d", 25.0), ("e", 0.0)], "customer_id string, contracted_power_kw double")
    sc = spark.createDataFrame([("a", 1, "2024-01-01", "2024-01-31"), ("b", 1, "2024-02-10", "2024-01-31"), ("c", 0, "2024-01-01", "2024-01-05"),
                                ("d", 1, None, "2024-01-05")], "customer_id string, has_interaction int, date string, next_renewal_date string") \
        .withColumns({c: F.col(c).cast("timestamp") for c in ("date", "next_renewal_date")})
    got = {r["customer_id"]: (r["power_bucket"], r["days_bucket"]) for r in C.lifecycle_columns(gold, sc).collect()}
    assert got == {"a": ("<=3.5kW", "30-90d"), "b": ("3.5-5kW", None), "c": (None, None), "d": (None, None), "e": (None, None)}


def test_customer_medians(spark):
    rows = [("a", 1.0, 0.0, 1.0, 4.0), ("a", 3.0, 1.0, 4.0, 4.0), ("a", 5.0, 5.0, 10.0, 7.0), ("b", 2.0, None, 2.0, 1.0)]
    scm = spark.createDataFrame(rows, "customer_id string, elec_margin double, gas_margin double, total_margin double, total_revenue double")
    got = {r["customer_id"]: r for r in C.customer_medians(scm).collect()}
    assert (got["a"]["elec_margin_med"], got["a"]["gas_margin_med"], got["a"]["total_margin_med"]) == (3.0, 1.0, 4.0)
    assert got["a"]["bill_volatility"] == pytest.approx(3 ** 0.5)
    assert got["b"]["gas_margin_med"] is None and got["b"]["margin_volatility"] is None

"""Exact two-sample KS law, and models that can be scored in any session."""

from fractions import Fraction
from math import comb, gcd

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from voltchurn.operators import stats
from voltchurn.plans import drift, model


def counted(h, n, m):
    """P(D >= h / lcm) by counting every path that stays inside."""
    g = gcd(n, m)
    row = [0] * (m + 1)
    for i in range(n + 1):
        for j in range(m + 1):
            if i == j == 0:
                row[0] = 1
            elif abs(i * (m // g) - j * (n // g)) < h:
                row[j] = (row[j] if i else 0) + (row[j - 1] if j else 0)
            else:
                row[j] = 0
    return 1 - Fraction(row[m], comb(n + m, n))


@pytest.mark.parametrize("n,m", [(1, 1), (1, 7), (4, 6), (9, 9), (12, 5), (30, 20), (41, 37)])
def test_exact_law_counts_paths(n, m):
    lcm = n * m // gcd(n, m)
    for h in range(1, lcm + 1, max(1, lcm // 40)):
        assert stats.ks_exact_sf(h / lcm, n, m) == pytest.approx(float(counted(h, n, m)), rel=1e-11)
    assert stats.ks_exact_sf(0.0, n, m) == 1.0


def test_exact_law_of_equal_sizes_and_small_chances():
    for n, h in ((100, 20), (1000, 150), (10_000, 200), (10_000, 2_500)):
        closed = 2 * sum((-1) ** (k + 1) * Fraction(comb(2 * n, n - k * h), comb(2 * n, n)) for k in range(1, n // h + 1))
        assert stats.ks_exact_sf(h / n, n, n) == pytest.approx(float(closed), rel=1e-9)


def test_published_value():
    # two samples of 5 and 4: D = 1 has 2 of the C(9, 4) = 126 orders
    assert stats.ks_exact_sf(1.0, 5, 4) == pytest.approx(2 / 126)


def test_large_samples_take_the_asymptotic_law(spark):
    rows = spark.createDataFrame([(0.3, 10, 12), (0.02, 10_001, 20_000), (0.02, 10_000, 9_000)], "d double, n long, m long")
    got = rows.select("n", stats.ks_p_value(F.col("d"), F.col("n"), F.col("m")).alias("p"),
                      stats.kolmogorov_sf(F.col("d"), F.col("n").cast("double"), F.col("m").cast("double")).alias("limit")).collect()
    by = {r["n"]: r for r in got}
    assert by[10]["p"] == pytest.approx(stats.ks_exact_sf(0.3, 10, 12)) and by[10]["p"] != pytest.approx(by[10]["limit"], rel=1e-3)
    assert by[10_001]["p"] == by[10_001]["limit"]
    assert by[10_000]["p"] == pytest.approx(stats.ks_exact_sf(0.02, 10_000, 9_000))


def test_drift_uses_the_exact_law_for_small_samples(spark):
    a = spark.createDataFrame([("f", float(v)) for v in range(8)] + [("g", 1.0), ("h", None)], "feature string, value double")
    b = spark.createDataFrame([("f", float(v) + 3.5) for v in range(6)] + [("g", 1.0), ("h", 2.0)], "feature string, value double")
    got = {r["feature"]: r for r in drift.drift_long(a, b).collect()}
    assert set(got) == {"f", "g"}
    f = got["f"]
    assert f["p_value"] == pytest.approx(stats.ks_exact_sf(f["ks_statistic"], 8, 6)) and got["g"]["p_value"] == 1.0


def test_logistic_model_scores_after_the_session_observed_a_metric(spark):
    rows = spark.createDataFrame([(f"c{i}", float(i % 7), "abc"[i % 3], int(i % 7 > 3)) for i in range(80)], "customer_id string, x double, s string, churn int")
    seen = Observation()
    rows.observe(seen, F.count("*").alias("n")).count()
    assert seen.get["n"] == 80
    fitted = model.fit(rows, ["x", "s"], "logistic_regression")
    proba = model.predict_proba(fitted, rows, ["x", "s"]).collect()
    assert len(proba) == 80 and all((r["proba"] > 0.5) == (r["churn"] == 1) for r in proba)

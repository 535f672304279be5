"""Work that grows with the tables: read once, counted only where ranks fall, no quadratic frames."""

import datetime
import random
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltchurn.operators import frames, stats
from voltchurn.plans import crosses, gold, model, silver
from voltchurn.sources import standins


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_value_bins_never_fall(spark):
    tiny = 5e-324
    values = [float("-inf"), -1e308, -3.0, -2.9999, -1e-300, -tiny, -0.0, 0.0, tiny, 1e-300, 0.5, 0.5000001, 1.0, 7.0, 1e308, float("inf"), float("nan")]
    bins = [r["b"] for r in spark.createDataFrame(list(enumerate(values)), "i int, v double")
            .select("i", stats._value_bin(F.col("v")).alias("b")).orderBy("i").collect()]
    assert bins == sorted(bins) and bins[6] == bins[7] and bins[-3] < bins[-2] < bins[-1]


def test_quantiles_count_only_the_values_near_their_ranks(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(g, rng.lognormvariate(0, 2) * rng.choice([-1, 1])) for g in ("a", "b") for _ in range(4000)]
    counted = []
    whole = stats.prefix_sums
    monkeypatch.setattr(stats, "prefix_sums", lambda df, *a, **k: counted.append(df.count()) or whole(df, *a, **k))
    out = stats.grouped_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], {"q": F.col("v")}, [0.0, 0.5, 0.9])
    for r in out.collect():
        want = np.quantile([v for g, v in rows if g == r["g"]], [0.0, 0.5, 0.9])
        assert r["q"] == pytest.approx(list(want), rel=1e-12)
    assert sum(counted) < 1000


def test_quantiles_of_odd_values(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("one bin", 1.0 + i * 1e-9) for i in range(101)] + [("wide", v) for v in (-inf, -5.0, 0.0, 3.0, inf)]
    rows += [("nan", 1.0), ("nan", nan), ("nan", nan), ("same", 2.0), ("same", 2.0), (None, 4.0), ("empty", None)]
    q = {r["g"]: r["m"] for r in stats.grouped_quantile(spark.createDataFrame(rows, "g string, v double"), ["g"], {"m": F.col("v")}, 0.5).collect()}
    assert set(q) == {"one bin", "wide", "nan", "same"}
    assert q["one bin"] == pytest.approx(1.0 + 50e-9, rel=1e-15) and q["wide"] == 0.0 and np.isnan(q["nan"]) and q["same"] == 2.0


def test_fill_frames_end_at_the_row_or_span_the_partition(spark):
    rows = [("a", m, v) for m, v in enumerate([None, None, 1.0, None, 3.0, None])] + [("b", 0, None), ("b", 1, None), ("c", 0, 5.0)]
    df = spark.createDataFrame(rows, "k string, m int, v double").withColumn("f", frames.ffill_bfill("v", ["k"], ["m"]))
    assert "currentrow$(), unboundedfollowing$()" not in _plan(df)
    assert [r["f"] for r in df.orderBy("k", "m").collect()] == [1.0, 1.0, 1.0, 1.0, 3.0, 3.0, None, None, 5.0]


def test_active_months_are_counted_in_the_window_pass(spark):
    rows = [("a", m, 1.0, 0.0) for m in ("2001-01", "2001-03", "2001-03", None, None)] + [("b", None, 1.0, 0.0)]
    out = gold.monthly_features(spark.createDataFrame(rows, "customer_id string, month string, monthly_elec_kwh double, monthly_gas_m3 double"))
    assert "distinct" not in _plan(out).lower() and "Expand" not in _plan(out)
    assert {r["customer_id"]: r["active_months_count"] for r in out.collect()} == {"a": 2, "b": 0}


@pytest.mark.parametrize("report", [
    lambda df: stats.chi_square(df, "a", "b"), lambda df: stats.expected_counts(df, "a", "b"),
    lambda df: stats.value_counts(df, "a", normalize=True)])
def test_small_count_tables_are_written_so_the_input_is_read_once(spark, tmp_path, report):
    spark.range(100).selectExpr("concat('x', id % 3) AS a", "concat('y', id % 2) AS b").write.parquet(f"{tmp_path}/t")
    assert report(spark.read.parquet(f"{tmp_path}/t")).inputFiles() == []


def test_customer_medians_ride_on_one_aggregate(spark):
    rng = random.Random(5)
    rows = [(f"c{i % 7}", *[rng.gauss(0, 9) for _ in range(4)]) for i in range(60)] + [("none", None, None, None, None)]
    out = crosses.customer_medians(spark.createDataFrame(
        rows, "customer_id string, elec_margin double, gas_margin double, total_margin double, total_revenue double"))
    assert "Join" not in _plan(out)
    got = {r["customer_id"]: r for r in out.collect()}
    for k in got:
        for i, c in enumerate(("elec_margin_med", "gas_margin_med", "total_margin_med"), 1):
            have = [r[i] for r in rows if r[0] == k and r[i] is not None]
            assert got[k][c] == (pytest.approx(float(np.median(have))) if have else None)


def test_costs_and_prices_make_no_text_per_line_item(spark):
    for df, col in ((standins.costs(spark, "/root/testdata/sf0.001"), "l_shipdate"), (standins.prices(spark, "/root/testdata/sf0.001"), "o_orderdate")):
        assert f"date_format(cast({col}" not in _plan(df) and f"date_format({col}" not in _plan(df)


def test_the_two_fits_of_an_experiment_run_side_by_side(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(f"c{i}", rng.gauss(0, 1), i % 2) for i in range(80)]
    df = spark.createDataFrame(rows, "customer_id string, x double, churn int")
    meet, fit = threading.Barrier(2, timeout=60), model.fit
    monkeypatch.setattr(model, "fit", lambda *a, **k: (meet.wait(), fit(*a, **k))[1])
    res = model.run_experiment(df.limit(60), df, ["x"], "gbt", maxIter=1)
    assert res["metrics"].count() == 1


def _months(spark):
    """(customer_id, month, is_industrial, price, kwh): month 1 lacks a price in both segments, month 2 in one, month 3 in none."""
    rows = [("a", "2001-01", 0, None, 1.0), ("b", "2001-01", 1, None, 1.0), ("c", "2001-02", 0, None, 1.0), ("d", "2001-02", 1, 4.0, 1.0),
            ("e", "2001-02", 1, 6.0, 1.0), ("f", "2001-03", 0, 1.0, 1.0), ("g", "2001-03", 0, None, 1.0), ("h", "2001-03", 1, 9.0, 1.0),
            ("i", "2001-03", 0, None, 0.0)]
    return spark.createDataFrame(rows, "customer_id string, month string, is_industrial int, gas_variable_price_eur_m3 double, monthly_gas_m3 double")


def test_level_3_counts_only_the_months_that_lack_a_price(spark, monkeypatch):
    seen = []
    whole = silver.grouped_quantile
    monkeypatch.setattr(silver, "grouped_quantile", lambda df, groups, *a: seen.append((groups, {r["month"] for r in df.select("month").collect()})) or whole(df, groups, *a))
    got = {r["customer_id"]: r["gas_variable_price_eur_m3"] for r in silver.impute_prices(_months(spark)).collect()}
    assert got == {"a": None, "b": None, "c": 5.0, "d": 4.0, "e": 6.0, "f": 1.0, "g": 1.0, "h": 9.0, "i": None}
    assert seen == [(["is_industrial", "month"], {"2001-01", "2001-02", "2001-03"}), (["month"], {"2001-01", "2001-02"})]


def test_medians_of_asked_groups_use_all_their_rows(spark):
    df = spark.createDataFrame([("x", 1.0, False), ("x", 3.0, True), ("y", 7.0, False), (None, 2.0, True)], "g string, v double, ask boolean")
    out = silver.attach_medians(df, ["g"], {"m": F.col("v")}, asking=F.col("ask"))
    assert {(r["g"], r["v"]): r["m"] for r in out.collect()} == {("x", 1.0): 2.0, ("x", 3.0): 2.0, ("y", 7.0): None, (None, 2.0): None}


def test_values_of_a_written_table_are_not_written_again(spark, monkeypatch):
    monkeypatch.setattr(stats, "written", lambda *a: pytest.fail("written again"))
    df = spark.createDataFrame([("x", None, 1.0), ("x", None, 2.0), ("y", 5.0, None)], "g string, v double, w double")
    got = stats.grouped_quantiles(df, ["g"], {"v": F.col("v"), "w": F.col("w")}, [0.5], kept=True).collect()
    assert {r["g"]: (r["v"], r["w"]) for r in got} == {"x": (None, [1.5]), "y": ([5.0], None)}


def test_costs_are_grouped_by_plain_numbers(spark, tmp_path):
    day = lambda *a: datetime.datetime(*a)
    spark.createDataFrame([(1, 10.0, 0.1, 0.2, day(1999, 12, 31)), (1, 20.0, 0.3, 0.4, day(1999, 12, 1)), (1, 30.0, 0.5, 0.6, day(2000, 1, 1)), (2, 5.0, 0.0, 0.0, None)],
                          "l_suppkey long, l_quantity double, l_discount double, l_tax double, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 7), (2, 7)], "s_suppkey long, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    out = standins.costs(spark, str(tmp_path))
    assert "trunc" not in _plan(out)
    got = {r["month"]: (r["province"], r["elec_fixed_cost_eur_month"]) for r in out.collect()}
    assert got == {"1999-12": (7, 3.0), "2000-01": (7, 6.0), None: (7, 1.0)}

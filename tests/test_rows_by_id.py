"""Wide rows chosen by id, medians of few and of many groups, flags and overlap of columns."""

import pytest
from pyspark.sql import functions as F

from voltchurn.operators import frames as FR
from voltchurn.plans import bronze, quality, silver
from voltchurn.plans.enrich import enrich_interactions

ROWS = "customer_id string, id long, date date, text string"


def rows(spark, data):
    return spark.createDataFrame(data, ROWS).withColumn("date", F.col("date"))


def day(n):
    import datetime as dt

    return dt.date(2024, 1, n)


def test_the_latest_row_is_fetched_by_id(spark):
    df = rows(spark, [("a", 1, day(1), "old"), ("a", 2, day(3), "new"), ("a", 3, None, "undated"),
                      ("b", 4, None, None), ("b", 5, None, "x" * 100_000), ("c", 6, day(2), ""),
                      ("d", 7, day(5), "tie"), ("d", 8, day(5), "tie"), (None, 9, day(1), "no key"), ("e", None, day(1), "no id")])
    got = {r.customer_id: (r.id, r.text) for r in FR.latest_per_key(df, ["date"], row_id="id").collect()}
    assert got == {"a": (2, "new"), "b": (5, "x" * 100_000), "c": (6, ""), "d": (8, "tie"), None: (9, "no key"), "e": (None, "no id")}
    first = {r.customer_id: r.id for r in FR.first_per_key(df, order=["date"], row_id="id").collect()}
    assert first == {"a": 1, "b": 4, "c": 6, "d": 7, None: 9, "e": None}
    assert FR.latest_per_key(df.limit(0), ["date"], row_id="id").collect() == []
    assert FR.latest_per_key(df, ["date"], row_id="id").columns == df.columns


def test_an_id_of_several_rows_fails_the_job(spark):
    df = rows(spark, [("a", 1, day(1), "x"), ("a", 1, day(1), "x"), ("b", 2, day(1), "y")])
    with pytest.raises(Exception, match="names more than one row"):
        FR.latest_per_key(df, ["date"], row_id="id").collect()
    unchosen = rows(spark, [("a", 1, day(1), "x"), ("a", 1, day(1), "x"), ("a", 2, day(2), "y")])
    assert FR.latest_per_key(unchosen, ["date"], row_id="id").first().text == "y"


def test_no_aggregate_carries_the_text(spark, tmp_path):
    spark.range(1000).select((F.col("id") % 7).cast("string").alias("customer_id"), "id",
                             F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("date"),
                             F.repeat(F.lit("word "), 50).alias("text")).write.parquet(str(tmp_path / "t"))
    plan = FR.latest_per_key(spark.read.parquet(str(tmp_path / "t")), ["date"], row_id="id")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    aggregates = [line for line in text.splitlines() if "Aggregate" in line]
    assert aggregates and not any("text#" in line for line in aggregates)
    assert plan.count() == 7


def test_bronze_customers_are_the_same_with_and_without_ids(spark):
    churn = spark.createDataFrame([("a", 1), ("b", 0), ("c", 0)], "customer_id string, churn int")
    attr = spark.createDataFrame([("a", 1), ("b", 2)], "customer_id string, province_code int")
    con = spark.createDataFrame([("a", "2020-01-01")], "customer_id string, contract_start_date string")
    inter = spark.createDataFrame(
        [("a", 1, "2024-01-01", "I want to cancel", "web"), ("a", 2, "2024-02-01", "all good, thank you", "phone"), ("b", 3, None, None, None)],
        "customer_id string, interaction_id long, date string, interaction_summary string, channel string")
    make = lambda i, **k: bronze.customer(churn, attr, con, i, enrich=enrich_interactions, **k)
    by_id, plain = make(inter, interaction_id="interaction_id"), make(inter.drop("interaction_id"))
    assert by_id.columns == plain.columns
    assert sorted(map(str, by_id.collect())) == sorted(map(str, plain.collect()))


def test_many_groups_are_joined_and_few_looked_up(spark):
    df = spark.range(600).select((F.col("id") % 50).alias("g"), F.when(F.col("id") % 3 > 0, F.col("id").cast("double")).alias("v")) \
        .unionByName(spark.createDataFrame([(None, 1.0)], "g long, v double"))
    few = silver.attach_medians(df, ["g"], {"m": F.col("v")})
    many = silver.attach_medians(df, ["g"], {"m": F.col("v")}, most_map_groups=10)
    assert few.columns == many.columns == ["g", "v", "m"]
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))
    want = {r.g: r.m for r in df.where("g IS NOT NULL").groupBy("g").agg(F.median("v").alias("m")).collect()}
    assert all(r.m == want.get(r.g) for r in many.collect())
    assert many.count() == 601


def test_negative_readings_are_flagged_and_kept(spark):
    df = spark.createDataFrame([("a", -1.0, 2.0), ("b", -3.0, -0.5), ("c", None, float("nan")), ("d", 0.0, 1.0)],
                               "customer_id string, consumption_elec_kwh double, consumption_gas_m3 double")
    got = {r.customer_id: r for r in quality.flag_negative_readings(df).collect()}
    assert got["a"].consumption_elec_kwh == -1.0 and got["a"].negative_measures == "consumption_elec_kwh"
    assert got["b"].negative_measures == "consumption_elec_kwh,consumption_gas_m3"
    assert all(got[k].negative_measures == "" and got[k].consumption_elec_kwh_negative == 0 for k in "cd")
    dist = {(r.measure, r.percentile): r.value for r in quality.negative_distribution(df, probs=(0.0, 0.5)).collect()}
    assert dist[("consumption_elec_kwh", 0.0)] == -3.0 and dist[("consumption_elec_kwh", 0.5)] == -2.0
    none = quality.negative_distribution(df.where("customer_id = 'd'"), probs=(0.5,)).collect()
    assert [r.value for r in none] == [None, None]


def test_shared_columns_are_reported_and_joined_once(spark):
    a = spark.createDataFrame([("a", 1, None), ("b", 2, "x"), ("c", 3, "y")], "customer_id string, n int, s string")
    b = spark.createDataFrame([("a", 1, None, 9.0), ("b", 5, "x", 8.0)], "customer_id string, n int, s string, extra double")
    assert {r.column: (r.rows, r.differing) for r in FR.overlap_report(a, b).collect()} == {"n": (2, 1), "s": (2, 0)}
    assert FR.overlap_report(a, b.select("customer_id", "extra")).count() == 0
    joined = FR.join_new_columns(a, b)
    assert joined.columns == ["customer_id", "n", "s", "extra"] and joined.count() == 3

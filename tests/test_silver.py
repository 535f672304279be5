from pyspark.sql import functions as F

from voltchurn.plans import silver


def test_segments_and_residence(spark):
    rows = [("r1", 0, 3.0, 1), ("r2", 0, 3.0, 0), ("s", 1, 10.0, 0), ("c", 1, 50.0, 0), ("u", 1, 5.0, 0)]
    df = spark.createDataFrame(rows, "customer_id string, is_industrial int, contracted_power_kw double, "
                                     "is_second_residence int")
    out = {r.customer_id: r for r in silver.customer_segments(df).collect()}
    assert out["r1"].segment == "Residential" and out["r1"].residential_type == "Second_Residence"
    assert out["r2"].residential_type == "Primary_Residence"
    assert out["s"].segment == "SME" and out["c"].segment == "Corporate"
    assert out["u"].segment is None and out["u"].residential_type is None  # industrial below 10 kW


def test_channel_cleaning(spark):
    df = spark.createDataFrame([(" Comparador ",), ("WEB_PROPIA",), ("desconocido",), ("partner",), (None,)],
                               "sales_channel string")
    got = [r.sales_channel for r in silver.clean_sales_channels(df).collect()]
    assert got == ["Comparison Website", "Own Website", "Unknown", "partner", None]


def test_three_level_imputation(spark):
    # c1: price known in Jan only -> Feb filled from customer (level 1)
    # c2: never priced, industrial 0 -> segment-month median of consumers (level 2)
    # c3: never priced, segment unknown -> national month median (level 3)
    # c4: zero consumption in Feb -> stays missing
    rows = [("c1", "2024-01", 10.0, 0.20, 0), ("c1", "2024-02", 10.0, None, 0),
            ("c2", "2024-01", 5.0, 0.0, 0), ("c2", "2024-02", 5.0, None, 0),
            ("c5", "2024-01", 5.0, 0.40, 0),
            ("c3", "2024-01", 5.0, None, None),
            ("c4", "2024-01", 1.0, 0.30, 1), ("c4", "2024-02", 0.0, None, 1)]
    df = spark.createDataFrame(rows, "customer_id string, month string, elec_kwh_tier_1_peak double, "
                                     "variable_price_tier1_eur_kwh double, is_industrial int")
    out = {(r.customer_id, r.month): r.variable_price_tier1_eur_kwh
           for r in silver.impute_prices(df, checkpoint=False).collect()}
    assert out[("c1", "2024-02")] == 0.20
    assert abs(out[("c2", "2024-01")] - 0.30) < 1e-12      # median of 0.20, 0.40 (zero counts as missing)
    assert out[("c2", "2024-02")] == 0.20                   # only c1 priced in Feb for segment 0
    assert abs(out[("c3", "2024-01")] - 0.30) < 1e-12      # national Jan median after level 2: .2 .3 .4 .3
    assert out[("c4", "2024-02")] is None                   # no consumption: not imputed

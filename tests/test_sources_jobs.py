import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from voltchurn.sources import io
from voltchurn.sources import schemas as SC


def test_raw_loader_csv_json_and_coercion(spark):
    d = tempfile.mkdtemp(prefix="vc-raw-")
    files = {
        "churn_label.csv": "customer_id,churn\na,1\nb,0\n",
        "customer_attributes.csv": "customer_id,province_code,is_industrial,contracted_power_kw,is_second_residence,"
                                   "sales_channel,is_high_competition_province,customer_first_activation_date,"
                                   "next_renewal_date\na,1,0,3.5,1,comparador,1,2020-01-01,2025-03-01\n",
        "customer_contracts.csv": "customer_id,contract_start_date,next_renewal_date,last_product_change_date\n"
                                  "a,2020-01-01,2025-03-01,2024-06-01\n",
        "price_history.csv": "customer_id,pricing_date,variable_price_tier1_eur_kwh,variable_price_tier2_eur_kwh,"
                             "variable_price_tier3_eur_kwh,gas_variable_price_eur_m3,elec_fixed_fee_eur_month,"
                             "gas_fixed_revenue_eur_year\na,2024-01-05,0.2,bad,0.1,,3,0\n",
        "costs_by_province_month.csv": "province,month,elec_var_cost_eur_kwh,peaje_elec_eur_kwh,"
                                       "elec_fixed_cost_eur_month,gas_var_cost_eur_m3,gas_fixed_cost_eur_year\n"
                                       "1,2024-01-01,0.05,0.01,1,0.3,12\n",
    }
    for name, text in files.items():
        with open(os.path.join(d, name), "w") as f:
            f.write(text)
    with open(os.path.join(d, "customer_interactions.json"), "w") as f:
        json.dump([{"customer_id": "a", "date": "2024-12-01", "interaction_summary": "I want to cancel",
                    "channel": "phone"}], f)
    raw = io.load_raw_datasets(spark, d)
    assert set(raw) == {"churn", "attributes", "contracts", "prices", "costs", "interactions"}
    assert raw["churn"].count() == 2 and raw["interactions"].first().interaction_summary == "I want to cancel"
    from voltchurn.plans import silver

    # text prices coerce: 'bad' -> NULL, '' -> NULL, 0 -> treated as missing later
    p = raw["prices"].select(F.col("variable_price_tier2_eur_kwh").try_cast("double").alias("x")).first()
    assert p.x is None
    assert silver.compute_margins(raw["prices"]).first().variable_price_tier2_eur_kwh == 0.0


def test_consumption_conversion_once(spark):
    d = tempfile.mkdtemp(prefix="vc-cons-")
    with open(os.path.join(d, "consumption_hourly_2024.csv"), "w") as f:
        f.write("customer_id,timestamp,consumption_elec_kwh,consumption_gas_m3\n"
                "a,2024-01-01 10:00:00,1.5,0.1\na,2024-02-01 10:00:00,2.5,0.2\n")
    df = io.load_or_convert_consumption(spark, d)
    assert df.count() == 2 and os.path.isdir(os.path.join(d, "consumption_hourly_2024.parquet"))
    assert {r.month for r in df.select("month").collect()} == {"2024-01", "2024-02"}
    again = io.load_or_convert_consumption(spark, d)           # parquet copy is now preferred
    assert again.count() == 2


def test_half_written_consumption_copy_is_made_anew(spark):
    d = tempfile.mkdtemp(prefix="vc-cons-")
    with open(os.path.join(d, "consumption_hourly_2024.csv"), "w") as f:
        f.write("customer_id,timestamp,consumption_elec_kwh,consumption_gas_m3\n"
                "a,2024-01-01 10:00:00,1.5,0.1\na,2024-02-01 10:00:00,2.5,0.2\n")
    aborted = os.path.join(d, "consumption_hourly_2024.parquet", "month=2024-01")
    os.makedirs(aborted)                                        # as an aborted job leaves it: rows, no _SUCCESS
    io.read_csv(spark, os.path.join(d, "consumption_hourly_2024.csv"), SC.CONSUMPTION).limit(1).write.mode("overwrite").parquet(aborted)
    assert io.load_or_convert_consumption(spark, d).count() == 2


def test_flatten_and_layer_fallback(spark):
    d = tempfile.mkdtemp(prefix="vc-json-")
    with open(os.path.join(d, "x.json"), "w") as f:
        f.write('{"id": 1, "meta": {"a": 2, "b": {"c": 3}}}\n')
    flat = io.flatten(io.read_json(spark, os.path.join(d, "x.json"), multiline=False))
    assert set(flat.columns) == {"id", "meta.a", "meta.b.c"} and flat.first()["meta.b.c"] == 3
    empty = io.read_layer(spark, os.path.join(d, "missing"), SC.CHURN)
    assert empty.count() == 0 and empty.columns == ["customer_id", "churn"]


def test_pipeline_runs_newest_first(spark):
    d = tempfile.mkdtemp(prefix="vc-runs-")
    rows = [{"run_id": "r1", "file_key": "k", "status": "COMPLETED", "started_at": "2024-01-01T00:00:00",
             "completed_at": "2024-01-01T01:00:00"},
            {"run_id": "r2", "file_key": "k", "status": "FAILED", "started_at": "2024-01-02T00:00:00",
             "completed_at": None}]
    with open(os.path.join(d, "runs.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))
    runs = io.pipeline_runs(spark, os.path.join(d, "runs.json"))
    assert [r.run_id for r in runs.collect()] == ["r2", "r1"]
    assert io.pipeline_runs(spark, os.path.join(d, "runs.json"), "COMPLETED").count() == 1


def test_for_each_batch_scores_new_rows(spark):
    from voltchurn.streaming import jobs as J

    base = tempfile.mkdtemp(prefix="vc-feb-")
    src = os.path.join(base, "src")
    spark.createDataFrame([("a", 0.9), ("b", 0.1)], "customer_id string, proba double").write.parquet(src + "/f1")
    seen = []

    def handle(batch, batch_id):
        seen.append(batch.filter(F.col("proba") >= 0.5).count())

    schema = spark.read.parquet(src + "/f1").schema
    J.for_each_batch(J.read_stream(spark, src + "/*", schema), handle, os.path.join(base, "ck"))
    assert sum(seen) == 1


def test_drift_job_first_run_saves_baseline(spark):
    from voltchurn.plans import drift

    base = tempfile.mkdtemp(prefix="vc-drift-")
    scored = spark.createDataFrame([(str(i), i / 100.0, float(i)) for i in range(100)],
                                   "customer_id string, churn_proba double, avg_monthly_margin double")
    s1 = drift.run_drift_job(spark, scored, os.path.join(base, "ref"), os.path.join(base, "out1")).first()
    assert not s1.any_drift
    shifted = scored.withColumn("avg_monthly_margin", F.col("avg_monthly_margin") + 60)
    s2 = drift.run_drift_job(spark, shifted, os.path.join(base, "ref"), os.path.join(base, "out2")).first()
    assert s2.any_drift and s2.n_features_drifted == 1 and "avg_monthly_margin" in s2.summary

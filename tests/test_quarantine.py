"""Corrupt raw rows go to a quarantine table beside the clean one."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from voltchurn.plans import quality
from voltchurn.sources import io
from voltchurn.sources import schemas as SC


def folder():
    return tempfile.mkdtemp(prefix="vc-quarantine-")


def test_csv_rows_of_every_kind(spark):
    d = folder()
    with open(f"{d}/in.csv", "w") as f:
        f.write("customer_id,churn\na,1\nb,many\nc\nd,0,9\ne,\n\"f,x\",1\n")
    clean, bad = io.quarantine(spark, f"{d}/in.csv", SC.CHURN, f"{d}/out")
    assert sorted((r.customer_id, r.churn) for r in clean.collect()) == [("a", 1), ("e", None), ("f,x", 1)]
    assert sorted(r._corrupt_record for r in bad.collect()) == ["b,many", "c", "d,0,9"]
    assert all(r.source_file.endswith("in.csv") for r in bad.collect())
    assert clean.columns == SC.CHURN.names


def test_json_lines_and_documents(spark):
    d = folder()
    with open(f"{d}/lines.json", "w") as f:
        f.write('{"customer_id": "a", "channel": "web"}\n{"customer_id": "b", \n{"customer_id": "c"}\n')
    clean, bad = io.quarantine(spark, f"{d}/lines.json", SC.INTERACTIONS, f"{d}/out1", "json", multiline=False)
    assert sorted(r.customer_id for r in clean.collect()) == ["a", "c"] and bad.count() == 1
    with open(f"{d}/whole.json", "w") as f:
        json.dump([{"customer_id": "a"}, {"customer_id": "b"}], f)
    clean, bad = io.quarantine(spark, f"{d}/whole.json", SC.INTERACTIONS, f"{d}/out2", "json")
    assert clean.count() == 2 and bad.count() == 0


def test_all_raw_tables_and_the_report(spark):
    d = folder()
    for name, (fname, schema) in SC.RAW_FILES.items():
        with open(os.path.join(d, fname), "w") as f:
            if fname.endswith(".json"):
                json.dump([{"customer_id": "a"}], f)
            else:
                row = ",".join("1" for _ in schema.fields)
                f.write(",".join(schema.names) + f"\n{row}\n" + (f"{row},extra\n" if name == "prices" else ""))
    clean, bad = io.load_checked_datasets(spark, d, f"{d}/checked")
    report = {r.dataset: r for r in quality.corrupt_report(clean, bad).collect()}
    assert set(report) == set(SC.RAW_FILES)
    assert {k: r.corrupt_rows for k, r in report.items()} == {k: int(k == "prices") for k in SC.RAW_FILES}
    assert all(r.clean_rows == 1 for r in report.values()) and report["prices"].corrupt_share == 0.5


def test_an_empty_file_has_neither(spark):
    d = folder()
    open(f"{d}/in.csv", "w").close()
    clean, bad = io.quarantine(spark, f"{d}/in.csv", SC.CHURN, f"{d}/out")
    assert clean.count() == 0 and bad.count() == 0
    assert quality.corrupt_report({"x": clean}, {"x": bad}).select(F.col("corrupt_share")).first()[0] is None

"""External lookup (mapInPandas) with a fake service, and the table lookup."""

import json
import os

from pyspark.sql import functions as F

from scrubjay.operators.lookup import TransientLookupError, lookup_table, lookup_udf

GOOD = {"Results": [{"EngineCylinders": "8", "Make": "NIMBUS", "Model": "Vento", "ModelYear": "2011",
                     "DisplacementL": "4.2", "FuelTypePrimary": "Diesel"}]}


def make_fetch(log_dir):
    def fetch(key):
        with open(os.path.join(log_dir, "calls.log"), "a") as f:
            f.write(key + "\n")
        if key == "SCRUBJAY000000101":
            return GOOD
        if key == "SCRUBJAY0AZ999999":
            return {"Results": []}
        if key == "SCRUBJAY000000606":
            return {"Results": [{"EngineCylinders": "", "Make": "BORA", "Model": "B-20"}]}
        if key == "SCRUBJAY0AZ500500":
            raise TimeoutError("Connection timed out")
        if key == "SCRUBJAY0AZ400400":
            raise TransientLookupError("500 Server Error")
        if key == "SCRUBJAY0AZ123805":
            return {"Results": [{"EngineCylinders": "V8", "Make": "NIMBUS", "Model": "Vento", "ModelYear": "2011"}]}
        if key == "SCRUBJAY000000303":
            return "<p>not json</p>"
        if key == "SCRUBJAY000000202":
            return json.dumps({"Results": [{"EngineCylinders": "4", "Make": None, "Model": "Zefir"}]})
        if key == "SCRUBJAY0AZ777777":
            raise ValueError("boom")
        return {"error": "unknown"}
    return fetch


def _run(spark, keys, tmp):
    df = spark.createDataFrame([(k,) for k in keys], "VIN string")
    res = lookup_udf(df, make_fetch(tmp), partitions=3, rate_per_sec=None, max_attempts=3, base_delay=0.0)
    return {r.VIN: r for r in res.collect()}


def test_lookup_udf_outcomes(spark, tmpdir_path):
    keys = ["SCRUBJAY000000101", "SCRUBJAY0AZ999999", "SCRUBJAY000000606", "SCRUBJAY0AZ500500",
            "SCRUBJAY0AZ400400", "SCRUBJAY0AZ123805", "SCRUBJAY000000303", "SCRUBJAY000000202",
            "INVALID", "SCRUBJAY0AZ777777", " scrubjay000000101 "]
    r = _run(spark, keys, tmpdir_path)
    ok = r["SCRUBJAY000000101"]
    assert (ok.api_cylinders, ok.api_make, ok.api_model, ok.api_year, ok.api_engine_displacement,
            ok.api_fuel_type, ok.api_error_message) == (8, "NIMBUS", "Vento", "2011", "4.2", "Diesel", None)
    assert r["SCRUBJAY0AZ999999"].api_error_message == "No results returned from API"
    blank = r["SCRUBJAY000000606"]
    assert blank.api_cylinders is None and blank.api_make == "BORA" and blank.api_error_message is None
    assert r["SCRUBJAY0AZ500500"].api_error_message == "API request timeout"
    assert r["SCRUBJAY0AZ400400"].api_error_message.startswith("API request failed")
    v8 = r["SCRUBJAY0AZ123805"]
    assert v8.api_cylinders is None and v8.api_make == "NIMBUS" and v8.api_model == "Vento"
    assert r["SCRUBJAY000000303"].api_error_message.startswith("API request failed")
    nullfield = r["SCRUBJAY000000202"]
    assert nullfield.api_cylinders == 4 and nullfield.api_make is None and nullfield.api_model == "Zefir"
    inv = r["INVALID"]
    assert inv.api_error_message == "Invalid VIN format" and inv.api_response_time == 0.0
    assert r["SCRUBJAY0AZ777777"].api_error_message.startswith("Unexpected error")
    # the raw key is kept; the lookup used the normalised key
    assert r[" scrubjay000000101 "].api_cylinders == 8
    calls = open(os.path.join(tmpdir_path, "calls.log")).read().split()
    assert "INVALID" not in calls
    assert calls.count("SCRUBJAY0AZ500500") == 3  # retried
    assert calls.count("SCRUBJAY0AZ400400") == 3
    assert calls.count("SCRUBJAY0AZ777777") == 1  # permanent: no retry
    assert calls.count("SCRUBJAY000000101") == 1  # two raw spellings, one call


def test_lookup_table_semantics(spark):
    keys = spark.createDataFrame([("SCRUBJAY000000101",), ("SCRUBJAY0AZ999999",), ("BAD",),
                                  (" scrubjay000000101",)], "VIN string")
    attrs = spark.createDataFrame([("SCRUBJAY000000101", 8, "NIMBUS"), ("BAD", 4, "X")],
                                  "vin_key string, api_cylinders int, api_make string")
    r = {x.VIN: x for x in lookup_table(keys, attrs).collect()}
    assert r["SCRUBJAY000000101"].api_cylinders == 8
    assert r[" scrubjay000000101"].api_make == "NIMBUS"
    assert r["SCRUBJAY0AZ999999"].api_error_message == "No results returned from API"
    assert r["BAD"].api_error_message == "Invalid VIN format" and r["BAD"].api_cylinders is None
    assert r["BAD"].api_model is None


def _timed_calls(spark, tmp, n_keys, partitions, rate, fail_first=False, workers=1):
    import glob
    import time

    def fetch(key):
        path = os.path.join(tmp, f"{key}-{time.time_ns()}")
        open(path, "w").close()
        if fail_first and len(glob.glob(os.path.join(tmp, f"{key}-*"))) < 3:
            raise TransientLookupError("503")
        return {"Results": [{"EngineCylinders": "4"}]}

    keys = spark.createDataFrame([(f"SCRUBJAY0AZ{i:06d}",) for i in range(n_keys)], "VIN string")
    rows = lookup_udf(keys, fetch, partitions=partitions, rate_per_sec=rate, base_delay=0.0, workers=workers).collect()
    assert len(rows) == n_keys and all(r.api_cylinders == 4 for r in rows)
    return sorted(int(f.rsplit("-", 1)[1]) / 1e9 for f in os.listdir(tmp))


def _within(calls, rate, slots):
    """In no second are there more calls than the rate and one for each caller."""
    return max(sum(t <= u < t + 1 for u in calls) for t in calls) <= rate + slots


def test_rate_holds_over_partitions_retries_and_waves(spark, tmpdir_path):
    import tempfile

    slots = spark.sparkContext.defaultParallelism
    few_keys = _timed_calls(spark, tempfile.mkdtemp(dir=tmpdir_path), 6, 6, 4.0)
    assert _within(few_keys, 4, min(6, slots)) and few_keys[-1] - few_keys[0] > 0.5
    failing = _timed_calls(spark, tempfile.mkdtemp(dir=tmpdir_path), 6, 2, 10.0, fail_first=True, workers=3)
    assert len(failing) == 18 and _within(failing, 10, 2) and failing[-1] - failing[0] >= 1.0
    waves = _timed_calls(spark, tempfile.mkdtemp(dir=tmpdir_path), 40, 3 * slots, 20.0)
    assert _within(waves, 20, slots) and 40 / (waves[-1] - waves[0]) > 5  # near the budget, not a third of it


def test_one_parse_of_a_response(spark):
    import re

    keys = spark.createDataFrame([("SCRUBJAY000000101",)], "VIN string")
    res = lookup_udf(keys, lambda k: GOOD, rate_per_sec=None)
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"from_json\(", plan)) == 1


def test_repeated_reference_keys(spark):
    """A repeated key that is asked for is an error or one defined row; others, and rows repeated as a whole, do not matter."""
    import pytest

    row = "vin_key string, api_cylinders int, api_make string"
    attrs = spark.createDataFrame([("SCRUBJAY000000101", 8, "B"), ("SCRUBJAY000000101", 6, "C"), ("SCRUBJAY000000101", 6, None),
                                   ("SCRUBJAY000000202", 4, "A"), ("SCRUBJAY000000202", 4, "A")], row)
    ask = lambda *k: spark.createDataFrame([(x,) for x in k], "VIN string")
    assert [r.api_cylinders for r in lookup_table(ask("SCRUBJAY000000202", "SCRUBJAY000000303"), attrs).orderBy("VIN").collect()] == [4, None]
    with pytest.raises(Exception, match="repeated vin_key: SCRUBJAY000000101"):
        lookup_table(ask("SCRUBJAY000000101", "SCRUBJAY000000202"), attrs).collect()
    got = lookup_table(ask("SCRUBJAY000000101", "SCRUBJAY000000202"), attrs, on_repeat="pick").collect()
    assert sorted((r.VIN, r.api_cylinders, r.api_make) for r in got) == [("SCRUBJAY000000101", 6, None), ("SCRUBJAY000000202", 4, "A")]


def test_rate_is_shared_by_the_tasks_that_run(spark, tmpdir_path, monkeypatch):
    """The query was built when the cluster seemed to have three times the slots: the rate still holds and is reached."""
    import tempfile

    from pyspark import SparkContext

    slots = spark.sparkContext.defaultParallelism
    with monkeypatch.context() as m:
        m.setattr(SparkContext, "defaultParallelism", property(lambda self: 3 * slots))
        calls = _timed_calls(spark, tempfile.mkdtemp(dir=tmpdir_path), 60, 2, 20.0)
    assert _within(calls, 20, 2) and 59 / (calls[-1] - calls[0]) > 12
    plan = lookup_udf(spark.createDataFrame([("SCRUBJAY000000101",)], "VIN string"), str, partitions=2)._jdf.queryExecution().optimizedPlan()
    assert "MapInPandas" in plan.toString() and ", true" in plan.toString()


def test_other_key_name_and_self_derived_reference(spark):
    """A key column with another name; the reference table derived from the
    same frame as the keys (self-join safe)."""
    from scrubjay.operators.keys import keys_to_enrich
    from scrubjay.operators.merge import merge_lookup

    df = spark.createDataFrame([(1, "SCRUBJAY000000101", None, 8), (2, "SCRUBJAY000000101", "", 8),
                                (3, "SCRUBJAY0AZ123805", None, None)],
                               "id long, vin string, cylinders string, known int")
    attrs = df.filter("known is not null").selectExpr("vin as vin_key", "known as api_cylinders").distinct()
    keys = keys_to_enrich(df, key="vin")
    res = lookup_table(keys, attrs, key="vin")
    assert "vin" in res.columns
    out = {r.id: r.cylinders for r in merge_lookup(df, res, key="vin").collect()}
    assert out == {1: "8.0", 2: "8.0", 3: None}


def test_threaded_workers_same_results_and_overlap(spark):
    import time

    def slow(k):
        time.sleep(0.2)
        return {"Results": [{"EngineCylinders": str(len(k) % 5 + 4), "Make": k[:3]}]}

    keys = spark.createDataFrame([(f"SCRUBJAY0AZ{i:06d}",) for i in range(16)], "VIN string")
    seq = lookup_udf(keys, slow, partitions=1, rate_per_sec=None, workers=1)
    par = lookup_udf(keys, slow, partitions=1, rate_per_sec=None, workers=8)
    t0 = time.perf_counter()
    a = sorted((r.VIN, r.api_cylinders, r.api_make) for r in par.collect())
    t_par = time.perf_counter() - t0
    b = sorted((r.VIN, r.api_cylinders, r.api_make) for r in seq.collect())
    assert a == b and len(a) == 16
    assert t_par < 16 * 0.2 * 0.6  # 8 threads overlap the waits (sequential would be 3.2 s)

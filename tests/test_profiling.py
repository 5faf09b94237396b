"""Profiles and remediation."""

import pytest
from pyspark.sql import functions as F

from scrubjay.operators.cleaning import clean_stats, drop_missing, dry_run_estimate
from scrubjay.operators.profiling import cardinality, key_profile, null_profile, numeric_profile
from scrubjay.operators.remediation import (cap_outliers, drop_all_null, flag_invalid_key, impute,
                                            null_out_of_range)

ROWS = [(1, "SCRUBJAY000000101", 100.0, 2014, None, "white"),
        (2, None, float("nan"), 1975, None, None),
        (3, "SHORT", 3.7e9, None, None, "blue"),
        (4, "SCRUBJAY0AZ12380I", 5.0, 2001, None, "white")]
SCHEMA = "id long, VIN string, price double, year int, county string, paint_color string"


def test_null_profile_counts_nan(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    p = {r.column_name: r for r in null_profile(df).collect()}
    assert p["price"].null_count == 1 and p["county"].null_count == 4 and p["county"].null_pct == 100.0
    assert p["VIN"].null_pct == 25.0


def test_key_profile(spark):
    r = key_profile(spark.createDataFrame(ROWS, SCHEMA)).first()
    assert (r.total_rows, r.len17_rows, r.valid_rows, r.missing_or_invalid_rows) == (4, 2, 1, 2)


def test_cardinality_and_numeric(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    c = {r.column_name: r.n_distinct for r in cardinality(df, ["paint_color", "year"]).collect()}
    assert c == {"paint_color": 2, "year": 3}
    ca = {r.column_name: r.n_distinct for r in cardinality(df, ["paint_color"], approx=True).collect()}
    assert ca == {"paint_color": 2}
    n = {r.column_name: r for r in numeric_profile(df, ["price"]).collect()}["price"]
    assert n.n == 3 and n.min_value == 5.0 and n.max_value == 3.7e9


def test_remediation(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert "county" not in drop_all_null(df).columns
    flags = {r.id: r.vin_invalid for r in flag_invalid_key(df).collect()}
    assert flags == {1: False, 2: True, 3: True, 4: True}
    assert flag_invalid_key(df, exclude=True).count() == 1
    capped = {r.id: (r.price_capped, r.price_outlier) for r in cap_outliers(df, {"price": 250000.0, "odometer": 1e6}).collect()}
    assert capped[3] == (250000.0, True) and capped[1] == (100.0, False)
    yr = {r.id: r.year for r in null_out_of_range(df, "year", lo=1981).collect()}
    assert yr == {1: 2014, 2: None, 3: None, 4: 2001}
    assert null_out_of_range(df, "year", lo=1981, exclude=True).count() == 2
    imp = {r.id: r.paint_color for r in impute(df, ["paint_color"]).collect()}
    assert imp[2] == "unknown"


def test_cleaning(spark):
    df = spark.createDataFrame([(1, "8"), (2, None), (3, ""), (4, " ")], "id long, cylinders string")
    assert drop_missing(df).count() == 3
    assert drop_missing(df, "engine").count() == 4
    s = clean_stats(df).first()
    assert (s.total_rows, s.filtered_rows, s.cleaned_rows, s.retention_pct) == (4, 1, 3, 75.0)
    s2 = clean_stats(df, "engine").first()
    assert (s2.filtered_rows, s2.cleaned_rows) == (0, 4)
    d = dry_run_estimate(df, n=2).first()
    assert (d.sample_rows, d.sample_null_rows, d.estimated_rows, d.estimated_null_rows) == (2, 1, 4, 2)


def test_sample_is_the_same_whatever_the_split(spark):
    from scrubjay.operators.profiling import profile_sample

    df = spark.range(20000).selectExpr("id", "id % 7 AS g")
    rows = lambda d: sorted(map(tuple, d.collect()))
    tenth = rows(profile_sample(df, 0.1, "id"))
    assert 1600 < len(tenth) < 2400
    assert tenth == rows(profile_sample(df.repartition(13).orderBy("g"), 0.1, "id"))
    assert set(tenth) <= set(rows(profile_sample(df, 0.3, "id"))) and tenth != rows(profile_sample(df, 0.1, "id", seed=1))
    assert rows(profile_sample(df)) == rows(profile_sample(df.repartition(5)))
    assert rows(profile_sample(df, 0.0)) == [] and len(rows(profile_sample(df, 1.0))) == 20000
    with pytest.raises(ValueError):
        profile_sample(df, 1.5)


def test_sampled_counts_and_their_errors(spark):
    """Keys with several rows: over many seeds the estimate is right on average and the stated error is its spread."""
    import statistics

    from scrubjay.operators.profiling import sampled_nulls

    df = spark.range(3000).selectExpr("id % 500 AS k", "if(id % 500 % 5 = 0, null, 1) AS v").cache()
    got = [sampled_nulls(df, "k", ["v"], 0.2, seed=s).first() for s in range(25)]
    ests = [r.est_nulls for r in got]
    assert abs(statistics.mean(ests) - 600) < 60
    assert 0.6 < statistics.stdev(ests) / statistics.mean(r.est_nulls_error for r in got) < 1.6
    none = sampled_nulls(df.limit(0), "k", ["v"], 0.2).first()
    assert (none.sample_rows, none.est_nulls, none.est_nulls_error) == (0, 0, 0)
    df.unpersist()


def test_united_sketches_equal_the_whole_tables(spark, tmpdir_path):
    from scrubjay.operators.profiling import sketch_columns, sketch_profile

    df = spark.range(20000).selectExpr("id % 7 AS day", "id % 4000 AS c", "if(id % 11 = 0, double('nan'), cast(id AS double)) AS x", "cast(null AS double) AS none")
    parts = sketch_columns(df, ["day"], ["c"], ["x", "none"])
    parts.where("day < 4").write.parquet(f"{tmpdir_path}/s")
    parts.where("day >= 4").write.mode("append").parquet(f"{tmpdir_path}/s")
    stored = sketch_profile(spark.read.parquet(f"{tmpdir_path}/s"), ["c"], ["x", "none"], (0.1, 0.5))
    whole = sketch_profile(sketch_columns(df.withColumn("day", F.lit(0)), ["day"], ["c"], ["x", "none"]), ["c"], ["x", "none"], (0.1, 0.5))
    a, b = ({r.column_name: r for r in d.collect()} for d in (stored, whole))
    assert abs(a["c"].n_distinct - b["c"].n_distinct) <= 4 and abs(a["c"].n_distinct - 4000) <= 120
    for q, want in (("q0.1", 2000), ("q0.5", 10000)):
        assert abs(a["x"][q] - want) < 400 and abs(b["x"][q] - want) < 400
    assert (a["x"].n, a["x"].min_value, a["x"].max_value) == (b["x"].n, b["x"].min_value, b["x"].max_value) == (18181, 1.0, 19999.0)
    assert (a["none"].n, a["none"].avg_value, a["none"]["q0.5"]) == (0, None, None)
    assert sketch_profile(spark.read.parquet(f"{tmpdir_path}/s").limit(0), ["c"], ["x"]).count() == 2


def test_footers_answer_without_a_scan(spark, tmpdir_path):
    from scrubjay.operators.profiling import footer_profile

    df = spark.range(500).selectExpr("id", "if(id % 3 = 0, null, date_add(date'2024-01-01', cast(id AS int))) AS d", "cast(id AS double) AS x")
    df.repartition(4).write.parquet(f"{tmpdir_path}/t")
    got = footer_profile(spark, f"{tmpdir_path}/t", ["id", "d"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)" in plan and "MIN(id)" in plan
    assert [tuple(r) for r in got.collect()] == [("id", 500, 500, "0", "499"), ("d", 500, 333, "2024-01-02", "2025-05-14")]
    with pytest.raises(ValueError, match="x"):
        footer_profile(spark, f"{tmpdir_path}/t", ["id", "x"])
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_batches_are_full(spark):
    """All batches but the last hold batch_size keys, in key order, whatever the ranges; no window over all rows."""
    from scrubjay.operators.metrics import assign_batches, number_in_order

    keys = spark.range(1003).selectExpr("concat('K', lpad(id * 7919 % 1003, 4, '0')) AS VIN").repartition(5)
    got = assign_batches(keys, 100).collect()
    assert sorted((r.VIN, r.batch_id) for r in got) == [(f"K{i:04d}", i // 100) for i in range(1003)]
    out = number_in_order(keys.withColumn("x", F.lit(1)), ["x"], "no", partitions=3)  # all rows tie
    assert sorted(r.no for r in out.collect()) == list(range(1003))
    plan = assign_batches(keys, 100)._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan and assign_batches(keys.limit(0)).count() == 0
    with pytest.raises(ValueError):
        assign_batches(keys, 0)

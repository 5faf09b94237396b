"""Key selection, merge and fill — the reference's enrichment cases as data."""

from pyspark.sql import functions as F

from scrubjay.operators.joins import hot_keys, skew_safe_left_join
from scrubjay.operators.keys import invalid_keys, keys_to_enrich, unseen
from scrubjay.operators.lookup import empty_results, lookup_table
from scrubjay.operators.merge import merge_lookup, rows_updated
from scrubjay.operators.metrics import enrich_stats

SAMPLE = [(1, "SCRUBJAY000000101", None, "nimbus", "vento"),
          (2, "SCRUBJAY0AZ123805", "8 cylinders", "mistral", "sirocco"),
          (3, "SHRTKEY000000707", None, "unknown", "unknown"),
          (4, "", None, "unknown", "unknown")]
SCHEMA = "id long, VIN string, cylinders string, make string, model string"
RESULTS = [("SCRUBJAY000000101", 8, "NIMBUS", "Vento", "2011", None, None, 1.0, None),
           ("SHRTKEY000000707", None, None, None, None, None, None, 0.5, "Invalid VIN format")]
RSCHEMA = ("VIN string, api_cylinders int, api_make string, api_model string, api_year string, "
           "api_engine_displacement string, api_fuel_type string, api_response_time double, "
           "api_error_message string")


def test_keys_to_enrich(spark):
    df = spark.createDataFrame(SAMPLE, SCHEMA)
    assert {r.VIN for r in keys_to_enrich(df).collect()} == {"SCRUBJAY000000101", "SHRTKEY000000707"}
    assert {r.VIN for r in keys_to_enrich(df, skip_existing=False).collect()} == {
        "SCRUBJAY000000101", "SCRUBJAY0AZ123805", "SHRTKEY000000707"}
    # no value column: every usable key
    assert keys_to_enrich(df.drop("cylinders")).count() == 3
    assert {r.VIN for r in invalid_keys(df).collect()} == {"SHRTKEY000000707"}


def test_unseen(spark):
    keys = spark.createDataFrame([("A",), ("B",), ("C",)], "VIN string")
    seen = spark.createDataFrame([("B",), (None,)], "VIN string")
    assert sorted(r.VIN for r in unseen(keys, seen).collect()) == ["A", "C"]


def test_merge_fill(spark):
    df = spark.createDataFrame(SAMPLE, SCHEMA)
    res = spark.createDataFrame(RESULTS, RSCHEMA)
    out = merge_lookup(df, res)
    rows = {r.id: r for r in out.collect()}
    assert out.count() == 4
    assert out.columns[:5] == ["id", "VIN", "cylinders", "make", "model"]
    assert out.columns[5:] == ["api_cylinders", "api_make", "api_model", "api_year",
                               "api_engine_displacement", "api_fuel_type", "api_response_time",
                               "api_error_message"]
    assert rows[1].api_cylinders == 8 and rows[1].api_make == "NIMBUS" and rows[1].cylinders == "8.0"
    assert rows[2].cylinders == "8 cylinders" and rows[2].api_cylinders is None
    assert rows[3].api_error_message == "Invalid VIN format" and rows[3].cylinders is None
    assert rows[4].api_cylinders is None


def test_merge_existing_values(spark):
    # only rows 2 and 3 need a value; text None is looked up but not filled
    df = spark.createDataFrame([(1, "SCRUBJAY000000101", "8"), (2, "SCRUBJAY0AZ123805", None),
                                (3, "SCRUBJAY000000505", ""), (4, "SCRUBJAY000000404", "6 cylinders"),
                                (5, "SCRUBJAY000000202", "None")], "id long, VIN string, cylinders string")
    keys = keys_to_enrich(df)
    assert {r.VIN for r in keys.collect()} == {"SCRUBJAY0AZ123805", "SCRUBJAY000000505", "SCRUBJAY000000202"}
    attrs = spark.createDataFrame([(k, 8) for k in ["SCRUBJAY000000101", "SCRUBJAY0AZ123805",
                                                    "SCRUBJAY000000505", "SCRUBJAY000000202"]],
                                  "vin_key string, api_cylinders int")
    res = lookup_table(keys, attrs)
    rows = {r.id: r for r in merge_lookup(df, res).collect()}
    assert rows[1].cylinders == "8" and rows[1].api_cylinders is None
    assert rows[2].cylinders == "8.0" and rows[3].cylinders == "8.0"
    assert rows[4].cylinders == "6 cylinders" and rows[4].api_cylinders is None
    assert rows[5].cylinders == "None" and rows[5].api_cylinders == 8
    assert rows_updated(df, res).first().rows_updated == 2


def test_merge_numeric_value_column(spark):
    df = spark.createDataFrame([(1, "SCRUBJAY000000101", None), (2, "SCRUBJAY000000101", float("nan")),
                                (3, "SCRUBJAY000000101", 6.0)], "id long, VIN string, cylinders double")
    res = spark.createDataFrame([RESULTS[0]], RSCHEMA)
    rows = {r.id: r.cylinders for r in merge_lookup(df, res).collect()}
    assert rows == {1: 8.0, 2: 8.0, 3: 6.0}


def test_merge_creates_column_and_slim(spark):
    df = spark.createDataFrame(SAMPLE, SCHEMA).drop("cylinders")
    res = spark.createDataFrame(RESULTS, RSCHEMA)
    out = merge_lookup(df, res)
    assert out.columns[-1] == "cylinders"
    assert {r.id: r.cylinders for r in out.collect()}[1] == 8
    slim = merge_lookup(spark.createDataFrame(SAMPLE, SCHEMA), res, include_metadata=False)
    assert [c for c in slim.columns if c.startswith("api_")] == ["api_cylinders"]


def test_merge_is_idempotent(spark):
    df = spark.createDataFrame(SAMPLE, SCHEMA)
    res = spark.createDataFrame(RESULTS, RSCHEMA)
    once = merge_lookup(df, res)
    twice = merge_lookup(once, res)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_merge_empty_results_keeps_schema(spark):
    df = spark.createDataFrame(SAMPLE, SCHEMA)
    out = merge_lookup(df, empty_results(spark))
    assert out.count() == 4 and "api_error_message" in out.columns
    st = enrich_stats(df, empty_results(spark)).first()
    assert (st.total_rows, st.vins_enriched, st.successful_enrichments, st.failed_enrichments) == (4, 0, 0, 0)
    assert st.success_rate is None


def test_golden_fill(spark):
    """sample_missing -> sample_enriched_demo: blank values filled with 8.0,
    the row with a value and no key keeps it and gets null api columns."""
    df = spark.createDataFrame(
        [(7400000001, "SCRUBJAY000000101", None), (7400000002, "SCRUBJAY0AZ123805", None),
         (7400000003, "SCRUBJAY000000505", None), (7400000004, "SCRUBJAY000000404", None),
         (7400000005, None, "6 cylinders")], "id long, VIN string, cylinders string")
    attrs = spark.createDataFrame([(k, 8, "X") for k in ["SCRUBJAY000000101", "SCRUBJAY0AZ123805",
                                                         "SCRUBJAY000000505", "SCRUBJAY000000404"]],
                                  "vin_key string, api_cylinders int, api_make string")
    out = merge_lookup(df, lookup_table(keys_to_enrich(df), attrs))
    rows = {r.id: r for r in out.collect()}
    assert [rows[i].cylinders for i in (7400000001, 7400000002, 7400000003, 7400000004)] == ["8.0"] * 4
    last = rows[7400000005]
    assert last.cylinders == "6 cylinders" and last.api_cylinders is None and last.api_error_message is None


def test_skew_safe_join_equals_plain_join(spark):
    rows = [(i, "HOT" if i % 3 else (None if i % 5 == 0 else f"K{i % 7}")) for i in range(300)]
    left = spark.createDataFrame(rows, "id long, VIN string")
    right = spark.createDataFrame([("HOT", 1), ("K0", 2), ("K3", 3)], "VIN string, v int")
    hot = hot_keys(left, "VIN", min_share=0.2, fraction=1.0)
    assert hot_keys(left, "VIN") == []  # sampled: 300 rows are too few to need salting
    assert hot == ["HOT"]
    a = sorted(map(tuple, skew_safe_left_join(left, right, "VIN", hot=hot, salts=4).collect()),
               key=str)
    b = sorted(map(tuple, left.join(right, "VIN", "left").select("id", "VIN", "v").collect()), key=str)
    assert a == b and len(a) == 300


def test_hot_key_detected_on_sample_and_join_exact(spark):
    """A key holding a third of 300k rows, with its rows clustered in one
    partition, is found from a 1% sample; the salted join is exact."""
    from pyspark.sql import functions as F

    n = 300_000
    left = (spark.range(n).select(F.col("id"), F.when(F.col("id") < n // 3, F.lit("HOT"))
                                  .when(F.col("id") % 10 == 0, F.lit(None))
                                  .otherwise(F.concat(F.lit("K"), (F.col("id") % 5000).cast("string")))
                                  .alias("VIN")).coalesce(4))
    hot = hot_keys(left, "VIN")
    assert hot == ["HOT"]
    right = spark.createDataFrame([("HOT", 1)] + [(f"K{i}", i) for i in range(0, 5000, 7)],
                                  "VIN string, v int")
    j = skew_safe_left_join(left, right, "VIN", hot=hot, salts=8)
    want = left.join(right, "VIN", "left")
    agg = lambda d: d.agg(F.count(F.lit(1)), F.count("v"), F.sum("v"), F.sum("id")).first()
    assert tuple(agg(j)) == tuple(agg(want))


def test_co_located_merge_keeps_bucketing(spark):
    """A listing table bucketed by key: the co-located merge shuffles only the
    lookup side, and gives the same rows as the skew-safe merge."""
    df = spark.createDataFrame(SAMPLE * 5, SCHEMA).withColumn("id", F.monotonically_increasing_id())
    df.write.mode("overwrite").bucketBy(4, "VIN").sortBy("VIN").saveAsTable("listings_bucketed")
    b = spark.table("listings_bucketed")
    res = spark.createDataFrame(RESULTS, RSCHEMA)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = merge_lookup(b, res, co_located=True)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, out.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning") == 1  # the lookup side only
    want = sorted(map(tuple, merge_lookup(b, res, hot=None).collect()), key=str)
    assert got == want and len(got) == 20
    # results derived from the same table (the usual case) resolve cleanly
    attrs = spark.createDataFrame([("SCRUBJAY000000101", 8)], "vin_key string, api_cylinders int")
    derived = merge_lookup(b, lookup_table(keys_to_enrich(b), attrs), co_located=True)
    assert derived.filter("cylinders = '8.0'").count() == 5


def test_building_a_merge_starts_no_job(spark):
    sc = spark.sparkContext
    sc.setJobGroup("merge-build", "")
    df = spark.createDataFrame([(1, "K", None), (2, None, None), (3, " ", None)], "id long, VIN string, cylinders string")
    out = merge_lookup(df, spark.createDataFrame([("K", 8, None, None, None, None, None, 0.0, None)], RSCHEMA))
    assert list(sc.statusTracker().getJobIdsForGroup("merge-build")) == []
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert sorted((r.id, r.cylinders) for r in out.collect()) == [(1, "8.0"), (2, None), (3, None)]


def test_unusable_keys_stay_out_of_a_co_located_join(spark):
    """40% of the keys are NULL or blank: they take no part in the join's tasks."""
    rows = [(i, [None, " ", f"K{i % 97}", f"K{i % 89}", "K5"][i % 5]) for i in range(5000)]
    spark.createDataFrame(rows, "id long, VIN string").write.mode("overwrite").bucketBy(4, "VIN").saveAsTable("null_heavy")
    res = spark.createDataFrame([(f"K{i}", i, None, None, None, None, None, 0.0, None) for i in range(97)], RSCHEMA)
    out = merge_lookup(spark.table("null_heavy"), res, co_located=True, include_metadata=False)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1 and plan.startswith("Union")
    assert out.count() == 5000 and out.filter("api_cylinders IS NULL").count() == 2000
    import pytest
    with pytest.raises(ValueError, match="salt"):
        merge_lookup(spark.table("null_heavy"), res, co_located=True, hot=["K5"])

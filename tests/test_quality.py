"""Quality rules: null handling, empty tables, thresholds, latest run, export."""

from scrubjay.operators.quality import (NonNull, Range, RowCondition, TableCondition, by_dimension,
                                        export_results, latest, run_suite, vehicle_rules)

ROWS = [(1, "SCRUBJAY000000101", "8", 2014), (2, "SCRUBJAY000000101", None, 1899),
        (3, None, "6", 2025), (4, "SHORT", "4", None)]
SCHEMA = "id long, VIN string, cylinders string, year int"


def _by_rule(df):
    return {r.rule_name: r for r in df.collect()}


def test_suite_values(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    r = _by_rule(run_suite(df, vehicle_rules(), scan_id="s", job_id="j", run_ts="2024-01-01 00:00:00"))
    nn = r["cylinders-not-null"]
    assert (nn.evaluated, nn.passed, nn.null_count, nn.pass_ratio, nn.passed_flag) == (4, 3, 1, 0.75, False)
    ln = r["vin-length-check"]  # NULL counts as failing
    assert (ln.evaluated, ln.passed, ln.null_count) == (4, 2, 1)
    un = r["vin-uniqueness"]
    assert (un.evaluated, un.passed, un.passed_flag) == (1, 0, False)
    rg = r["year-range-check"]  # inclusive bounds; NULL fails
    assert (rg.evaluated, rg.passed, rg.null_count) == (4, 2, 1)
    assert {x.dimension for x in r.values()} == {"COMPLETENESS", "VALIDITY", "UNIQUENESS"}


def test_empty_table_passes(spark):
    df = spark.createDataFrame([], SCHEMA)
    r = _by_rule(run_suite(df, vehicle_rules(), job_id="j"))
    assert all(x.passed_flag for x in r.values())
    assert r["vin-uniqueness"].passed == 1


def test_unique_with_null_fails(spark):
    df = spark.createDataFrame([(1, "A", "8", 2000), (2, None, "8", 2000)], SCHEMA)
    r = run_suite(df, [TableCondition(name="u", dimension="UNIQUENESS",
                                      sql_expression="COUNT(DISTINCT VIN) = COUNT(*)")]).first()
    assert r.passed_flag is False


def test_ignore_null_and_threshold(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    rules = [Range(name="yr", dimension="VALIDITY", column="year", min_value="1900",
                   max_value="2025", ignore_null=True, threshold=0.6),
             RowCondition(name="len", dimension="VALIDITY", column="VIN",
                          sql_expression="LENGTH(VIN) = 17", threshold=0.5),
             NonNull(name="nn", dimension="COMPLETENESS", column="VIN")]
    r = _by_rule(run_suite(df, rules))
    assert (r["yr"].evaluated, r["yr"].passed, r["yr"].passed_flag) == (3, 2, True)
    assert r["len"].passed_flag is True
    assert r["nn"].passed == 3


def test_latest_and_dimension(spark, tmpdir_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    a = run_suite(df, vehicle_rules(), scan_id="s", job_id="j1", run_ts="2024-01-01 00:00:00")
    b = run_suite(df, vehicle_rules("1990", "2030"), scan_id="s", job_id="j2", run_ts="2024-02-01 00:00:00")
    target = f"{tmpdir_path}/dq_results"
    export_results(a, target)
    export_results(b, target)
    results = spark.read.parquet(target)
    assert results.count() == 8
    assert {r.job_id for r in latest(results, "s").collect()} == {"j2"}
    assert {r.job_id for r in latest(results, "s", job_id="j1").collect()} == {"j1"}
    dims = {r.dimension: r for r in by_dimension(latest(results, "s")).collect()}
    assert dims["VALIDITY"].rules == 2


def test_quality_source_by_name_or_path(spark, tmpdir_path):
    from scrubjay.operators.quality import quality_source

    df = spark.createDataFrame(ROWS, SCHEMA)
    df.write.mode("overwrite").parquet(f"{tmpdir_path}/v.parquet")
    df.write.mode("overwrite").saveAsTable("dq_vehicles")
    a = run_suite(quality_source(spark, table="dq_vehicles"), vehicle_rules(), job_id="j").collect()
    b = run_suite(quality_source(spark, path=f"{tmpdir_path}/v.parquet"), vehicle_rules(), job_id="j").collect()
    key = lambda r: (r.rule_name, r.evaluated, r.passed)
    assert sorted(map(key, a)) == sorted(map(key, b))


def test_several_distinct_table_rules(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    rules = vehicle_rules() + [TableCondition(name="ids-unique", dimension="UNIQUENESS",
                                              sql_expression="COUNT(DISTINCT id) = COUNT(*)")]
    r = _by_rule(run_suite(df, rules, job_id="j"))
    assert r["ids-unique"].passed_flag is True and r["vin-uniqueness"].passed_flag is False
    assert r["cylinders-not-null"].passed == 3


def test_flag_uses_unrounded_ratio(spark):
    # 1 failure in 3 million rows: the ratio rounds to 1.0 but must still fail
    df = spark.range(3_000_000).selectExpr("case when id = 7 then null else id end as x")
    r = run_suite(df, [NonNull(name="nn", dimension="COMPLETENESS", column="x")]).first()
    assert r.pass_ratio == 1.0 and r.passed_flag is False


def test_export_again_replaces_the_run(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "x")], "id long, VIN string")
    rules = [vehicle_rules()[1]]
    a = run_suite(df, rules, scan_id="s")
    assert a.first().job_id == a.first().job_id and a.first().run_ts == a.first().run_ts
    for _ in range(2):
        export_results(a, f"{tmpdir_path}/r")
        export_results(a, "dq_runs", as_table=True)
    export_results(run_suite(df, rules, scan_id="s"), f"{tmpdir_path}/r")
    export_results(run_suite(df, rules, scan_id="s"), "dq_runs", as_table=True)
    assert spark.read.parquet(f"{tmpdir_path}/r").count() == 2 and spark.table("dq_runs").count() == 2
    assert latest(spark.read.parquet(f"{tmpdir_path}/r"), "s").count() == 1

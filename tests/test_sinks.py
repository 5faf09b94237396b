"""Readers and writers: RFC-4180 round trip, overwrite policy, loads."""

import pytest

from scrubjay.sources.sinks import load_table, path_exists, put_and_verify, write_table
from scrubjay.sources.tables import read_table, require_columns, typed_load

TRICKY = [(1, 'He said "hi"\nthen left', ""), (2, "  padded  ", None), (3, "a,b;c\r\nd", "x"),
          (4, "", " ")]


def test_csv_round_trip_exact(spark, tmpdir_path):
    df = spark.createDataFrame(TRICKY, "id long, text string, note string")
    write_table(df, f"{tmpdir_path}/t.csv", mode="overwrite")
    back = typed_load(read_table(spark, f"{tmpdir_path}/t.csv"), {"id": "bigint"})
    assert sorted(map(tuple, back.collect())) == sorted(TRICKY)


def test_parquet_by_suffix_and_modes(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "a")], "id long, s string")
    write_table(df, f"{tmpdir_path}/t.parquet")
    assert read_table(spark, f"{tmpdir_path}/t.parquet").count() == 1
    with pytest.raises(Exception):
        write_table(df, f"{tmpdir_path}/t.parquet", mode="errorifexists")
    write_table(df, f"{tmpdir_path}/t.parquet", mode="append")
    assert read_table(spark, f"{tmpdir_path}/t.parquet").count() == 2
    assert read_table(spark, f"{tmpdir_path}/t.parquet", where="id = 2").count() == 0


def test_put_and_verify(spark, tmpdir_path):
    df = spark.createDataFrame([(i,) for i in range(10)], "id long")
    uri = f"file://{tmpdir_path}/obj.parquet"
    assert put_and_verify(df, uri) is True
    assert path_exists(spark, uri)
    assert put_and_verify(df, uri) is False  # present, no overwrite
    assert put_and_verify(df, uri, overwrite=True) is True


def test_load_table_typed(spark):
    df = spark.createDataFrame([("7300000001", "8.0"), ("2", "6 cylinders")], "id string, cylinders string")
    n = load_table(df, "typed_listings", mode="overwrite", types={"id": "bigint", "cylinders": "double"})
    assert n == 2
    t = spark.table("typed_listings")
    assert dict(t.dtypes) == {"id": "bigint", "cylinders": "double"}
    assert sorted((r.id, r.cylinders) for r in t.collect()) == [(2, None), (7300000001, 8.0)]
    with pytest.raises(Exception):
        load_table(df, "typed_listings", mode="errorifexists")


def test_require_columns(spark):
    df = spark.createDataFrame([(1,)], "id long")
    with pytest.raises(ValueError, match="must contain a 'VIN' column"):
        require_columns(df, ["VIN"])


def test_predicate_reaches_the_reader(spark):
    from scrubjay.sources.tables import read_table

    df = read_table(spark, "/root/testdata/sf0.001/orders.parquet", where="o_totalprice > 200000", columns=["o_orderkey"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_totalprice,200000.0)" in plan and "o_comment" not in plan


def test_probe_targets(spark, tmpdir_path):
    from scrubjay.sources.sinks import probe_targets

    spark.createDataFrame([(1,)], "i int").write.mode("overwrite").saveAsTable("probed")
    assert probe_targets(spark, file=tmpdir_path, uri=f"file://{tmpdir_path}/none", table="probed") == {
        "file": True, "uri": False, "table": True}
    assert probe_targets(spark, table="never_made") == {"table": False}


def test_no_local_work_folder_on_a_cluster():
    from types import SimpleNamespace as N

    from scrubjay.session import work_dir

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        fake = N(conf=N(get=lambda *a: None), sparkContext=N(getCheckpointDir=lambda: None, master=master))
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            work_dir(fake)

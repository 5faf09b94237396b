"""Outputs are replaced as a whole, after proof; a write or a swap that is cut off loses nothing."""

import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from scrubjay.sources import publish as P
from scrubjay.sources.sinks import load_table, path_exists, put_and_verify, write_table
from scrubjay.sources.tables import read_table


def numbers(spark, n):
    return spark.range(n).withColumn("t", F.concat(F.lit('"\n'), "id"))


def broken(spark, n):
    """Rows of which the last cannot be computed."""
    return numbers(spark, n).withColumn("t", F.when(F.col("id") == n - 1, F.raise_error(F.lit("half-way"))).otherwise(F.col("t")))


@pytest.mark.parametrize("name", ["t.parquet", "t.csv"])
def test_a_failed_overwrite_leaves_the_old_output(spark, tmpdir_path, name):
    at = f"{tmpdir_path}/{name}"
    write_table(numbers(spark, 5), at, mode="overwrite")
    for write in (lambda: write_table(broken(spark, 9), at, mode="overwrite"), lambda: put_and_verify(broken(spark, 9), at, overwrite=True)):
        with pytest.raises(Exception, match="half-way"):
            write()
        assert read_table(spark, at).count() == 5 and os.listdir(tmpdir_path) == [name]
    write_table(numbers(spark, 7), at, mode="overwrite")
    assert read_table(spark, at).count() == 7 and os.listdir(tmpdir_path) == [name]


def test_an_output_may_be_made_from_itself(spark, tmpdir_path):
    at = f"{tmpdir_path}/t.parquet"
    write_table(numbers(spark, 5), at)
    write_table(spark.read.parquet(at).where("id > 2"), at, mode="overwrite")
    assert read_table(spark, at).count() == 2


@pytest.mark.parametrize("name", ["t.parquet", "t.csv"])
def test_put_proves_content_before_the_old_data_goes(spark, tmpdir_path, name, monkeypatch):
    """Storage that loses a file, or returns other rows in the same number, is noticed while the old object is there."""
    at = f"file://{tmpdir_path}/{name}"
    assert put_and_verify(numbers(spark, 5).repartition(2), at)

    def spoiled(how):
        real = P.stage

        def stage(df, *a, **k):
            s = real(df.repartition(3), *a, **k)
            how(s.path.replace("file://", ""))
            return s
        return stage

    def lose(folder):
        name = max(glob.glob(f"{folder}/part-*"), key=os.path.getsize)
        os.remove(name)

    def alter(folder):
        shutil.rmtree(folder)
        write_table(numbers(spark, 20).withColumn("t", F.lit("x")), folder, fmt=name.rsplit(".")[-1])

    import scrubjay.sources.sinks as sinks
    for how in (lose, alter):
        monkeypatch.setattr(sinks, "stage", spoiled(how))
        assert put_and_verify(numbers(spark, 20), at, overwrite=True) is False
        monkeypatch.undo()
        assert read_table(spark, at).count() == 5 and os.listdir(tmpdir_path) == [name]
    assert put_and_verify(numbers(spark, 20), at, overwrite=True) and read_table(spark, at).count() == 20
    assert put_and_verify(numbers(spark, 1), at) is False


@pytest.mark.parametrize("at_step", [1, 2])
def test_a_swap_that_is_cut_off(spark, tmpdir_path, at_step):
    """Dead after the old output has moved aside (1), or after the new one has come but the old one is still there (2)."""
    at = f"{tmpdir_path}/t.parquet"
    write_table(numbers(spark, 5), at)
    s = P.stage(numbers(spark, 8), at, "parquet")
    with open(f"{s.path}/{P.MARKER}", "w") as f:
        f.write("{}")
    os.rename(at, f"{tmpdir_path}/.t.parquet.replaced-x")
    if at_step == 2:
        os.rename(s.path, at)
    assert read_table(spark, at).count() == 8  # the new output was complete
    assert P.recover(spark, at) and not P.recover(spark, at)
    assert os.listdir(tmpdir_path) == ["t.parquet"] and read_table(spark, at).count() == 8


def test_a_write_killed_half_way_is_ignored(spark, tmpdir_path):
    """A staging folder without a marker is never read, whatever became of the old output."""
    at = f"{tmpdir_path}/t.parquet"
    write_table(numbers(spark, 5), at)
    P.stage(numbers(spark, 8), at, "parquet")
    assert read_table(spark, at).count() == 5
    os.rename(at, f"{tmpdir_path}/.t.parquet.replaced-x")
    assert read_table(spark, at).count() == 5 and P.recover(spark, at) and read_table(spark, at).count() == 5
    assert not path_exists(spark, f"{tmpdir_path}/.t.parquet.replaced-x")


def test_checksum_is_free_of_order_and_sees_nulls(spark):
    df = spark.createDataFrame([(1, None, "a", {"k": 1, "l": 2}), (2, "a", None, None), (2, "a", None, None)], "i int, x string, y string, m map<string,int>")
    digest = lambda d: d.agg(*P.content(d)).first()
    assert digest(df) == digest(df.orderBy(F.desc("i")).repartition(3))
    assert digest(df).rows == 3 and digest(df) != digest(df.dropDuplicates(["i"]))
    moved = spark.createDataFrame([(1, "a", None, {"k": 1, "l": 2}), (2, "a", None, None), (2, "a", None, None)], df.schema)
    assert digest(df) != digest(moved) and tuple(digest(df.limit(0))) == (0, "0")


def test_a_failed_load_leaves_the_old_table(spark):
    load_table(numbers(spark, 5), "kept_table", mode="overwrite")
    with pytest.raises(Exception, match="half-way"):
        load_table(broken(spark, 9), "kept_table", mode="overwrite")
    assert spark.table("kept_table").count() == 5
    assert load_table(numbers(spark, 6), "kept_table", mode="overwrite") == 6 and spark.table("kept_table").count() == 6
    assert not [t.name for t in spark.catalog.listTables() if "__staging_" in t.name]

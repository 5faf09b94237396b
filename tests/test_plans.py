"""End-to-end jobs on files: the reference's pipeline edge cases."""

import os

import pytest
from pyspark.sql import functions as F

from scrubjay.operators.lookup import lookup_table, lookup_udf
from scrubjay.plans import clean, enrich
from scrubjay.sources.sinks import write_table
from scrubjay.sources.tables import read_table


def _csv(spark, rows, schema, path):
    write_table(spark.createDataFrame(rows, schema).coalesce(1), path, mode="overwrite", fmt="csv")
    return path


def _attrs(spark, pairs):
    return spark.createDataFrame(pairs, "vin_key string, api_cylinders int, api_make string")


def test_enrich_small_batch_and_rerun(spark, tmpdir_path):
    vins = ["SCRUBJAY000000101", "SCRUBJAY0AZ123805", "SCRUBJAY000000202", "SCRUBJAY000000303",
            "SCRUBJAY000000404"]
    src = _csv(spark, [(i, v, None, 2014) for i, v in enumerate(vins)],
               "id long, VIN string, cylinders string, year int", f"{tmpdir_path}/in.csv")
    attrs = _attrs(spark, [(v, 8, "NIMBUS") for v in vins])
    cache = f"{tmpdir_path}/cache"
    st = enrich(spark, src, f"{tmpdir_path}/out.parquet", lambda k: lookup_table(k, attrs), cache=cache)
    assert (st["total_rows"], st["vins_enriched"], st["successful_enrichments"],
            st["failed_enrichments"], st["rows_updated"]) == (5, 5, 5, 0, 5)
    out = spark.read.parquet(f"{tmpdir_path}/out.parquet")
    assert {r.cylinders for r in out.collect()} == {"8.0"}
    # second run over the same input: every key is already in the lookup table
    st2 = enrich(spark, src, f"{tmpdir_path}/out2.parquet", lambda k: lookup_table(k, attrs), cache=cache)
    assert st2["vins_enriched"] == 0 and st2["rows_updated"] == 5
    with pytest.raises(FileExistsError):
        enrich(spark, src, f"{tmpdir_path}/out.parquet", lambda k: lookup_table(k, attrs),
               cache=cache, overwrite=False)


def test_enrich_errors_and_transient_retry(spark, tmpdir_path):
    src = _csv(spark, [("SCRUBJAY000000101",), ("SHRTKEY000000707",), ("SCRUBJAY0AZ500500",),
                       ("SCRUBJAY0AZ400400",), ("",)], "VIN string", f"{tmpdir_path}/in.csv")
    state = f"{tmpdir_path}/down"
    open(state, "w").close()

    def fetch(key):
        if key == "SCRUBJAY000000101":
            return {"Results": [{"EngineCylinders": "8", "Make": "NIMBUS"}]}
        if key == "SCRUBJAY0AZ500500" and os.path.exists(state):
            raise TimeoutError()
        if key == "SCRUBJAY0AZ400400":
            return {"Results": []}
        return {"Results": [{"EngineCylinders": "6"}]}

    look = lambda k: lookup_udf(k, fetch, partitions=2, rate_per_sec=None, base_delay=0.0)
    cache = f"{tmpdir_path}/cache"
    st = enrich(spark, src, f"{tmpdir_path}/o1", look, cache=cache, fmt="parquet")
    assert (st["total_rows"], st["vins_enriched"], st["successful_enrichments"],
            st["failed_enrichments"]) == (5, 4, 1, 3)
    out = {r.VIN: r for r in spark.read.parquet(f"{tmpdir_path}/o1").collect()}
    assert out["SCRUBJAY000000101"].cylinders == 8  # column created from the lookup (P11)
    assert out["SCRUBJAY0AZ500500"].api_error_message == "API request timeout"
    os.remove(state)  # the service recovers: only the transient failure is retried
    st2 = enrich(spark, src, f"{tmpdir_path}/o2", look, cache=cache, fmt="parquet")
    assert (st2["vins_enriched"], st2["successful_enrichments"]) == (1, 1)
    out2 = {r.VIN: r for r in spark.read.parquet(f"{tmpdir_path}/o2").collect()}
    assert out2["SCRUBJAY0AZ500500"].cylinders == 6
    assert out2["SHRTKEY000000707"].api_error_message == "Invalid VIN format"


def test_enrich_header_only_single_row_and_many(spark, tmpdir_path):
    attrs = _attrs(spark, [(f"SCRUBJAY0AZ{i:06d}", 8 if i % 2 == 0 else 6, "MISTRAL")
                           for i in range(100)] + [("SCRUBJAY000000101", 8, "NIMBUS")])
    look = lambda k: lookup_table(k, attrs)
    empty = _csv(spark, [], "id long, VIN string, cylinders string", f"{tmpdir_path}/empty.csv")
    st = enrich(spark, empty, f"{tmpdir_path}/e_out.csv", look, stable_schema=False)
    assert (st["total_rows"], st["vins_enriched"], st["successful_enrichments"]) == (0, 0, 0)
    back = read_table(spark, f"{tmpdir_path}/e_out.csv")
    assert back.count() == 0 and "VIN" in back.columns
    one = _csv(spark, [(1, "SCRUBJAY000000101", None)], "id long, VIN string, cylinders string",
               f"{tmpdir_path}/one.csv")
    st = enrich(spark, one, f"{tmpdir_path}/one_out.parquet", look)
    assert (st["total_rows"], st["vins_enriched"], st["successful_enrichments"]) == (1, 1, 1)
    assert spark.read.parquet(f"{tmpdir_path}/one_out.parquet").first().cylinders == "8.0"
    many = _csv(spark, [(i, f"SCRUBJAY0AZ{i:06d}", None) for i in range(100)],
                "id long, VIN string, cylinders string", f"{tmpdir_path}/many.csv")
    st = enrich(spark, many, f"{tmpdir_path}/many_out.parquet", look)
    assert (st["total_rows"], st["vins_enriched"], st["successful_enrichments"]) == (100, 100, 100)
    out = spark.read.parquet(f"{tmpdir_path}/many_out.parquet")
    assert out.filter(F.col("cylinders").isNull()).count() == 0


def test_enrich_requires_key_column(spark, tmpdir_path):
    src = _csv(spark, [(1, "x")], "id long, invalid_column string", f"{tmpdir_path}/bad.csv")
    with pytest.raises(ValueError, match="must contain a 'VIN' column"):
        enrich(spark, src, f"{tmpdir_path}/bad_out.csv", lambda k: k)
    assert not os.path.exists(f"{tmpdir_path}/bad_out.csv")


def test_clean_job(spark, tmpdir_path):
    src = _csv(spark, [(1, "8"), (2, None), (3, ""), (4, "6 cylinders")], "id long, cylinders string",
               f"{tmpdir_path}/raw.csv")
    st = clean(spark, src, f"{tmpdir_path}/clean.csv")
    assert st == {"total_rows": 4, "filtered_rows": 1, "cleaned_rows": 3, "retention_pct": 75.0}
    assert read_table(spark, f"{tmpdir_path}/clean.csv").count() == 3
    st_na = clean(spark, src, f"{tmpdir_path}/clean_na.csv", normalize=True)
    assert st_na["filtered_rows"] == 2  # the text reader's NA tokens: blank is missing too
    absent = clean(spark, src, f"{tmpdir_path}/clean2.csv", column="engine")
    assert absent["filtered_rows"] == 0 and absent["cleaned_rows"] == 4
    with pytest.raises(FileExistsError):
        clean(spark, src, f"{tmpdir_path}/clean.csv", overwrite=False)
    dry = clean(spark, src, f"{tmpdir_path}/never.csv", dry_run=True)
    assert dry["estimated_rows"] == 4 and not os.path.exists(f"{tmpdir_path}/never.csv")


def test_enrich_missing_rows_and_append(spark, tmpdir_path):
    """Read only rows lacking a value (pushed-down filter), enrich them and
    append to an output table."""
    rows = [(1, "SCRUBJAY000000101", None), (2, "SCRUBJAY0AZ123805", "6"), (3, "SCRUBJAY000000202", None)]
    spark.createDataFrame(rows, "id long, VIN string, cylinders string").write.parquet(f"{tmpdir_path}/v.parquet")
    attrs = _attrs(spark, [("SCRUBJAY000000101", 8, "NIMBUS"), ("SCRUBJAY000000202", 4, "LEVANT")])
    missing = read_table(spark, f"{tmpdir_path}/v.parquet", where="cylinders IS NULL")
    out = f"{tmpdir_path}/enriched.parquet"
    st = enrich(spark, missing, out, lambda k: lookup_table(k, attrs), append=True)
    st2 = enrich(spark, missing, out, lambda k: lookup_table(k, attrs), append=True)
    assert st["total_rows"] == 2 and st["rows_updated"] == 2 and st2["rows_updated"] == 2
    got = spark.read.parquet(out)
    assert got.count() == 4 and {r.cylinders for r in got.collect()} == {"8.0", "4.0"}


def test_clean_header_only(spark, tmpdir_path):
    src = _csv(spark, [], "id long, cylinders string", f"{tmpdir_path}/empty.csv")
    st = clean(spark, src, f"{tmpdir_path}/out.csv")
    assert st == {"total_rows": 0, "filtered_rows": 0, "cleaned_rows": 0, "retention_pct": None}


def test_nothing_to_enrich_golden(spark, tmpdir_path):
    """Rows 1-4 have a value and row 5 has no key: nothing is looked up and,
    without a stable schema, the output equals the input."""
    rows = [(7400000001, "SCRUBJAY000000101", "8 cylinders"), (7400000002, "SCRUBJAY0AZ123805", "8 cylinders"),
            (7400000003, "SCRUBJAY000000505", "8 cylinders"), (7400000004, "SCRUBJAY000000404", "8 cylinders"),
            (7400000005, None, "6 cylinders")]
    schema = "id long, VIN string, cylinders string"
    src = _csv(spark, rows, schema, f"{tmpdir_path}/sample.csv")
    attrs = _attrs(spark, [("SCRUBJAY000000101", 8, "NIMBUS")])
    st = enrich(spark, src, f"{tmpdir_path}/out.csv", lambda k: lookup_table(k, attrs), stable_schema=False)
    assert (st["total_rows"], st["vins_enriched"], st["rows_updated"]) == (5, 0, 0)
    back = read_table(spark, f"{tmpdir_path}/out.csv")
    assert back.columns == ["id", "VIN", "cylinders"]
    assert sorted(map(tuple, back.collect()), key=str) == sorted(
        [(str(a), b, c) for a, b, c in rows], key=str)


def test_enrich_normalize_fills_na_tokens(spark, tmpdir_path):
    rows = [(1, "SCRUBJAY000000101", "None"), (2, "SCRUBJAY000000101", "NaN"), (3, "SCRUBJAY000000101", "8")]
    src = _csv(spark, rows, "id long, VIN string, cylinders string", f"{tmpdir_path}/na.csv")
    attrs = _attrs(spark, [("SCRUBJAY000000101", 6, "NIMBUS")])
    look = lambda k: lookup_table(k, attrs)
    enrich(spark, src, f"{tmpdir_path}/raw.parquet", look)
    enrich(spark, src, f"{tmpdir_path}/norm.parquet", look, normalize=True)
    raw = {int(r.id): r.cylinders for r in spark.read.parquet(f"{tmpdir_path}/raw.parquet").collect()}
    norm = {int(r.id): r.cylinders for r in spark.read.parquet(f"{tmpdir_path}/norm.parquet").collect()}
    assert raw == {1: "None", 2: "NaN", 3: "8"}       # text kept: looked up, not filled
    assert norm == {1: "6.0", 2: "6.0", 3: "8"}       # pandas-style reading: filled


def test_enrich_broadcast_or_shuffle_same_output(spark, tmpdir_path):
    """The size check picks broadcast or a shuffle join; results are equal.
    A lookup table full of other inputs' keys is cut to this input's keys
    before it is sized."""
    vins = [f"SCRUBJAY0AZ{i:06d}" for i in range(40)]
    src = _csv(spark, [(i, vins[i % 40], None if i % 3 else "8") for i in range(200)],
               "id long, VIN string, cylinders string", f"{tmpdir_path}/in.csv")
    attrs = _attrs(spark, [(v, 4 + i % 3, "MISTRAL") for i, v in enumerate(vins)])
    look = lambda k: lookup_table(k, attrs)
    cache = f"{tmpdir_path}/cache"
    # an earlier run over many other keys fills the lookup table
    other = _csv(spark, [(i, f"SCRUBJAY1BZ{i:06d}", None) for i in range(3000)],
                 "id long, VIN string, cylinders string", f"{tmpdir_path}/other.csv")
    enrich(spark, other, f"{tmpdir_path}/other_out.parquet", look, cache=cache)
    a = enrich(spark, src, f"{tmpdir_path}/a.parquet", look, cache=cache, broadcast_bytes=1 << 30)
    b = enrich(spark, src, f"{tmpdir_path}/b.parquet", look, cache=cache, broadcast_bytes=0)
    ra = sorted(map(tuple, spark.read.parquet(f"{tmpdir_path}/a.parquet").collect()), key=str)
    rb = sorted(map(tuple, spark.read.parquet(f"{tmpdir_path}/b.parquet").collect()), key=str)
    assert ra == rb and len(ra) == 200 and a["rows_updated"] == b["rows_updated"]


def test_enrich_co_located_bucketed_input(spark, tmpdir_path):
    rows = [(i, f"SCRUBJAY0AZ{i % 7:06d}", None if i % 2 else "8") for i in range(50)]
    spark.createDataFrame(rows, "id long, VIN string, cylinders string").write.mode("overwrite") \
        .bucketBy(4, "VIN").saveAsTable("enrich_bucketed")
    attrs = _attrs(spark, [(f"SCRUBJAY0AZ{i:06d}", 6, "X") for i in range(7)])
    st = enrich(spark, spark.table("enrich_bucketed"), f"{tmpdir_path}/out.parquet",
                lambda k: lookup_table(k, attrs), co_located=True)
    assert st["rows_updated"] == 25
    assert spark.read.parquet(f"{tmpdir_path}/out.parquet").filter("cylinders = '6.0'").count() == 25

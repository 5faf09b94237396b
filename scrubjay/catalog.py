"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator id. Each reads the driver tables (directly or through the fixture
views derived from them) so its work grows with the data."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .functions import keys as fk, text as ft
from .operators import keys as ok, lookup as ol, merge as om, metrics as omt
from .sources import fixtures as fx
from .sources.tables import normalize_na

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _results(spark, sf, skip=True, src=None):
    v = src if src is not None else fx.vehicles(spark, sf)
    keys = ok.keys_to_enrich(v, skip_existing=skip)
    return ol.lookup_table(keys, fx.vin_attrs(spark, sf))


def _written(spark, results):
    """Lookup results as the job has them: a table that is written once."""
    from .session import work_dir

    path = f"{work_dir(spark, 'results')}/results"
    results.write.parquet(path)
    return spark.read.parquet(path)


# -- keys and scalar functions ------------------------------------------------

@query("keys_usable")
def keys_usable(spark, sf):
    return ok.usable_rows(fx.vehicles(spark, sf).select("id", "VIN"))


@query("keys_to_enrich")
def keys_to_enrich(spark, sf):
    return ok.keys_to_enrich(fx.vehicles(spark, sf))


@query("keys_all")
def keys_all(spark, sf):
    return ok.keys_to_enrich(fx.vehicles(spark, sf), skip_existing=False)


@query("keys_invalid")
def keys_invalid(spark, sf):
    return ok.invalid_keys(fx.vehicles(spark, sf))


@query("keys_invalid_rows")
def keys_invalid_rows(spark, sf):
    return ok.invalid_key_rows(fx.vehicles(spark, sf).select("id", "VIN"))


@query("keys_unseen")
def keys_unseen(spark, sf):
    keys = ok.keys_to_enrich(fx.vehicles(spark, sf))
    k = keys.withColumn("_norm", ft.upper_strip("VIN"))
    return ok.unseen(k, fx.vin_attrs(spark, sf), key="_norm", seen_key="vin_key").select("VIN")


@query("fn_validate")
def fn_validate(spark, sf):
    v = fx.vehicles(spark, sf)
    return v.select("id", "VIN", fk.is_valid_key("VIN").alias("is_valid"))


@query("fn_strip")
def fn_strip(spark, sf):
    v = fx.vehicles(spark, sf)
    return v.select("id", "VIN", ft.strip("VIN").alias("vin_stripped"),
                    ft.strip("cylinders").alias("cylinders_stripped"))


@query("fn_length")
def fn_length(spark, sf):
    v = fx.vehicles(spark, sf)
    return v.select("id", ft.length("VIN").alias("vin_length"),
                    ft.length("cylinders").alias("cylinders_length"))


@query("fn_blank_null")
def fn_blank_null(spark, sf):
    v = fx.vehicles(spark, sf)
    return v.select("id", ft.blank_to_null("VIN").alias("vin_or_null"),
                    ft.blank_to_null("cylinders").alias("cylinders_or_null"))


@query("norm_na")
def norm_na(spark, sf):
    return normalize_na(fx.vehicles(spark, sf))


@query("fn_try_int")
def fn_try_int(spark, sf):
    v = fx.vehicles(spark, sf)
    return v.select("id", "cylinders", ft.try_int("cylinders").alias("cylinders_int"),
                    ft.try_int(F.col("id").cast("string")).alias("id_int"))


@query("fn_fingerprint")
def fn_fingerprint(spark, sf):
    d = fx.table(spark, sf, "documents")
    return d.select("doc_id", ft.fingerprint("text").alias("fingerprint"))


# -- lookup and merge ---------------------------------------------------------

@query("lookup_table")
def lookup_table(spark, sf):
    return _results(spark, sf)


@query("enrich_fanout")
def enrich_fanout(spark, sf):
    return om.fanout(fx.vehicles(spark, sf), _results(spark, sf))


@query("merge_fill")
def merge_fill(spark, sf):
    return om.merge_lookup(fx.vehicles(spark, sf), _results(spark, sf))


@query("merge_slim")
def merge_slim(spark, sf):
    return om.merge_lookup(fx.vehicles(spark, sf), _results(spark, sf), include_metadata=False)


@query("merge_create_col")
def merge_create_col(spark, sf):
    v = fx.vehicles(spark, sf).drop("cylinders")
    return om.merge_lookup(v, _results(spark, sf, src=v))


@query("merge_updated_rows")
def merge_updated_rows(spark, sf):
    return om.rows_updated(fx.vehicles(spark, sf), _results(spark, sf))


@query("enrich_stats")
def enrich_stats(spark, sf):
    return omt.enrich_stats(fx.vehicles(spark, sf), _results(spark, sf))


@query("enrich_empty")
def enrich_empty(spark, sf):
    done = fx.vehicles(spark, sf).filter(F.col("cylinders").isin("8.0", "6 cylinders"))
    return omt.enrich_stats(done, _results(spark, sf, src=done))


@query("error_dist")
def error_dist(spark, sf):
    return omt.error_dist(_results(spark, sf))


@query("batch_stats")
def batch_stats(spark, sf):
    return omt.batch_stats(_written(spark, _results(spark, sf)), batch_size=100)


@query("run_summary")
def run_summary(spark, sf):
    return omt.run_summary(_written(spark, _results(spark, sf)), batch_size=100)


# -- cleaning and sources -----------------------------------------------------

from .operators import cleaning as oc, quality as oq, profiling as op, remediation as orm  # noqa: E402
from .sources.tables import filtered_scan, typed_load  # noqa: E402

# 64-bit column types of the warehouse table.
TYPED = {"id": "bigint", "cylinders": "double", "api_cylinders": "bigint", "api_response_time": "double"}
ID_BASE = 7_300_000_000  # real listing ids do not fit in 32 bits


@query("clean_drop_null")
def clean_drop_null(spark, sf):
    return oc.drop_missing(fx.vehicles(spark, sf), "cylinders")


@query("clean_absent_col")
def clean_absent_col(spark, sf):
    return oc.drop_missing(fx.vehicles(spark, sf), "engine")


@query("clean_stats")
def clean_stats(spark, sf):
    return oc.clean_stats(fx.vehicles(spark, sf), "cylinders")


@query("dry_run_estimate")
def dry_run_estimate(spark, sf):
    return oc.dry_run_estimate(fx.vehicles(spark, sf), "cylinders", n=1000, order_by="id")


@query("src_filtered_scan")
def src_filtered_scan(spark, sf):
    return filtered_scan(fx.vehicles(spark, sf), "cylinders", missing=True)


@query("typed_load")
def typed_load_q(spark, sf):
    merged = merge_fill(spark, sf)
    return typed_load(merged.withColumn("id", (F.col("id") + F.lit(ID_BASE)).cast("string")), TYPED)


# -- data quality ---------------------------------------------------------------

SCAN = "vehicles-dq"
RUN1 = ("job-1", "2024-01-01 00:00:00")
RUN2 = ("job-2", "2024-01-02 00:00:00")


def _show_ts(df):
    return df.withColumn("run_ts", F.date_format("run_ts", "yyyy-MM-dd HH:mm:ss"))


def _suite(spark, sf, rules, run=RUN1):
    return oq.run_suite(fx.vehicles(spark, sf), rules, scan_id=SCAN, job_id=run[0], run_ts=run[1])


def _rule(i, year_min="1996", year_max="2000"):
    return oq.vehicle_rules(year_min, year_max)[i]


@query("dq_non_null")
def dq_non_null(spark, sf):
    return _show_ts(_suite(spark, sf, [_rule(0)]))


@query("dq_row_condition")
def dq_row_condition(spark, sf):
    return _show_ts(_suite(spark, sf, [_rule(1)]))


@query("dq_table_condition")
def dq_table_condition(spark, sf):
    return _show_ts(_suite(spark, sf, [_rule(2)]))


@query("dq_range")
def dq_range(spark, sf):
    return _show_ts(_suite(spark, sf, [_rule(3)]))


@query("dq_suite")
def dq_suite(spark, sf):
    return _show_ts(_suite(spark, sf, oq.vehicle_rules("1996", "2000")))


@query("dq_latest")
def dq_latest(spark, sf):
    # Two runs appended to a results table (K8), then the latest fetched (Q7).
    from .session import work_dir

    target = f"{work_dir(spark, 'dq-results')}/results"
    oq.export_results(_suite(spark, sf, oq.vehicle_rules(), RUN1), target)
    oq.export_results(_suite(spark, sf, oq.vehicle_rules("1996", "2000"), RUN2), target)
    return _show_ts(oq.latest(spark.read.parquet(target), SCAN))


@query("dq_by_dimension")
def dq_by_dimension(spark, sf):
    return oq.by_dimension(_suite(spark, sf, oq.vehicle_rules("1996", "2000")))


# -- profiling and remediation --------------------------------------------------

PROFILE_TABLES = {
    "lineitem": (["l_returnflag", "l_linestatus"], ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]),
    "events": (["event_type", "user_id"], ["value"]),
    "customer": (["c_mktsegment", "c_nationkey"], ["c_acctbal"]),
}


@query("prof_nulls")
def prof_nulls(spark, sf):
    return op.null_profile(fx.vehicles(spark, sf))


@query("prof_key")
def prof_key(spark, sf):
    return op.key_profile(fx.vehicles(spark, sf), "VIN")


@query("prof_validity")
def prof_validity(spark, sf):
    return op.validity_profile(fx.vehicles(spark, sf), [("price", ">", 250000), ("year", "<", 1981)])


@query("prof_cardinality")
def prof_cardinality(spark, sf):
    out = None
    for t, (cats, _) in PROFILE_TABLES.items():
        p = op.cardinality(fx.table(spark, sf, t), cats, table_name=t)
        out = p if out is None else out.unionByName(p)
    return out


@query("prof_numeric")
def prof_numeric(spark, sf):
    out = None
    for t, (_, nums) in PROFILE_TABLES.items():
        p = op.numeric_profile(fx.table(spark, sf, t), nums, table_name=t, digits=4)
        out = p if out is None else out.unionByName(p)
    return out


@query("fix_drop_null_cols")
def fix_drop_null_cols(spark, sf):
    v = fx.vehicles(spark, sf).withColumn("county", F.lit(None).cast("string"))
    return orm.drop_all_null(v)


@query("fix_flag_key")
def fix_flag_key(spark, sf):
    return orm.flag_invalid_key(fx.vehicles(spark, sf), "VIN", "vin_invalid")


@query("fix_outliers")
def fix_outliers(spark, sf):
    v = fx.vehicles(spark, sf).select("id", "price")
    return orm.cap_outliers(v, {"price": 250000.0, "odometer": 1000000.0})


@query("fix_year")
def fix_year(spark, sf):
    # The fixture's years are 1995-2001, so the pre-1981 cut-off would change
    # nothing; 1997 exercises the operator.
    v = fx.vehicles(spark, sf).select("id", "year")
    return orm.null_out_of_range(v, "year", lo=1997, target="year_fixed")


@query("fix_impute")
def fix_impute(spark, sf):
    return orm.impute(fx.vehicles(spark, sf), ["VIN", "cylinders"], "unknown")


# -- JSON decode and the external lookup -------------------------------------------

from .functions.json import first_result, parse_results  # noqa: E402
from .functions.json import ERR_NO_RESULTS, ERR_NOT_JSON  # noqa: E402


@query("json_decode")
def json_decode(spark, sf):
    r = fx.api_responses(spark, sf)
    r = r.withColumn("_parsed", parse_results(F.col("body"), ["k"]))
    p = first_result("_parsed")
    return r.select(
        "event_id", p["n_results"].cast("int").alias("n_results"),
        F.when(~p["corrupt"], p["first"]["k"]).alias("k"),
        F.when(~p["corrupt"], ft.try_int(p["first"]["k"])).alias("k_int"),
        F.when(p["corrupt"], F.lit(ERR_NOT_JSON))
        .when(p["n_results"] == 0, F.lit(ERR_NO_RESULTS)).alias("error_message"))


# Field names of the service's answer.
def checksum_fetch(key: str):
    """Offline stand-in for the decoding service, deterministic per key:
    MD5 digit 0 -> empty result, f -> timeout; otherwise attributes derived
    from the digest and the key."""
    import hashlib

    h = hashlib.md5(key.encode("utf-8")).hexdigest()
    if h[0] == "0":
        return '{"Results": []}'
    if h[0] == "f":
        raise TimeoutError("read timed out")
    return {"Results": [{"EngineCylinders": str(4 + 2 * (int(h[1], 16) % 3)),
                         "Make": key[:3], "ModelYear": str(1990 + int(h[2], 16)),
                         "Model": "", "DisplacementL": None}]}


@query("lookup_udf")
def lookup_udf(spark, sf):
    keys = ok.keys_to_enrich(fx.vehicles(spark, sf))
    res = ol.lookup_udf(keys, checksum_fetch, rate_per_sec=None,
                        max_attempts=3, base_delay=0.0)
    return res.select("VIN", "api_cylinders", "api_make", "api_model", "api_year",
                      "api_engine_displacement", "api_error_message")


_ATTEMPTS: dict[str, int] = {}  # of this Python worker; a task's retries stay in it


def flaky_fetch(key: str):
    """Fails in a transient way until the third attempt of a key, for good where its MD5 starts with 0."""
    import hashlib

    digest = hashlib.md5(key.encode()).hexdigest()
    _ATTEMPTS[key] = _ATTEMPTS.get(key, 0) + 1
    if digest[0] == "0" or _ATTEMPTS[key] % 3:
        raise ol.TransientLookupError("503")
    return {"Results": [{"EngineCylinders": str(4 + int(digest[1], 16) % 3)}]}


@query("lookup_retry")
def lookup_retry(spark, sf):
    # U4: three attempts; transient failures end as data.
    keys = ok.keys_to_enrich(fx.vehicles(spark, sf))
    res = ol.lookup_udf(keys, flaky_fetch, rate_per_sec=None, max_attempts=3, base_delay=0.0)
    return res.select("VIN", "api_cylinders", "api_error_message")


# -- streaming and file round trips ------------------------------------------------

from .session import work_dir  # noqa: E402
from .sources.sinks import write_table  # noqa: E402
from .sources.tables import read_table  # noqa: E402
from . import streaming as st  # noqa: E402

VEHICLE_SCHEMA = "id bigint, VIN string, cylinders string, year int, price double, paint_color string"


@query("stream_clean")
def stream_clean(spark, sf):
    w = work_dir(spark, "stream-clean")
    st.land_csv(fx.vehicles(spark, sf), f"{w}/in")
    st.stream_clean(spark, f"{w}/in", f"{w}/out", f"{w}/ckpt", VEHICLE_SCHEMA)
    return spark.read.parquet(f"{w}/out").drop("batch_id")


@query("stream_enrich")
def stream_enrich(spark, sf):
    w = work_dir(spark, "stream-enrich")
    st.land_csv(fx.vehicles(spark, sf), f"{w}/in")
    attrs = fx.vin_attrs(spark, sf)
    out, _ = st.stream_enrich(spark, f"{w}/in", w, VEHICLE_SCHEMA,
                              lambda keys: ol.lookup_table(keys, attrs))
    return out


@query("src_csv_roundtrip")
def src_csv_roundtrip(spark, sf):
    w = work_dir(spark, "csv-roundtrip")
    docs = fx.table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    write_table(docs, f"{w}/documents.csv", mode="overwrite")
    back = read_table(spark, f"{w}/documents.csv")
    return typed_load(back, {"doc_id": "bigint", "n_chars": "bigint"})


# -- other driver tables: real NULLs from a join, duplicate texts ---------------

def _labeled(spark, sf):
    """``documents`` LEFT JOIN ``labels``: unlabeled documents carry NULLs."""
    d = fx.table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return d.join(fx.table(spark, sf, "labels"), "doc_id", "left")


@query("prof_nulls_labeled")
def prof_nulls_labeled(spark, sf):
    return op.null_profile(_labeled(spark, sf))


@query("clean_stats_labeled")
def clean_stats_labeled(spark, sf):
    return oc.clean_stats(_labeled(spark, sf), "quality")


def doc_rules() -> list:
    return [
        oq.NonNull(name="text-not-null", column="text", dimension="COMPLETENESS",
                   description="Every document has text"),
        oq.RowCondition(name="text-not-empty", column="text", dimension="VALIDITY",
                        sql_expression="LENGTH(text) > 0", description="Text is not empty"),
        oq.TableCondition(name="text-unique", dimension="UNIQUENESS",
                          sql_expression="COUNT(DISTINCT sha2(text, 256)) = COUNT(*)",
                          description="No two documents share a text"),
        oq.Range(name="n-chars-range", column="n_chars", dimension="VALIDITY",
                 min_value="1", max_value="200000", description="Length between 1 and 200000"),
    ]


@query("dq_docs")
def dq_docs(spark, sf):
    d = fx.table(spark, sf, "documents")
    return _show_ts(oq.run_suite(d, doc_rules(), scan_id="documents-dq", job_id=RUN1[0],
                                 run_ts=RUN1[1]))


DIM_TABLES = {
    "orders": (["o_orderpriority", "o_orderstatus"], ["o_totalprice"]),
    "part": (["p_brand", "p_type"], ["p_size", "p_retailprice"]),
}


@query("prof_cardinality_dims")
def prof_cardinality_dims(spark, sf):
    out = None
    for t, (cats, _) in DIM_TABLES.items():
        p = op.cardinality(fx.table(spark, sf, t), cats, table_name=t)
        out = p if out is None else out.unionByName(p)
    return out


@query("prof_numeric_dims")
def prof_numeric_dims(spark, sf):
    out = None
    for t, (_, nums) in DIM_TABLES.items():
        p = op.numeric_profile(fx.table(spark, sf, t), nums, table_name=t, digits=4)
        out = p if out is None else out.unionByName(p)
    return out


# -- further checked forms ---------------------------------------------------------

@query("src_pushed_scan")
def src_pushed_scan(spark, sf):
    # A predicate on a stored column reaches the Parquet reader.
    return read_table(spark, f"{sf.rstrip('/')}/orders.parquet", fmt="parquet",
                      where="o_totalprice > 200000 AND o_orderstatus = 'F'",
                      columns=["o_orderkey", "o_totalprice"])


@query("fix_flag_key_exclude")
def fix_flag_key_exclude(spark, sf):
    return orm.flag_invalid_key(fx.vehicles(spark, sf), "VIN", exclude=True)


@query("fix_year_exclude")
def fix_year_exclude(spark, sf):
    return orm.null_out_of_range(fx.vehicles(spark, sf).select("id", "year"), "year", lo=1997, exclude=True)


@query("fix_outliers_quantity")
def fix_outliers_quantity(spark, sf):
    li = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return orm.cap_outliers(li, {"l_quantity": 40.0, "l_extendedprice": 60000.0})


@query("clean_job_readback")
def clean_job_readback(spark, sf):
    # K2, K3: the job's output, read back.
    from .plans import clean

    out = f"{work_dir(spark, 'clean-job')}/clean.parquet"
    clean(spark, fx.vehicles(spark, sf), out)
    return read_table(spark, out)


@query("append_readback")
def append_readback(spark, sf):
    # K6: two appends to one output.
    out = f"{work_dir(spark, 'append')}/rows.parquet"
    v = fx.vehicles(spark, sf).select("id", "VIN", "cylinders")
    write_table(v.filter("cylinders IS NULL"), out, mode="append")
    write_table(v.filter("cylinders IS NOT NULL"), out, mode="append")
    return read_table(spark, out)


@query("load_table_readback")
def load_table_readback(spark, sf):
    # K5: typed load into a catalog table.
    import uuid

    from .sources.sinks import load_table

    name = f"loaded_{uuid.uuid4().hex}"
    v = fx.vehicles(spark, sf).select((F.col("id") + F.lit(ID_BASE)).cast("string").alias("id"), "VIN", "cylinders")
    load_table(v, name, types={"id": "bigint", "cylinders": "double"})
    return spark.table(name)


@query("csv_quotes_readback")
def csv_quotes_readback(spark, sf):
    # Quotes, separators and line breaks inside fields.
    d = fx.table(spark, sf, "documents")
    hard = d.select("doc_id", F.concat(F.lit('"a", "'), F.col("lang"), F.lit('"\n,'), F.col("source")).alias("field"))
    out = f"{work_dir(spark, 'csv-quotes')}/rows.csv"
    write_table(hard, out)
    return typed_load(read_table(spark, out), {"doc_id": "bigint"})


@query("prof_sample")
def prof_sample(spark, sf):
    # The same orders whatever the split, with scaled counts and their errors.
    return op.sampled_nulls(fx.vehicles(spark, sf), "id", ["VIN", "cylinders"], 0.1)


@query("prof_sketch")
def prof_sketch(spark, sf):
    # Sketches by month, stored, then united; the estimates are compared with the exact figures.
    li = fx.table(spark, sf, "lineitem").withColumn("month", F.trunc("l_shipdate", "month"))
    distinct, numeric = ["l_orderkey", "l_returnflag"], ["l_extendedprice", "l_quantity"]
    path = f"{work_dir(spark, 'sketches')}/by_month"
    op.sketch_columns(li, ["month"], distinct, numeric).write.parquet(path)
    got = op.sketch_profile(spark.read.parquet(path), distinct, numeric)
    exact = op.cardinality(li, distinct).select("column_name", F.col("n_distinct").alias("exactly"))
    return got.join(exact, "column_name", "left").select(
        "column_name", "n", F.round("min_value", 2).alias("min_value"), F.round("max_value", 2).alias("max_value"), F.round("avg_value", 4).alias("avg_value"),
        (F.abs(F.col("n_distinct") - F.col("exactly")) <= 0.04 * F.col("exactly")).alias("distinct_near"))


@query("prof_footers")
def prof_footers(spark, sf):
    # A9, A10, A13 from Parquet footers.
    return op.footer_profile(spark, f"{sf.rstrip('/')}/orders.parquet", ["o_orderkey", "o_custkey"])


@query("required_column")
def required_column(spark, sf):
    # Tables with and without the key column; the check reads no row, the count shows what passed.
    from .sources.tables import require_columns

    out = None
    for name, df in (("vehicles", fx.vehicles(spark, sf)), ("orders", fx.table(spark, sf, "orders"))):
        try:
            n, error = require_columns(df, ["VIN"]).agg(F.count("*").alias("n_rows")), F.lit(None).cast("string")
        except ValueError as e:
            n, error = df.agg(F.lit(None).cast("bigint").alias("n_rows")), F.lit(str(e))
        row = n.select(F.lit(name).alias("table_name"), "n_rows", error.alias("error"))
        out = row if out is None else out.unionByName(row)
    return out


@query("overwrite_policy")
def overwrite_policy(spark, sf):
    # K3: a first run, a refused one, an overwriting one; the rows are those of the last that was allowed.
    from .plans.clean import clean
    from .sources.sinks import probe_targets

    at = f"{work_dir(spark, 'policy')}/cleaned.parquet"
    seen = [probe_targets(spark, file=at)["file"]]
    clean(spark, fx.vehicles(spark, sf), at, column="VIN", overwrite=False)
    seen.append(probe_targets(spark, file=at)["file"])
    try:
        clean(spark, fx.vehicles(spark, sf), at, column="id", overwrite=False)
    except FileExistsError:
        seen.append("refused")
    clean(spark, fx.vehicles(spark, sf), at, column="cylinders", overwrite=True)
    return read_table(spark, at).withColumn("seen", F.lit(str(seen)))


@query("put_readback")
def put_readback(spark, sf):
    # K4: an object is put, refused, and replaced once its successor is proved; what can be read is the last.
    from .sources.sinks import put_and_verify

    uri = f"{work_dir(spark, 'put')}/orders.csv"
    o = fx.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    done = [put_and_verify(o.limit(1), uri), put_and_verify(o, uri), put_and_verify(o, uri, overwrite=True)]
    back = typed_load(read_table(spark, uri), {"o_orderkey": "bigint", "o_totalprice": "double"})
    return back.withColumn("answers", F.lit(str(done)))


@query("src_csv_split")
def src_csv_split(spark, sf):
    # Texts with line breaks, quotes and separators, read in splits.
    d = fx.table(spark, sf, "documents")
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit(" "), F.lit('" ,')), F.lit('\n"'))
    hard = d.select("doc_id", quoted.alias("field"), F.when(F.col("lang") == "en", "").otherwise(F.col("lang")).alias("lang"),
                    F.when(F.col("doc_id") % 3 > 0, F.col("source")).alias("source"))
    out = f"{work_dir(spark, 'csv-split')}/rows.csv"
    write_table(hard, out)
    return typed_load(read_table(spark, out, split_csv=True), {"doc_id": "bigint"})


@query("dq_source_path")
def dq_source_path(spark, sf):
    # A suite over a source addressed by path.
    src = oq.quality_source(spark, path=f"{sf.rstrip('/')}/documents.parquet")
    return _show_ts(oq.run_suite(src, doc_rules(), scan_id="documents-dq", job_id=RUN1[0], run_ts=RUN1[1]))

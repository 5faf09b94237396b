"""ANSI/DuckDB SQL equivalents of the registered queries (the correctness
oracle). Fixture views are inlined as CTEs over the driver tables."""

from __future__ import annotations


def _vin(k: str) -> str:
    return (f"upper(substring(translate(md5(cast({k} as varchar)),'ab','iz'),1,"
            f"case when {k} % 13 = 0 then 16 else 17 end))")


_OWNER = "(case when o_custkey % 4 = 0 then -o_custkey else o_custkey end)"

VEHICLES = f"""vehicles as (
  select o_orderkey as id,
    case when o_orderkey % 11 = 0 then null
         when o_orderkey % 11 = 1 then ''
         when o_orderkey % 11 = 2 then concat(' ', {_vin(_OWNER)}, ' ')
         else {_vin(_OWNER)} end as VIN,
    case o_orderkey % 7 when 0 then null when 1 then '' when 2 then ' '
         when 3 then 'None' when 4 then '8.0' else '6 cylinders' end as cylinders,
    cast(year(o_orderdate) as integer) as year,
    o_totalprice as price,
    o_orderpriority as paint_color
  from orders)"""

VIN_ATTRS = f"""vin_attrs as (
  select {_vin('c_custkey')} as vin_key,
    case when c_custkey % 5 = 0 then null else cast(4 + 2 * (c_custkey % 3) as integer) end as api_cylinders,
    c_mktsegment as api_make,
    case when c_custkey % 5 = 0 then null else cast(2000 + c_custkey % 20 as varchar) end as api_year
  from customer)"""


def valid(x: str) -> str:
    t = f"upper(trim({x}))"
    return (f"coalesce(length(trim({x})) = 17 and {t} not like '%I%' and {t} not like '%O%' "
            f"and {t} not like '%Q%' and regexp_full_match({t}, '[\\p{{L}}\\p{{N}}]+'), false)")


USABLE = "VIN is not null and trim(VIN) <> ''"
MISSING_SELECT = "(cylinders is null or trim(cylinders) = '' or cylinders in ('nan', 'None'))"
MISSING_FILL = "(cylinders is null or trim(cylinders) = '')"


def keys_cte(src: str = "vehicles", skip: bool = True, name: str = "keys") -> str:
    cond = f"{USABLE} and {MISSING_SELECT}" if skip else USABLE
    return f"{name} as (select distinct VIN from {src} where {cond})"


def results_cte(keys: str = "keys", name: str = "results") -> str:
    return f"""{name} as (
  select kn.VIN as VIN,
    a.api_cylinders as api_cylinders, a.api_make as api_make,
    cast(null as varchar) as api_model, a.api_year as api_year,
    cast(null as varchar) as api_engine_displacement, cast(null as varchar) as api_fuel_type,
    cast(0.0 as double) as api_response_time,
    case when not kn.valid then 'Invalid VIN format'
         when a.vin_key is null then 'No results returned from API' end as api_error_message
  from (select VIN, upper(trim(VIN)) as norm, {valid('VIN')} as valid from {keys}) kn
  left join vin_attrs a on kn.norm = a.vin_key and kn.valid)"""


API_COLS = ("api_cylinders, api_make, api_model, api_year, api_engine_displacement, "
            "api_fuel_type, api_response_time, api_error_message")


def with_(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


# The text tokens of a missing value, stated here on their own.
NA = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
      "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def na(x: str) -> str:
    toks = ", ".join(f"'{t}'" for t in NA)
    return f"case when {x} in ({toks}) then null else {x} end"


def try_int(x: str) -> str:
    return (f"case when regexp_full_match(trim({x}), '[+-]?[0-9]+') "
            f"then try_cast(trim({x}) as integer) end")


ENRICH_BASE = with_(VEHICLES, VIN_ATTRS, keys_cte(), results_cte())

FILL = (f"case when {MISSING_FILL.replace('cylinders', 'v.cylinders')} and r.api_cylinders is not null "
        "then cast(cast(r.api_cylinders as double) as varchar) else v.cylinders end")


def stats_sql(src: str, results: str) -> str:
    return f"""select t.total_rows, r.vins_enriched, r.successful_enrichments,
  r.vins_enriched - r.successful_enrichments as failed_enrichments,
  round(r.successful_enrichments * 100.0 / nullif(r.vins_enriched, 0), 4) as success_rate,
  round(r.mean_t, 6) as mean_response_time,
  case when r.sum_t > 0 then round(r.vins_enriched * 60.0 / r.sum_t, 4) end as keys_per_minute
from (select count(*) as total_rows from {src}) t,
     (select count(*) as vins_enriched,
             count(*) filter (where api_cylinders is not null) as successful_enrichments,
             avg(api_response_time) as mean_t, sum(api_response_time) as sum_t from {results}) r"""


ORACLE: dict[str, str] = {
    "keys_usable": with_(VEHICLES) + f"select id, VIN from vehicles where {USABLE}",
    "keys_to_enrich": with_(VEHICLES, keys_cte()) + "select VIN from keys",
    "keys_all": with_(VEHICLES, keys_cte(skip=False)) + "select VIN from keys",
    "keys_invalid": with_(VEHICLES) + f"select distinct VIN from vehicles where {USABLE} and not {valid('VIN')}",
    "keys_invalid_rows": with_(VEHICLES) + f"select id, VIN from vehicles where not {valid('VIN')}",
    "keys_unseen": with_(VEHICLES, VIN_ATTRS, keys_cte())
    + "select VIN from keys where upper(trim(VIN)) not in (select vin_key from vin_attrs)",
    "fn_validate": with_(VEHICLES) + f"select id, VIN, {valid('VIN')} as is_valid from vehicles",
    "fn_strip": with_(VEHICLES) + "select id, VIN, trim(VIN) as vin_stripped, trim(cylinders) as cylinders_stripped from vehicles",
    "fn_length": with_(VEHICLES) + "select id, cast(length(VIN) as bigint) as vin_length, cast(length(cylinders) as bigint) as cylinders_length from vehicles",
    "fn_blank_null": with_(VEHICLES) + "select id, nullif(trim(VIN), '') as vin_or_null, nullif(trim(cylinders), '') as cylinders_or_null from vehicles",
    "norm_na": with_(VEHICLES) + f"""select id, {na('VIN')} as VIN, {na('cylinders')} as cylinders,
  year, price, {na('paint_color')} as paint_color from vehicles""",
    "fn_try_int": with_(VEHICLES) + f"""select id, cylinders, {try_int('cylinders')} as cylinders_int,
  {try_int('cast(id as varchar)')} as id_int from vehicles""",
    "fn_fingerprint": "select doc_id, substring(md5(text), 1, 12) as fingerprint from documents",
    "lookup_table": ENRICH_BASE + "select * from results",
    "enrich_fanout": ENRICH_BASE + """select v.*, r.api_cylinders, r.api_error_message
from vehicles v join results r on v.VIN = r.VIN""",
    "merge_fill": ENRICH_BASE + f"""select v.id, v.VIN, {FILL} as cylinders, v.year, v.price, v.paint_color,
  {', '.join('r.' + c.strip() for c in API_COLS.split(','))}
from vehicles v left join results r on v.VIN = r.VIN""",
    "merge_slim": ENRICH_BASE + f"""select v.id, v.VIN, {FILL} as cylinders, v.year, v.price, v.paint_color,
  r.api_cylinders from vehicles v left join results r on v.VIN = r.VIN""",
    "merge_create_col": with_(VEHICLES, VIN_ATTRS, keys_cte(skip=False), results_cte()) + f"""
select v.id, v.VIN, v.year, v.price, v.paint_color,
  {', '.join('r.' + c.strip() for c in API_COLS.split(','))}, r.api_cylinders as cylinders
from vehicles v left join results r on v.VIN = r.VIN""",
    "merge_updated_rows": ENRICH_BASE + f"""select count(*) filter (where {MISSING_FILL.replace('cylinders', 'v.cylinders')}
  and r.api_cylinders is not null) as rows_updated
from vehicles v left join results r on v.VIN = r.VIN""",
    "enrich_stats": ENRICH_BASE + stats_sql("vehicles", "results"),
    "enrich_empty": with_(VEHICLES, VIN_ATTRS,
                          "done as (select * from vehicles where cylinders in ('8.0', '6 cylinders'))",
                          keys_cte("done"), results_cte()) + stats_sql("done", "results"),
    "error_dist": ENRICH_BASE + "select api_error_message, count(*) as n_keys from results group by 1",
    "batch_stats": ENRICH_BASE + """select batch_id, count(*) as n_keys,
  count(*) filter (where api_cylinders is not null) as successful,
  count(*) filter (where api_cylinders is null) as failed,
  round(avg(api_response_time), 6) as avg_response_time
from (select *, (row_number() over (order by VIN) - 1) // 100 as batch_id from results) group by 1""",
}


def pct_sql(a: str, b: str, digits: int = 4) -> str:
    return f"round(({a})::double / nullif(({b}), 0) * 100.0, {digits})"


MERGE_SELECT = f"""select v.id, v.VIN, {FILL} as cylinders, v.year, v.price, v.paint_color,
  {', '.join('r.' + c.strip() for c in API_COLS.split(','))}
from vehicles v left join results r on v.VIN = r.VIN"""

NULL_CYL = "count(*) filter (where cylinders is null)"

ORACLE.update({
    "clean_drop_null": with_(VEHICLES) + "select * from vehicles where cylinders is not null",
    "clean_absent_col": with_(VEHICLES) + "select * from vehicles",
    "clean_stats": with_(VEHICLES) + f"""select count(*) as total_rows, {NULL_CYL} as filtered_rows,
  count(*) - {NULL_CYL} as cleaned_rows, {pct_sql(f'count(*) - {NULL_CYL}', 'count(*)')} as retention_pct
from vehicles""",
    "dry_run_estimate": with_(VEHICLES, "head as (select * from vehicles order by id limit 1000)",
                              f"s as (select count(*) as sample_rows, {NULL_CYL} as sample_null_rows from head)",
                              "t as (select count(*) as n from vehicles)") + """select sample_rows, sample_null_rows,
  round(sample_null_rows::double / nullif(sample_rows, 0), 6) as null_ratio,
  t.n as estimated_rows,
  cast(floor(t.n * (sample_null_rows::double / nullif(sample_rows, 0))) as bigint) as estimated_null_rows,
  t.n - cast(floor(t.n * (sample_null_rows::double / nullif(sample_rows, 0))) as bigint) as estimated_clean_rows
from s, t""",
    "src_filtered_scan": with_(VEHICLES) + "select * from vehicles where cylinders is null",
    "typed_load": ENRICH_BASE.rstrip() + f""",
m as ({MERGE_SELECT})
select cast(id + 7300000000 as bigint) as id, VIN, try_cast(trim(cylinders) as double) as cylinders, year, price,
  paint_color, cast(api_cylinders as bigint) as api_cylinders, api_make, api_model, api_year,
  api_engine_displacement, api_fuel_type, cast(api_response_time as double) as api_response_time,
  api_error_message
from m""",
})

# -- data quality ---------------------------------------------------------------

RUN1 = ("job-1", "2024-01-01 00:00:00")
RUN2 = ("job-2", "2024-01-02 00:00:00")


def _dq_rules(year_min="1996", year_max="2000"):
    """(name, dimension, column, description, type, evaluated, passed, null_count)."""
    return [
        ("cylinders-not-null", "COMPLETENESS", "cylinders", "Ensure cylinders field is not null",
         "NON_NULL", "count(*)", "count(*) filter (where cylinders is not null)", NULL_CYL),
        ("vin-length-check", "VALIDITY", "VIN", "VIN must be exactly 17 characters", "ROW_CONDITION",
         "count(*)", "count(*) filter (where VIN is not null and coalesce(length(VIN) = 17, false))",
         "count(*) filter (where VIN is null)"),
        ("vin-uniqueness", "UNIQUENESS", None, "VIN values must be unique across all records",
         "TABLE_CONDITION", "1",
         "case when coalesce(count(distinct VIN) = count(*), false) then 1 else 0 end", "null"),
        ("year-range-check", "VALIDITY", "year", f"Year must be between {year_min} and {year_max}",
         "RANGE", "count(*)",
         f"count(*) filter (where year is not null and year >= {year_min} and year <= {year_max})",
         "count(*) filter (where year is null)"),
    ]


def dq_sql(rules, run=RUN1, show_ts=True) -> str:
    parts = []
    for name, dim, col, desc, rtype, ev, ps, nc in rules:
        colv = f"'{col}'" if col else "cast(null as varchar)"
        ratio = f"cast({ps} as double) / nullif(cast({ev} as double), 0)"
        parts.append(f"""select 'vehicles-dq' as scan_id, '{run[0]}' as job_id,
  {f"'{run[1]}'" if show_ts else f"timestamp '{run[1]}'"} as run_ts,
  '{name}' as rule_name, '{dim}' as dimension, {colv} as column_name, '{desc}' as description,
  '{rtype}' as rule_type, cast({ev} as bigint) as evaluated, cast({ps} as bigint) as passed,
  cast({nc} as bigint) as null_count, round({ratio}, 6) as pass_ratio,
  coalesce({ratio} >= 1.0, true) as passed_flag
from vehicles""")
    return "\nunion all\n".join(parts)


_R = _dq_rules()
ORACLE.update({
    "dq_non_null": with_(VEHICLES) + dq_sql(_R[0:1]),
    "dq_row_condition": with_(VEHICLES) + dq_sql(_R[1:2]),
    "dq_table_condition": with_(VEHICLES) + dq_sql(_R[2:3]),
    "dq_range": with_(VEHICLES) + dq_sql(_R[3:4]),
    "dq_suite": with_(VEHICLES) + dq_sql(_R),
    "dq_latest": with_(VEHICLES, f"runs as ({dq_sql(_dq_rules('1900', '2025'), RUN1)}\nunion all\n{dq_sql(_R, RUN2)})")
    + "select * from runs where job_id = (select job_id from runs order by run_ts desc limit 1)",
    "dq_by_dimension": with_(VEHICLES, f"suite as ({dq_sql(_R)})") + """select scan_id, job_id, dimension,
  count(*) as rules, count(*) filter (where passed_flag) as rules_passed,
  cast(sum(evaluated) as bigint) as evaluated, cast(sum(passed) as bigint) as passed,
  round(cast(sum(passed) as double) / nullif(cast(sum(evaluated) as double), 0), 6) as pass_ratio
from suite group by 1, 2, 3""",
})

# -- profiling and remediation --------------------------------------------------

_VCOLS = ["id", "VIN", "cylinders", "year", "price", "paint_color"]


def _nulls_sql(c: str) -> str:
    cond = f"{c} is null or isnan({c})" if c == "price" else f"{c} is null"
    n = f"count(*) filter (where {cond})"
    return f"select '{c}' as column_name, {n} as null_count, {pct_sql(n, 'count(*)')} as null_pct from vehicles"


PROFILE_TABLES = {
    "lineitem": (["l_returnflag", "l_linestatus"], ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]),
    "events": (["event_type", "user_id"], ["value"]),
    "customer": (["c_mktsegment", "c_nationkey"], ["c_acctbal"]),
}

LEN17 = "count(*) filter (where length(VIN) = 17)"
ORACLE.update({
    "prof_nulls": with_(VEHICLES) + "\nunion all\n".join(_nulls_sql(c) for c in _VCOLS),
    "prof_key": with_(VEHICLES) + f"""select count(*) as total_rows, {LEN17} as len17_rows,
  count(*) filter (where {valid('VIN')}) as valid_rows, count(*) filter (where VIN is null) as null_rows,
  count(*) - {LEN17} as missing_or_invalid_rows, {pct_sql(LEN17, 'count(*)')} as len17_pct,
  {pct_sql(f'count(*) - {LEN17}', 'count(*)')} as missing_or_invalid_pct
from vehicles""",
    "prof_validity": with_(VEHICLES) + """select 'price > 250000' as check_name, 'price' as column_name,
  cast(min(price) as double) as min_value, cast(max(price) as double) as max_value, 250000.0::double as threshold,
  count(*) filter (where price > 250000) as n_flagged from vehicles
union all
select 'year < 1981', 'year', cast(min(year) as double), cast(max(year) as double), 1981.0::double,
  count(*) filter (where year < 1981) from vehicles""",
    "prof_cardinality": "\nunion all\n".join(
        f"select '{t}' as table_name, '{c}' as column_name, count(distinct {c}) as n_distinct from {t}"
        for t, (cats, _) in PROFILE_TABLES.items() for c in cats),
    "prof_numeric": "\nunion all\n".join(
        f"""select '{t}' as table_name, '{c}' as column_name, count({c}) as n,
  round(cast(min({c}) as double), 4) as min_value, round(cast(max({c}) as double), 4) as max_value,
  round(avg({c}), 4) as avg_value, round(stddev_samp({c}), 4) as stddev_value from {t}"""
        for t, (_, nums) in PROFILE_TABLES.items() for c in nums),
    "fix_drop_null_cols": with_(VEHICLES) + "select * from vehicles",
    "fix_flag_key": with_(VEHICLES) + f"select *, not {valid('VIN')} as vin_invalid from vehicles",
    "fix_outliers": with_(VEHICLES) + """select id, price, least(price, 250000.0) as price_capped,
  coalesce(price > 250000.0, false) as price_outlier from vehicles""",
    "fix_year": with_(VEHICLES) + "select id, year, case when year >= 1997 then year end as year_fixed from vehicles",
    "fix_impute": with_(VEHICLES) + """select id, coalesce(VIN, 'unknown') as VIN,
  coalesce(cylinders, 'unknown') as cylinders, year, price, paint_color from vehicles""",
})

# -- JSON decode, external lookup, streams, file round trips -----------------------

_BODY = """case when event_type = 'error' then '{"Results":[]}'
  when event_id % 17 = 0 then '<html>Service Unavailable</html>'
  else concat('{"Results":[', props, ']}') end"""
_K = "json_extract_string(body, '$.Results[0].k')"
_N = "coalesce(json_array_length(body, '$.Results'), 0)"
_H = "md5(norm)"
_HIT = f"valid and substring({_H}, 1, 1) not in ('0', 'f')"

ORACLE.update({
    "json_decode": f"""with r as (select event_id, {_BODY} as body from events)
select event_id,
  cast(case when json_valid(body) then {_N} else 0 end as integer) as n_results,
  case when json_valid(body) then {_K} end as k,
  case when json_valid(body) then {try_int(_K)} end as k_int,
  case when not json_valid(body) then 'API request failed: response is not valid JSON'
       when {_N} = 0 then 'No results returned from API' end as error_message
from r""",
    "lookup_udf": with_(VEHICLES, keys_cte(),
                        f"kn as (select VIN, upper(trim(VIN)) as norm, {valid('VIN')} as valid from keys)")
    + f"""select VIN,
  case when {_HIT} then 4 + 2 * (('0x' || substring({_H}, 2, 1))::integer % 3) end as api_cylinders,
  case when {_HIT} then substring(norm, 1, 3) end as api_make,
  cast(null as varchar) as api_model,
  case when {_HIT} then cast(1990 + ('0x' || substring({_H}, 3, 1))::integer as varchar) end as api_year,
  cast(null as varchar) as api_engine_displacement,
  case when not valid then 'Invalid VIN format'
       when substring({_H}, 1, 1) = '0' then 'No results returned from API'
       when substring({_H}, 1, 1) = 'f' then 'API request timeout' end as api_error_message
from kn""",
    "stream_clean": ORACLE["clean_drop_null"],
    "stream_enrich": ORACLE["merge_fill"],
    "src_csv_roundtrip": "select doc_id, text, lang, source, n_chars from documents",
})

# -- other driver tables ----------------------------------------------------------

LABELED = """labeled as (select d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
  from documents d left join labels l on d.doc_id = l.doc_id)"""


def _nulls_of(src: str, c: str) -> str:
    n = f"count(*) filter (where {c} is null)"
    return f"select '{c}' as column_name, {n} as null_count, {pct_sql(n, 'count(*)')} as null_pct from {src}"


_DOC_RULES = [
    ("text-not-null", "COMPLETENESS", "text", "Every document has text", "NON_NULL",
     "count(*)", "count(*) filter (where text is not null)", "count(*) filter (where text is null)"),
    ("text-not-empty", "VALIDITY", "text", "Text is not empty", "ROW_CONDITION", "count(*)",
     "count(*) filter (where text is not null and coalesce(length(text) > 0, false))",
     "count(*) filter (where text is null)"),
    ("text-unique", "UNIQUENESS", None, "No two documents share a text", "TABLE_CONDITION", "1",
     "case when coalesce(count(distinct text) = count(*), false) then 1 else 0 end", "null"),
    ("n-chars-range", "VALIDITY", "n_chars", "Length between 1 and 200000", "RANGE", "count(*)",
     "count(*) filter (where n_chars is not null and n_chars >= 1 and n_chars <= 200000)",
     "count(*) filter (where n_chars is null)"),
]

DIM_TABLES = {
    "orders": (["o_orderpriority", "o_orderstatus"], ["o_totalprice"]),
    "part": (["p_brand", "p_type"], ["p_size", "p_retailprice"]),
}

ORACLE.update({
    "prof_nulls_labeled": with_(LABELED) + "\nunion all\n".join(
        _nulls_of("labeled", c) for c in ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]),
    "clean_stats_labeled": with_(LABELED) + f"""select count(*) as total_rows,
  count(*) filter (where quality is null) as filtered_rows,
  count(*) - count(*) filter (where quality is null) as cleaned_rows,
  {pct_sql('count(*) - count(*) filter (where quality is null)', 'count(*)')} as retention_pct
from labeled""",
    "dq_docs": dq_sql(_DOC_RULES).replace("from vehicles", "from documents")
    .replace("'vehicles-dq' as scan_id", "'documents-dq' as scan_id"),
    "prof_cardinality_dims": "\nunion all\n".join(
        f"select '{t}' as table_name, '{c}' as column_name, count(distinct {c}) as n_distinct from {t}"
        for t, (cats, _) in DIM_TABLES.items() for c in cats),
    "prof_numeric_dims": "\nunion all\n".join(
        f"""select '{t}' as table_name, '{c}' as column_name, count({c}) as n,
  round(cast(min({c}) as double), 4) as min_value, round(cast(max({c}) as double), 4) as max_value,
  round(avg({c}), 4) as avg_value, round(stddev_samp({c}), 4) as stddev_value from {t}"""
        for t, (_, nums) in DIM_TABLES.items() for c in nums),
})

ORACLE.update({
    "run_summary": ENRICH_BASE + "select count(*) as unique_keys_processed, cast(ceil(count(*) / 100.0) as bigint) as chunks_processed from results",
    "src_pushed_scan": "select o_orderkey, o_totalprice from orders where o_totalprice > 200000 and o_orderstatus = 'F'",
    "fix_flag_key_exclude": with_(VEHICLES) + f"select * from vehicles where {valid('VIN')}",
    "fix_year_exclude": with_(VEHICLES) + "select id, year from vehicles where year >= 1997",
    "fix_outliers_quantity": """select l_orderkey, l_linenumber, l_quantity, l_extendedprice,
  least(l_quantity, 40.0::double) as l_quantity_capped, l_quantity > 40 as l_quantity_outlier,
  least(l_extendedprice, 60000.0::double) as l_extendedprice_capped, l_extendedprice > 60000 as l_extendedprice_outlier
from lineitem""",
    "clean_job_readback": with_(VEHICLES) + "select * from vehicles where cylinders is not null",
    "append_readback": with_(VEHICLES) + "select id, VIN, cylinders from vehicles",
    "load_table_readback": with_(VEHICLES) + "select id + 7300000000 as id, VIN, try_cast(trim(cylinders) as double) as cylinders from vehicles",
    "prof_sample": with_(VEHICLES) + """, s as (
  select * from vehicles where ('0x' || substring(md5('42:' || id), 1, 8))::bigint < floor(0.1::double * 4294967296)::bigint),
c as (select 'VIN' as column_name, VIN as v from s union all select 'cylinders', cylinders from s)
select column_name, count(*) as sample_rows, count(*) filter (where v is null) as sample_nulls,
  round(count(*) / 0.1::double, 4) as est_rows, round(count(*) filter (where v is null) / 0.1::double, 4) as est_nulls,
  round(sqrt(count(*) filter (where v is null) * 90.0::double), 4) as est_nulls_error
from c group by 1""",
    "prof_sketch": """select 'l_orderkey' as column_name, null::bigint as n, null::double as min_value, null::double as max_value, null::double as avg_value, true as distinct_near
union all select 'l_returnflag', null, null, null, null, true
union all select 'l_extendedprice', count(*), round(min(l_extendedprice), 2), round(max(l_extendedprice), 2), round(avg(l_extendedprice), 4), null from lineitem
union all select 'l_quantity', count(*), round(min(l_quantity), 2), round(max(l_quantity), 2), round(avg(l_quantity), 4), null from lineitem""",
    "prof_footers": """select 'o_orderkey' as column_name, count(*) as n_rows, count(o_orderkey) as n_present, min(o_orderkey)::varchar as min_value, max(o_orderkey)::varchar as max_value from orders
union all select 'o_custkey', count(*), count(o_custkey), min(o_custkey)::varchar, max(o_custkey)::varchar from orders""",
    "lookup_retry": with_(VEHICLES, keys_cte(),
                          f"kn as (select VIN, upper(trim(VIN)) as norm, {valid('VIN')} as valid from keys)")
    + f"""select VIN, case when valid and substring({_H}, 1, 1) <> '0' then 4 + ('0x' || substring({_H}, 2, 1))::integer % 3 end as api_cylinders,
  case when not valid then 'Invalid VIN format' when substring({_H}, 1, 1) = '0' then 'API request failed: 503' end as api_error_message from kn""",
    "required_column": with_(VEHICLES) + """select 'vehicles' as table_name, count(*) as n_rows, null::varchar as error from vehicles
union all select 'orders', null, 'Input data must contain a ''VIN'' column'""",
    "overwrite_policy": with_(VEHICLES) + "select *, '[False, True, ''refused'']' as seen from vehicles where cylinders is not null",
    "put_readback": """select o_orderkey, o_orderpriority, o_totalprice, '[True, False, True]' as answers from orders""",
    "src_csv_split": """select doc_id, '"' || replace(text, ' ', '" ,') || chr(10) || '"' as field, case when lang = 'en' then '' else lang end as lang,
  case when doc_id % 3 > 0 then source end as source from documents""",
    "csv_quotes_readback": """select doc_id, '"a", "' || lang || '"' || chr(10) || ',' || source as field from documents""",
    "dq_source_path": ORACLE["dq_docs"],
})

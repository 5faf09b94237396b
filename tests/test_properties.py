"""Property tests: Spark expressions agree with Python's str semantics on
random Unicode text (one Spark job per generated batch)."""

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from scrubjay.functions import is_valid_key, strip, try_int

WS = st.sampled_from([" ", "\t", "\n", " ", "　", "\x1c", " ", "​", "\x85"])
KEYISH = st.text(alphabet=st.sampled_from("ABCDEFGHJKLMNPRSTUVWXYZ0123456789IOQéß٣!- "),
                 min_size=15, max_size=19)
TEXT = st.one_of(st.text(max_size=25),
                 st.builds(lambda a, k, b: a + k + b, st.text(WS, max_size=3), KEYISH,
                           st.text(WS, max_size=3)))


def _py_valid(v):
    if not v or not isinstance(v, str):
        return False
    v = v.strip().upper()
    return len(v) == 17 and not any(ch in v for ch in "IOQ") and v.isalnum()


def _py_int(v):
    s = v.strip()
    if not s or not all(c in "0123456789+-" for c in s):
        return None
    try:
        n = int(s)
    except ValueError:
        return None
    return n if -2**31 <= n < 2**31 else None


@settings(max_examples=8, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=300))
def test_strip_and_validity_match_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = df.orderBy("i").select(strip("v").alias("s"), is_valid_key("v").alias("ok"),
                                 try_int("v").alias("n")).collect()
    assert [r.s for r in got] == [v.strip() for v in values]
    assert [r.ok for r in got] == [_py_valid(v) for v in values]
    assert [r.n for r in got] == [_py_int(v) for v in values]


KEYS = ["SCRUBJAY000000101", "SCRUBJAY0AZ123805", " scrubjay000000101 ", "SCRUBJAY000000303",
        "SCRUBJAY0AZ12380I", "SHORT", "", " ", None, "SCRUBJAY000000202"]
VALUES = [None, "", " ", "None", "nan", "8", "6 cylinders"]
ATTRS = {"SCRUBJAY000000101": 8, "SCRUBJAY0AZ123805": None, "SCRUBJAY000000202": 4,
         "SCRUBJAY0AZ12380I": 6}


def _brute(rows, skip=True):
    """The enrichment rules, row by row in plain Python."""
    def usable(k):
        return k is not None and k.strip() != ""

    def miss_select(v):
        return v is None or v.strip() == "" or v in ("nan", "None")

    def miss_fill(v):
        return v is None or v.strip() == ""

    keys = {k for _, k, v in rows if usable(k) and (not skip or miss_select(v))}
    res = {}
    for k in keys:
        if not _py_valid(k):
            res[k] = (None, "Invalid VIN format")
        elif k.strip().upper() in ATTRS:
            res[k] = (ATTRS[k.strip().upper()], None)
        else:
            res[k] = (None, "No results returned from API")
    out = []
    for i, k, v in rows:
        api, err = res.get(k, (None, None))
        fill = miss_fill(v) and api is not None
        out.append((i, k, f"{float(api)}" if fill else v, api, err))
    return sorted(out, key=lambda t: t[0])


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(KEYS), st.sampled_from(VALUES)), min_size=1, max_size=80),
       st.booleans())
def test_merge_matches_brute_force(spark, pairs, skip):
    from scrubjay.operators.keys import keys_to_enrich
    from scrubjay.operators.lookup import lookup_table
    from scrubjay.operators.merge import merge_lookup

    rows = [(i, k, v) for i, (k, v) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "id long, VIN string, cylinders string")
    attrs = spark.createDataFrame(list(ATTRS.items()), "vin_key string, api_cylinders int")
    res = lookup_table(keys_to_enrich(df, skip_existing=skip), attrs)
    got = merge_lookup(df, res, hot=None).select("id", "VIN", "cylinders", "api_cylinders",
                                                 "api_error_message")
    assert sorted(map(tuple, got.collect()), key=lambda t: t[0]) == _brute(rows, skip)


CSV_TEXT = st.one_of(st.none(), st.text(alphabet=st.sampled_from(
    list('ab ,"\n\r;é☃\t\'　')), max_size=30))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(CSV_TEXT, CSV_TEXT), min_size=1, max_size=60))
def test_csv_round_trip_is_exact(spark, tmp_path_factory, pairs):
    from scrubjay.sources.sinks import write_table
    from scrubjay.sources.tables import read_table, typed_load

    rows = [(i, a, b) for i, (a, b) in enumerate(pairs)]
    path = str(tmp_path_factory.mktemp("csv") / "t.csv")
    write_table(spark.createDataFrame(rows, "id long, a string, b string"), path, mode="overwrite")
    back = typed_load(read_table(spark, path), {"id": "bigint"})
    assert sorted(map(tuple, back.collect()), key=lambda t: t[0]) == rows

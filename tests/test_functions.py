"""Scalar functions: key validation, Python-compatible strip/int, NA tokens."""

import hashlib

from pyspark.sql import functions as F

from scrubjay.functions import (blank_to_null, fingerprint, is_valid_key, missing_for_fill,
                                missing_for_select, pct, strip, try_int, usable)
from scrubjay.sources.tables import NA_TOKENS, normalize_na

VALID = ["SCRUBJAY000000101", "SCRUBJAY0AZ123805", "SCRUBJAY000000202", "SCRUBJAY000000303",
         "scrubjay000000101", "Scrubjay000000101", " SCRUBJAY000000101\t", " SCRUBJAY000000101　"]
INVALID = ["", "ABC123", "1234567890123456789", "SCRUBJAY0AZ12380I", "SCRUBJAY0AZ12380O",
           "SCRUBJAY0AZ12380Q", "SCRUBJAY0AZ123!@#", None, "SCRUBJAY0AZ12 805", "   "]


def _py_valid(v):
    if not v or not isinstance(v, str):
        return False
    v = v.strip().upper()
    return len(v) == 17 and not any(ch in v for ch in "IOQ") and v.isalnum()


def _one(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_valid_keys(spark):
    assert _one(spark, VALID, is_valid_key) == [True] * len(VALID)


def test_invalid_keys(spark):
    assert _one(spark, INVALID, is_valid_key) == [False] * len(INVALID)


def test_validity_matches_python_on_unicode(spark):
    cases = ["SCRUBJAY0AZ12380É", "SCRUBJAY0AZ1238٣", "\x1cSCRUBJAY0AZ123805\x1f",
             "SCRUBJAY0AZ12380ß", "SCRUBJAY0AZ12380́", " SCRUBJAY0AZ123805 ",
             "scrubıay0az123805", "SCRUBJAY0AZ123805​"]
    got = _one(spark, cases, is_valid_key)
    assert got == [_py_valid(c) for c in cases]


def test_strip_matches_python(spark):
    cases = [" a ", "\ta\n", " a　", "\x1ca\x1f", "a", "", "  ", "​a​", None]
    assert _one(spark, cases, strip) == [c.strip() if c is not None else None for c in cases]


def test_try_int_like_python(spark):
    cases = ["8", " 8 ", "8.0", "+8", "-2", "V8", "", None, "99999999999", "0"]
    assert _one(spark, cases, try_int) == [8, 8, None, 8, -2, None, None, None, None, 0]


def test_blank_to_null(spark):
    assert _one(spark, [" NIMBUS ", "  ", "", None], blank_to_null) == ["NIMBUS", None, None, None]


def test_missing_flavours(spark):
    vals = [None, "", " ", "nan", "None", "8", "6 cylinders", " None"]
    assert _one(spark, vals, missing_for_select) == [True, True, True, True, True, False, False, False]
    assert _one(spark, vals, missing_for_fill) == [True, True, True, False, False, False, False, False]
    assert _one(spark, [None, "", " ", "x"], usable) == [False, False, False, True]


def test_fingerprint(spark):
    texts = ["hello", "", "été ☃"]
    want = [hashlib.md5(t.encode()).hexdigest()[:12] for t in texts]
    assert _one(spark, texts, fingerprint) == want


def test_pct_guards_zero(spark):
    df = spark.createDataFrame([(1, 4), (1, 0)], "a long, b long")
    assert [r[0] for r in df.select(pct("a", "b")).collect()] == [25.0, None]


def test_normalize_na_exact_tokens(spark):
    vals = NA_TOKENS + [" ", "none", "8"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    got = [r.v for r in normalize_na(df).orderBy("i").collect()]
    assert got == [None] * len(NA_TOKENS) + [" ", "none", "8"]

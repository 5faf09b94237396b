"""Decoding lookup responses with ``from_json`` (F9, F10) — JVM-side, no Python."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType, StructField, StructType, ArrayType

from .text import _c, blank_to_null, try_int

# Attribute names in the vehicle-decoding service response and
# the result column each one feeds.
RESPONSE_FIELDS = {
    "EngineCylinders": "api_cylinders",
    "Make": "api_make",
    "Model": "api_model",
    "ModelYear": "api_year",
    "DisplacementL": "api_engine_displacement",
    "FuelTypePrimary": "api_fuel_type",
}
# Error texts recorded per key.
ERR_INVALID = "Invalid VIN format"
ERR_NO_RESULTS = "No results returned from API"
ERR_NOT_JSON = "API request failed: response is not valid JSON"
ERR_TIMEOUT = "API request timeout"
ERR_REQUEST_PREFIX = "API request failed: "
ERR_UNEXPECTED_PREFIX = "Unexpected error: "


def _schema(fields) -> StructType:
    item = StructType([StructField(f, StringType()) for f in fields])
    return StructType([StructField("Results", ArrayType(item)),
                       StructField("_corrupt_record", StringType())])


def parse_results(body, fields=tuple(RESPONSE_FIELDS)) -> Column:
    """Parse ``{"Results": [{...}, ...]}`` with one ``from_json``. Put the result
    into a column of its own and hand that column to ``first_result`` or
    ``decode_response``: an expression that is used many times is then still
    evaluated once per row.

    Scalars of any JSON type are read as their text (``69`` -> ``"69"``)."""
    return F.from_json(_c(body), _schema(fields),
                       {"columnNameOfCorruptRecord": "_corrupt_record", "mode": "PERMISSIVE"})


def first_result(parsed: str) -> dict[str, Column]:
    """``n_results``, ``first`` (struct of text fields) and ``corrupt`` of a column made by
    ``parse_results``. A missing ``Results`` array counts as zero results (F10); a
    body that is not JSON is ``corrupt`` (D8)."""
    p = F.col(parsed)
    return {"n_results": F.greatest(F.coalesce(F.size(p["Results"]), F.lit(0)), F.lit(0)),
            "first": F.try_element_at(p["Results"], F.lit(1)),
            "corrupt": p["_corrupt_record"].isNotNull() | p.isNull()}


def decode_response(parsed: str) -> dict[str, Column]:
    """Map a column made by ``parse_results`` to the typed ``api_*`` attributes plus an
    error message (F7-F10, D7): cylinders parsed like ``int()``, other attributes
    blank-to-null, a null JSON field is just a null attribute."""
    r = first_result(parsed)
    out: dict[str, Column] = {}
    for src, dst in RESPONSE_FIELDS.items():
        v = r["first"][src]
        out[dst] = try_int(v) if dst == "api_cylinders" else blank_to_null(v)
    out["api_error_message"] = (F.when(r["corrupt"], F.lit(ERR_NOT_JSON))
                                .when(r["n_results"] == 0, F.lit(ERR_NO_RESULTS)))
    return out

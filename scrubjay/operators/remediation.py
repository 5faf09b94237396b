"""The profile's action plan as operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.keys import is_valid_key
from .profiling import _nullish


def all_null_columns(df: DataFrame) -> list[str]:
    """Columns with no value at all: one aggregate pass; only the one-row
    result (a count per column) reaches the driver."""
    if not df.columns:
        return []
    row = df.agg(*[F.count_if(~_nullish(df, c)).alias(f"_{i}")
                   for i, c in enumerate(df.columns)]).first()
    return [c for i, c in enumerate(df.columns) if row[f"_{i}"] == 0]


def drop_all_null(df: DataFrame) -> DataFrame:
    """Drop columns that are entirely NULL, e.g. ``county``."""
    return df.drop(*all_null_columns(df))


def flag_invalid_key(df: DataFrame, key: str = "VIN", flag: str = "vin_invalid",
                     exclude: bool = False) -> DataFrame:
    """Flag rows whose key is missing or invalid, or drop them."""
    bad = ~is_valid_key(F.col(key))
    return df.filter(~bad) if exclude else df.withColumn(flag, bad)


def cap_outliers(df: DataFrame, caps: dict[str, float], flag: bool = True,
                 suffix: str = "_capped") -> DataFrame:
    """Cap values above a threshold (e.g. price 250K, odometer 1M) into
    ``<col>_capped`` and flag them in ``<col>_outlier`` (P16). Columns not in
    the table are skipped."""
    out = df
    for c, t in caps.items():
        if c not in df.columns:
            continue
        col = F.col(f"`{c}`")
        out = out.withColumn(f"{c}{suffix}", F.least(col, F.lit(t).cast(df.schema[c].dataType)))
        if flag:
            out = out.withColumn(f"{c}_outlier", F.coalesce(col > F.lit(t), F.lit(False)))
    return out


def null_out_of_range(df: DataFrame, column: str = "year", lo: float | None = 1981,
                      hi: float | None = None, exclude: bool = False,
                      target: str | None = None) -> DataFrame:
    """Years before the key era (< 1981 by default): set to NULL into
    ``target`` (default: in place), or drop the rows (P17)."""
    c = F.col(f"`{column}`")
    ok = F.lit(True)
    if lo is not None:
        ok = ok & (c >= F.lit(lo))
    if hi is not None:
        ok = ok & (c <= F.lit(hi))
    if exclude:
        return df.filter(ok)
    return df.withColumn(target or column, F.when(ok, c))


def impute(df: DataFrame, cols: list[str], value: str = "unknown",
           blank_too: bool = False) -> DataFrame:
    """Replace missing category values with ``value``."""
    from ..functions.text import strip

    out = []
    for c in df.columns:
        col = F.col(f"`{c}`")
        if c in cols:
            miss = col.isNull() | (strip(col) == "") if blank_too else col.isNull()
            col = F.when(miss, F.lit(value)).otherwise(col).alias(c)
        out.append(col)
    return df.select(*out)

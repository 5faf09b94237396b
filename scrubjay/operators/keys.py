"""Key selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions.keys import is_valid_key, missing_for_fill, missing_for_select, usable
from ..functions.text import upper_strip
from ..sources.tables import require_columns


def value_missing(df: DataFrame, value: str, flavour: str = "select"):
    """Type-aware missing predicate for ``value``: floating NaN counts as
    missing (pandas prints it ``nan``); text uses the P4/P5 predicates."""
    dt = df.schema[value].dataType
    c = F.col(f"`{value}`")
    if isinstance(dt, (DoubleType, FloatType)):
        return c.isNull() | F.isnan(c)
    if dict(df.dtypes)[value] != "string":
        return c.isNull()
    return missing_for_select(c) if flavour == "select" else missing_for_fill(c)


def usable_rows(df: DataFrame, key: str = "VIN") -> DataFrame:
    """Rows whose key is present."""
    require_columns(df, [key])
    return df.filter(usable(F.col(key)))


def keys_to_enrich(df: DataFrame, key: str = "VIN", value: str = "cylinders",
                   skip_existing: bool = True) -> DataFrame:
    """Distinct raw keys that need a lookup.

    With ``skip_existing`` (and ``value`` present) only rows whose value is
    missing in the select flavour count; otherwise every usable key does.
    One column ``key``; never collected. ``distinct`` is a hash aggregate with
    map-side partial aggregation, so a key holding a third of the rows
    shuffles as one row per map task.
    """
    rows = usable_rows(df.select(*([key, value] if value in df.columns else [key])), key)
    if skip_existing and value in df.columns:
        rows = rows.filter(value_missing(rows, value, "select"))
    return rows.select(key).distinct()


def _key_valid(df: DataFrame, key: str, ascii_only: bool = False):
    """Validity of ``key``; a non-text key column is never valid (a number is
    not an identifier, whatever its digits)."""
    if dict(df.dtypes)[key] != "string":
        return F.lit(False)
    return is_valid_key(F.col(key), ascii_only)


def split_keys(keys: DataFrame, key: str = "VIN", ascii_only: bool = False):
    """Add the normalised key and its validity (F1): ``(key, _norm, _valid)``."""
    return keys.select(F.col(key), upper_strip(F.col(key).cast("string"), ascii_only).alias("_norm"),
                       _key_valid(keys, key, ascii_only).alias("_valid"))


def key_stats(df: DataFrame, key: str = "VIN", value: str = "cylinders",
              skip_existing: bool = True) -> DataFrame:
    """One row per present key: ``(key, n_rows, needs_lookup)``.

    A single aggregation (map-side partial) that serves both key selection
    (``needs_lookup``) and hot-key detection (``n_rows``), so a job that
    materialises it scans the key column once.
    """
    cols = [key, value] if value in df.columns else [key]
    rows = usable_rows(df.select(*cols), key)
    need = (value_missing(rows, value, "select")
            if (skip_existing and value in df.columns) else F.lit(True))
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"),
                                 F.max(need).alias("needs_lookup"))


def invalid_keys(df: DataFrame, key: str = "VIN") -> DataFrame:
    """Distinct present keys that fail validation."""
    return (usable_rows(df.select(key), key)
            .filter(~_key_valid(df, key)).select(key).distinct())


def invalid_key_rows(df: DataFrame, key: str = "VIN") -> DataFrame:
    """Rows whose key fails validation, missing keys included (P7, row form)."""
    return df.filter(~_key_valid(df, key))


def unseen(keys: DataFrame, seen: DataFrame, key: str = "VIN",
           seen_key: str | None = None) -> DataFrame:
    """Keys not processed yet: ``keys`` left-anti ``seen`` (J3). The seen table
    is a persisted lookup table, not a driver-side set."""
    sk = seen_key or key
    s = seen.select(F.col(sk).alias("_seen")).filter(F.col("_seen").isNotNull())
    return keys.join(s, keys[key] == s["_seen"], "left_anti")

"""Fan lookup results back out to every listing row and fill gaps (J1, J2,
P5, P8-P11, A6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from .joins import skew_safe_left_join
from .keys import value_missing
from .lookup import API_COLUMNS


def _fill_value(df: DataFrame, value: str) -> Column:
    """The looked-up number in the target column's type. A text column gets
    ``8.0``: the number is a float once NULLs are present (F11, D6)."""
    api = F.col("api_cylinders")
    dt = df.schema[value].dataType
    if isinstance(dt, StringType):
        return api.cast("double").cast("string")
    return api.cast(dt)


def merge_lookup(df: DataFrame, results: DataFrame, key: str = "VIN",
                 value: str = "cylinders", include_metadata: bool = True,
                 hot: list | None = None, salts: int = 16,
                 with_fill_flag: bool = False, broadcast_results: bool = False,
                 co_located: bool = False) -> DataFrame:
    """Listings LEFT JOIN results on the raw key, then fill ``value`` where it
    is missing (fill flavour: NULL/blank) and the lookup has a number.

    * previous ``api_*`` columns are dropped first, so reruns are idempotent
      (D10);
    * ``include_metadata=False`` adds only ``api_cylinders`` (P9);
    * with no ``value`` column, one is created from ``api_cylinders`` and
      appended last (P11);
    * ``with_fill_flag`` adds ``_filled`` (for counting updated rows, A6);
    * ``broadcast_results`` only when the caller has checked their size;
    * ``hot``: keys known to hold many rows (from ``hot_keys`` or a per-key
      statistics table); they are salted. By default skewed shuffles are left
      to AQE, and building the query starts no job;
    * ``co_located=True`` is for a listing table stored bucketed by ``key``:
      the join on the raw key keeps the bucket partitioning, so only the
      lookup side is shuffled. Salting would change the join key, so ``hot``
      is refused; AQE cannot split a bucketed side either, so such a table
      should have no hot keys.

    The join is skew-safe (see ``joins``); row count is preserved because
    results hold one row per key.
    """
    base = df.drop(*[c for c in df.columns if c.startswith("api_")])
    api = API_COLUMNS if include_metadata else ["api_cylinders"]
    res = results.select(F.col(key), *[F.col(c) for c in api])
    if co_located and hot:
        raise ValueError("a co-located merge cannot salt hot keys; use co_located=False")
    j = skew_safe_left_join(base, res, key, hot=hot, salts=salts,
                            broadcast_right=broadcast_results)
    if value in base.columns:
        mask = value_missing(j, value, "fill") & F.col("api_cylinders").isNotNull()
        cols = [F.when(mask, _fill_value(j, value)).otherwise(F.col(f"`{c}`")).alias(c)
                if c == value else F.col(f"`{c}`") for c in base.columns]
        out = j.select(*cols, *api, *([mask.alias("_filled")] if with_fill_flag else []))
    else:
        out = j.select(*[F.col(f"`{c}`") for c in base.columns], *api,
                       F.col("api_cylinders").alias(value),
                       *([F.col("api_cylinders").isNotNull().alias("_filled")]
                         if with_fill_flag else []))
    return out


def fanout(df: DataFrame, results: DataFrame, key: str = "VIN",
           columns: list[str] | None = None, hot: list | None = None,
           salts: int = 16) -> DataFrame:
    """Every listing row whose key was looked up, with the key's result (J2):
    distinct keys in, one value copied to each duplicate row. Same skew-safe
    join as ``merge_lookup``, keeping matched rows only."""
    cols = columns or ["api_cylinders", "api_error_message"]
    res = results.select(F.col(key), *cols, F.lit(True).alias("_matched"))
    j = skew_safe_left_join(df, res, key, hot=hot, salts=salts)
    return j.filter(F.col("_matched")).drop("_matched")


def rows_updated(df: DataFrame, results: DataFrame, key: str = "VIN",
                 value: str = "cylinders") -> DataFrame:
    """Size of the fill mask (A6) as a one-row frame ``rows_updated``."""
    m = merge_lookup(df.select(key, value) if value in df.columns else df.select(key),
                     results, key, value, include_metadata=False, with_fill_flag=True)
    return m.agg(F.count_if(F.col("_filled")).alias("rows_updated"))

"""Drop rows missing a filter column and report what was dropped (P1, P2,
A1, A8, A9, S9)."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, functions as F

from ..functions.text import nullish_in, pct

log = logging.getLogger(__name__)


_nullish = nullish_in


def drop_missing(df: DataFrame, column: str = "cylinders") -> DataFrame:
    """Remove rows whose ``column`` is NULL (or NaN) (P1). When the column is
    absent, warn and pass every row (P2). Plain NULL only: blank text and
    ``None`` text survive cleaning (the enrich step treats them differently).
    """
    if column not in df.columns:
        log.warning("'%s' column not found; passing all rows", column)
        return df
    return df.filter(~_nullish(df, column))


def clean_stats(df: DataFrame, column: str = "cylinders") -> DataFrame:
    """``total_rows, filtered_rows, cleaned_rows, retention_pct`` in one
    global aggregate (A1, A9: exact count, not a line count)."""
    filt = F.count_if(_nullish(df, column)) if column in df.columns else F.lit(0).cast("bigint")
    a = df.agg(F.count(F.lit(1)).alias("total_rows"), filt.alias("filtered_rows"))
    return a.select("total_rows", "filtered_rows",
                    (F.col("total_rows") - F.col("filtered_rows")).alias("cleaned_rows"),
                    pct(F.col("total_rows") - F.col("filtered_rows"), "total_rows", 4)
                    .alias("retention_pct"))


def dry_run_estimate(df: DataFrame, column: str = "cylinders", n: int = 1000,
                     chunk_size: int = 10000, order_by: str | None = "id") -> DataFrame:
    """Estimate what cleaning would drop without writing anything.

    The null ratio comes from a head sample of ``min(n, chunk_size)`` rows
    (first by ``order_by`` so it is deterministic: a per-partition top-k then
    a merge, never a full sort); the row total is exact (a scalar subquery).
    """
    size = min(n, chunk_size)
    head = df.orderBy(order_by).limit(size) if order_by else df.limit(size)
    total = df.select(F.count(F.lit(1))).scalar()
    nulls = F.count_if(_nullish(df, column)) if column in df.columns else F.lit(None).cast("bigint")
    s = head.agg(F.count(F.lit(1)).alias("sample_rows"), nulls.alias("sample_null_rows"))
    ratio = F.try_divide(F.col("sample_null_rows").cast("double"), F.col("sample_rows").cast("double"))
    est_null = F.floor(total * ratio).cast("bigint")
    return s.select("sample_rows", "sample_null_rows", F.round(ratio, 6).alias("null_ratio"),
                    total.alias("estimated_rows"), est_null.alias("estimated_null_rows"),
                    (total - est_null).alias("estimated_clean_rows"))

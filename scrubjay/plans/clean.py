"""The cleaning job (CV): read, drop rows missing the filter column, write
one distributed output, report counts. One job, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators.cleaning import _nullish, dry_run_estimate
from ..session import observed
from ..sources.sinks import path_exists, write_table
from ..sources.tables import normalize_na, read_table


def clean(spark: SparkSession, input_path: str | DataFrame, output_path: str,
          column: str = "cylinders", overwrite: bool = True, dry_run: bool = False,
          normalize: bool = False, fmt: str | None = None,
          input_fmt: str | None = None) -> dict:
    """Returns ``total_rows, filtered_rows, cleaned_rows, retention_pct``.

    ``overwrite=False`` refuses an existing output with ``FileExistsError``
    before doing any work (K3). ``dry_run`` writes nothing and returns the
    head-sample estimate (A8). ``normalize`` folds NA tokens into NULL first
    (S3) — the text-file reader's behaviour. ``input_fmt`` is the format of
    ``input_path`` where its suffix does not tell.
    """
    df = input_path if isinstance(input_path, DataFrame) else read_table(spark, input_path, fmt=input_fmt, split_csv=True)
    if normalize:
        df = normalize_na(df)
    if dry_run:
        order = "id" if "id" in df.columns else None
        return dry_run_estimate(df, column, order_by=order).first().asDict()
    if path_exists(spark, output_path) and not overwrite:
        raise FileExistsError(f"Output {output_path} already exists")
    obs = Observation("clean")
    has = column in df.columns
    filt = F.count_if(_nullish(df, column)) if has else F.lit(0).cast("bigint")
    watched = df.observe(obs, F.count(F.lit(1)).alias("total_rows"), filt.alias("filtered_rows"))
    out = watched.filter(~_nullish(df, column)) if has else watched
    write_table(out, output_path, mode="overwrite", fmt=fmt)
    m = observed(obs, "total_rows", "filtered_rows")
    total, filtered = int(m["total_rows"]), int(m["filtered_rows"])
    return {"total_rows": total, "filtered_rows": filtered, "cleaned_rows": total - filtered,
            "retention_pct": round((total - filtered) * 100.0 / total, 4) if total else None}

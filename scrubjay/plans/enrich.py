"""The enrichment job (EC / BE): read -> keys needing a value -> drop keys
already in the lookup table -> look the rest up once -> append them to the
lookup table -> fan out with a skew-safe join -> write -> summary.

The lookup output is materialised (written) before it is used twice (merge
and statistics); re-evaluating ``mapInPandas`` would call the external
service again.
"""

from __future__ import annotations

import time
import uuid
from typing import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators.keys import key_stats, unseen
from ..operators.merge import merge_lookup
from ..session import drop_dir, observed, work_dir
from ..sources.sinks import path_exists, stored_bytes, write_table
from ..sources.tables import normalize_na, read_table, require_columns
from ..streaming.incremental import append_results, read_lookup_cache, seen_keys


def _hot_from_stats(total: int, kstats: DataFrame, key: str, min_share: float = 0.01) -> list:
    """Hot keys from the exact per-key counts: at most ``1 / min_share`` keys
    can hold ``min_share`` of ``total`` rows, so the list is bounded."""
    max_hot = int(1 / min_share)
    if not total:
        return []
    floor = max(1, int(total * min_share))
    top = (kstats.filter(F.col("n_rows") >= floor).orderBy(F.col("n_rows").desc())
           .limit(max_hot).select(key).collect())
    return [r[key] for r in top]


def _threshold(spark: SparkSession) -> int:
    v = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    try:
        return int(v)
    except ValueError:  # e.g. "10MB"
        units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
        v = v.strip().lower().rstrip("b")
        return int(float(v[:-1]) * units[v[-1]]) if v and v[-1] in units else 10 << 20


def enrich(spark: SparkSession, input_path: str | DataFrame, output_path: str,
           lookup: Callable[[DataFrame], DataFrame], key: str = "VIN",
           value: str = "cylinders", skip_existing: bool = True,
           include_metadata: bool = True, stable_schema: bool = True,
           cache: str | None = None, overwrite: bool = True, detect_skew: bool = True,
           fmt: str | None = None, broadcast_bytes: int | None = None,
           append: bool = False, normalize: bool = False,
           co_located: bool = False, input_fmt: str | None = None) -> dict:
    """Run one enrichment; returns ``total_rows, vins_enriched,
    successful_enrichments, failed_enrichments, success_rate, rows_updated,
    mean_response_time, keys_per_minute, processing_time`` (A3, A6, A16). ``cache`` is the persistent lookup table folder
    (default: a fresh folder under the session's checkpoint dir).
    ``broadcast_bytes`` caps the lookup-table size that may be broadcast
    (default: ``spark.sql.autoBroadcastJoinThreshold``). ``append`` adds the
    enriched rows to an existing output (e.g. enrich only the rows read with
    ``where cylinders IS NULL`` and append them to an enriched table, K6).
    ``input_fmt`` is the format of ``input_path`` where its suffix does not tell.
    ``normalize`` folds the text NA tokens (``""``, ``None``, ``NaN``, ...)
    into NULL first, as a pandas-style CSV reader does (S3); then such
    values are filled, not only looked up. ``co_located`` is for an input
    table bucketed by ``key``: the merge keeps its buckets and shuffles only
    the lookup side (see ``merge_lookup``)."""
    t0 = time.time()
    df = input_path if isinstance(input_path, DataFrame) else read_table(spark, input_path, fmt=input_fmt, split_csv=True)
    require_columns(df, [key])
    if normalize:
        df = normalize_na(df)
    if path_exists(spark, output_path) and not overwrite and not append:
        raise FileExistsError(f"Output {output_path} already exists")
    cache = cache or f"{work_dir(spark, 'lookup')}/cache"
    run = int(time.time() * 1000) * 1000 + uuid.uuid4().int % 1000
    out_mode = "append" if append else "overwrite"

    # Per-key statistics, written once: key selection and hot-key detection
    # both read this (distinct keys) table instead of re-scanning the input.
    # The same pass counts all input rows (``observe``), for hot-key shares.
    stats_path = f"{work_dir(spark, 'keystats')}/key_stats"
    rows_obs = Observation("input_rows")
    counted = df.observe(rows_obs, F.count(F.lit(1)).alias("n"))
    write_table(key_stats(counted, key, value, skip_existing), stats_path, mode="overwrite",
                fmt="parquet")
    n_input = int(observed(rows_obs, "n")["n"])
    kstats = spark.read.parquet(stats_path)
    keys = kstats.filter("needs_lookup").select(key)
    seen = seen_keys(spark, cache, key)
    if seen is not None:
        keys = unseen(keys, seen, key)
    t_lookup = time.time()
    this_run = append_results(lookup(keys), cache, run)
    st = this_run.agg(F.count(F.lit(1)).alias("n"),
                      F.count_if(F.col("api_cylinders").isNotNull()).alias("ok"),
                      F.avg("api_response_time").alias("t")).first()
    attempted, ok, mean_t = int(st["n"]), int(st["ok"]), st["t"]
    lookup_secs = time.time() - t_lookup

    if attempted == 0 and seen is None and not stable_schema:
        obs = Observation("passthrough")
        write_table(df.observe(obs, F.count(F.lit(1)).alias("n")), output_path,
                    mode="overwrite", fmt=fmt)
        total, updated = int(observed(obs, "n")["n"]), 0
    else:
        # Only this input's keys matter: the lookup table (which grows over
        # runs) is cut to them and written once, so the size check measures
        # what the join will really use.
        rel_path = f"{work_dir(spark, 'results')}/results"
        write_table(read_lookup_cache(spark, cache, key).join(kstats.select(key), key, "left_semi"),
                    rel_path, mode="overwrite", fmt="parquet")
        results = spark.read.parquet(rel_path)
        # Broadcast only on a measured size (Parquet bytes on storage, a lower
        # bound of the in-memory size, hence the 1/4); otherwise a shuffle join
        # with hot keys split over several tasks.
        limit = broadcast_bytes if broadcast_bytes is not None else _threshold(spark)
        small = 0 <= stored_bytes(spark, rel_path) <= limit // 4
        hot = (_hot_from_stats(n_input, kstats, key)
               if (detect_skew and not small and not co_located) else None)
        merged = merge_lookup(df, results, key, value, include_metadata, hot=hot,
                              with_fill_flag=True, broadcast_results=small,
                              co_located=co_located)
        obs = Observation("merge")
        watched = merged.observe(obs, F.count(F.lit(1)).alias("n"),
                                 F.count_if(F.col("_filled")).alias("updated"))
        write_table(watched.drop("_filled"), output_path, mode=out_mode, fmt=fmt)
        m = observed(obs, "n", "updated")
        total, updated = int(m["n"]), int(m["updated"])
        drop_dir(spark, rel_path)
    drop_dir(spark, stats_path)
    return {"total_rows": total, "vins_enriched": attempted,
            "successful_enrichments": ok, "failed_enrichments": attempted - ok,
            "success_rate": round(ok * 100.0 / attempted, 4) if attempted else None,
            "rows_updated": updated, "mean_response_time": mean_t,
            "keys_per_minute": attempted * 60.0 / lookup_secs if lookup_secs > 0 else None,
            "processing_time": time.time() - t0}

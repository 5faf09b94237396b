"""Run summaries as one-row / grouped frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import pct
from ..session import work_dir


def success():
    """A cylinder number came back (not merely "no error")."""
    return F.col("api_cylinders").isNotNull()


def enrich_stats(df: DataFrame, results: DataFrame) -> DataFrame:
    """``total_rows, vins_enriched, successful_enrichments, failed_enrichments,
    success_rate, mean_response_time, keys_per_minute`` (A3, A16); the rate is that of
    one caller, NULL if the calls took no time.

    ``vins_enriched`` counts keys *attempted* (including invalid ones);
    success means a cylinder number came back (P12). Both inputs are counted
    in one job: the listing side contributes only a row marker (no columns
    are read), then a single global aggregate with partial aggregation.
    No keys (A7) gives zeros and NULL rates.
    """
    rows = df.select(F.lit(True).alias("_row"), F.lit(None).cast("boolean").alias("_ok"),
                     F.lit(None).cast("double").alias("_t"))
    res = results.select(F.lit(False).alias("_row"), success().alias("_ok"),
                         F.col("api_response_time").alias("_t"))
    a = rows.unionByName(res).agg(
        F.count_if(F.col("_row")).alias("total_rows"),
        F.count_if(~F.col("_row")).alias("vins_enriched"),
        F.count_if(F.col("_ok")).alias("successful_enrichments"),
        F.avg("_t").alias("_mean_t"), F.sum("_t").alias("_sum_t"))
    return a.select(
        "total_rows", "vins_enriched", "successful_enrichments",
        (F.col("vins_enriched") - F.col("successful_enrichments")).alias("failed_enrichments"),
        pct("successful_enrichments", "vins_enriched", 4).alias("success_rate"),
        F.round("_mean_t", 6).alias("mean_response_time"),
        F.when(F.col("_sum_t") > 0, F.round(F.col("vins_enriched") * 60.0 / F.col("_sum_t"), 4))
        .alias("keys_per_minute"))


def error_dist(results: DataFrame) -> DataFrame:
    """Keys per error message, NULL = no error."""
    return results.groupBy("api_error_message").agg(F.count(F.lit(1)).alias("n_keys"))


def number_in_order(df: DataFrame, order: list[str], out: str = "row_no", partitions: int | None = None) -> DataFrame:
    """``df`` plus ``out``: the place of each row, from 0, in ``order`` (missing values first, ties in any order).

    No task sees all rows: they are dealt into ranges, sorted and numbered in each, and written once under the
    work folder; the sizes of earlier ranges, one number a range, are added. ``partitions`` is the number of ranges (default:
    the session's shuffle partitions)."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{work_dir(spark, 'numbered')}/rows"
    # the id is the number of the range and, in its low 33 bits, the place in it
    (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
     .withColumn("_id", F.monotonically_increasing_id()).write.parquet(path))
    rows = spark.read.schema(df.withColumn("_id", F.lit(0).cast("bigint")).schema).parquet(path)
    ranged = rows.withColumn("_range", F.shiftright("_id", 33))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    offsets = (ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
               .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    place = F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.join(F.broadcast(offsets), "_range").withColumn(out, place).drop("_range", "_id", "_before")


def assign_batches(results: DataFrame, batch_size: int = 100, key: str = "VIN") -> DataFrame:
    """``results`` plus ``batch_id`` (P13): batches of exactly ``batch_size`` rows in the order of ``key``, the last one of what is
    left (F13)."""
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    return number_in_order(results, [key], "_no").withColumn("batch_id", F.expr(f"_no div {int(batch_size)}")).drop("_no")


def batch_stats(results: DataFrame, batch_size: int = 100, key: str = "VIN") -> DataFrame:
    """Per-batch successes, failures and mean response time (A4) of ``assign_batches``;
    invalid keys count with 0.0 s. ``results`` is read once, for the columns this takes."""
    b = assign_batches(results.select(key, "api_cylinders", "api_response_time"), batch_size, key)
    return b.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(success()).alias("successful"),
        F.count_if(~success()).alias("failed"),
        F.round(F.avg("api_response_time"), 6).alias("avg_response_time"))


def run_summary(results: DataFrame, batch_size: int = 100, key: str = "VIN") -> DataFrame:
    """``unique_keys_processed`` and ``chunks_processed`` (batches of ``batch_size``, the last one may be
    short) of a batch run (A5)."""
    return results.agg(F.count(F.lit(1)).alias("unique_keys_processed"),
                       F.ceil(F.count(F.lit(1)) / F.lit(batch_size)).cast("bigint").alias("chunks_processed"))

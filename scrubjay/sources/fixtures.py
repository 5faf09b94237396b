"""Listing-shaped views derived from the driver's TPC-H-style tables.

The driver tables hold no listing table and no NULL or blank values, so the
``vehicles`` and ``vin_attrs`` views are pure projections of ``orders`` and
``customer`` that plant every kind of missing/invalid key and value. Their
work grows with the source tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. The tables are read-only, so one DataFrame per
    application and path is reused (no repeated schema inference)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    k = (spark.sparkContext.applicationId, path)
    df = _TABLES.get(k)
    if df is None or df.sparkSession is not spark:
        df = _TABLES[k] = spark.read.parquet(path)
    return df


def synthetic_key(k: Column) -> Column:
    """A 17-character key (16 when k % 13 = 0) from the MD5 of ``k``, with
    ``a``/``b`` mapped to the forbidden ``I`` and ``Z``."""
    n = F.when(k % 13 == 0, F.lit(16)).otherwise(F.lit(17))
    return F.upper(F.translate(F.md5(k.cast("string")), "ab", "iz").substr(F.lit(1), n))


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, VIN, cylinders, year, price, paint_color`` from ``orders``. The keys of every fourth owner are in no
    reference table (the "no results" path)."""
    o = table(spark, sf_dir, "orders")
    k, m11, m7 = F.col("o_orderkey"), F.col("o_orderkey") % 11, F.col("o_orderkey") % 7
    owner = F.col("o_custkey")
    key = synthetic_key(F.when(owner % 4 == 0, -owner).otherwise(owner))  # no customer has a negative number
    vin = (F.when(m11 == 0, F.lit(None).cast("string"))
           .when(m11 == 1, F.lit(""))
           .when(m11 == 2, F.concat(F.lit(" "), key, F.lit(" ")))
           .otherwise(key))
    cyl = (F.when(m7 == 0, F.lit(None).cast("string")).when(m7 == 1, F.lit(""))
           .when(m7 == 2, F.lit(" ")).when(m7 == 3, F.lit("None"))
           .when(m7 == 4, F.lit("8.0")).otherwise(F.lit("6 cylinders")))
    return o.select(k.alias("id"), vin.alias("VIN"), cyl.alias("cylinders"),
                    F.year("o_orderdate").cast("int").alias("year"),
                    F.col("o_totalprice").alias("price"),
                    F.col("o_orderpriority").alias("paint_color"))


def vin_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference decode table ``vin_key, api_cylinders, api_make, api_year``, a row a
    ``customer``; 1 in 5 entries carries no value."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return (c.select(synthetic_key(k).alias("vin_key"),
                     F.when(k % 5 == 0, F.lit(None)).otherwise(4 + 2 * (k % 3))
                     .cast("int").alias("api_cylinders"),
                     F.col("c_mktsegment").alias("api_make"),
                     F.when(k % 5 == 0, F.lit(None))
                     .otherwise((2000 + k % 20).cast("string")).alias("api_year")))


def api_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup-style response bodies from ``events.props``: the props object
    wrapped as ``{"Results":[props]}``; ``error`` events answer with an empty
    result list and every 17th event with a non-JSON body."""
    e = table(spark, sf_dir, "events")
    body = (F.when(F.col("event_type") == "error", F.lit('{"Results":[]}'))
            .when(F.col("event_id") % 17 == 0, F.lit("<html>Service Unavailable</html>"))
            .otherwise(F.concat(F.lit('{"Results":['), F.col("props"), F.lit("]}"))))
    return e.select("event_id", "event_type", body.alias("body"))

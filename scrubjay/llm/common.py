"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import drop_dir, ship_package, work_dir

__all__ = ["table", "materialise", "discard", "without", "number_rows", "connected_components",
           "ship_package", "work_dir", "hex_prefix", "broadcast_value", "broadcast_if_small",
           "first_by_hash"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared work folder and read it back: cuts
    the lineage and survives the loss of executors."""
    spark = df.sparkSession
    path = f"{work_dir(spark, name)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*written: DataFrame) -> None:
    """Remove folders of ``materialise`` that nothing written later still has to be computed from."""
    for df in written:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            drop_dir(df.sparkSession, folder)


def without(df: DataFrame, names: list[str]) -> list[str]:
    """Columns of ``df`` whose names do not clash (in any case) with ``names``:
    an operator's own output column replaces an input column of that name."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def hex_prefix(hex_text: Column, digits: int) -> Column:
    """The first ``digits`` (at most 15) hexadecimal digits as a long."""
    return F.conv(F.substring(hex_text, 1, digits), 16, 10).cast("long")


def broadcast_value(spark: SparkSession, value):
    return spark.sparkContext.broadcast(value)


def broadcast_if_small(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """A hint to broadcast a written table of a few numbers a row, if it has been counted to be at
    most ``rows`` long; else the table itself, for a shuffle join."""
    return F.broadcast(df) if df.count() <= rows else df


def first_by_hash(df: DataFrame, column: str, rows: int, total: int) -> DataFrame:
    """At most ``rows`` rows, the first by a hash of ``column``. Rows are thinned by the hash before they are
    ranked, so tasks send about three times ``rows`` in all, whatever their number."""
    draw = F.pmod(F.xxhash64(F.lit(1), column), F.lit(1 << 30))
    share = min(1.0, (3.0 * rows + 50) / max(total, 1)) * (1 << 30)
    return df.where(draw < F.lit(int(share))).orderBy(draw, column).limit(rows)


def rank_part(value: Column, salts: int) -> Column:
    """The part that ``number_rows`` deals a row to; numbers rise with the part, then with the order."""
    return hex_prefix(F.md5(F.coalesce(value.cast("string"), F.lit(""))), 8) % salts


def number_rows(df: DataFrame, keys: list[str], order: list[str], out: str,
                salts: int = 16) -> DataFrame:
    """Add ``out``: a gapless number from 0 within each group of ``keys``.

    No task holds a whole group. Each is dealt over ``salts`` parts by a hash of
    the first ``order`` column; rows are numbered inside a part and moved
    by the sizes of the parts before it. Rows that agree in all ``order``
    columns may swap numbers. ``df`` is read twice; materialise it if it is
    costly. ``keys`` must not be null."""
    dealt = df.withColumn("__part", rank_part(F.col(order[0]), salts))
    by = [*keys, "__part"]
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (dealt.groupBy(*by).agg(F.count("*").alias("__n"))
               .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n"))
    inside = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return (dealt.withColumn("__inside", inside).join(offsets, by)
            .withColumn(out, (F.col("__before") + F.col("__inside") - 1).cast("long"))
            .drop("__part", "__inside", "__before"))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(a, b)`` of longs -> ``(node, comp)``, comp being the smallest
    node reachable. Every node that appears in an edge is returned.

    Alternates large-star and small-star rounds, each written under the shared
    work folder, until the edge set is a set of stars. A hub's neighbours
    are only aggregated (``min``) and re-joined, never collected in one task's
    memory; the number of rounds grows with the logarithm of the longest path. An
    error is raised if ``max_rounds`` do not reach the stars."""
    pairs = lambda d: d.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    cur = materialise(pairs(edges).distinct(), "cc-edges")
    for _ in range(max_rounds):
        # large star: every larger neighbour of a node links to the smallest of its neighbourhood
        up = cur.select(F.col("b").alias("a"), F.col("a").alias("b"))
        low = cur.union(up).groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = up.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = pairs(large).repartition("a").distinct()  # dealt by a, as both uses below need it
        # small star: a node and its smaller neighbours link to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        before, cur = cur, materialise(pairs(small).distinct(), "cc-edges")
        discard(before)
        ends = cur.select(F.col("a").alias("node"), F.lit(1).alias("up")).union(cur.select("b", F.lit(0)))
        if ends.groupBy("node").agg(F.sum("up").alias("ups"), F.count("*").alias("n")).where("ups > 1 OR (ups = 1 AND n > 1)").isEmpty():
            break  # every node hangs on one root
    else:
        raise RuntimeError(f"connected_components: no stars after {max_rounds} rounds")
    return (cur.select(F.col("a").alias("node"), F.col("b").alias("comp"))
            .union(cur.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()))

"""Skew-safe left equi-join used to fan lookup results out to listing rows.

Two kinds of skew hit a listing table joined on its key:

* rows whose key is NULL/blank never match, yet a plain shuffle sends all of
  them to one reducer (they hash alike). They go around the join: a filter
  splits them off, NULLs stand for the right side, and a union brings them back;
* a hot key (one value holding a large share of rows) is split over
  ``salts`` reducers: its left rows take a round-robin salt and its single
  right row is replicated ``salts`` times.

Salts come from ``monotonically_increasing_id()`` (partition id and row
position), so rows spread evenly even when the input is clustered by key and
one partition holds a whole hot key. Results never depend on the salt a row
draws (every salt finds exactly one replica of its key's right row), and
Spark re-runs stages that hash such expressions as a whole on retry. The
hot-key list is bounded by construction (at most ``max_hot`` keys), so it is
a literal ``isin``. When the right side turns out small at run time, AQE
replaces the sort-merge join with a broadcast join anyway.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.keys import usable


def hot_keys(df: DataFrame, key: str, min_share: float = 0.01, max_hot: int | None = None,
             fraction: float = 0.01, min_sample_rows: int = 100, seed: int = 17) -> list:
    """Keys holding at least ``min_share`` of all rows. At most
    ``1 / min_share`` keys can qualify, so the list is bounded by
    construction (``max_hot`` defaults to that bound); a key left off the
    list still joins exactly, only unsalted.

    Detection only decides where to salt (results never depend on it), so it
    runs on a ``fraction`` Bernoulli sample: a key with 1% of 10^11 rows still
    shows ~10^7 times in a 1% sample, while the aggregation shuffles 100x
    less. A key must also be seen ``min_sample_rows`` times, so small tables
    (which need no salting) report none. ``fraction=1`` counts exactly.

    One job: per-key counts (map-side partial aggregation) unioned with the
    sample's row count; only the top ``max_hot + 1`` rows come back (the
    total always ranks first), so the driver gets a bounded list.
    """
    max_hot = max_hot or int(1 / min_share)
    src = df.select(F.col(key).alias("_k"))
    if fraction < 1.0:
        src = src.sample(withReplacement=False, fraction=fraction, seed=seed)
    counts = (src.filter(usable(F.col("_k")))
              .groupBy("_k").agg(F.count(F.lit(1)).alias("_n"))
              .select(F.lit(False).alias("_total"), "_k", "_n"))
    total = src.agg(F.count(F.lit(1)).alias("_n")).select(
        F.lit(True).alias("_total"), F.lit(None).cast(counts.schema["_k"].dataType).alias("_k"), "_n")
    top = counts.unionByName(total).orderBy(F.col("_n").desc(), F.col("_total").desc()) \
                .limit(max_hot + 1).collect()
    n_total = next((r["_n"] for r in top if r["_total"]), 0)
    if not n_total:
        return []
    floor = max(1 if fraction >= 1.0 else min_sample_rows, int(n_total * min_share))
    return [r["_k"] for r in top if not r["_total"] and r["_n"] >= floor][:max_hot]


def skew_safe_left_join(left: DataFrame, right: DataFrame, key: str,
                        hot: list | None = None, salts: int = 16,
                        broadcast_right: bool = False) -> DataFrame:
    """``left LEFT JOIN right USING (key)``; ``right`` must be unique on key.

    Output keeps all left columns (in order) followed by right's non-key
    columns; row count equals ``left``'s. ``broadcast_right`` only for a right
    side whose size the caller has checked.
    """
    hot = [h for h in (hot or []) if h is not None]
    row = F.monotonically_increasing_id()
    ok = usable(F.col(key))
    rcols = [c for c in right.columns if c != key]
    # Right-side columns get private names so the join resolves by name even
    # when both sides descend from the same plan (re-running a merge).
    r = right.select(F.col(key).alias("_rk"),
                     *[F.col(f"`{c}`").alias(f"_r{i}") for i, c in enumerate(rcols)])
    l = left.filter(ok)
    cond = F.col(key) == F.col("_rk")
    if hot:
        # Hot keys: (key, salt) is the join key, so one hot key spreads over
        # ``salts`` reducers; its single right row is replicated per salt.
        l = l.withColumn("_ls", F.when(F.col(key).isin(hot), F.pmod(row, F.lit(salts)))
                         .otherwise(F.lit(0)).cast("int"))
        r = r.withColumn("_rs", F.explode(
            F.when(F.col("_rk").isin(hot), F.sequence(F.lit(0), F.lit(salts - 1)))
            .otherwise(F.array(F.lit(0)))))
        cond = cond & (F.col("_ls") == F.col("_rs"))
    if broadcast_right:
        r = F.broadcast(r)
    own = [F.col(f"`{c}`") for c in left.columns]
    j = l.join(r, cond, "left").select(*own, *[F.col(f"_r{i}").alias(c) for i, c in enumerate(rcols)])
    types = {f.name: f.dataType for f in right.schema.fields}
    rest = left.filter(~F.coalesce(ok, F.lit(False))).select(
        *own, *[F.lit(None).cast(types[c]).alias(c) for c in rcols])
    return j.union(rest)

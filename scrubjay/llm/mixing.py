"""Mixing sources to target weights by entropy balancing.

Each document gets a rate r >= 0 near 1: the rates minimise the entropy
distance sum(r ln r - r + 1) under r <= cap and one token constraint for each
source, sum(r * size) = target. The solution is an exponential tilt,
r = min(cap, exp(lam * size / scale)), whose multiplier ``lam`` solves the
convex dual. Newton steps on the dual run over all sources at once as Spark
aggregations; a step that leaves its bracket is replaced by bisection.

Rates depend on a document through (source, size) only, so the iterations run on
the exact histogram of (source, size) cells. Rates are then rounded to whole copies:
cells of a source are taken from the largest size down and each corrects what
earlier roundings left over, and inside a cell the documents are ranked by a hash.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import broadcast_if_small, materialise, number_rows, rank_part, table, without

WORD = r"[^\x20\x09-\x0D]+"
OUTPUTS = ["size", "source_size", "target", "rate", "copies", "taken"]


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, cycle=(1.0, 2.0, 3.0), cap: int = 3) -> DataFrame:
    """``sizes(source, source_size)``, one row per source, plus ``sid``, ``weight`` and
    ``target``. Weights follow the sources' order by code point, null last.
    All sizes are shared by weight, no target above ``cap`` times its size: the water
    level is found from running sums in the order of size over weight.
    One row per source passes through one task."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in cycle]), ((F.col("sid") % len(cycle)) + 1).cast("int"))
    t = (sizes.withColumn("sid", F.row_number().over(by_name).cast("long") - 1).withColumn("weight", w)
         .withColumn("ceil", F.lit(cap) * F.col("source_size")))
    order = Window.orderBy(F.col("ceil") / F.col("weight"), "sid")
    capped = F.coalesce(F.sum("ceil").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    everything = F.sum("source_size").over(Window.partitionBy())
    level = (everything - capped) / left  # if all from this row on stay below their ceiling
    t = t.withColumn("level", F.when(F.col("ceil") / F.col("weight") >= level, level))
    t = t.withColumn("level", F.first("level", ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return t.select("source", "sid", "weight", "source_size",
                    F.least(F.col("ceil").cast("double"), F.col("weight") * F.col("level")).alias("target"))


def _exact(x: Column) -> Column:
    """Sums of decimals do not depend on the order of rows, so reruns agree."""
    return F.sum(x.cast("decimal(30,9)")).cast("double")


def solve_tilt(cells: DataFrame, targets: DataFrame, cap: int = 3, tol: float = 1e-7,
               max_rounds: int = 60) -> DataFrame:
    """Multipliers of the dual: ``cells(sid, size, n)`` and ``targets(sid, target)`` ->
    ``(sid, scale, lam)``. ``lam`` is null for a source whose target is its ceiling or zero
    (rate ``cap`` or 0)."""
    scale = cells.where("size > 0").groupBy("sid").agg(
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("scale"), F.sum(F.col("size") * F.col("n")).alias("have"))
    lam = (targets.select("sid", "target").join(scale, "sid")
           .where((F.col("target") > 0) & (F.col("target") < cap * F.col("have") * (1 - 1e-12)))
           .select("sid", "target", "scale", F.lit(0.0).alias("lam"), F.lit(None).cast("double").alias("lo"),
                   F.lit(None).cast("double").alias("hi"), F.lit(1.0).alias("err")))
    lam = materialise(lam, "mix-dual")
    c, x = F.col("size") / F.col("scale"), F.col("lam") * F.col("size") / F.col("scale")
    rate = F.exp(F.least(x, F.lit(math.log(cap))))
    words = F.col("n") * F.col("size") * rate
    for _ in range(max_rounds):
        moved = (cells.where("size > 0").join(lam, "sid")
                 .groupBy("sid", "target", "scale", "lam", "lo", "hi")
                 .agg(_exact(words).alias("f"), _exact(F.when(x < math.log(cap), words * c).otherwise(0)).alias("slope")))
        short = F.col("f") < F.col("target")
        lo, hi = F.when(short, F.col("lam")).otherwise(F.col("lo")), F.when(short, F.col("hi")).otherwise(F.col("lam"))
        step = F.col("lam") + (F.col("target") - F.col("f")) / F.col("slope")
        half = (F.when(hi.isNull(), F.greatest(F.lit(1.0), 2 * F.col("lam")))
                .when(lo.isNull(), F.least(F.lit(-1.0), 2 * F.col("lam"))).otherwise((lo + hi) / 2))
        inside = (F.col("slope") > 0) & (lo.isNull() | (step > lo)) & (hi.isNull() | (step < hi)) & (F.abs(step - F.col("lam")) <= 4)
        err = F.abs(F.col("f") / F.col("target") - 1)
        done = err <= tol
        lam = materialise(moved.select(
            "sid", "target", "scale", F.when(done, F.col("lam")).when(inside, step).otherwise(half).alias("lam"),
            lo.alias("lo"), hi.alias("hi"), err.alias("err")), "mix-dual")
        if (lam.agg(F.max("err")).first()[0] or 0) <= tol:
            break
    return lam.select("sid", "scale", F.round("lam", 9).alias("lam"))


def _round_cells(cap: int):
    def run(pdf):
        """One source, a row per size: whole copies, largest sizes first."""
        pdf = pdf.sort_values("size", ascending=False)
        owed, out = 0.0, []
        for size, n, rate in zip(pdf["size"].tolist(), pdf["n"].tolist(), pdf["rate"].tolist()):
            owed += size * n * rate
            k = min(cap * n, max(0, round(owed / size))) if size else n
            owed -= k * size
            out.append(k)
        pdf = pdf.assign(k=out)
        # what is still owed goes to the one document, or the swap of two, that fits best
        sized = pdf["size"].to_numpy()
        up = np.flatnonzero((sized > 0) & (pdf["k"].to_numpy() < cap * pdf["n"].to_numpy()))
        down = np.flatnonzero((sized > 0) & (pdf["k"].to_numpy() > 0))
        more, less = np.append(sized[up], 0), np.append(sized[down], 0)
        if len(up) + len(down):
            order = np.argsort(less, kind="stable")
            near = np.searchsorted(less[order], more - owed)
            tries = [(abs(owed - (more - less[order[np.clip(near + d, 0, len(order) - 1)]])), np.clip(near + d, 0, len(order) - 1)) for d in (-1, 0)]
            best = min(((gap.min(), int(gap.argmin()), at) for gap, at in tries), key=lambda t: t[0])
            if best[0] < abs(owed):
                a, b = best[1], order[best[2][best[1]]]
                k = pdf["k"].to_numpy().copy()
                if a < len(up):
                    k[up[a]] += 1
                if b < len(down):
                    k[down[b]] -= 1
                pdf = pdf.assign(k=k)
        return pdf[["sid", "size", "n", "rate", "k"]]
    return run


def mix_sources(docs: DataFrame, source: str = "source", text: str = "text", cycle=(1.0, 2.0, 3.0),
                cap: int = 3, rows_per_part: int = 500_000, carry: list[str] | None = None) -> DataFrame:
    """``docs`` plus ``size`` (words), ``source_size``, ``target``, ``rate``, ``copies`` (0 to ``cap``)
    and ``taken`` (copies times size).

    A null source is a source of its own, last in order. Null or empty text: size 0,
    taken 0, one copy. A source whose size is 0 has target 0. Empty table: no
    rows. Repeated rows are documents of their own. Input columns named like an output are
    replaced. Rounding a source goes through one task with one row per distinct size,
    bounded by the length of the longest document, not by the number of documents."""
    keep = [c for c in without(docs, OUTPUTS) if carry is None or c in carry]
    sized = docs.select(*keep, F.col(source).alias("__source"), word_count(text).alias("size"))
    if carry is not None:
        sized = materialise(sized, "mix-digest")
    raw = materialise(sized.groupBy("__source", "size").agg(F.count("*").alias("n")), "mix-raw-cells")
    sizes = raw.groupBy(F.col("__source").alias("source")).agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = materialise(source_targets(sizes, cycle, cap), "mix-targets")
    cells = materialise(raw.join(targets, raw["__source"].eqNullSafe(targets["source"])).select("sid", "size", "n"),
                        "mix-cells")
    dual = solve_tilt(cells, targets, cap)
    tilt = F.exp(F.least(F.col("lam") * F.col("size") / F.col("scale"), F.lit(math.log(cap))))
    rate = (F.when(F.col("size") == 0, 1.0).when(F.col("lam").isNotNull(), tilt)
            .when(F.col("target") > 0, float(cap)).otherwise(0.0))
    rated = (cells.join(targets.select("sid", "target"), "sid").join(dual, "sid", "left")
             .select("sid", "size", "n", F.round(rate, 9).alias("rate")))
    rounded = materialise(rated.groupBy("sid").applyInPandas(
        _round_cells(cap), "sid long, size long, n long, rate double, k long"), "mix-rounded")
    rows = raw.agg(F.sum("n")).first()[0] or 0
    known = targets.select(F.col("source").alias("__name"), F.col("sid").alias("__sid"), "source_size", "target")
    placed = sized.join(known, F.col("__source").eqNullSafe(F.col("__name"))).drop("__source", "__name")
    order = ["doc_id"] if "doc_id" in keep else [source]
    ranked = number_rows(placed, ["__sid", "size"], order, "__rank", salts=16 + rows // rows_per_part)
    plan = rounded.select(F.col("sid").alias("__sid"), "size", F.col("n").alias("__n"), "rate", F.col("k").alias("__k"))
    copies = F.expr("__k div __n") + F.when(F.col("__rank") < F.col("__k") % F.col("__n"), 1).otherwise(0)
    out = ranked.join(plan, ["__sid", "size"]).withColumn("copies", copies.cast("int"))
    return out.withColumn("taken", F.col("copies") * F.col("size")).select(*keep, *OUTPUTS)


def mixed_copies(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", rows_per_part: int = 500_000, **options) -> DataFrame:
    """``docs`` with all their columns, every row as often as ``mix_sources`` takes it; documents without words once.

    Texts are not shuffled: the mix is made on ids, sources and sizes. What it says about a (source, size) cell is how many
    copies each of its documents gets and up to which one, in the order of the ranks, a document gets one more; that table, a row a
    cell, is joined to the scan of the documents (broadcast if it has been counted to be short). Of repeated rows
    at that place all get one more."""
    digest = materialise(mix_sources(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text")),
                                     rows_per_part=rows_per_part, carry=["doc_id", "source"], **options), "mix-copies")
    salts = 16 + digest.count() // rows_per_part
    place = lambda c: F.struct(rank_part(c, salts), c.alias("id"))
    cells = digest.groupBy(F.col("source").alias("__s"), F.col("size").alias("__z"), "copies").agg(F.max(place(F.col("doc_id"))).alias("upto"))
    cells = (cells.groupBy("__s", "__z").agg(F.min("copies").alias("__least"), F.max_by(F.struct("copies", "upto"), "copies").alias("m"))
             .select("__s", "__z", "__least", F.col("m.copies").alias("__most"), F.col("m.upto").alias("__upto")))
    cells = broadcast_if_small(materialise(cells, "mix-copies-cells"))
    keep = docs.columns
    rows = docs.withColumn("__size", word_count(text)).join(
        cells, F.col(source).eqNullSafe(F.col("__s")) & (F.col("__size") == F.col("__z")))
    copies = F.when(place(F.col(doc_id)) <= F.col("__upto"), F.col("__most")).otherwise(F.col("__least"))
    return (rows.withColumn("__copies", copies).where("__copies > 0")
            .withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*[f"`{c}`" for c in keep]))


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: every row as often as it is taken."""
    return (mixed.where("copies > 0").withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .drop("__i", *OUTPUTS))


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix_sources(docs, carry=["doc_id"]).select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "rate")

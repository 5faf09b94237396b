"""Embedding near-dedup with an inverted multi-index.

Unit vectors are cut in halves with a codebook each; pairs of codewords form a grid
of cells, and every vector is listed in its cell. A query visits cells in
multi-sequence order (smallest sum of the two halves' squared distances first) and
verifies the exact cosine with their members. How many cells are visited is calibrated on bounded
samples of vectors the codebooks were not fitted on: neighbours drawn at exactly the threshold cosine,
the hardest case, displaced in uniform directions and along the data's own covariance, and the real
neighbours of the sample among all vectors. The depth is the one that finds the target share of the worst of these.

Equal vectors are one class. A pair of classes is met once, from the class with the
smaller cell number; inside a block only link counts and a spanning set of links leave the task, so a
family of copies never becomes all its pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import broadcast_value, connected_components, first_by_hash, materialise, table

#: Vectors that codebooks are fitted on, at most; held-out queries for the depth; displacements of each.
SAMPLE, CALIBRATION, DRAWS = 8192, 1024, 4
RECALL = 0.999
BAND = 0.2  # links in this lowest part of the cosines from the threshold to 1 must meet the target by themselves
PAIRS = 1 << 21  # rank pairs held at a time
CELL, MAX_CODEWORDS = 200, 512  # vectors aimed at in a cell; codewords of a half
BLOCK = 2048                    # members, or queries, in one task's block


def _distances(x: np.ndarray, codebook: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ codebook.T + (codebook * codebook).sum(1), 0)


def _codebook(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(k)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = _distances(x, centres).argmin(axis=1)
        for j in range(len(centres)):
            if (near == j).any():
                centres[j] = x[near == j].mean(axis=0)
    return centres


@dataclass
class Index:
    books: tuple[np.ndarray, np.ndarray]
    depth: int

    @property
    def half(self) -> int:
        return self.books[0].shape[1]

    def _halves(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _distances(unit[:, :self.half], self.books[0]), _distances(unit[:, self.half:], self.books[1])

    def cells(self, unit: np.ndarray) -> np.ndarray:
        a, b = self._halves(unit)
        return a.argmin(axis=1) * len(self.books[1]) + b.argmin(axis=1)

    def visits(self, unit: np.ndarray) -> np.ndarray:
        """The first ``depth`` cells in multi-sequence order. The cell of ranks (i, j)
        has (i + 1)(j + 1) - 1 cells before it, so only few rank pairs can be among them."""
        i, j = np.meshgrid(np.arange(len(self.books[0])), np.arange(len(self.books[1])), indexing="ij")
        some = ((i + 1) * (j + 1) <= self.depth)
        i, j = i[some], j[some]
        step = max(1, PAIRS // len(i))
        return np.concatenate([self._first(unit[at:at + step], i, j) for at in range(0, max(len(unit), 1), step)])

    def _first(self, unit: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self._halves(unit)
        order_a, order_b = a.argsort(axis=1, kind="stable"), b.argsort(axis=1, kind="stable")
        sums = np.take_along_axis(a, order_a, 1)[:, i] + np.take_along_axis(b, order_b, 1)[:, j]
        first = sums.argsort(axis=1, kind="stable")[:, :self.depth]
        return (np.take_along_axis(order_a[:, i], first, 1) * b.shape[1] + np.take_along_axis(order_b[:, j], first, 1))

    def ranks(self, unit: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """How many cells each vector visits before the given one."""
        out = np.zeros(len(unit), np.int64)
        for at in range(0, len(unit), 4096):
            a, b = self._halves(unit[at:at + 4096])
            for n, (da, db, cell) in enumerate(zip(a, b, cells[at:at + 4096]), at):
                limit = da[cell // len(db)] + db[cell % len(db)]
                out[n] = np.searchsorted(np.sort(db), limit - da, side="left").sum()
        return out


def _depth(ranks: np.ndarray, counts: np.ndarray, recall: float) -> int:
    """The least depth at which ``recall`` of the neighbours, ``counts`` at each rank, are visited."""
    order = np.argsort(ranks)
    reached = np.cumsum(counts[order])
    return int(ranks[order][np.searchsorted(reached, recall * reached[-1] - 1e-9)]) + 1


def _held_out(sample: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Queries and the vectors to fit on; a sample too small to be parted is both."""
    n = min(CALIBRATION, len(sample) // 8)
    return (sample[:n], sample[n:]) if n else (sample, sample)


def build_index(sample: np.ndarray, vectors: int, cosine: float, recall: float = RECALL) -> Index:
    """``sample``: unit vectors; ``vectors``: how many the index will hold."""
    k = int(np.clip(round(np.sqrt(vectors / CELL)), 1, MAX_CODEWORDS))
    half = sample.shape[1] // 2
    held, rest = _held_out(sample)
    index = Index((_codebook(rest[:, :half], k), _codebook(rest[:, half:], k)), 1)
    rng = np.random.default_rng(7)
    q = np.repeat(held, DRAWS, axis=0)
    values, axes = np.linalg.eigh(np.atleast_2d(np.cov(sample, rowvar=False, bias=True)))
    for scale in (np.eye(sample.shape[1]), np.sqrt(np.maximum(values, 0))[:, None] * axes.T):
        side = rng.normal(size=q.shape) @ scale
        side -= (side * q).sum(axis=1, keepdims=True) * q
        side /= np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-12)
        ranks = index.ranks(q, index.cells(cosine * q + np.sqrt(1 - cosine ** 2) * side))
        index.depth = max(index.depth, _depth(ranks, np.ones(len(ranks)), recall))
    return index


def _real_ranks(shared, width: int, cosine: float):
    """Real neighbours of the queries in all vectors, as counts by rank of their cell: rows (rank, low, n)."""
    def run(batches):
        index, queries = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                unit = _unit(batch.slice(at, 4096).column("v"), width)
                found = queries @ unit.T
                q, m = np.nonzero((found >= cosine) & (found < 1 - 1e-12))
                if not len(q):
                    continue
                low = found[q, m] < cosine + BAND * (1 - cosine)
                # links of a query into the same cell have one rank
                at_cell, n = np.unique(np.stack([q, index.cells(unit)[m], low], axis=1), axis=0, return_counts=True)
                ranks = index.ranks(queries[at_cell[:, 0]], at_cell[:, 1])
                yield pa.RecordBatch.from_arrays([pa.array(ranks), pa.array(at_cell[:, 2].astype(bool)), pa.array(n, pa.int64())], names=["rank", "low", "n"])
    return run


def calibrate(classes: DataFrame, index: Index, queries: np.ndarray, width: int, cosine: float, recall: float) -> Index:
    """Raises the depth until real neighbours of ``queries`` meet the target, and by themselves those just above ``cosine``."""
    shared = broadcast_value(classes.sparkSession, (index, queries))  # bounded: codewords and held-out vectors
    found = (classes.select("v").mapInArrow(_real_ranks(shared, width, cosine), "rank long, low boolean, n long")
             .groupBy("rank", "low").agg(F.sum("n").alias("n")).toArrow())  # at most two rows for each cell of the grid
    ranks, low, n = (found[c].to_numpy() for c in ("rank", "low", "n"))
    for some in (np.ones(len(n), bool), low.astype(bool)):
        if some.any():
            index.depth = max(index.depth, _depth(ranks[some], n[some], recall))
    return index


def _scaled(rows: list[bytes], width: int) -> np.ndarray:
    """Vectors, each times the power of two that brings its largest component near 1: no square overflows or vanishes, no digit
    is lost."""
    x = np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), width)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _unit(rows: pa.Array, width: int) -> np.ndarray:
    x = _scaled(rows.to_pylist(), width)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _place(shared, width: int, visits: bool):
    def run(batches):
        index = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                unit = _unit(part.column("v"), width)
                own = index.cells(unit)
                if not visits:
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(own, pa.int64())], names=[*part.schema.names, "cell"])
                    continue
                cells = index.visits(unit)
                # the own cell, and of the visited ones those with a larger number
                q, c = np.nonzero(cells > own[:, None])
                q, cell = np.concatenate([np.arange(len(own)), q]), np.concatenate([own, cells[q, c]])
                yield pa.RecordBatch.from_arrays([*part.take(pa.array(q)).columns, pa.array(cell, pa.int64()), pa.array(cell == own[q])],
                                                 names=[*part.schema.names, "cell", "home"])
    return run


def _spanning(link: np.ndarray, q: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from every node of a block to the smallest node it reaches inside the block.
    ``link`` is a queries x members matrix; equal node numbers are one node."""
    nodes, at = np.unique(np.concatenate([q, m]), return_inverse=True)
    iq, im = at[:len(q)], at[len(q):]
    rows, cols = np.nonzero(link)
    a, b = iq[rows], im[cols]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _verify(cosine: float, width: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        query = group["query"].to_numpy().astype(bool)
        node, copies, home = group["node"].to_numpy(), group["copies"].to_numpy(), group["home"].to_numpy().astype(bool)
        x = _scaled(group["v"].to_pylist(), width)
        norm = np.linalg.norm(x, axis=1)
        q, m = np.flatnonzero(query), np.flatnonzero(~query)
        link = (x[q] @ x[m].T) / (norm[q][:, None] * norm[m]) >= cosine
        link &= node[q][:, None] != node[m]
        counts = np.concatenate([link @ copies[m], (link & ~home[q][:, None]).T @ copies[q]])
        ids = np.concatenate([node[q], node[m]])
        a, b = _spanning(link, node[q], node[m])
        some = counts > 0
        return pa.table({
            "a": pa.array(np.concatenate([ids[some], a]), pa.int64()),
            "b": pa.array([None] * int(some.sum()) + b.tolist(), pa.int64()),
            "n": pa.array(np.concatenate([counts[some], np.zeros(len(a), np.int64)]), pa.int64())})
    return run


def _link(classes: DataFrame, width: int, cosine: float, recall: float) -> DataFrame | None:
    """``classes(node, v, copies)`` of one width -> rows (a, b, n): a link, or with null b a count of links."""
    spark = classes.sparkSession
    total = classes.count()
    rows = first_by_hash(classes, "node", SAMPLE + CALIBRATION, total).select("v").toArrow()
    if not total:
        return None
    sample = _unit(rows["v"], width)
    index = build_index(sample, total, cosine, recall)
    if len(index.books[0]) * len(index.books[1]) > 1:
        index = calibrate(classes, index, _held_out(sample)[0], width, cosine, recall)
    shared = broadcast_value(spark, index)  # bounded: codewords of two halves
    fields = "node long, v binary, copies long, cell long"
    members = materialise(classes.mapInArrow(_place(shared, width, False), fields), "imi-members")
    queries = classes.mapInArrow(_place(shared, width, True), fields + ", home boolean")
    # a full cell, or one with many queries, is dealt out in blocks against blocks
    sizes = members.groupBy("cell").agg(F.count("*").alias("size"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("size") / BLOCK)).cast("int")
    sizes = materialise(sizes.select("cell", parts.alias("mparts")), "imi-cells")
    queries = materialise(queries.join(sizes, "cell"), "imi-queries")
    asked = queries.groupBy("cell").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / BLOCK)).cast("int").alias("qparts"))
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = (members.join(sizes.join(asked, "cell"), "cell")
            .select("cell", own("mparts").alias("mb"), each("qparts").alias("qb"), F.lit(False).alias("query"), "node", "v", "copies", F.lit(False).alias("home")))
    right = (queries.join(asked, "cell")
             .select("cell", each("mparts").alias("mb"), own("qparts").alias("qb"), F.lit(True).alias("query"), "node", "v", "copies", "home"))
    return (left.unionByName(right).groupBy("cell", "mb", "qb")
            .applyInArrow(_verify(cosine, width), "a long, b long, n long"))


def _to_binary(embedding: str):
    """Arrays of numbers as packed doubles."""
    def run(batches):
        for batch in batches:
            values = [np.asarray(v, np.float64).tobytes() for v in batch.column("e").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(values, pa.binary()), batch.column("copies"), batch.column("width")],
                                             names=["node", "v", "copies", "width"])
    return run


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = 0.95,
                 recall: float = RECALL) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id``, ``n_links`` (other rows with a cosine of at least ``cosine``),
    ``component_id`` (smallest vec_id reachable by links, itself included) and ``kept``.

    Null, empty and zero vectors, and those with null or non-finite components, have no links.
    Vectors of different lengths never link. A null vec_id is never a component_id unless
    its component has no other, and is not kept. Repeated rows link with each other. Empty table: no rows."""
    e = F.col(embedding)
    finite = F.forall(e, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    good = F.coalesce(finite & F.exists(e, lambda x: F.coalesce(x != 0, F.lit(False))), F.lit(False))
    base = materialise(vectors.select(F.col(vec_id).cast("long").alias("id"), F.when(good, e).alias("e"))
                       .withColumn("node", F.when(F.col("e").isNotNull(), F.xxhash64(F.size("e"), "e"))), "imi-base")
    classes = (base.where("node IS NOT NULL").groupBy("node").agg(F.first("e").alias("e"), F.count("*").alias("copies"))
               .withColumn("width", F.size("e")))
    classes = materialise(classes.mapInArrow(_to_binary(embedding), "node long, v binary, copies long, width int"), "imi-classes")
    found = None
    for width in sorted(r[0] for r in classes.select("width").distinct().collect()):
        links = _link(classes.where(F.col("width") == width).select("node", "v", "copies"), width, cosine, recall)
        found = links if found is None else found.union(links)
    rows = base.select("id", "node")
    if found is None:
        return rows.select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"),
                           F.col("id").isNotNull().alias("kept"))
    found = materialise(found, "imi-links")
    counts = found.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("others"))
    comp = connected_components(found.where("b IS NOT NULL").select("a", "b"))
    nodes = (classes.select("node", "copies").join(counts.withColumnRenamed("a", "node"), "node", "left").join(comp, "node", "left")
             .select("node", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("comp", "node").alias("comp"))
             .where("n_links > 0"))
    nodes = materialise(nodes, "imi-nodes")
    rows = materialise(rows.join(nodes, "node", "left").drop("node"), "imi-rows")
    heads = rows.where("comp IS NOT NULL").groupBy("comp").agg(F.min("id").alias("head"))
    out = rows.join(heads, "comp", "left")
    component = F.coalesce("head", "id")
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def op1_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))

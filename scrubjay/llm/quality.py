"""Quality classifier: nearest-neighbour voting in a latent semantic space.

A document's terms are n-grams of its shape (letter case, digits, white space
and punctuation, runs collapsed) and levels of repetition. Term vectors of a bounded
labelled sample are weighted by rarity and reduced by a truncated singular value decomposition;
the labelled latent vectors are broadcast. Every document is projected, its cosines with all labelled
vectors are computed exactly in blocks, and its nearest neighbours vote with their similarity.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import broadcast_value, materialise, table, without
from .features import bounded_sample, crc_mod, hellinger, ngrams, repetition
from .words import buffers, slices

#: Labelled documents for each label that are learned from, at most.
SAMPLE = 2000
DIMS, LEVELS, RANK, NEIGHBOURS = 1024, 8, 48, 15
ROWS, BYTES = 512, 1 << 18  # documents in a block, and about the text in it: a worker holds about 100 bytes for one of text


def terms(text: pa.Array) -> np.ndarray:
    data, off = buffers(text)
    shape = hellinger(ngrams(data, off, "shape", (3, 4), DIMS))
    levels = np.zeros((len(off) - 1, 2 * LEVELS), np.float32)
    for j, rate in enumerate(repetition(data, off).T):
        at = np.minimum((np.sqrt(rate) * LEVELS).astype(int), LEVELS - 1)
        levels[np.arange(len(at)), j * LEVELS + at] = 0.5
    levels[np.diff(off) == 0] = 0
    return np.hstack([shape, levels])


@dataclass
class Neighbours:
    weight: np.ndarray    # of terms
    basis: np.ndarray     # terms x rank
    vectors: np.ndarray   # labelled documents, unit length
    votes: np.ndarray     # their labels
    shares: np.ndarray    # what one labelled document stands for
    prior: float

    def project(self, x: np.ndarray) -> np.ndarray:
        y = (x * self.weight) @ self.basis
        return y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-12)

    def scores(self, text: pa.Array) -> np.ndarray:
        x = terms(text)
        out = np.full(len(x), self.prior)
        if not len(self.vectors):
            return out
        cosine = self.project(x) @ self.vectors.T
        k = min(NEIGHBOURS, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        w = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** 2 * self.shares[near]
        total = w.sum(axis=1)
        known = (total > 0) & x.any(axis=1)
        out[known] = (w * self.votes[near]).sum(axis=1)[known] / total[known]
        return np.clip(out, 0, 1)


def _gram(x: np.ndarray, block: int = 130) -> np.ndarray:
    """``x.T @ x`` in double precision, by blocks of columns, so that ``x`` is never held whole in doubles."""
    out = np.empty((x.shape[1], x.shape[1]))
    for i in range(0, len(out), block):
        left = x[:, i:i + block].T.astype(np.float64)
        for j in range(0, len(out), block):
            out[i:i + block, j:j + block] = left @ x[:, j:j + block]
    return out


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Neighbours:
    """``documents(doc_id, text)`` and ``labels(doc_id, label)``, both as allowed for learning.
    Conflicting labels of an id are averaged; null labels and ids are left out."""
    votes = (labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id")
             .agg(F.avg("label").alias("vote")).withColumn("side", (F.col("vote") >= 0.5).cast("int")))
    votes = materialise(votes, "quality-votes")
    counts = {r["side"]: r["count"] for r in votes.groupBy("side").count().collect()}
    chosen = bounded_sample(votes, "side", sample, ["doc_id"])
    # at most 2 * sample ids: a proven bound; one document of a repeated id
    rows = documents.join(F.broadcast(chosen), "doc_id")

    def vectors(batches):
        for batch in batches:
            for a, b in slices(batch.column("text"), BYTES, ROWS):
                x = terms(batch.column("text").slice(a, b - a))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(n).slice(a, b - a) for n in ("doc_id", "vote", "side")]
                    + [pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), x.astype(np.float32).ravel())],
                    names=["doc_id", "vote", "side", "x"])

    got = (rows.select("doc_id", "vote", "side", "text").mapInArrow(vectors, "doc_id long, vote double, side int, x array<float>")
           .dropDuplicates(["doc_id"]).toArrow().sort_by("doc_id"))
    n, width = got.num_rows, DIMS + 2 * LEVELS
    prior = counts.get(1, 0) / max(sum(counts.values()), 1) if counts else 0.5
    if not n:
        return Neighbours(np.ones(width, np.float32), np.zeros((width, 1), np.float32), np.zeros((0, 1)), np.zeros(0), np.zeros(0), prior)
    x = got["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, width)
    side, vote = got["side"].to_numpy(), got["vote"].to_numpy()
    weight = (np.log((n + 1) / ((x > 0).sum(axis=0) + 1)) + 1).astype(np.float32)
    basis = np.linalg.eigh(_gram(x * weight))[1][:, ::-1][:, :RANK].astype(np.float32)
    taken = np.bincount(side, minlength=2)
    shares = np.array([counts.get(s, 0) / max(taken[s], 1) for s in (0, 1)])[side]
    model = Neighbours(weight, basis, np.zeros((0, 1)), vote, shares, prior)
    model.vectors = model.project(x)
    del got, x
    pa.default_memory_pool().release_unused()  # the driver's, which later stages share
    return model


def _scorer(shared, keep: list[str], text: str, output: str):
    def run(batches):
        m = shared.value
        for batch in batches:
            for a, b in slices(batch.column(text), BYTES, ROWS):
                part = batch.slice(a, b - a)
                arrays = [part.column(i) for i in range(len(keep))] + [pa.array(m.scores(part.column(text)), pa.float64())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, output])
    return run


def score_quality(docs: DataFrame, model: Neighbours, text: str = "text", output: str = "score") -> DataFrame:
    """``docs`` plus ``score``, 0 to 1, higher for label 1. Null and empty texts get the share of
    label 1 among the labelled; with no labels at all every score is 0.5. Repeated rows are
    scored alike. An input column named ``score`` is replaced."""
    keep = without(docs, [output])
    shared = broadcast_value(docs.sparkSession, model)  # bounded by the sample
    fields = [*docs.select(*keep).schema.fields, StructField(output, DoubleType())]
    if text in keep:  # texts go to the workers once
        return docs.select(*keep).mapInArrow(_scorer(shared, keep, text, output), StructType(fields))
    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(_scorer(shared, keep, "__text", output), StructType(fields))


def learnable(spark, sf_dir: str, m: int = 5, left_out: int = 0) -> DataFrame:
    """Labels that may be learned: crc32 of the id as text, modulo ``m``, is not ``left_out``."""
    return (table(spark, sf_dir, "labels").where(crc_mod("doc_id", m) != left_out)
            .select("doc_id", F.col("quality").cast("double").alias("label")))


def op10_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, learnable(spark, sf_dir))
    out = score_quality(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
                      F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))

"""Language identification by error-correcting output codes.

Each language has a codeword; one binary classifier per code bit (logistic regression
over hashed letter n-grams) is fitted on a bounded sample. A document's language is the codeword
of least total loss, where each bit's logistic loss is weighted by the bit's reliability. A
small lead over the second codeword flags an ambiguous document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from .common import broadcast_value, table, without
from .features import bounded_sample, crc_mod, hellinger, ngrams
from .words import buffers, slices

#: Documents learned from in all, at most; an equal share for each language.
SAMPLE = 2400
DIMS, ROUNDS, RIDGE = 2048, 150, 1e-4
ROWS = 512
AMBIGUOUS = 0.2  # lead in probability below which a document is flagged
UNDETERMINED = "und"


def terms(text: pa.Array) -> np.ndarray:
    data, off = buffers(text)
    return hellinger(ngrams(data, off, "letters", (1, 2, 3), DIMS))


def codewords(n: int) -> np.ndarray:
    """A row of -1 and 1 per language. Up to 7 languages: all ways to split them in
    two. More: the random code with the largest least distance between rows."""
    if n < 2:
        return np.ones((n, 0))
    if n <= 7:
        bits = np.arange(1, 1 << (n - 1))
        return np.where((bits >> np.arange(n)[:, None]) & 1, 1.0, -1.0)
    rng, best, width = np.random.default_rng(n), None, int(np.ceil(10 * np.log2(n)))
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (n, width))
        same = code @ code.T
        np.fill_diagonal(same, -width)
        mixed = (np.abs(code.sum(axis=0)) < n).all()
        if mixed and (best is None or same.max() < best[0]):
            best = (same.max(), code)
    return best[1]


@dataclass
class Codes:
    names: list[str]
    code: np.ndarray     # languages x bits
    weight: np.ndarray   # terms + 1 x bits
    trust: np.ndarray    # of bits

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        margin = x @ self.weight[:-1] + self.weight[-1]
        loss = np.logaddexp(0, -margin[:, None, :] * self.code[None]) @ self.trust
        e = np.exp(loss.min(axis=1, keepdims=True) - loss)
        return e / e.sum(axis=1, keepdims=True)


def _bits(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regressions for all bits at once, by accelerated gradient steps."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w = v = np.zeros((x.shape[1], y.shape[1]), np.float32)
    rate = 1.0 / (0.25 * 2 + RIDGE)  # rows have unit length, and the constant adds one
    for i in range(ROUNDS):
        slope = x.T @ (-y / (1 + np.exp(y * (x @ v)))) / len(x) + RIDGE * v
        new = v - rate * slope
        v, w = new + (i / (i + 3)) * (new - w), new
    return w


def fit(documents: DataFrame, sample: int = SAMPLE) -> Codes:
    """``documents(doc_id, text, lang)`` as allowed for learning; null languages and texts
    without letters are left out."""
    rows = documents.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    names = sorted(r[0] for r in rows.select("lang").distinct().collect())  # a few hundred languages at most
    if not names:
        return Codes([], np.ones((0, 0)), np.zeros((DIMS + 1, 0)), np.zeros(0))
    small = rows.select("doc_id", "lang", F.xxhash64("text").alias("h"))
    chosen = bounded_sample(small, "lang", max(8, sample // len(names)), ["h", "doc_id"]).select("h", "lang").distinct()

    def vectors(batches):
        for batch in batches:
            for a, b in slices(batch.column("text"), rows=ROWS):
                x = terms(batch.column("text").slice(a, b - a))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("h").slice(a, b - a), batch.column("lang").slice(a, b - a),
                     pa.ListArray.from_arrays(np.arange(0, x.size + 1, DIMS, dtype=np.int32), x.astype(np.float32).ravel())],
                    names=["h", "lang", "x"])

    picked = rows.withColumn("h", F.xxhash64("text")).join(F.broadcast(chosen), ["h", "lang"])  # at most ``sample`` rows
    got = (picked.select("h", "lang", "text").mapInArrow(vectors, "h long, lang string, x array<float>")
           .dropDuplicates(["h", "lang"]).toArrow().sort_by([("lang", "ascending"), ("h", "ascending")]))
    x = got["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(got.num_rows, DIMS)
    of = np.searchsorted(np.array(names), np.array(got["lang"].to_pylist(), dtype=str))
    code = codewords(len(names))
    y = code[of]
    # a bit's reliability is its accuracy on a part that a first fit has not seen
    held = np.arange(len(x)) % 5 == 0
    first = _bits(x[~held], y[~held]) if (~held).any() else np.zeros((DIMS + 1, code.shape[1]))
    right = ((x[held] @ first[:-1] + first[-1]) * y[held] > 0).sum(axis=0)
    accuracy = (right + 1) / (held.sum() + 2)
    trust = np.maximum(np.log(accuracy / (1 - accuracy)), 0.05)
    return Codes(names, code, _bits(x, y), trust / max(trust.sum(), 1e-9) * len(trust) if len(trust) else trust)


OUTPUTS = ["lang_pred", "score", "ambiguous", "second"]


def identify(docs: DataFrame, model: Codes, text: str = "text") -> DataFrame:
    """``docs`` plus ``lang_pred``, ``score`` (0 to 1), ``ambiguous`` and ``second`` (the runner-up).

    Null, empty and letterless texts: ``und``, score 0, ambiguous. With one known language
    every text with letters is of it; with none all are ``und``. Ties go to the language
    first by code point. Repeated rows get the same answer. Input columns named like an output are replaced."""
    keep = without(docs, OUTPUTS)
    shared = broadcast_value(docs.sparkSession, model)  # bounded: terms x bits

    def run(batches):
        m = shared.value
        for batch in batches:
            for a, b in slices(batch.column("__text"), rows=ROWS):
                part = batch.slice(a, b - a)
                some = part.column("__some").to_numpy(zero_copy_only=False).astype(bool)
                n = part.num_rows
                pred, second = np.full(n, UNDETERMINED, object), np.full(n, None, object)
                score, lead = np.zeros(n), np.zeros(n)
                if len(m.names) and n:
                    p = m.probabilities(terms(part.column("__text")))
                    order = np.argsort(-p, axis=1, kind="stable")
                    top = np.take_along_axis(p, order[:, :2], 1)
                    names = np.array(m.names, object)
                    pred = np.where(some, names[order[:, 0]], pred)
                    score = np.where(some, top[:, 0], 0)
                    lead = np.where(some, top[:, 0] - (top[:, 1] if top.shape[1] > 1 else 0), 0)
                    if top.shape[1] > 1:
                        second = np.where(some, names[order[:, 1]], None)
                arrays = [part.column(i) for i in range(len(keep))] + [
                    pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(lead < AMBIGUOUS, pa.bool_()), pa.array(second, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *OUTPUTS])

    fields = [*docs.select(*keep).schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType()),
              StructField("ambiguous", BooleanType()), StructField("second", StringType())]
    some = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return docs.select(*keep, F.col(text).alias("__text"), some.alias("__some")).mapInArrow(run, StructType(fields))


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(crc_mod("doc_id", 4) != 2).select("doc_id", "text", "lang"))
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
                      "lang_pred", "score", "ambiguous", "second")

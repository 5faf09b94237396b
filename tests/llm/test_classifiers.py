import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from scrubjay.llm import features, langid, quality
from scrubjay.llm.queries import QUERIES
from scrubjay.llm.words import buffers

SF = "/root/testdata/sf0.01"


def test_quality_on_held_out_labels(spark):
    out = QUERIES["op10_quality"](spark, SF).toPandas()
    labels = pd.read_parquet(f"{SF}/labels.parquet")
    assert len(out) == 1000 and out.score.between(0, 1).all()
    assert (out.held_out == out.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    assert (out.predicted == (out.score >= 0.3)).all()
    m = out[out.held_out].merge(labels, on="doc_id")
    good, bad = m[m.quality == 1].score.to_numpy(), m[m.quality == 0].score.to_numpy()
    assert (good[:, None] > bad).mean() > 0.97
    assert (m[m.quality == 1].predicted == 1).mean() > 0.98


def test_scores_are_exact_votes():
    """Blocked cosine products against a plain loop over the labelled vectors."""
    rng = np.random.default_rng(2)
    texts = pa.array(["a b. C!", "xx yy " * 30, "MUCH NOISE!! " * 4, "one | two | three", "", "é"])
    width = quality.DIMS + 2 * quality.LEVELS
    model = quality.Neighbours(np.ones(width, np.float32), rng.normal(size=(width, 8)).astype(np.float32), np.zeros((0, 1)),
                               rng.integers(0, 2, 40).astype(float), rng.uniform(0.5, 2, 40), 0.7)
    v = rng.normal(size=(40, 8)).astype(np.float32)
    model.vectors = v / np.linalg.norm(v, axis=1, keepdims=True)
    y = model.project(quality.terms(texts))
    for i, s in enumerate(model.scores(texts)):
        near = sorted(range(40), key=lambda j: -float(y[i] @ model.vectors[j]))[:quality.NEIGHBOURS]
        w = [max(float(y[i] @ model.vectors[j]), 0) ** 2 * model.shares[j] for j in near]
        want = sum(a * model.votes[j] for a, j in zip(w, near)) / sum(w) if sum(w) and texts[i].as_py() else 0.7
        assert s == pytest.approx(want, abs=1e-5)


def test_ngrams_against_a_plain_loop():
    texts = ["ab  C9!", "", "é é", "x", "aab"]
    data, off = buffers(pa.array(texts))
    got = features.ngrams(data, off, "shape", (2, 3), 64)
    for i, t in enumerate(texts):
        s = []
        for b in t.encode():
            c = int(features.SHAPE[b])
            if not (s and s[-1] == c and features._shape_runs[c]):
                s.append(c)
        framed = [0, *s, 0]
        want = sum(max(len(framed) - n + 1, 0) for n in (2, 3)) if s else 0
        assert got[i].sum() == want
    assert (got[3] == features.ngrams(*buffers(pa.array(["y"])), "shape", (2, 3), 64)[0]).all()


def test_repetition():
    data, off = buffers(pa.array(["a a a a", "a b c d", "a b a b a b", "", "one"]))
    r = features.repetition(data, off)
    assert r[0].tolist() == [1.0, pytest.approx(2 / 3)] and r[1].tolist() == [0, 0] and r[2][1] == pytest.approx(3 / 5) and not r[3:].any()


def test_language_on_held_out_documents(spark):
    out = QUERIES["op9_language_id"](spark, SF).toPandas()
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    assert len(out) == len(docs) and out.score.between(0, 1).all()
    assert (out.held_out == out.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    m = out[out.held_out].merge(docs, on="doc_id")
    assert (m.lang == m.lang_pred).mean() > 0.98


@pytest.mark.parametrize("n,bits", [(1, 0), (2, 1), (4, 7), (7, 63), (30, 50)])
def test_codewords(n, bits):
    code = langid.codewords(n)
    assert code.shape == (n, bits) and len({tuple(r) for r in code}) == n
    if n == 4:
        assert min((code[i] != code[j]).sum() for i in range(4) for j in range(i)) == 4
    if n == 30:  # every bit splits the languages, and several wrong bits are corrected
        assert (abs(code.sum(axis=0)) < n).all() and min((code[i] != code[j]).sum() for i in range(n) for j in range(i)) >= 11


def test_decoding_corrects_a_wrong_bit():
    code = langid.codewords(4)
    for lang in range(4):
        for wrong in range(7):
            margins = code[lang] * 3
            margins[wrong] *= -1
            weight = np.vstack([np.zeros((langid.DIMS, 7)), margins])
            m = langid.Codes(list("abcd"), code, weight, np.ones(7))
            assert m.probabilities(np.zeros((1, langid.DIMS)))[0].argmax() == lang


def test_odd_rows(spark, odd_docs):
    model = langid.fit(odd_docs.select("doc_id", "text", "lang"))
    assert model.names == ["de", "en", "fr"]
    out = langid.identify(odd_docs, model)
    rows = out.collect()
    assert len(rows) == odd_docs.count() and out.columns.count("score") == 1
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) for r in rows)
    empty = langid.fit(odd_docs.select("doc_id", "text", "lang").limit(0))
    assert {r.lang_pred for r in langid.identify(odd_docs, empty).collect()} == {"und"}
    one = langid.fit(odd_docs.where("lang = 'en'").select("doc_id", "text", "lang"))
    assert {r.lang_pred for r in langid.identify(odd_docs, one).collect()} == {"und", "en"}
    assert langid.identify(odd_docs.limit(0), model).count() == 0

    labels = spark.createDataFrame([(1, 1.0), (1, 0.0), (3, 1.0), (4, 0.0), (None, 1.0), (5, None), (99, 1.0)], "doc_id long, label double")
    scored = quality.score_quality(odd_docs, quality.fit(odd_docs.select("doc_id", "text"), labels))
    rows = scored.collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not r.text}) == 1
    none = quality.fit(odd_docs.select("doc_id", "text"), labels.limit(0))
    assert {r.score for r in quality.score_quality(odd_docs, none).collect()} == {0.5}
    assert quality.score_quality(odd_docs.limit(0), none).count() == 0


def test_sample_is_bounded_and_stable(spark):
    df = spark.createDataFrame([(i, "a" if i % 10 else "b") for i in range(5000)], "i long, g string")
    one, two = (sorted(map(tuple, features.bounded_sample(df.repartition(n), "g", 40, ["i"]).collect())) for n in (2, 5))
    assert one == two and [sum(r[0] == g or r[1] == g for r in one) for g in "ab"] == [40, 40]




def test_scoring_sends_texts_once_and_works_in_small_blocks(spark):
    """A worker's memory follows the text in a block, not the rows of a batch."""
    import tracemalloc
    from types import SimpleNamespace

    docs = spark.createDataFrame([(1, "a b. C!", "en")], "doc_id long, text string, lang string")
    model = quality.fit(docs, docs.selectExpr("doc_id", "1D AS label"))
    plan = quality.score_quality(docs, model)._jdf.queryExecution().optimizedPlan().toString()
    assert "__text" not in plan
    renamed = quality.score_quality(docs, model, output="text")  # the score takes the text's place
    assert renamed.columns == ["doc_id", "lang", "text"] and renamed.first()["text"] == quality.score_quality(docs, model).first()["score"]

    texts = pa.array([f"Some words, {i} | " * 500 for i in range(512)])
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    run = quality._scorer(SimpleNamespace(value=model), ["text"], "text", "score")
    tracemalloc.start()
    got = pa.Table.from_batches(run([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(got["score"].to_numpy(), model.scores(texts)) and got["text"].to_pylist() == texts.to_pylist()
    assert peak < 100 * 2**20, f"{peak / 2**20:.0f} MB"


def test_gram_holds_no_copy_in_doubles():
    """The driver multiplies the sample's terms by blocks: the same numbers, in less memory than the terms take."""
    import tracemalloc

    rng = np.random.default_rng(3)
    for rows, columns in ((900, 260), (70, 133), (1, 5)):
        x = rng.random((rows, columns)).astype(np.float32)
        assert np.allclose(quality._gram(x), x.astype(np.float64).T @ x.astype(np.float64), rtol=1e-12, atol=0)
    x = rng.random((4000, 1040)).astype(np.float32)
    tracemalloc.start()
    got = quality._gram(x)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < got.nbytes + x.nbytes

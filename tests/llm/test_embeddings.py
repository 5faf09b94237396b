import numpy as np
import pytest
from llm_tables import SF

from scrubjay.llm import embeddings
from scrubjay.llm.queries import QUERIES


def brute(ids, vectors, cosine=0.95):
    """Links and components by all pairs."""
    good = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    n = len(ids)
    link = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            if i != j and good[i] and good[j] and len(vectors[i]) == len(vectors[j]):
                a, b = np.array(vectors[i], float), np.array(vectors[j], float)
                link[i, j] = a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= cosine
    label = np.arange(n)
    while True:
        new = np.array([min([label[i], *label[link[i]]]) for i in range(n)])
        if (new == label).all():
            break
        label = new
    head = {k: min((ids[i] for i in range(n) if label[i] == k and ids[i] is not None), default=None) for k in set(label)}
    return [(ids[i], int(link[i].sum()), head[label[i]]) for i in range(n)]


def got(df):
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in df.collect()), key=str)


def test_given_vectors(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    assert got(QUERIES["op1_embedding_near_dedup"](spark, SF)) == sorted(brute(rows.vec_id.tolist(), rows.embedding.tolist()), key=str)


@pytest.mark.parametrize("seed,cell,block", [(1, 200, 2048), (2, 20, 2048), (3, 30, 16)])
def test_families(spark, monkeypatch, seed, cell, block):
    """Families around the threshold, exact copies, and blocks smaller than a cell."""
    monkeypatch.setattr(embeddings, "CELL", cell)
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(seed)
    parts = []
    for spread in (0.05, 0.1, 0.2, 0.25, 0.3):
        centre = rng.normal(size=16)
        noise = rng.normal(size=(40, 16))
        parts.append(centre / np.linalg.norm(centre) + spread * noise / np.linalg.norm(noise, axis=1, keepdims=True))
    x = np.vstack([*parts, np.repeat(parts[0][:1], 30, axis=0), 3 * parts[1][:5], rng.normal(size=(200, 16))]).astype(np.float32)
    rows = [(int(i), [float(v) for v in r]) for i, r in zip(rng.permutation(len(x)), x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert got(embeddings.near_vectors(df)) == sorted(brute([r[0] for r in rows], [r[1] for r in rows]), key=str)


@pytest.mark.parametrize("scale", [1e-310, 1e-200, 1e-170, 1e170, 1e200, 1e305])
def test_any_finite_magnitude(spark, scale):
    """Scaled copies of two vectors link as the vectors do; brute force takes unscaled ones."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(450, 8))
    rows = [(i, r.tolist(), r.tolist()) for i, r in enumerate(x)]
    rows += [(1000 + i, (x[i] * scale / np.abs(x[i]).max()).tolist(), x[i].tolist()) for i in (0, 7)]
    rows += [(2000, (x[0] * 3).tolist(), x[0].tolist())]
    df = spark.createDataFrame([(i, v) for i, v, _ in rows], "vec_id long, embedding array<double>")
    cosine = 0.95 if scale > 1e-300 else 0.9499  # below 1e-308 digits are lost before the vector gets here
    out = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_vectors(df, cosine=cosine).collect()}
    want = {i: (n, c) for i, n, c in brute([r[0] for r in rows], [r[2] for r in rows], cosine)}
    assert out == want and out[1000][0] >= 2 and out[1007][0] >= 1


def test_recall_of_the_index():
    """Neighbours at exactly the threshold are found within the calibrated depth."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(6000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = embeddings.build_index(x[:4096], 50_000, 0.95)
    q = x[4096:]
    side = rng.normal(size=q.shape)
    side -= (side * q).sum(axis=1, keepdims=True) * q
    y = 0.95 * q + np.sqrt(1 - 0.95 ** 2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    assert (index.visits(q) == index.cells(y)[:, None]).any(axis=1).mean() >= 0.99


@pytest.mark.parametrize("power", [1, 2])
def test_recall_along_the_data(power):
    """Neighbours displaced along the covariance of anisotropic data, of vectors the index has not seen."""
    rng = np.random.default_rng(5)
    scale = np.arange(1, 65) ** (-power / 2)
    x = rng.normal(size=(12_000, 64)) * scale
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = embeddings.build_index(x[:9000], 2_000_000, 0.95)
    q = x[9000:]
    side = rng.normal(size=q.shape) * scale
    side -= (side * q).sum(axis=1, keepdims=True) * q
    y = 0.95 * q + np.sqrt(1 - 0.95 ** 2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    assert (index.visits(q) == index.cells(y)[:, None]).any(axis=1).mean() >= 0.995


def test_real_neighbours_against_brute_force(spark, monkeypatch):
    """Near-copies along a few directions of their own, which the covariance of all vectors hardly shows."""
    monkeypatch.setattr(embeddings, "CELL", 5)
    rng = np.random.default_rng(6)
    scale = 1 / np.arange(1, 33)
    x = rng.normal(size=(5000, 32)) * scale
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = np.zeros((2500, 32))
    side[:, [3, 20]] = rng.normal(size=(2500, 2))
    side -= (side * x[:2500]).sum(axis=1, keepdims=True) * x[:2500]
    y = 0.955 * x[:2500] + np.sqrt(1 - 0.955 ** 2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    x = np.vstack([x, y])
    out = embeddings.near_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()
    want = (x @ x.T >= 0.95).sum() - len(x)
    assert want * 0.998 <= sum(r.n_links for r in out) <= want


def test_unfinished_components_are_an_error(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    with pytest.raises(RuntimeError, match="no stars"):
        embeddings.connected_components(path, max_rounds=1)
    assert {r.comp for r in embeddings.connected_components(path).collect()} == {0}


def test_odd_rows(spark):
    v = [1.0, 2.0]
    rows = [(1, v, 0), (1, v, 0), (2, None, 0), (3, [], 0), (4, [0.0, 0.0], 0), (5, [1.0, None], 0), (6, [float("nan"), 1.0], 0), (7, [float("inf"), 1.0], 0),
            (None, v, 0), (9, [2.0, 4.0], 0), (10, [-1.0, 2.0], 0), (11, [1.0, 2.0, 0.0], 0), (12, [5.0], 0), (13, [2.0], 0), (None, [0.0], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n_links int")
    want = brute([r[0] for r in rows], [r[1] for r in rows])
    assert got(embeddings.near_vectors(df)) == sorted(want, key=str)
    kept = {(r.vec_id, r.kept) for r in embeddings.near_vectors(df).collect()}
    assert (1, True) in kept and (9, False) in kept and (None, False) in kept and (2, True) in kept
    assert embeddings.near_vectors(df.limit(0)).count() == 0
    assert embeddings.near_vectors(df.where("vec_id = 2")).collect()[0].n_links == 0

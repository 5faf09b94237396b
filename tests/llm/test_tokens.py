import numpy as np
import pandas as pd
from llm_tables import SF

from scrubjay.llm import tokens as T
from scrubjay.llm.queries import QUERIES


def encoder():
    with open(T.VOCABULARY, "rb") as f:
        return T.encoding(f.read())


def test_against_plain_counting(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    e = encoder()
    ids = [e.encode_ordinary(t) for t in docs.text]
    assert all(e.decode(i) == t for i, t in zip(ids, docs.text))
    n = np.array([len(i) for i in ids])
    out = QUERIES["op8_token_counts"](spark, SF).toPandas().sort_values("n_tokens")
    assert out.n_tokens.tolist() == sorted(set(n))
    for r in out.itertuples():
        assert (r.n_docs, r.docs_fitting, r.docs_longer) == ((n == r.n_tokens).sum(), (n <= r.n_tokens).sum(), (n > r.n_tokens).sum())
        assert (r.tokens_fitting, r.tokens_longer) == (n[n <= r.n_tokens].sum(), n[n > r.n_tokens].sum())
        assert (r.truncated_total, r.tokens_lost) == (np.minimum(n, r.n_tokens).sum(), np.maximum(n - r.n_tokens, 0).sum())
        assert (r.total_docs, r.total_tokens) == (len(n), n.sum())


def test_limits_and_quantiles(spark):
    n = np.array([0, 0, 3, 5, 5, 2000, 70_000])
    hist = T.length_histogram(spark.createDataFrame([(int(i),) for i in n], "n_tokens long"))
    t = T.context_limits(hist)
    got = {r.context_limit: (r.docs_fitting, r.truncated_total) for r in T.at_limits(t, [1, 5, 4096, 100_000]).collect()}
    assert got == {k: ((n <= k).sum(), np.minimum(n, k).sum()) for k in (1, 5, 4096, 100_000)}
    assert list(T.quantiles(t, [0.0, 0.5, 1.0]).first()) == [0, 5, 70_000]


def test_odd_rows(spark, odd_docs):
    rows = T.count_tokens(odd_docs.withColumnRenamed("k", "N_tokens")).collect()
    assert len(rows) == odd_docs.count()
    assert all((r.n_tokens == 0) == (not r.text) for r in rows)
    empty = T.context_limits(T.length_histogram(T.count_tokens(odd_docs.limit(0))))
    assert empty.count() == 0

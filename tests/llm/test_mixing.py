import re

import numpy as np
import pandas as pd
import pytest
from llm_tables import DOCS, SF

from scrubjay.llm import mixing
from scrubjay.llm.queries import QUERIES


def brute_targets(sizes, cycle=(1, 2, 3), cap=3):
    """Sources in order; excess over the cap reshared until none is above."""
    total, w, capped = sum(sizes), [cycle[i % len(cycle)] for i in range(len(sizes))], set()
    while True:
        rest = total - sum(cap * sizes[i] for i in capped)
        share = sum(w[i] for i in range(len(sizes)) if i not in capped)
        t = [cap * sizes[i] if i in capped else rest * w[i] / share for i in range(len(sizes))]
        new = {i for i in range(len(sizes)) if i not in capped and t[i] > cap * sizes[i] + 1e-9}
        if not new:
            return t
        capped |= new


def test_contract(spark):
    out = QUERIES["op2_mixing"](spark, SF).toPandas()
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    m = out.merge(docs, on="doc_id")
    assert len(m) == len(docs) == len(out)
    assert (m["size"] == m.text.map(lambda t: len(re.findall(r"[^\x20\x09-\x0d]+", t)))).all()
    s = m.groupby("source").agg(size=("size", "sum"), source_size=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"))
    assert (s["size"] == s.source_size).all()
    assert np.allclose(s.target, brute_targets(s["size"].tolist()))
    assert (abs(s.taken - s.target) <= 0.02 * s.target + 20).all()
    assert (m.taken <= 3 * m["size"]).all() and (m.taken % m["size"] == 0).all()


def test_rerun_agrees(spark):
    a, b = (sorted(map(tuple, QUERIES["op2_mixing"](spark, SF).collect())) for _ in range(2))
    assert a == b


@pytest.mark.parametrize("sizes", [[10, 1000, 5, 2000, 0, 30], [1, 1, 1000], [5], [0, 0], [100] * 7])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(f"s{i:02d}", s) for i, s in enumerate(sizes)], "source string, source_size long")
    got = [r.target for r in mixing.source_targets(df).orderBy("source").collect()]
    assert np.allclose(got, brute_targets(sizes))


def test_rates_are_the_entropy_solution(spark):
    """Rates of a source are min(cap, exp(lam size / scale)) for one lam, and meet the target."""
    rng = np.random.default_rng(5)
    rows = [(i, "w " * int(n), None, f"s{i % 4}", None) for i, n in enumerate(rng.integers(1, 60, 400))]
    out = mixing.mix_sources(spark.createDataFrame(rows, DOCS)).toPandas()
    for _, g in out.groupby("source"):
        assert abs((g.rate * g["size"]).sum() / g.target.iloc[0] - 1) < 1e-5
        free = g[g.rate < 3 - 1e-6]
        tilt = np.log(free.rate) / free["size"]
        assert tilt.max() - tilt.min() < 1e-5


def test_odd_rows(spark, odd_docs):
    out = mixing.mix_sources(odd_docs, rows_per_part=2)
    rows = out.collect()
    assert len(rows) == odd_docs.count() and "Size" not in out.columns
    assert all(r["size"] == 0 and r.taken == 0 and r.copies == 1 for r in rows if not (r.text or "").strip(" \t\n"))
    assert all(0 <= r.copies <= 3 and r.taken == r.copies * r["size"] for r in rows)
    nulls = [r for r in rows if r.source is None]
    assert {r.source_size for r in nulls} == {4} and len({r.target for r in nulls}) == 1
    kept = mixing.repeated(out)
    assert kept.count() == sum(r.copies for r in rows)


def test_empty_table(spark, odd_docs):
    assert mixing.mix_sources(odd_docs.limit(0)).count() == 0


def test_copies_equal_the_mix(spark, odd_docs):
    """Each row as often as the mix takes it, with its own columns, also those named like the mix's; no text is shuffled."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "'own' AS size", "7 AS Target")
    want = {r.doc_id: r.copies for r in mixing.mix_sources(docs).collect()}
    out = mixing.mixed_copies(docs, rows_per_part=50)
    assert out.columns == docs.columns
    got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert {r[0] for r in out.select("size").distinct().collect()} == {"own"}
    small = {r.doc_id: r["count"] for r in mixing.mixed_copies(docs).groupBy("doc_id").count().collect()}
    assert small == {k: v for k, v in want.items() if v} and len(set(small.values())) > 1
    assert sum(got.values()) > 0 and max(got.values()) <= 3
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan
    n = mixing.mixed_copies(odd_docs).groupBy("doc_id", "text").count().collect()
    assert all(r["count"] >= 1 for r in n if not (r.text or "").strip()) and mixing.mixed_copies(odd_docs.limit(0)).count() == 0

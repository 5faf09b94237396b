import pandas as pd
from llm_tables import SF
from test_decontam import brute as leaks
from test_minhash import brute as copies

import corpus_pipeline as P
from scrubjay.llm import quality
from scrubjay.llm.common import table


def test_stages_against_brute_force(spark, tmpdir_path):
    docs, frames = table(spark, SF, "documents"), []
    for name, stage in P.STAGES:
        stage(spark, docs, SF).write.parquet(f"{tmpdir_path}/{name}")
        docs = spark.read.parquet(f"{tmpdir_path}/{name}")
        frames.append(docs.toPandas().sort_values("doc_id").reset_index(drop=True))
    first = pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id")
    columns = list(first.columns)
    assert [n for n, _ in P.STAGES] == ["quality", "near_dedup", "decontaminate", "mix", "shard"]
    assert all(list(f.columns) == columns for f in frames[:-1])
    good, single, clean, mixed, sharded = frames

    source = table(spark, SF, "documents")
    model = quality.fit(source.select("doc_id", "text"), quality.learnable(spark, SF))
    scores = quality.score_quality(source.select("doc_id", "text"), model).toPandas()
    assert good.doc_id.tolist() == sorted(scores[scores.score >= P.QUALITY].doc_id)

    groups = copies(good.doc_id.tolist(), good.text.tolist(), P.WIDTH, P.PERCENT)
    assert single.doc_id.tolist() == sorted({g[2] for g in groups})

    bench = pd.read_parquet(f"{SF}/benchmark.parquet")
    hit = leaks(single.text, list(zip(bench.item_id, bench.text)), P.WINDOW)
    assert clean.doc_id.tolist() == [i for i, h in zip(single.doc_id, hit) if not h[4]] and len(clean) < len(single)

    counts = mixed.doc_id.value_counts()
    assert counts.max() <= 3 and set(counts.index) <= set(clean.doc_id)
    words = mixed.text.str.split().str.len().groupby(mixed.source).sum()
    have = clean.text.str.split().str.len().groupby(clean.source).sum()
    from test_mixing import brute_targets
    target = brute_targets(have.tolist())
    for s, t in zip(have.index, target):
        assert abs(words.get(s, 0) - t) <= 0.05 * t + 30

    assert len(sharded) == len(mixed) and sharded.groupby("text").shard.nunique().max() == 1
    for _, g in sharded.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))


def test_run_on_odd_documents(spark, odd_docs, tmpdir_path):
    """Nulls, empty texts and repeated rows go through every stage; so does an empty table."""
    for part in (odd_docs.select("doc_id", "text", "lang", "source", "n_chars"), odd_docs.select("doc_id", "text", "lang", "source", "n_chars").limit(0)):
        docs = part
        n = [part.count()]
        for name, stage in P.STAGES:
            docs = stage(spark, docs, SF)
            n.append(docs.count())
        assert set(part.columns) <= set(docs.columns) and {"size", "shard", "slot"} <= set(docs.columns)
        assert n[1] <= n[0] and n[2] <= n[1] and n[3] <= n[2] and n[5] == n[4] <= 3 * n[3]
        assert (n[-1] > 0) == (n[0] > 0)

import math
import random
import re

import numpy as np
import pandas as pd
import pytest
from llm_tables import DOCS, SF

from scrubjay.llm import differences, minhash
from scrubjay.llm.common import connected_components
from scrubjay.llm.queries import QUERIES

LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text, width=3):
    w = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def brute(ids, texts, width=3, percent=85):
    sets, root = [shingles(t, width) for t in texts], list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(ids)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    low = {}
    for i in range(len(ids)):
        low[find(i)] = min(low.get(find(i), ids[i]), ids[i])
    return [(ids[i], len(sets[i]), low[find(i)]) for i in range(len(ids))]


def got(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def test_against_brute_force(spark):
    out = QUERIES["op6_minhash_near_dedup"](spark, SF)
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    want = brute(docs.doc_id.tolist(), docs.text.tolist())
    assert got(out) == sorted(want)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out.collect())
    assert len({w[2] for w in want}) < len(want)


@pytest.mark.parametrize("few, split", [(8, 8192), (8192, 8192), (0, 8192), (0, 4), (0, 0)])
def test_families_and_common_passages(spark, few, split):
    """Families of edited copies, and unrelated documents that share a passage; a small
    ``few`` forces differences to pivots, a small ``split`` further coordinates."""
    rng = random.Random(few + split)
    words = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    passage, texts = words(60), []
    for _ in range(4):
        base = words(120)
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = "edited"
            texts.append(" ".join(copy))
    texts += [" ".join(words(30) + passage + words(30)) for _ in range(25)]
    texts += [" ".join(passage + words(3)) for _ in range(6)] + ["a b", "A  b", "c", None, "", " \t "]
    rng.shuffle(texts)
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    assert got(minhash.near_duplicates(df, few=few, split=split)) == sorted(brute(list(range(len(texts))), texts))


@pytest.mark.parametrize("few, split", [(0, 8192), (0, 0), (16, 8192)])
@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_related_families(spark, few, split, width, percent):
    """A family whose members are mostly related but not linked, with links between edited members."""
    rng = random.Random(few + split + percent)
    base = [f"w{rng.randrange(400)}" for _ in range(90)]
    texts = []
    for _ in range(160):
        copy = list(base)
        for _ in range(rng.choice([1, 2, 4, 6, 8, 12])):
            copy[rng.randrange(90)] = f"e{rng.randrange(60)}"
        texts.append(" ".join(copy[:rng.choice([90, 90, 86])]))
        if rng.random() < 0.3:
            copy[rng.randrange(90)] = "again"
            texts.append(" ".join(copy))
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    want = brute(list(range(len(texts))), texts, width, percent)
    assert len({w[2] for w in want}) > 20
    assert got(minhash.near_duplicates(df, width=width, percent=percent, few=few, split=split)) == sorted(want)


@pytest.mark.parametrize("percent", [90, 85, 80])
def test_differences_find_all_pairs(spark, percent):
    """All similar pairs of a group with one at least outside the pivot's reach, whatever the pivot."""
    rng = np.random.default_rng(percent)
    base = rng.integers(0, 1 << 63, 120, dtype=np.uint64)
    sets = []
    for i in range(90):
        keep = base[rng.random(120) > rng.choice([0.02, 0.1, 0.25])]
        sets.append(np.unique(np.concatenate([keep, rng.integers(0, 1 << 63, rng.integers(0, 20), dtype=np.uint64)])))
        if i % 3 == 0:
            sets.append(np.unique(np.concatenate([sets[-1][3:], rng.integers(0, 1 << 63, 2, dtype=np.uint64)])))

    def similar(a, b):
        both = len(np.intersect1d(a, b))
        return 100 * both >= percent * (len(a) + len(b) - both)
    for pivot in (0, 7, 41):
        comp = [-1 if similar(s, sets[pivot]) else i for i, s in enumerate(sets)]
        members = spark.createDataFrame([(pivot, i, len(s), comp[i], comp[i] != -1, len(sets)) for i, s in enumerate(sets)],
                                        "pivot long, node long, n long, comp long, outside boolean, size long")
        rows = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate(sets)], "node long, shingles binary")
        found = {tuple(sorted(map(int, r))) for r in differences.similar_in_groups(members, rows, percent)[0].collect()}
        want = {(i, j) for j in range(len(sets)) for i in range(j) if comp[i] != comp[j] and similar(sets[i], sets[j])}
        assert want and want <= found


@pytest.mark.parametrize("copies", [100, 300])
def test_families_are_met_at_their_centre(spark, monkeypatch, copies):
    """Copies of one text, edited each in its own way: half of them resemble the text, few each other. Whatever members the
    lists name as pivots, differences are posted about once a member and no square of the family is compared."""
    rng = random.Random(copies)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for i in range(copies):
        copy = list(base)
        for j in rng.sample(range(200), rng.choice([3, 6, 12, 15, 20])):
            copy[j] = f"e{i}x{j}"
        texts.append(" ".join(copy))
    seen = []

    def similar(members, sets, percent):
        pairs, posted = differences.similar_in_groups(members, sets, percent)
        seen.append((members.count(), members.select("node").distinct().count(), pairs.count()))
        return pairs, posted
    monkeypatch.setattr(minhash, "similar_in_groups", similar)
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    want = brute(list(range(copies)), texts)
    assert got(minhash.near_duplicates(df, few=0)) == sorted(want)
    assert all(members <= 1.5 * nodes and pairs <= 2 * copies for members, nodes, pairs in seen)


def test_gathered(spark):
    """Groups that lie in a larger one for the most part move to it; others stay."""
    groups = {1: range(10), 2: range(3, 12), 3: [11, 20, 21], 4: [20, 21, 22, 23], 5: [9]}
    rows = spark.createDataFrame([(p, n, 7) for p, nodes in groups.items() for n in nodes], "pivot long, node long, n long")
    out = {}
    for r in minhash._gathered(rows).collect():
        out.setdefault(r.pivot, []).append(r.node)
    assert {p: sorted(n) for p, n in out.items()} == {1: list(range(12)), 4: [11, 20, 21, 22, 23]}


def test_central_members(spark):
    """The member that holds what most hold, though the pivot is far from all; a group without drawn rows has one too."""
    base = set(range(1, 60))
    sets = {0: set(range(40, 150)), 1: base, 2: base - {3} | {200}, 3: base - {9, 10} | {300, 301}, 4: base | {400}}
    rows = spark.createDataFrame([(i, bytearray(np.array(sorted(s), np.uint64).tobytes())) for i, s in sets.items()], "node long, shingles binary")
    members = spark.createDataFrame([(0, i, 5) for i in range(5)] + [(2, 3, 1)], "pivot long, node long, size long")
    assert {(r.pivot, r.centre) for r in differences.central_members(members, rows, 85).collect()} == {(0, 1), (2, 3)}
    members = members.withColumn("size", members["size"] + (1 << 40))
    assert {r.pivot for r in differences.central_members(members, rows, 85).collect()} == {0, 2}


def test_least_matches():
    for p in (0.95, 0.85, 0.8, 0.5):
        t = minhash.least_matches(p)
        fewer = lambda k: sum(math.comb(32, i) * p ** i * (1 - p) ** (32 - i) for i in range(k))
        assert fewer(t) <= 1e-8 < fewer(t + 1)
    assert minhash.least_matches(0.05) == 1


def test_odd_rows(spark, odd_docs):
    out = {(r.doc_id, r.n_shingles, r.component_id, r.kept, r.leader) for r in minhash.near_duplicates(odd_docs).collect()}
    assert (1, 1, 1, True, True) in out and (2, 0, 2, True, True) in out and (None, 0, None, False, True) in out
    kept = minhash.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, None, 5, 6, None], key=str)
    assert minhash.near_duplicates(odd_docs.limit(0)).count() == 0
    assert minhash.drop_near_duplicates(odd_docs.limit(0)).count() == 0


def test_drop_keeps_one_of_a_group(spark):
    rows = [(5, "a b c d e f", "", "", 0), (3, "A b c d e f", "", "", 0), (None, "a b c d e f", "", "", 0), (3, "other words here now", "", "", 0)]
    kept = minhash.drop_near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(r.text for r in kept) == ["A b c d e f", "other words here now"]


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(-200, 200), rng.randrange(-200, 200)) for _ in range(120)] + [(i, i + 1) for i in range(1000, 1060)]
    edges = [e for e in edges if e[0] != e[1]]
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    out = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert dict(map(tuple, out.collect())) == root


def test_components_plan_few_shuffles(spark, monkeypatch):
    """Each shuffle or broadcast of a plan takes a thread and memory of the driver."""
    from scrubjay.llm import common
    plans, write = [], common.materialise

    def recorded(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)
    monkeypatch.setattr(common, "materialise", recorded)
    edges = spark.range(50).selectExpr("id * 2 + 1 AS a", "id * 2 + 2 AS b").union(spark.range(40).selectExpr("id AS a", "id + 1 AS b"))
    out = {r.node: r.comp for r in common.connected_components(edges).collect()}
    assert out == {n: 0 if n <= 40 else n - 1 + n % 2 for n in range(101)}
    assert len(plans) >= 3
    assert all(p.count("Exchange") <= 8 for p in plans[1:])

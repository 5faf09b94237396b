"""The trie against its definition over whole sequences, with containers, rounds and ranges small enough to be cut."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pandas as pd
import pytest
from llm_tables import SF

from scrubjay.llm import prefix_trie as T
from scrubjay.llm.queries import ORACLE, QUERIES

TURNS = "conv_id long, turn long, role string, text string"


def tid(role, text):
    r, x = (role or "").encode(), (text or "").encode()
    return hashlib.sha256(str(len(r)).encode() + b":" + r + x).hexdigest()


def sequences(rows):
    """Rebuilt (role, text) sequences by conversation."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, tid(role, text), (role or "", text or "")))
    own = {c: [x[-1] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + v[h:]
    return out


def brute(rows):
    seqs = sequences(rows)
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1].encode()) if p else 0)
    sha = lambda m: hashlib.sha256(",".join(map(str, sorted(m))).encode()).hexdigest()
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids.get(p, 0), leaves[p], saved[p],
                    sha([c for c in m if len(seqs[c]) == len(p)])) for p, m in members.items()), key=str)


def trie(spark, rows, **small):
    df = spark.createDataFrame(rows, TURNS).repartition(3)
    ranges = {k: v for k, v in small.items() if k == "range_rows"}
    return sorted(map(tuple, T.prefix_trie(*T.rebuilt(T.numbered_turns(df, **ranges)), **small).select(*T.OUTPUT).collect()), key=str)


def test_query_matches_oracle_and_brute_force(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SF}/conversations.parquet'")
    got = QUERIES["op13_prefix_trie"](spark, SF).select(*T.OUTPUT).collect()
    got = sorted(map(tuple, got), key=str)
    assert got == sorted(con.execute(f"select {', '.join(T.OUTPUT)} from ({ORACLE['op13_prefix_trie']})").fetchall(), key=str)
    assert got == brute(list(pd.read_parquet(f"{SF}/conversations.parquet").itertuples(index=False, name=None)))


def families(seed):
    """Copies, a common first turn, one long conversation with copies, its prefixes, and conversations that differ late."""
    rng, rows = random.Random(seed), []
    long = [(rng.choice("ua"), f"turn {i} " + "x" * (i % 7)) for i in range(60)]
    for c in range(70):
        kind = c % 7
        if kind == 0:
            seq = long
        elif kind == 1:
            seq = long[:rng.randint(1, 60)]
        elif kind == 2:
            seq = long[:40] + [("u", f"own {c}")] * rng.randint(1, 12)
        elif kind == 3:
            seq = [("u", "hello"), ("a", "hi"), ("u", "bye")]
        else:
            seq = [("u", "hello")] + [(rng.choice("ua"), rng.choice("pqr")) for _ in range(rng.randint(0, 14))]
        rows += [(c, i, r, t) for i, (r, t) in enumerate(seq)]
    return rows


@pytest.mark.parametrize("small", [dict(capacity=1, levels=1, range_rows=37), dict(capacity=40, levels=3, range_rows=200), {}])
def test_families_burst_and_ranges(spark, small):
    rows = families(3)
    assert trie(spark, rows, **small) == brute(rows)


ODD = [(10, None, "user", "first"), (10, 3, None, "third"), (10, 3, None, "third"), (10, -1, "user", None), (11, 0, None, None), (11, 0, "x", ""),
       (None, 0, "user", "nobody's"), (12, 1, "ab", "c"), (12, 2, "a", "bc"), (1000, 1, "user", "w" * 100_000), (1001, 1, "user", "é😀\0"),
       (1003, 1, "user", ""), (1004, 1, "user", ""), (9, 5, "u", "base is missing")]


@pytest.mark.parametrize("small", [dict(capacity=1, levels=1, range_rows=2), {}])
def test_odd_rows(spark, small):
    """Nulls everywhere, ties, repeated rows, turnless conversations, absent bases, long texts."""
    rows = ODD + [(c, 0, "u", "short") for c in range(40, 60)]
    assert any(not s for s in sequences(rows).values())
    assert trie(spark, rows, **small) == brute(rows)


def test_all_turnless_and_empty(spark):
    c = [c for c in range(200) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1][:3]
    rows = [(x, 0, "u", "t") for x in c]
    assert trie(spark, rows) == brute(rows) and len(brute(rows)) == 1
    assert trie(spark, []) == []


def test_extra_columns(spark):
    df = spark.createDataFrame([(5, 0, "u", "a"), (5, 1, "a", "b")], TURNS).selectExpr("*", "'x' AS ph", "'y' AS d", "'z' AS Pos", "1 AS size")
    out = T.prefix_trie(*T.rebuilt(T.numbered_turns(df)))
    assert sorted(map(tuple, out.select(*T.OUTPUT).collect()), key=str) == brute([(5, 0, "u", "a"), (5, 1, "a", "b")])


def test_ordered_sums_over_cut_keys(spark):
    rng = random.Random(1)
    rows = [(k, i, rng.randint(-9, 2**70)) for k, n in ((1, 100), (2, 1), (3, 400), (-7, 3)) for i in range(n)]
    df = spark.createDataFrame([(k, i, str(v)) for k, i, v in rows], "k long, i long, v string").repartition(5)
    got = {(r.k, r.i): int.from_bytes(r.s, "big") for r in T.ordered_sums(df, "k", ["i"], ["v"], int, "s", len(rows), 20).collect()}
    want, total = {}, defaultdict(int)
    for k, i, v in sorted(rows):
        total[k] = (total[k] + v) % (1 << 128)
        want[k, i] = total[k]
    assert got == want

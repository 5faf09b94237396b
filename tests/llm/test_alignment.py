"""Alignment against the definition, with plain loops over byte offsets."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from llm_tables import DOCS, SF

from scrubjay.llm import alignment as A
from scrubjay.llm.queries import QUERIES


@pytest.fixture(scope="module")
def plain():
    """Token ids and bytes of both sides, by the tokenizers' own libraries."""
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(A.BYTE_BPE)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=A.PIECES)
    of = A.byte_of_char()

    def tokens(text):
        if not text:
            return [], []
        a = [(i, bytes(of[c] for c in t.id_to_token(i))) for i in t.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode())
             for i in sp.encode(text)]
        want = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == want == b"".join(x for _, x in b) else ([], [])
    return tokens


def groups_of(a, b):
    """Lists of (A ids, B ids) between byte offsets where tokens of both end."""
    ends = lambda x: np.cumsum([len(t) for _, t in x]).tolist()
    ea, eb = ends(a), ends(b)
    cuts = sorted(set(ea) & set(eb))
    pick = lambda x, e, lo, hi: [i for (i, _), at in zip(x, e) if lo < at <= hi]
    return [(pick(a, ea, lo, hi), pick(b, eb, lo, hi)) for lo, hi in zip([0, *cuts], cuts)]


def brute(ids, texts, tokens):
    rows, holds, links = [], Counter(), []
    for text in texts:
        a, b = tokens(text)
        groups = groups_of(a, b)
        links.append(Counter((x, y) for g, h in groups for x in g for y in h))
        holds.update(set(links[-1]))
        said = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        rows.append([len(a), len(b), len(groups), hashlib.sha256(said.encode()).hexdigest() if a else ""])
    best = defaultdict(int)
    for (x, _), n in holds.items():
        best[x] = max(best[x], n)
    return [(i, na, nb, ng, sum(k.values()), sum(m for p, m in k.items() if holds[p] == best[p[0]]), sum(m * holds[p] for p, m in k.items()), h)
            for i, (na, nb, ng, h), k in zip(ids, rows, links)]


COLS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [None, "", " ", "plain words here", "plain words here", "▁ in a text", "a\x00b\tc\r\nd", "<|endoftext|> and <s></s><unk><0x41>", "é😀ﬁ Ⅳ 漢字かな ไทย", "  two  spaces  ",
       "x" * 3000, "=" * 500 + " " * 400 + "\n" * 300, "".join(chr(0x1F300 + i % 200) for i in range(400)), "naïve " * 2000]


def got(df):
    return sorted(map(tuple, df.select(*COLS).collect()), key=str)


def test_query_matches_brute_force(spark, plain):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    assert got(QUERIES["op12_token_alignment"](spark, SF)) == sorted(brute(docs.doc_id.tolist(), docs.text.tolist(), plain), key=str)


@pytest.mark.parametrize("at_once", [10**6, 0])
def test_odd_texts_by_table_and_by_join(spark, plain, at_once, monkeypatch):
    monkeypatch.setattr(A, "EXPAND", 50)
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(ODD)], DOCS)
    digest = A.materialise(A.align_digest(df, carry=["doc_id"]), "t")
    out = A.link_statistics(digest, A.piece_count(), at_once)
    assert got(out) == sorted(brute(range(len(ODD)), ODD, plain), key=str)


def test_arrays_hold_the_groups(spark, plain):
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(ODD)], DOCS).repartition(2)
    for r in A.align_tokens(df).collect():
        a, b = plain(r.text)
        want = groups_of(a, b)
        k = max(r.a_groups, default=-1) + 1
        have = [([i for i, g in zip(r.a_ids, r.a_groups) if g == x], [i for i, g in zip(r.b_ids, r.b_groups) if g == x]) for x in range(k)]
        assert have == want


def test_nulls_clashes_and_empty_table(spark, odd_docs):
    clash = odd_docs.selectExpr("*", "'x' AS N_A", "'y' AS pairs", "'z' AS n_best")
    out = A.link_statistics(A.materialise(A.align_digest(clash), "t"), A.piece_count())
    assert out.count() == odd_docs.count() and {c.lower() for c in out.columns} >= {"n_a", "n_best", "size", "k"}
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    zero = out.where("text IS NULL OR text = ''").select("n_a", "n_links", "n_best", "count_sum", "groups_sha256").distinct().collect()
    assert [tuple(r) for r in zero] == [(0, 0, 0, 0, "")]
    empty = A.materialise(A.align_digest(odd_docs.limit(0)), "t")
    assert A.link_statistics(empty, A.piece_count()).count() == 0 == A.link_statistics(empty, A.piece_count(), at_once=-1).count()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.integers(0, 2**32))
def test_terminal_groups(lengths, seed):
    """Pointer jumping gives the runs between common ends, whatever the cuts."""
    total, rng = sum(lengths), random.Random(seed)
    a = np.cumsum(lengths)
    b = np.array(sorted(set(rng.choices(range(1, total + 1), k=len(lengths))) | {total}))
    ga, gb, n = A.terminal_groups(a, b)
    cuts = sorted(set(a.tolist()) & set(b.tolist()))
    assert n == len(cuts)
    assert ga.tolist() == np.searchsorted(cuts, a).tolist() and gb.tolist() == np.searchsorted(cuts, b).tolist()


def test_encoder_equals_the_files_own(plain):
    """The faster encoder gives the ids of the JSON file's own library."""
    a, _ = A.encoders(open(A.BYTE_BPE, "rb").read(), open(A.PIECES, "rb").read())
    rng = random.Random(3)
    words = [b.decode() for b in a.bytes if b and b.isascii()]
    for _ in range(300):
        text = "".join(rng.choices(words, k=rng.randint(1, 20)))
        assert [i for i, _ in plain(text)[0]] in ([], a.encode(" " + text))

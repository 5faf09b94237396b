import hashlib
import random
import re

import pandas as pd
import pytest
from llm_tables import DOCS, SF

from scrubjay.llm import decontam
from scrubjay.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def brute(docs, items, width=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for s in range(max(len(w) - width + 1, 1 if w else 0)):
            windows.setdefault(tuple(w[s:s + width]), set()).add("" if item is None else str(item))
    lengths = {len(k) for k in windows}
    out = []
    for text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for p in range(len(w) - n + 1):
                got = windows.get(tuple(w[p:p + n]))
                if got:
                    found |= got
                    hit.update(range(p, p + n))
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


COLS = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def test_against_brute_force(spark):
    out = QUERIES["op7_decontamination"](spark, SF).toPandas().sort_values("doc_id")
    docs = pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id")
    bench = pd.read_parquet(f"{SF}/benchmark.parquet")
    want = brute(docs.text, list(zip(bench.item_id, bench.text)))
    assert list(out[COLS].itertuples(index=False, name=None)) == want
    assert sum(w[4] for w in want) > 0


@pytest.mark.parametrize("seed,block", [(1, 1 << 20), (2, 700), (3, 300)])
def test_random_overlaps(spark, seed, block):
    """Few distinct words, so windows repeat; several blocks must agree with one."""
    rng = random.Random(seed)
    vocabulary = ["a", "B", "é", "straße", "x9", "Z"]
    text = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", ",", "."]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 4, 5, 12, 30]) if i % 3 else rng.choice([5, 14]))) for i in range(14)] + [(None, text(11)), (3, text(13))]
    items = [x for x in items if len(words(x[1])) not in (1,)]
    docs = [text(rng.randint(0, 80)) + " " + " ".join(rng.choice(items)[1] for _ in range(rng.randint(0, 2))) for _ in range(60)] + [None, ""]
    d = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(docs)], DOCS).repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    out = decontam.find_overlaps(d, b, block_bytes=block).toPandas().sort_values("doc_id")
    assert list(out[COLS].itertuples(index=False, name=None)) == brute(docs, items)


def test_longest_match(spark):
    w = [f"w{i}" for i in range(40)]
    d = spark.createDataFrame([(1, "x y " + " ".join(w[5:30]) + " z " + " ".join(w[:10]), None, None, None)], DOCS)
    b = spark.createDataFrame([(7, " ".join(w))], "item_id long, text string")
    r = decontam.find_overlaps(d, b).first()
    assert (r.longest, r.longest_at, r.longest_item, r.n_hit) == (25, 2, "7", 35)


def test_long_words_and_segments(spark, monkeypatch):
    import numpy as np
    import pyarrow as pa

    from scrubjay.llm import words as W

    texts = ["ab " * 50, "x" * 300, None, "é" * 70 + " y", "", " q "]
    whole = W.word_hashes(*W.buffers(pa.array(texts, pa.string())), W.NOT_SPACE)
    monkeypatch.setattr(W, "SEGMENT", 400)
    W._powers.clear()
    cut = W.word_hashes(*W.buffers(pa.array(texts, pa.string())), W.NOT_SPACE)
    W._powers.clear()
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()
    assert np.diff(whole[1]).tolist() == [50, 1, 0, 2, 0, 1]


def test_a_word_longer_than_a_segment(spark):
    """With the real segment: one word, equal to itself wherever it stands and different from a longer one."""
    import pyarrow as pa

    from scrubjay.llm import words as W

    long = "x" * (2 * W.SEGMENT + 40) + "y"
    texts = [f"{long} two three", f"one {long.upper()} three", long, long + "y", None, long + "\x00" + long]
    h, first = W.word_hashes(*W.buffers(pa.array(texts, pa.string())), W.ALNUM)
    assert first.tolist() == [0, 3, 6, 7, 8, 8, 10]
    assert len({h[0], h[4], h[6], h[8], h[9]}) == 1 and h[7] != h[0] and h[2] == h[5]
    d = spark.createDataFrame([(1, texts[0], None, None, None)], DOCS)
    item = spark.createDataFrame([(7, f"{long} TWO three")], "item_id long, text string")
    r = decontam.find_overlaps(d, item).first()
    assert (r.n_words, r.n_hit) == (3, 3)


def test_odd_rows(spark, odd_docs):
    b = spark.createDataFrame([(1, "The MIT license!"), (None, "other text"), (2, None), (3, "")], "item_id long, text string")
    out = decontam.find_overlaps(odd_docs, b)
    rows = out.collect()
    assert len(rows) == odd_docs.count() and out.columns.count("n_words") == 1
    assert [r.n_hit for r in rows if r.doc_id == 1] == [3, 3]
    assert [r.n_words for r in rows if r.text is None] == [0, 0]
    assert decontam.remove_contaminated(odd_docs, b).count() == len(rows) - 3
    empty = b.limit(0)
    assert decontam.find_overlaps(odd_docs, empty).where("contaminated").count() == 0
    assert decontam.find_overlaps(odd_docs.limit(0), b).count() == 0

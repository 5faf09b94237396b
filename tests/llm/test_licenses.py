import random
import re

import duckdb
import pandas as pd
import pytest
from llm_tables import DOCS, SF

from scrubjay.llm import licenses as L
from scrubjay.llm.queries import ORACLE, QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute(text):
    w = WORD.findall((text or "").translate(LOWER))
    places, base = [], set()
    for phrase, label in L.PHRASES:
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    said, best = runs(text)
    labels, best = base | set(said.split(",")) - {""}, 1.0 if base else best
    labels -= {a for a, b in L.REFINED.items() if b in labels} - base
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), best)


TEXTS = ["Under the MIT License.", "under the mit\nlicense under the MIT license", "x CC BY-NC y cc by nc", "apache license version 2 " * 3,
         "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated files",
         "license mit the under", "This work is licensed under the GNU General Public License, version 3.", None, "", "É under the mİt license", "cc by", "\n\n", "under the mit license" + " pad" * 50_000,
         "word " * 10 + "licensed under the gnu public license version 3", "a\x00under\x7fthe-mit_license"]


def test_against_brute_force(spark):
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(TEXTS)], DOCS)
    out = {r.doc_id: r for r in L.scan_licenses(df).collect()}
    for i, t in enumerate(TEXTS):
        r = out[i]
        n = brute(t)
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) == n[:6], t
        assert r.score == pytest.approx(n[6])


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:"""
GPL = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by"""


def runs(text):
    """Labels and best containment over all runs of words."""
    w = WORD.findall((text or "").translate(LOWER))
    labels, best = set(), 0.0
    for t in L.templates():
        if not t.whole:
            sets = [set(w[i:i + t.span]) for i in range(max(1, len(w) - t.span + 1))]
            most = max((len(r & set(t.tokens)) for r in sets if r >= set(t.must) and not r & set(t.never)), default=0)
            if most >= t.need:
                labels.add(t.label)
                best = max(best, most / len(t.tokens))
    return ",".join(sorted(labels - {a for a, b in L.REFINED.items() if b in labels})), best


def test_wrapped_notices_and_scattered_words(spark):
    rng = random.Random(8)
    narrow = lambda s: "\n".join(s.split())
    texts = [MIT, BSD, GPL, narrow(MIT), narrow(GPL), "\n * ".join(BSD.split("\n")), "released pad under pad the pad mit pad", "released under " + "pad " * 3000 + "the license mit"]
    want = ["mit", "bsd", "gpl", "mit", "gpl", "bsd", "mit", ""]
    for _ in range(120):  # notices in all places of windows, stretched to about the length of a run
        notice = rng.choice(L.TEMPLATES)[0].split()
        gaps = [x for y in notice for x in [y, *["pad"] * rng.choice([0, 0, 0, 1, 1, 2])]]
        texts.append(" ".join(["word"] * rng.randint(0, 120) + [x for x in gaps if rng.random() > 0.05] + ["tail"] * rng.randint(0, 120)))
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    out = {r.doc_id: r for r in L.scan_licenses(df).collect()}
    assert [out[i].labels for i in range(len(want))] == want
    some = set()
    for i, t in enumerate(texts):
        labels, best = runs(t)
        some.add(labels)
        if not out[i].n_base:
            assert (out[i].labels, out[i].score) == (labels, pytest.approx(best)), t
    assert len(some) > 5 and "" in some


NOTICES = {
    "This work is licensed under a Creative Commons Attribution 4.0 International License.": "cc-by",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "cc-by-sa",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.": "cc-by-nc",
    "Licensed under CC BY 4.0": "cc-by", "Licensed under CC BY SA 4.0": "cc-by-sa", "Licensed under CC BY-NC 4.0": "cc-by-nc", "Licensed under CC BY-NC-SA 4.0": "cc-by-nc",
    "Released under the Apache license": "apache", "released under the GPL license": "gpl", "released under the license of the vendor": "", "Released under the MIT license": "mit",
    "Licensed under the GNU General Public License version 2": "gpl-2", "Licensed under the GNU General Public License, version 3": "gpl-3",
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published": "lgpl",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License": "agpl",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published": "gpl",
    "Licensed under the Apache License, Version 2.0 (the License)": "apache-2",
}


def test_licences_are_told_apart(spark):
    """The words that tell licences apart are never the missing ones, in Spark and in SQL."""
    rows = [(i, pad + t + tail, None, None, None) for i, (t, pad, tail) in enumerate((t, *p) for t in NOTICES for p in (("", ""), ("some words\nbefore ", "\nand after")))]
    df = spark.createDataFrame(rows, DOCS)
    want = [v for v in NOTICES.values() for _ in range(2)]
    assert [r.labels for r in L.scan_licenses(df).orderBy("doc_id").collect()] == want
    con = duckdb.connect()
    documents = df.toPandas()
    con.register("documents", documents)
    got = con.execute(f"select labels from ({L.oracle_sql()}) order by doc_id").fetchall()
    assert [r[0] for r in got] == want


def test_oracle(spark):
    out = QUERIES["op4_license_scan"](spark, SF).toPandas().sort_values("doc_id")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(ORACLE["op4_license_scan"]).df().sort_values("doc_id")
    for c in want.columns:
        a, b = ([None if pd.isna(x) else x for x in t[c].tolist()] for t in (out, want))
        assert a == b, c


def test_plan_is_native(spark):
    text = QUERIES["op4_license_scan"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "CartesianProduct" not in text


def test_odd_rows(spark, odd_docs):
    out = L.scan_licenses(odd_docs)
    rows = out.collect()
    assert len(rows) == odd_docs.count() and out.columns.count("labels") == 1
    assert [r.n_base for r in rows if r.doc_id == 1] == [0, 0] and [r.labels for r in rows if r.doc_id == 1] == ["", ""]
    assert L.scan_licenses(odd_docs.limit(0)).count() == 0

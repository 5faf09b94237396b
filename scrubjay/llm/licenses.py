"""License scan: an exact set-similarity join of text blocks with templates.

A notice is found where ``need`` of a template's n tokens stand in a run of ``span`` words, whatever the
line ends between them. Blocks are overlapping windows of words, of which one holds every such run. Tokens are ordered globally by how many blocks of the corpus hold them, rarest first. A block
whose words contain at least ``need`` of a template's n tokens holds one of the template's first
n - need + 1 tokens (its prefix), so blocks are joined to an index of prefixes on the token. The first
shared token alone produces the pair; blocks that are too short (length
filter) or whose remaining tokens cannot reach ``need`` (positional filter) are dropped, and the
overlap of the rest is computed in full, in each run of ``span`` words. A run must also hold the words that tell
the licence from others, and none that name another. Phrases are templates too, with containment 1 in the
whole text; the texts found are then searched for the exact places.

Built-in functions only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import materialise, table, without

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Base phrases and labels.
PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
# Wording of common notices, their labels, the words that tell them from other licences (a run
# without them is no such notice), and words that make a run a notice of another licence.
TEMPLATES = [
    ("released under the mit license", "mit", "mit", ""),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit", "permission granted", ""),
    ("released under the apache license", "apache", "apache", "2"),
    ("licensed under the apache license version 2 0", "apache-2", "apache 2", ""),
    ("licensed under cc by nc 4 0", "cc-by-nc", "cc nc", ""),
    ("licensed under cc by sa 4 0", "cc-by-sa", "cc sa", "nc"),
    ("licensed under cc by 4 0", "cc-by", "cc by", "nc sa nd"),
    ("this work is licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc", "commons noncommercial", ""),
    ("this work is licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa", "commons sharealike", "noncommercial"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by", "commons attribution", "noncommercial sharealike noderivatives"),
    ("released under the gpl license", "gpl", "gpl", ""),
    ("licensed under the gnu general public license version 3", "gpl-3", "gnu general 3", "lesser affero"),
    ("licensed under the gnu general public license version 2", "gpl-2", "gnu general 2", "lesser affero"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl", "gnu general", "lesser affero"),
    ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "lgpl", "gnu lesser general", ""),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license", "agpl", "gnu affero general", ""),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd", "redistribution permitted", ""),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2", "mozilla", ""),
]
#: A label is left out of a text that also has the one that says more.
REFINED = {"apache": "apache-2"}
THRESHOLD = 0.8
STRETCH = 1.5  # words of a run for each word of a template
OUTPUTS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


@dataclass(frozen=True)
class Template:
    id: int
    label: str
    whole: bool           # joined with whole texts, else with windows
    tokens: tuple[str, ...]
    need: int
    span: int             # words that the tokens stand in, at most
    must: tuple[str, ...] = ()   # tokens that a run must hold
    never: tuple[str, ...] = ()  # words that it must not hold


def templates(notices=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD) -> list[Template]:
    out = []
    for text, label in phrases:
        t = tuple(dict.fromkeys(text.split()))
        out.append(Template(len(out), label, True, t, len(t), len(text.split())))
    for text, label, *own in notices:
        t = tuple(dict.fromkeys(text.split()))
        must, never = (tuple(x.split()) for x in (own or ["", ""]))
        out.append(Template(len(out), label, False, t, math.ceil(threshold * len(t) - 1e-9), math.ceil(STRETCH * len(text.split())), must, never))
    return out


def _lits(words) -> Column:
    return F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")


def _index(spark, known: list[Template], order: dict[str, int]) -> DataFrame:
    """One row per prefix token of a template; as small as the templates."""
    rows = []
    for t in known:
        ranked = sorted(t.tokens, key=order.__getitem__)
        for p, token in enumerate(ranked[:len(ranked) - t.need + 1]):
            rows.append((token, t.id, t.label, t.whole, p, t.need, t.span, ranked, list(t.must), list(t.never)))
    return spark.createDataFrame(rows, "token string, tid int, label string, whole boolean, p int, need int, span int, ranked array<string>, "
                                       "must array<string>, never array<string>")


def _places(text: str, phrase: str, n_words: str) -> tuple[Column, Column, Column]:
    """Number of places, first and last start in a double-spaced text."""
    p = " " + "  ".join(phrase.split()) + " "
    words_in = lambda s: ((F.length(s) - F.length(F.replace(s, F.lit("  "), F.lit("")))) / 2).cast("long")
    s, back = F.col(text), F.reverse(F.col(text))
    n = F.regexp_count(s, F.lit(f"(?={p})")).cast("long")
    first = words_in(F.left(s, F.locate(p, s) - 1))
    after = words_in(F.left(back, F.locate(p[::-1], back) - 1))
    return n, F.when(n > 0, first), F.when(n > 0, F.col(n_words) - after - len(phrase.split()))


def scan_licenses(docs: DataFrame, text: str = "text", notices=TEMPLATES, phrases=PHRASES,
                  threshold: float = THRESHOLD, carry: list[str] | None = None) -> DataFrame:
    """``docs`` plus ``n_words``, ``n_base`` (places where a phrase stands), ``first_word``, ``last_word``,
    ``base_labels``, ``labels`` (also those of notices found in a run of words) and ``score``, the best containment
    that meets ``threshold`` (1 for a phrase, 0 for none).

    Null and empty texts: no words, empty label lists, null places. Repeated texts get the same answer.
    Empty table: no rows. Input columns named like an output are replaced. ``carry``
    names the columns to keep (default all)."""
    spark = docs.sparkSession
    known = templates(notices, phrases, threshold)
    vocabulary = sorted({w for t in known for w in (*t.tokens, *t.never)})
    of_phrases = sorted({w for t in known if t.whole for w in t.tokens})
    shortest = min((t.need for t in known if t.whole), default=0)
    keep = [c for c in without(docs, OUTPUTS) if carry is None or c in carry]
    clean = F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN, " "))
    rows = docs.select(*keep, F.xxhash64(text).alias("__k1"), F.coalesce(F.crc32(F.encode(text, "UTF-8")), F.lit(-1)).alias("__k2"), clean.alias("__t"))
    # the words that templates know, in their places, for the whole text and for windows of twice the longest run, one
    # beginning after each longest run
    step = max((t.span for t in known if not t.whole), default=1)
    least = min((t.need for t in known if not t.whole), default=1)
    rows = rows.withColumn("__w", F.array_remove(F.split("__t", " "), ""))
    rows = rows.select(*keep, "__k1", "__k2", "__t", F.size("__w").cast("long").alias("n_words"),
                       F.transform("__w", lambda x: F.when(x.isin(vocabulary), x).otherwise("")).alias("__known"))
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("n_words") / step).cast("int") - 2))
    window = lambda k: F.slice("__known", k * step + 1, F.lit(2 * step))
    block = lambda k: F.struct(F.array_intersect(_lits(vocabulary), window(k)).alias("toks"), window(k).alias("words"))
    rows = rows.select(*keep, "__k1", "__k2", "__t", "n_words", F.filter(F.transform(starts, block), lambda b: F.size(b["toks"]) >= least).alias("__blocks"),
                       F.array_intersect(_lits(of_phrases), F.col("__known")).alias("__whole"))
    spaced = F.replace(F.concat(F.lit(" "), F.col("__t"), F.lit(" ")), F.lit(" "), F.lit("  "))
    rows = rows.withColumn("__text", F.when(F.size("__whole") >= shortest, spaced)).drop("__t")
    rows = materialise(rows, "license-digest")

    counted = rows.select(F.explode("__blocks.toks").alias("toks")).select(F.explode("toks").alias("token")).groupBy("token").count().collect()
    seen = {r["token"]: r["count"] for r in counted}  # at most one row per token of the templates
    order = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (seen.get(w, 0), w)))}
    index = F.broadcast(_index(spark, known, order))
    ranked = _lits(sorted(vocabulary, key=order.__getitem__))

    blocks = rows.select("__k1", "__k2", F.explode("__blocks").alias("b")).select(
        "__k1", "__k2", F.lit(False).alias("whole"), F.col("b.toks").alias("toks"), F.col("b.words").alias("words"), F.size("b.words").alias("size"))
    blocks = blocks.unionByName(rows.where("__text IS NOT NULL").select(
        "__k1", "__k2", F.lit(True).alias("whole"), F.col("__whole").alias("toks"), F.lit(None).cast("array<string>").alias("words"), F.col("n_words").cast("int").alias("size")))
    firsts = {w for t in known for w in sorted(t.tokens, key=order.__getitem__)[:len(t.tokens) - t.need + 1]}
    blocks = blocks.where(F.arrays_overlap("toks", _lits(sorted(firsts))))
    posted = blocks.withColumn("toks", F.array_intersect(ranked, "toks")).select("*", F.posexplode("toks").alias("at", "token"))
    pairs = posted.join(index, ["token", "whole"]).where(
        (F.col("size") >= F.col("need"))  # length
        & (1 + F.least(F.size("ranked") - F.col("p") - 1, F.size("toks") - F.col("at") - 1) >= F.col("need"))  # position
        & ~F.arrays_overlap("toks", F.slice("ranked", F.lit(1), F.col("p"))))  # the first shared token
    overlap = F.size(F.array_intersect("toks", "ranked"))
    run_starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - F.col("span") + 1))
    def held(s: Column) -> Column:
        run = F.slice("words", s, F.col("span"))
        fits = (F.size(F.array_intersect(run, F.col("must"))) == F.size("must")) & ~F.arrays_overlap(run, F.col("never"))
        return F.when(fits, F.size(F.array_intersect(run, F.col("ranked")))).otherwise(0)

    in_run = F.array_max(F.transform(run_starts, held))
    pairs = pairs.withColumn("overlap", overlap).where("overlap >= need").withColumn("overlap", F.when(F.col("whole"), F.col("overlap")).otherwise(in_run))
    matched = pairs.where("overlap >= need").select(
        "__k1", "__k2", "whole", "label", (F.col("overlap") / F.size("ranked")).alias("containment"))

    key = ["__k1", "__k2"]
    notices_found = matched.where("NOT whole").groupBy(*key).agg(
        F.collect_set("label").alias("__labels"), F.max("containment").alias("__best"))
    candidates = matched.where("whole").select(*key).distinct()
    texts = (rows.where("__text IS NOT NULL").join(candidates, key, "left_semi").select(*key, "__text", "n_words").dropDuplicates(key))
    found = [(_places("__text", phrase, "n_words"), label) for phrase, label in phrases]
    places = texts.select(
        *key, sum((n for (n, _, _), _ in found), F.lit(0).cast("long")).alias("__n"),
        F.array_min(F.array(*[f for (_, f, _), _ in found])).alias("first_word"),
        F.array_max(F.array(*[z for (_, _, z), _ in found])).alias("last_word"),
        F.array_compact(F.array(*[F.when(n > 0, F.lit(label)) for (n, _, _), label in found])).alias("__base"))
    out = rows.join(places, key, "left").join(notices_found, key, "left")
    none = F.array().cast("array<string>")
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    base, own = F.coalesce("__base", none), F.coalesce("__labels", none)
    for less, more in REFINED.items():
        own = F.when(F.array_contains(F.concat(base, own), more), F.array_remove(own, less)).otherwise(own)
    score = F.when(F.size(base) > 0, 1.0).otherwise(F.coalesce("__best", F.lit(0.0)))
    return out.select(*keep, "n_words", F.coalesce("__n", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
                      joined(base).alias("base_labels"), joined(F.concat(base, own)).alias("labels"), score.alias("score"))


def op4_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])


def oracle_sql() -> str:
    """In DuckDB, every run of words of every text that holds enough of a template's tokens at all."""
    lit = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]::varchar[]"
    starts, names, rows = [], [], []
    for i, (phrase, label) in enumerate(PHRASES):
        w = phrase.split()
        starts.append(f"list_filter(range(len(w)), lambda i: w[i+1:i+{len(w)}] = {lit(w)}) AS p{i}")
        names.append(f"CASE WHEN len(p{i}) > 0 THEN ['{label}'] ELSE [] END")
    for t in templates():
        if not t.whole:
            rows.append(f"({t.id}, '{t.label}', {lit(t.tokens)}, {t.need}, {t.span}, {lit(t.must)}, {lit(t.never)})")
    allp = " || ".join(f"p{i}" for i in range(len(PHRASES)))
    base = " || ".join(names)
    refined = " OR ".join(f"x = '{a}' AND list_contains(base || coalesce(ls, []), '{b}')" for a, b in REFINED.items())
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
p AS (SELECT doc_id, len(w) AS n_words, {', '.join(starts)} FROM d),
b AS (SELECT *, {allp} AS places, list_distinct({base}) AS base FROM p),
tpl(tid, label, tokens, need, span, must, never) AS (VALUES {', '.join(rows)}),
candidates AS (SELECT * FROM (SELECT doc_id, w, list_distinct(w) AS ws FROM d), tpl WHERE len(list_intersect(ws, tokens)) >= need),
runs AS (SELECT doc_id, label, tokens, need, must, never, list_distinct(w[i+1:i+span]) AS r
         FROM (SELECT *, unnest(range(greatest(1, len(w) - span + 1))) AS i FROM candidates)),
hits AS (SELECT doc_id, label, len(list_intersect(r, tokens)) / len(tokens)::DOUBLE AS c FROM runs
         WHERE len(list_intersect(r, tokens)) >= need AND list_has_all(r, must) AND NOT list_has_any(r, never)),
m AS (SELECT doc_id, list(label) AS ls, max(c) AS best FROM hits GROUP BY doc_id)
SELECT doc_id, n_words::BIGINT AS n_words, len(places)::BIGINT AS n_base, list_min(places)::BIGINT AS first_word, list_max(places)::BIGINT AS last_word,
       array_to_string(list_sort(base), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(base || list_filter(coalesce(ls, []), lambda x: NOT ({refined})))), ',') AS labels,
       CASE WHEN len(base) > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM b LEFT JOIN m USING (doc_id)"""

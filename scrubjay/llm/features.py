"""Hashed n-gram features of whole Arrow string columns, with numpy, and bounded
labelled samples for fitting."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from .words import NOT_SPACE, mix, word_hashes

PAD = 0


def symbols_of_letters() -> np.ndarray:
    """Bytes as symbols for language features: letters in lower case, the bytes of
    non-ASCII characters as they are, all else one separator."""
    t = np.full(256, 32, np.uint8)
    t[97:123] = np.arange(97, 123)
    t[65:91] = np.arange(97, 123)
    t[128:] = np.arange(128, 256)
    return t


def symbols_of_shape() -> np.ndarray:
    """Bytes as symbols for shape: lower case, upper case, digit, white space; punctuation as it is."""
    t = np.arange(256, dtype=np.uint8)
    t[97:123] = 97
    t[128:] = 97
    t[65:91] = 65
    t[48:58] = 48
    t[[9, 10, 11, 12, 13]] = 32
    t[0] = 1  # PAD
    return t


LETTERS, SHAPE = symbols_of_letters(), symbols_of_shape()
_letter_runs = np.zeros(256, bool)
_letter_runs[32] = True
_shape_runs = np.zeros(256, bool)
_shape_runs[[32, 48, 65, 97]] = True


def ngrams(data: np.ndarray, off: np.ndarray, kind: str, sizes: tuple[int, ...], dims: int) -> np.ndarray:
    """Counts of hashed n-grams, a row per document. Runs of equal collapsible
    symbols count once; documents are framed by a pad symbol."""
    n_docs = len(off) - 1
    table, runs = (LETTERS, _letter_runs) if kind == "letters" else (SHAPE, _shape_runs)
    s = table[data]
    doc = np.repeat(np.arange(n_docs), np.diff(off))
    if kind == "letters" and len(s):  # upper case of two-byte Latin letters
        s = s.copy()
        s[1:][(data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)] += 0x20
    if len(s):
        same = np.zeros(len(s), bool)
        same[1:] = (s[1:] == s[:-1]) & (doc[1:] == doc[:-1]) & runs[s[1:]]
        s, doc = s[~same], doc[~same]
    framed = np.full(len(s) + n_docs + 1, PAD, np.uint64)
    owner = np.zeros(len(framed), np.int64)
    at = np.arange(len(s)) + doc + 1
    framed[at], owner[at] = s, doc
    counts = np.zeros(n_docs * dims, np.int64)
    for n in sizes:
        if len(framed) < n:
            continue
        m = len(framed) - n + 1
        code = np.full(m, n, np.uint64)
        for j in range(n):
            code = code * np.uint64(0x100000001B3) + framed[j:j + m]
        # the pad may stand first or last in an n-gram only; its document is that of an inner symbol
        ok = np.ones(m, bool)
        for j in range(1, n - 1):
            ok &= framed[j:j + m] != PAD
        if n == 1:
            ok, own = framed != PAD, owner
        elif n == 2:
            ok, own = (framed[:m] != PAD) | (framed[1:] != PAD), np.where(framed[:m] != PAD, owner[:m], owner[1:])
        else:
            own = owner[1:1 + m]
        counts += np.bincount(own[ok] * dims + (mix(code[ok]) % np.uint64(dims)).astype(np.int64), minlength=n_docs * dims)
    return counts.reshape(n_docs, dims).astype(np.float32)


def repetition(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Two rates of each document: words equal to the word before, and word
    pairs that have occurred before in the document."""
    words, first = word_hashes(data, off, NOT_SPACE)
    n_docs = len(off) - 1
    out = np.zeros((n_docs, 2), np.float32)
    doc = np.repeat(np.arange(n_docs), np.diff(first))
    if len(words) < 2:
        return out
    inside = doc[1:] == doc[:-1]
    total = np.maximum(np.bincount(doc[1:][inside], minlength=n_docs), 1)
    out[:, 0] = np.bincount(doc[1:][inside & (words[1:] == words[:-1])], minlength=n_docs) / total
    pair = mix(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])[inside]
    owner = doc[1:][inside]
    order = np.lexsort((pair, owner))
    pair, owner = pair[order], owner[order]
    again = (pair[1:] == pair[:-1]) & (owner[1:] == owner[:-1])
    out[:, 1] = np.bincount(owner[1:][again], minlength=n_docs) / total
    return out


def hellinger(counts: np.ndarray) -> np.ndarray:
    """Square roots of relative frequencies: rows of unit length (or zero)."""
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))


def crc_mod(doc_id: str, m: int) -> Column:
    """crc32 of the id as text, modulo m; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % m


def bounded_sample(rows: DataFrame, by: str, cap: int, order: list[str]) -> DataFrame:
    """At most ``cap`` rows of each value of ``by``, the first by a hash of ``order``.
    A group is first thinned by its hash to about three times ``cap``, so no task sorts a large group."""
    draw = F.pmod(F.xxhash64(*order), F.lit(1 << 20))
    counts = rows.groupBy(by).agg(F.count("*").alias("__n"))
    share = F.least(F.lit(1.0), F.lit(3.0 * cap + 50) / F.col("__n")) * (1 << 20)
    thin = rows.withColumn("__draw", draw).join(counts, by).where(F.col("__draw") < share)
    rank = F.row_number().over(Window.partitionBy(by).orderBy("__draw", *order))
    return thin.withColumn("__rank", rank).where(F.col("__rank") <= cap).drop("__rank", "__draw", "__n")

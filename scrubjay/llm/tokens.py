"""Token counts: an exact histogram of encoded lengths with suffix sums.

Every text is encoded once with a public byte-level BPE. Documents are then aggregated by
encoded length; a row per length is all that later questions need. Sums over the lengths above and up to
a limit give, for every context limit, the documents and tokens that fit, the tokens lost by
truncation and the quantiles.

Sums run over blocks of lengths first, so no task sums the whole histogram row by row.
"""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import broadcast_value, materialise, table, without
from .words import slices

#: Where the vocabulary lies, as ranks of base64 tokens; read on the driver and broadcast.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the byte-level BPE splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK = 1024  # lengths whose sums are taken together

_encodings: dict[int, object] = {}


def encoding(vocabulary: bytes, pattern: str = PATTERN):
    """The encoding, built once in a Python process."""
    key = hash((vocabulary, pattern))
    if key not in _encodings:
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in vocabulary.splitlines() if line)}
        _encodings[key] = tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encodings[key]


def count_tokens(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, output: str = "n_tokens",
                 carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) plus ``n_tokens``. Strings of special tokens are ordinary text; null text has no
    tokens. An input column named ``n_tokens`` is replaced."""
    keep = [c for c in without(docs, [output]) if carry is None or c in carry]
    with open(vocabulary, "rb") as f:
        shared = broadcast_value(docs.sparkSession, f.read())  # a vocabulary: bounded

    def run(batches):
        encode = encoding(shared.value).encode_ordinary
        for batch in batches:
            for a, b in slices(batch.column("__text")):
                part = batch.slice(a, b - a)
                lengths = [len(encode(t)) if t else 0 for t in part.column("__text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(keep))] + [pa.array(lengths, pa.int64())], names=[*keep, output])

    schema = StructType([*docs.select(*keep).schema.fields, StructField(output, LongType())])
    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)


def length_histogram(counted: DataFrame, length: str = "n_tokens") -> DataFrame:
    """One row per encoded length: ``n_tokens`` and ``n_docs``."""
    return counted.groupBy(F.col(length).alias("n_tokens")).agg(F.count("*").alias("n_docs"))


def context_limits(histogram: DataFrame) -> DataFrame:
    """The histogram with sums, each row read as a context limit of ``n_tokens``:
    ``docs_fitting``, ``tokens_fitting`` (documents up to the limit), ``docs_longer``, ``tokens_longer`` (suffix sums),
    ``truncated_total`` (tokens left if every document is cut at the limit), ``tokens_lost``,
    ``fitting_share`` (the share of documents up to the limit: quantiles are read off here)
    and ``total_docs``, ``total_tokens``. A limit between two lengths follows from the next lower row; see
    ``at_limits``. Empty input: no rows."""
    h = histogram.withColumns({"block": F.floor(F.col("n_tokens") / BLOCK), "tokens": F.col("n_tokens") * F.col("n_docs")})
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    later = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)  # a row per block of lengths
    whole = Window.partitionBy()
    blocks = blocks.select("block", *[F.coalesce(F.sum(c).over(later), F.lit(0)).alias(c + "_later") for c in "dt"],
                           F.sum("d").over(whole).alias("total_docs"), F.sum("t").over(whole).alias("total_tokens"))
    inside = Window.partitionBy("block").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    own = lambda c: F.coalesce(F.sum(c).over(inside), F.lit(0))
    out = h.withColumns({"di": own("n_docs"), "ti": own("tokens")}).join(blocks, "block").withColumns({
        "docs_longer": F.col("di") + F.col("d_later"), "tokens_longer": F.col("ti") + F.col("t_later")})
    out = out.withColumns({
        "docs_fitting": F.col("total_docs") - F.col("docs_longer"), "tokens_fitting": F.col("total_tokens") - F.col("tokens_longer"),
        "tokens_lost": F.col("tokens_longer") - F.col("docs_longer") * F.col("n_tokens")})
    return out.select(
        "n_tokens", "n_docs", "docs_fitting", "tokens_fitting", "docs_longer", "tokens_longer",
        (F.col("total_tokens") - F.col("tokens_lost")).alias("truncated_total"), "tokens_lost",
        (F.col("docs_fitting") / F.col("total_docs")).alias("fitting_share"), "total_docs", "total_tokens")


def at_limits(limits_table: DataFrame, limits: list[int]) -> DataFrame:
    """``truncated_total`` and ``docs_fitting`` for any limits, one row each: the documents up to a
    limit are those up to the largest length not above it."""
    parts = []
    for limit in limits:
        below, above = F.col("n_tokens") <= limit, F.col("n_tokens") > limit
        longer = F.coalesce(F.sum(F.when(above, F.col("n_docs"))), F.lit(0))
        parts.append(limits_table.agg(
            F.lit(limit).cast("long").alias("context_limit"), F.coalesce(F.sum(F.when(below, F.col("n_docs"))), F.lit(0)).alias("docs_fitting"),
            (F.coalesce(F.sum(F.when(below, F.col("n_docs") * F.col("n_tokens"))), F.lit(0)) + longer * limit).alias("truncated_total")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def quantiles(limits_table: DataFrame, shares: list[float]) -> DataFrame:
    """For each share the smallest length that at least this share of documents does not exceed."""
    cols = [F.min(F.when(F.col("fitting_share") >= s, F.col("n_tokens"))).alias(f"q{s:g}") for s in shares]
    return limits_table.agg(*cols)


def op8_token_counts(spark, sf_dir: str) -> DataFrame:
    counted = count_tokens(table(spark, sf_dir, "documents").select("text"), carry=[])
    return context_limits(materialise(length_histogram(counted), "token-histogram"))

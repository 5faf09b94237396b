"""Benchmark decontamination with training suffix arrays.

Each run of training documents inside a task is a shard: its words become
benchmark word numbers, and the suffixes that could match are sorted into a suffix array. Every
window of every benchmark item is binary-searched in it, which yields the places
of all verbatim matches; neighbouring places on one diagonal give the longest match.
A document is whole in its shard, so nothing is shuffled. The benchmark is sent to
the tasks in blocks of bounded size, one pass a block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import table, without
from .words import ALNUM, buffers, slices, word_hashes

#: Bytes of benchmark text in one block (the broadcast's bound).
BLOCK_BYTES = 8 << 20
DEPTH = 12  # words of a suffix that are sorted; at least a window
_BITS, _WIDE = 21, (1 << 21) - 1
STATE = StructType([
    StructField("__n_words", LongType()), StructField("__hits", ArrayType(LongType())),
    StructField("__items", ArrayType(StringType())), StructField("__longest", LongType()),
    StructField("__longest_at", LongType()), StructField("__longest_item", StringType())])
OUTPUTS = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest", "longest_at", "longest_item"]


def _keys(ids: np.ndarray, at: np.ndarray, length: np.ndarray, fill: int = 0) -> np.ndarray:
    """The first DEPTH word numbers from each place as one sortable byte string; what lies
    beyond ``length`` becomes ``fill``."""
    step = np.arange(DEPTH)
    m = ids[np.minimum(at[:, None] + step, max(len(ids) - 1, 0))]
    m = np.where(step < length[:, None], m, fill).astype(np.uint64)
    per = 63 // _BITS
    packed = np.zeros((len(at), DEPTH // per), np.uint64)
    for j in range(per):
        packed = (packed << np.uint64(_BITS)) | m[:, j::per]
    return np.ascontiguousarray(packed.astype(">u8")).view(f"S{8 * (DEPTH // per)}").ravel()


class Windows:
    """The windows of a benchmark block, ready for binary search."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        if width > DEPTH:
            raise ValueError(f"windows of more than {DEPTH} words are not supported")
        data, off = buffers(pa.array([t for _, t in items], pa.large_string()))
        words, first = word_hashes(data, off, ALNUM)
        self.vocabulary = np.unique(words)
        if len(self.vocabulary) >= _WIDE:
            raise ValueError("a benchmark block has too many distinct words; lower BLOCK_BYTES")
        ids = np.searchsorted(self.vocabulary, words) + 1
        at, length, item = [], [], []
        for i in range(len(items)):
            n = int(first[i + 1] - first[i])
            starts = range(n - width + 1) if n >= width else range(min(n, 1))
            at += [int(first[i]) + s for s in starts]
            length += [min(n, width)] * len(starts)
            item += [i] * len(starts)
        at, length, item = (np.array(x, np.int64) for x in (at, length, item))
        self.names = [name for name, _ in items]
        self.least = int(length.min()) if len(length) else 0
        low, high = _keys(ids, at, length), _keys(ids, at, length, _WIDE)
        # windows with the same words are searched once; their places in items stay listed
        _, one, group = np.unique(np.char.add(low, high) if len(low) else low, return_index=True, return_inverse=True)
        self.low, self.high, self.length = low[one], high[one], length[one]
        order = np.argsort(group, kind="stable")
        self.item, self.place = item[order], (at - first[item])[order] if len(at) else at
        self.begin = np.searchsorted(group[order], np.arange(len(one) + 1))

    def search(self, words: np.ndarray, first: np.ndarray):
        """Matches in a shard: word place, item number, place in the item, window length."""
        none = (np.zeros(0, np.int64),) * 4
        if not self.least or not len(words):
            return none
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        ids = np.where(self.vocabulary[at] == words, at + 1, 0)
        # words up to the next unknown word or the document's end
        n = len(ids)
        unknown = np.where(ids == 0, np.arange(n), n)
        run = np.minimum.accumulate(unknown[::-1])[::-1]
        run = np.minimum(run, np.repeat(first[1:], np.diff(first))) - np.arange(n)
        places = np.flatnonzero(run >= self.least)
        if not len(places):
            return none
        suffix = _keys(ids, places, run[places])
        order = np.argsort(suffix, kind="stable")
        array = suffix[order]
        lo, hi = np.searchsorted(array, self.low, "left"), np.searchsorted(array, self.high, "right")
        found = np.flatnonzero(hi > lo)
        if not len(found):
            return none
        count = (hi - lo)[found]
        window = np.repeat(found, count)
        where = places[order[np.repeat(lo[found] - np.cumsum(count) + count, count) + np.arange(count.sum())]]
        listed = (self.begin[1:] - self.begin[:-1])[window]
        start = np.repeat(self.begin[window] - np.cumsum(listed) + listed, listed) + np.arange(listed.sum())
        return np.repeat(where, listed), self.item[start], self.place[start], np.repeat(self.length[window], listed)


def _merged(spans: list[int], more: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for a, b in sorted([*zip(spans[::2], spans[1::2]), *more]):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _scan_rows(text: pa.Array, state: dict[str, list] | None, windows: Windows) -> dict[str, list]:
    n_docs = len(text)
    out = state or {"__n_words": [0] * n_docs, "__hits": [[] for _ in range(n_docs)], "__items": [[] for _ in range(n_docs)],
                    "__longest": [0] * n_docs, "__longest_at": [None] * n_docs, "__longest_item": [None] * n_docs}
    data, off = buffers(text)
    words, first = word_hashes(data, off, ALNUM)
    out["__n_words"] = np.diff(first).tolist()
    where, item, place, length = windows.search(words, first)
    if not len(where):
        return out
    doc = np.searchsorted(first, where, side="right") - 1
    # runs of places on one diagonal of a document and an item are one verbatim match
    order = np.lexsort((where, where - place, item, doc))
    doc, item, where, place, length = (x[order] for x in (doc, item, where, place, length))
    new = np.ones(len(where), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (where[1:] != where[:-1] + 1) | (place[1:] != place[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(where)) - 1
    begin, end = where[head] - first[doc[head]], where[tail] + length[tail] - first[doc[head]]
    spans: dict[int, list] = {}
    for d, i, a, b in zip(doc[head].tolist(), item[head].tolist(), begin.tolist(), end.tolist()):
        spans.setdefault(d, []).append((a, b, windows.names[i]))
    for d, found in spans.items():
        out["__hits"][d] = _merged(out["__hits"][d], [(a, b) for a, b, _ in found])
        out["__items"][d] = sorted({*out["__items"][d], *(i for _, _, i in found)})
        a, b, i = min(found, key=lambda f: (f[0] - f[1], f[0], f[2]))
        if b - a > out["__longest"][d]:
            out["__longest"][d], out["__longest_at"][d], out["__longest_item"][d] = b - a, a, i
    return out


def _scanner(text: str, shared):
    def run(batches):
        windows = shared.value
        for batch in batches:
            names = batch.schema.names
            for a, b in slices(batch.column(text)):
                part = batch.slice(a, b - a)
                state = ({f.name: part.column(f.name).to_pylist() for f in STATE} if "__hits" in names else None)
                new = _scan_rows(part.column(text), state, windows)
                kept = [n for n in names if not n.startswith("__")]
                types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in kept] + [pa.array(new[f.name], t) for f, t in zip(STATE, types)],
                    names=kept + [f.name for f in STATE])
    return run


def find_overlaps(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", width: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` plus ``n_words``, ``n_hit`` (words inside a matched window), ``n_items``,
    ``items_sha256``, ``contaminated``, and the ``longest`` match in words with its place and item.

    A window is ``width`` consecutive words of an item; a shorter item is one
    window; an item without words matches nothing. Null text has no words, null item
    text none, a null item id is listed as an empty string. Equal item ids count as one item.
    Repeated rows are each scanned. Empty tables: no rows, or no hits. Input columns
    named like an output are replaced."""
    spark = docs.sparkSession
    keep = without(docs, [*OUTPUTS, *(f.name for f in STATE)])
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"),
                             F.coalesce(F.col(item_text), F.lit("")).alias("t"))
    total = items.agg(F.sum(F.octet_length("t") + F.octet_length("i") + 64)).first()[0] or 0
    blocks = -(-int(total) // block_bytes) or 1
    schema = StructType([*docs.select(*keep).schema.fields, *STATE.fields])
    out = docs.select(*keep)
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).collect() if blocks > 1 else items.collect()
        shared = spark.sparkContext.broadcast(Windows([(r["i"], r["t"]) for r in rows], width))
        out = out.mapInArrow(_scanner(text, shared), schema)
    hit = F.aggregate("__hits", F.lit(0).cast("long"), lambda s, x: x - s)  # ends minus starts
    return out.select(
        *keep, F.col("__n_words").alias("n_words"), hit.alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("__items"), ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"), F.col("__longest").alias("longest"),
        F.col("__longest_at").alias("longest_at"), F.col("__longest_item").alias("longest_item"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any hit, with their own columns."""
    own = without(docs, OUTPUTS)
    return find_overlaps(docs, benchmark, **options).where("not contaminated").select(*own)


def op7_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_overlaps(docs, table(spark, sf_dir, "benchmark")).drop("text")

"""Similar pairs in groups of related sets, found by their differences to the group's pivot.

Members of a family of copies resemble each other, so filters on whole sets pass most of their
pairs. With DA and DB the symmetric differences of A and B to one pivot,
|A ^ B| = |DA| + |DB| - 2 |DA & DB|: a pair is similar exactly if it shares at least
t = (|DA| + |DB| - d) / 2 of what sets it apart from the pivot, where d = (1-p) / (1+p) * (|A| + |B|). That holds for any
pivot; it is selective because edits differ from copy to copy. A join on the first |D| - t + 1 elements of each difference
finds every such pair if all differences of a group are in one order; rare elements come first.

A pivot that few members resemble makes all of them post what they share. ``central_members`` names the member of a group
that is nearest to what most of its members hold, as a better pivot.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import materialise
from .words import mix

#: Members of a group, about, that frequencies are estimated on. They only set the order of elements: results do not depend on them.
SAMPLE = 4096
#: The same for the elements that most members of a group hold, which only choose its pivot.
CENTRE = 256
#: An element is common in a group from one in so many of its members on.
RARE = 64
WORDS = 4  # 64-bit words of a difference's bitmap


def _difference(row_set, pivot_set) -> np.ndarray:
    a, b = (np.frombuffer(s.as_buffer(), np.uint64) for s in (row_set, pivot_set))
    return np.setxor1d(a, b, assume_unique=True)


def _changed(batches):
    """How many of a batch's sets differ from their pivot in an element."""
    for batch in batches:
        groups: dict[int, list[np.ndarray]] = {}
        for pivot, a, b in zip(batch.column("pivot").to_pylist(), batch.column("shingles"), batch.column("pshingles")):
            groups.setdefault(pivot, []).append(_difference(a, b))
        pivots, els, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for pivot, found in groups.items():
            el, c = np.unique(np.concatenate(found), return_counts=True)
            pivots.append(np.full(len(el), pivot, np.int64))
            els.append(el)
            counts.append(c)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(pivots)), pa.array(np.concatenate(els).view(np.int64)), pa.array(np.concatenate(counts))],
            names=["pivot", "el", "c"])


def _distances(percent: int):
    """(100 + percent) |D| - (100 - percent) |A| with D the difference to the group's centre: two sets whose sum is at most 0 are similar."""
    def run(batches):
        for batch in batches:
            far = []
            for a, b, moved in zip(batch.column("shingles"), batch.column("pshingles"), batch.column("moved")):
                d = _difference(a, b)
                if moved.is_valid:
                    d = np.setxor1d(d, moved.values.to_numpy().view(np.uint64), assume_unique=True)
                far.append((100 + percent) * len(d) - (100 - percent) * (len(a.as_buffer()) // 8))
            yield pa.RecordBatch.from_arrays([batch.column("pivot"), batch.column("node"), pa.array(far, pa.int64())],
                                             names=["pivot", "node", "far"])
    return run


def _added(batches):
    """Elements of each set that its pivot lacks."""
    for batch in batches:
        els, pivots = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for pivot, a, b in zip(batch.column("pivot").to_pylist(), batch.column("shingles"), batch.column("pshingles")):
            x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            els.append(np.setdiff1d(x, y, assume_unique=True))
            pivots.append(np.full(len(els[-1]), pivot, np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(pivots)), pa.array(np.concatenate(els).view(np.int64))],
                                         names=["pivot", "el"])


def _ordered(d: np.ndarray, pivot: np.ndarray, common: np.ndarray) -> np.ndarray:
    """A difference in the order of its group: rare elements, common ones by frequency, elements of the pivot;
    each by value. ``common`` rises in frequency."""
    rank = np.zeros(len(d), np.int64)
    if len(common):
        by = np.argsort(common)
        at = np.minimum(np.searchsorted(common[by], d), len(common) - 1)
        rank = np.where(common[by][at] == d, by[at] + 1, 0)
    at = np.minimum(np.searchsorted(pivot, d), len(pivot) - 1)
    rank[pivot[at] == d] = len(common) + 1
    return d[np.lexsort((d, rank))]


def _bitmap(d: np.ndarray) -> np.ndarray:
    at = mix(d) % np.uint64(64 * WORDS)
    out = np.zeros(WORDS, np.uint64)
    np.bitwise_or.at(out, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return out


def _reach(s: int, n: int, pivot_n: int, outside: bool, p: float) -> int:
    """How many elements of its difference a member has to post: as many as its partner with the
    smallest difference can ask for. A member that is not outside meets outside members only, which
    are not similar to the pivot."""
    c = (1 - p) / (1 + p)
    d = c * (n + n / p)
    least = max(0.0, s - d)
    if not outside:
        least = max(least, c * (p * n + pivot_n) - 1e-6)
    t = max(1, int(np.ceil((s + least - d) / 2 - 1e-6)))
    return max(0, s - t + 1)


def _posted(p: float):
    def run(batches):
        names = ["node", "comp", "n"]
        for batch in batches:
            rows, keys, at, sizes, bits = [], [], [], [], []
            outside, n, pivots = (batch.column(c).to_pylist() for c in ("outside", "n", "pivot"))
            for i, (a, b, common) in enumerate(zip(batch.column("shingles"), batch.column("pshingles"), batch.column("common"))):
                pivot = np.frombuffer(b.as_buffer(), np.uint64)
                d = _difference(a, b)
                reach = _reach(len(d), n[i], len(pivot), outside[i], p)
                if not reach:
                    continue
                common = common.values.to_numpy().view(np.uint64) if common.is_valid else d[:0]
                head = _ordered(d, pivot, common)[:reach]
                keys.append(mix(head + mix(np.array([pivots[i]], np.int64).view(np.uint64))))
                rows.append(np.full(len(head), i))
                at.append(np.arange(len(head)))
                sizes.append(np.full(len(head), len(d)))
                bits.append(np.broadcast_to(_bitmap(d), (len(head), WORDS)))
            if not rows:
                continue
            take = pa.array(np.concatenate(rows))
            bits = np.concatenate(bits).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(at)), pa.array(np.concatenate(sizes))]
                + [batch.column(c).take(take) for c in names] + [batch.column("outside").take(take)]
                + [pa.array(np.ascontiguousarray(bits[:, w])) for w in range(WORDS)],
                names=["key", "pos", "s", *names, "outside", *[f"b{w}" for w in range(WORDS)]])
    return run


def _with_sets(members: DataFrame, sets: DataFrame) -> DataFrame:
    return (members.join(sets, "node")
            .join(sets.select(F.col("node").alias("pivot"), F.col("shingles").alias("pshingles")), "pivot"))


def _drawn(sample: int):
    return F.pmod(F.xxhash64(F.lit(5), "node"), F.lit(1 << 20)) * F.col("size") < F.lit(sample << 20)


def central_members(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``members(pivot, node, size)`` and ``sets`` as below -> ``(pivot, centre)``: the member nearest to the set of elements that
    most members hold, as a sample of the group tells."""
    rows = _with_sets(members.select("pivot", "node", "size"), sets)
    drawn = members.where(_drawn(CENTRE)).groupBy("pivot").agg(F.count("*").alias("seen"))
    moved = (rows.where(_drawn(CENTRE)).select("pivot", "shingles", "pshingles").mapInArrow(_changed, "pivot long, el long, c long")
             .groupBy("pivot", "el").agg(F.sum("c").alias("c")).join(drawn, "pivot").where("2 * c > seen")
             .groupBy("pivot").agg(F.collect_list("el").alias("moved")))
    far = rows.join(moved, "pivot", "left").mapInArrow(_distances(percent), "pivot long, node long, far long")
    return far.groupBy("pivot").agg(F.min(F.struct("far", "node"))["node"].alias("centre"))


def similar_in_groups(members: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """``members(pivot, node, n, comp, outside, size)``: sets of a group, their sizes and components, whether the component is
    not the pivot's, and the group's size. ``sets(node, shingles)``: sorted hashes, pivots included. Returns ``(a, b)``,
    possibly repeated: every pair of a group with different components and a similarity of at least
    ``percent``, and some of less; and a written table that it is computed from. A pivot and the members of
    its component are not paired with each other; members outside must have been found not similar to it."""
    p = percent / 100
    c = (1 - p) / (1 + p)
    rows = _with_sets(members, sets)
    seen = F.least("size", F.lit(SAMPLE))
    common = (rows.where(_drawn(SAMPLE)).select("pivot", "shingles", "pshingles").mapInArrow(_added, "pivot long, el long")
              .groupBy("pivot", "el").count().join(members.select("pivot", seen.alias("seen")).distinct(), "pivot")
              .where(F.col("count") >= F.greatest(F.lit(2), F.col("seen") / RARE))
              .groupBy("pivot").agg(F.sort_array(F.collect_list(F.struct("count", "el")))["el"].alias("common")))
    posted = rows.join(common, "pivot", "left").mapInArrow(
        _posted(p), "key long, pos long, s long, node long, comp long, n long, outside boolean, "
        + ", ".join(f"b{w} long" for w in range(WORDS)))
    posted = materialise(posted, "minhash-differences")
    side = lambda x: [F.col(k).alias(x + k) for k in posted.columns if k != "key"]
    over = lambda x, y: sum((F.bit_count(F.col(f"{x}b{w}").bitwiseAND(F.bitwise_not(f"{y}b{w}"))) for w in range(WORDS)), F.lit(0))
    t = (F.col("as") + F.col("bs") - c * (F.col("an") + F.col("bn"))) / 2 - 1e-6
    pairs = posted.where("outside").select("key", *side("a")).join(posted.select("key", *side("b")), "key").where(
        F.expr("acomp <> bcomp AND (NOT boutside OR anode < bnode)")
        & (100 * F.least("an", "bn") >= percent * F.greatest("an", "bn"))
        & (F.col("as") - F.col("apos") >= t) & (F.col("bs") - F.col("bpos") >= t)
        & (F.col("as") - over("a", "b") >= t) & (F.col("bs") - over("b", "a") >= t))
    return pairs.select(F.col("anode").alias("a"), F.col("bnode").alias("b")), posted

"""Sharding by minimax contiguous partition.

Groups of equal texts are atomic and stand in the order of a digest of their
text. The smallest feasible shard capacity is found by binary search, each
candidate checked by filling shards greedily; the order is then cut there.

The driver never holds the groups. It keeps a bounded list of *pieces*,
contiguous runs of the order with their total size, and brackets the
capacity: from above by treating pieces as atomic, from below by letting cuts
fall anywhere inside a piece. Only pieces that a cut can touch are split
further, by one grouped scan a round, until both bounds meet.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from .common import hex_prefix, materialise, number_rows, without

KEY_BITS = 60
FIRST_BITS = 12
#: Bound on the pieces fetched to the driver in one round.
MAX_PIECES = 65_536


def order_key(text: Column) -> Column:
    """60 bits of SHA-256: equal texts share it. Different texts that collide
    become one atomic group, which is harmless. All nulls form one group."""
    return F.coalesce(hex_prefix(F.sha2(text, 256), 15), F.lit(0))


class _Pieces:
    """Pieces in order, as (first key, shift, size, groups, largest group)."""

    def __init__(self, rows: list[tuple[int, int, int, int, int]]):
        self.rows = sorted(rows)
        self.ends = list(accumulate(r[2] for r in self.rows))
        self.total = self.ends[-1] if self.ends else 0
        self.largest = max((r[4] for r in self.rows), default=0)

    def fill(self, capacity: int, shards: int, divisible: bool) -> list[int]:
        """Ends of greedily filled shards. With ``divisible`` a cut may fall
        anywhere inside a piece of several groups."""
        at, ends = 0, []
        for _ in range(shards):
            i = bisect_right(self.ends, at + capacity)
            stop = self.ends[i - 1] if i else 0
            if divisible and i < len(self.ends) and self.rows[i][3] > 1:
                stop = at + capacity
            at = max(at, min(stop, self.total))
            ends.append(at)
        return ends

    def smallest(self, shards: int, divisible: bool) -> int:
        lo, hi = max(self.largest, -(-self.total // shards)), max(self.total, self.largest)
        while lo < hi:
            mid = (lo + hi) // 2
            if self.fill(mid, shards, divisible)[-1] >= self.total:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def latest_needed(self, capacity: int, shards: int) -> list[int]:
        """For each cut, the smallest end from which the rest still fits."""
        need, at = [], self.total
        for _ in range(shards):
            need.append(at)
            i = bisect_left(self.ends, at - capacity)
            at = self.ends[i] if at > capacity else 0
        return need[::-1]

    def level(self, capacity: int, shards: int) -> tuple[list[int], list[int]]:
        """Cuts of at most ``capacity`` per shard, each as near to an even share
        of what is left as a boundary allows; and the even positions."""
        need, cuts, ideals, at = self.latest_needed(capacity, shards), [], [], 0
        for j in range(shards - 1):
            ideal = at + (self.total - at) / (shards - j)
            i = bisect_left(self.ends, ideal)
            near = [self.ends[k] if k >= 0 else 0 for k in (i - 1, i) if k < len(self.ends)]
            near = [e for e in near if max(at, need[j]) <= e <= at + capacity]
            stop = min(near, key=lambda e: abs(e - ideal)) if near else max(need[j], at)
            ideals.append(int(ideal))
            cuts.append(stop)
            at = stop
        return cuts, ideals

    def touched(self, windows: list[tuple[int, int]]) -> list[tuple]:
        """Pieces of several groups that overlap a window of positions."""
        out = set()
        for a, b in windows:
            i, j = bisect_right(self.ends, a), bisect_left(self.ends, b)
            out.update(r for r in self.rows[i:j + 1] if r[3] > 1)
        return sorted(out)

    def key_at(self, end: int) -> int:
        """First key of the shard that begins at this boundary."""
        i = bisect_right(self.ends, end)
        return self.rows[i][0] if i < len(self.rows) else 1 << KEY_BITS


def _summary(groups: DataFrame, shift: int) -> list[tuple[int, int, int, int, int]]:
    piece = F.shiftright("k", shift)
    rows = groups.groupBy(piece.alias("p")).agg(F.sum("size"), F.count("*"), F.max("size")).collect()
    return [(r[0] << shift, shift, r[1], r[2], r[3]) for r in rows]


def _split(groups: DataFrame, pieces: list[tuple]) -> list[tuple]:
    """The given pieces at a finer step; one scan for each step size."""
    spark, out, by_shift = groups.sparkSession, [], defaultdict(list)
    for r in pieces:
        by_shift[r[1]].append(r[0] >> r[1])
    for shift, ids in by_shift.items():
        bits = max(1, (MAX_PIECES // len(ids)).bit_length() - 1)
        chosen = spark.createDataFrame([(i,) for i in ids], "p long")  # at most MAX_PIECES ids
        part = groups.withColumn("p", F.shiftright("k", shift)).join(F.broadcast(chosen), "p", "left_semi")
        out += _summary(part, max(0, shift - bits))
    return out


def contiguous_cuts(groups: DataFrame, shards: int) -> tuple[list[int], int]:
    """``groups(k, size)``, one row per atomic group -> the first keys of shards
    1.. and the smallest feasible capacity. Empty input: no cuts, 0."""
    known = _Pieces(_summary(groups, KEY_BITS - FIRST_BITS))
    while True:
        lo, hi = known.smallest(shards, True), known.smallest(shards, False)
        if lo < hi:
            first, last = known.fill(lo, shards, False), known.fill(hi, shards, True)
            todo = known.touched(list(zip(first, last)))
        else:
            _, ideals = known.level(hi, shards)
            todo = known.touched([(max(0, x - 1), x + 1) for x in ideals])
        if not todo:
            break
        gone = set(todo)
        known = _Pieces([r for r in known.rows if r not in gone] + _split(groups, todo))
    cuts, _ = known.level(hi, shards)
    return [known.key_at(c) for c in cuts], hi


def _shard_of(key: Column, cuts: list[int]) -> Column:
    if len(cuts) <= 64:
        return sum((F.when(key >= F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0)).cast("int")
    bounds = F.array(*[F.lit(c) for c in cuts])
    return F.size(F.filter(bounds, lambda c: c <= key)).cast("int")


def shard_documents(docs: DataFrame, text: str = "text", shards: int = 24, overhead: int = 8,
                    rows_per_part: int = 500_000, carry: list[str] | None = None) -> DataFrame:
    """``docs`` plus ``size`` (UTF-8 bytes and ``overhead``), ``shard`` and ``slot``
    (gapless within the shard). Rows of equal text share a shard.

    Null text: size ``overhead``; all nulls share a shard. Empty table: no rows.
    Repeated rows each get a slot. A group larger than an even share gets a
    shard of its own size; some shards may then stay empty. Input columns named like an output are
    replaced. ``carry`` names the columns to keep (default all)."""
    keep = [c for c in without(docs, ["size", "shard", "slot"]) if carry is None or c in carry]
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(overhead).cast("long")
    sized = docs.select(*keep, size.alias("size"), order_key(F.col(text)).alias("__key"))
    if carry is not None:  # a narrow digest: written once, so that texts are read once
        sized = materialise(sized, "shard-digest")
    groups = materialise(sized.groupBy(F.col("__key").alias("k")).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
                         .repartition(F.shiftright("k", KEY_BITS - FIRST_BITS)).sortWithinPartitions("k"),
                         "shard-groups")
    cuts, _ = contiguous_cuts(groups, shards)
    rows = groups.agg(F.sum("n")).first()[0] or 0
    placed = sized.withColumn("shard", _shard_of(F.col("__key"), cuts))
    order = (["doc_id"] if "doc_id" in keep else []) + ["__key"]
    return number_rows(placed, ["shard"], order, "slot", salts=16 + rows // rows_per_part).drop("__key")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder ``shard=N`` per shard."""
    sharded.write.partitionBy("shard").parquet(path)


def op5_sharding(spark, sf_dir: str) -> DataFrame:
    from .common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("text_crc32", F.crc32(F.encode("text", "UTF-8")).cast("long"))
    out = shard_documents(docs, carry=["doc_id", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))

"""MinHash near-dedup by an inverted join of signature coordinates.

Documents with the same shingle set form one class. Every class is posted
under its coordinate-value pairs. A pair similar enough agrees in at least ``t`` of the
``K`` coordinates (but for a chance of at most ``MISS``), so its d-th smallest agreeing
coordinate is at most K - t + d - 1: posting under the first K - t + 1 coordinates
(the prefix), apart for each band of sizes, finds it, and a list that is too long is posted again under a second,
third, ... agreeing coordinate, each within that bound.

Lists are never expanded into all pairs. First each member is compared with its list's
pivots, which joins families of copies; then only members outside the first pivot's component are
compared with the rest. In a list with many of them, members related to the same pivot are compared by
their differences to it (``differences``), others by their signatures, and very long lists are split by a further coordinate.
Candidates must fit in size and agree in t coordinates, counted on four bits of each, and then
in enough ranges of a finer sketch; what remains is confirmed on the full shingle sets.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import broadcast_if_small, connected_components, discard, materialise, table
from .differences import central_members, similar_in_groups
from .words import NOT_SPACE, buffers, mix, slices, word_hashes

K = 32
MISS = 1e-8
#: Members outside a pivot's component that are compared with a whole list; in longer lists differences to pivots are.
FEW = 16
#: Lists with more of them are split by further coordinates, at most DEPTH in all; after the last, all pairs go by differences.
SPLIT = 8192
DEPTH = 2
#: Coordinates, counted on four bits, in which a member related to a pivot agrees with it.
RELATED = 8
#: Pivots of a list that all its members are compared with.
PIVOTS = 3
BINS = 512
_rng = np.random.default_rng(64087)
_XOR = _rng.integers(0, 1 << 63, K, dtype=np.uint64)
_MUL = _rng.integers(0, 1 << 63, K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def least_matches(similarity: float, coordinates: int = K, miss: float = MISS) -> int:
    """The largest t such that a pair of this similarity agrees in fewer than t
    coordinates with a chance of at most ``miss``."""
    below, t = 0.0, 0
    while True:
        below += math.comb(coordinates, t) * similarity ** t * (1 - similarity) ** (coordinates - t)
        if below > miss:
            return max(1, t)
        t += 1


def _shingle_sets(text: pa.Array, width: int):
    """Sorted distinct shingle hashes of each document."""
    data, off = buffers(text)
    words, first = word_hashes(data, off, NOT_SPACE)
    n = len(words)
    if n >= width:
        h = words[:n - width + 1].copy()
        for j in range(1, width):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[j:n - width + 1 + j])
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            yield np.unique(h[a:b - width + 1])
        elif b > a:  # the whole sequence as one shingle
            yield np.frombuffer(hashlib.blake2b(words[a:b].tobytes(), digest_size=8).digest(), np.uint64)
        else:
            yield words[:0]


def _class_id(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def _signature(s: np.ndarray) -> np.ndarray:
    low = np.full(K, 0xFFFFFFFF, np.uint64)
    for at in range(0, len(s), 1 << 15):
        part = ((s[at:at + (1 << 15), None] ^ _XOR) * _MUL) >> np.uint64(32)
        np.minimum(low, part.min(axis=0), out=low)
    return low.astype(np.uint32).view(np.int32)


def _digest(sign: np.ndarray) -> np.ndarray:
    """Four bits of every coordinate, sixteen to a long. Equal coordinates have equal bits."""
    bits = (sign.view(np.uint32) & 15).astype(np.uint64).reshape(2, 16)
    return (bits << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(axis=1, dtype=np.uint64).view(np.int64)


def _sketch(s: np.ndarray) -> bytes:
    """One byte for each of ``BINS`` equal ranges of hash values: a digest of the smallest
    shingle in the range, 0 for an empty range. ``s`` is sorted."""
    out = np.zeros(BINS, np.uint8)
    at = (s >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    out[at[first]] = mix(s[first]) % np.uint64(255) + np.uint64(1)
    return out.tobytes()


def _sign(width: int, text: str):
    def run(batches):
        for batch in batches:
            others = [n for n in batch.schema.names if n != text]
            for a, b in slices(batch.column(text)):
                part = batch.slice(a, b - a)
                sets = list(_shingle_sets(part.column(text), width))
                full = np.array([len(s) > 0 for s in sets])
                signs = [_signature(s) for s in sets if len(s)]
                flat = np.concatenate(signs) if signs else np.zeros(0, np.int32)
                offsets = np.concatenate([[0], np.cumsum(full * K)]).astype(np.int32)
                bits = np.zeros((len(sets), 2), np.int64)
                if signs:
                    bits[full] = [_digest(x) for x in signs]
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in others]
                    + [pa.array([len(s) for s in sets], pa.int64()),
                       pa.array([_class_id(s) if len(s) else None for s in sets], pa.int64()),
                       pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(bits[:, 0]), pa.array(bits[:, 1]),
                       pa.array([_sketch(s) for s in sets], pa.binary())],
                    names=others + ["n_shingles", "node", "sig", "x", "y", "sketch"])
    return run


def _sets(width: int, text: str):
    def run(batches):
        for batch in batches:
            for a, b in slices(batch.column(text)):
                sets = list(_shingle_sets(batch.column(text).slice(a, b - a), width))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_class_id(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["node", "shingles"])
    return run


def _plausible(percent: int):
    """Pairs whose sketches allow a similarity of ``percent``. The smallest shingles of the ranges that are
    not empty in both are a sample, without replacement, of the union; that share of them should be common, less six
    standard deviations."""
    def run(batches):
        p = percent / 100
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS) for c in ("sa", "sb"))
            used = ((a > 0) | (b > 0)).sum(axis=1)
            same = ((a == b) & (a > 0)).sum(axis=1)
            union = (batch.column("na").to_numpy() + batch.column("nb").to_numpy()) / (1 + p)
            left = np.maximum(1 - used / np.maximum(union, 1), 0.02)
            yield batch.select(["a", "b"]).filter(pa.array(same >= p * used - 6 * np.sqrt(p * (1 - p) * used * left) - 1))
    return run


def _confirm(percent: int):
    def run(batches):
        for batch in batches:
            yes = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                yes.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(yes, pa.bool_()))
    return run


def _differ(ax, ay, bx, by) -> Column:
    """In how many coordinates the four bits differ."""
    def count(a, b):
        d = a.bitwiseXOR(b)
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        return F.bit_count(d.bitwiseOR(F.shiftrightunsigned(d, 2)).bitwiseAND(F.lit(0x1111111111111111)))
    return count(ax, bx) + count(ay, by)


def _fits(a: str, b: str, percent: int, t: int) -> Column:
    """Sizes leave a similarity of ``percent`` possible, and at least ``t`` coordinates agree
    in their four bits, as they do if the coordinates agree."""
    x = F.col
    sizes = 100 * F.least(x(a + "n"), x(b + "n")) >= percent * F.greatest(x(a + "n"), x(b + "n"))
    return sizes & (_differ(x(a + "x"), x(a + "y"), x(b + "x"), x(b + "y")) <= K - t)


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


class _Links:
    """Confirmed links so far, and the pairs already compared."""

    def __init__(self, docs: DataFrame, classes: DataFrame, text: str, width: int, percent: int):
        self.docs, self.classes, self.text, self.width, self.percent = docs, classes, text, width, percent
        self.links: DataFrame | None = None
        self.seen: DataFrame | None = None

    def sets_of(self, active: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Full sets of the distinct nodes ``active``, and a table to discard with them."""
        heads = active.join(self.classes.select("node", F.col("head").alias("__head")), "node").select("__head")
        heads = materialise(heads, "minhash-heads")
        texts = self.docs.join(broadcast_if_small(heads),  # then texts are not shuffled
                               F.col("__id").eqNullSafe(F.col("__head")), "left_semi").select(self.text)
        sets = (texts.mapInArrow(_sets(self.width, self.text), "node long, shingles binary")
                .dropDuplicates(["node"]).join(active, "node", "left_semi"))
        return materialise(sets, "minhash-sets"), heads

    def add(self, candidates: DataFrame) -> bool:
        """``candidates(a, b)``: distinct pairs that pass signatures and sizes. Whether links were found."""
        if self.seen is not None:
            candidates = candidates.join(self.seen, ["a", "b"], "left_anti")
        sketch = lambda p: self.classes.select(F.col("node").alias(p), F.col("sketch").alias("s" + p), F.col("n").alias("n" + p))
        near = (candidates.join(sketch("b"), "b").join(sketch("a"), "a")  # candidates may lie by b already
                .select("a", "b", "sa", "sb", "na", "nb").mapInArrow(_plausible(self.percent), "a long, b long"))
        pairs = materialise(near, "minhash-pairs")
        self.seen = pairs if self.seen is None else self.seen.union(pairs)
        if pairs.isEmpty():
            return False
        sets, spent = self.sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        joined = (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
                  .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
                  .select("a", "b", "sa", "sb"))
        new = materialise(joined.mapInArrow(_confirm(self.percent), "a long, b long"), "minhash-links")
        discard(sets, spent)
        if new.isEmpty():
            return False
        self.links = new if self.links is None else self.links.union(new)
        return True

    def components(self) -> DataFrame | None:
        return None if self.links is None else materialise(connected_components(self.links), "minhash-components")


def _cross(lists: DataFrame, percent: int, t: int, *by: str) -> DataFrame:
    """Pairs of different components that meet outside their list's pivot's component. ``by`` names a column of values that
    a row does not meet itself, -1 apart."""
    side = lambda p: [F.col(c).alias(p + c) for c in ("node", "comp", "n", "x", "y", "outside")]
    a, b, on = lists.where("outside").select("list", *by, *side("a")), lists.select("list", *by, *side("b")), ["list", *by]
    for c in by:
        others = F.filter(F.array(*[F.lit(r) for r in range(-1, PIVOTS)]), lambda r: (r == -1) | (r != F.col(c)))
        a = a.withColumn(c, F.explode(others))
    cross = a.join(b, on).where("acomp <> bcomp AND (NOT boutside OR anode < bnode)").where(_fits("a", "b", percent, t))
    return cross.select(F.col("anode").alias("a"), F.col("bnode").alias("b"))


def _anchored(lists: DataFrame, listed: DataFrame, classes: DataFrame, split: int | None) -> DataFrame:
    """``lists`` with the number (-1 for none) and node of the first of its list's pivots that a row is related to. In lists
    with more than ``split`` others the first pivot is everyone's."""
    pivots = (listed.join(lists.select("list").distinct(), "list", "left_semi").groupBy("list").agg(F.first("pivots").alias("pivots"))
              .select("list", F.posexplode("pivots").alias("r", "node"))
              .join(classes.select("node", "x", "y"), "node")
              .groupBy("list").agg(F.sort_array(F.collect_list(F.struct("r", "node", "x", "y"))).alias("pivots")))
    rows = lists.join(pivots, "list")
    related = F.filter("pivots", lambda p: _differ(p["x"], p["y"], F.col("x"), F.col("y")) <= K - RELATED)
    if split is not None:
        related = F.when(F.col("others") > split, F.col("pivots")).otherwise(related)
    rows = rows.withColumn("pivot", F.get(related, F.lit(0))).drop("pivots")
    return rows.withColumns({"r": F.coalesce("pivot.r", F.lit(-1)), "pivot": F.col("pivot.node")})


def _families(members: DataFrame, comp: DataFrame | None) -> DataFrame:
    """``members(pivot, node, n)`` with components, of groups that some component but the pivot's is in."""
    if comp is not None:
        members = (members.join(comp, "node", "left")
                   .join(comp.select(F.col("node").alias("pivot"), F.col("comp").alias("pc")), "pivot", "left"))
    else:
        members = members.withColumns({"comp": F.lit(None).cast("long"), "pc": F.lit(None).cast("long")})
    own = F.coalesce("comp", "node")
    members = materialise(members.select("pivot", "node", "n", own.alias("comp"), (own != F.coalesce("pc", "pivot")).alias("outside")), "minhash-family")
    groups = members.groupBy("pivot").agg(F.count("*").alias("size"), F.max("outside").alias("any")).where("any")
    found = materialise(members.join(groups.drop("any"), "pivot"), "minhash-members")
    discard(members)
    return found


def _gathered(members: DataFrame) -> DataFrame:
    """``members(pivot, node, n)`` with groups that lie for the most part in a larger one moved to it, a few steps on. Lists of
    one family name several pivots; rows of the same pivot stay together, so nothing is lost."""
    sizes = members.groupBy("pivot").agg(F.count("*").alias("size"))
    sized = materialise(members.join(sizes, "pivot"), "minhash-sized")
    largest = sized.groupBy("node").agg(F.max(F.struct("size", "pivot"))["pivot"].alias("to"))
    into = (sized.join(largest, "node").groupBy("pivot", "to").agg(F.count("*").alias("o"), F.first("size").alias("size"))
            .where("2 * o >= size").groupBy("pivot").agg(F.max(F.struct("o", "to"))["to"].alias("to")).where("pivot <> to"))
    into = materialise(into, "minhash-into")
    step = into
    for _ in range(2):
        further = step.select(F.col("pivot").alias("to"), F.col("to").alias("next"))
        step = step.join(further, "to", "left").select("pivot", F.coalesce("next", "to").alias("to"))
    out = sized.join(step, "pivot", "left").select(F.coalesce("to", "pivot").alias("pivot"), "node", "n").distinct()
    out = materialise(out, "minhash-gathered")
    discard(sized, into)
    return out


def _in_families(links: _Links, rows: DataFrame, comp: DataFrame | None, percent: int) -> tuple[DataFrame | None, DataFrame | None]:
    """Candidates among the rows of lists that are related to the same pivot, and components with the links found on the way.
    First groups of one family are gathered, a group's central member becomes its pivot, and links to it are confirmed: then
    members near the centre are one component, which leaves few that have to be compared with each other."""
    members = _families(rows.where("pivot IS NOT NULL").select("pivot", "node", "n").distinct(), comp)
    if members.isEmpty():
        return None, comp
    members = _gathered(members.select("pivot", "node", "n"))
    members = members.join(members.groupBy("pivot").agg(F.count("*").alias("size")), "pivot")
    sets, spent = links.sets_of(members.select("node").union(members.select("pivot")).distinct())
    centres = materialise(central_members(members, sets, percent), "minhash-centres")
    members = members.join(centres, "pivot").select(F.col("centre").alias("pivot"), "node", "n").distinct()
    members = materialise(members, "minhash-central")
    sizes = links.classes.select(F.col("node").alias("pivot"), F.col("n").alias("pn"))
    star = members.join(sizes, "pivot").where(100 * F.least("n", "pn") >= percent * F.greatest("n", "pn"))
    if links.add(_pairs(star.select(F.col("node").alias("a"), F.col("pivot").alias("b")))):
        comp = links.components()
    members = _families(members, comp)
    if members.isEmpty():
        return None, comp
    pairs, posted = similar_in_groups(members, sets, percent)
    found = materialise(_pairs(pairs), "minhash-similar")
    discard(sets, spent, members, posted)
    return found, comp


def _link_classes(links: _Links, classes: DataFrame, percent: int, t: int, few: int, split: int) -> DataFrame | None:
    # sizes of a similar pair lie in one band or in neighbours, so they share the band of the larger
    width = -math.log(min(percent, 99.9) / 100) * (1 + 1e-9)
    band = F.floor(F.log(F.col("n")) / width)
    lists = classes.select("node", F.posexplode(F.slice("sig", 1, K - t + 1)).alias("i", "v"), band.alias("band"))
    lists = lists.select("node", "i", "v", F.explode(F.array("band", F.col("band") + 1)).alias("band")).select(
        F.xxhash64("i", "v", "band").alias("list"), "i", "node")
    comp, more, done = None, False, []
    for depth in range(1, min(DEPTH, t) + 1):
        first = lambda r: F.min(F.struct(F.xxhash64(F.lit(r), "node").alias("h"), "node"))["node"]
        sizes = lists.groupBy("list").agg(F.count("*").alias("members"), *[first(r).alias(f"p{r}") for r in range(PIVOTS)])
        sizes = sizes.where("members > 1").select("list", F.col("p0").alias("pivot"), F.array(*[f"p{r}" for r in range(PIVOTS)]).alias("pivots"))
        lists = listed = materialise(lists.join(sizes, "list"), "minhash-lists")
        discard(*done)
        signs = lambda p: classes.select(*[F.col(c).alias(p + c) for c in ("node", "n", "x", "y")])
        star = _pairs(lists.select(F.col("node").alias("a"), F.explode(F.array_distinct("pivots")).alias("b")))
        star = (star.join(signs("a"), F.col("a") == F.col("anode")).join(signs("b"), F.col("b") == F.col("bnode"))
                .where(_fits("a", "b", percent, t)).select("a", "b"))
        if links.add(star):
            comp = links.components()
        if comp is not None:
            roots = comp.select(F.col("node").alias("pivot"), F.col("comp").alias("pc"))
            lists = lists.join(comp, "node", "left").join(roots, "pivot", "left")
        else:
            lists = lists.withColumns({"comp": F.lit(None).cast("long"), "pc": F.lit(None).cast("long")})
        lists = lists.select("list", "i", "node", F.coalesce("comp", "node").alias("comp"),
                             (F.coalesce("comp", "node") != F.coalesce("pc", "pivot")).alias("outside"))
        apart = lists.groupBy("list").agg(F.count_if("outside").alias("others")).where("others > 0")
        lists = materialise(lists.join(apart, "list").join(signs(""), "node"), "minhash-apart")
        done = [lists, listed]
        last = depth == min(DEPTH, t)
        found = _cross(lists.where(F.col("others") <= few), percent, t)
        far = lists.where(F.col("others") > few)
        if far.isEmpty():
            more = links.add(_pairs(found)) or more
            break
        far = materialise(_anchored(far, listed, classes, split if last else None), "minhash-anchored")
        done.append(far)
        short = far.where(F.col("others") <= split)
        found = found.union(_cross(short, percent, t, "r"))
        related, comp = _in_families(links, far, comp, percent)
        more = links.add(_pairs(found if related is None else found.union(related))) or more
        far = far.where(F.col("others") > split)
        if last or far.isEmpty():
            break
        far = far.select("list", "i", "node").join(classes.select("node", "sig"), "node")
        lists = far.select("list", "node", "sig", F.explode(F.sequence(F.col("i") + 1, F.lit(K - t + depth))).alias("i"))
        lists = lists.select(F.xxhash64("list", "i", F.col("sig")[F.col("i")]).alias("list"), "i", "node")
    discard(*done)
    return links.components() if more else comp


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, percent: int = 85,
                    few: int = FEW, split: int = SPLIT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text_hash``, ``n_shingles``, ``component_id`` (smallest doc_id
    reachable over links of at least ``percent`` similarity), ``kept`` (doc_id = component_id) and
    ``leader`` (the row that stands for its component: smallest doc_id, nulls last).

    Null or empty text, or text of white space only: no shingles, linked with nothing. A null
    doc_id is never a component_id unless no document of the component has one; such rows are not
    ``kept``. Repeated rows share a component. Empty table: no rows."""
    t = least_matches(percent / 100)
    base = docs.select(F.col(doc_id).cast("long").alias("__id"), F.col(text).alias("__text"))
    digest = materialise(
        base.select("__id", F.xxhash64("__text").alias("text_hash"), "__text").mapInArrow(
            _sign(width, "__text"), "__id long, text_hash long, n_shingles long, node long, sig array<int>, x long, y long, sketch binary"), "minhash-digest")
    classes = materialise(
        digest.where("node IS NOT NULL").groupBy("node").agg(
            F.min_by(F.struct("n_shingles", "sig", "x", "y", "sketch"), "text_hash").alias("s"), F.min("__id").alias("head"))
        .select("node", F.col("s.n_shingles").alias("n"), F.col("s.sig").alias("sig"), "s.x", "s.y", "s.sketch", "head"), "minhash-classes")
    comp = _link_classes(_Links(base, classes, "__text", width, percent), classes, percent, t, few, split)
    rows = digest.select("__id", "text_hash", "n_shingles", "node")
    rows = rows.join(comp, "node", "left") if comp is not None else rows.withColumn("comp", F.lit(None).cast("long"))
    rows = materialise(rows.withColumn("comp", F.coalesce("comp", "node")).drop("node"), "minhash-rows")
    first = F.min(F.struct(F.col("__id").isNull().alias("x"), F.col("__id").alias("id"), F.col("text_hash").alias("h")))
    groups = (rows.where("comp IS NOT NULL").groupBy("comp").agg(first.alias("first"), F.count("*").alias("c"))
              .where("c > 1").select("comp", "first"))
    out = rows.join(groups, "comp", "left")
    alone = F.col("first").isNull()
    component = F.when(alone, F.col("__id")).otherwise(F.col("first.id"))
    return out.select(
        F.col("__id").alias("doc_id"), "text_hash", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("__id") == component, F.lit(False)).alias("kept"),
        (alone | (F.col("__id").eqNullSafe(F.col("first.id")) & (F.col("text_hash") == F.col("first.h")))).alias("leader"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each group stays, with its own columns: the one with the smallest
    doc_id. Of fully repeated rows one stays; documents without shingles all stay."""
    found = materialise(near_duplicates(docs, doc_id, text, **options), "minhash-found")
    keyed = docs.withColumns({"__id": F.col(doc_id).cast("long"), "__hash": F.xxhash64(text)})
    gone = found.where("NOT leader").select(F.col("doc_id").alias("__i"), F.col("text_hash").alias("__h")).distinct()
    gone = broadcast_if_small(materialise(gone, "minhash-gone"))
    kept = keyed.join(gone, F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__hash") == F.col("__h")), "left_anti")
    twice = found.where("leader AND n_shingles > 0").groupBy("doc_id", "text_hash").count().where("count > 1")
    if not twice.isEmpty():
        whole = kept.where(F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")) > 0)
        blank = kept.where(F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")) == 0)
        kept = whole.dropDuplicates(["__id", "__hash"]).unionByName(blank)
    return kept.drop("__id", "__hash")


def op6_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")

"""The prefix trie of conversations, by burst tries.

A conversation is a sequence of turn ids (digests of role and text). All of them start as suffixes in one container
under the root. A container of more turns than its capacity bursts: its suffixes are dealt out by their next turn
id to containers one level deeper, and a trie head stays in its place. One round bursts several levels, twice
as many as the round before, so rounds grow with the logarithm of the depth. The shards then hold the
remaining containers, all small: their suffixes are sorted and swept into nodes.

Everything about heads is aggregated over rows (conversation, depth), so neither a hot turn, nor copies of a
conversation, nor a long conversation is ever held by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .common import broadcast_if_small, broadcast_value, materialise, table

CAPACITY = 4096          # turns in a container
FIRST_LEVELS = 8         # levels that the first round bursts
RANGE_ROWS = 250_000     # rows of an ordered range
GROUP, HEADS = 5, 9      # conversations of a group share a beginning of fewer than HEADS turns
_MOD = 1 << 128
NO_ENDS = hashlib.sha256(b"").hexdigest()
OUTPUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_LONGS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]


def ordered_sums(df: DataFrame, key: str, order: list[str], uses: list[str], term: Callable[..., int], out: str,
                 rows: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``df`` plus ``out`` (16 bytes, big-endian): within each ``key`` (a long, not null), in ``order``, the sum of
    ``term`` of the columns ``uses`` modulo 2^128, over the rows up to and with this one. Rows equal in ``order`` come in any order.

    Rows are dealt into ordered ranges of about ``range_rows``, which may cut a key; a range is summed in a stream, then
    keys that were cut get the sums of their earlier ranges. At most one key is cut at a boundary, so the
    driver adds up a number a range. ``rows`` is the length of ``df``."""
    columns = df.columns
    extra = [StructField(out, BinaryType()), StructField("__range", LongType()), StructField("__place", LongType())]

    def run(batches):
        last, total, place, here = None, 0, 0, TaskContext.get().partitionId()
        for batch in batches:
            sums = []
            for k, *used in zip(batch.column(key).to_pylist(), *(batch.column(c).to_pylist() for c in uses)):
                if k != last:
                    last, total = k, 0
                total = (total + term(*used)) % _MOD
                sums.append(total.to_bytes(16, "big"))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sums, pa.binary()), pa.array([here] * n, pa.int64()), pa.array(range(place, place + n), pa.int64())],
                names=[*columns, out, "__range", "__place"])
            place += n

    dealt = df.repartitionByRange(1 + rows // range_rows, key, *order).sortWithinPartitions(key, *order)
    local = materialise(dealt.mapInArrow(run, StructType([*df.schema.fields, *extra])), "ordered-ranges")
    ends = local.groupBy("__range").agg(F.min(key).alias("low"), F.max(key).alias("high")).collect()
    seen: dict[int, int] = {}
    for r in ends:
        for k in {r.low, r.high}:
            seen[k] = seen.get(k, 0) + 1
    cut, moved = [(k,) for k, n in seen.items() if n > 1], {}
    if cut:
        keys = F.broadcast(df.sparkSession.createDataFrame(cut, f"{key} long"))
        for r in sorted(local.join(keys, key).groupBy(key, "__range").agg(F.max_by(out, "__place").alias("part")).collect()):
            before = moved.setdefault(r[key], {-1: 0})
            total = before.pop(-1)
            before[r["__range"]] = total
            before[-1] = (total + int.from_bytes(r["part"], "big")) % _MOD
    shared = broadcast_value(df.sparkSession, moved)  # a number a range

    def shift(batches):
        before = shared.value
        for batch in batches:
            sums = batch.column(out)
            if before:
                add = [before[k][p] if k in before else 0 for k, p in zip(batch.column(key).to_pylist(), batch.column("__range").to_pylist())]
                sums = pa.array([((int.from_bytes(s, "big") + a) % _MOD).to_bytes(16, "big") if a else s for s, a in zip(sums.to_pylist(), add)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in columns] + [sums], names=[*columns, out])

    return local.mapInArrow(shift, StructType([*df.schema.fields, extra[0]]))


def _low(column: str) -> Column:
    return F.conv(F.hex(F.substring(column, 9, 8)), 16, 10).cast("long")


def _high(column: str) -> Column:
    return F.conv(F.hex(F.substring(column, 1, 8)), 16, 10).cast("long")


def numbered_turns(turns: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``conv_id``, ``pos`` (from 1), ``tid`` (16 bytes, a digest of role and text) and ``size`` (UTF-8 bytes of the text) of
    every turn, in the order of ``turn`` with null first; turns of equal number by ``tid``. Null role and text count
    as empty, repeated rows as turns of their own. Rows without a conv_id belong to no conversation."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    narrow = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.unhex(F.substring(F.sha2(said, 256), 1, 32)).alias("tid"),
        F.octet_length(text).cast("long").alias("size"))
    digest = materialise(narrow, "turn-digests")
    placed = ordered_sums(digest, "conv_id", ["turn", "tid"], [], lambda: 1, "__n", digest.count(), range_rows)
    return placed.select("conv_id", _low("__n").alias("pos"), "tid", "size")


def rebuilt(turns: DataFrame, group: int = GROUP, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Conversations of a group begin alike: of ``numbered_turns``, every conversation c gets the first h turns of
    c - c % ``group`` (h = crc32 of c in decimal, modulo ``heads``), then its own after its first h. Two written tables: ``conv_id``, ``len``
    for every conversation, also those left without turns; and ``conv_id``, ``d`` (from 1), ``len``, ``tid``, ``size``."""
    turns = materialise(turns, "numbered-turns")
    shared = (turns.where((F.col("pos") < heads) & (F.col("conv_id") % group == 0)).groupBy(F.col("conv_id").alias("__base"))
              .agg(F.sort_array(F.collect_list(F.struct("pos", "tid", "size"))).alias("__head")))  # fewer than ``heads`` turns
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads)).cast("long")
    convs = (convs.withColumns({"h": h, "__base": F.col("conv_id") - F.col("conv_id") % group}).join(shared, "__base", "left")
             .withColumn("__take", F.when(F.col("h") > 0, F.expr("slice(__head, 1, cast(h as int))")))
             .withColumn("took", F.when(F.col("__take").isNull(), 0).otherwise(F.size("__take")).cast("long"))
             .withColumn("len", F.col("took") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
             .select("conv_id", "h", "took", "len", "__take"))
    convs = materialise(convs, "rebuilt-conversations")
    first = convs.select("conv_id", "len", F.explode("__take").alias("x")).select("conv_id", F.col("x.pos").alias("d"), "len", "x.tid", "x.size")
    own = (turns.join(broadcast_if_small(convs.drop("__take")), "conv_id").where("pos > h")
           .select("conv_id", (F.col("pos") - F.col("h") + F.col("took")).alias("d"), "len", "tid", "size"))
    return convs.select("conv_id", "len"), materialise(first.unionByName(own), "rebuilt-turns")


def _step(tid: bytes, d: int) -> int:
    return int.from_bytes(hashlib.blake2b(tid + d.to_bytes(8, "big"), digest_size=16).digest(), "big")


def with_prefixes(rows: DataFrame, n: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``rows`` plus ``ph``, a digest of the first d turns (the sum of digests of turn and place), and ``up``, that of the first
    d - 1."""
    summed = ordered_sums(rows, "conv_id", ["d"], ["tid", "d"], _step, "ph", n, range_rows)

    def parents(batches):
        for batch in batches:
            up = [((int.from_bytes(p, "big") - _step(t, d)) % _MOD).to_bytes(16, "big")
                  for p, t, d in zip(*(batch.column(c).to_pylist() for c in ("ph", "tid", "d")))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(up, pa.binary())], names=[*batch.schema.names, "up"])

    return summed.mapInArrow(parents, StructType([*summed.schema.fields, StructField("up", BinaryType())]))


def burst(rows: DataFrame, capacity: int = CAPACITY, levels: int = FIRST_LEVELS) -> DataFrame:
    """The trie heads: prefixes of more than ``capacity`` turns at or below them. ``d``, ``ph``, ``up``, ``n_convs``, ``conv_id``
    (smallest member), ``size`` (bytes of the last text).

    A round bursts the levels ``a`` to ``b`` of the conversations that still lie in oversized containers at level ``a``."""
    spark = rows.sparkSession
    a, b, active, found = 0, levels, rows, None
    while True:
        over = materialise(active.where(F.col("d").between(a + 1, b)).groupBy("d", "ph")
                           .agg(F.count("*").alias("n_convs"), F.sum(F.col("len") - F.col("d") + 1).alias("turns"),
                                F.min("conv_id").alias("conv_id"), F.max("size").alias("size"), F.max("up").alias("up"))
                           .where(F.col("turns") > capacity).drop("turns"), "trie-heads")
        found = over if found is None else found.unionByName(over)
        deepest = over.where(F.col("d") == b).select("ph")
        if deepest.isEmpty():
            return found
        still = materialise(rows.where((F.col("d") == b) & (F.col("len") > b)).join(broadcast_if_small(deepest), "ph", "left_semi")
                            .select("conv_id"), "trie-active")
        active = rows.join(broadcast_if_small(still), "conv_id", "left_semi")
        a, b = b, b + 2 * (b - a)


def sweep(members: dict[int, list[tuple[bytes, int]]], depth: int) -> list[list]:
    """The nodes of one container: suffixes (turn id, size) by conversation, which start at ``depth`` with the same turn. They are sorted, and one
    pass over neighbours opens and closes nodes. Rows: smallest member, depth, index of the parent's row (-1: above the container), members, children, leaves,
    saved bytes of the subtree, conversations that end here."""
    nodes, path, last = [], [], []
    for turns, conv in sorted((t, c) for c, t in members.items()):
        same = 0
        while same < min(len(last), len(turns)) and last[same][0] == turns[same][0]:
            same += 1
        del path[same:]
        for i in range(same, len(turns)):
            nodes.append([conv, depth + i, path[-1] if path else -1, 0, 0, 0, 0, []])
            path.append(len(nodes) - 1)
        for i in path:
            nodes[i][0] = min(nodes[i][0], conv)
            nodes[i][3] += 1
        if path:
            nodes[path[-1]][7].append(conv)
        for i, at in enumerate(path):
            nodes[at][6] = turns[i][1]  # bytes of the last text, until members are known
        last = turns
    for node in nodes:
        node[6] *= node[3] - 1
    for node in reversed(nodes):  # children come after their parents
        node[5] = node[5] or 1
        if node[2] >= 0:
            up = nodes[node[2]]
            up[4] += 1
            up[5] += node[5]
            up[6] += node[6]
    return nodes


def ends_digest(convs: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, sorted(convs))).encode()).hexdigest()


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Containers one after another; rows are sorted by container, conversation and depth."""
    def made(head, members, up, depth):
        nodes = sweep(members, depth)
        return [(n[0], n[1], nodes[n[2]][0] if n[2] >= 0 else None, n[3], n[4], n[5], n[6], ends_digest(n[7]) if n[7] else NO_ENDS, up if n[2] < 0 else None) for n in nodes]

    def out(rows):
        kinds = [pa.int64()] * 7 + [pa.string(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[*OUTPUT, "up"])

    head, members, up, depth, rows = None, {}, None, 0, []
    for batch in batches:
        for container, conv, d, tid, size, above in zip(*(batch.column(c).to_pylist() for c in ("container", "conv_id", "d", "tid", "size", "up"))):
            if container != head:
                if members:
                    rows += made(head, members, up, depth)
                    if len(rows) > 20_000:
                        yield out(rows)
                        rows = []
                head, members, up, depth = container, {}, above, d
            members.setdefault(conv, []).append((tid, size))
    if members:
        rows += made(head, members, up, depth)
    if rows:
        yield out(rows)


def digests_of_ends(ends: DataFrame, n: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``ph`` and ``ends_sha256`` of ``ends(ph, conv_id)``: ids are sorted over ranges of rows and joined to long pieces there, so the task that
    hashes the list of a hot prefix reads pieces in order and holds one of them."""
    def pieces(batches):
        key, convs = None, []
        def flush():
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([convs[0]], pa.int64()), pa.array([",".join(map(str, convs))])], names=["ph", "first", "ids"])
        for batch in batches:
            for ph, conv in zip(batch.column("ph").to_pylist(), batch.column("conv_id").to_pylist()):
                if convs and (ph != key or len(convs) >= 50_000):
                    yield flush()
                    convs = []
                key = ph
                convs.append(conv)
        if convs:
            yield flush()

    def hashed(batches):
        key, state, rows = None, None, []
        for batch in batches:
            for ph, ids in zip(batch.column("ph").to_pylist(), batch.column("ids").to_pylist()):
                if ph != key:
                    if state:
                        rows.append((key, state.hexdigest()))
                    key, state = ph, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
        if state:
            rows.append((key, state.hexdigest()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows])], names=["ph", "ends_sha256"])

    joined = (ends.select("ph", "conv_id").repartitionByRange(1 + n // range_rows, "ph", "conv_id").sortWithinPartitions("ph", "conv_id")
              .mapInArrow(pieces, "ph binary, first long, ids string"))
    return joined.repartition("ph").sortWithinPartitions("ph", "first").mapInArrow(hashed, "ph binary, ends_sha256 string")


def prefix_trie(convs: DataFrame, turns: DataFrame, capacity: int = CAPACITY, levels: int = FIRST_LEVELS,
                range_rows: int = RANGE_ROWS) -> DataFrame:
    """A row a node of the trie over ``turns(conv_id, d, len, tid, size)`` of ``convs(conv_id, len)``, both written tables; see
    ``rebuilt``. Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` (bytes not stored again in the subtree), ``ends_sha256``. No conversations: no rows."""
    spark = convs.sparkSession
    whole = convs.agg(F.count("*").alias("n"), F.min("conv_id").alias("least"), F.sum("len").alias("turns"), F.count_if(F.col("len") == 0).alias("bare")).first()
    if not whole.n:
        return spark.createDataFrame([], ", ".join([f"{c} long" for c in _LONGS] + ["ends_sha256 string"]))
    rows = materialise(with_prefixes(turns, whole.turns, range_rows), "trie-rows")
    heads = materialise(burst(rows, capacity, levels), "all-trie-heads")
    names = broadcast_if_small(heads.select("ph"))
    marked = (rows.join(names.withColumn("in_head", F.lit(True)), "ph", "left")
              .join(names.select(F.col("ph").alias("up"), F.lit(True).alias("under_head")), "up", "left"))
    marked = materialise(marked, "trie-marked")

    # containers: every conversation's first prefix that is no head
    rest = marked.where("in_head IS NULL")
    place = rest.where("under_head OR d = 1").select("conv_id", F.col("ph").alias("container"))
    held = rest.select("conv_id", "d", "tid", "size", "up").join(broadcast_if_small(materialise(place, "trie-containers")), "conv_id")
    shards = 1 + whole.turns // range_rows
    swept = (held.repartition(max(shards, int(spark.conf.get("spark.sql.shuffle.partitions"))), "container")
             .sortWithinPartitions("container", "conv_id", "d")
             .mapInArrow(_swept, ", ".join([f"{c} long" for c in _LONGS] + ["ends_sha256 string", "up binary"])))
    swept = materialise(swept, "trie-swept")
    tops = swept.where("up IS NOT NULL")

    # heads: what hangs under them is credited to the smallest member, at the depth of the head, and summed towards the root
    children = (tops.select("up").unionByName(heads.select("up")).groupBy("up").agg(F.count("*").alias("n_children"))
                .withColumnRenamed("up", "ph"))
    heads = materialise(heads.join(children, "ph", "left").fillna(0, ["n_children"]), "trie-heads-children")
    credit = (tops.where("depth > 1").select("conv_id", (F.col("depth") - 1).alias("d"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
              .unionByName(heads.select("conv_id", "d", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"),
                                        ((F.col("n_convs") - 1) * F.col("size")).alias("saved")))
              .groupBy("conv_id", "d").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
    credit = materialise(credit, "trie-credit")
    in_heads = marked.where("in_head").select("conv_id", "d", "len", "ph")
    paths = materialise(in_heads.join(broadcast_if_small(materialise(credit.select("conv_id").distinct(), "trie-credited")), "conv_id", "left_semi")
                        .join(broadcast_if_small(credit), ["conv_id", "d"], "left").fillna(0, ["leaves", "saved"])
                        .withColumn("down", -F.col("d")).select("conv_id", "down", "ph", "leaves", "saved"), "trie-paths")
    below = ordered_sums(paths, "conv_id", ["down"], ["leaves", "saved"], lambda n, s: (n << 64) + s, "below", paths.count(), range_rows)
    sums = below.groupBy("ph").agg(F.sum(_high("below")).alias("n_leaves"), F.sum(_low("below")).alias("saved_tokens"))
    ending = materialise(in_heads.where("d = len").select("ph", "conv_id"), "trie-ends")
    ends = digests_of_ends(ending, ending.count(), range_rows)
    named = heads.select(F.col("ph").alias("up"), F.col("conv_id").alias("__parent"))
    up_name = F.when(F.col("depth") == 1, F.lit(whole.least)).otherwise(F.col("__parent"))
    top = materialise(heads.join(sums, "ph", "left").join(ends, "ph", "left").withColumnRenamed("d", "depth")
                      .join(broadcast_if_small(named), "up", "left")
                      .select("conv_id", "depth", up_name.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
                              F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")), "trie-head-nodes")

    inside = (swept.join(broadcast_if_small(named), "up", "left")
              .withColumn("parent_conv_id", F.when(F.col("up").isNull(), F.col("parent_conv_id")).otherwise(up_name)).select(*OUTPUT))
    total = (top.where("depth = 1").select("n_leaves", "saved_tokens").unionByName(tops.where("depth = 1").select("n_leaves", "saved_tokens"))
             .agg(F.count("*").alias("k"), F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s")).first())
    bare = NO_ENDS
    if whole.bare:
        bare = digests_of_ends(convs.where("len = 0").select(F.lit(b"").alias("ph"), "conv_id"), whole.bare, range_rows).first().ends_sha256
    root = spark.createDataFrame([(whole.least, 0, None, whole.n, total.k, total.l or 1, total.s or 0, bare)],
                                 ", ".join([f"{c} long" for c in _LONGS] + ["ends_sha256 string"]))
    return inside.unionByName(top).unionByName(root)


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(*rebuilt(numbered_turns(table(spark, sf_dir, "conversations"))))


def oracle_sql() -> str:
    return f"""
with t as (
  select conv_id, turn, octet_length(encode(coalesce(text, ''))) as size,
         sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) as tid
  from conversations where conv_id is not null),
own as (select *, row_number() over (partition by conv_id order by turn nulls first, tid) as pos from t),
convs as (
  select conv_id, max(pos) as n, conv_id - conv_id % {GROUP} as base,
         xor(list_reduce(list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint),
             lambda c, b: list_reduce([1, 2, 3, 4, 5, 6, 7, 8]::bigint[],
                 lambda x, i: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end, xor(c, b)), 4294967295::bigint),
             4294967295::bigint) % {HEADS} as h
  from own group by conv_id),
heads as (select c.conv_id, o.pos as d, o.tid, o.size from convs c join own o on o.conv_id = c.base and o.pos <= c.h),
took as (select conv_id, count(*) as took from heads group by conv_id),
turns as (
  select * from heads union all
  select o.conv_id, o.pos - c.h + coalesce(k.took, 0), o.tid, o.size
  from own o join convs c on o.conv_id = c.conv_id and o.pos > c.h left join took k on k.conv_id = c.conv_id),
seqs as (
  select conv_id, d, size, string_agg(tid, '') over (partition by conv_id order by d) as path, count(*) over (partition by conv_id) as len from turns
  union all
  select c.conv_id, 0, 0, '', (select count(*) from turns x where x.conv_id = c.conv_id) from convs c),
nodes as (
  select path, d, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * max(size) as saved,
         sha256(coalesce(string_agg(case when d = len then conv_id::varchar end, ',' order by conv_id), '')) as ends_sha256
  from seqs group by path, d),
kids as (select left(path, (64 * (d - 1))::bigint) as path, count(*) as n_children from nodes where d > 0 group by 1),
full_nodes as (select n.*, coalesce(k.n_children, 0) as n_children from nodes n left join kids k using (path)),
below as (
  select left(path, 64 * i) as path, sum(case when n_children = 0 then 1 else 0 end) as n_leaves, sum(saved) as saved_tokens
  from (select *, unnest(range(d::bigint + 1)) as i from full_nodes) group by 1)
select n.conv_id, cast(n.d as bigint) as depth, p.conv_id as parent_conv_id, n.n_convs, cast(n.n_children as bigint) as n_children,
       cast(b.n_leaves as bigint) as n_leaves, cast(b.saved_tokens as bigint) as saved_tokens, n.ends_sha256
from full_nodes n join below b using (path) left join nodes p on n.d > 0 and p.path = left(n.path, (64 * (n.d - 1))::bigint)"""

"""Cross-tokenizer alignment by pointer jumping.

Two tokenizers cut the same bytes in two ways. Two tokens overlap if they share a byte; the components of that
overlap are the groups between bytes where tokens of both end. Every token points to its
farthest-right overlapping token of the other side, or to the end of its group if it ends there; squaring the
pointers (``succ = succ[succ]``) until nothing moves leaves every token at the terminal token
of its component, which names the group. The pointers of a run of texts are one numpy array, so the number of steps
is the logarithm of the longest group.

Ids linked by a group are kept as distinct pairs with multiplicities; how many documents hold a
pair is a Spark aggregation over the corpus.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .common import broadcast_value, materialise, table, without
from .tokens import PATTERN
from .words import slices

#: Public vocabularies (paths are parameters): A, byte-level BPE in JSON; B, pieces with byte fallback.
BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
EXPAND = 4_000_000     # id pairs that are formed at a time
PAIRS_AT_ONCE = 4_000_000  # counted id pairs up to which the table of counts is broadcast (13 bytes each)

DIGEST = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
ARRAYS = ["a_ids", "b_ids", "a_groups", "b_groups"]
_cache: dict[str, object] = {}


def byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a character: printable Latin-1 as itself, the others, in order,
    from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Side:
    """Token bytes by id, as lists and lengths, and decimal digits of the ids."""

    def __init__(self, token_bytes: list[bytes]):
        self.bytes = token_bytes
        self.lengths = np.array([len(b) for b in token_bytes], np.int64)
        width = len(str(max(1, len(token_bytes) - 1)))
        text = np.array([str(i).rjust(width, "\0") for i in range(len(token_bytes))], f"S{width}")
        self.digits = np.frombuffer(text.tobytes(), np.uint8).reshape(len(token_bytes), width)

    def spells(self, ids: list[int], wanted: bytes) -> bool:
        return b"".join(map(self.bytes.__getitem__, ids)) == wanted


class ByteBpe(Side):
    """A: a byte-level BPE read from its JSON file. Merges numbered as their tokens let the ids be ranks, which a faster
    encoder of the same algorithm takes; any other file is encoded by its own library."""

    def __init__(self, spec: bytes):
        spec = json.loads(spec)
        of_char, vocab = byte_of_char(), spec["model"]["vocab"]
        special = {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *special]) + 1
        tokens = [b""] * size
        for word, i in vocab.items():
            tokens[i] = word.encode() if i in special else bytes(of_char[c] for c in word)
        super().__init__([special.get(i, b) if not b else b for i, b in enumerate(tokens)])
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        ranked = all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(merges)) and len(merges) + 256 == len(set(vocab.values()) - set(special))
        plain = spec.get("normalizer") is None and (spec.get("pre_tokenizer") or {}).get("type") == "ByteLevel" \
            and spec["pre_tokenizer"].get("use_regex", True) and not spec["pre_tokenizer"].get("add_prefix_space")
        if ranked and plain:
            import tiktoken

            ranks = {b: i for i, b in enumerate(tokens) if b and i not in special}
            self.encode = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            from tokenizers import Tokenizer

            own = Tokenizer.from_str(json.dumps(spec))
            own.encode_special_tokens = True
            self.encode = lambda text: own.encode(text, add_special_tokens=False).ids


class Pieces(Side):
    """B: pieces; U+2581 stands for a space, byte pieces for their byte."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        piece, is_byte = self.model.id_to_piece, self.model.is_byte
        super().__init__([bytes([int(piece(i)[3:5], 16)]) if is_byte(i) else piece(i).replace("▁", " ").encode()
                          for i in range(self.model.get_piece_size())])

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def encoders(byte_bpe: bytes, pieces: bytes) -> tuple[ByteBpe, Pieces]:
    """Both sides, built once in a Python process."""
    key = hashlib.md5(byte_bpe).hexdigest() + hashlib.md5(pieces).hexdigest()
    if key not in _cache:
        _cache[key] = (ByteBpe(byte_bpe), Pieces(pieces))
    return _cache[key]


def terminal_groups(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Group number of every A and every B token, from the byte offsets where they end (rising, with an equal last
    offset), by pointer jumping; and the number of groups."""
    n = len(a_ends)
    over_a = np.searchsorted(b_ends, a_ends)  # the B token that holds an A token's last byte
    over_b = np.searchsorted(a_ends, b_ends)
    ends_here = b_ends[over_a] == a_ends if n else np.zeros(0, bool)
    succ = np.concatenate([np.where(ends_here, np.arange(n), n + over_a), over_b])
    while True:
        further = succ[succ]
        if np.array_equal(further, succ):
            break
        succ = further
    number = np.cumsum(ends_here) - 1
    return number[succ[:n]], number[succ[n:]], int(ends_here.sum())


def _flat(ids: list[list[int]]) -> np.ndarray:
    return np.concatenate([np.array(x, np.int64) for x in ids]) if ids else np.zeros(0, np.int64)


class Aligned:
    """The alignment of a run of texts: flat tokens of both sides in order, their documents and groups."""

    def __init__(self, texts: list[str | None], a: ByteBpe, b: Pieces):
        self.a, self.b, self.n = a, b, len(texts)
        wanted = [(" " + t).encode() if t else b"" for t in texts]
        ids_a = [a.encode(" " + t) if t else [] for t in texts]
        ids_b = b.encode_all([t or "" for t in texts])
        for i, w in enumerate(wanted):
            if not w or not a.spells(ids_a[i], w) or not b.spells(ids_b[i], w):
                ids_a[i], ids_b[i] = [], []
        self.n_a, self.n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
        self.ids_a, self.ids_b = _flat(ids_a), _flat(ids_b)
        self.doc_a, self.doc_b = (np.repeat(np.arange(self.n), k) for k in (self.n_a, self.n_b))
        # a text's tokens of both sides spell the same bytes, so every text ends a group
        self.group_a, self.group_b, self.groups = terminal_groups(np.cumsum(a.lengths[self.ids_a]), np.cumsum(b.lengths[self.ids_b]))
        self.in_a, self.in_b = (np.bincount(g, minlength=self.groups) for g in (self.group_a, self.group_b))
        last_of_group = np.cumsum(self.in_a) - 1
        self.doc_of_group = self.doc_a[last_of_group] if self.groups else np.zeros(0, np.int64)

    def per_doc(self, of_group: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(of_group)])
        n = np.searchsorted(self.doc_of_group, np.arange(self.n + 1))
        return total[n[1:]] - total[n[:-1]]

    def digests(self) -> list[str]:
        """SHA-256 of ``a1,a2|b1;a3|b2,b3`` for every text, '' without tokens."""
        before_b = np.concatenate([[0], np.cumsum(self.in_b)])
        up_to_a = np.cumsum(self.in_a)
        at_a = np.arange(len(self.ids_a)) + before_b[self.group_a]
        at_b = np.arange(len(self.ids_b)) + up_to_a[self.group_b]
        wa, wb = self.a.digits.shape[1], self.b.digits.shape[1]
        w = max(wa, wb)
        cells = np.zeros((len(at_a) + len(at_b), w + 1), np.uint8)
        cells[at_a, :wa], cells[at_b, :wb] = self.a.digits[self.ids_a], self.b.digits[self.ids_b]
        cells[:, w] = ord(",")
        cells[at_a[up_to_a - 1], w] = ord("|")
        cells[at_b[before_b[1:] - 1], w] = ord(";")
        used = cells != 0
        ends = np.concatenate([[0], np.cumsum(used.sum(axis=1))])
        text = cells[used].tobytes()
        rows = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])
        return [hashlib.sha256(text[ends[r]:ends[s] - 1]).hexdigest() if s > r else "" for r, s in zip(rows[:-1], rows[1:])]

    def _distinct(self, group, ids, size):
        key, times = np.unique(group * size + ids, return_counts=True)
        return key // size, key % size, times

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, a * |B| + b, occurrences) of the distinct linked id pairs, by document and pair. Ids of a group are
        made distinct first; ``EXPAND`` pairs at a time are formed and merged."""
        size_a, size_b = len(self.a.bytes), len(self.b.bytes)
        ga, a, ta = self._distinct(self.group_a, self.ids_a, size_a)
        gb, b, tb = self._distinct(self.group_b, self.ids_b, size_b)
        first, many = np.searchsorted(gb, ga), np.bincount(gb, minlength=self.groups)[ga] if len(ga) else np.zeros(0, np.int64)
        made = np.cumsum(many)
        done, at = [], 0
        while at < len(a):
            stop = max(at + 1, int(np.searchsorted(made, (made[at - 1] if at else 0) + EXPAND, side="right")))
            k = many[at:stop]
            of_a = np.repeat(np.arange(at, stop), k)
            of_b = np.repeat(first[at:stop] - (np.cumsum(k) - k), k) + np.arange(k.sum())
            key = (self.doc_of_group[ga[of_a]] * size_a + a[of_a]) * size_b + b[of_b]
            done.append(_summed(key, ta[of_a] * tb[of_b]))
            at = stop
        key, times = _summed(*(np.concatenate(x) for x in zip(*done))) if done else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        return key // (size_a * size_b), key % (size_a * size_b), times


def _summed(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(key):
        return key, times
    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(times, first)


def _lists(counts: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values, kind))


def _digest(x: Aligned) -> list[pa.Array]:
    doc, pair, times = x.pairs()
    per = np.bincount(doc, minlength=x.n)
    long = lambda v: pa.array(v, pa.int64())
    return [long(x.n_a), long(x.n_b), long(x.per_doc(np.ones(x.groups, np.int64))), long(x.per_doc(x.in_a * x.in_b)),
            pa.array(x.digests(), pa.string()), _lists(per, pair, pa.int32()), _lists(per, times, pa.int64())]


def _arrays(x: Aligned) -> list[pa.Array]:
    start = np.searchsorted(x.doc_of_group, np.arange(x.n))  # groups before a text
    return [_lists(x.n_a, x.ids_a, pa.int32()), _lists(x.n_b, x.ids_b, pa.int32()),
            _lists(x.n_a, x.group_a - start[x.doc_a], pa.int32()), _lists(x.n_b, x.group_b - start[x.doc_b], pa.int32())]


def _aligned(docs: DataFrame, text: str, byte_bpe: str, pieces: str, keep: list[str], make, fields: list[StructField]) -> DataFrame:
    spark = docs.sparkSession
    with open(byte_bpe, "rb") as f, open(pieces, "rb") as g:
        shared = broadcast_value(spark, (f.read(), g.read()))  # two vocabularies: bounded

    def run(batches):
        a, b = encoders(*shared.value)
        for batch in batches:
            for i, j in slices(batch.column("__text"), limit=2 << 20):
                part = batch.slice(i, j - i)
                arrays = make(Aligned(part.column("__text").to_pylist(), a, b))
                yield pa.RecordBatch.from_arrays([part.column(k) for k in range(len(keep))] + arrays, names=[*keep, *(f.name for f in fields)])

    schema = StructType([*docs.select(*keep).schema.fields, *fields])
    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)


def align_tokens(docs: DataFrame, text: str = "text", byte_bpe: str = BYTE_BPE, pieces: str = PIECES) -> DataFrame:
    """``docs`` plus the tokens of both sides and the group (from 0 in each text) that each belongs to: ``a_ids``,
    ``a_groups``, ``b_ids``, ``b_groups``. Null and empty texts, and those whose tokens do not spell a space and
    the text (U+2581 in it, for instance), have empty arrays. Input columns of these names are replaced."""
    ints = ArrayType(IntegerType())
    return _aligned(docs, text, byte_bpe, pieces, without(docs, ARRAYS), _arrays, [StructField(c, ints) for c in ARRAYS])


def align_digest(docs: DataFrame, text: str = "text", byte_bpe: str = BYTE_BPE, pieces: str = PIECES,
                 carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) plus ``n_a``, ``n_b``, ``n_groups``, ``n_links`` (occurrence pairs inside
    groups), ``groups_sha256``, and the distinct linked id pairs: ``pairs`` (A id times the size of B plus B id, rising) with their
    occurrences ``times``. Texts without tokens: zeros, '' and empty arrays. Repeated rows are documents of their
    own; input columns named like an output are replaced."""
    keep = [c for c in without(docs, DIGEST) if carry is None or c in carry]
    fields = [StructField(c, LongType()) for c in DIGEST[:4]] + [StructField("groups_sha256", StringType()),
              StructField("pairs", ArrayType(IntegerType())), StructField("times", ArrayType(LongType()))]
    return _aligned(docs, text, byte_bpe, pieces, keep, _digest, fields)


def pair_counts(digest: DataFrame, size_b: int) -> DataFrame:
    """``pair``, ``n`` (documents that hold it linked), ``best`` (``n`` is the highest of its A id). One row a pair at
    most for each task goes into the shuffle; the highest counts are one row an A id."""
    counts = materialise(digest.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pair-counts")
    a_id = F.expr(f"pair div {size_b}")
    top = counts.groupBy(a_id.alias("__a")).agg(F.max("n").alias("__top"))  # bounded by the vocabulary
    return counts.join(F.broadcast(top), a_id == F.col("__a")).select("pair", "n", (F.col("n") == F.col("__top")).alias("best"))


def _scored_by_table(digest: DataFrame, counts: DataFrame, keep: list[str]) -> DataFrame:
    found = counts.orderBy("pair").toArrow()
    shared = broadcast_value(digest.sparkSession, tuple(found.column(c).to_numpy() for c in ("pair", "n", "best")))

    def run(batches):
        pair, n, best = shared.value
        for batch in batches:
            lists, times = batch.column("pairs"), batch.column("times").flatten().to_numpy().astype(np.int64)
            at = np.searchsorted(pair, lists.flatten().to_numpy())
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            per = lambda v: pa.array((t := np.concatenate([[0], np.cumsum(v)]))[ends[1:]] - t[ends[:-1]], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [per(np.where(best[at], times, 0)), per(n[at] * times)],
                                             names=[*keep, "n_best", "count_sum"])

    schema = StructType([*digest.select(*keep).schema.fields, StructField("n_best", LongType()), StructField("count_sum", LongType())])
    return digest.select(*keep, "pairs", "times").mapInArrow(run, schema)


def _scored_by_join(digest: DataFrame, counts: DataFrame, keep: list[str]) -> DataFrame:
    rows = materialise(digest.withColumn("__row", F.monotonically_increasing_id()), "aligned-rows")
    links = rows.select("__row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("__row", "x.pairs", "x.times")
    sums = (links.join(counts, F.col("pairs") == F.col("pair"))
            .groupBy("__row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                  F.sum(F.col("n") * F.col("times")).alias("count_sum")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return rows.join(sums, "__row", "left").select(*keep, zero("n_best"), zero("count_sum"))


def link_statistics(digest: DataFrame, size_b: int, at_once: int = PAIRS_AT_ONCE) -> DataFrame:
    """The digest, without its arrays, plus ``n_best`` (links whose pair has the highest count of its A id, ties
    included) and ``count_sum`` (counts summed over links), counts being taken over all rows of ``digest``, which is read
    several times: write it first. Up to ``at_once`` counted pairs go to the tasks as a sorted table; a longer table is joined by a
    shuffle, with the same result."""
    counts = materialise(pair_counts(digest, size_b), "pair-best")
    keep = [c for c in without(digest, ["n_best", "count_sum"]) if c not in ("pairs", "times")]
    return (_scored_by_table if counts.count() <= at_once else _scored_by_join)(digest, counts, keep)


def piece_count(pieces: str = PIECES) -> int:
    with open(pieces, "rb") as f:
        return len(Pieces(f.read()).bytes)


def op12_token_alignment(spark, sf_dir: str) -> DataFrame:
    digest = materialise(align_digest(table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"]), "aligned")
    return link_statistics(digest, piece_count()).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

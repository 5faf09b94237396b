"""WARC archives with an external index merge.

Pages are written as WARC/1.1 records into gzip volumes of bounded size, a member a record, by Spark's own text
writer (one row a volume), so volumes are committed like any output and can lie on any file system. Equal
payloads are stored once: later copies are revisit records that refer to the stored one.

Reading a volume back gives its captures; the captures of a task, sorted by URL key and time, are a local run.
Runs are written, cut at common splitters, and every range is merged from its runs by a loser tree, so the ranges
in turn hold all captures in the order of URL key and time: the capture histories.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import broadcast_if_small, materialise, table, work_dir

VOLUME_BYTES = 16 << 20   # a volume is closed when its members are this long
LEAST_REVISIT = 1000      # payloads shorter than this many bytes are always stored
RANGE_ROWS = 200_000      # captures merged by one task
YEAR = 31_536_000
# Names and texts of the WARC/1.1 format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http;msgtype=response"
ID = "urn:page:"

RECORDS = ("archive string, offset long, length long, record_type string, record_id string, refers_to_id string, "
           "target_uri string, captured_at string, payload_digest string, payload_bytes long, payload binary")


# --- writing ---------------------------------------------------------------------------------------------------

def _header(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _one_line(url: str) -> str:
    """A URL as a header value: white space and control characters are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in url)


def record(page_id, url, date: str, sha1_hex: str, size: int, payload: bytes | None, refers_to) -> bytes:
    """One record: a response with its payload, or, with no payload given, a revisit with the HTTP head only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {size}\r\n\r\n".encode()
    digest = "sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode()
    named = lambda x: f"<{ID}{'none' if x is None else x}>"
    revisit = payload is None
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", named(page_id)), ("WARC-Date", date),
              ("WARC-Target-URI", None if url is None else _one_line(url)), ("WARC-Payload-Digest", digest),
              ("WARC-Profile", PROFILE if revisit else None), ("WARC-Refers-To", named(refers_to) if revisit else None),
              ("Content-Type", HTTP_TYPE)]
    return _header(fields, http + (payload or b""))


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _volumes(limit: int):
    """A row a volume. Members are joined once a volume is full, so a task holds one volume and one record."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = _member(_header([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:software:scrubjay>"),
                                ("WARC-Date", "2024-01-01T00:00:00Z"), ("Content-Type", "application/warc-fields")],
                               b"software: scrubjay\r\nformat: WARC File Format 1.1\r\n"))
        members, size = [head], len(head)
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "date", "digest", "size", "payload", "refers_to")]
            for i in range(batch.num_rows):
                members.append(_member(record(*(c[i].as_py() for c in columns))))
                size += len(members[-1])
                if size >= limit:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(members)], pa.binary())], names=["volume"])
                    members, size = [head], len(head)
        if len(members) > 1:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(members)], pa.binary())], names=["volume"])
    return run


def capture_date(page_id: Column) -> Column:
    """The date of pages that carry none: seconds of the id after 2024-01-01, within a year."""
    return F.date_format(F.timestamp_seconds(F.lit(1_704_067_200) + F.coalesce(F.pmod(page_id, F.lit(YEAR)), F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def stored_once(pages: DataFrame, page_id: str = "page_id", html: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """``digest`` (SHA-1 in hex) and ``keeper`` (the largest id) of payloads of at least ``least`` bytes that more
    than one id holds. Digests are counted inside tasks before they are shuffled."""
    payload = F.encode(F.col(html), "UTF-8")
    long = pages.select(F.col(page_id).alias("id"), payload.alias("p")).where(F.octet_length("p") >= least)
    ids = long.select("id", F.sha1("p").alias("digest")).groupBy("digest").agg(F.max("id").alias("keeper"), F.min("id").alias("least"), F.count("*").alias("n"), F.count("id").alias("ids"))
    return ids.where("keeper IS NOT NULL AND (least < keeper OR ids < n)").select("digest", "keeper")


def write_warc(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
               date: str | None = None, least: int = LEAST_REVISIT, volume_bytes: int = VOLUME_BYTES) -> None:
    """Write ``pages`` as gzip WARC volumes under ``path``, a record a row.

    Of rows with equal payloads of at least ``least`` bytes, those with the largest id are responses, the others revisits
    (a null id is smaller than any other). Null html is an empty payload; a null url leaves out the target. ``date`` names
    a column of ISO dates (default ``capture_date``). An empty table leaves no volume. Rows of equal id have equal record
    ids. Other columns are not read. ``path`` must not exist."""
    spark = pages.sparkSession
    pid = F.col(page_id)
    keepers = broadcast_if_small(materialise(stored_once(pages, page_id, html, least), "warc-keepers"))
    rows = pages.select(pid.alias("page_id"), F.col(url).alias("url"), (F.col(date) if date else capture_date(pid)).alias("date"),
                        F.coalesce(F.encode(F.col(html), "UTF-8"), F.lit(b"")).alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})
    known = rows.join(keepers, "digest", "left")
    revisit = F.col("keeper").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("keeper")))
    planned = known.select("page_id", "url", "date", "digest", "size", F.when(~revisit, F.col("payload")).alias("payload"),
                           F.when(revisit, F.col("keeper")).alias("refers_to"))
    volumes = planned.mapInArrow(_volumes(volume_bytes), "volume binary")
    # bytes pass through the text writer as they are; a zero byte after the last gzip member is padding
    (volumes.select(F.col("volume").cast("string").alias("value")).write
     .option("maxRecordsPerFile", 1).option("lineSep", "\0").option("compression", "none").text(path))


# --- reading ---------------------------------------------------------------------------------------------------

def _members(data: memoryview) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, bytes) of the gzip members of a volume, or of the whole of a file that is not compressed."""
    at, n = 0, len(data)
    if bytes(data[:2]) != b"\x1f\x8b":
        if bytes(data[:5]) == b"WARC/":
            yield 0, n, bytes(data)
        elif bytes(data[:64]).strip(b"\0\r\n"):
            raise ValueError("not a WARC file")
        return
    while at < n and data[at] == 0x1F:
        z, fed, out = zlib.decompressobj(31), at, []
        while not z.eof:
            if fed >= n:
                raise ValueError("a WARC volume ends inside a member")
            out.append(z.decompress(data[fed:fed + 65536]))
            fed = min(n, fed + 65536)
        end = fed - len(z.unused_data)
        yield at, end - at, b"".join(out)
        at = end
    if bytes(data[at:]).strip(b"\0\r\n"):
        raise ValueError("a WARC volume has bytes after its last member")


def _parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and blocks of the records in ``data``, by their stated lengths."""
    at = 0
    while data[at:at + 5] == b"WARC/":
        head = data[at:data.index(b"\r\n\r\n", at)]
        fields = {}
        for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        start = at + len(head) + 4
        stop = start + int(fields["content-length"])
        if stop > len(data):
            raise ValueError("a WARC record is shorter than its stated length")
        yield fields, data[start:stop]
        at = stop
        while data[at:at + 2] == b"\r\n":
            at += 2


def _hex(digest: str | None) -> str | None:
    """``sha1:`` and base 32 (or hex) as lower-case hex."""
    if not digest or not digest.lower().startswith("sha1:"):
        return None
    text = digest[5:]
    return text.lower() if len(text) == 40 else base64.b32decode(text.upper()).hex()


def _capture(archive: str, offset: int, length: int, fields: dict[str, str], block: bytes, payload: bool) -> tuple:
    kind, body, size = fields["warc-type"], block, len(block)
    if fields.get("content-type", "").replace(" ", "").startswith("application/http"):
        head, _, body = block.partition(b"\r\n\r\n")
        stated = [ln.split(b":", 1)[1] for ln in head.lower().split(b"\r\n") if ln.startswith(b"content-length:")]
        size = int(stated[0]) if stated and kind == "revisit" else len(body)
    digest = _hex(fields.get("warc-payload-digest"))
    if kind != "revisit":
        real = hashlib.sha1(body).hexdigest()
        if digest not in (None, real):
            raise ValueError(f"payload of {fields.get('warc-record-id')} in {archive} does not have its stated digest")
        digest = real
    bare = lambda x: x.strip("<>") if x else None
    return (archive, offset, length, kind, bare(fields.get("warc-record-id")), bare(fields.get("warc-refers-to")), bare(fields.get("warc-target-uri")),
            fields.get("warc-date"), digest, size, body if payload and kind != "revisit" else None)


def _records(payload: bool):
    names = [f.split(" ")[0] for f in RECORDS.split(", ")]
    types = [pa.int64() if f.endswith("long") else pa.binary() if f.endswith("binary") else pa.string() for f in RECORDS.split(", ")]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                archive, rows, held = batch.column("path")[i].as_py(), [], 0
                for offset, length, data in _members(memoryview(batch.column("content")[i].as_buffer())):
                    for fields, block in _parsed(data):
                        if fields["warc-type"] in ("response", "resource", "revisit"):
                            rows.append(_capture(archive, offset, length, fields, block, payload))
                            held += 300 + (len(block) if payload else 0)
                            if held > 8 << 20:
                                yield batch_of(rows)
                                rows, held = [], 0
                if rows:
                    yield batch_of(rows)
    return run


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The captures (response, resource and revisit records) of all WARC files under ``path``, compressed a member a record, as a
    whole, or not at all: ``archive``, ``offset`` and ``length`` of the member, ``record_type``, ``record_id``, ``refers_to_id``,
    ``target_uri``, ``captured_at``, ``payload_digest`` (hex SHA-1, recomputed where there is a payload; a wrong one is an
    error), ``payload_bytes`` (of the full payload; a revisit states it in its HTTP head) and ``payload`` (null in
    revisits, or with ``payload=False``). A task reads one file at a time as a whole: Spark's limit for it is 2 GB."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where("length > 0").select("path", "content")
    return files.mapInArrow(_records(payload), RECORDS)


def resolved(captures: DataFrame) -> DataFrame:
    """``captures`` with the payload of revisits filled in from the record they refer to (null where that is missing)."""
    stored = captures.where("record_type <> 'revisit'").dropDuplicates(["record_id"]).select(F.col("record_id").alias("__id"), F.col("payload").alias("__payload"))
    wanted = captures.where("record_type = 'revisit'").join(stored, F.col("refers_to_id") == F.col("__id"), "left")
    rest = [c for c in captures.columns if c != "payload"]
    return (wanted.select(*rest, F.col("__payload").alias("payload"))
            .unionByName(captures.where("record_type <> 'revisit'").select(*rest, "payload")))


# --- index -----------------------------------------------------------------------------------------------------

def url_key(url: Column) -> Column:
    """A sort key that keeps hosts together: scheme, user, ``www.``, default port and fragment are left out, the host is lower
    case and reversed (``com,example)/path?query``). Null: ''."""
    rest = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://", ""), r"#.*$", "")
    rest = F.regexp_replace(rest, r"^[^/?]*@", "")
    place = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*", 0), r":(80|443)$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(place, r"^[^:]*", 0)), r"^www[0-9]*\.", "")
    tail = F.regexp_replace(rest, r"^[^/?]*", "")
    return F.coalesce(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.regexp_extract(place, r":[0-9]+$", 0), F.lit(")"),
                               F.when(F.substring(tail, 1, 1) == "/", tail).otherwise(F.concat(F.lit("/"), tail))), F.lit(""))


class LoserTree:
    """Merges sorted lists: every inner node keeps the loser of its match, so the next row costs one match a level.
    A list that is used up loses every match; of equal rows the earlier list's comes first."""

    def __init__(self, runs: list[list]):
        self.runs, self.at = runs, [0] * len(runs)
        self.losers = [None] * len(runs)
        k = len(runs)
        winners = [None] * k + list(range(k))
        for node in range(k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._beats(a, b) else (b, a)
        self.winner = winners[1] if k > 1 else 0

    def _beats(self, a: int, b: int) -> bool:
        used_a, used_b = self.at[a] >= len(self.runs[a]), self.at[b] >= len(self.runs[b])
        if used_a or used_b:
            return used_b and (not used_a or a < b)
        x, y = self.runs[a][self.at[a]], self.runs[b][self.at[b]]
        return x < y or (x == y and a < b)

    def __iter__(self):
        runs, at, losers, k = self.runs, self.at, self.losers, len(self.runs)
        for _ in range(sum(map(len, runs))):
            w = self.winner
            yield runs[w][at[w]]
            at[w] += 1
            node = (w + k) // 2
            while node:
                if self._beats(losers[node], w):
                    losers[node], w = w, losers[node]
                node //= 2
            self.winner = w


ORDER = ["url_key", "captured_at", "record_id", "archive", "offset"]


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    rows = pa.Table.from_batches(got).combine_chunks()
    runs: dict[int, list] = {}
    for i, key in enumerate(zip(rows.column("run").to_pylist(), *(rows.column(c).to_pylist() for c in ORDER))):
        runs.setdefault(key[0], []).append((*key[1:], i))
    for run in runs.values():
        run.sort()  # a run arrives in blocks; within one it is sorted already
    order = pa.array([key[-1] for key in LoserTree([runs[r] for r in sorted(runs)])], pa.int64())
    out = rows.take(order).append_column("range", pa.array([TaskContext.get().partitionId()] * len(rows), pa.int64()))
    out = out.append_column("place", pa.array(range(len(rows)), pa.int64()))
    yield from out.to_batches(max_chunksize=50_000)


def capture_index(captures: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``captures`` without payloads plus ``url_key`` and ``position``: their place, from 0, in the order of URL key, time, record
    id, archive and offset. Missing values sort first, as ''.

    The captures of every task are one sorted run, written under the work folder. The runs are cut at common splitters
    of the whole order (also inside the history of one URL), and each range of about ``range_rows`` captures is merged in
    one task. Empty input: no rows."""
    narrow = captures.drop("payload").withColumns({
        "url_key": url_key(F.col("target_uri")), "captured_at": F.coalesce("captured_at", F.lit("")), "record_id": F.coalesce("record_id", F.lit(""))})
    runs = materialise(narrow.withColumn("run", F.spark_partition_id().cast("long")).sortWithinPartitions(*ORDER), "capture-runs")
    ranges = 1 + runs.count() // range_rows
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in runs.schema), "range long", "place long"])
    merged = materialise(runs.repartitionByRange(ranges, *ORDER).mapInArrow(_merged, schema), "capture-index")
    sizes = {r["range"]: r["n"] for r in merged.groupBy("range").agg(F.count("*").alias("n")).collect()}  # a number a range
    before, total = [], 0
    for k in sorted(sizes):
        before.append((k, total))
        total += sizes[k]
    moved = captures.sparkSession.createDataFrame(before, "range long, before long")
    return merged.join(F.broadcast(moved), "range").withColumn("position", F.col("before") + F.col("place")).drop("range", "place", "before", "run")


def histories(index: DataFrame) -> DataFrame:
    """A row a URL key: ``n_captures``, ``n_versions`` (distinct payloads, by a sketch), ``first_position``, ``first_at``, ``last_at``. A history
    is the run of positions from ``first_position``."""
    return index.groupBy("url_key").agg(
        F.count("*").alias("n_captures"), F.approx_count_distinct("payload_digest", 0.01).alias("n_versions"), F.min("position").alias("first_position"),
        F.min("captured_at").alias("first_at"), F.max("captured_at").alias("last_at"))


def page_number(record_id: Column) -> Column:
    """The page id in a record id that ``write_warc`` gave."""
    return F.regexp_extract(record_id, rf"^{ID}(-?[0-9]+)$", 1).try_cast("long")


def op11_warc_index(spark, sf_dir: str) -> DataFrame:
    path = f"{work_dir(spark, 'warc')}/archives"
    write_warc(table(spark, sf_dir, "pages"), path)
    index = capture_index(read_warc(spark, path, payload=False))
    return index.select(page_number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                        page_number(F.col("refers_to_id")).alias("refers_to"), "url_key", "captured_at", "position")


def oracle_sql() -> str:
    rest = r"regexp_replace(regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.\-]*://', ''), '#.*$', ''), '^[^/?]*@', '')"
    return rf"""
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest, {rest} as rest,
         strftime(timestamp '2024-01-01' + to_seconds(coalesce(((page_id % {YEAR}) + {YEAR}) % {YEAR}, 0)), '%Y-%m-%dT%H:%M:%SZ') as captured_at
  from pages),
places as (select *, regexp_replace(regexp_extract(rest, '^[^/?]*'), ':(80|443)$', '') as place, regexp_replace(rest, '^[^/?]*', '') as tail from p),
hosts as (select *, regexp_replace(lower(regexp_extract(place, '^[^:]*')), '^www[0-9]*\.', '') as host from places),
keyed as (
  select *, coalesce(array_to_string(list_reverse(string_split(host, '.')), ',') || regexp_extract(place, ':[0-9]+$') || ')'
                     || case when tail[1] = '/' then tail else '/' || tail end, '') as url_key,
         max(page_id) over (partition by payload_digest) as keeper
  from hosts),
typed as (
  select *, payload_bytes >= {LEAST_REVISIT} and keeper is not null and (page_id is null or page_id < keeper) as again from keyed)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest, case when again then 'revisit' else 'response' end as record_type,
       case when again then keeper end as refers_to, url_key, captured_at,
       row_number() over (order by url_key, captured_at, '{ID}' || page_id) - 1 as position
from typed"""

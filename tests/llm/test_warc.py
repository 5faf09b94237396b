"""Archives read back by plain code, exact round trips, and the order of the index."""

import glob
import gzip
import hashlib

import duckdb
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from llm_tables import SF

from scrubjay.llm import warc
from scrubjay.llm.queries import ORACLE, QUERIES

PAGES = "page_id long, url string, html string"
LONG = "<p>" + "x" * 1200 + "</p>"
ODD = [(1, "http://www.Example.com/a?b=1#c", LONG), (2, "http://example.com:80/a?b=1", LONG), (3, "https://u@example.com:8443", LONG),
       (3, "https://u@example.com:8443", LONG), (4, "ftp://x.org/ü ö\r\nWARC-Type: evil", None), (5, None, ""), (None, "http://a.b/", LONG), (None, None, None),
       (6, "http://a.b/", "WARC/1.1\r\n\r\n" * 300), (7, "http://a.b/", "\0\0\r\n\r\n\x1f\x8b" + "é漢😀" * 500), (8, "", "x" * 999), (9, "", "x" * 999), (10, "q", "y" * 1000), (11, "q", "y" * 1000)]


def brute(rows, least=1000):
    """(page_id, payload_bytes, digest, record_type, refers_to) of every row."""
    out = []
    for pid, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        keeper = max(same, default=None)
        again = len(data) >= least and keeper is not None and (pid is None or pid < keeper)
        out.append((pid, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", keeper if again else None))
    return out


def by_text(rows):
    return sorted(rows, key=str)


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('warc')}/odd"
    df = spark.createDataFrame(ODD, PAGES).selectExpr("*", "1 AS digest", "2 AS payload", "'z' AS keeper").repartition(3)
    warc.write_warc(df, path, volume_bytes=600)
    return path


def test_query_matches_oracle_and_brute_force(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    want = con.execute(ORACLE["op11_warc_index"]).df()
    got = QUERIES["op11_warc_index"](spark, SF).toPandas()[list(want.columns)]
    both = [d.sort_values("position").astype(object).where(lambda x: x.notna(), None).values.tolist() for d in (got, want)]
    assert both[0] == both[1]
    pages = pd.read_parquet(f"{SF}/pages.parquet")
    rows = list(zip(pages.page_id.tolist(), pages.url.tolist(), pages.html.tolist()))
    assert by_text(tuple(r[:5]) for r in both[0]) == by_text(brute(rows))


def test_odd_pages(spark, archive):
    got = warc.read_warc(spark, archive)
    number = warc.page_number
    rows = got.select(number(got.record_id), "payload_bytes", "payload_digest", "record_type", number(got.refers_to_id)).collect()
    assert by_text(map(tuple, rows)) == by_text(brute(ODD))
    assert got.select("archive").distinct().count() > 3  # volumes are closed by size


def test_payloads_come_back(spark, archive):
    """Every row's bytes are restored, those of revisits from the record they refer to."""
    got = warc.resolved(warc.read_warc(spark, archive)).collect()
    have = [(r.record_id.split(":")[-1].replace("none", "None"), bytes(r.payload)) for r in got]
    assert by_text(have) == by_text((str(p), (h or "").encode()) for p, _, h in ODD)


def test_volumes_are_plain_warc(archive):
    """A separate reader: gzip members one after another, lengths, and the fields each kind of record needs."""
    n = 0
    for name in glob.glob(f"{archive}/part-*"):
        data = gzip.decompress(open(name, "rb").read())
        at = 0
        while at < len(data):
            head, _, rest = data[at:].partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            fields = dict(x.split(": ", 1) for x in lines[1:])
            assert lines[0] == "WARC/1.1" and {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"} <= set(fields)
            size = int(fields["Content-Length"])
            assert rest[size:size + 4] == b"\r\n\r\n"
            if fields["WARC-Type"] == "revisit":
                assert fields["WARC-Profile"] == warc.PROFILE and "WARC-Refers-To" in fields
            n += fields["WARC-Type"] != "warcinfo"
            at += len(head) + 4 + size + 4
    assert n == len(ODD)


def test_members_stand_at_their_offsets(spark, archive):
    for r in warc.read_warc(spark, archive).collect():
        with open(r.archive.replace("file:", ""), "rb") as f:
            f.seek(r.offset)
            assert r.record_id.encode() in gzip.decompress(f.read(r.length))


def test_other_shapes_of_files(spark, tmpdir_path):
    """Not compressed, compressed as a whole, empty; a wrong digest and a cut volume are errors."""
    one = warc.record(5, "http://a.b/", "2024-01-01T00:00:05Z", hashlib.sha1(b"abc").hexdigest(), 3, b"abc", None)
    two = one.replace(b"sha1:", b"md5:").replace(b"page:5", b"page:6")
    for name, data in (("a.warc", one + two), ("b.warc.gz", gzip.compress(one + two)), ("c.warc", b"")):
        open(f"{tmpdir_path}/{name}", "wb").write(data)
    got = warc.read_warc(spark, tmpdir_path)
    assert sorted((r.record_id[-1], bytes(r.payload)) for r in got.collect()) == [("5", b"abc"), ("5", b"abc"), ("6", b"abc"), ("6", b"abc")]
    for bad in (one.replace(b"abc\r\n", b"abd\r\n"), gzip.compress(one)[:-12], one[:-8], b"something else"):
        open(f"{tmpdir_path}/d.warc", "wb").write(bad)
        with pytest.raises(Exception, match="stated digest|ends inside|stated length|not a WARC"):
            warc.read_warc(spark, tmpdir_path).count()


def test_index_over_many_ranges(spark, archive):
    """Positions follow URL key, time, id, archive and offset, also when a URL's history is cut into ranges."""
    index = warc.capture_index(warc.read_warc(spark, archive), range_rows=2).toPandas().sort_values("position")
    assert index.position.tolist() == list(range(len(ODD)))
    keys = list(zip(*(index[c].tolist() for c in warc.ORDER)))
    assert keys == sorted(keys) and "payload" not in index
    out = {r.url_key: r for r in warc.histories(spark.createDataFrame(index[["url_key", "payload_digest", "position", "captured_at"]])).collect()}
    assert (out["com,example)/a?b=1"].n_captures, out["com,example)/a?b=1"].n_versions) == (2, 1) and out["b,a)/"].n_captures == 3


def test_empty_table(spark, tmpdir_path):
    warc.write_warc(spark.createDataFrame([], PAGES), f"{tmpdir_path}/none")
    assert warc.capture_index(warc.read_warc(spark, f"{tmpdir_path}/none")).count() == 0


def test_url_keys(spark):
    want = {"http://www.Example.com/A?b=1#c": "com,example)/A?b=1", "https://u:p@x.y.org:8443": "org,y,x:8443)/", "HTTP://a.b:80?q=1": "b,a)/?q=1",
            "www2.a.b/x": "b,a)/x", "": ")/", None: "", "http://a.b:443/@x": "b,a)/@x"}
    df = spark.createDataFrame([(u,) for u in want], "u string")
    assert {r.u: r.k for r in df.select("u", warc.url_key(df.u).alias("k")).collect()} == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 20)).map(sorted), min_size=1, max_size=9))
def test_loser_tree(runs):
    got = list(warc.LoserTree([[(x, i) for x in run] for i, run in enumerate(runs)]))
    assert got == sorted((x, i) for i, run in enumerate(runs) for x in run)

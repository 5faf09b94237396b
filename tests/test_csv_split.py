"""The splitting CSV reader against Spark's multi-line reader, with splits of a few bytes."""

import os

import pytest
from hypothesis import HealthCheck, Phase, given, settings, strategies as st

from scrubjay.sources import csv_split
from scrubjay.sources.csv_split import csv_lines, csv_records, read_csv_splits, safe_names
from scrubjay.sources.sinks import write_table
from scrubjay.sources.tables import read_table


@pytest.fixture
def tiny_splits(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


def both(spark, path, **options):
    a, b = read_csv_splits(spark, path, **options), read_table(spark, path, fmt="csv", **options)
    assert a.columns == b.columns
    key = lambda r: tuple((x is None, x or "") for x in r)
    return sorted(map(key, map(tuple, a.collect()))), sorted(map(key, map(tuple, b.collect())))


def put(folder, data: str | bytes, name="a.csv"):
    with open(f"{folder}/{name}", "wb") as f:
        f.write(data.encode() if isinstance(data, str) else data)
    return f"{folder}/{name}"


def field(text: str | None, quote: bool) -> str:
    if text is None:
        return ""
    return '"' + text.replace('"', '""') + '"' if quote or text == "" or any(c in text for c in ',"\r\n') else text


CELL = st.one_of(st.none(), st.text(st.sampled_from('ab,"\n\r é '), max_size=12))


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck), phases=[Phase.explicit, Phase.generate])
@given(st.lists(st.lists(st.tuples(CELL, st.booleans()), min_size=3, max_size=3), min_size=1, max_size=25), st.sampled_from(["\n", "\r\n"]),
       st.booleans(), st.integers(0, 2))
def test_fuzz_equals_multiline(spark, tmp_path_factory, tiny_splits, rows, end, last, blank):
    """Quoted quotes, separators, line breaks of both kinds, empty and missing fields, blank lines, no last line break."""
    folder = str(tmp_path_factory.mktemp("csv"))
    lines = ["h1,h2,h3", *(",".join(field(t, q) for t, q in r) for r in rows)]
    put(folder, (end * (1 + blank)).join(lines) + (end if last else ""))
    got, want = both(spark, folder)
    assert got == want


HARD = {
    "stray quotes in plain fields": 'a,b\nx"y,1\n5" pipe,"q"\nit"s,"open\nhere"\nz,9\n',
    "text after a closing quote": 'a,b\n"x"y,1\n"u\nv"w,2\n"p""q" ,3\nr,4\n',
    "a record over many splits": 'a,b\n1,"' + "long line of text\n" * 40 + '"\n2,"x"\n',
    "only quotes": 'a,b\n"",""""\n"""""",""\n"\n""\n","\n"\n',
    "short and long records": 'a,b\n1\n1,2,3\n,\n"",\n',
    "blank lines": '\n\n\na,b\n\n1,2\n\n\n3,"\n\n"\n\n',
    "quoted header": '"a\nb","c,""d"""\n1,2\n',
    "repeated and empty names": 'x,X,,y\n1,2,3,4\n',
    "byte order mark": '﻿a,b\n1,2\n',
    "wide characters": 'a,b\n"é漢\n😀",ü\nß,"\n"\n',
}


@pytest.mark.parametrize("name", sorted(HARD))
def test_hard_files(spark, tmpdir_path, tiny_splits, name):
    got, want = both(spark, put(tmpdir_path, HARD[name]))
    assert got == want and got


def test_line_breaks_can_be_kept(spark, tmpdir_path, tiny_splits):
    path = put(tmpdir_path, 'a,b\r\n"1\r\n2\n3\r4",x\r\n')
    assert [tuple(r) for r in read_csv_splits(spark, path, keep_breaks=True).collect()] == [("1\r\n2\n3\r4", "x")]
    assert [tuple(r) for r in read_csv_splits(spark, path).collect()] == [("1\n2\n3\r4", "x")]


def test_open_quote_ends_with_its_file(spark, tmpdir_path, tiny_splits):
    """A quote that is never closed takes the rest of its own file and nothing of the next."""
    put(tmpdir_path, 'a,b\n1,2\n3,"open\n4,5\n6,7\n')
    put(tmpdir_path, "a,b\n8,9\n", "b.csv")
    got = read_csv_splits(spark, tmpdir_path)
    assert got.count() == 3 and {r.a for r in got.collect()} == {"1", "3", "8"}


def test_other_separator_schema_and_no_header(spark, tmpdir_path, tiny_splits):
    path = put(tmpdir_path, '1;"a;\nb"\n2;c\n3;"d"";"\n')
    for options in ({"sep": ";", "header": "false"}, {"sep": ";", "header": "false", "schema": "n int, t string"}):
        got, want = both(spark, path, **options)
        assert got == want and len(got) == 3
    with pytest.raises(ValueError):
        read_csv_splits(spark, path, sep=";;")


def test_many_files_with_headers(spark, tmpdir_path, tiny_splits):
    df = spark.range(200).selectExpr("id", "concat('\"', id, '\n\n', id, '\",') AS t", "if(id % 3 = 0, null, '') AS e").repartition(5)
    write_table(df, f"{tmpdir_path}/t.csv")
    got, want = both(spark, f"{tmpdir_path}/t.csv")
    assert got == want and len(got) == 200


def test_one_file_is_read_by_many_tasks(spark, tmpdir_path, tiny_splits):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    path = put(tmpdir_path, "a,b\n" + "".join(f'{i},"{i}\n{i}"\n' for i in range(20_000)))
    assert csv_lines(spark, path).rdd.getNumPartitions() >= os.path.getsize(path) // 20_000
    assert read_table(spark, path).rdd.getNumPartitions() == 1
    out = read_csv_splits(spark, path)
    assert out.count() == 20_000 and out.where("b <> concat(a, '\n', a)").count() == 0


def test_read_table_splits_large_files_only(spark, tmpdir_path, tiny_splits):
    small, large = put(tmpdir_path, "a,b\n1,2\n", "s.csv"), put(tmpdir_path, 'a,b\n' + '1,"x\ny"\n' * 50, "l.csv")
    plans = {p: read_table(spark, p, split_csv=True) for p in (small, large)}
    assert "from_csv(" in plans[large]._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "from_csv(" not in plans[small]._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plans[large].count() == 50 and plans[small].count() == 1
    assert read_table(spark, large, split_csv=True, where="a = '2'").count() == 0


def test_records_of_complete_lines_are_not_grouped(spark, tmpdir_path, tiny_splits):
    """Only the lines of broken records go through the aggregation."""
    path = put(tmpdir_path, 'a,b\n1,"x"\n2,"y\nz"\n')
    plan = csv_records(csv_lines(spark, path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list") == 1 and "raise_error" in plan
    assert sorted(r.record for r in csv_records(csv_lines(spark, path)).collect()) == ['1,"x"', '2,"y\nz"', "a,b"]


def test_records_over_batches(spark, tmpdir_path, tiny_splits):
    """Records that run over the Arrow batches of a split, and over splits."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        for k, text in enumerate(HARD.values()):
            text += '7,"x\n\n\ny""z\n"\n8,9\n' * 12
            got, want = both(spark, put(tmpdir_path, text.replace("\n", "\r\n") if k % 2 else text, f"{k}.csv"))
            assert got == want and got
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_texts_are_neither_sorted_nor_held_by_windows(spark, tmpdir_path, tiny_splits):
    path = put(tmpdir_path, "a,b\n" + '1,"x\ny"\n' * 50)
    plan = csv_records(csv_lines(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and not any("value#" in line for line in plan.splitlines() if "Sort [" in line)


def test_header_is_read_from_the_first_lines(spark, tmpdir_path, tiny_splits, monkeypatch):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    for name in ("a b.csv", "b.csv"):
        put(tmpdir_path, '"p\nq",r\n' + "".join(f'{i},"{i}\n{i}"\n' for i in range(5_000)), name)
    put(tmpdir_path, "", "0.csv")
    read = []
    plain = csv_records
    monkeypatch.setattr(csv_split, "csv_records", lambda lines, *a: read.append(lines) or plain(lines, *a))
    out = read_csv_splits(spark, tmpdir_path)
    assert out.columns == ["p\nq", "r"] and all(d.count() <= 1000 for d in read[1:]) and out.count() == 10_000


def test_empty_inputs(spark, tmpdir_path):
    path = put(tmpdir_path, "")
    assert read_csv_splits(spark, path, schema="a string").count() == 0
    with pytest.raises(ValueError, match="schema"):
        read_csv_splits(spark, path)
    assert read_csv_splits(spark, put(tmpdir_path, "a,b\n", "h.csv")).collect() == []


def test_names():
    assert safe_names(["a", "", "A", None, "b"]) == ["a0", "_c1", "A2", "_c3", "b"]

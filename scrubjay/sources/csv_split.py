"""Quoted CSV read by many tasks a file.

A line break inside quotes does not end a record, so Spark's multi-line reader takes a file as one task. Here the file is
read as text in splits, and record boundaries are found from the quotes:

1. What a line does to the state "inside quotes or not" is one of four functions (it keeps the state, swaps it, or ends inside
   or outside whatever came before). Functions compose, so a task that reads the lines of a split gives the
   function of the whole split, and the lines at its edges that belong to records of other splits.
2. One row a split is composed over the splits of each file: now every
   split knows the state it starts in, and which record of an earlier split its first lines may continue.
3. The lines are read again, and a task joins those of records that begin and end in its split. Texts are not shuffled, but
   for the records that run over the edges of splits: their lines, only those, are grouped by the record they belong to.

``from_csv`` then parses records exactly as the reader would.
"""

from __future__ import annotations

import csv
import io
import re
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import ship_package
from .tables import CSV_READ_OPTIONS

#: Columns that say where a line comes from.
FILE, SPLIT, LINE = "__file", "__split", "__line"


def csv_lines(spark: SparkSession, path: str, stream: bool = False, **options) -> DataFrame:
    """The physical lines under ``path`` (a batch or a stream): ``value`` and the file and split they stand in. Lines end
    at ``\\n``; a ``\\r`` stays in the line."""
    reader = (spark.readStream if stream else spark.read).option("lineSep", "\n").options(**options)
    return reader.text(path).select("value", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(SPLIT))


def _patterns(sep: str) -> tuple[str, str]:
    """Regexes of lines that end inside quotes, when they start outside or inside. A field that starts with a quote ends at the first
    quote that is not doubled, and what follows up to the separator belongs to it; in other fields a quote is a character. All loops are
    possessive: no backtracking, no recursion."""
    s = re.escape(sep)
    inside = r'[^"]*+(?:""[^"]*+)*+'
    field = rf'(?:"{inside}"[^{s}]*+|[^"{s}][^{s}]*+)?+'
    open_field = rf'(?:{field}{s})*+"{inside}\z'
    return rf"\A{open_field}", rf'\A{inside}(?:\z|"[^{s}]*+{s}{open_field})'


def _line_function(sep: str) -> tuple[Column, Column]:
    """(state after the line if it starts outside, if it starts inside), true being inside."""
    out, ins = _patterns(sep)
    quoted = F.col("value").contains('"')
    return quoted & F.col("value").rlike(out), ~quoted | F.col("value").rlike(ins)


def _after(out: np.ndarray, ins: np.ndarray, start: bool) -> np.ndarray:
    """The state after each of a run of lines."""
    swaps = np.cumsum(out & ~ins)
    at = np.maximum.accumulate(np.where(out == ins, np.arange(len(out)), -1))
    fixed = at >= 0
    return np.where(fixed, out[at], start) ^ ((swaps - np.where(fixed, swaps[at], 0)) % 2 == 1)


def _runs(batches):
    """Batches cut where another split begins, and whether one does. Lines of a split stand together, in order."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        file, split = batch.column(FILE), batch.column(SPLIT).to_numpy()
        moved = (split[1:] != split[:-1]) | pc.not_equal(file.slice(1), file.slice(0, len(file) - 1)).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(moved) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = file[a].as_py(), int(split[a])
            yield batch.slice(a, b - a), key != last
            last = key


def _flags(run: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [run.column(n).to_numpy(zero_copy_only=False).astype(bool) for n in names]


#: What is known of a split for either state at its start: the state at its end, the records that begin in it, and the line at which one begins
#: that is open at its end. Lines to ``head`` continue an earlier record, if it starts inside (null: all do); ``cr`` is of its first line.
SPLIT_ROW = (f"{FILE} string, {SPLIT} long, cr boolean, head long, s_out boolean, n_out long, tail_out long, "
             "s_ins boolean, n_ins long, tail_ins long")


def _split_rows(batches):
    row = None

    def done():
        for h in ("out", "ins"):
            if not row[f"s_{h}"]:
                row[f"tail_{h}"] = None
        return pa.RecordBatch.from_arrays([pa.array([row[n]], t) for n, t in types.items()], names=list(types))

    types = {c.split()[0]: {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}[c.split()[1]] for c in SPLIT_ROW.split(", ")}
    for run, new in _runs(batches):
        out, ins, blank, cr = _flags(run, "__out", "__ins", "__blank", "__cr")
        line = run.column(LINE).to_numpy()
        if new:
            if row:
                yield done()
            row = {FILE: run.column(FILE)[0].as_py(), SPLIT: run.column(SPLIT)[0].as_py(), "cr": bool(cr[0]), "head": None,
                   "s_out": False, "n_out": 0, "tail_out": None, "s_ins": True, "n_ins": 0, "tail_ins": None}
        for h in ("out", "ins"):
            after = _after(out, ins, row[f"s_{h}"])
            outside = ~np.concatenate([[row[f"s_{h}"]], after[:-1]])
            if h == "ins" and row["head"] is None and not after.all():
                row["head"] = int(line[np.argmin(after)])
            if outside.any():
                row[f"tail_{h}"] = int(line[np.flatnonzero(outside)[-1]])
            row[f"n_{h}"] += int((outside & ~blank).sum())
            row[f"s_{h}"] = bool(after[-1])
    if row:
        yield done()


def _records_of_splits(batches):
    """The records that begin and end in a split, in order."""
    state = head = first = False
    open_lines: list[pa.Array] = []  # of a record that began in an earlier batch
    join = lambda lines, at: pc.binary_join(pa.ListArray.from_arrays(pa.array(at, pa.int32()), lines), "\n")
    for run, new in _runs(batches):
        out, ins, blank = _flags(run, "__out", "__ins", "__blank")
        value, n, found = run.column("value"), run.num_rows, []
        if new:
            state = head = run.column("__start")[0].as_py()
            first, open_lines = run.column("__none_before")[0].as_py(), []
        after = _after(out, ins, state)
        before = np.concatenate([[state], after[:-1]])
        a, b = 0, n
        if state:
            a = n if after.all() else int(np.argmin(after)) + 1
            if not head:
                open_lines.append(value.slice(0, a))
            if not after.all():
                if not head:
                    lines = pa.concat_arrays(open_lines)
                    found.append(join(lines, [0, len(lines)]))
                head, open_lines = False, []
        begins = ~before & ~blank
        begins[:a] = False
        if a < n and after[-1]:
            b = int(np.flatnonzero(begins)[-1])
            open_lines = [value.slice(b)]
        keep = (before | begins)[a:b]
        if keep.any():
            at = np.cumsum(keep)[np.flatnonzero(begins[a:b])] - 1
            found.append(join(value.slice(a, b - a).filter(pa.array(keep)), [*at.tolist(), int(keep.sum())]))
        state = bool(after[-1])
        for records in found:
            firsts = np.zeros(len(records), bool)
            firsts[0], first = first, False
            same = [run.column(c).take(pa.array(np.zeros(len(records), np.int64))) for c in (FILE, "__folds")]
            yield pa.RecordBatch.from_arrays([records, *same, pa.array(firsts)], names=["record", FILE, "__folds", "__first"])


#: ``_split_rows`` with the state at the start, the earlier split in which a record that runs into this one begins (null: none has begun), and the line of the open
#: record at its end (``__tail``), which may be the file's first.
KNOWN_ROW = "__f string, __s long, __start boolean, __owner long, __head long, __tail long, __tail_first boolean, __folds boolean"


def _known_of_file(splits: pa.Table) -> pa.Table:
    state, owner, folds, found = False, None, None, []
    for s in splits.sort_by(SPLIT).to_pylist():
        h = "ins" if state else "out"
        folds = s["cr"] if folds is None else folds
        found.append((s[FILE], s[SPLIT], state, owner, s["head"], s[f"tail_{h}"], owner is None and s[f"n_{h}"] == 1, folds))
        state, owner = s[f"s_{h}"], s[SPLIT] if s[f"n_{h}"] else owner
    types = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names=[c.split()[0] for c in KNOWN_ROW.split(", ")])


def csv_records(lines: DataFrame, sep: str = ",", keep_breaks: bool = False) -> DataFrame:
    """The records of ``csv_lines`` as text: ``record``, ``__file`` and ``__first`` (true for a file's first record). The ``\\r`` of a closing line
    break is left out, and empty lines outside quotes are no records. Line breaks inside quotes stay as they are, but, as in
    the multi-line reader, ``\\r\\n`` becomes ``\\n`` there in a file whose first line ends with it (not with ``keep_breaks``). A quote left
    open runs to the end of its file. Lines are read three times and only those of records that run over an edge of splits are shuffled; one
    row a split is broadcast."""
    ship_package(lines.sparkSession)
    out, ins = _line_function(sep)
    flags = [FILE, SPLIT, out.alias("__out"), ins.alias("__ins"), F.col("value").isin("", "\r").alias("__blank")]

    # one row a split: its function, and the records that begin in it for either state at its start
    splits = (lines.select(*flags, F.col("value").endswith("\r").alias("__cr"), F.monotonically_increasing_id().alias(LINE))
              .mapInArrow(_split_rows, SPLIT_ROW))
    known = F.broadcast(splits.groupBy(FILE).applyInArrow(_known_of_file, KNOWN_ROW))

    # lines again, with what is known of their split; a broadcast join leaves them in their order
    folds = F.lit(False).alias("__folds") if keep_breaks else F.col("__folds")
    of_split = (F.col(FILE) == F.col("__f")) & (F.col(SPLIT) == F.col("__s"))
    start = F.coalesce("__start", F.raise_error(F.lit("a CSV file changed while it was read")).cast("boolean"))
    whole = (lines.select("value", *flags).join(known, of_split, "left")
             .select("value", FILE, SPLIT, "__out", "__ins", "__blank", start.alias("__start"), F.col("__owner").isNull().alias("__none_before"), folds)
             .mapInArrow(_records_of_splits, f"record string, {FILE} string, __folds boolean, __first boolean"))
    in_head = F.col("__start") & (F.col("__head").isNull() | (F.col(LINE) <= F.col("__head")))
    in_tail = F.coalesce(F.col(LINE) >= F.col("__tail"), F.lit(False))
    part = (lines.select("value", FILE, SPLIT, F.monotonically_increasing_id().alias(LINE)).join(known, of_split)
            .where(in_head | in_tail)
            .select(FILE, F.when(in_head, F.col("__owner")).otherwise(F.col(SPLIT)).alias("owner"), F.struct(SPLIT, LINE, "value").alias("line"),
                    folds, (~in_head & F.col("__tail_first")).alias("__first")))
    joined = (part.groupBy(FILE, "owner").agg(F.sort_array(F.collect_list("line")).alias("x"), F.bool_or("__first").alias("__first"), F.bool_or("__folds").alias("__folds"))
              .select(F.array_join(F.transform("x", lambda v: v["value"]), "\n").alias("record"), FILE, "__folds", "__first"))
    text = F.when(F.col("__folds"), F.replace("record", F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("record"))
    text = F.when(F.col("__first"), F.regexp_replace(text, r"\A\x{FEFF}", "")).otherwise(text)
    return whole.unionByName(joined).select(text.alias("record"), FILE, "__first").withColumn(
        "record", F.when(F.col("record").endswith("\r"), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record")))


def safe_names(header: list[str | None]) -> list[str]:
    """Column names from a header as Spark's reader gives them: ``_cN`` where empty, a number added where repeated."""
    lower = [(h or "").lower() for h in header]
    return [f"_c{i}" if not h else f"{h}{i}" if lower.count(h.lower()) > 1 else h for i, h in enumerate(header)]


def parse_records(records: DataFrame, schema: StructType | str, header: bool = True, **options) -> DataFrame:
    """The columns of ``schema`` from ``csv_records``; a file's first record is left out if it is a ``header``."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    quoted = lambda n: "`" + n.replace("`", "``") + "`"
    ddl = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    own = {k: str(v) for k, v in {**CSV_READ_OPTIONS, **options, "lineSep": "\n"}.items() if k != "header"}
    rows = records.where("NOT __first") if header else records
    return rows.select(F.from_csv("record", ddl, own).alias("r")).select("r.*")


def _header_cells(record: str, sep: str) -> list[str]:
    return next(csv.reader(io.StringIO(record, newline=""), delimiter=sep), [])


def _first_record(lines: DataFrame, sep: str, keep_breaks: bool) -> str | None:
    """The first record of the first file, in the order of their names, that has one. Of the first files only the first lines
    are read, where a second record begins in them, so the first is whole."""
    for file in sorted(lines.inputFiles())[:10]:
        short = re.sub(r"\A(\w+):///", r"\1:/", file)  # as the lines name it
        own = lines.where(F.col(FILE).isin(short, unquote(short), file) & (F.col(SPLIT) == 0)).limit(1000)
        got = csv_records(own, sep, keep_breaks).orderBy(FILE, F.desc("__first")).take(2)
        if len(got) == 2 and got[0][FILE] == got[1][FILE]:
            return got[0]["record"]
        if got or not own.isEmpty():
            break
    got = csv_records(lines, sep, keep_breaks).where("__first").orderBy(FILE).first()
    return got and got["record"]


def read_csv_splits(spark: SparkSession, path: str, schema: StructType | str | None = None, keep_breaks: bool = False,
                    **options) -> DataFrame:
    """A CSV file or folder, as ``read_table`` reads it, but with as many tasks as its size asks for.

    Columns are text unless ``schema`` is given; without it the names come from the header of the first file (without a header: ``_cN``,
    as many as its first record has). ``header``, ``sep``, ``keep_breaks`` (see ``csv_records``) and the
    reader's null options can be given. Files are UTF-8 and end their
    lines with ``\\n`` or ``\\r\\n``. Compressed files cannot be split and stay one task. An input without records
    is an error unless ``schema`` is given."""
    sep, header = options.get("sep", ","), str(options.pop("header", "true")).lower() == "true"
    if len(sep) != 1 or sep in '"\r\n':
        raise ValueError("sep must be one character other than a quote or a line break")
    lines = csv_lines(spark, path)
    records = csv_records(lines, sep, keep_breaks)
    if schema is None:
        head = _first_record(lines, sep, keep_breaks)
        if head is None:
            raise ValueError(f"no records in {path}: give a schema")
        cells = _header_cells(head, sep)
        names = safe_names(cells) if header else [f"_c{i}" for i in range(len(cells))]
        schema = StructType([StructField(n, StringType()) for n in names])
    return parse_records(records, schema, header, **options)

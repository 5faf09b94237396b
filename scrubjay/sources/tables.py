"""Table readers (S1-S4, S6, S9) and schema helpers (K9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

# The text tokens a pandas CSV reader turns into missing values
# by default. Spark's CSV reader maps a single ``nullValue``, so we read text
# and fold these in explicitly.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# RFC-4180 options: quoted fields may hold newlines and doubled quotes. Without
# these Spark splits records and mangles quotes.
# An unquoted empty field is NULL and a quoted one (``""``) is the empty
# string, so text survives a round trip exactly: the NUL character stands for
# NULL only inside the parser (it never occurs in text CSV).
CSV_READ_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"',
                    "inferSchema": "false", "mode": "PERMISSIVE",
                    "nullValue": "\u0000", "emptyValue": ""}


def _format_for(path: str, fmt: str | None) -> str:
    if fmt:
        return fmt
    p = path.rstrip("/").lower()
    if p.endswith(".parquet"):
        return "parquet"
    if p.endswith(".json") or p.endswith(".jsonl"):
        return "json"
    if p.endswith(".orc"):
        return "orc"
    return "csv"  # .csv and anything unknown, as the listing loader does


def _largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file under ``path``, from its listing alone."""
    return spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] or 0


def split_bytes(spark: SparkSession) -> int:
    """Bytes of a file that a task reads at most."""
    return spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()


def read_table(spark: SparkSession, path: str, fmt: str | None = None,
               schema=None, where: str | Column | None = None,
               columns: list[str] | None = None, split_csv: bool = False,
               **options) -> DataFrame:
    """Read a table, picking the reader from the suffix.

    CSV is read as text with the RFC-4180 options (S2). Spark's multi-line reader
    takes a file as one task; with ``split_csv``, an input with a file larger than a split is read by
    ``csv_split.read_csv_splits``, which gives the same rows with a task a split and a shuffle
    of records over the edges of splits alone. ``where``/``columns`` are applied right after the
    scan so Catalyst pushes them into the Parquet reader (S6).
    """
    f = _format_for(path, fmt)
    from .publish import readable_path

    path = readable_path(spark, path) or path  # an output whose replacement was cut off
    if f == "csv" and split_csv and _largest_file(spark, path) > split_bytes(spark):
        from .csv_split import read_csv_splits

        df = read_csv_splits(spark, path, schema, **options)
        df = df if where is None else df.filter(where)
        return df.select(*columns) if columns else df
    r = spark.read
    if f == "csv":
        r = r.options(**CSV_READ_OPTIONS)
    if options:
        r = r.options(**options)
    if schema is not None:
        r = r.schema(schema)
    df = r.format(f).load(path)
    if where is not None:
        df = df.filter(where)
    if columns:
        df = df.select(*columns)
    return df


def filtered_scan(df: DataFrame, column: str, missing: bool = True) -> DataFrame:
    """``SELECT * WHERE column IS [NOT] NULL``."""
    c = F.col(column)
    return df.filter(c.isNull() if missing else c.isNotNull())


def require_columns(df: DataFrame, cols) -> DataFrame:
    """Fail before any action when a required column is absent."""
    for c in ([cols] if isinstance(cols, str) else cols):
        if c not in df.columns:
            raise ValueError(f"Input data must contain a '{c}' column")
    return df


def normalize_na(df: DataFrame, cols: list[str] | None = None,
                 tokens: list[str] = NA_TOKENS) -> DataFrame:
    """Turn the NA tokens into NULL in string columns (S3). Exact match: a
    single space stays text, as in pandas."""
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    targets = set(cols) if cols is not None else strings
    toks = F.array(*[F.lit(t) for t in tokens])
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in targets and f.name in strings:
            c = F.when(~F.array_contains(toks, c), c).alias(f.name)
        out.append(c)
    return df.select(*out)


def typed_load(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast listed columns with ``try_cast`` (bad text -> NULL, row kept),
    keep the rest (K9). Text such as ``6 cylinders`` becomes NULL in a numeric
    column — keep the original text column if that matters (D6)."""
    out = []
    for name in df.columns:
        c = F.col(f"`{name}`")
        if name in types:
            numeric_from_text = (dict(df.dtypes)[name] == "string"
                                 and types[name].lower() not in ("string", "varchar"))
            src = F.trim(c) if numeric_from_text else c
            c = src.try_cast(types[name]).alias(name)
        out.append(c)
    return df.select(*out)

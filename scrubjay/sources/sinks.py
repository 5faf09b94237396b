"""Writers (K1-K6): format by suffix, overwrite policy, verify by read-back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from .publish import readable_path, stage
from .tables import _format_for

# Spark's CSV writer trims values by default; keep text exactly as it is.
CSV_WRITE_OPTIONS = {"header": "true", "escape": '"', "quoteAll": "false",
                     "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_table(df: DataFrame, target: str, mode: str = "errorifexists",
                fmt: str | None = None, partition_by: list[str] | None = None,
                **options) -> None:
    """One distributed write; a directory of part files (K1, K2).

    ``mode``: ``overwrite`` / ``errorifexists`` (K3) / ``append`` (K6).
    Suffix picks the format; anything else is CSV with header. An existing output is
    overwritten as a whole when the new one is complete (``publish``): a
    failed write leaves it as it was.
    """
    f = _format_for(target, fmt)
    options = ({**CSV_WRITE_OPTIONS} if f == "csv" else {}) | options
    if mode == "overwrite" and "partitionOverwriteMode" not in options and readable_path(df.sparkSession, target):
        stage(df, target, f, partition_by, checksum=False, **options).publish()
        return
    w = df.write.mode(mode).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.format(f).save(target)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file/object/folder exists on any Hadoop file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def probe_targets(spark: SparkSession, file: str | None = None, uri: str | None = None,
                  table: str | None = None) -> dict[str, bool]:
    """Which of the given outputs are there already: a file, an object-store URI,
    a catalog table (K3)."""
    found = {}
    if file is not None:
        found["file"] = path_exists(spark, file)
    if uri is not None:
        found["uri"] = path_exists(spark, uri)
    if table is not None:
        found["table"] = spark.catalog.tableExists(table)
    return found


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes stored under a path (file or folder), from the file system's
    metadata; -1 when absent. Used to decide broadcasts on a proven size."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return -1
    return int(fs.getContentSummary(p).getLength())


def put_and_verify(df: DataFrame, uri: str, overwrite: bool = False,
                   fmt: str | None = None) -> bool:
    """Object-store put (K4): refuse (False) when present and not overwriting. The rows are written
    beside ``uri`` and read back; only if their count and order-free checksum
    are those observed on the write do they take its place, else the
    old object stays and the result is False. The data is computed once."""
    if readable_path(df.sparkSession, uri) and not overwrite:
        return False
    f = _format_for(uri, fmt)
    staged = stage(df, uri, f, **(CSV_WRITE_OPTIONS if f == "csv" else {}))
    if not staged.verify():
        staged.drop()
        return False
    staged.publish()
    return True


def load_table(df: DataFrame, name: str, mode: str = "errorifexists",
               types: dict[str, str] | None = None) -> int:
    """Warehouse load (K5): optional typed cast pass, ``saveAsTable`` with
    ``overwrite`` (truncate) / ``errorifexists`` (empty only) / ``append``;
    returns the loaded row count. An overwritten table stays until its
    successor has been written and counted."""
    from pyspark.sql import Observation, functions as F
    from ..session import observed
    from .tables import typed_load

    spark = df.sparkSession
    if types:
        df = typed_load(df, types)
    replace = mode == "overwrite" and spark.catalog.tableExists(name)
    # an existing table is dropped when its successor is complete
    target = f"{name}__staging_{uuid.uuid4().hex[:12]}" if replace else name
    obs = Observation("load")
    try:
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists" if replace else mode).saveAsTable(target)
        rows = int(observed(obs, "rows")["rows"])
        if replace:
            if spark.table(target).count() != rows:
                raise RuntimeError(f"{name}: the table read back does not have the {rows} rows written")
            spark.sql(f"DROP TABLE {name}")
            spark.sql(f"ALTER TABLE {target} RENAME TO {name}")
    except Exception:
        if replace and spark.catalog.tableExists(name):
            spark.sql(f"DROP TABLE IF EXISTS {target}")
        raise
    return rows

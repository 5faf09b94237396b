"""Publishing a folder or a table as a whole (K2-K5).

New output is written beside its target, into a hidden staging folder; a marker with the row count and a checksum
is put there when it is complete, and only then does it take the target's place. A write that dies before
the marker leaves the old output as it was. A swap that dies between its two renames leaves the old output under a
hidden name and the new one complete: ``recover`` finishes it, and readers find the new one meanwhile (``readable_path``).

The checksum is a sum of row hashes, so it depends neither on the order of rows nor on how they are
split into files, and it is taken on the write itself.

A rename is atomic on HDFS and local disks; on stores where it copies, readers may see a folder grow. One writer a target at a time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import MapType, TimestampNTZType, TimestampType

from ..session import observed

MARKER = "_PUBLISHED"  # hidden from Spark's readers by its first character


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _sibling(target: str, what: str) -> str:
    parent, _, name = target.rstrip("/").rpartition("/")
    return f"{parent}/.{name}.{what}" if parent or target.startswith("/") else f".{name}.{what}"


def _hashed(df: DataFrame, as_text: bool) -> Column:
    """A hash of a row. Maps are compared by their sorted entries; ``as_text`` hashes what a text file holds."""
    cols = []
    for f in df.schema.fields:
        c = F.col("`" + f.name.replace("`", "``") + "`")
        c = F.sort_array(F.map_entries(c)) if isinstance(f.dataType, MapType) else c
        c = c.cast("string") if as_text else c
        # null and its neighbours must not look alike: a null adds nothing to a hash
        cols += [c, c.isNull()]
    return F.xxhash64(*cols) if cols else F.lit(0).cast("long")


def content(df: DataFrame, as_text: bool = False) -> tuple[Column, Column]:
    """(rows, checksum) as aggregates."""
    return (F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(_hashed(df, as_text).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("checksum"))


def _texts(df: DataFrame) -> DataFrame:
    """Time stamps as the text a cast gives, so a text file holds what its checksum was taken of."""
    return df.select(*[F.col(f"`{f.name}`").cast("string").alias(f.name) if isinstance(f.dataType, (TimestampType, TimestampNTZType)) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


class Staged:
    """A complete output that waits for its place: where it is, its rows and checksum."""

    def __init__(self, spark: SparkSession, target: str, fmt: str, path: str, rows: int, checksum: str, df: DataFrame):
        self.spark, self.target, self.fmt, self.path, self.rows, self.checksum = spark, target, fmt, path, rows, checksum
        self.schema = df.schema

    def verify(self) -> bool:
        """Whether what storage gives back has the rows and the checksum that were written."""
        text = self.fmt == "csv"
        from .tables import read_table

        back = read_table(self.spark, self.path, fmt=self.fmt, schema=None if text else self.schema) if self.rows else None
        if back is None:
            return self.checksum == "0"
        got = back.agg(*content(back, text)).first()
        return (got["rows"], got["checksum"]) == (self.rows, self.checksum)

    def publish(self) -> None:
        """Mark as complete and take the target's place."""
        fs, at = _fs(self.spark, f"{self.path}/{MARKER}")
        out = fs.create(at, True)
        out.write(json.dumps({"rows": self.rows, "checksum": self.checksum}).encode())
        out.close()
        swap(self.spark, self.path, self.target)

    def drop(self) -> None:
        fs, at = _fs(self.spark, self.path)
        fs.delete(at, True)


def stage(df: DataFrame, target: str, fmt: str, partition_by: list[str] | None = None, checksum: bool = True, **options) -> Staged:
    """Write ``df`` beside ``target``. The rows are computed once: count and checksum are observed on the write."""
    spark = df.sparkSession
    text = fmt == "csv"
    df = _texts(df) if text and checksum else df
    path = _sibling(target, f"staging-{uuid.uuid4().hex[:12]}")
    obs = Observation("staged")
    rows, digest = content(df, text)
    watched = df.observe(obs, rows, digest) if checksum else df.observe(obs, rows)
    w = watched.write.options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    try:
        w.format(fmt).save(path)
    except Exception:
        fs, at = _fs(spark, path)
        fs.delete(at, True)
        raise
    m = observed(obs, "rows", "checksum") if checksum else observed(obs, "rows")
    return Staged(spark, target, fmt, path, int(m["rows"]), str(m.get("checksum") or 0), df)


def swap(spark: SparkSession, staged: str, target: str) -> None:
    """Put a complete staging folder in the place of ``target``; the old output goes last."""
    fs, to = _fs(spark, target)
    recover(spark, target)
    old = None
    if fs.exists(to):
        old = _fs(spark, _sibling(target, f"replaced-{uuid.uuid4().hex[:12]}"))[1]
        if not fs.rename(to, old):
            raise OSError(f"cannot move {target} aside")
    if not fs.rename(_fs(spark, staged)[1], to):
        if old is not None:
            fs.rename(old, to)
        raise OSError(f"cannot move {staged} to {target}")
    if old is not None:
        fs.delete(old, True)


def _left_behind(spark: SparkSession, target: str) -> tuple[list[str], list[str]]:
    """Complete staging folders and replaced outputs beside ``target``."""
    fs, _ = _fs(spark, target)
    jvm = spark.sparkContext._jvm
    find = lambda what: [s.getPath() for s in (fs.globStatus(jvm.org.apache.hadoop.fs.Path(_sibling(target, what))) or [])]
    done = [p.toString() for p in find("staging-*") if fs.exists(jvm.org.apache.hadoop.fs.Path(p, MARKER))]
    return done, [p.toString() for p in find("replaced-*")]


def readable_path(spark: SparkSession, target: str) -> str | None:
    """``target``, or, where a swap was cut off, the folder that holds its content; None if there is neither."""
    fs, to = _fs(spark, target)
    if fs.exists(to):
        return target
    done, old = _left_behind(spark, target)
    return (done if done and old else old or [None])[0]


def recover(spark: SparkSession, target: str) -> bool:
    """Finish a swap that was cut off. Returns whether there was one."""
    fs, to = _fs(spark, target)
    done, old = _left_behind(spark, target)
    if not old:
        return False
    if not fs.exists(to):
        fs.rename(_fs(spark, (done or old)[0])[1], to)
    for p in old:
        fs.delete(_fs(spark, p)[1], True)
    return True

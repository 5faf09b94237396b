"""File-arrival streams.

* ``stream_clean``: each new ``*.csv`` file in a folder is cleaned and written to
  ``sink/batch_id=N``; the checkpoint remembers which files are done, so
  reruns only process new files (S8, T1).
* ``stream_enrich`` runs three streams in turn, each with a checkpoint of its own:

  1. *land*: a micro-batch of CSV goes to ``landed/batch_id=N``, its distinct keys to ``postings/batch_id=N``;
  2. *look up*: postings pass a streaming ``dropDuplicates`` on the key. Its state (kept by key, in RocksDB)
     is the set of seen keys (T3), so a key leaves it once; transient failures of
     earlier micro-batches come back as a second input (D5). Results go to ``cache/batch_id=M``;
  3. *resolve*: a stream-stream join of postings and results on the key. Both sides are state, so a new posting meets old results and a
     new result the micro-batches that hold its key (T5): only these are merged, into ``out/batch_id=N``.

  So the work of a run follows its own keys; no step reads the landed rows, the postings or the results of
  earlier runs again, but for the landed folders it merges. All folders are written by micro-batch id, so a
  replay leaves neither duplicates nor gaps (D4).

A micro-batch takes files up to a byte bound, and a large CSV file is read by many tasks (``sources.csv_split``).

Lookup tables have one order for all writers: a final result beats a transient
failure, then the latest ``looked_up_at`` wins.
"""

from __future__ import annotations

import time
from typing import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions.json import ERR_REQUEST_PREFIX, ERR_TIMEOUT
from ..operators.cleaning import drop_missing
from ..operators.keys import key_stats
from ..operators.lookup import RESULT_COLUMNS, empty_results
from ..operators.merge import merge_lookup
from ..session import drop_dir, observed
from ..sources.csv_split import FILE, SPLIT, csv_lines, csv_records, parse_records
from ..sources.sinks import path_exists, write_table
from ..sources.tables import CSV_READ_OPTIONS, normalize_na, split_bytes

# Errors worth another attempt on a later run.
TRANSIENT_ERRORS = (ERR_TIMEOUT, ERR_REQUEST_PREFIX.rstrip() + "%")
MAX_BYTES = 1 << 30  # of input in one micro-batch; raise it with the cluster


def land_csv(df: DataFrame, folder: str, rows_per_file: int = 1_000_000) -> None:
    """Write ``df`` as CSV part files (a stand-in for uploads): as many as its
    partitions, more where a partition is large."""
    write_table(df, folder, mode="overwrite", fmt="csv", maxRecordsPerFile=rows_per_file)


def csv_source(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None,
               max_bytes_per_trigger: int | None = MAX_BYTES) -> DataFrame:
    """Stream of the lines of new ``*.csv`` files only (S5, S8); ``csv_rows`` makes rows of a micro-batch. It takes
    files up to ``max_bytes_per_trigger``, each read in splits, or a number of files if
    ``max_files_per_trigger`` is given."""
    options = {"pathGlobFilter": "*.csv"}
    if max_files_per_trigger:
        options["maxFilesPerTrigger"] = max_files_per_trigger
    elif max_bytes_per_trigger:
        options["maxBytesPerTrigger"] = max_bytes_per_trigger
    return csv_lines(spark, folder, stream=True, **options)


def csv_rows(batch: DataFrame, schema) -> DataFrame:
    """The rows of a micro-batch of ``csv_source``: a file is always in one micro-batch as a whole. Files that are no larger
    than a split go to the multi-line reader, which needs no shuffle; the rows are the same."""
    seen = batch.agg(F.max(SPLIT).alias("last"), F.collect_set(FILE).alias("files")).first()  # the paths the driver has listed
    files = [unquote(f) for f in seen["files"]]
    if files and seen["last"] < split_bytes(batch.sparkSession) and not any(c in f for f in files for c in "*?[]{}\\"):
        return batch.sparkSession.read.schema(schema).options(**CSV_READ_OPTIONS).csv(files)
    return parse_records(csv_records(batch), schema)


def _run_to_end(stream: DataFrame, per_batch, checkpoint: str) -> None:
    q = (stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def stream_clean(spark: SparkSession, src: str, sink: str, checkpoint: str, schema,
                 column: str = "cylinders", max_files_per_trigger: int | None = None,
                 normalize: bool = False, max_bytes_per_trigger: int | None = MAX_BYTES) -> dict:
    """Clean every new CSV file into a Parquet sink, a folder ``batch_id=N`` a micro-batch. Runs until the
    files present at start are done (``availableNow``) and returns the counts of this run.
    ``normalize`` folds text NA tokens into NULL first (S3)."""
    t = {"batches": 0, "rows_in": 0, "filtered_rows": 0}

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        rows = csv_rows(batch, schema)
        if normalize:
            rows = normalize_na(rows)
        # Count before the filter, on the write itself.
        nul = F.count_if(F.col(column).isNull()) if column in rows.columns else F.lit(0).cast("bigint")
        obs = Observation(f"clean-{batch_id}")
        watched = rows.observe(obs, F.count(F.lit(1)).alias("total_rows"), nul.alias("filtered_rows"))
        write_table(drop_missing(watched, column), f"{sink}/batch_id={batch_id}", mode="overwrite", fmt="parquet")
        m = observed(obs, "total_rows", "filtered_rows")
        t["batches"] += bool(m["total_rows"])
        t["rows_in"] += int(m["total_rows"])
        t["filtered_rows"] += int(m["filtered_rows"])

    _run_to_end(csv_source(spark, src, max_files_per_trigger, max_bytes_per_trigger), per_batch, checkpoint)
    return t | {"cleaned_rows": t["rows_in"] - t["filtered_rows"]}


def _transient(col: str = "api_error_message") -> Column:
    t = F.lit(False)
    for pat in TRANSIENT_ERRORS:
        t = t | F.coalesce(F.col(col).like(pat), F.lit(False))
    return t


def _cache(spark: SparkSession, cache: str, exclude_batch: int | None = None) -> DataFrame | None:
    if not path_exists(spark, cache):
        return None
    c = spark.read.parquet(cache)
    return c if exclude_batch is None else c.filter(F.col("batch_id") != exclude_batch)


def append_results(results: DataFrame, cache: str, batch_id: int) -> DataFrame:
    """Write lookup results as a folder of the lookup table, stamped with the time;
    writing the same ``batch_id`` again replaces it. Returns what was written."""
    spark, path = results.sparkSession, f"{cache}/batch_id={batch_id}"
    write_table(results.withColumn("looked_up_at", F.lit(time.time_ns() // 1000)), path,
                mode="overwrite", fmt="parquet")
    return spark.read.parquet(path)


def seen_keys(spark: SparkSession, cache: str, key: str = "VIN",
              exclude_batch: int | None = None) -> DataFrame | None:
    """Keys with a final result in the lookup table (transient failures are
    not final). Just a filtered key scan: the anti-join needs no dedupe."""
    c = _cache(spark, cache, exclude_batch)
    return None if c is None else c.filter(~_transient()).select(key)


def _latest(c: DataFrame, key: str) -> DataFrame:
    """One row per key: a final result before a transient failure, then the latest."""
    cols = [x for x in c.columns if x not in (key, "batch_id")]
    order = F.struct(~_transient(), F.col("looked_up_at"))
    latest = c.groupBy(key).agg(F.max_by(F.struct(*cols), order).alias("_r"))
    return latest.select(key, *[F.col("_r")[x].alias(x) for x in cols])


def read_lookup_cache(spark: SparkSession, cache: str, key: str = "VIN",
                      exclude_batch: int | None = None) -> DataFrame | None:
    """Lookup table, one row per key (see ``_latest``)."""
    c = _cache(spark, cache, exclude_batch)
    return None if c is None else _latest(c, key).drop("looked_up_at")


def compact_cache(spark: SparkSession, cache: str, key: str = "VIN", max_folders: int = 64) -> bool:
    """Rewrite a lookup table of more than ``max_folders`` folders as one. The new
    folder is complete before the old ones go, so a crash in between only leaves rows that
    ``read_lookup_cache`` folds together. Returns whether it was rewritten."""
    c = _cache(spark, cache)
    if c is None:
        return False
    ids = [r[0] for r in c.select("batch_id").distinct().limit(max_folders + 1).collect()]
    if len(ids) <= max_folders:
        return False
    old = c.inputFiles()
    folders = sorted({f.rsplit("/", 1)[0] for f in old})
    write_table(_latest(c, key), f"{cache}/batch_id={time.time_ns() // 1000}", mode="overwrite", fmt="parquet")
    for f in folders:
        drop_dir(spark, f)
    return True


def retry_transient(spark: SparkSession, cache: str,
                    lookup: Callable[[DataFrame], DataFrame], key: str = "VIN") -> DataFrame | None:
    """Look up again the keys whose result is still a transient failure (timeouts,
    request errors) and append them to the lookup table; permanent failures stay (D5).
    Returns the results of the retried keys, or None if there were none.

    Cheap when nothing failed: a filtered scan of the error column (pushed
    into Parquet) finds the candidates first; only those keys are checked for
    a final result."""
    raw = _cache(spark, cache)
    if raw is None:
        return None
    cands = raw.filter(_transient()).select(key).distinct()
    if cands.isEmpty():
        return None
    still = (raw.join(cands, key, "left_semi").groupBy(key)
             .agg(F.bool_and(_transient()).alias("_still")).filter("_still").select(key))
    if still.isEmpty():
        return None
    return append_results(lookup(still), cache, time.time_ns() // 1000)


def _folder_stream(session: SparkSession, folder: str, schema: str) -> DataFrame:
    """Stream of the Parquet files under ``folder/batch_id=N``."""
    fs_path = session.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs_path.getFileSystem(session.sparkContext._jsc.hadoopConfiguration()).mkdirs(fs_path)
    return session.readStream.schema(f"{schema}, batch_id long").parquet(folder)


def stream_enrich(spark: SparkSession, src: str, work: str, schema,
                  lookup: Callable[[DataFrame], DataFrame], key: str = "VIN",
                  value: str = "cylinders", skip_existing: bool = True,
                  max_files_per_trigger: int | None = None,
                  include_metadata: bool = True, retry: bool = True,
                  max_bytes_per_trigger: int | None = MAX_BYTES,
                  state_partitions: int = 8) -> tuple[DataFrame, dict]:
    """Incremental enrichment over arriving CSV files; see the module's text.

    ``lookup(keys_df) -> results_df`` is any lookup operator (table or external); it is called with
    keys that are written already, and its results are written before they are used twice, so
    an external service is called once per key. Returns the enriched table of all runs (empty if nothing has landed) and counters of
    this run: ``batches``, ``unique_keys_processed`` (keys looked up for the first time, A5) and
    ``retried`` (keys whose lookup had failed in a transient way; ``retry`` looks each of them up once more a run).
    ``state_partitions`` is fixed by the first run over ``work``: size it by the number of keys."""
    landed, postings, cache, failed, asked, resolved, out = (
        f"{work}/{x}" for x in ("landed", "postings", "cache", "failed", "asked", "resolved", "out"))
    checkpoint = f"{work}/checkpoint"
    counters = {"batches": 0, "unique_keys_processed": 0, "retried": 0}
    fields = [(key if c == "VIN" else c, t) for c, t in RESULT_COLUMNS]
    result_ddl = ", ".join(f"`{c}` {t}" for c, t in fields) + ", looked_up_at long"
    stateful = spark.newSession()  # settings of the streams that keep state, not of the caller's session
    stateful.conf.set("spark.sql.shuffle.partitions", state_partitions)
    stateful.conf.set("spark.sql.streaming.stateStore.providerClass",
                      "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

    def merge(batch_id: int, found: bool = True) -> None:
        """One landed folder with what has been resolved for it, in any run."""
        rows = spark.read.parquet(f"{landed}/batch_id={batch_id}")
        mine = empty_results(spark).withColumnRenamed("VIN", key)
        if found:
            mine = _latest(spark.read.schema(result_ddl).parquet(f"{resolved}/epoch=*/batch_id={batch_id}"), key).drop("looked_up_at")
        write_table(merge_lookup(rows, mine, key, value, include_metadata),
                    f"{out}/batch_id={batch_id}", mode="overwrite", fmt="parquet")

    def land(batch: DataFrame, batch_id: int) -> None:
        write_table(csv_rows(batch, schema), f"{landed}/batch_id={batch_id}", mode="overwrite", fmt="parquet")
        rows = spark.read.parquet(f"{landed}/batch_id={batch_id}")
        obs = Observation(f"postings-{batch_id}")
        keys = key_stats(rows, key, value, skip_existing).select(key, "needs_lookup")
        write_table(keys.observe(obs, F.count_if("needs_lookup").alias("needed")), f"{postings}/batch_id={batch_id}", mode="overwrite", fmt="parquet")
        counters["batches"] += 1
        if not observed(obs, "needed")["needed"]:
            merge(batch_id, found=False)  # nothing to wait for

    def look_up(batch: DataFrame, batch_id: int) -> None:
        write_table(batch, f"{asked}/batch_id={batch_id}", mode="overwrite", fmt="parquet")
        keys = spark.read.parquet(f"{asked}/batch_id={batch_id}")
        again = keys.filter("again").count()
        total = keys.count()
        if not total:
            return
        found = append_results(lookup(keys.select(key).distinct()).select(*[c for c, _ in fields]), cache, batch_id)
        write_table(found.filter(_transient()).select(key), f"{failed}/batch_id={batch_id}", mode="overwrite", fmt="parquet")
        counters["unique_keys_processed"] += total - again
        counters["retried"] += again

    def resolve(batch: DataFrame, epoch: int) -> None:
        folder = f"{resolved}/epoch={epoch}"
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("batch_id").parquet(folder)
        for r in spark.read.schema(f"{result_ddl}, batch_id long").parquet(folder).select("batch_id").distinct().collect():
            merge(r[0])  # a number a micro-batch

    def lookups() -> None:
        first = (_folder_stream(stateful, postings, f"`{key}` string, needs_lookup boolean").where("needs_lookup")
                 .select(key).dropDuplicates([key]).withColumn("again", F.lit(False)))
        failures = _folder_stream(stateful, failed, f"`{key}` string").select(key, F.lit(True).alias("again"))
        _run_to_end(first.union(failures if retry else failures.where("false")), look_up, f"{checkpoint}/lookup")

    _run_to_end(csv_source(spark, src, max_files_per_trigger, max_bytes_per_trigger), land, f"{checkpoint}/land")
    lookups()
    if retry and counters["unique_keys_processed"] and not spark.read.schema(f"`{key}` string").parquet(failed).isEmpty():
        lookups()  # what has just failed in a transient way
    held = _folder_stream(stateful, postings, f"`{key}` string, needs_lookup boolean").select(F.col(key).alias("_key"), "batch_id")
    results = _folder_stream(stateful, cache, result_ddl).drop("batch_id")
    _run_to_end(results.join(held, F.col(key) == F.col("_key")).drop("_key"), resolve, f"{checkpoint}/resolve")
    if not path_exists(spark, out):
        return merge_lookup(spark.createDataFrame([], schema), empty_results(spark).withColumnRenamed("VIN", key), key, value,
                            include_metadata), counters
    return spark.read.parquet(out).drop("batch_id"), counters

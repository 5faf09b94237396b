"""Lookups that turn distinct keys into one result row per key.

``lookup_table`` re-aims the per-key HTTP call as a join with a decode table
(J4). ``lookup_udf`` is the pluggable external call (U1-U4, U6): distinct
*normalised valid* keys are partitioned and handed to a caller-supplied
``fetch`` inside ``mapInPandas``; partition count is the concurrency, every
attempt keeps to the rate budget, transient errors are retried after a
random pause, and every error is captured as data. Response
bodies come back as text and are decoded JVM-side with ``from_json``.

Both return the result schema below keyed by the *raw* key (D15; the key
column keeps the caller's name): invalid keys get ``Invalid VIN format``
without any lookup.

Note: ``mapInPandas`` is re-run by every action on its output, so callers
that need the results more than once must materialise them (see
``plans.enrich``), never recompute them.
"""

from __future__ import annotations

import json
import random
import time
from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.json import (ERR_INVALID, ERR_NO_RESULTS, ERR_REQUEST_PREFIX, ERR_TIMEOUT,
                              ERR_UNEXPECTED_PREFIX, decode_response, parse_results)
from .keys import split_keys

# The result columns of a lookup.
RESULT_COLUMNS = [
    ("VIN", "string"), ("api_cylinders", "int"), ("api_make", "string"),
    ("api_model", "string"), ("api_year", "string"),
    ("api_engine_displacement", "string"), ("api_fuel_type", "string"),
    ("api_response_time", "double"), ("api_error_message", "string"),
]
API_COLUMNS = [c for c, _ in RESULT_COLUMNS if c != "VIN"]
RESULT_DDL = ", ".join(f"{c} {t}" for c, t in RESULT_COLUMNS)


def empty_results(spark) -> DataFrame:
    """Explicit empty result frame, so merges never fail on no keys."""
    return spark.createDataFrame([], RESULT_DDL)


def lookup_table(keys: DataFrame, attrs: DataFrame, key: str = "VIN",
                 attrs_key: str = "vin_key", on_repeat: str = "error") -> DataFrame:
    """Resolve each raw key against a reference table (J4): one result a key, always.

    ``attrs`` may carry any subset of the ``api_*`` attribute columns (missing ones are NULL). Its rows are
    grouped by ``attrs_key`` on their way into the join, by the partitioning the join needs anyway, so repeated keys are
    found in the same pass: a key that is asked for and has several rows is an error, or, with
    ``on_repeat="pick"``, gets the smallest row in the order of the columns. A row repeated as a whole counts once. Matching uses the
    normalised key; invalid keys never match. Unmatched valid keys record
    ``No results returned from API``. Response time is 0.0 (no remote call).
    """
    if on_repeat not in ("error", "pick"):
        raise ValueError("on_repeat must be 'error' or 'pick'")
    k = split_keys(keys.select(key), key)
    have = set(attrs.columns)
    took = [c for c in API_COLUMNS if c in have and c not in ("api_response_time", "api_error_message")]
    row = F.struct(*[F.col(c) for c in took], F.lit(True).alias("_hit"))
    a = (attrs.groupBy(F.col(attrs_key).alias("_ak")).agg(F.min(row).alias("_low"), F.max(row).alias("_high"))
         .withColumn("_repeated", F.lit(on_repeat == "error") & (F.col("_low") != F.col("_high")))
         .select("_ak", "_repeated", "_low.*"))
    j = k.join(a, (F.col("_norm") == F.col("_ak")) & F.col("_valid"), "left")
    cols = []
    for c, t in RESULT_COLUMNS:
        if c == "VIN":
            cols.append(F.col(key))
        elif c == "api_response_time":
            cols.append(F.lit(0.0).alias(c))
        elif c == "api_error_message":
            cols.append(F.when(~F.col("_valid"), F.lit(ERR_INVALID))
                        .when(F.col("_hit").isNull(), F.lit(ERR_NO_RESULTS))
                        .when(F.col("_repeated"), F.raise_error(F.concat(F.lit(f"repeated {attrs_key}: "), F.col("_ak")))).alias(c))
        elif c in have:
            cols.append(F.col(c).cast(t).alias(c))
        else:
            cols.append(F.lit(None).cast(t).alias(c))
    return j.select(*cols)


# ---------------------------------------------------------------------------
# External lookup (mapInPandas)
# ---------------------------------------------------------------------------

class TransientLookupError(Exception):
    """Raise from ``fetch`` for retryable failures (connection reset, 5xx)."""


class _Pacer:
    """Spaces the calls of one task, shared by its threads: every call, the first
    one and retries included, waits for the next free slot. The first slot lies one interval
    after the start, so a task that follows another in the same core slot
    keeps its distance."""

    def __init__(self, interval: float):
        import threading

        self.interval = interval
        self.next_at = time.monotonic() + interval
        self.lock = threading.Lock()

    def wait(self) -> None:
        if not self.interval:
            return
        with self.lock:
            at = max(time.monotonic(), self.next_at)
            self.next_at = at + self.interval
        time.sleep(max(0.0, at - time.monotonic()))


def _ask(fetch, key, pacer, tries, pause):
    """(body, error) of one key; failures become error texts, never exceptions.
    ``pause(i)`` is how long to wait after the i-th transient failure."""
    error = ERR_TIMEOUT
    for i in range(tries):
        if i:
            time.sleep(pause(i))
        pacer.wait()
        try:
            body = fetch(key)
        except TimeoutError:
            error = ERR_TIMEOUT
        except (TransientLookupError, OSError) as e:
            error = f"{ERR_REQUEST_PREFIX}{e}"
        except Exception as e:  # permanent: no retry
            return None, f"{ERR_UNEXPECTED_PREFIX}{e}"
        else:
            return (json.dumps(body) if isinstance(body, (dict, list)) else body), None
    return None, error


def _make_caller(fetch, interval, tries, shortest, longest, workers, seed, rate=None):
    """``interval`` is the pause between calls of a task; with ``rate`` it is a barrier stage, whose tasks
    all run at a time and share the rate by the number that there are."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from concurrent.futures import ThreadPoolExecutor
        from pyspark import BarrierTaskContext

        pause_of_task = len(BarrierTaskContext.get().getTaskInfos()) / rate if rate else interval
        pacer, rng = _Pacer(pause_of_task), random.Random(seed)

        def pause(i):  # anywhere up to a ceiling that doubles
            return rng.uniform(0.0, min(longest, shortest * 2 ** (i - 1)))

        def timed(key):
            t0 = time.monotonic()
            return (*_ask(fetch, key, pacer, tries, pause), time.monotonic() - t0)

        with ThreadPoolExecutor(max_workers=workers) as pool:
            for pdf in batches:
                keys = list(pdf["_norm"])
                out = list(pool.map(timed, keys))  # order is kept
                yield pd.DataFrame({"_norm": keys, "_body": [o[0] for o in out],
                                    "_call_error": [o[1] for o in out],
                                    "api_response_time": [o[2] for o in out]})
    return run


def lookup_udf(keys: DataFrame, fetch: Callable[[str], object], key: str = "VIN",
               partitions: int | None = None, rate_per_sec: float | None = 5.0,
               max_attempts: int = 3, base_delay: float = 1.0,
               max_delay: float = 30.0, workers: int = 1, seed: int | None = None) -> DataFrame:
    """Per-key external lookup.

    ``fetch(normalised_key) -> body`` returns the response body (JSON text or
    a dict). Raise ``TimeoutError`` / ``TransientLookupError`` /
    ``ConnectionError`` for retryable failures; anything else is recorded as
    ``Unexpected error: ...`` without retry (U6). Retries wait a random time up to a
    ceiling that doubles from ``base_delay`` to ``max_delay`` (U4; ``seed`` fixes it).

    ``partitions`` (default: the session's core slots) x ``workers`` threads
    call at once (U2). ``rate_per_sec`` bounds the calls of the whole job, retries
    included (U3). Where ``partitions`` fit the core slots, the calls are a barrier stage: its tasks all run at the same time,
    learn their number when they start and share the rate by it, so the rate holds, and is reached, whatever
    the cluster has become since the query was built; the stage waits until that many slots are free. More partitions
    run in waves instead, spaced by the slots counted when the query is built.
    """
    slots = max(1, keys.sparkSession.sparkContext.defaultParallelism)
    k = split_keys(keys.select(key), key)
    targets = k.filter("_valid").select("_norm").distinct()
    n = partitions or slots
    targets = targets.repartition(n, "_norm")
    at_once = bool(rate_per_sec) and n <= slots
    interval = min(n, slots) / rate_per_sec if rate_per_sec else 0.0
    called = targets.mapInPandas(
        _make_caller(fetch, interval, max_attempts, base_delay, max_delay, workers, seed, rate_per_sec if at_once else None),
        "_norm string, _body string, _call_error string, api_response_time double", barrier=at_once)
    called = called.withColumn("_parsed", parse_results(F.col("_body")))
    dec = decode_response("_parsed")
    decoded = called.select(
        "_norm", "api_response_time",
        *[F.when(F.col("_call_error").isNull(), v).alias(c) for c, v in dec.items()
          if c != "api_error_message"],
        F.coalesce(F.col("_call_error"), dec["api_error_message"]).alias("_err"))
    j = k.join(decoded, "_norm", "left")
    cols = []
    for c, t in RESULT_COLUMNS:
        if c == "VIN":
            cols.append(F.col(key))
        elif c == "api_response_time":
            cols.append(F.when(F.col("_valid"), F.col(c)).otherwise(F.lit(0.0)).alias(c))
        elif c == "api_error_message":
            cols.append(F.when(~F.col("_valid"), F.lit(ERR_INVALID)).otherwise(F.col("_err")).alias(c))
        else:
            cols.append(F.col(c).cast(t).alias(c))
    return j.select(*cols)

"""Session helpers: a tuned local session for tests/bench and the shared
work folder used to cut lineage (checkpoints, lookup tables, stream state)."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale as much as locally: AQE re-plans joins and
# coalesces shuffle partitions from runtime statistics, splits skewed join
# partitions, and the session time zone is pinned so date functions agree
# with other engines.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "scrubjay",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to roughly input_bytes / 128 MB there (AQE then
    coalesces small ones).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    """One process holds the driver and its tasks, so a local folder is shared."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def drop_dir(spark: SparkSession, path: str) -> None:
    """Remove a work folder that is no longer needed, on any Hadoop file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def work_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh sub-folder of the shared checkpoint folder.

    The cluster names its shared folder in ``spark.checkpoint.dir``; we read
    it from the session. When it is unset, a local session gets a temporary
    folder, registered for the rest of the session; on a cluster this is an
    error, since executors would each write to their own disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="scrubjay-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
        spark.conf.set("spark.checkpoint.dir", base)
    base = base.rstrip("/")
    sub = f"{base}/scrubjay/{name or 'run'}-{uuid.uuid4().hex[:12]}"
    if sub.startswith("/") or sub.startswith("file:"):
        os.makedirs(sub.replace("file:", "", 1), exist_ok=True)
    return sub


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``scrubjay`` importable in Python workers (needed by the external
    lookup's ``mapInPandas``). On a cluster, deploy it with ``--py-files`` or
    an environment instead; this zips the package once per application into
    the shared work folder and registers it with ``addPyFile``."""
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    folder = work_dir(spark, "pyfiles")
    if folder.startswith("/") or folder.startswith("file:"):
        local = folder.replace("file:", "", 1)
    else:
        # a remote shared folder: build the zip on the driver; addPyFile ships
        # it to executors through Spark's file server (like --py-files)
        local = tempfile.mkdtemp(prefix="scrubjay-pyfiles-")
    target = os.path.join(local, "scrubjay.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def observed(obs, *names: str) -> dict:
    """Metrics of an ``Observation`` after its action. An input with no
    partitions emits none; its counts are zero."""
    try:
        got = obs.get
    except Exception:  # no metrics were emitted (empty input)
        got = {}
    return {n: (got.get(n) if got and got.get(n) is not None else 0) for n in names}

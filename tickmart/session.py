"""Session settings and shared scratch locations.

Queries run on a session the caller owns, so :func:`configure` only sets
runtime (session-level) options.  Scratch tables live under the cluster's
``spark.checkpoint.dir``; a local one is created only when none is set
(tests, local runs).
"""

from __future__ import annotations

import contextvars
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session options every tickmart job relies on.
RUNTIME_CONF = {
    # Dates are UTC calendar days; epoch -> date and ts ordering assume it.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A JSON object that repeats a key is read like everywhere: the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def get_session(master: str | None = None, app_name: str = "tickmart",
                shuffle_partitions: int | None = None,
                driver_memory: str | None = None) -> SparkSession:
    builder = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:  # local mode: the driver JVM is the only executor
        builder = builder.config("spark.driver.memory", driver_memory)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the session's checkpoint dir."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured and not re.fullmatch(r"local(\[[^-]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        # Unset in local runs and tests only: make a private one.
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="tickmart-ckpt-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


# The job's run folder is scoped to the calling thread / context, so queries
# running concurrently on the same session keep their own scratch folders.
_RUN: contextvars.ContextVar[str | None] = contextvars.ContextVar("tickmart_run", default=None)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused directory under the shared scratch root, inside
    the current run's folder when a job has opened one."""
    run = _RUN.get()
    base = f"{scratch_root(spark)}/tickmart" + (f"/{run}" if run else "")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def current_run() -> str | None:
    return _RUN.get()


def open_run_scratch(spark: SparkSession, label: str) -> str:
    """Route this context's scratch folders into one run folder; returns it."""
    run = f"{label}-{uuid.uuid4().hex[:12]}"
    _RUN.set(run)
    return f"{scratch_root(spark)}/tickmart/{run}"


def close_run_scratch(spark: SparkSession, folder: str | None, delete: bool) -> None:
    """Stop routing scratch into the run folder; delete it when asked."""
    _RUN.set(None)
    if delete and folder:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

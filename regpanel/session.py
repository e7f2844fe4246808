"""Session helpers.

Tests and the bench build their own local session; on a cluster the
session is supplied by the caller and only ``checkpoint_dir`` is read.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "regpanel",
              extra: dict | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests/bench; memory
    and, beyond one shuffle partition per core, its sizing are the caller's (``extra``)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    if master is None:
        builder = builder.config("spark.sql.shuffle.partitions", cpus)
    for k, v in {**_LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names in spark.checkpoint.dir
    (falling back to the one set on the SparkContext)."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The configured folder that driver and executors share.  Where none is
    set, a cluster raises; a ``local[..]`` session, whose executor is the
    driver itself, gets ``fallback`` or a folder that goes at exit."""
    d = checkpoint_dir(spark)
    if not d:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by driver and executors")
        d = fallback
        if not d:
            d = tempfile.mkdtemp(prefix="regpanel-ckpt-")
            atexit.register(shutil.rmtree, d, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(d)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


_written: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one for a table that cuts lineage; a lazy
    result may still read it, so it stays until :func:`clear_scratch`."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/regpanel-q/{name}/{uuid.uuid4().hex}"
    _written.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Deletes the scratch tables that this process has made; call it once the
    results that read them are written or collected.  Returns how many."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    n = len(_written)
    while _written:
        p = jvm.org.apache.hadoop.fs.Path(_written.pop())
        p.getFileSystem(conf).delete(p, True)
    return n

"""Session settings shared by every job.

`configure` pins what results depend on (the UTC session time zone) and
turns on adaptive execution where the cluster left it unset; it never
overrides cluster-provided sizing.  `scratch_dir` returns the shared checkpoint folder the cluster
names in ``spark.checkpoint.dir``.  Only a local session (tests, the
benchmark) may go without: it gets a temporary folder, removed at exit; on a
cluster an unset folder is an error, since executors do not share disks.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that change results: always pinned.  (Dynamic partition
# overwrite is passed per write, so the caller's session default is kept.)
_PINNED = {
    "spark.sql.session.timeZone": "UTC",
}

# Performance defaults: only applied when the cluster has not set them.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Stream state (URL sets, per-crawl streaks) off the JVM heap.  A query
    # restarted from an existing checkpoint keeps the provider it recorded.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in _PINNED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key, value in _DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def sorted_aggregates(spark: SparkSession):
    """Lists are collected from sorted rows in plans made inside: one sort,
    shared with the join that follows.  The hash form keeps a list a key and,
    past 128 keys, sorts the rows of the partial and of the final step each."""
    return _setting(spark, "spark.sql.execution.useObjectHashAggregateExec", "false")


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "gleaner") -> SparkSession:
    """Local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("GLEANER_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def scratch_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder under the session's shared checkpoint directory.

    On a cluster ``spark.checkpoint.dir`` names shared storage; it is read,
    never replaced.  Where it is unset, a local session gets a temporary
    folder for its lifetime, any other an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="gleaner-ckpt-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    base = base.rstrip("/")
    return f"{base}/{name or 'scratch'}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable (reliable, shared storage)."""
    scratch_dir(spark, "init")


def materialize(df, name: str = "table"):
    """Compute ``df`` once into a Parquet table in the shared checkpoint
    folder and continue from the files: lineage is cut, a lost executor
    costs nothing already written, and (unlike ``Dataset.checkpoint`` on an
    unpersisted plan) the plan runs once, not twice.  Its shuffle files are
    removed at its end, since nothing runs this plan again."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    with _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables) -> None:
    """Delete the files of tables of ``materialize`` that nothing reads again."""
    for df in tables:
        spark = df.sparkSession
        jvm = spark.sparkContext._jvm
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)

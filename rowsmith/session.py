"""Spark session and shared scratch space.

Scratch output (round trips, resume tables, checkpoints) always lives under the
folder the cluster names in ``spark.checkpoint.dir``. Only when that setting is
missing and the master is local (tests, bench) do we make one and set it on the
context, so every later call sees the same folder.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int = 8, shuffle_partitions: int | None = None) -> SparkSession:
    """Session for tests and the benchmark: local mode, AQE on, no UI."""
    shuffle_partitions = shuffle_partitions or cores
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("rowsmith")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        # Checkpoints go when nothing refers to them any more.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # Model calls must not be repeated by speculative copies.
        .config("spark.speculation", "false")
    )
    event_log = os.environ.get("ROWSMITH_EVENT_LOG")
    if event_log:  # stage and task times for later reading, written to a scratch folder
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder.

    It is the folder named by ``spark.checkpoint.dir``, or one already set on
    the context. A machine-local folder is made only for a local master (tests,
    bench); on a cluster executors could not see it, so there the missing
    setting is an error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get(_CHECKPOINT_KEY, None) or spark.conf.get(_CHECKPOINT_KEY, None) or sc.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\[\]]*\])?", sc.master):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="rowsmith-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder path under the shared checkpoint root."""
    return os.path.join(checkpoint_root(spark), "rowsmith", f"{name}-{uuid.uuid4().hex[:12]}")


_FREED_KEY = "spark.sql.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes made inside give back the disk of their own shuffles when they end, not when the driver collects its garbage."""
    before = spark.conf.get(_FREED_KEY, "false")
    spark.conf.set(_FREED_KEY, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREED_KEY, before)


def written(df: DataFrame, name: str = "", path: str | None = None) -> DataFrame:
    """``df`` written once under the shared checkpoint root and read back.

    For plans that read an expensive input more than once: the input runs once,
    and a lost executor costs a task and not the stages before.
    """
    path = path or scratch_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED_KEY = "spark.rowsmith.shippedPyFile"


def ship_package(spark: SparkSession) -> None:
    """Make ``rowsmith`` importable on every executor's Python workers.

    Stages that run Python (the model stage) refer to functions of this
    package; executors get it as a zip via ``addPyFile``, written once per
    session into the shared checkpoint folder through the Hadoop file system
    API (so it works for local, HDFS and object-store folders alike).
    """
    import hashlib
    import io
    import zipfile

    if spark.conf.get(_SHIPPED_KEY, None):
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in sorted(os.walk(pkg_dir)):
            for name in sorted(files):
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    data = buf.getvalue()
    digest = hashlib.sha1(data).hexdigest()[:12]
    target = os.path.join(checkpoint_root(spark), "rowsmith", f"pyfiles-{digest}", "rowsmith.zip")
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(target)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        out = fs.create(hpath, True)
        out.write(bytearray(data))
        out.close()
    spark.sparkContext.addPyFile(hpath.toString())
    spark.conf.set(_SHIPPED_KEY, target)

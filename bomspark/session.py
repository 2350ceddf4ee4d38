"""Session helpers: a sensible local session for tests/bench, and the shared
scratch folder every materialisation goes to.

On a cluster the scratch root is the shared folder named by
``spark.checkpoint.dir``.  A machine-local temp folder stands in for it only
on a ``local`` master (tests, bench); any other master without the setting is
an error, as executors would write where the others cannot read.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"
_OWN: set[str] = set()


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "bomspark", extra: dict | None = None) -> SparkSession:
    """Local session with AQE on and the UI off (tests, bench)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    value = spark.conf.get(_CKPT_KEY, None)
    if value:
        return value
    value = spark.sparkContext.getConf().get(_CKPT_KEY, None)
    if value:
        return value
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    current = _configured_checkpoint_dir(spark)
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all "
                           f"executors share (master is {master})")
    # spark.checkpoint.dir cannot be changed on a running session (it is a
    # core setting); the context's checkpoint folder can, and later calls
    # find it through getCheckpointDir().
    local = tempfile.mkdtemp(prefix="bomspark-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir() or local


def _session_folder(spark: SparkSession) -> str:
    """This application's folder below the scratch root; Hadoop deletes it when
    the driver ends."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    folder = f"{root}/bomspark-scratch/{spark.sparkContext.applicationId}"
    if folder not in _OWN:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _OWN.add(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder.

    Used for landing fixtures, stage tables, round-trip sinks and stream
    checkpoints; each call gets a new folder so runs never see each other's
    files, and all of a session's folders go when its driver ends.
    """
    return f"{_session_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"

"""Session construction and shared-folder helpers.

All intermediate storage (checkpoints, staged stream files, aggregate tables
written by the registered queries) lives below the folder the cluster names in
``spark.checkpoint.dir``.  Only a local-mode session without that setting gets
a fresh private folder (tests and the bench); a cluster session without it is
an error, because a machine-local folder is not shared between executors.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins from runtime sizes
# (a broadcast only below the threshold, a shuffle join beyond it), coalesces
# small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", app: str = "shelfwise",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting it from the session conf.

    Order: the SparkContext's current checkpoint dir, then the
    ``spark.checkpoint.dir`` setting.  Only when neither exists and the
    session runs in local mode is a private folder created.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # unset
            configured = None
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: a shared folder is required on a cluster")
        configured = tempfile.mkdtemp(prefix="shelfwise-ckpt-")
    sc.setCheckpointDir(configured)
    got = sc._jsc.sc().getCheckpointDir()
    return got.get() if got.isDefined() else configured


def scratch_root(spark: SparkSession) -> str:
    """A folder next to the checkpoints for tables the jobs write themselves."""
    base = ensure_checkpoint_dir(spark)
    # the context appends a random sub-folder to the checkpoint dir; keep our
    # tables beside it, under the same shared parent
    parent = base.rstrip("/").rsplit("/", 1)[0] if "/" in base.rstrip("/") else base
    return parent.rstrip("/") + "/shelfwise"


def new_scratch(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder for one run of one job."""
    return f"{scratch_root(spark)}/{name}/{uuid.uuid4().hex}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme (used only by local-mode helpers such as tests)."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)

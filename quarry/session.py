"""Session construction and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package relies on.  AQE re-plans joins at
# runtime: a join side whose *measured* shuffle output is below
# spark.sql.adaptive.autoBroadcastJoinThreshold becomes a broadcast, larger
# ones stay sort-merge, and skewed partitions are split.  That is the
# size-checked broadcast with a fallback; explicit broadcast() hints are only
# used for sides whose size is bounded by parameters, not by data.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "8192",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(total_cores: int) -> dict:
    """Settings for a cluster run, to pass as ``extra`` or via spark-submit.

    Shuffle partitions start at about three per core; AQE then coalesces
    them toward the advisory size and splits skewed ones.  Input splits of
    256 MB keep scan tasks large enough to amortise task start-up while
    staying well inside executor memory.
    """
    return {
        "spark.sql.shuffle.partitions": str(max(200, 3 * total_cores)),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "quarry", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and staged tables.

    Read from ``spark.checkpoint.dir``.  Only a local-mode session (tests,
    the bench) without that setting gets a fresh folder under /tmp; on a
    cluster a machine-local folder would be wrong, so that case raises.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if d:
        return d.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder on a cluster")
    # the setting itself is fixed once a context runs; the context keeps the folder
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quarry-ckpt-", dir="/tmp"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for one run."""
    base = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")

"""Session settings and the shared scratch folder.

Files that an operator has to land (batch files, landed pages, stream
checkpoints) go under the folder the cluster names in
``spark.checkpoint.dir``. A folder is only created here when that setting is
unset, which is the case in local tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings for large inputs: adaptive execution re-plans joins from measured
# sizes, splits skewed shuffle partitions and merges tiny ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Broadcasts come from sizes Spark measured: file sizes on disk at
    # planning time (Spark's default bound), or, for a shuffled side, its
    # materialised size under the adaptive bound.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
}


# Starting point for a large cluster (hundreds of executors, tens of TB):
# many initial shuffle partitions that adaptive execution merges down to about
# the advisory size, larger read splits, a bounded broadcast size and skew
# splitting. spark.checkpoint.dir must name a folder shared by all executors.
LARGE_SCALE_CONF = {
    **SCALE_CONF,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app_name: str = "annotask", extra=None):
    """A session for tests and the benchmark (no UI)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and landed files.

    Read from the session; only when none is named and the master is local
    (tests, local runs) is a fresh folder made and registered. On a cluster
    an unset folder is an error: a machine-local folder would not survive
    the loss of that machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    try:
        sc = spark.sparkContext  # absent in a Spark Connect session
    except Exception:  # noqa: BLE001
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors") from None
    root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="annotask-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder name under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/annotask/{name}-{uuid.uuid4().hex[:12]}"

"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that may be changed on a running session. Nothing here depends on the data size:
# partition counts are left to adaptive execution, which splits and merges by measured bytes.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where that costs one more exchange above the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Parquet is compressed: judge a side by about four times its file size before it is broadcast.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


_own_folder: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on to an existing session."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cpus: int | str = "*", memory: str = "12g", shuffle_partitions: int = 8):
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("transit_engine")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        # Do not record the Python call site of every column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for name, value in RUNTIME_SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, where the cluster names one,
    or the session's checkpoint directory.

    Without either, a session on one machine (a laptop, a test) gets a temporary folder, removed
    when Python ends; on a cluster that would lose what the executors write, so it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"no shared folder: set spark.checkpoint.dir (master {master})")
    if "path" not in _own_folder:
        _own_folder["path"] = tempfile.mkdtemp(prefix="transit-")
        atexit.register(shutil.rmtree, _own_folder["path"], ignore_errors=True)
    return _own_folder["path"]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; each call gives a new one."""
    return f"{shared_folder(spark)}/transit_engine/{name}-{uuid.uuid4().hex[:12]}"

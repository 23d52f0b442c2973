"""Session construction and shared-storage helpers.

Library code never creates its own session; it works with whatever session the
caller passes. ``build_session`` is for tests, the bench and command-line runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

from .functions.crypto import PAD_REDACTION

# Settings that matter for correctness or for the plans this library relies on.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.redaction.string.regex": PAD_REDACTION,
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "ledgerlake", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint = ensure_checkpoint_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(checkpoint)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; intermediate tables are written below it.

    On a cluster the setting must name shared storage; without it this raises. Only a session in
    local mode (one JVM on one machine) gets a fresh local folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="ledgerlake-ckpt-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_shipped: dict[str, str] = {}


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the session's Python workers (once per application)."""
    sc = spark.sparkContext
    if _shipped.get(sc.applicationId):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(here):  # else the package already comes from a zip that was shipped
        out = os.path.join(tempfile.mkdtemp(prefix="ledgerlake-zip-"), "ledgerlake.zip")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in sorted(os.walk(here)):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.join("ledgerlake", os.path.relpath(full, here)))
        sc.addPyFile(out)
    _shipped[sc.applicationId] = here


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint dir for one job run."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "ledgerlake", f"{name}-{uuid.uuid4().hex[:12]}")


def cluster_conf(input_bytes: int, cores: int, partition_bytes: int = 256 << 20) -> dict:
    """Settings sized for a job that reads ``input_bytes`` on ``cores`` executor cores.

    Scan splits and shuffle partitions target ``partition_bytes`` each, so a task's data fits
    in executor memory without spilling; shuffle partitions are a multiple of the cores (whole
    waves) and AQE coalesces the ones that come out small. Skewed partitions above four
    times the target are split by AQE; stream state lives in RocksDB (off the JVM heap).
    """
    cores = max(1, cores)
    wanted = -(-input_bytes // partition_bytes)
    shuffle = min(max(wanted, 2 * cores), 20 * cores)
    shuffle = -(-shuffle // cores) * cores
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }

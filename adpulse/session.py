"""Session construction and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every job relies on: UTC session time (event timestamps are
# zone-less), adaptive execution for partition coalescing and skew, and the
# RocksDB state store so streaming state lives off-heap and scales with keys.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "adpulse", extra: dict | None = None) -> SparkSession:
    """Local or cluster session with the defaults above.

    On a cluster leave ``master`` unset and size ``spark.sql.shuffle.partitions``
    to the data (roughly input bytes / 128 MB); AQE coalesces small ones.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", os.environ.get("ADPULSE_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    The cluster names its shared folder in ``spark.checkpoint.dir``; it is
    read from the session. Only when it is unset and the master is local
    (tests) a temporary folder is created and registered as the checkpoint
    directory; a cluster without the setting is an error.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="adpulse-ckpt-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    return f"{base.rstrip('/')}/adpulse/{name}-{uuid.uuid4().hex[:12]}"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors once per application, for
    the functions and classes that their Python workers import."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix=f"{package.name}-"), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def materialize(df):
    """Cut lineage: write ``df`` to the shared checkpoint folder and read it
    back (reliable ``checkpoint``, so it survives executor loss). Used for small
    intermediates that several branches of one query read, so the raw scan
    and shuffle behind them run once."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        work_dir(df.sparkSession, "checkpoint")  # registers a folder when unset (tests)
    return df.checkpoint(eager=True)

"""Session helpers.

The library never assumes it owns the session: cluster jobs pass their own
``SparkSession``.  ``get_spark`` is for tests, benchmarks and notebooks.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # live sessions: a task merges its own rows before the exchange
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # state for the streaming processors (transformWithStateInPandas needs RocksDB)
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(master: str | None = None, app: str = "keyflow",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators expect."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and lineage cuts.

    On a cluster ``spark.checkpoint.dir`` names a shared file system folder
    and is used as is (it is required there).  Only in local mode, when it is
    unset (tests), a scratch folder is created and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote sessions have no local context
        sc = None
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        master = spark.conf.get("spark.master", "") or ""
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors "
                             "(a machine-local folder does not survive a lost executor)")
        d = tempfile.mkdtemp(prefix="keyflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - not settable at runtime in every deployment
            pass
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d

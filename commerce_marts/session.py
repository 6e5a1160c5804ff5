"""Session helpers.

Library code never builds its own session; it receives one.  ``get_session``
exists for tests, the bench and local runs.  ``ensure_checkpoint_dir`` reads
``spark.checkpoint.dir`` from the session (a cluster names a shared folder
there) and only falls back to a fresh local folder when nothing is configured,
which is the local-test case.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def get_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                app: str = "commerce_marts") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        # Plan construction: PySpark otherwise captures the Python call stack
        # on every Column/DataFrame call (~4 ms each); the value is read once.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring it if needed.

    Order of preference: an already active checkpoint dir on the context, the
    ``spark.checkpoint.dir`` setting of the session (shared storage on a
    cluster), and only in local mode (tests) a new temp folder; else an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver-side context, use the setting
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc is None or not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="cm-checkpoint-")
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared checkpoint folder for written tables."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/cm-tables/{name}-{uuid.uuid4().hex[:12]}"

"""Session helpers: pinned session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  UTC keeps ``to_timestamp`` on TIMESTAMP_NTZ
# inputs and ``year``/``month`` extraction independent of the host zone.
PINNED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Scale defaults for a fresh session (tests / bench).  On a cluster these
# come from the deployment; AQE re-plans joins and coalesces small shuffles.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str = "local[*]",
    app_name: str = "tollgate",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = {**DEFAULT_CONF, **PINNED_CONF}
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    pin(spark)
    return spark


def pin(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to an existing session."""
    for key, value in PINNED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is configured by the deployment and is visible to
    every executor.  Only when it is unset (unit tests, a laptop) do we set
    one ourselves.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a local context (Spark Connect)
        sc = None
    root = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if not root:
        root = tempfile.mkdtemp(prefix="tollgate-ckpt-")
        if sc is None:
            spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark)
    return f"{root}/tollgate/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for driver-side existence checks in tests."""
    return path[5:] if path.startswith("file:") else path


def exists(path: str) -> bool:
    return os.path.exists(local_path(path))

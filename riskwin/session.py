"""Session helpers: building a local session and finding the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "riskwin") -> SparkSession:
    """Session for tests and the bench. Cluster jobs bring their own."""
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # HotSpot does not JIT methods over 8000 bytecode bytes; a wide
        # projection (35 flags) above that runs interpreted, ~10x slower.
        # With this limit Spark splits such a stage out of whole-stage codegen.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, used as it is.

    Where the setting is missing, a bare local session (as in tests) gets a
    folder of its own; on a cluster that would be a folder that executors don't
    share, so it is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="riskwin-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/riskwin-{name}-{uuid.uuid4().hex[:12]}"

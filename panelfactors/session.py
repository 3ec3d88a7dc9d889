"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "panelfactors") -> SparkSession:
    """A local session configured like the cluster one: AQE on, UI off, UTC."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PANELFACTORS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    use_local_scratch(spark)
    return spark


def use_local_scratch(spark: SparkSession) -> None:
    """Tests, bench and the driver's local runs: a scratch folder where the session names none.

    Only a ``local[...]`` master (one machine, one process) gets it; on a
    cluster the folder must be shared and is the cluster's to name.
    """
    sc = spark.sparkContext
    if not (sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)) and sc.master.startswith("local["):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="panelfactors-"))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session, named by ``spark.checkpoint.dir``; an error where there is none."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            raise ValueError("no shared folder for intermediate tables: set spark.checkpoint.dir to a folder "
                             "that the driver and all executors share")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def session_key(spark: SparkSession) -> tuple:
    """Identity of a session (for per-session shared tables)."""
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001
        app = spark.conf.get("spark.app.id", "app")
    return (app, id(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"

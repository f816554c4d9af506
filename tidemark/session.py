"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cores: int | str = "*", app: str = "tidemark", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.driver.memory": "8g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | conf
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Event times are defined in UTC, whatever zone the session came with."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path for tables and stream checkpoints written on the way.

    It lies in the folder the cluster names in spark.checkpoint.dir, which all executors share. A
    machine-local folder is used only by a local-mode session that names none.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if base is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"

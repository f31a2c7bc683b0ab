"""Spark session and shared-folder helpers.

Every job that cuts lineage (``checkpoint()``) or writes an intermediate
table does it under the folder the cluster names in ``spark.checkpoint.dir``.
We only invent a folder when that setting is absent (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SCRATCH_ENV = "CREDERE_LOCAL_SCRATCH"


def build_session(master: str | None = None, app_name: str = "credere",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session with AQE (coalescing + skew join) and ANSI left on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = os.environ.get(_SCRATCH_ENV) or tempfile.mkdtemp(prefix="credere-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/credere/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once a context: functions that run there import them."""
    sc = spark.sparkContext
    if getattr(sc, "_credere_shipped", False):
        return
    home = Path(__file__).resolve().parent
    if home.is_dir():  # else the package itself was shipped as an archive
        path = Path(tempfile.mkdtemp(prefix="credere-code-")) / "credere.zip"
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted(home.rglob("*.py")):
                z.write(f, f.relative_to(home.parent))
        sc.addPyFile(str(path))
    sc._credere_shipped = True

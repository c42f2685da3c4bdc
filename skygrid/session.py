"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Provider files come in big5 and its relatives, which Spark reads only on request.
    "spark.sql.legacy.javaCharsets": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings every operator relies on (UTC clock, adaptive execution)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str | int = 8, app_name: str = "skygrid", memory: str = "12g") -> SparkSession:
    """Single-JVM session for tests and benchmarks; a cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_BASE: dict[str, str] = {}


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder named by ``spark.checkpoint.dir``.

    Every executor must see the folder, so a machine-local one is made up only
    for a local master that has the setting unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.sparkContext.applicationId
        base = _LOCAL_BASE.get(app) or _LOCAL_BASE.setdefault(app, tempfile.mkdtemp(prefix="skygrid-"))
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"

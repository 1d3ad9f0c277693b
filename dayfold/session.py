"""Session set-up for tests and the benchmark, and the shared folder for written results."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

def local_session(cores: str | int = 8, app: str = "dayfold", **settings: str) -> SparkSession:
    """A local session for tests and the benchmark. On a cluster the caller brings the session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then uses its warehouse folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not (spark.conf.get("spark.master", None) or "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder, never used before."""
    return f"{shared_folder(spark)}/dayfold/{purpose}-{uuid.uuid4().hex}"

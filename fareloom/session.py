"""Where a session keeps the tables it writes on the way, and finds this package."""

from __future__ import annotations

from pathlib import Path
from uuid import uuid4

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[1])
SHARED_DIR = "spark.checkpoint.dir"
WAREHOUSE = "spark.sql.warehouse.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder for scratch tables, one rule for every session.

    It is below the shared folder that the cluster names in `spark.checkpoint.dir`
    or, without that, below the session's warehouse, which a cluster keeps on
    shared storage.
    """
    root = spark.conf.get(SHARED_DIR, None) or spark.conf.get(WAREHOUSE)
    return f"{root.rstrip('/')}/fareloom-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing was written to before."""
    return f"{shared_root(spark)}/{name}-{uuid4().hex[:12]}"


def share_code(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "")
    if ROOT not in paths.split(":"):
        environment["PYTHONPATH"] = f"{paths}:{ROOT}" if paths else ROOT

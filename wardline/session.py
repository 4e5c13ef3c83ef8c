"""Session helpers.

On a cluster the session is created by the platform; these helpers only fill
in settings that are *unset*, so cluster-level choices (shuffle partitions,
checkpoint folder, AQE) always win.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a local test session needs; a cluster session keeps its own.
LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", app: str = "wardline") -> SparkSession:
    """A local[cores] session for tests and the bench, with a scratch checkpoint dir."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.driver.memory", os.environ.get("WARDLINE_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting a scratch one only in a local session without one.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that value is
    used as is.  A cluster session without it raises: a folder of one machine
    would be lost, or unseen, on the others.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="wardline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def ship(spark: SparkSession) -> None:
    """Put the package on the Python workers' path, for the steps that run Python in tasks (a session may start elsewhere)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back.

    Cuts lineage like ``checkpoint()``, but runs the plan once, stores columns
    compressed, and gives the planner true sizes.  Values that depend on the
    partitioning (partition numbers, row tags) are fixed by it.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/wardline-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

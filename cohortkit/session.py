"""Session construction and lineage cuts.

Every operator in the package is a DataFrame -> DataFrame function and does
not need this module. It only exists so that tests, the bench and the entry
file build sessions the same way, and so that long plans can be cut with a
reliable checkpoint in the directory the cluster names.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the oracle comparison depends on (UTC, ANSI) plus the adaptive
# execution features the operators rely on for skewed joins.
SESSION_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "cohortkit", cores: str | int = "*",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Local session for tests and the bench; clusters pass their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    conf["spark.driver.memory"] = os.environ.get("COHORTKIT_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def app_key(spark: SparkSession) -> str:
    """An id of the running application, for per-session caches."""
    try:
        return spark.sparkContext.applicationId
    except Exception:   # sessions without a local SparkContext (Spark Connect)
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, setting one only where none is set.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is. Only a session without it (a bare local test) gets a fresh
    scratch folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:   # Spark Connect: the folder must be configured
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="cohortkit-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def materialize(df: DataFrame, name: str = "cut") -> DataFrame:
    """Cut lineage: write ``df`` once as a Parquet table in the shared
    checkpoint folder and continue from that table.

    Unlike ``DataFrame.checkpoint(eager=True)``, which computes the plan once
    to count it and again to write the un-persisted RDD, this computes it
    once. The table lives in ``spark.checkpoint.dir`` (shared storage on a
    cluster), so a lost executor only loses work that Spark redoes from the
    written files; it is never a machine-local folder.
    """
    root = ensure_checkpoint_dir(df.sparkSession)
    path = f"{root.rstrip('/')}/cohortkit-{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)

"""Session construction and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale.  Everything is overridable by the caller's
# cluster config; ``builder`` only fills what is unset.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ledgerlake", extra: dict | None = None) -> SparkSession:
    """Return the active session or build one (local runs and tests)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    On a cluster this is ``spark.checkpoint.dir`` (a shared filesystem named by
    the cluster config).  Only when nothing is set and the master is local (tests)
    a private temporary folder is created; on a cluster that raises, as other
    machines would not see the folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or _conf_get(spark, "spark.checkpoint.dir")
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the whole cluster shares")
    else:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlake-ckpt-"))
    return sc.getCheckpointDir()


def _conf_get(spark: SparkSession, key: str):
    try:
        return spark.conf.get(key, None)
    except Exception:  # pragma: no cover - conf access can fail on some builds
        return None


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared work folder (for written intermediates)."""
    base = ensure_checkpoint_dir(spark)
    # the checkpoint dir returned by Spark already carries a unique sub folder
    return os.path.join(base.rstrip("/"), "ledgerlake", f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df, name: str = "stage"):
    """Write ``df`` once as parquet under the shared work folder and scan it.

    Cuts lineage like a reliable ``checkpoint()`` but computes the plan only
    once (an eager checkpoint of an uncached plan runs it twice: once to count,
    once to write).  The files live on the cluster's shared filesystem, so a
    lost executor re-reads them instead of recomputing the plan.
    """
    path = work_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)

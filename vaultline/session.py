"""Session construction and shared-folder helpers.

Jobs that write (stream checkpoints, vault batch folders, CSV round trips)
put their files under the folder the cluster names in ``spark.checkpoint.dir``.
Only when that setting is absent *and* Spark runs in local mode (tests, the
laptop) do we pick a private temporary folder; on a cluster a machine-local
folder would not survive the loss of the driver host, so we refuse instead.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "vaultline", extra: dict | None = None) -> SparkSession:
    """A session with the package's settings.

    Master and shuffle partitions are set only when the caller names them (tests, tools, the bench):
    on a cluster they come from spark-submit, and a master set in code would override it.
    """
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
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir); set a private one only in local mode where unset.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/ABFS) before running jobs that write")
        root = tempfile.mkdtemp(prefix="vaultline-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, never-reused folder under the shared root for one run, made by the folder's own file system."""
    path = f"{checkpoint_root(spark)}/vaultline/{name}-{uuid.uuid4().hex[:12]}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hadoop)
    return path

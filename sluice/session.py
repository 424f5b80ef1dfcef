"""Session settings and the shared working folder.

Everything durable that a job writes for itself (stream checkpoints, seen
sets, watermarks, cut lineage) goes under ``spark.checkpoint.dir``: on a
cluster that is a shared folder every executor can reach. Only a local
session with no such setting gets a fresh temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that shape the plans this library builds; all are ordinary
# session options and can be overridden by the caller.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Documents are large rows: bound Arrow batches sent to Python UDFs by
    # rows and by bytes, whichever is hit first.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[*]", app: str = "sluice", **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    When the session names none, a local session gets its own temporary
    folder (tests, laptops); a cluster session must name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(root)  # so DataFrame.checkpoint() writes there too
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
    root = tempfile.mkdtemp(prefix="sluice-")
    spark.sparkContext.setCheckpointDir(root)  # the next call finds it there
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused location under the shared folder."""
    return f"{work_root(spark)}/sluice/{name}-{uuid.uuid4().hex[:12]}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Removes a folder that ``fresh_path`` named, on whatever file system it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

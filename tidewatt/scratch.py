"""Where intermediate tables go: always a folder the cluster shares."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder in the session's scratch folder.

    That folder lies under ``spark.checkpoint.dir`` or, where it is unset, in the
    warehouse.  It goes when the driver's process ends.  On a cluster without the setting, a
    warehouse on the driver's own disk is an error: executors would not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        if base.startswith("file:") and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    session = f"{base.rstrip('/')}/tidewatt-{spark.sparkContext.applicationId}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(session)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        files.mkdirs(folder)
        files.deleteOnExit(folder)
    return f"{session}/{label}-{uuid.uuid4().hex}"

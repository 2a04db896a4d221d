"""Tables written once and read many times, and joins that check sizes first.

A staged table cuts lineage at a parquet folder on shared storage: later passes
read only the columns they need and a lost executor costs a re-read, not a rerun
of the scan and shuffles that made the table.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Spark's switch for shuffle files that go at the end of the job that wrote them.
FREE_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staging_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only on a local master."""
    sc = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_KEY, None) or sc.getConf().get(CHECKPOINT_KEY)
    root = root or sc.getCheckpointDir()
    if root is None:
        if not sc.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="weekloom-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the staging root."""
    app = spark.sparkContext.applicationId
    return f"{staging_root(spark).rstrip('/')}/weekloom-{app}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to a fresh parquet folder and return the table read back.

    The shuffle files of the write are not read again, so they go as soon as it ends and not
    when the driver collects garbage: a job of many stages holds those of one stage at a time.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    was = spark.conf.get(FREE_KEY, None)
    spark.conf.set(FREE_KEY, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(FREE_KEY) if was is None else spark.conf.set(FREE_KEY, was)
    return spark.read.schema(df.schema).parquet(path)

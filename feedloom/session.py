"""Session settings and the shared folder that staged tables live in."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What the jobs rely on; most are Spark's defaults, set here so that a changed cluster default
# does not silently take skew handling or runtime re-planning away.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "feedloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**JOB_CONF, "spark.ui.enabled": "false", **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Plain local mode, where driver and executors are one process, may leave it unset: a temporary
    folder then serves for the session.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="feedloom-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of that name; what cannot be reached raises."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


class Staging:
    """Tables written between the rounds of an iterative job.

    A written table cuts the lineage, survives the loss of executors, and has an exact size, so
    that the planner can decide a broadcast from fact instead of from an estimate.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{staging_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, table: str) -> DataFrame:
        path = f"{self.path}/{table}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        """Delete the tables. For jobs that know that nothing reads them any more, such as a micro-batch once written."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)

"""One write for the records of many destinations, each of which reads its own part."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import exists

_COMMIT = "destination string, run string, n bigint"


class Outbox:
    """Records under ``path``, in a folder for each destination and run, and a commit row for each of both.

    A run is written in one job whatever the number of destinations: the records are read once, and a
    destination with many is written by several tasks. It counts from the moment its commit rows are
    written; what a run that failed has left is in no commit, and the run is delivered again under another name.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def deliver(self, records: DataFrame, routes: DataFrame, run: str | None = None) -> str:
        """Write ``records`` by the ``routes(task_id, destination)`` of their tasks; returns the run's name.

        A task may have several destinations, and a destination several tasks; a record goes to each
        destination once. Tasks without a route and records without a task go nowhere. A run that is
        committed is not written again. Destinations may have any name; their folders have its digest.
        """
        run = run or uuid.uuid4().hex
        if self._committed().where(F.col("run") == run).isEmpty():
            pairs = routes.where("task_id IS NOT NULL AND destination IS NOT NULL").select("task_id", "destination").distinct()
            routed = records.join(pairs, "task_id").withColumn("outbox", F.sha2("destination", 256))
            place = f"{self.path}/records/run={run}"
            routed.write.mode("overwrite").partitionBy("outbox").parquet(place)
            # Counted from what was written, by its narrowest column.
            written = self.spark.read.schema("destination string").parquet(place).groupBy("destination").agg(F.count(F.lit(1)).alias("n"))
            told = pairs.select("destination").distinct().join(written, "destination", "left")
            commits = told.select("destination", F.lit(run).alias("run"), F.coalesce("n", F.lit(0)).alias("n"))
            commits.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        return run

    def _committed(self) -> DataFrame:
        if not exists(self.spark, f"{self.path}/commits"):
            return self.spark.createDataFrame([], _COMMIT)
        return self.spark.read.schema(_COMMIT).parquet(f"{self.path}/commits")

    def commits(self) -> DataFrame:
        """``destination, run, n`` of every delivery, those of no records too."""
        return self._committed()

    def read(self, destination: str | None = None) -> DataFrame | None:
        """The delivered records of one destination, from its own folders, or of all; None before the first delivery."""
        if not exists(self.spark, f"{self.path}/records"):
            return None
        rows = self.spark.read.parquet(f"{self.path}/records")
        if destination is not None:
            rows = rows.where((F.col("outbox") == F.sha2(F.lit(destination), 256)) & (F.col("destination") == destination))
        runs = self._committed().select("run").distinct()
        return rows.join(runs, "run", "left_semi").drop("outbox")

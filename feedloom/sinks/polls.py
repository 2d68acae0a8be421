"""What earlier polls found: a validator and a digest for each address, so that unchanged bodies are not read again."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Staging, exists
from .clustered import Clustered

_INDEX = "url string, validator string, digest string"


class PollIndex:
    """Versions of the index under ``path``, one for each poll; a version without Spark's mark of success does not count.

    One driver at a time polls. A version has a short row for each address, whatever the size of the bodies.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _newest(self) -> int | None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not exists(self.spark, self.path):
            return None
        names = (s.getPath().getName() for s in folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(folder))
        numbers = sorted((int(m[1]) for m in map(re.compile(r"version=(\d+)$").match, names) if m), reverse=True)
        return next((n for n in numbers if exists(self.spark, f"{self.path}/version={n}/_SUCCESS")), None)

    def read(self) -> DataFrame:
        """``url, validator, digest`` after the last poll."""
        newest = self._newest()
        if newest is None:
            return self.spark.createDataFrame([], _INDEX)
        return self.spark.read.schema(_INDEX).parquet(f"{self.path}/version={newest}")

    def poll(self, listing: DataFrame, bodies: DataFrame | Clustered) -> DataFrame:
        """``(url, change)`` since the last poll: added, modified or removed; unchanged ones left out.

        ``listing(url, validator)`` names what is there, one row per address, as an answer without a body does;
        ``bodies(url, body)`` is read for addresses that are new, have no validator, or another one than before.
        From a clustered store only the buckets of those are opened. A body that came with a new validator but
        is the same is unchanged. An address listed without a body counts as one with none.
        """
        staging = Staging(self.spark, "poll")
        old = self.read().select(F.col("url").alias("__url"), F.col("validator").alias("old_validator"), F.col("digest").alias("old_digest"))
        known = listing.select("url", F.col("validator").cast("string").alias("validator")).where("url IS NOT NULL")
        met = known.join(old, F.col("url") == F.col("__url"), "full")
        same = F.col("__url").isNotNull() & F.coalesce(F.col("validator") == F.col("old_validator"), F.lit(False))
        met = staging.write(
            met.select(
                F.coalesce("url", "__url").alias("url"), "validator", "old_digest", F.col("__url").isNotNull().alias("was"),
                F.col("url").isNotNull().alias("is"), (F.col("url").isNotNull() & ~same).alias("due"),
            ),
            "met",
        )
        due = met.where("due").select("url")
        store = bodies.holding(due, "url") if isinstance(bodies, Clustered) else bodies
        digests = store.join(due, "url", "left_semi").select("url", F.sha2(F.col("body").cast("binary"), 256).alias("new_digest"))
        digest = F.when(F.col("due"), F.col("new_digest")).otherwise(F.col("old_digest"))
        after = staging.write(met.join(digests, "url", "left").withColumn("digest", digest).drop("new_digest"), "after")
        number = -1 if (newest := self._newest()) is None else newest
        after.where("is").select("url", "validator", "digest").write.mode("overwrite").parquet(f"{self.path}/version={number + 1}")
        change = F.when(~F.col("was"), "added").when(~F.col("is"), "removed").when(~F.col("digest").eqNullSafe(F.col("old_digest")), "modified")
        return after.select("url", change.alias("change")).where("change IS NOT NULL")

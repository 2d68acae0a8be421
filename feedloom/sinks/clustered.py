"""Stores of long rows that are looked up by key: clustered on disk, so that look-ups do not move them."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import exists

_BUCKET = re.compile(r"_(\d{5})(?:\.c\d+)?\.")
# Share of the buckets up to which a look-up opens only those that its keys fall into.
FEW = 0.25


def bucket_of(key: Column, buckets: int) -> Column:
    """The bucket that Spark keeps a key in."""
    return F.pmod(F.hash(key), F.lit(buckets))


class Clustered:
    """Rows under ``path`` in buckets by a hash of their key, sorted within, a Bloom filter of the keys in each file.

    A join on the key with this store exchanges the other side only: the store is read bucket by bucket, where
    it lies. Choose as many buckets as make each fit a task, and the shuffle partitions of the jobs that
    join it no higher. Each bucket is one file, so what has keys in few buckets opens few files. A null key is
    in no bucket that a look-up opens, and meets nothing. The store is immutable; a new one is written
    beside it under a new path.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        about = json.loads(spark.read.text(f"{self.path}/about").first()["value"])
        self.key, self.buckets, self._schema = about["key"], about["buckets"], about["schema"]
        self.table = f"clustered_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{name}` {kind}" for name, kind in self._schema)
        place = f"{self.path}/rows".replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {self.table} ({columns}) USING parquet"
            f" CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{place}'"
        )

    @classmethod
    def write(cls, rows: DataFrame, path: str, key: str, buckets: int, *, distinct_keys: int | None = None) -> Clustered:
        """``rows`` as a store. ``distinct_keys`` in all, if known, sizes the Bloom filters."""
        spark, path = rows.sparkSession, path.rstrip("/")
        if exists(spark, f"{path}/about"):
            raise ValueError(f"{path} holds a store already")
        name = f"clustered_{uuid.uuid4().hex}"
        # One task writes a bucket: the exchange deals rows by the hash that buckets go by.
        writer = (
            rows.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
            .option(f"parquet.bloom.filter.enabled#{key}", "true").option("path", f"{path}/rows")
        )
        if distinct_keys:
            writer = writer.option(f"parquet.bloom.filter.expected.ndv#{key}", str(-(-distinct_keys // buckets)))
        writer.saveAsTable(name)
        spark.sql(f"DROP TABLE {name}")  # the files stay
        about = {"key": key, "buckets": buckets, "schema": [(f.name, f.dataType.simpleString()) for f in rows.schema]}
        # Written last: a store without it was not finished.
        spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")
        return cls(spark, path)

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def files(self) -> dict[int, list[str]]:
        """The files of each bucket; one if no write was interrupted and repeated."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/rows")
        found: dict[int, list[str]] = {}
        for status in folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(folder):
            bucket = _BUCKET.search(status.getPath().getName())
            if bucket:
                found.setdefault(int(bucket[1]), []).append(status.getPath().toString())
        return found

    def holding(self, keys: DataFrame, column: str) -> DataFrame:
        """The store, or where ``keys`` fall into few buckets those only. At most a number for each bucket comes to the driver."""
        hit = [r[0] for r in keys.where(F.col(column).isNotNull()).select(bucket_of(F.col(column), self.buckets)).distinct().collect()]
        if len(hit) > FEW * self.buckets:
            return self.read()
        files = self.files()
        paths = [path for bucket in sorted(hit) for path in files.get(bucket, [])]
        schema = self.read().schema
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

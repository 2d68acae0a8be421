"""A kept change feed as a streaming source whose offsets are the feed's own tokens."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..schemas import DRIVE_CHANGE
from ..session import exists

_SEGMENT = re.compile(r"segment=(\d+)-(\d+)$")
_WIDTH = 20


def append(changes: DataFrame, path: str) -> int:
    """Add changes with their positions ``seq`` to the feed; returns the token behind them.

    What is added makes one segment, named by its first position and the token behind its last. A
    segment counts from the moment its writing is complete, so a failed one may be written again.
    """
    spark, path = changes.sparkSession, path.rstrip("/")
    low, high = changes.agg(F.min("seq"), F.max("seq")).first()
    if low is None:
        return end_of(path) if exists(spark, path) else 0
    segment = f"{path}/segment={low:0{_WIDTH}d}-{high + 1:0{_WIDTH}d}"
    columns = StructType.fromDDL(DRIVE_CHANGE).fieldNames()
    changes.select(*columns).repartitionByRange("seq").sortWithinPartitions("seq").write.mode("overwrite").parquet(segment)
    return high + 1


def _segments(path: str) -> tuple[fs.FileSystem, list[tuple[int, int, str]]]:
    """The complete segments: first position, token behind, folder."""
    store, root = fs.FileSystem.from_uri(path)
    found = []
    for entry in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
        named = _SEGMENT.search(entry.path)
        if named and store.get_file_info(f"{entry.path}/_SUCCESS").type == fs.FileType.File:
            found.append((int(named[1]), int(named[2]), entry.path))
    return store, sorted(found)


def end_of(path: str) -> int:
    """The token behind the newest change."""
    return max((end for _, end, _ in _segments(path)[1]), default=0)


@dataclass
class _Part(InputPartition):
    file: str
    low: int
    high: int


class DriveFeedReader(DataSourceStreamReader):
    """Offsets are ``{"token": position}``: what is before it was read.

    A new query begins at the token it is given, or else at the feed's end: the handshake. ``max_per_batch``
    bounds how many positions a batch goes on by. A restarted query says by ``resume`` where its checkpoint
    stands, as Spark asks for the next offset before it tells the last one.
    """

    def __init__(self, path: str, schema: StructType, token: int | None, resume: int | None, most: int | None):
        self.path, self.schema, self.token, self.most = path, schema, token, most
        self.at = resume

    def initialOffset(self) -> dict:
        self.at = end_of(self.path) if self.token is None else self.token
        return {"token": self.at}

    def latestOffset(self) -> dict:
        if self.at is None:
            self.initialOffset()
        end = max(end_of(self.path), self.at)
        self.at = end if self.most is None else min(end, self.at + self.most)
        return {"token": self.at}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        low, high = start["token"], end["token"]
        store, segments = _segments(self.path)
        return [
            _Part(file.path, low, high)
            for first, last, folder in segments
            if first < high and last > low
            for file in store.get_file_info(fs.FileSelector(folder))
            if file.path.endswith(".parquet")
        ]

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(self.path)
        schema = to_arrow_schema(self.schema)
        with store.open_input_file(partition.file) as file:
            parquet = pq.ParquetFile(file)
            for group in range(parquet.num_row_groups):
                span = parquet.metadata.row_group(group).column(0).statistics
                if span is not None and span.has_min_max and (span.max < partition.low or span.min >= partition.high):
                    continue
                for batch in parquet.iter_batches(row_groups=[group], batch_size=4096):
                    seq = batch.column("seq")
                    due = batch.filter(pc.and_(pc.greater_equal(seq, partition.low), pc.less(seq, partition.high)))
                    if due.num_rows:
                        yield from pa.Table.from_batches([due]).cast(schema).to_batches()


class DriveFeedSource(DataSource):
    """``spark.readStream.format("drive_feed").option("token", ...).load(path)``"""

    @classmethod
    def name(cls) -> str:
        return "drive_feed"

    def schema(self) -> str:
        return DRIVE_CHANGE

    def streamReader(self, schema: StructType) -> DriveFeedReader:
        number = {k: int(self.options[k]) if self.options.get(k) else None for k in ("token", "resume", "max_per_batch")}
        if number["max_per_batch"] is not None and number["max_per_batch"] < 1:
            raise ValueError("max_per_batch must be positive")
        return DriveFeedReader(self.options["path"], schema, number["token"], number["resume"], number["max_per_batch"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(DriveFeedSource)


def checkpoint_token(spark: SparkSession, checkpoint: str) -> int | None:
    """The token up to which the newest batch in a stream's checkpoint goes; None before the first."""
    folder = f"{checkpoint.rstrip('/')}/offsets"
    if not exists(spark, folder):
        return None
    log = spark.read.text(folder, wholetext=True).select(F.col("_metadata.file_name").cast("int").alias("batch"), "value")
    newest = log.where("batch IS NOT NULL").agg(F.max_by("value", "batch").alias("value")).first().value
    return None if newest is None else json.loads(newest.splitlines()[-1])["token"]

"""Where records go: named writers that serve batch runs and ``foreachBatch`` alike."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Writer = Callable[[DataFrame, int], None]
WriterFactory = Callable[[Mapping[str, str]], Writer]

_FACTORIES: dict[str, WriterFactory] = {}


def register(name: str, factory: WriterFactory) -> None:
    """Make ``factory(config) -> write(batch, batch_id)`` available under ``name``."""
    _FACTORIES[name.lower()] = factory


def destination(name: str, config: Mapping[str, str]) -> Writer:
    try:
        return _FACTORIES[name.lower()](config)
    except KeyError:
        raise ValueError(f"no destination {name!r}; known: {sorted(_FACTORIES)}") from None


def write_once(records: DataFrame, name: str, config: Mapping[str, str]) -> None:
    """One batch run; it stands beside what earlier runs and streams have written."""
    destination(name, {**config, "stream": f"run-{uuid.uuid4().hex}"})(records, 0)


def _files(config: Mapping[str, str]) -> Writer:
    """A folder for each stream and batch, rewritten when a batch is repeated; partitioned by source.

    Streams into one path need a ``stream`` name each in their configuration.
    """
    kind, path, stream = config.get("format", "parquet"), config["path"], config.get("stream", "default")

    def write(batch: DataFrame, batch_id: int) -> None:
        by = [c for c in ("source",) if c in batch.columns]
        batch.write.format(kind).mode("overwrite").partitionBy(*by).save(f"{path}/stream={stream}/batch={batch_id}")

    return write


def _table(config: Mapping[str, str]) -> Writer:
    """A table with the columns stream and batch added, made by the first batch; a repeated batch replaces its partition."""
    table, stream = config["table"], config.get("stream", "default")

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumns({"stream": F.lit(stream), "batch": F.lit(batch_id).cast("bigint")})
        spark = batch.sparkSession
        if not spark.catalog.tableExists(table):
            # Kept with the table: an overwrite replaces only the partitions that rows go to.
            rows.write.option("partitionOverwriteMode", "dynamic").partitionBy("stream", "batch").saveAsTable(table)
            return
        rows.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)

    return write


register("files", _files)
register("table", _table)

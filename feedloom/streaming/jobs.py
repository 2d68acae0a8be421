"""Streaming runs of the incremental operators.

Transforms are the batch ones; each micro-batch succeeds or fails as a whole. ``available_now``
drains what is there and stops, which also makes these the scheduled incremental runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.drive import drive_delta
from ..operators.git import git_push_delta
from ..operators.webhooks import normalize_webhooks
from ..schemas import DELIVERY, DRIVE_CHANGE, PUSH_EVENT
from ..session import Staging
from ..sinks.corpus import TokenState, stream_id
from ..sources import drive_feed

Writer = Callable[[DataFrame, int], None]


def read_stream(spark: SparkSession, path: str, schema: str, *, kind: str = "json", files_per_batch: int = 1000) -> DataFrame:
    """New files of a folder; the number of files per batch bounds what one batch holds."""
    return spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", files_per_batch).load(path)


def deliveries(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_stream(spark, path, DELIVERY, **options)


def push_events(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_stream(spark, path, PUSH_EVENT, **options)


def drive_changes(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_stream(spark, path, DRIVE_CHANGE, **options)


def start(stream: DataFrame, checkpoint: str, write: Writer, *, available_now: bool = True) -> StreamingQuery:
    """Run ``write(batch, batch_id)`` per micro-batch."""
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def run_webhooks(
    stream: DataFrame, registry: DataFrame | None, checkpoint: str, write: Writer, *, available_now: bool = True
) -> StreamingQuery:
    """Judge each delivery as it comes; stateless."""
    verdicts = normalize_webhooks(stream, registry)
    return start(verdicts, checkpoint, write, available_now=available_now)


def run_pushes(
    stream: DataFrame,
    repo_files: DataFrame,
    checkpoint: str,
    write: Writer,
    *,
    order_by: str = "event_id",
    run_ts: Column | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Records of each batch of pushes, with ``seq`` for :class:`~feedloom.sinks.corpus.Corpus`."""

    def batch_job(batch: DataFrame, batch_id: int) -> None:
        staging = Staging(batch.sparkSession, "pushes")
        delta = git_push_delta(batch, repo_files, order_by, run_ts=run_ts, staging=staging)
        write(delta.withColumnRenamed(order_by, "seq"), batch_id)
        staging.remove()

    return start(stream, checkpoint, batch_job, available_now=available_now)


def run_drive(
    stream: DataFrame,
    content: DataFrame,
    folder_id: str,
    checkpoint: str,
    write: Writer,
    *,
    tokens: TokenState | None = None,
    start_token: int | None = None,
    next_token: int | None = None,
    feed: DataFrame | None = None,
    run_ts: Column | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Records of each batch of drive changes; the next token is written after the records.

    The stream goes on from ``effective_token`` of the folder's two tokens, the start token first. With
    neither it goes on from the folder's token in ``tokens``, and without one its first run is the
    handshake: nothing that is there by then gives records. The token a stream began from holds for all
    its batches, also those that are repeated or come after a restart.

    At the handshake ``feed``, the same changes as a table, tells how far the backlog goes. Without it
    the first batch counts as the backlog. :func:`run_drive_feed` needs neither.
    """

    def batch_job(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = stream_id(spark, checkpoint)
        staging = Staging(spark, "drive")
        batch = staging.write(batch, "batch")
        token = first_token(batch, batch_id, own)
        write(drive_delta(batch, content, folder_id, token, run_ts=run_ts, staging=staging), batch_id)
        if tokens is not None:
            newest = batch.agg((F.max("seq") + 1).alias("next_token")).where("next_token is not null")
            tokens.write(newest.select(F.lit(folder_id).alias("resource"), F.greatest("next_token", F.lit(token)).alias("next_token")), batch_id, own)
        staging.remove()

    def first_token(batch: DataFrame, batch_id: int, own: str) -> int:
        given = start_token if start_token is not None else next_token
        if given is not None:
            return given
        if tokens is None:
            raise ValueError("a stream without a token needs a table of tokens to keep its first one")
        held = tokens.read_before(folder_id, own, 0) if batch_id == 0 else None
        if held is None and batch_id == 0:
            backlog = feed if feed is not None else batch
            held = backlog.agg(F.coalesce(F.max("seq") + 1, F.lit(0))).first()[0]
        return tokens.begin(folder_id, own, held or 0)

    return start(stream, checkpoint, batch_job, available_now=available_now)


def run_drive_feed(
    spark: SparkSession,
    path: str,
    content: DataFrame,
    folder_id: str,
    checkpoint: str,
    write: Writer,
    *,
    tokens: TokenState | None = None,
    start_token: int | None = None,
    next_token: int | None = None,
    max_per_batch: int | None = None,
    run_ts: Column | None = None,
) -> int:
    """Drain the kept feed at ``path`` (see ``sources.drive_feed``) and return the token behind what was read.

    The offsets of the stream are the feed's tokens. A new stream begins at the start token, else the next
    token, else the folder's token in ``tokens``, else behind the newest change: the handshake, which
    is kept in ``tokens``. Then and after a restart its checkpoint alone decides. A batch goes on by at
    most ``max_per_batch`` positions.
    """
    drive_feed.register(spark)
    resume = drive_feed.checkpoint_token(spark, checkpoint)
    token = start_token if start_token is not None else next_token
    if resume is None and token is None:
        if tokens is None:
            raise ValueError("a stream without a token needs a table of tokens to keep its first one")
        token = tokens.read_before(folder_id, "", 0)
        if token is None:
            token = drive_feed.end_of(path)
            row = spark.createDataFrame([(folder_id, token)], "resource string, next_token bigint")
            tokens.write(row, 0, "handshake")

    def batch_job(batch: DataFrame, batch_id: int) -> None:
        staging = Staging(batch.sparkSession, "drive")
        batch = staging.write(batch, "batch")
        write(drive_delta(batch, content, folder_id, F.col("seq"), run_ts=run_ts, staging=staging), batch_id)
        if tokens is not None:
            newest = batch.agg((F.max("seq") + 1).alias("next_token")).where("next_token is not null")
            tokens.write(newest.select(F.lit(folder_id).alias("resource"), "next_token"), batch_id, stream_id(spark, checkpoint))
        staging.remove()

    options = {"token": token, "resume": resume, "max_per_batch": max_per_batch}
    stream = spark.readStream.format("drive_feed").options(**{k: str(v) for k, v in options.items() if v is not None}).load(path)
    query = start(stream, checkpoint, batch_job, available_now=False)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    reached = drive_feed.checkpoint_token(spark, checkpoint)
    return token if reached is None else reached

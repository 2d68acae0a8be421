"""Building and combining rows of the shared record schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import RECORD

# Change types as the three sources spell them, by what they do to a stored copy.
_UPSERTS = ("added", "modified", "full_scan", "UPSERT")
_DELETES = ("removed", "DELETE")


def change_op(change_type: Column, status_code: Column) -> Column:
    """UPSERT, DELETE or NONE. Failed fetches are NONE, so they never erase a stored copy."""
    return (
        F.when(status_code >= 400, "NONE")
        .when(change_type.isin(*_DELETES), "DELETE")
        .when(change_type.isNull() | change_type.isin(*_UPSERTS), "UPSERT")
        .otherwise("NONE")
    )


def git_key(repo: Column, branch: Column, path: Column) -> Column:
    """Full scans name a repository by address, pushes by ``owner/name``; both give one key."""
    name = F.regexp_replace(F.regexp_replace(repo, r"^[a-z+]+://[^/]+/|^[^@/]+@[^:/]+:", ""), r"(?:\.git)?/*$", "")
    return F.concat(F.lit("git:"), name, F.lit(":"), branch, F.lit(":"), path)


def drive_key(file_id: Column) -> Column:
    return F.concat(F.lit("drive:"), file_id)


def to_records(df: DataFrame, keep: tuple[str, ...] = (), **columns: Column) -> DataFrame:
    """Select the record schema from ``df``; fields not given are NULL.

    ``change_op`` is derived. ``keep`` names columns of ``df`` to carry in front, such as the
    position in a feed.
    """
    unknown = set(columns) - set(RECORD)
    if unknown:
        raise ValueError(f"not record fields: {sorted(unknown)}")
    fields = df.select(
        *keep, *[columns.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in RECORD.items()]
    )
    return fields.withColumn("change_op", change_op(F.col("change_type"), F.col("status_code")))


def unify(*parts: DataFrame) -> DataFrame:
    """One table of records from several sources."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def run_summary(records: DataFrame, outcomes: DataFrame, *, counted: bool = False) -> DataFrame:
    """One status row per row of ``outcomes(task_id, code)``: what its records count up to and whether it succeeded.

    Error rows count as crawled and do not fail the run; a task that could not run, or found nothing, has
    counts of zero. Records are counted where they are read; with ``counted`` they come as
    ``(task_id, crawled_count, error_count)``, a row for each task.
    """
    counts = records if counted else records.groupBy("task_id").agg(
        F.count(F.lit(1)).alias("crawled_count"), F.count_if(F.col("status_code") >= 400).alias("error_count")
    )
    none = F.lit(0).cast("bigint")
    return outcomes.join(counts, "task_id", "left").select(
        *outcomes.columns,
        (F.col("code") == 200).alias("success"),
        F.coalesce("crawled_count", none).alias("crawled_count"),
        F.coalesce("error_count", none).alias("error_count"),
    )

"""Keeping a stored corpus up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.lookup import first_per_key
from ..session import Staging


def _effective(changes: DataFrame) -> DataFrame:
    return changes.where((F.col("change_op") != "NONE") & F.col("entity_key").isNotNull())


def latest_changes(changes: DataFrame) -> DataFrame:
    """The last record per entity by ``seq``, then ``pos`` if there is one; failed fetches are left out.

    A push has one ``seq`` for all its files, told apart by ``pos``. Rows alike in both are settled
    by id, then an UPSERT before a DELETE, then by content: never by the order they come in. An
    entity with any share of all changes sends one row per task, and contents move once.
    """
    columns = [c for c in changes.columns if c != "entity_key"]
    content = F.xxhash64(*(c for c in columns if c.startswith("content_")))
    order = [*(c for c in ("seq", "pos", "id") if c in columns), "change_op"]
    last = first_per_key(_effective(changes), ["entity_key"], [*(F.desc(c) for c in order), content.desc()])
    return last.select("entity_key", *columns)


def apply_changes(
    current: DataFrame | None, changes: DataFrame, *, staging: Staging | None = None
) -> DataFrame:
    """The corpus after ``changes``: the newest copy per entity, deleted ones gone.

    Both sides are records with ``seq``; the corpus has one row per ``entity_key``. Stored rows are
    never shuffled for a small delta: they meet only its keys, by anti-joins the planner can
    broadcast. A stored row newer than its change stays, so a batch may be applied again. With
    ``staging`` the reduced changes are written down once instead of being worked out for each use.
    """
    latest = latest_changes(changes)
    if staging is not None:
        latest = staging.write(latest, "latest")
    if current is None:
        return latest.where(F.col("change_op") == "UPSERT")
    # Without a staged copy the keys are worked out again, from two columns instead of all.
    newest = latest.select("entity_key", "seq") if staging is not None else _effective(changes).select("entity_key", "seq")
    due = newest.groupBy("entity_key").agg(F.max("seq").alias("__due"))
    stored = current.select("entity_key", F.col("seq").alias("__stored"))
    untouched = current.join(
        due.withColumnRenamed("entity_key", "__key"),
        (F.col("entity_key") == F.col("__key")) & (F.col("__due") >= F.col("seq")),
        "left_anti",
    )
    fresh = latest.join(
        stored.withColumnRenamed("entity_key", "__key"),
        (F.col("entity_key") == F.col("__key")) & (F.col("__stored") > F.col("seq")),
        "left_anti",
    ).where(F.col("change_op") == "UPSERT")
    return untouched.unionByName(fresh, allowMissingColumns=True)


def poll_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """``(url, change)`` between two snapshots: added, modified or removed; unchanged ones left out.

    Bodies are digested where they are read and only digests move. Both snapshots go through one
    aggregation instead of a join, so an address held many times costs one row per task; its
    bodies then count as a bag.
    """

    def digests(pages: DataFrame, side: int) -> DataFrame:
        return pages.select("url", F.sha2(F.col("body").cast("binary"), 256).alias("digest"), F.lit(side).alias("side"))

    # All of the digest, in four parts; their sums are free of order and exact in a wide decimal.
    whole = F.coalesce(F.col("digest"), F.lit("0" * 64))
    parts = [F.conv(F.substring(whole, at, 16), 16, 10).cast("decimal(20,0)") for at in (1, 17, 33, 49)]

    def bag(side: int):
        mine = F.col("side") == side
        known = F.count_if(mine & F.col("digest").isNotNull()).alias("known")
        sums = [F.sum(F.when(mine, part)).alias(f"part{i}") for i, part in enumerate(parts)]
        return F.struct(F.count_if(mine).alias("n"), known, *sums)

    return (
        digests(before, 0)
        .unionByName(digests(after, 1))
        .groupBy("url")
        .agg(bag(0).alias("old"), bag(1).alias("new"))
        .select(
            "url",
            F.when(F.col("old")["n"] == 0, "added")
            .when(F.col("new")["n"] == 0, "removed")
            .when(F.col("old") != F.col("new"), "modified")
            .alias("change"),
        )
        .where(F.col("change").isNotNull())
    )

"""Sitemap discovery and expansion, and crawls that start from sitemaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import is_sitemap_index, robots_sitemap, sitemap_locs
from ..functions.urls import normalize_url, resolve_url, url_allowed, url_host, url_scheme
from ..plans.lookup import first_per_key, lookup, lookup_staged
from ..session import Staging
from .web import crawl


def discover_sitemaps(seeds: DataFrame, robots: DataFrame, sitemaps: DataFrame) -> DataFrame:
    """``(task_id, url, host, sitemap_url)``: the sitemap to read for each start address, or NULL.

    The first ``Sitemap:`` line of the host's robots file decides, even if what it names is empty
    or missing. Only without such a line is ``/sitemap.xml`` taken, if there is one. ``robots``
    has one row per host; a port in the start address is not part of the host.
    """
    address = F.col("__address")
    starts = seeds.select("task_id", "url", normalize_url(F.col("url")).alias("__address")).select(
        "task_id",
        "url",
        url_host(address).alias("host"),
        F.concat(url_scheme(address), F.lit("://"), url_host(address), F.lit("/sitemap.xml")).alias("__fallback"),
    )
    named = robots.select("host", robots_sitemap(F.col("body")).alias("__named"))
    known = sitemaps.select(normalize_url(F.col("url")).alias("__fallback")).distinct().withColumn("__exists", F.lit(True))
    found = lookup(lookup(starts, named, ["host"]), known, ["__fallback"])
    return found.select(
        "task_id",
        "url",
        "host",
        F.when(F.col("__named").isNotNull(), F.nullif(F.col("__named"), F.lit("")))
        .when(F.col("__exists"), F.col("__fallback"))
        .alias("sitemap_url"),
    )


def sitemap_urls(
    starts: DataFrame,
    sitemaps: DataFrame,
    *,
    start_url: Column | None = None,
    allowed=None,
    include=None,
    exclude=None,
    staging: Staging | None = None,
) -> DataFrame:
    """``(task_id, sitemap_url, loc, allowed)`` for every entry under ``starts(task_id, sitemap_url)``.

    Only sitemaps that a start leads to are parsed. Indexes are followed until no new sitemap turns up; an index may name itself or another one
    above it. Sitemap addresses are compared, and given, in normal form; entries are given as they
    are written. Sitemaps missing from the table, or not sitemaps at all, give nothing. Filters are
    lists, or array Columns over columns of ``starts``; relative entries are tested against
    ``start_url``, a Column over ``starts``.
    """
    spark = starts.sparkSession
    staging = staging or Staging(spark, "sitemaps")
    rules = [c for c in starts.columns if c not in ("task_id", "sitemap_url")]
    keyed = sitemaps.select(normalize_url(F.col("url")).alias("sitemap_url"), "body")
    key = ["task_id", "sitemap_url"]

    first = starts.withColumn("sitemap_url", normalize_url(F.col("sitemap_url"))).dropDuplicates(key)
    frontier = staging.write(first.select(*key, *rules), "reached/round=0")
    if frontier.isEmpty():
        return spark.createDataFrame([], "task_id string, sitemap_url string, loc string, allowed boolean")
    reached, turn, searched = frontier, 0, None
    while True:
        # Of the sitemaps, those that this round reaches first are read and parsed, once for all tasks.
        fresh = frontier.select("sitemap_url").distinct()
        if searched is not None:
            fresh = fresh.join(searched, "sitemap_url", "left_anti")
        fresh = staging.write(fresh, f"searched/round={turn}")
        # A sitemap held several times counts once, as its greatest body.
        bodies = first_per_key(keyed.join(fresh, "sitemap_url", "left_semi"), ["sitemap_url"], [F.desc("body")])
        found = staging.write(
            bodies.select(
                "sitemap_url", is_sitemap_index(F.col("body")).alias("is_index"), sitemap_locs(F.col("body")).alias("locs")
            ).where(F.size("locs") > 0),
            f"parsed/round={turn}",
        )
        searched = spark.read.schema(fresh.schema).parquet(f"{staging.path}/searched").select("sitemap_url")
        parsed = spark.read.schema(found.schema).parquet(f"{staging.path}/parsed").select(*found.columns)
        if frontier.isEmpty():
            break
        turn += 1
        indexes = parsed.where("is_index").select("sitemap_url", "locs")
        # The rules of a task ride along with its sitemaps: every row of a task has the same ones.
        nested = (
            lookup_staged(frontier, indexes, ["sitemap_url"])
            .select("task_id", *rules, F.explode("locs").alias("__named"))
            .select("task_id", normalize_url(F.col("__named")).alias("sitemap_url"), *rules)
            .dropDuplicates(key)
            .join(reached.select(*key), key, "left_anti")
        )
        frontier = staging.write(nested, f"reached/round={turn}")
        reached = spark.read.schema(frontier.schema).parquet(f"{staging.path}/reached")

    entries = parsed.where(~F.col("is_index")).select("sitemap_url", "locs")
    base = normalize_url(start_url) if start_url is not None else F.lit("")
    return (
        lookup_staged(reached.select(*key, *rules), entries, ["sitemap_url"])
        .withColumn("loc", F.explode("locs"))
        .select(
            *key,
            "loc",
            url_allowed(
                resolve_url(F.col("loc"), base), allowed=allowed, include=include, exclude=exclude
            ).alias("allowed"),
        )
    )


def urls_per_sitemap(entries: DataFrame) -> DataFrame:
    return entries.groupBy("sitemap_url").agg(F.count(F.lit(1)).alias("n_urls"))


def crawl_from_sitemap(
    tasks: DataFrame,
    pages: DataFrame,
    robots: DataFrame,
    sitemaps: DataFrame,
    *,
    fetched: DataFrame | None = None,
    run_ts: Column | None = None,
) -> DataFrame:
    """Records of crawls whose tasks may ask for sitemap discovery (``sitemap_discovery``).

    A task with a sitemap starts from its allowed entries, all at depth 0, and not from its start
    address; a task without one falls back to the start address, which no filter applies to. ``fetched`` is as in :func:`crawl`.
    """
    usable = tasks.where(F.coalesce(F.col("start_url"), F.lit("")) != "")
    wants = F.coalesce(F.col("sitemap_discovery"), F.lit(False))
    staging = Staging(tasks.sparkSession, "discovery")
    found = staging.write(
        discover_sitemaps(
            usable.where(wants).select("task_id", F.col("start_url").alias("url")), robots, sitemaps
        ),
        "found",
    )
    starts = found.where(F.col("sitemap_url").isNotNull()).join(
        usable.select("task_id", "start_url", "allowed_domains", "include_paths", "exclude_paths"), "task_id"
    )
    listed = sitemap_urls(
        starts.drop("url", "host"),
        sitemaps,
        start_url=F.col("start_url"),
        allowed=F.col("allowed_domains"),
        include=F.col("include_paths"),
        exclude=F.col("exclude_paths"),
    )
    seeds = (
        listed.where("allowed")
        .select("task_id", F.col("loc").alias("url"))
        .unionByName(found.where(F.col("sitemap_url").isNull()).select("task_id", "url"))
        .unionByName(usable.where(~wants).select("task_id", F.col("start_url").alias("url")))
    )
    return crawl(usable, pages, seeds=seeds, fetched=fetched, run_ts=run_ts)

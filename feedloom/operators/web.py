"""Web pages: fetching from a snapshot, extracting links, and the crawl itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import is_html, page_links
from ..functions.urls import fetch_key, normalize_url, parse_absolute, url_allowed, url_scheme
from ..plans.lookup import first_per_key, lookup, lookup_staged
from ..session import Staging
from .records import to_records

TASK_COLUMNS = ("task_id", "max_depth", "recursive", "allowed_domains", "include_paths", "exclude_paths")


def page_snapshot(pages: DataFrame, newest: str | None = None) -> DataFrame:
    """One row per request address: the newest by ``newest``, then the greatest address.

    For tables that hold an address several times or under several fragments. Rows alike in address
    and ``newest`` are told apart by a hash of their body; wholly equal ones stay one row. Bodies
    move once, and of an address held many times each task sends one.
    """
    order = [*([F.desc(newest)] if newest else []), F.desc("url"), F.xxhash64("body").desc()]
    keyed = pages.withColumn("__key", fetch_key(normalize_url(F.col("url"))))
    return first_per_key(keyed, ["__key"], order).select(*pages.columns)


def _column(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


# The request address, in snapshots that are kept clustered by it.
FETCH_KEY = "fetch_key"


def keyed_pages(pages: DataFrame) -> DataFrame:
    """A snapshot with the column FETCH_KEY, for a :class:`~feedloom.sinks.clustered.Clustered` store."""
    return pages.withColumn(FETCH_KEY, fetch_key(normalize_url(F.col("url"))))


def _prepared(pages: DataFrame) -> DataFrame:
    key = F.col(FETCH_KEY) if FETCH_KEY in pages.columns else fetch_key(normalize_url(F.col("url")))
    return pages.select(
        key.alias("__fetch"),
        F.lit(True).alias("__hit"),
        _column(pages, "status_code", "int").alias("__status"),
        _column(pages, "content_type", "string").alias("__type"),
        F.col("body").alias("__body"),
        _column(pages, "error", "string").alias("__error"),
        _column(pages, "fetched_at", "timestamp").alias("__at"),
    )


def _succeeded(status: Column) -> Column:
    return F.coalesce(status.between(200, 299), F.lit(False))


def content_kind(content_type: Column, body: Column) -> Column:
    return (
        F.when(F.coalesce(body, F.lit("")) == "", "empty")
        .when(
            F.coalesce(content_type.contains("json"), F.lit(False)) & F.try_parse_json(body).isNotNull(), "json"
        )
        .otherwise("text")
    )


def web_fetch(
    frontier: DataFrame, pages: DataFrame, *, staged: bool = False, run_ts: Column | None = None
) -> DataFrame:
    """Records for ``frontier(url[, task_id, depth])`` read from a page snapshot.

    ``pages`` has one row per request address (see :func:`page_snapshot`); if it is a clustered store of
    :func:`keyed_pages`, its bodies stay where they are. An address the snapshot lacks is a 404 row; a row without a status is a failed request, 500. ``staged`` tells that the
    frontier is read from a written table: a small one then never moves the page store.
    """
    front = frontier.select(
        fetch_key(F.col("url")).alias("__fetch"),
        F.col("url"),
        _column(frontier, "task_id", "string").alias("task_id"),
        _column(frontier, "depth", "int").alias("depth"),
    )
    got = (lookup_staged if staged else lookup)(front, _prepared(pages), ["__fetch"])
    hit, requested = F.col("__hit").isNotNull(), F.col("__requested")
    # A request is only made for an absolute http(s) address; for anything else it fails outright.
    refusal = F.when(requested.isNull(), "Invalid URL").when(
        ~requested.startswith("http"), F.concat(F.lit("Unsupported protocol "), url_scheme(requested), F.lit(":"))
    )
    # In steps, so that no expression is repeated inside another one.
    judged = (
        got.withColumn("__requested", parse_absolute(F.col("url")))
        .withColumn("__refusal", F.when(~hit, refusal))
        .withColumn("__ok", hit & _succeeded(F.col("__status")))
        .withColumn(
            "__code",
            F.when(hit, F.coalesce(F.col("__status"), F.lit(500))).otherwise(
                F.when(F.col("__refusal").isNotNull(), 500).otherwise(404)
            ),
        )
        .withColumn(
            "__message",
            F.when(
                ~F.col("__ok"),
                F.coalesce(
                    F.col("__error"),
                    F.col("__refusal"),
                    F.concat(F.lit("Request failed with status code "), F.col("__code").cast("string")),
                ),
            ),
        )
    )
    ok, message = F.col("__ok"), F.col("__message")
    return to_records(
        judged,
        source=F.lit("web"),
        id=F.col("url"),
        url=F.col("url"),
        status_code=F.col("__code"),
        fetched_at=F.coalesce(F.col("__at"), run_ts) if run_ts is not None else F.col("__at"),
        content_kind=F.when(ok, content_kind(F.col("__type"), F.col("__body"))).otherwise("error"),
        content_text=F.when(ok, F.col("__body")).otherwise(F.concat(F.lit("Error fetching: "), message)),
        entity_key=F.coalesce(requested, F.col("url")),
        web=F.struct(F.when(ok, F.col("__type")).alias("content_type"), F.col("depth")),
        error=message,
        task_id=F.col("task_id"),
    )


def extract_links(pages: DataFrame, *keep: str, distinct: bool = False) -> DataFrame:
    """``keep`` columns plus ``link_url`` for every usable ``a[href]`` of the HTML pages.

    Links are resolved against the page's address; unparseable ones are dropped. Every whole page
    is read once and no shuffle is needed. ``distinct`` removes repeats within a page.
    """
    # One generator and no later filter: a filter would be pushed below and resolve links twice.
    links = page_links(F.col("body"), normalize_url(F.col("url")))
    return pages.where(is_html(F.col("content_type"))).select(
        *keep, F.explode(F.array_distinct(links) if distinct else links).alias("link_url")
    )


def link_edges(pages: DataFrame) -> DataFrame:
    """``(src, dst)`` for the links of all successfully fetched HTML pages; ``src`` is a request address."""
    ok = pages.where(_succeeded(F.col("status_code"))) if "status_code" in pages.columns else pages
    keyed = ok.withColumn("src", fetch_key(normalize_url(F.col("url"))))
    return extract_links(keyed, "src", distinct=True).withColumnRenamed("link_url", "dst")


def crawl_frontier(
    seeds: DataFrame,
    tasks: DataFrame,
    pages: DataFrame,
    *,
    edges: DataFrame | None = None,
    strict_domain: bool = False,
    staging: Staging | None = None,
) -> DataFrame:
    """``(task_id, url, depth)`` of every address the tasks reach, each at its least depth.

    ``seeds(task_id, url)`` start at depth 0 and are not filtered; ``tasks`` has the columns
    ``TASK_COLUMNS``. All tasks advance together, one depth per round:

    * A round searches the frontier's own pages for links, each page once in a crawl, and keeps what
      it finds as ``edges``. Crawls that share a snapshot can be given its edges instead, made by
      :func:`link_edges`; then no page text is read.
    * Then: pages of the frontier (many fragments of one page count once) with edges, filter by the
      task's rules, distinct (which reduces popular targets before the shuffle), anti-join against
      what was visited.
    * Every round's frontier is a written table: its exact size lets the planner broadcast a small
      one instead of shuffling the edges, and nothing is recomputed when an executor is lost.
    """
    spark = seeds.sparkSession
    staging = staging or Staging(spark, "crawl")
    rules = staging.write(tasks.select(*TASK_COLUMNS), "rules")
    run_depth = F.coalesce(F.col("max_depth"), F.lit(0))

    start = (
        seeds.select("task_id", normalize_url(F.col("url")).alias("url"))
        .distinct()
        .join(rules.where(run_depth >= 0).select("task_id"), "task_id", "left_semi")
    )
    # The depth is the name of the folder, not a column: plans of all rounds stay the same, and
    # so does their generated code.
    frontier = staging.write(start, "visited/depth=0")
    visited = frontier
    deepest = rules.where(F.col("recursive")).agg(F.coalesce(F.max(run_depth), F.lit(0)).alias("d")).first()["d"]
    given, searched = edges, None
    keyed = pages.withColumn("__src", fetch_key(normalize_url(F.col("url"))))

    allowed = url_allowed(
        F.col("dst"),
        allowed=F.col("allowed_domains"),
        include=F.col("include_paths"),
        exclude=F.col("exclude_paths"),
        strict_domain=strict_domain,
    )
    for depth in range(1, deepest + 1):
        if frontier.isEmpty():
            break
        active = rules.where(F.col("recursive") & (run_depth >= depth))
        due = frontier.join(active.select("task_id"), "task_id", "left_semi")
        due = due.select("task_id", fetch_key(F.col("url")).alias("src")).distinct()
        if given is None:
            fresh = due.select(F.col("src").alias("__src")).distinct()
            if searched is not None:
                fresh = fresh.join(searched, "__src", "left_anti")
            fresh = staging.write(fresh, f"searched/depth={depth}")
            staging.write(link_edges(keyed.join(fresh, "__src", "left_semi").drop("__src")), f"edges/depth={depth}")
            searched = spark.read.schema(fresh.schema).parquet(f"{staging.path}/searched")
            edges = spark.read.schema("src string, dst string").parquet(f"{staging.path}/edges")
        found = (
            due.join(edges, "src")
            .join(active, "task_id")
            .where(allowed)
            .select("task_id", F.col("dst").alias("url"))
            .distinct()
            .join(visited.select("task_id", "url"), ["task_id", "url"], "left_anti")
        )
        frontier = staging.write(found, f"visited/depth={depth}")
        visited = spark.read.schema(frontier.schema).parquet(f"{staging.path}/visited")
    reached = spark.read.schema("task_id string, url string, depth int").parquet(f"{staging.path}/visited")
    return reached.select("task_id", "url", "depth")


def crawl(
    tasks: DataFrame,
    pages: DataFrame,
    *,
    seeds: DataFrame | None = None,
    edges: DataFrame | None = None,
    strict_domain: bool = False,
    fetched: DataFrame | None = None,
    run_ts: Column | None = None,
) -> DataFrame:
    """Records of a depth-limited crawl of a page snapshot, for all ``tasks`` at once.

    ``tasks(task_id, start_url, ...)``; ``seeds(task_id, url)`` replaces the start addresses, as
    after sitemap discovery. A task without a start address yields nothing. Depths are shortest
    distances, so results do not depend on the order pages are visited in. Links are searched in ``pages``;
    records are made from ``fetched`` where it is given, the same snapshot with something else for the bodies.
    """
    if seeds is None:
        seeds = tasks.where(F.coalesce(F.col("start_url"), F.lit("")) != "").select(
            "task_id", F.col("start_url").alias("url")
        )
    reached = crawl_frontier(seeds, tasks, pages, edges=edges, strict_domain=strict_domain)
    return web_fetch(reached, pages if fetched is None else fetched, staged=True, run_ts=run_ts)

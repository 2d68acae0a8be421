"""Running task definitions: from plugin name to operator to destination."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.mappings import mapped
from ..operators import drive, git, records, sitemaps
from ..operators.tasks import GIT_DEFAULTS, RUN_MESSAGES, parse_tasks, validate_tasks, web_tasks, well_formed
from ..session import Staging
from ..sinks.destinations import write_once
from ..sinks.outbox import Outbox
from .contents import CONTENT, SCAN, Shared, referring, stand_in, text_stand_in, write_contents

Inputs = Mapping[str, DataFrame]
# Records, the (task_id, problem) of tasks that could not run, and if records have a SCAN the (SCAN, task_id) of who asked for it.
Ran = tuple[DataFrame, DataFrame] | tuple[DataFrame, DataFrame, DataFrame]
Runner = Callable[[DataFrame, Inputs, Column | None], Ran]

# Why a task that is well defined did not run.
NO_INPUT = "No input was given for this plugin: "
NO_REPO = "Git operation failed: repository or branch not found: "
NO_FOLDER = "Google Drive folder not found: "


@dataclass(frozen=True)
class Plugin:
    """``run(tasks, inputs, run_ts)`` and the input without which none of its tasks can run.

    ``refers`` tells that its records can be made of stand-ins of contents.
    """

    run: Runner
    needs: str
    message: str
    refers: bool = False


def _none(tasks: DataFrame) -> DataFrame:
    return tasks.select("task_id", F.lit(None).cast("string").alias("problem")).where(F.lit(False))


def _run_web(tasks: DataFrame, inputs: Inputs, run_ts: Column | None) -> Ran:
    """Inputs ``pages``, and for sitemap discovery ``robots`` and ``sitemaps``; ``fetched`` has stand-ins of the pages' bodies."""
    spark = tasks.sparkSession
    nothing = {"robots": "host string, body string", "sitemaps": "url string, body string"}
    robots, maps = (inputs.get(k, spark.createDataFrame([], ddl)) for k, ddl in nothing.items())
    wanted = Staging(spark, "web").write(web_tasks(tasks), "tasks")
    return sitemaps.crawl_from_sitemap(wanted, inputs["pages"], robots, maps, fetched=inputs.get("fetched"), run_ts=run_ts), _none(tasks)


def _scanned(found: DataFrame) -> DataFrame:
    """Scans that were named in place of a task."""
    return found.withColumn(SCAN, F.col("task_id")).withColumn("task_id", F.lit(None).cast("string"))


def _run_git(tasks: DataFrame, inputs: Inputs, run_ts: Column | None) -> Ran:
    """Input ``repo_files``, and ``pushes(task_id, event_id, body)``: the events routed to tasks.

    A task with pushes takes in what they touch; any other scans its repository's branch, once for all tasks that ask for it.
    """
    conf = F.col("git")
    wanted = parse_tasks(tasks).select(
        "task_id",
        conf["repoUrl"].alias("repo"),
        F.coalesce(conf["branch"], F.lit(GIT_DEFAULTS["branch"])).alias("branch"),
    )
    wanted = Staging(tasks.sparkSession, "git").write(wanted, "tasks")
    files, delta = inputs["repo_files"], None
    if "pushes" in inputs:
        pushed = inputs["pushes"].join(wanted.select("task_id"), "task_id", "left_semi")
        wanted = wanted.join(pushed.select("task_id").distinct(), "task_id", "left_anti")
        delta = git.git_push_delta(
            pushed.withColumnRenamed("task_id", "__task"), files, "__task", "event_id",
            run_ts=run_ts, staging=Staging(tasks.sparkSession, "pushes"),
        )
        delta = delta.withColumn("task_id", F.col("__task")).drop("__task").withColumnRenamed("event_id", "seq")
    scan = F.concat(F.lit("git "), F.to_json(F.struct("repo", "branch")))
    asked = files.join(wanted.select("repo", "branch").distinct(), ["repo", "branch"], "left_semi")
    found = _scanned(git.git_full_scan(asked, branch=F.col("branch"), task_id=scan, run_ts=run_ts))
    lost = wanted.join(files.select("repo", "branch").distinct(), ["repo", "branch"], "left_anti")
    problems = lost.select("task_id", F.concat(F.lit(NO_REPO), "repo", F.lit(" "), "branch").alias("problem"))
    return (found if delta is None else records.unify(found, delta)), problems, wanted.select(scan.alias(SCAN), "task_id")


def _run_drive(tasks: DataFrame, inputs: Inputs, run_ts: Column | None) -> Ran:
    """Inputs ``drive_files``, ``drive_content``, and ``drive_changes`` with the ``task_id`` whose feed a change is in.

    With a feed, a task that has a token takes in the changes from it; any other scans its folder, once for all
    tasks that ask for it. A folder that neither holds a file nor is one is not found.
    """
    token = drive.effective_token(_text(tasks, "start_page_token"), _text(tasks, "next_page_token")).try_cast("bigint")
    wanted = parse_tasks(tasks).select("task_id", F.col("drive")["folderId"].alias("__folder"), token.alias("__token"))
    staging = Staging(tasks.sparkSession, "drive")
    wanted = staging.write(wanted, "tasks")
    listing, content, delta = inputs["drive_files"], inputs["drive_content"], None
    if "drive_changes" in inputs:
        feed = inputs["drive_changes"].join(wanted.where("__token is not null"), "task_id")
        due = drive.drive_delta(
            feed, content, F.col("__folder"), F.col("__token"),
            run_ts=run_ts, staging=Staging(tasks.sparkSession, "changes"),
        )
        delta, wanted = due, wanted.where("__token is null")
    listed = listing.withColumn("__folder", F.explode(F.array_distinct("parents")))
    scan = F.concat(F.lit("drive "), "__folder")
    found = drive.drive_full_scan(
        listed.join(wanted.select("__folder").distinct(), "__folder", "left_semi"),
        content,
        None,
        task_id=scan,
        run_ts=run_ts,
        staging=staging,
    )
    found = _scanned(found)
    known = listed.select("__folder").unionByName(listing.select(F.col("id").alias("__folder"))).distinct()
    lost = wanted.join(known, "__folder", "left_anti")
    problems = lost.select("task_id", F.concat(F.lit(NO_FOLDER), "__folder").alias("problem"))
    return (found if delta is None else records.unify(found, delta)), problems, wanted.select(scan.alias(SCAN), "task_id")


def _text(df: DataFrame, name: str) -> Column:
    return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")


_PLUGINS: dict[str, Plugin] = {
    "http": Plugin(_run_web, "pages", RUN_MESSAGES["http"], refers=True),
    "git": Plugin(_run_git, "repo_files", RUN_MESSAGES["git"], refers=True),
    "drive": Plugin(_run_drive, "drive_files", RUN_MESSAGES["drive"], refers=True),
}


def register(name: str, run: Runner, needs: str, message: str) -> None:
    """Make tasks whose plugin type is ``name`` run by ``run``, which returns records and problems."""
    _PLUGINS[name.lower()] = Plugin(run, needs, message)


def run_tasks(
    tasks: DataFrame,
    inputs: Inputs,
    *,
    run_ts: Column | None = None,
    transform: Callable[..., DataFrame] | None = None,
    transform_params: Mapping[str, object] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Run every enabled, valid task of a known status and trigger; returns their records and one status row per task.

    All tasks of a plugin run as one job. The records are written down once, those of a scan once for all tasks that
    ask for it and a content once for all records that hold it; what is returned has them by task and whole. The optional
    ``transform(records, **transform_params)`` is applied before anything is written, to whole records of each task,
    which are then written as it gives them. The status counts what was written, and tasks with a ``destination`` (plugin type and JSON configuration) have theirs
    written there too: all into outboxes by one job for each outbox, others by one for each destination. A task whose plugin has no input, or whose
    repository or folder is not there, fails.
    """
    if "enabled" in tasks.columns:
        tasks = tasks.where(F.coalesce("enabled", F.lit(True)))
    tasks = tasks.where(well_formed(tasks))
    staging = Staging(tasks.sparkSession, "run")
    own = F.lower("plugin_type").isin(*(set(_PLUGINS) - {"http", "git", "drive"}))
    checks = validate_tasks(tasks.where(~F.coalesce(own, F.lit(False)))).select("task_id", "plugin_type", "code", "message")
    checks = staging.write(
        checks.unionByName(
            tasks.where(own).select("task_id", F.lower("plugin_type").alias("plugin_type"), F.lit(200).alias("code"), F.lit(None).cast("string").alias("message"))
        ),
        "checks",
    )
    ready = tasks.join(checks.where("code = 200").select("task_id", F.col("plugin_type").alias("__plugin")), "task_id")
    brief = dict(inputs) if transform is not None else _brief(inputs)
    parts, problems, holders = [], [], []
    for name, plugin in _PLUGINS.items():
        mine = ready.where(F.col("__plugin") == name).drop("__plugin")
        if plugin.needs not in inputs:
            problems.append(mine.select("task_id", F.lit(NO_INPUT + plugin.needs).alias("problem")))
            continue
        refers = plugin.refers and transform is None
        found, lost, *scans = plugin.run(mine, brief if refers else inputs, run_ts)
        parts.append(referring(found) if refers else found)
        problems.append(lost)
        holders += scans
    if not parts:
        raise ValueError(f"no inputs for any plugin; expected some of {sorted(p.needs for p in _PLUGINS.values())}")
    asked = staging.write(records.unify(*holders), "holders") if holders else None
    written = Shared(records.unify(*parts), asked)
    if transform is not None:
        written = Shared(staging.write(written.of().transform(transform, **(transform_params or {})), "records"))
    else:
        # Part by part: plans stay small, and what a part has moved is let go of before the next one.
        columns = written.rows.schema
        for number, part in enumerate(parts):
            given = [(F.col(f"`{c.name}`") if c.name in part.columns else F.lit(None)).cast(c.dataType).alias(c.name) for c in columns]
            staging.write(part.select(*given), f"records/__part={number}")
        rows = tasks.sparkSession.read.schema(columns).parquet(f"{staging.path}/records").drop("__part")
        stores = _stores(inputs) if CONTENT in rows.columns else {}
        written = Shared(rows, asked, write_contents(rows, stores, staging) if stores else None)
    _deliver(written, ready)
    failed = problems[0]
    for more in problems[1:]:
        failed = failed.unionByName(more)
    said = {name: plugin.message for name, plugin in _PLUGINS.items()}
    code = F.when(F.col("problem").isNotNull(), 500).otherwise(F.col("code"))
    outcomes = checks.join(failed.groupBy("task_id").agg(F.min("problem").alias("problem")), "task_id", "left").select(
        "task_id", "plugin_type", code.alias("code"), F.coalesce("message", "problem", mapped(F.col("plugin_type"), said)).alias("message")
    )
    status = records.run_summary(written.counted(), outcomes, counted=True)
    return written.of(), status.select("task_id", "plugin_type", "success", "code", "message", "crawled_count", "error_count")


def _brief(inputs: Inputs) -> dict[str, DataFrame]:
    """Inputs whose contents are stand-ins, short enough to be moved and repeated. Links are still searched in ``pages``."""
    brief = dict(inputs)
    for name in ("repo_files", "drive_content"):
        if name in inputs:
            brief[name] = inputs[name].withColumn("content", stand_in(F.col("content").cast("binary")))
    if "pages" in inputs:
        pages = inputs["pages"]
        json = F.coalesce(F.col("content_type").contains("json"), F.lit(False)) if "content_type" in pages.columns else F.lit(False)
        brief["fetched"] = pages.withColumn("body", text_stand_in(F.col("body"), json))
    return brief


def _stores(inputs: Inputs) -> dict[str, DataFrame]:
    """The contents that records refer to, by the source of the records."""
    places = {"git": ("repo_files", "content"), "drive": ("drive_content", "content"), "web": ("pages", "body")}
    return {source: inputs[name].select(F.col(c).cast("binary").alias("content")) for source, (name, c) in places.items() if name in inputs}


def _deliver(written: Shared, tasks: DataFrame) -> None:
    """Write the records of tasks with a destination there; tasks that share one are written together.

    Destinations of the type ``outbox`` name a ``path`` and their own ``name`` in it; all that share a path
    are written in one pass over the records.
    """
    if "destination" not in tasks.columns:
        return
    chosen = tasks.where(F.col("destination")["pluginType"].isNotNull()).select("task_id", "destination.*")
    posted = F.lower("pluginType") == "outbox"
    place = F.from_json("config", "path string, name string")
    routes = chosen.where(posted).select("task_id", place["path"].alias("path"), place["name"].alias("destination"))
    for box in routes.select("path").distinct().collect():
        mine = routes.where(F.col("path") == box.path)
        Outbox(tasks.sparkSession, box.path).deliver(written.of(mine.select("task_id")), mine)
    chosen = chosen.where(~posted)
    for target in chosen.select("pluginType", "config").distinct().collect():
        same = F.col("pluginType").eqNullSafe(target.pluginType) & F.col("config").eqNullSafe(target.config)
        write_once(written.of(chosen.where(same).select("task_id")), target.pluginType, json.loads(target.config or "{}"))

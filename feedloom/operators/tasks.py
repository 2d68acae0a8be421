"""Task definitions: parsing, defaults and the checks made before a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsontext import is_json
from ..functions.values import is_blank, json_truthy
from ..schemas import DRIVE_CONFIG, GIT_CONFIG, WEB_CONFIG

# Every spelling a plugin goes by, compared in lower case.
PLUGIN_NAMES = {
    "http": ("http-crawler", "http"),
    "git": ("git-crawler", "git"),
    "drive": ("googledrive-crawler", "gdrive-crawler"),
}
# Configuration defaults.
WEB_DEFAULTS = {"maxDepth": 1, "recursiveCrawling": False, "sitemapDiscovery": False, "requestTimeoutMs": 30000}
GIT_DEFAULTS = {"branch": "main", "depth": 1}
DRIVE_DEFAULTS = {"authType": "service_account", "pageSize": 100}
# Why a task cannot run.
NO_PLUGIN = "Unsupported plugin type: "
NO_START_URL = "Missing 'startUrl' configuration for standard crawl."
NO_REPO_URL = "Missing 'repoUrl' configuration for Git crawl."
NO_FOLDER_ID = "Missing or invalid 'folderId' in configuration. Client not initialized."
NO_KEY = "Missing service account key configuration. Client not initialized."
BAD_KEY = "Invalid service account key: not valid JSON"
PARTIAL_KEY = "Incomplete service account key. Client not initialized."
# What a completed full run says.
RUN_MESSAGES = {
    "http": "HTTP crawl successful.",
    "git": "Repository cloned/pulled and files read successfully",
    "drive": "Google Drive folder scan successful.",
}
# The states a task can be in, and what can set one off.
TASK_STATUSES = ("SCHEDULED", "RUNNING", "COMPLETED", "FAILED", "DISABLED")
TRIGGER_TYPES = ("cron", "webhook", "manual")
# Fixed value: the folder id of the sample configuration.
PLACEHOLDER_FOLDER = "your_google_drive_folder_id"


def plugin_of(plugin_type: Column) -> Column:
    """``http``, ``git``, ``drive`` or NULL."""
    found = F.lit(None).cast("string")
    for plugin, names in PLUGIN_NAMES.items():
        found = F.when(F.lower(plugin_type).isin(*names), plugin).otherwise(found)
    return found


def well_formed(tasks: DataFrame) -> Column:
    """Whether a task's status and trigger type, where it has them, are known ones."""
    known = F.lit(True)
    for name, values in (("status", TASK_STATUSES), ("trigger_type", TRIGGER_TYPES)):
        if name in tasks.columns:
            known = known & F.coalesce(F.col(name).isin(*values), F.lit(True))
    return known


def parse_tasks(tasks: DataFrame) -> DataFrame:
    """Adds ``plugin`` and the parsed ``web``, ``git`` and ``drive`` configurations."""
    return tasks.select(
        "*",
        plugin_of(F.col("plugin_type")).alias("plugin"),
        F.from_json("config", WEB_CONFIG).alias("web"),
        F.from_json("config", GIT_CONFIG).alias("git"),
        F.from_json("config", DRIVE_CONFIG).alias("drive"),
    )


def web_tasks(tasks: DataFrame) -> DataFrame:
    """Crawl tasks in the columns :func:`feedloom.operators.web.crawl` reads.

    Runs use the task's own settings; an absent depth is 0 here, whatever the registered default.
    """
    web = F.col("web")
    return (
        parse_tasks(tasks)
        .where(F.col("plugin") == "http")
        .select(
            "task_id",
            web["startUrl"].alias("start_url"),
            web["maxDepth"].alias("max_depth"),
            F.coalesce(web["recursiveCrawling"], F.lit(False)).alias("recursive"),
            F.coalesce(web["sitemapDiscovery"], F.lit(False)).alias("sitemap_discovery"),
            web["allowedDomains"].alias("allowed_domains"),
            web["includePaths"].alias("include_paths"),
            web["excludePaths"].alias("exclude_paths"),
        )
    )


def validate_tasks(tasks: DataFrame) -> DataFrame:
    """``(task_id, plugin_type, code, message, run_depth, effective_*)`` per task.

    ``message`` is NULL for tasks that can run (code 200). The ``effective_`` columns are the task's
    settings with the registered defaults filled in, NULL where its plugin has none; ``run_depth`` is
    what a run uses. Key texts are checked, never selected; keys given as a file are not read.
    """
    web, git, drive = F.col("web"), F.col("git"), F.col("drive")
    plugin, key = F.col("plugin"), drive["serviceAccountKey"]

    def key_part(name: str) -> Column:
        return json_truthy(F.from_json(key, f"{name} variant")[name])

    def setting(name: str, config: Column, field: str, defaults) -> Column:
        return F.when(plugin == name, F.coalesce(config[field], F.lit(defaults[field])))

    is_drive = plugin == "drive"
    problem = (
        F.when(
            plugin.isNull(),
            _problem(400, F.concat(F.lit(NO_PLUGIN), F.coalesce("plugin_type", F.lit("undefined")))),
        )
        .when(
            (plugin == "http") & is_blank(web["startUrl"]),
            _problem(400, F.lit(NO_START_URL)),
        )
        .when(
            (plugin == "git") & is_blank(git["repoUrl"]),
            _problem(400, F.lit(NO_REPO_URL)),
        )
        .when(
            is_drive & (is_blank(drive["folderId"]) | (drive["folderId"] == PLACEHOLDER_FOLDER)),
            _problem(400, F.lit(NO_FOLDER_ID)),
        )
        .when(
            is_drive & is_blank(key) & is_blank(drive["serviceAccountKeyPath"]),
            _problem(400, F.lit(NO_KEY)),
        )
        .when(
            is_drive & ~is_blank(key) & ~is_json(key),
            _problem(500, F.lit(BAD_KEY)),
        )
        .when(
            is_drive & ~is_blank(key) & ~(key_part("client_email") & key_part("private_key")),
            _problem(400, F.lit(PARTIAL_KEY)),
        )
    )
    return (
        parse_tasks(tasks)
        .select(
            "task_id",
            F.coalesce(plugin, F.lit("unknown")).alias("plugin_type"),
            problem.alias("__problem"),
            F.when(plugin == "http", F.coalesce(web["maxDepth"], F.lit(WEB_DEFAULTS["maxDepth"])))
            .when(plugin == "git", F.coalesce(git["depth"], F.lit(GIT_DEFAULTS["depth"])))
            .alias("effective_depth"),
            F.when(plugin == "http", F.coalesce(web["maxDepth"], F.lit(0)))
            .when(plugin == "git", F.coalesce(git["depth"], F.lit(GIT_DEFAULTS["depth"])))
            .alias("run_depth"),
            setting("http", web, "recursiveCrawling", WEB_DEFAULTS).alias("effective_recursive"),
            setting("http", web, "sitemapDiscovery", WEB_DEFAULTS).alias("effective_sitemap"),
            setting("http", web, "requestTimeoutMs", WEB_DEFAULTS).alias("effective_timeout_ms"),
            setting("git", git, "branch", GIT_DEFAULTS).alias("effective_branch"),
            setting("drive", drive, "authType", DRIVE_DEFAULTS).alias("effective_auth_type"),
            setting("drive", drive, "pageSize", DRIVE_DEFAULTS).alias("effective_page_size"),
        )
        .select(
            "task_id",
            "plugin_type",
            F.coalesce(F.col("__problem")["code"], F.lit(200)).alias("code"),
            F.col("__problem")["message"].alias("message"),
            "effective_depth",
            "run_depth",
            "effective_recursive",
            "effective_sitemap",
            "effective_timeout_ms",
            "effective_branch",
            "effective_auth_type",
            "effective_page_size",
        )
    )


def _problem(code: int, message: Column) -> Column:
    return F.struct(F.lit(code).alias("code"), message.alias("message"))

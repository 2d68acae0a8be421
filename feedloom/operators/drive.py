"""Drive folder listings and change feeds as records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import first_text, is_blank, leading_int, lossy_utf8
from ..plans.lookup import lookup, lookup_staged, tied_first
from ..session import Staging
from .records import drive_key, to_records

# What native documents are exported as.
EXPORT_TYPES = {
    "application/vnd.google-apps.document": "text/plain",
    "application/vnd.google-apps.spreadsheet": "text/csv",
    "application/vnd.google-apps.presentation": "application/pdf",
}
# Defaults of a file without a name or a type.
DEFAULT_NAME = "unknown-name"
DEFAULT_MIME = "application/octet-stream"
# How a record came about; the last one in full scans and deltas alike.
DELTA = "gdrive_delta_sync"
DELTA_REMOVAL = "gdrive_delta_sync_removal"
DELTA_TRASH = "gdrive_delta_sync_trash"
FULL_SCAN = "gdrive_full_scan"
FULL_SCAN_TRASH = "gdrive_full_scan_trash"
FETCH_FAILED = "gdrive_full_scan_fetch_failed"


def content_plan(mime: Column) -> Column:
    """STRUCT<export_mime, content_kind>: how a file of this type is fetched and kept.

    Exports count as text whatever they are exported to, and so does every type naming json or
    xml, office files among them.
    """
    export = F.lit(None).cast("string")
    for native, exported in EXPORT_TYPES.items():
        export = F.when(mime == native, exported).otherwise(export)
    textual = mime.isin(*EXPORT_TYPES) | mime.startswith("text/") | mime.contains("json") | mime.contains("xml")
    return F.struct(export.alias("export_mime"), F.when(textual, "text").otherwise("binary").alias("content_kind"))


def file_url(file_id: Column, web_view: Column, web_content: Column) -> Column:
    return first_text(web_view, web_content, default_file_url(file_id))


def default_file_url(file_id: Column) -> Column:
    return F.concat(F.lit("https://drive.google.com/file/d/"), file_id, F.lit("/view"))


def _content(content: DataFrame) -> DataFrame:
    message = F.col("error") if "error" in content.columns else F.lit(None).cast("string")
    return content.select(
        F.col("file_id").alias("__lookup"),
        F.col("content").cast("binary").alias("__content"),
        message.alias("__fetch_error"),
    )


def _file_records(
    rows: DataFrame, keep: tuple[str, ...], action: Column, change_type: Column, ingestion: Column, run_ts
) -> DataFrame:
    """Records from rows with ``file_id``, ``file`` and looked-up content.

    ``action`` is ``removed``, ``trashed`` or ``live`` per row.
    """
    file, file_id = F.col("file"), F.col("file_id")
    removed, live = action == "removed", action == "live"
    failed = live & F.col("__content").isNull()
    ok = ~failed
    known = ~removed
    detailed = known & ok
    mime = F.coalesce(file["mimeType"], F.lit(DEFAULT_MIME))
    kind = content_plan(mime)["content_kind"]
    raw_text = F.col("__content").cast("string")
    error = F.when(
        failed, F.coalesce(F.col("__fetch_error"), F.concat(F.lit("File not found: "), file_id, F.lit(".")))
    )
    as_text = live & ok & (kind == "text")
    as_binary = live & ok & ((kind == "binary") | ~F.is_valid_utf8(raw_text))
    empty = ~live | (F.length(F.col("__content")) == 0)
    return to_records(
        rows,
        keep,
        source=F.lit("drive"),
        id=file_id,
        url=F.when(removed, default_file_url(file_id)).otherwise(
            file_url(file_id, file["webViewLink"], file["webContentLink"])
        ),
        status_code=F.when(failed, 500).otherwise(200),
        fetched_at=run_ts if run_ts is not None else F.lit(None),
        content_kind=F.when(failed, "error").when(empty, "empty").otherwise(kind),
        content_text=F.when(failed, F.concat(F.lit("Error fetching file: "), error))
        .when(empty, "")
        .when(as_text, lossy_utf8(F.col("__content"))),
        content_binary=F.when(as_binary & ~empty, F.col("__content")),
        change_type=F.when(ok, change_type),
        entity_key=drive_key(file_id),
        drive=F.struct(
            file_id.alias("file_id"),
            F.when(known, F.coalesce(file["name"], F.lit(DEFAULT_NAME))).alias("file_name"),
            F.when(known, mime).alias("mime_type"),
            F.when(
                detailed,
                F.when(is_blank(file["size"]), F.lit(0).cast("bigint")).otherwise(leading_int(file["size"])),
            ).alias("file_size"),
            F.when(failed, FETCH_FAILED).otherwise(ingestion).alias("ingestion_type"),
            F.when(detailed, F.coalesce(file["createdTime"], F.lit(""))).alias("created_time"),
            F.when(detailed, F.coalesce(file["modifiedTime"], F.lit(""))).alias("modified_time"),
            F.when(detailed, F.coalesce(file["parents"], F.array().cast("array<string>"))).alias("parents"),
            F.when(action == "trashed", F.lit(True)).alias("trashed"),
        ),
        error=error,
        task_id=F.col("task_id") if "task_id" in rows.columns else F.lit(None),
    )


def drive_listing(
    files: DataFrame, folder_id: str | Column | None, *, resume_after: str | None = None, include_trashed: bool = False
) -> DataFrame:
    """Files of a folder (of all, for None); with ``resume_after`` only those of greater ids.

    Rows without an id or a name are skipped; trashed files are listed only on request.
    """
    listed = files.where(~is_blank(F.col("id")) & ~is_blank(F.col("name")))
    if folder_id is not None:
        folder = F.lit(folder_id) if isinstance(folder_id, str) else folder_id
        listed = listed.where(F.array_contains(F.col("parents"), folder))
    if not include_trashed:
        listed = listed.where(~F.coalesce(F.col("trashed"), F.lit(False)))
    return listed if resume_after is None else listed.where(F.col("id") > resume_after)


def drive_full_scan(
    files: DataFrame,
    content: DataFrame,
    folder_id: str | Column | None,
    *,
    resume_after: str | None = None,
    include_trashed: bool = False,
    task_id: Column | None = None,
    run_ts: Column | None = None,
    staging: Staging | None = None,
) -> DataFrame:
    """Records of a folder. Live files carry no change type; a file without content is an error row.

    ``task_id`` is a Column over ``files``, for listings already matched with tasks. With ``staging``
    the listing is written down first, and a small one never moves the content store.
    """
    listed = drive_listing(files, folder_id, resume_after=resume_after, include_trashed=include_trashed)
    action = F.when(F.coalesce(F.col("trashed"), F.lit(False)), "trashed").otherwise("live")
    rows = listed.select(
        F.col("id").alias("file_id"),
        (task_id if task_id is not None else F.lit(None).cast("string")).alias("task_id"),
        action.alias("action"),
        F.struct(
            "name", "mimeType", "webViewLink", "webContentLink", "size", "createdTime", "modifiedTime", "parents"
        ).alias("file"),
        F.when(action == "live", F.col("id")).alias("__lookup"),
    )
    if staging is not None:
        got = lookup_staged(staging.write(rows, "listing"), _content(content), ["__lookup"])
    else:
        got = lookup(rows, _content(content), ["__lookup"])
    trashed = F.col("action") == "trashed"
    return _file_records(
        got,
        (),
        F.col("action"),
        F.when(trashed, "DELETE"),
        F.when(trashed, FULL_SCAN_TRASH).otherwise(FULL_SCAN),
        run_ts,
    )


def classify_change(folder_id: str | Column | None) -> Column:
    """``removed``, ``trashed``, ``live`` or NULL (skip) for a row of the change feed.

    Trash is decided before the folder test, so trashed files of any folder count.
    """
    file = F.col("file")
    trashed = F.coalesce(file["trashed"], F.lit(False))
    if folder_id is None:
        inside = F.lit(True)
    else:
        folder = F.lit(folder_id) if isinstance(folder_id, str) else folder_id
        inside = is_blank(folder) | F.coalesce(F.array_contains(file["parents"], folder), F.lit(False))
    return (
        F.when(is_blank(F.col("fileId")), None)
        .when(F.coalesce(F.col("removed"), F.lit(False)), "removed")
        .when(file.isNull(), None)
        .when(trashed, "trashed")
        .when(inside, "live")
    )


def _last_due(due: DataFrame, content: DataFrame) -> DataFrame:
    """Of relevant changes, the last of each file that counts: live ones only with a content to read."""
    live = F.col("action") == "live"
    due = tied_first(due.withColumn("__live", live), ["file_id", "__live"], [F.desc("seq")])
    readable = content.where("__content is not null").select("__lookup")
    counted = due.where("__live").join(readable, "__lookup", "left_semi").unionByName(due.where("not __live"), allowMissingColumns=True)
    return tied_first(counted, ["file_id"], [F.desc("seq"), F.desc("__live")]).select(*due.columns).drop("__live")


def drive_delta(
    changes: DataFrame,
    content: DataFrame,
    folder_id: str | Column | None,
    token: int | Column | None,
    *,
    newest: bool = False,
    run_ts: Column | None = None,
    staging: Staging | None = None,
) -> DataFrame:
    """``seq`` and the record for every relevant change from ``token`` on.

    Without a token nothing is due yet: the first run only learns where the feed stands (see
    :func:`drive_next_token`). Only live files inside the folder are looked up. With ``staging`` the
    relevant changes are written down first, and few of them never move the content store. For a stored
    corpus, ``newest`` gives only the records that ``changes.latest_changes`` keeps of all: the last change of
    each file is found before contents are looked up, so a file that changed often has its content moved once.
    """
    since = token if isinstance(token, Column) else F.lit(token).cast("bigint")
    due = (
        changes.where(F.col("seq") >= since)
        .withColumn("action", classify_change(folder_id))
        .where(F.col("action").isNotNull())
        .withColumnRenamed("fileId", "file_id")
        .withColumn("__lookup", F.when(F.col("action") == "live", F.col("file_id")))
    )
    if newest:
        due = _last_due(due, _content(content))
    if staging is not None:
        got = lookup_staged(staging.write(due, "due"), _content(content), ["__lookup"])
    else:
        got = lookup(due, _content(content), ["__lookup"])
    live = F.col("action") == "live"
    return _file_records(
        got,
        ("seq",),
        F.col("action"),
        F.when(live, "UPSERT").otherwise("DELETE"),
        F.when(live, DELTA)
        .when(F.col("action") == "trashed", DELTA_TRASH)
        .otherwise(DELTA_REMOVAL),
        run_ts,
    )


def effective_token(start_page_token: Column, next_page_token: Column) -> Column:
    """The token a run starts from: the start token, else the next token, else none."""
    return first_text(start_page_token, next_page_token)


# Ranges of positions that changes are counted in; finer ones only make smaller sorts.
_RANGES = 4096


def drive_next_token(changes: DataFrame, tokens: DataFrame) -> DataFrame:
    """``(task_id, next_token, n_changes)`` for each row of ``tokens(task_id, start_token, next_token)``.

    A task reads from its :func:`effective_token`. The next token is one past the newest change;
    when nothing new was read the old token stays. A task without a token reads nothing and gets the
    feed's current end. Changes are counted by ranges of positions, and within the ranges that a
    token falls into: no list of tokens goes through the driver or meets all changes.
    """
    token = effective_token(F.col("start_token").cast("string"), F.col("next_token").cast("string")).cast("bigint")
    wanted = tokens.select("task_id", token.alias("token"))
    span = changes.agg(F.min("seq").alias("low"), F.max("seq").alias("high")).select(
        "*", F.greatest(F.lit(1), F.ceil((F.col("high") - F.col("low") + 1) / _RANGES)).cast("bigint").alias("width")
    )
    # One row, so the planner broadcasts it.
    within = F.coalesce(F.floor((F.greatest("low", F.least("at", F.col("high") + 1)) - F.col("low")) / F.col("width")), F.lit(0))
    marks = changes.select(F.col("seq").alias("at"), F.lit(1).alias("n")).unionByName(
        wanted.where("token is not null").select(F.col("token").alias("at"), F.lit(0).alias("n")).distinct()
    )
    placed = marks.join(F.broadcast(span)).select("at", "n", "high", within.alias("range"))
    later = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("range").agg(F.sum("n").alias("n")).select("range", F.coalesce(F.sum("n").over(later), F.lit(0)).alias("beyond"))
    from_here = Window.partitionBy("range").orderBy(F.desc("at")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    counted = (
        placed.withColumn("here", F.sum("n").over(from_here))
        .where("n = 0")
        .join(counts, "range")
        .select(F.col("at").alias("token"), (F.col("here") + F.col("beyond")).alias("n_changes"))
    )
    end = F.col("high") + 1
    return (
        wanted.join(counted, "token", "left")
        .join(F.broadcast(span))
        .select(
            "task_id",
            F.when(F.col("token").isNull(), F.coalesce(end, F.lit(0)))
            .when(end > F.col("token"), end)
            .otherwise(F.col("token"))
            .alias("next_token"),
            F.coalesce("n_changes", F.lit(0)).alias("n_changes"),
        )
    )


def changes_per_page(changes: DataFrame, page_size: int = 100, token: int | None = None) -> DataFrame:
    """``(page, n)``: how many changes each page of the feed holds when it is read from ``token``.

    Every page but the last is full, whatever gaps the positions have, so one count decides.
    """
    if token is not None:
        changes = changes.where(F.col("seq") >= token)
    total = changes.count()
    n = F.least(F.lit(page_size), F.lit(total) - F.col("id") * page_size).cast("bigint")
    return changes.sparkSession.range(-(-total // page_size)).select(F.col("id").alias("page"), n.alias("n"))


def drive_content_plan(files: DataFrame) -> DataFrame:
    """How many files of each type are fetched and kept in which way."""
    mime = F.coalesce(F.col("mimeType"), F.lit(DEFAULT_MIME))
    return (
        files.groupBy(mime.alias("mime_type"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "mime_type",
            content_plan(F.col("mime_type"))["export_mime"].alias("export_mime"),
            content_plan(F.col("mime_type"))["content_kind"].alias("content_kind"),
            "n",
        )
    )


def drive_scan_counts(files: DataFrame, folder_id: str) -> DataFrame:
    """One row: how many live files the folder lists, and how many of them give records."""
    inside = files.where(
        F.array_contains(F.col("parents"), folder_id) & ~F.coalesce(F.col("trashed"), F.lit(False))
    )
    complete = ~is_blank(F.col("id")) & ~is_blank(F.col("name"))
    return inside.agg(F.count(F.lit(1)).alias("listed"), F.count_if(complete).alias("ingested"))


def drive_folder_edges(files: DataFrame) -> DataFrame:
    return files.select(F.col("id").alias("file_id"), F.explode("parents").alias("parent_id"))

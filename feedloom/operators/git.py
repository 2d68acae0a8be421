"""Repository trees and push events as records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsontext import has_keys, is_json
from ..functions.values import let, lossy_utf8
from ..plans.lookup import first_per_key, lookup, lookup_staged, tied_first
from ..schemas import PUSH
from ..session import Staging
from .records import git_key, to_records

# Outcomes of a push event.
PING_MESSAGE = "GitHub 'ping' event processed successfully (no data ingested)."
PUSH_MESSAGE = "Webhook processed and files ingested."
BAD_PUSH_MESSAGE = "Git operation failed: Invalid GitHub Push webhook payload structure."


def visible_path(path: Column) -> Column:
    """No segment starts with a dot."""
    return ~path.rlike(r"(^|/)\.")


def branch_of(ref: Column) -> Column:
    """A ref without its first ``refs/heads/``; tags stay as they are."""
    return F.regexp_replace(ref, r"(?s)^(.*?)refs/heads/", "$1")


def _kind(text: Column) -> Column:
    return F.when(text == "", "empty").otherwise("text")


def git_full_scan(
    repo_files: DataFrame,
    *,
    branch: str | Column = "main",
    task_id: Column | None = None,
    run_ts: Column | None = None,
) -> DataFrame:
    """Records of every readable visible file of one branch.

    Unreadable files (NULL content) give no row at all in a full scan, unlike in a push.
    """
    wanted = F.lit(branch) if isinstance(branch, str) else branch
    files = repo_files.where(
        (F.col("branch") == wanted) & visible_path(F.col("path")) & F.col("content").isNotNull()
    )
    text = lossy_utf8(F.col("content"))
    return to_records(
        files,
        source=F.lit("git"),
        id=F.concat_ws("-", "repo", "path"),
        url=F.concat(F.col("repo"), F.lit("/blob/"), F.col("branch"), F.lit("/"), F.col("path")),
        status_code=F.lit(200),
        fetched_at=run_ts if run_ts is not None else F.lit(None),
        content_kind=_kind(text),
        content_text=text,
        change_type=F.lit("full_scan"),
        entity_key=git_key(F.col("repo"), F.col("branch"), F.col("path")),
        git=F.struct(
            F.col("path").alias("file_path"),
            F.lit(None).cast("string").alias("commit_sha"),
            F.lit(None).cast("string").alias("commit_message"),
            F.col("repo"),
            F.col("branch"),
            F.lit(None).cast("string").alias("pusher"),
            F.lit(None).cast("string").alias("commit_author"),
        ),
        task_id=task_id if task_id is not None else F.lit(None),
    )


def _read_push(body: Column) -> Column:
    """STRUCT<outcome, push> of an event body, which is parsed once: ``ping``, ``push`` or ``bad``."""

    def judged(text: Column) -> Column:
        ping = has_keys(text, "zen", "hook_id")

        def with_push(p: Column) -> Column:
            whole = p["ref"].isNotNull() & p["repository"].isNotNull() & p["commits"].isNotNull() & is_json(text)
            outcome = F.when(ping, "ping").when(whole, "push").otherwise("bad")
            return F.struct(outcome.alias("outcome"), p.alias("push"))

        return let(F.from_json(text, PUSH), with_push)

    return let(body, judged)


def git_push_status(pushes: DataFrame, *keep: str) -> DataFrame:
    """Outcome of every push event: ``keep``, ``code``, ``message``, ``branch``.

    Pings succeed without data; a body that is not a push fails. ``branch`` is set for pushes.
    """
    outcome, push = F.col("__event")["outcome"], F.col("__event")["push"]
    return pushes.select(*keep, _read_push(F.col("body")).alias("__event")).select(
        *keep,
        F.when(outcome == "bad", 500).otherwise(200).alias("code"),
        F.when(outcome == "ping", PING_MESSAGE)
        .when(outcome == "push", PUSH_MESSAGE)
        .otherwise(BAD_PUSH_MESSAGE)
        .alias("message"),
        F.when(outcome == "push", branch_of(push["ref"])).alias("branch"),
    )


def _files(commit: Column) -> Column:
    """Files of a commit in the order added, modified, removed; repeats are kept."""

    def tagged(name: str, kind: str) -> Column:
        listed = F.coalesce(commit[name], F.array().cast("array<string>"))
        return F.transform(listed, lambda f: F.struct(f.alias("path"), F.lit(kind).alias("kind")))

    return F.concat(tagged("added", "added"), tagged("modified", "modified"), tagged("removed", "removed"))


def _last_touched(keyed: DataFrame, files: DataFrame, key: list[str], by: str) -> DataFrame:
    """Of touched files, the last touch of each entity that counts: added and modified ones only with a content to read."""
    entity, removed = git_key(F.col("__name"), F.col("__branch"), F.col("__path")), F.col("__kind") == "removed"
    order = [F.desc(by), F.desc("__pos"), F.concat_ws("-", "__name", "__path").desc(), F.asc("__removed")]
    rows = keyed.withColumns({"__entity": entity, "__removed": removed}).where("__entity is not null")
    rows = tied_first(rows, ["__entity", "__removed", *key], order)
    held = first_per_key(files.select(*key, "__held", F.col("content").isNull().alias("__none")), key, [F.asc("__held"), F.asc("__none")])
    readable = held.where("not __none").select(*key)
    counted = rows.where("not __removed").join(readable, key, "left_semi").unionByName(rows.where("__removed"))
    return tied_first(counted, ["__entity"], order).select(*keyed.columns)


def git_push_delta(
    pushes: DataFrame,
    repo_files: DataFrame,
    *keep: str,
    newest_by: str | None = None,
    run_ts: Column | None = None,
    staging: Staging | None = None,
) -> DataFrame:
    """Records for the files the head commit of every push touches.

    Added and modified files get their content from ``repo_files`` at the pushed commit, or become
    an error row; removed files become tombstones. Pings, malformed bodies and pushes without a
    head commit give no rows. Works on a stream of pushes as well. ``pos`` is the file's place within
    its push. A commit that the table holds under several branches counts once. With ``staging`` the
    list of files is written down first, and a short one never moves the content. For a stored corpus,
    ``newest_by`` names the column of ``keep`` that orders pushes, and only the records that ``changes.latest_changes``
    keeps of all are given: the last touch of each file is found before contents are looked up.
    """

    def head_files(event: Column) -> Column:
        p = event["push"]
        head = p["head_commit"]
        about = F.struct(
            p["repository"]["full_name"].alias("name"),
            p["repository"]["html_url"].alias("home"),
            p["after"].alias("after"),
            branch_of(p["ref"]).alias("branch"),
            p["pusher"]["name"].alias("pusher"),
            head["id"].alias("commit"),
            head["message"].alias("message"),
            head["author"]["name"].alias("author"),
        )
        rows = F.transform(_files(head), lambda f: F.struct(f["path"].alias("path"), f["kind"].alias("kind"), about.alias("about")))
        return F.when((event["outcome"] == "push") & head.isNotNull(), rows)

    # One generator holds all the parsing: as separate columns and filters the optimizer would
    # push and repeat them, and parse every body many times over.
    changes = pushes.select(
        *keep, F.posexplode(let(_read_push(F.col("body")), head_files)).alias("__pos", "__file")
    ).select(
        *keep,
        "__pos",
        F.col("__file")["path"].alias("__path"),
        F.col("__file")["kind"].alias("__kind"),
        *[
            F.col("__file")["about"][name].alias(f"__{name}")
            for name in ("name", "home", "after", "branch", "pusher", "commit", "message", "author")
        ],
    )
    if staging is not None:
        changes = staging.write(changes, "push_files")  # bodies are parsed once
    removed = F.col("__kind") == "removed"
    # Tombstones need no content: a NULL key keeps them out of the match.
    keyed = changes.select(
        "*",
        F.when(~removed, F.col("__home")).alias("repo"),
        F.when(~removed, F.col("__after")).alias("commit_sha"),
        F.when(~removed, F.col("__path")).alias("path"),
    )
    key = ["repo", "commit_sha", "path"]
    files = repo_files.select(*key, F.coalesce("branch", F.lit("")).alias("__held"), "content")
    if newest_by is not None:
        keyed = _last_touched(keyed, files, key, newest_by)
        keyed = keyed if staging is None else staging.write(keyed, "newest")
    # A commit's files are the same on every branch: the least branch counts.
    if staging is not None:
        # The branch is settled among the files that were pushed, before a file meets its many pushes.
        got = lookup_staged(keyed, files, key, first_by=[F.asc("__held"), F.col("content").isNull().asc()])
    else:
        chosen = files.groupBy(*key).agg(F.min("__held").alias("__held"))
        got = lookup(lookup(keyed, chosen, key), files, [*key, "__held"])

    failed = ~removed & F.col("content").isNull()
    file_id = F.concat_ws("-", "__name", "__path")
    message = F.when(
        failed, F.concat(F.lit("ENOENT: no such file or directory, open '"), F.col("__path"), F.lit("'"))
    )
    text = F.when(removed, "").otherwise(lossy_utf8(F.col("content")))
    unless_failed = lambda c: F.when(~failed, c)
    return to_records(
        got.withColumnRenamed("__pos", "pos"),
        (*keep, "pos"),
        source=F.lit("git"),
        id=F.when(failed, F.concat(file_id, F.lit("-error"))).otherwise(file_id),
        url=unless_failed(
            F.concat(F.col("__home"), F.lit("/blob/"), F.col("__branch"), F.lit("/"), F.col("__path"))
        ),
        status_code=F.when(failed, 500).otherwise(200),
        fetched_at=run_ts if run_ts is not None else F.lit(None),
        content_kind=F.when(failed, "error").otherwise(_kind(text)),
        content_text=F.when(failed, F.concat(F.lit("Error reading file: "), message)).otherwise(text),
        change_type=F.col("__kind"),
        entity_key=git_key(F.col("__name"), F.col("__branch"), F.col("__path")),
        git=F.struct(
            F.col("__path").alias("file_path"),
            F.col("__commit").alias("commit_sha"),
            unless_failed(F.col("__message")).alias("commit_message"),
            F.col("__name").alias("repo"),
            F.col("__branch").alias("branch"),
            unless_failed(F.col("__pusher")).alias("pusher"),
            unless_failed(F.col("__author")).alias("commit_author"),
        ),
        error=message,
    )


def push_commit_files(pushes: DataFrame, *keep: str) -> DataFrame:
    """``(keep, repo, commit_id, path, kind)`` for every file of every commit a push carries."""

    def all_files(event: Column) -> Column:
        name = event["push"]["repository"]["full_name"]

        def of_commit(c: Column) -> Column:
            return F.transform(
                _files(c),
                lambda f: F.struct(
                    name.alias("repo"), c["id"].alias("commit_id"), f["path"].alias("path"), f["kind"].alias("kind")
                ),
            )

        return F.when(event["outcome"] == "push", F.flatten(F.transform(event["push"]["commits"], of_commit)))

    return pushes.select(*keep, F.inline(let(_read_push(F.col("body")), all_files)))

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from feedloom.operators import records, tasks
from feedloom.plans import runs
from feedloom.plans.runs import run_tasks
from feedloom.schemas import DRIVE_CHANGE, DRIVE_CONTENT, DRIVE_FILE

KEY = json.dumps({"client_email": "a@b.c", "private_key": "k"})


def defs(spark, *rows):
    data = [(f"t{i}", plugin, json.dumps(config) if not isinstance(config, str) else config) for i, (plugin, config) in enumerate(rows)]
    return spark.createDataFrame(data, "task_id string, plugin_type string, config string")


@pytest.mark.parametrize(
    "plugin, config, code, message",
    [
        ("http-crawler", {"startUrl": "https://a"}, 200, None),
        ("http-crawler", {}, 400, "Missing 'startUrl' configuration for standard crawl."),
        ("http-crawler", {"startUrl": ""}, 400, "Missing 'startUrl' configuration for standard crawl."),
        ("Git-Crawler", {"repoUrl": "r"}, 200, None),
        ("git", {}, 400, "Missing 'repoUrl' configuration for Git crawl."),
        ("gdrive-crawler", {"serviceAccountKey": KEY}, 400, "Missing or invalid 'folderId' in configuration. Client not initialized."),
        ("googledrive-crawler", {"folderId": "your_google_drive_folder_id"}, 400, "Missing or invalid 'folderId' in configuration. Client not initialized."),
        ("googledrive-crawler", {"folderId": "f"}, 400, "Missing service account key configuration. Client not initialized."),
        ("googledrive-crawler", {"folderId": "f", "serviceAccountKey": "{x"}, 500, "Invalid service account key: not valid JSON"),
        ("googledrive-crawler", {"folderId": "f", "serviceAccountKey": "{}"}, 400, "Incomplete service account key. Client not initialized."),
        ("googledrive-crawler", {"folderId": "f", "serviceAccountKey": KEY}, 200, None),
        ("googledrive-crawler", {"folderId": "f", "serviceAccountKeyPath": "/k"}, 200, None),
        ("s3", {}, 400, "Unsupported plugin type: s3"),
        (None, {}, 400, "Unsupported plugin type: undefined"),
    ],
)
def test_validate(spark, plugin, config, code, message):
    r = tasks.validate_tasks(defs(spark, (plugin, config))).first()
    assert (r.code, r.message) == (code, message)


def test_registered_and_run_time_depth(spark):
    got = tasks.validate_tasks(
        defs(spark, ("http", {"startUrl": "a"}), ("http", {"startUrl": "a", "maxDepth": 3}), ("git", {"repoUrl": "r"}), ("git", {"repoUrl": "r", "depth": 5}))
    ).orderBy("task_id").collect()
    assert [(r.effective_depth, r.run_depth) for r in got] == [(1, 0), (3, 3), (1, 1), (5, 5)]


def test_key_texts_are_not_in_the_result(spark):
    got = tasks.validate_tasks(defs(spark, ("gdrive-crawler", {"folderId": "f", "serviceAccountKey": KEY})))
    assert not any("a@b.c" in str(v) for r in got.collect() for v in r)


def test_web_tasks_keep_empty_lists(spark):
    r = tasks.web_tasks(defs(spark, ("http", {"startUrl": "a", "allowedDomains": []}))).first()
    assert (r.allowed_domains, r.include_paths, r.max_depth, r.recursive) == ([], None, None, False)


def test_run_tasks(spark):
    todo = defs(
        spark,
        ("http-crawler", {"startUrl": "https://h/", "maxDepth": 1, "recursiveCrawling": True}),
        ("git-crawler", {"repoUrl": "https://github.com/u/r"}),
        ("git", {"repoUrl": "https://github.com/u/r", "branch": "dev"}),
        ("gdrive-crawler", {"folderId": "f1", "serviceAccountKey": KEY}),
        ("gdrive-crawler", {"folderId": "f2", "serviceAccountKey": KEY}),
        ("git", {}),
        ("http", {"startUrl": "https://off/"}),
    ).withColumn("enabled", F.col("task_id") != "t6")
    pages = spark.createDataFrame(
        [("https://h/", 200, "text/html", '<a href="/a">'), ("https://h/a", 200, "text/html", "x")],
        "url string, status_code int, content_type string, body string")
    repo_files = spark.createDataFrame(
        [("https://github.com/u/r", "main", "c", "a", bytearray(b"a")), ("https://github.com/u/r", "dev", "c", "b", bytearray(b"b")), ("other", "main", "c", "c", bytearray(b"c"))],
        "repo string, branch string, commit_sha string, path string, content binary")
    listing = spark.createDataFrame(
        [(f"d{i}", "n", "text/plain", None, None, "1", None, None, parents, False) for i, parents in enumerate([["f1"], ["f1", "f2"], ["x"]])], DRIVE_FILE)
    content = spark.createDataFrame([(f"d{i}", bytearray(b"t"), None) for i in range(2)], DRIVE_CONTENT)
    found, status = run_tasks(
        todo, {"pages": pages, "repo_files": repo_files, "drive_files": listing, "drive_content": content},
        transform=lambda df, tag: df.withColumn("tag", F.lit(tag)), transform_params={"tag": "x"})
    assert {(r.task_id, r.id, r.tag) for r in found.collect()} == {
        ("t0", "https://h/", "x"), ("t0", "https://h/a", "x"), ("t1", "https://github.com/u/r-a", "x"), ("t2", "https://github.com/u/r-b", "x"),
        ("t3", "d0", "x"), ("t3", "d1", "x"), ("t4", "d1", "x")}
    assert {r.message for r in status.where("success").collect()} == set(tasks.RUN_MESSAGES.values())
    got = {r.task_id: (r.success, r.code, r.crawled_count) for r in status.collect()}
    assert got == {"t0": (True, 200, 2), "t1": (True, 200, 1), "t2": (True, 200, 1), "t3": (True, 200, 2), "t4": (True, 200, 1), "t5": (False, 400, 0)}
    with pytest.raises(ValueError):
        run_tasks(todo, {})


REPO_FILES = "repo string, branch string, commit_sha string, path string, content binary"


def outcome(status):
    return {r.task_id: (r.success, r.code, r.crawled_count, r.message) for r in status.collect()}


def test_what_did_not_run_is_a_failure(spark):
    todo = defs(spark, ("http", {"startUrl": "https://h/"}), ("git", {"repoUrl": "gone"}), ("git", {"repoUrl": "r", "branch": "x"}), ("git", {"repoUrl": "r"}))
    files = spark.createDataFrame([("r", "main", "c", "a", bytearray(b"a"))], REPO_FILES)
    found = outcome(run_tasks(todo, {"repo_files": files})[1])
    assert {k: v[:3] for k, v in found.items()} == {"t0": (False, 500, 0), "t1": (False, 500, 0), "t2": (False, 500, 0), "t3": (True, 200, 1)}
    assert found["t1"][3].endswith("gone main") and "pages" in found["t0"][3]


def test_events_and_tokens_make_deltas(spark):
    todo = defs(spark, ("git", {"repoUrl": "https://github.com/u/r"}), ("git", {"repoUrl": "https://github.com/u/r"}),
                ("gdrive-crawler", {"folderId": "f", "serviceAccountKey": KEY}), ("gdrive-crawler", {"folderId": "f", "serviceAccountKey": KEY}))
    todo = todo.withColumn("next_page_token", F.when(F.col("task_id") == "t2", "7"))
    files = spark.createDataFrame([("https://github.com/u/r", b, "c1", p, bytearray(p.encode())) for b in ("dev", "main") for p in ("a", "b")], REPO_FILES)
    body = json.dumps({"ref": "refs/heads/main", "after": "c1", "repository": {"full_name": "u/r", "html_url": "https://github.com/u/r"}, "pusher": {"name": "p"},
                       "commits": [], "head_commit": {"id": "c1", "message": "m", "author": {"name": "n"}, "added": ["a"], "modified": [], "removed": ["z"]}})
    pushes = spark.createDataFrame([("t0", 3, body), ("other", 4, body)], "task_id string, event_id long, body string")
    def file(i):
        return (f"d{i}", "n", "text/plain", None, None, "1", None, None, ["f"], False)
    listing = spark.createDataFrame([file(i) for i in range(3)], DRIVE_FILE)
    content = spark.createDataFrame([(f"d{i}", bytearray(b"t"), None) for i in range(3)], DRIVE_CONTENT)
    feed = spark.createDataFrame([(s, f"d{s % 3}", s == 9, file(s % 3), t) for t in ("t2", "t3") for s in (5, 7, 9)], DRIVE_CHANGE + ", task_id string")
    records, status = run_tasks(todo, {"repo_files": files, "pushes": pushes, "drive_files": listing, "drive_content": content, "drive_changes": feed})
    got = sorted((r.task_id, r.id, r.change_type) for r in records.collect())
    assert got == [("t0", "u/r-a", "added"), ("t0", "u/r-z", "removed"), ("t1", "https://github.com/u/r-a", "full_scan"), ("t1", "https://github.com/u/r-b", "full_scan"),
                   ("t2", "d0", "DELETE"), ("t2", "d1", "UPSERT"), ("t3", "d0", None), ("t3", "d1", None), ("t3", "d2", None)]
    assert {k: v[:3] for k, v in outcome(status).items()} == {"t0": (True, 200, 2), "t1": (True, 200, 2), "t2": (True, 200, 2), "t3": (True, 200, 3)}


def shared_inputs(spark):
    """Tables with contents of all kinds, some of them held several times, and tasks that ask for the same."""
    bodies = [b"a", b"", None, b"a", b"\xffb", "ü\ufeff".encode(), b"sha256:" + b"0" * 64, b'{"k": 1}']
    mimes = ["text/plain", "image/png", "application/json", None]
    files = spark.createDataFrame(
        [("r", branch, "c1", f"f{i}", None if b is None else bytearray(b)) for i, b in enumerate(bodies) for branch in (("main", "dev") if i % 2 else ("main",))], REPO_FILES)
    listing = spark.createDataFrame(
        [(f"d{i}-{j}", "n", mime, None, None, "1", None, None, ["f", "g", "f"] if i % 2 else ["f"], i == 3) for i in range(len(bodies)) for j, mime in enumerate(mimes)], DRIVE_FILE)
    content = spark.createDataFrame([(f"d{i}-{j}", None if b is None else bytearray(b), "gone" if b is None else None) for i, b in enumerate(bodies) for j in range(len(mimes))], DRIVE_CONTENT)
    pages = spark.createDataFrame(
        [(f"https://h/{i}", 200 if i else 404, kind, body) for i, (kind, body) in enumerate(
            (k, b) for k in ("text/html", "application/json", None) for b in ("", None, "a", '{"k": 1}', "\ufeffü", "sha256:" + "0" * 64))],
        "url string, status_code int, content_type string, body string")
    feed = spark.createDataFrame([(s, r.id, s == 9, r) for s, r in enumerate(listing.collect())], DRIVE_CHANGE).withColumn("task_id", F.lit("t5"))
    body = json.dumps({"ref": "refs/heads/main", "after": "c1", "repository": {"full_name": "r", "html_url": "r"}, "pusher": {"name": "p"}, "commits": [],
                       "head_commit": {"id": "c1", "message": "m", "author": {"name": "n"}, "added": [f"f{i}" for i in range(9)], "modified": ["f0"], "removed": ["z"]}})
    pushes = spark.createDataFrame([("t2", 3, body), ("t2", 4, body)], "task_id string, event_id long, body string")
    todo = defs(spark, *[("git", {"repoUrl": "r"})] * 3, *[("gdrive-crawler", {"folderId": "f", "serviceAccountKey": KEY})] * 3, ("gdrive-crawler", {"folderId": "g", "serviceAccountKey": KEY}),
                *[("http", {"startUrl": f"https://h/{i % 20}"}) for i in range(40)], ("git", {"repoUrl": "r", "branch": "dev"}))
    todo = todo.withColumn("start_page_token", F.when(F.col("task_id") == "t5", "0"))
    todo = todo.unionByName(todo.where("task_id IN ('t1', 't4', 't9')"))
    return todo, {"pages": pages, "repo_files": files, "pushes": pushes, "drive_files": listing, "drive_content": content, "drive_changes": feed}


def test_shared_records_are_whole(spark):
    todo, tables = shared_inputs(spark)
    found, status = run_tasks(todo, tables)
    whole, counted = run_tasks(todo, tables, transform=lambda df: df)  # what a transform gets is written as it is
    assert found.columns == whole.columns and found.count() > 200
    assert sorted(map(repr, found.collect())) == sorted(map(repr, whole.collect()))
    assert sorted(map(repr, status.collect())) == sorted(map(repr, counted.collect()))


def test_scans_and_contents_are_written_once(spark):
    files = spark.createDataFrame([("r", "main", "c", f"f{i}", bytearray(b"x" * (i + 1))) for i in range(10)], REPO_FILES)
    body = json.dumps({"ref": "refs/heads/main", "after": "c", "repository": {"full_name": "r", "html_url": "r"}, "pusher": {"name": "p"}, "commits": [],
                       "head_commit": {"id": "c", "message": "m", "author": {"name": "n"}, "added": ["f0", "f1"], "modified": ["f0"], "removed": []}})
    pushes = spark.createDataFrame([("t0", i, body) for i in range(20)], "task_id string, event_id long, body string")
    listing = spark.createDataFrame([(f"d{i}", "n", "text/plain", None, None, "1", None, None, ["f"], False) for i in range(10)], DRIVE_FILE)
    content = spark.createDataFrame([(f"d{i}", bytearray(b"y" * (i + 1)), None) for i in range(10)], DRIVE_CONTENT)
    todo = defs(spark, *[("git", {"repoUrl": "r"})] * 31, *[("gdrive-crawler", {"folderId": "f", "serviceAccountKey": KEY})] * 30)
    place = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(place.iterdir())
    found, status = run_tasks(todo, {"repo_files": files, "pushes": pushes, "drive_files": listing, "drive_content": content})
    assert found.count() == 60 + 30 * 10 + 30 * 10 == sum(r.crawled_count for r in status.collect())
    (run,) = (p for p in set(place.iterdir()) - before if p.name.startswith("run-"))
    assert spark.read.parquet(str(run / "records")).count() == 60 + 10 + 10
    texts = [r.content_text for r in spark.read.parquet(str(run / "records")).collect()] + [bytes(r.content).decode() for r in spark.read.parquet(str(run / "contents")).collect()]
    assert sorted(filter(None, texts)) == sorted([c * (i + 1) for c in "xy" for i in range(10)])


def test_destinations_and_own_plugins(spark, tmp_path):
    runs.register("mine", lambda todo, inputs, run_ts: (inputs["mine"].join(todo.select("task_id"), "task_id"), runs._none(todo)), "mine", "Done.")
    try:
        todo = defs(spark, ("Mine", "{}"), ("mine", "{}"), ("mine", "{}"))
        place = json.dumps({"path": str(tmp_path / "o")})
        target = F.when(F.col("task_id") != "t2", F.struct(F.lit("files").alias("pluginType"), F.lit(place).alias("config")))
        mine = records.to_records(spark.createDataFrame([(f"t{i}",) for i in (0, 1, 1, 2)], "k string"), source=F.lit("own"), status_code=F.lit(200), task_id=F.col("k"))
        found, status = run_tasks(todo.withColumn("destination", target), {"mine": mine})
        assert {k: v for k, v in outcome(status).items()} == {"t0": (True, 200, 1, "Done."), "t1": (True, 200, 2, "Done."), "t2": (True, 200, 1, "Done.")}
        assert sorted(r.task_id for r in spark.read.parquet(str(tmp_path / "o")).collect()) == ["t0", "t1", "t1"]
    finally:
        runs._PLUGINS.pop("mine")


def test_well_formed(spark):
    rows = spark.createDataFrame(
        [("RUNNING", "cron", True), (None, None, True), ("running", "cron", False), ("FAILED", "timer", False)],
        "status string, trigger_type string, want boolean")
    assert all(r.want is r.got for r in rows.select("want", tasks.well_formed(rows).alias("got")).collect())
    assert spark.range(1).select(tasks.well_formed(spark.range(1))).first()[0] is True


def test_mappings(spark):
    from feedloom.functions.mappings import mapped

    rows = spark.createDataFrame([("MALE",), ("FEMALE",), ("male",), (None,)], "g string")
    assert [r[0] for r in rows.select(mapped(F.col("g"), "GENDER")).collect()] == [True, False, None, None]

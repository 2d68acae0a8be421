"""Clustered stores: look-ups by key that leave the long rows where they are."""

import re

import pytest
from pyspark.sql import functions as F

from feedloom.operators import changes, drive, git, web
from feedloom.plans.lookup import first_per_key
from feedloom.session import Staging
from feedloom.sinks.clustered import Clustered, bucket_of
from querybook import inputs


@pytest.fixture
def no_broadcast(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def below_exchanges(text):
    """The subtree of every exchange of a plan."""
    lines = text.splitlines()
    depth = [len(re.match(r"[\s:|+\-]*", line).group()) for line in lines]
    for i, line in enumerate(lines):
        if "Exchange " in line:
            j = i + 1
            while j < len(lines) and depth[j] > depth[i]:
                j += 1
            yield "\n".join(lines[i:j])


def moved(text, column):
    """How many exchanges have a long column below them."""
    return sum(column in part for part in below_exchanges(text))


def texts(df):
    return sorted(map(str, df.collect()))


def test_a_clustered_snapshot_is_not_moved(spark, data, tmp_path, no_broadcast):
    pages = inputs.raw_pages(spark, data)
    store = Clustered.write(web.keyed_pages(web.page_snapshot(pages)), str(tmp_path / "s"), web.FETCH_KEY, 8)
    front = pages.select("url").unionByName(pages.select(F.concat("url", F.lit("/none")).alias("url")))
    found = web.web_fetch(front, store.read())
    assert "body" in plan(found) and moved(plan(found), "body") == 0
    assert moved(plan(web.web_fetch(front, web.page_snapshot(pages))), "body") >= 1
    assert texts(found) == texts(web.web_fetch(front, web.page_snapshot(pages)))


def test_a_clustered_drive_is_not_moved(spark, data, tmp_path, no_broadcast):
    files, content = inputs.drive_files(spark, data), inputs.drive_content(spark, data)
    store = Clustered.write(content, str(tmp_path / "s"), "file_id", 8)
    found = drive.drive_full_scan(files, store.read(), "shared")
    # The listing moves; the store of contents does not.
    assert not [part for part in below_exchanges(plan(found)) if str(tmp_path) in part or "clustered_" in part]
    assert texts(found) == texts(drive.drive_full_scan(files, content, "shared"))


def test_few_keys_open_few_files(spark, tmp_path):
    rows = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("n"))
    store = Clustered.write(rows, str(tmp_path / "s"), "key", 32, distinct_keys=2000)
    assert {len(f) for f in store.files().values()} == {1} and len(store.files()) == 32
    wanted = spark.createDataFrame([("k5",), ("k77",), (None,), ("absent",)], "key string")
    part = store.holding(wanted, "key")
    hit = {r[0] for r in wanted.where("key is not null").select(bucket_of(F.col("key"), 32)).collect()}
    assert len(part.inputFiles()) == len(hit) <= 3
    assert {tuple(r) for r in part.join(wanted, "key").select("key", "n").collect()} == {("k5", 5), ("k77", 77)}
    assert len(store.holding(rows, "key").inputFiles()) == 32
    assert store.holding(wanted.where("key is null"), "key").count() == 0


def test_a_store_is_opened_again_and_never_overwritten(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, [1.5]), ("b", 2, None), (None, 3, [])], "key string, n int, `odd name` array<double>")
    Clustered.write(rows, str(tmp_path / "s"), "key", 4)
    again = Clustered(spark, str(tmp_path / "s"))
    assert again.read().schema == rows.schema and texts(again.read()) == texts(rows)
    with pytest.raises(ValueError):
        Clustered.write(rows, str(tmp_path / "s"), "key", 4)
    empty = Clustered.write(rows.limit(0), str(tmp_path / "e"), "key", 4)
    assert empty.read().count() == 0


def test_bodies_move_once(spark, data, tmp_path, no_broadcast):
    """One exchange with bodies and no aggregate over them."""
    snapshot = web.page_snapshot(inputs.raw_pages(spark, data))
    assert moved(plan(snapshot), "html") == 1 and "Aggregate" not in plan(snapshot)
    content = inputs.drive_content(spark, data)
    delta = drive.drive_delta(inputs.drive_changes(spark, data), content, "shared", 0)
    written = Staging(spark, "t").write(delta, "delta")
    last = changes.latest_changes(written)
    assert moved(plan(last), "content_text") == 1 and "Aggregate" not in plan(last)


def test_pushes_scan_contents_once(spark, data):
    files = Staging(spark, "t").write(inputs.repo_files(spark, data), "files")
    delta = git.git_push_delta(inputs.push_events(spark, data), files, "event_id", staging=Staging(spark, "t"))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan(delta))
    assert len(scans) >= 3 and sum("content#" in columns for columns in scans) == 1


def test_first_of_each_key(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "y"), (None, 1, "z"), (None, None, "w"), ("b", None, "v")]
    df = spark.createDataFrame(rows, "k string, n int, t string")
    assert {tuple(r) for r in first_per_key(df, ["k"], [F.desc("n"), F.desc("t")]).collect()} == {("a", 2, "y"), (None, 1, "z"), ("b", None, "v")}
    assert "WindowGroupLimit" in plan(first_per_key(df, ["k"], [F.desc("n")]))

"""Streams give what batch runs give; sources and sinks keep every row."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from feedloom.operators import drive, git, webhooks
from feedloom.schemas import DRIVE_CHANGE
from feedloom.sinks import destinations
from feedloom.sinks.corpus import Corpus, TokenState
from feedloom.plans.runs import run_tasks
from feedloom.session import Staging
from feedloom.sinks.outbox import Outbox
from feedloom.sources import drive_feed, repo_tree, tables, tree_listing
from feedloom.streaming import jobs
from querybook import inputs


def texts(df, *drop):
    return sorted(json.dumps(r.asDict(True), default=str, sort_keys=True) for r in df.drop(*drop).collect())


def write_files(df, path, n=3):
    df.repartition(n).write.json(str(path))


class Kept:
    """A writer that keeps its batches."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, str(path)

    def __call__(self, batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def read(self):
        return self.spark.read.parquet(self.path)


def test_webhook_stream(spark, data, tmp_path):
    deliveries = inputs.deliveries(spark, data).drop("secret").cache()
    write_files(deliveries, tmp_path / "in")
    kept = Kept(spark, tmp_path / "out")
    stream = jobs.deliveries(spark, str(tmp_path / "in"), files_per_batch=1)
    jobs.run_webhooks(stream, inputs.endpoints(spark), str(tmp_path / "check"), kept).awaitTermination()
    batch = webhooks.normalize_webhooks(deliveries, inputs.endpoints(spark))
    assert texts(kept.read(), "batch") == texts(batch)
    assert kept.read().select("batch").distinct().count() >= 3


def test_webhooks_straight_on_a_stream(spark, data, tmp_path):
    """Without foreachBatch: the transform itself is stateless and appends."""
    deliveries = inputs.deliveries(spark, data).drop("secret")
    write_files(deliveries, tmp_path / "in")
    verdicts = webhooks.normalize_webhooks(jobs.deliveries(spark, str(tmp_path / "in")), inputs.endpoints(spark))
    query = verdicts.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out"))
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == deliveries.count()


def test_push_stream(spark, data, tmp_path):
    pushes, files = inputs.push_events(spark, data), inputs.repo_files(spark, data)
    write_files(pushes, tmp_path / "in")
    kept = Kept(spark, tmp_path / "out")
    stream = jobs.push_events(spark, str(tmp_path / "in"), files_per_batch=1)
    jobs.run_pushes(stream, files, str(tmp_path / "check"), kept).awaitTermination()
    batch = git.git_push_delta(pushes, files, "event_id").withColumnRenamed("event_id", "seq")
    assert texts(kept.read(), "batch") == texts(batch)


def test_drive_stream_keeps_a_corpus_and_resumes(spark, data, tmp_path):
    content = inputs.drive_content(spark, data)
    changes = inputs.drive_changes(spark, data).cache()
    feed, check = tmp_path / "in", str(tmp_path / "check")
    half = changes.count() // 2
    corpus, tokens = Corpus(spark, str(tmp_path / "corpus")), TokenState(spark, str(tmp_path / "tokens"))

    def run():
        stream = jobs.drive_changes(spark, str(feed))
        jobs.run_drive(stream, content, "shared", check, corpus.stream_writer(check), tokens=tokens, start_token=0).awaitTermination()

    changes.where(F.col("seq") < half).coalesce(1).write.mode("append").json(str(feed))
    run()
    assert corpus.compact() == corpus.version() == 0
    assert [r.next_token for r in tokens.read().collect()] == [half]
    changes.where(F.col("seq") >= half).coalesce(1).write.mode("append").json(str(feed))
    run()
    assert corpus.version() == 0
    from feedloom.operators.changes import apply_changes

    want = apply_changes(None, drive.drive_delta(changes, content, "shared", 0))
    assert texts(corpus.read().select("entity_key", "seq", "content_text")) == texts(want.select("entity_key", "seq", "content_text"))
    assert [tuple(r) for r in tokens.read().collect()] == [("shared", changes.count())]
    before = texts(corpus.read())
    assert corpus.compact() == 1 and corpus.compact() == 1
    assert texts(corpus.read()) == before


def test_first_drive_run_is_a_handshake(spark, data, tmp_path):
    content, changes = inputs.drive_content(spark, data), inputs.drive_changes(spark, data).cache()
    half, tokens, kept = changes.count() // 2, TokenState(spark, str(tmp_path / "t")), Kept(spark, tmp_path / "out")

    def run(check):
        stream = jobs.drive_changes(spark, str(tmp_path / "in"))
        jobs.run_drive(stream, content, "shared", str(tmp_path / check), kept, tokens=tokens).awaitTermination()

    changes.where(F.col("seq") < half).coalesce(1).write.json(str(tmp_path / "in"))
    run("one")
    assert kept.read().count() == 0 and [r.next_token for r in tokens.read().collect()] == [half]
    changes.where(F.col("seq") >= half).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    run("one")
    assert texts(kept.read(), "batch") == texts(drive.drive_delta(changes, content, "shared", half))
    run("two")  # another checkpoint reads all files again, but goes on from the folder's token
    assert kept.read().where("batch = 0").count() == 0


def rows(spark, *items):
    return spark.createDataFrame([(s, k, k, op, t) for s, k, op, t in items], "seq bigint, id string, entity_key string, change_op string, content_text string")


def state(corpus, *upto):
    return {r.entity_key: r.content_text for r in corpus.read(*upto).collect()}


def test_batches_may_be_repeated_and_compacted(spark, tmp_path):
    corpus = Corpus(spark, str(tmp_path / "c"))
    assert corpus.version() is None and corpus.read() is None and corpus.compact() is None
    corpus.apply(rows(spark, (1, "a", "UPSERT", "1"), (2, "c", "UPSERT", "c")), 0)
    for _ in range(2):
        corpus.apply(rows(spark, (3, "a", "DELETE", ""), (4, "b", "UPSERT", "b")), 1)
    assert state(corpus) == {"b": "b", "c": "c"} and state(corpus, {"default": 0}) == {"a": "1", "c": "c"}
    assert corpus.compact() == 0
    assert state(corpus) == {"b": "b", "c": "c"}
    corpus.apply(rows(spark, (5, "a", "UPSERT", "again"), (6, "b", "NONE", "failed")), 2)
    assert state(corpus) == {"a": "again", "b": "b", "c": "c"} and state(corpus, {"default": 1}) == {"b": "b", "c": "c"}
    with pytest.raises(ValueError):
        corpus.read({"default": 0})


def test_streams_share_a_corpus(spark, tmp_path):
    corpus = Corpus(spark, str(tmp_path / "c"))
    corpus.writer("git")(rows(spark, (1, "git:a", "UPSERT", "1")), 0)
    corpus.writer("drive")(rows(spark, (1, "drive:b", "UPSERT", "2")), 0)
    assert state(corpus) == {"git:a": "1", "drive:b": "2"}
    corpus.writer("git")(rows(spark, (9, "git:a", "UPSERT", "9")), 5)
    assert corpus.compact() == 0
    corpus.writer("git of a new checkpoint")(rows(spark, (10, "git:n", "UPSERT", "n")), 0)
    assert state(corpus) == {"git:a": "9", "drive:b": "2", "git:n": "n"}
    assert corpus.compact() == 1 and state(corpus) == {"git:a": "9", "drive:b": "2", "git:n": "n"}


def test_segments_merge_by_levels(spark, tmp_path):
    corpus, want = Corpus(spark, str(tmp_path / "c"), fan=3), {}
    for n in range(13):
        ops = [(10 * n, f"k{n}", "UPSERT", str(n)), (10 * n + 1, f"k{n // 2}", "UPSERT", f"again {n}"), (10 * n + 2, f"k{n - 3}", "DELETE", "")]
        corpus.apply(rows(spark, *ops), n, "even" if n % 2 == 0 else "odd")
        for _, key, op, text in ops:
            want.pop(key, None) if op == "DELETE" else want.update({key: text})
        assert state(corpus) == want
    segments = corpus.state()["segments"]
    assert sorted(s["level"] for s in segments) == [0, 1, 2] and len(corpus.state()["contains"]) == 0
    top = max(segments, key=lambda s: s["level"])
    assert top["batches"] == {"even": [[0, 0], [2, 2], [4, 4], [6, 6], [8, 8]], "odd": [[1, 1], [3, 3], [5, 5], [7, 7]]}
    corpus.apply(rows(spark, (999, "x", "UPSERT", "x")), 2, "even")  # merged long ago: known
    assert state(corpus) == want
    with pytest.raises(ValueError):
        corpus.read({"even": 4})
    assert corpus.compact() == 0 and corpus.state()["segments"] == [] and state(corpus) == want
    assert corpus.clean() == 0
    corpus.KEPT = 1
    corpus.apply(rows(spark, (1000, "y", "UPSERT", "y")), 50, "even")
    assert corpus.clean() > 5 and state(corpus) == {**want, "y": "y"}


def test_ten_thousand_batches_are_in_few_folders():
    from feedloom.sinks.corpus import due_merge, merged_ranges

    segments, written = [], 0
    for n in range(10_000):
        segments.append({"level": 0, "batches": {"s": [[n, n]]}})
        while group := due_merge(segments, 8):
            written += sum(high - low + 1 for s in group for low, high in s["batches"]["s"])
            whole = merged_ranges(r for s in group for r in s["batches"]["s"])
            segments = [s for s in segments if s not in group] + [{"level": group[0]["level"] + 1, "batches": {"s": whole}}]
        assert len(segments) <= 7 * 5
    assert len(json.dumps(segments)) < 3000 and written < 10_000 * 5
    assert merged_ranges([r for s in segments for r in s["batches"]["s"]]) == [[0, 9999]]


def test_a_rival_commit_is_not_overwritten(spark, tmp_path):
    one, two = (Corpus(spark, str(tmp_path / "c")) for _ in range(2))
    one.apply(rows(spark, (1, "a", "UPSERT", "1")), 0, "one")
    tries = []

    def change(manifest):
        tries.append(len(manifest["segments"]))
        if len(tries) == 1:  # another writer commits between reading and renaming
            two.apply(rows(spark, (2, "b", "UPSERT", "2")), 0, "two")
        return {**manifest, "segments": [s for s in manifest["segments"] if "one" not in s["batches"]]}

    assert one._commit(change) and tries == [1, 2]
    assert state(two) == {"b": "2"}
    assert not list((tmp_path / "c" / "manifests").glob("draft*"))


def test_a_damaged_corpus_is_not_an_empty_one(spark, tmp_path):
    corpus = Corpus(spark, str(tmp_path / "c"))
    corpus.apply(rows(spark, (1, "a", "UPSERT", "1")), 0)
    for file in (tmp_path / "c" / "segments").glob("*/*.parquet"):
        file.write_bytes(b"no parquet")
    with pytest.raises(Exception):  # noqa: B017
        corpus.read().collect()


def test_tokens_of_several_folders(spark, tmp_path):
    tokens = TokenState(spark, str(tmp_path / "t"))
    assert tokens.read().count() == 0 and tokens.read_before("f1", "s", 0) is None

    def put(folder, token, batch, stream):
        tokens.write(spark.createDataFrame([(folder, token)], "resource string, next_token long"), batch, stream)

    put("f1", 5, 0, "one")
    put("f2", 7, 0, "two")
    put("f1", 9, 1, "one")
    assert dict(map(tuple, tokens.read().collect())) == {"f1": 9, "f2": 7}
    assert tokens.read_before("f1", "one", 1) == 5 and tokens.read_before("f1", "three", 0) == 9


def test_repo_tree_source(spark, tmp_path):
    wanted = {"a.txt": b"a", "_under/b.txt": b"b", ".env": b"e", "d1/d2/d3/d4/deep.txt": b"deep", "d1/_x": b"\xff", "d1/d2/y": b""}
    for path, body in wanted.items():
        target = tmp_path / "repo" / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(body)
    (tmp_path / "repo" / "dangling").symlink_to(tmp_path / "nowhere")
    (tmp_path / "repo" / "linked").symlink_to(tmp_path / "repo" / "d1")
    repo_tree.register(spark)
    df = spark.read.format("repo_tree").option("repo", "https://github.com/u/r").option("commit_sha", "c").option("files_per_partition", "2").load(str(tmp_path / "repo"))
    assert df.rdd.getNumPartitions() >= 3
    got = {r.path: r.content for r in df.collect()}
    assert {k: None if v is None else bytes(v) for k, v in got.items()} == {**wanted, "dangling": None}
    assert {r.git.file_path for r in git.git_full_scan(df).collect()} == {"a.txt", "_under/b.txt", "d1/d2/d3/d4/deep.txt", "d1/_x", "d1/d2/y"}


def test_saved_responses(spark, tmp_path):
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "1.json").write_text(json.dumps({"nextPageToken": "x", "files": [{"id": "a", "name": "n", "size": "3"}]}, indent=1))
    (tmp_path / "l" / "2.json").write_text(json.dumps({"files": [{"id": "b"}, {"id": "c"}]}))
    assert {r.id for r in tables.drive_listing(spark, str(tmp_path / "l")).collect()} == {"a", "b", "c"}
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "1.json").write_text(json.dumps({"pageToken": 5, "changes": [{"fileId": "a", "removed": True}, {"fileId": "b", "file": {"id": "b"}}]}))
    feed = tables.drive_change_pages(spark, str(tmp_path / "f"))
    assert [(r.seq, r.fileId) for r in feed.orderBy("seq").collect()] == [(5, "a"), (6, "b")]
    assert feed.schema.simpleString() == spark.createDataFrame([], DRIVE_CHANGE).schema.simpleString()


def test_task_documents(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps({
        "id": "1", "name": "n", "trigger": {"type": "cron", "expression": "* * * * *"},
        "source": {"pluginType": "git-crawler", "config": {"repoUrl": "r", "depth": 2}}, "startPageToken": "7"}, indent=2))
    r = tables.tasks(spark, str(tmp_path / "t.json")).first()
    assert (r.task_id, r.plugin_type, r.enabled, r.trigger_type, r.start_page_token) == ("1", "git-crawler", True, "cron", "7")
    assert json.loads(r.config) == {"repoUrl": "r", "depth": 2}


def test_destinations(spark, tmp_path):
    records = spark.createDataFrame([("web", 1), ("git", 2)], "source string, n int")
    place = {"path": str(tmp_path / "o")}
    destinations.write_once(records, "files", place)
    destinations.write_once(records.withColumn("n", F.col("n") + 10), "files", place)
    for _ in range(2):
        destinations.destination("FILES", {**place, "stream": "s"})(records.withColumn("n", F.col("n") + 20), 0)
    kept = spark.read.parquet(place["path"]).select("source", "n").collect()
    assert sorted(map(tuple, kept)) == [("git", 2), ("git", 12), ("git", 22), ("web", 1), ("web", 11), ("web", 21)]
    seen = []
    destinations.register("memory", lambda config: lambda batch, batch_id: seen.append((config["k"], batch.count(), batch_id)))
    destinations.write_once(records, "memory", {"k": "v"})
    assert seen == [("v", 2, 0)]
    with pytest.raises(ValueError):
        destinations.destination("nowhere", {})


def test_a_repeated_batch_is_once_in_the_table(spark):
    records = spark.createDataFrame([("web", 1), ("git", 2)], "source string, n int")
    name = f"sink_{uuid.uuid4().hex}"
    try:
        for stream, batch in (("a", 0), ("a", 1), ("a", 1), ("b", 0), ("a", 0)):
            destinations.destination("table", {"table": name, "stream": stream})(records, batch)
        found = spark.table(name).groupBy("stream", "batch").count().collect()
        assert sorted(map(tuple, found)) == [("a", 0, 2), ("a", 1, 2), ("b", 0, 2)]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def drive_run(spark, path, content, check, kept, **options):
    jobs.run_drive(jobs.drive_changes(spark, str(path), files_per_batch=1), content, "shared", str(check), kept, **options).awaitTermination()


def put(df, path, low, high):
    df.where((F.col("seq") >= low) & (F.col("seq") < high)).coalesce(1).write.mode("append").json(str(path))


def seqs(kept):
    return sorted(r.seq for r in kept.read().select("seq").collect())


def test_the_start_token_goes_before_the_next_one(spark, data, tmp_path):
    content, changes = inputs.drive_content(spark, data), inputs.drive_changes(spark, data).cache()
    put(changes, tmp_path / "in", 0, 1000)
    for n, (begin, following, token) in enumerate([(50, 400, 50), (400, 50, 400), (None, 300, 300), (0, 900, 0)]):
        kept = Kept(spark, tmp_path / f"out{n}")
        drive_run(spark, tmp_path / "in", content, tmp_path / f"c{n}", kept, start_token=begin, next_token=following)
        assert seqs(kept) == sorted(r.seq for r in drive.drive_delta(changes, content, "shared", token).collect())


def test_a_held_token_holds_for_all_batches(spark, data, tmp_path):
    content, changes = inputs.drive_content(spark, data), inputs.drive_changes(spark, data).cache()
    tokens, kept = TokenState(spark, str(tmp_path / "t")), Kept(spark, tmp_path / "out")
    tokens.write(spark.createDataFrame([("shared", 600)], "resource string, next_token long"), 0, "before")
    # The newest file is read first: old changes come in the second batch.
    put(changes, tmp_path / "in", 500, 1000)
    drive_run(spark, tmp_path / "in", content, tmp_path / "c", kept, tokens=tokens)
    put(changes, tmp_path / "in", 0, 500)
    drive_run(spark, tmp_path / "in", content, tmp_path / "c", kept, tokens=tokens)
    assert seqs(kept) == sorted(r.seq for r in drive.drive_delta(changes, content, "shared", 600).collect())
    assert [tuple(r) for r in tokens.read().collect()] in ([("shared", 600)], [("shared", 1000)])


def test_a_handshake_over_a_backlog_of_several_batches(spark, data, tmp_path):
    content, changes = inputs.drive_content(spark, data), inputs.drive_changes(spark, data).cache()
    tokens, kept = TokenState(spark, str(tmp_path / "t")), Kept(spark, tmp_path / "out")
    put(changes, tmp_path / "in", 0, 300)
    put(changes, tmp_path / "in", 300, 600)
    feed = spark.read.schema(DRIVE_CHANGE).json(str(tmp_path / "in"))
    drive_run(spark, tmp_path / "in", content, tmp_path / "c", kept, tokens=tokens, feed=feed)
    assert seqs(kept) == [] and kept.read().select("batch").distinct().count() <= 2
    put(changes, tmp_path / "in", 600, 1000)
    drive_run(spark, tmp_path / "in", content, tmp_path / "c", kept, tokens=tokens, feed=feed)
    assert seqs(kept) == sorted(r.seq for r in drive.drive_delta(changes, content, "shared", 600).collect())
    with pytest.raises(Exception):  # noqa: B017
        drive_run(spark, tmp_path / "in", content, tmp_path / "c2", kept)


def test_a_kept_feed_is_a_source(spark, data, tmp_path):
    content, changes = inputs.drive_content(spark, data), inputs.drive_changes(spark, data).cache()
    feed, tokens, kept = str(tmp_path / "feed"), TokenState(spark, str(tmp_path / "t")), Kept(spark, tmp_path / "out")
    sizes = []

    def keep(batch, batch_id):
        sizes.append(batch.count())
        kept(batch, batch_id)

    def drain(check="c", write=keep, **options):
        return jobs.run_drive_feed(spark, feed, content, "shared", str(tmp_path / check), write, **options)

    assert drain(tokens=tokens) == 0  # nothing there yet: the handshake
    sizes.clear()
    assert drive_feed.append(changes.where("seq < 400"), feed) == 400
    assert drain(tokens=tokens, max_per_batch=150) == 400 and len(sizes) == 3
    assert drain(tokens=tokens) == 400 and len(sizes) == 3
    (tmp_path / "feed" / "segment=00000000000000000900-00000000000000001000").mkdir()  # a segment that is being written
    assert drive_feed.append(changes.where("seq >= 400 and seq < 900"), feed) == 900
    assert drain(tokens=tokens, max_per_batch=400, start_token=3) == 900 and len(sizes) == 5  # the checkpoint decides
    assert seqs(kept) == sorted(r.seq for r in drive.drive_delta(changes.where("seq < 900"), content, "shared", 0).collect())
    assert [tuple(r) for r in tokens.read().collect()] == [("shared", 900)]
    other = Kept(spark, tmp_path / "other")
    assert drain("c2", other, start_token=850, next_token=10) == 900
    assert seqs(other) == sorted(r.seq for r in drive.drive_delta(changes.where("seq < 900"), content, "shared", 850).collect())
    with pytest.raises(ValueError):
        drain("c3")
    columns = ["seq", "fileId", "removed"]
    stream = spark.readStream.format("drive_feed").option("token", "0").load(feed)
    query = stream.writeStream.format("memory").queryName("feed_rows").start()
    query.processAllAvailable()
    query.stop()
    assert texts(spark.table("feed_rows").select(*columns)) == texts(changes.where("seq < 900").select(*columns))
    assert spark.table("feed_rows").where("file is not null and file.parents is not null").count() > 0


def test_an_outbox_is_written_once_a_run(spark, tmp_path):
    records = spark.createDataFrame([("t1", "a"), ("t1", "b"), ("t2", "c"), ("t3", "d"), (None, "e")], "task_id string, id string")
    routes = spark.createDataFrame([("t1", "x/../y"), ("t2", "x/../y"), ("t2", "z"), ("t2", "z"), ("t4", "idle"), (None, "n"), ("t3", None)], "task_id string, destination string")
    box = Outbox(spark, str(tmp_path / "o"))
    assert box.read() is None and box.commits().count() == 0
    assert box.deliver(records, routes, "one") == "one" and box.deliver(records.limit(0), routes, "one") == "one"
    (tmp_path / "o" / "records" / "run=failed" / "outbox=0").mkdir(parents=True)
    records.withColumn("destination", F.lit("z")).write.parquet(str(tmp_path / "o" / "records" / "run=broken" / "outbox=0"))  # no commit: not seen
    ids = lambda name: sorted(r.id for r in box.read(name).collect())
    assert ids("x/../y") == ["a", "b", "c"] and ids("z") == ["c"] and ids("idle") == [] and ids("nowhere") == []
    assert {tuple(r) for r in box.commits().collect()} == {("x/../y", "one", 3), ("z", "one", 1), ("idle", "one", 0)}
    box.deliver(records, routes)
    assert ids("z") == ["c", "c"]


def test_tasks_deliver_into_an_outbox(spark, data, tmp_path):
    definitions = inputs.run_definitions(spark, data).limit(8)
    box = F.concat(F.lit(f'{{"path": "{tmp_path}/box", "name": "'), "task_id", F.lit('"}'))
    definitions = definitions.withColumn("destination", F.struct(F.lit("Outbox").alias("pluginType"), box.alias("config")))
    found, status = run_tasks(definitions, inputs.run_inputs(spark, data))
    sent = {r.destination: r.n for r in Outbox(spark, f"{tmp_path}/box").commits().collect()}
    assert {k: n for k, n in sent.items() if n} == {r.task_id: r.crawled_count for r in status.collect() if r.crawled_count}
    assert found.count() == sum(sent.values())


def test_trees_are_listed_by_tasks(spark, tmp_path):
    wanted = {"a.txt": b"a", "_under/b.txt": b"b", ".env": b"e", "d1/d2/d3/d4/deep.txt": b"deep", "d1/_x": b"\xff", "d1/d2/y": b""}
    for path, body in wanted.items():
        target = tmp_path / "repo" / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(body)
    (tmp_path / "repo" / "empty").mkdir()
    files = tree_listing.read_tree(spark, str(tmp_path / "repo"), Staging(spark, "t"), commit_sha="c", task_files=2)
    assert {r.path: bytes(r.content) for r in files.collect()} == wanted
    assert files.rdd.getNumPartitions() >= 3
    listed = tree_listing.list_tree(spark, str(tmp_path / "repo"), Staging(spark, "t"))
    assert {r.path: r.size for r in listed.collect()} == {p: len(b) for p, b in wanted.items()}
    with pytest.raises(Exception):  # noqa: B017
        tree_listing.list_tree(spark, str(tmp_path / "nowhere"), Staging(spark, "t"))
    assert tree_listing.read_tree(spark, str(tmp_path / "repo" / "empty"), Staging(spark, "t")).count() == 0

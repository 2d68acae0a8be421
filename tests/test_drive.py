from pyspark.sql import functions as F

from feedloom.operators import drive
from feedloom.schemas import DRIVE_CHANGE, DRIVE_CONTENT, DRIVE_FILE

DOC = "application/vnd.google-apps.document"


def file(id, name="n", mime="text/plain", view=None, link=None, size="3", parents=("fold",), trashed=False, at="t"):
    return (id, name, mime, view, link, size, at, at, None if parents is None else list(parents), trashed)


def files(spark, *rows):
    return spark.createDataFrame(list(rows), DRIVE_FILE)


def content(spark, **texts):
    rows = [(k, None if v is None else bytearray(v if isinstance(v, bytes) else v.encode()), None) for k, v in texts.items()]
    return spark.createDataFrame(rows, DRIVE_CONTENT)


def feed(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], DRIVE_CHANGE)


def by_id(df):
    return {r.id: r for r in df.collect()}


def test_full_scan_of_a_folder(spark):
    listing = files(
        spark, file("a"), file("b", trashed=True), file("c", parents=["other"]), file("d", name=None), file("", name="x"),
        file("e", name=""), file("f", parents=None),
    )
    got = by_id(drive.drive_full_scan(listing, content(spark, a="abc"), "fold"))
    assert set(got) == {"a"}
    a = got["a"]
    assert (a.url, a.content_text, a.change_type, a.change_op) == ("https://drive.google.com/file/d/a/view", "abc", None, "UPSERT")
    assert (a.drive.ingestion_type, a.drive.file_size, a.drive.parents, a.drive.trashed) == ("gdrive_full_scan", 3, ["fold"], None)
    assert a.entity_key == "drive:a"


def test_trashed_files_on_request(spark):
    got = by_id(drive.drive_full_scan(files(spark, file("b", trashed=True, view="v")), content(spark, b="x"), "fold", include_trashed=True))
    b = got["b"]
    assert (b.content_text, b.change_type, b.change_op, b.url) == ("", "DELETE", "DELETE", "v")
    assert (b.drive.ingestion_type, b.drive.trashed) == ("gdrive_full_scan_trash", True)


def test_failed_fetch(spark):
    got = by_id(drive.drive_full_scan(files(spark, file("a"), file("b", mime=None)), content(spark, a=None), "fold"))
    a, b = got["a"], got["b"]
    assert (a.status_code, a.change_type, a.change_op, a.content_kind) == (500, None, "NONE", "error")
    assert a.content_text == f"Error fetching file: {a.error}"
    assert a.drive.ingestion_type == "gdrive_full_scan_fetch_failed"
    assert (a.drive.file_size, a.drive.parents) == (None, None)
    assert b.drive.mime_type == "application/octet-stream"


def test_url_size_and_defaults(spark):
    listing = files(
        spark, file("a", view="", link="dl"), file("b", view="v", link="dl"), file("c", view="", link="", size=None, at=None),
        file("d", size="12px"), file("e", size="px"), file("g", size="0"),
    )
    got = by_id(drive.drive_full_scan(listing, content(spark, a="", c="x", d="x", e="x", g="x"), "fold"))
    assert (got["a"].url, got["b"].url, got["c"].url) == ("dl", "v", "https://drive.google.com/file/d/c/view")
    assert [got[k].drive.file_size for k in "cdeg"] == [0, 12, None, 0]
    assert (got["c"].drive.created_time, got["c"].drive.modified_time) == ("", "")
    assert (got["a"].content_kind, got["a"].content_text) == ("empty", "")


def test_content_plan(spark):
    rows = [
        (DOC, "text/plain", "text"), ("application/vnd.google-apps.spreadsheet", "text/csv", "text"),
        ("application/vnd.google-apps.presentation", "application/pdf", "text"), ("text/markdown", None, "text"),
        ("application/json", None, "text"), ("image/svg+xml", None, "text"), ("application/pdf", None, "binary"),
        ("application/vnd.openxmlformats-officedocument.wordprocessingml.document", None, "text"),
    ]
    df = spark.createDataFrame(rows, "mime string, export string, kind string")
    got = df.select("*", drive.content_plan(F.col("mime")).alias("p")).collect()
    assert [(r.p.export_mime, r.p.content_kind) for r in got] == [(r.export, r.kind) for r in got]


def test_bytes_are_kept_where_text_cannot_hold_them(spark):
    listing = files(spark, file("a", mime="image/png"), file("b", mime="application/vnd.google-apps.presentation"), file("c"))
    got = by_id(drive.drive_full_scan(listing, content(spark, a=b"\x89P", b=b"%PDF\xff", c=b"ok"), "fold"))
    assert (bytes(got["a"].content_binary), got["a"].content_text, got["a"].content_kind) == (b"\x89P", None, "binary")
    assert (bytes(got["b"].content_binary), got["b"].content_text, got["b"].content_kind) == (b"%PDF\xff", "%PDF�", "text")
    assert (got["c"].content_binary, got["c"].content_text) == (None, "ok")


CHANGES = (
    ("r", True, file("r")),
    ("x", False, None),
    (None, True, None),
    ("t", False, file("t", parents=["other"], trashed=True)),
    ("o", False, file("o", parents=["other"])),
    ("n", False, file("n", parents=None)),
    ("u", False, file("u", name=None)),
    ("m", None, file("m")),
)


def test_delta(spark):
    got = by_id(drive.drive_delta(feed(spark, *CHANGES), content(spark, u="abc"), "fold", 0))
    assert {k: (r.change_type, r.drive.ingestion_type, r.status_code) for k, r in got.items()} == {
        "r": ("DELETE", "gdrive_delta_sync_removal", 200),
        "t": ("DELETE", "gdrive_delta_sync_trash", 200),
        "u": ("UPSERT", "gdrive_delta_sync", 200),
        "m": (None, "gdrive_full_scan_fetch_failed", 500),
    }
    assert (got["r"].url, got["r"].drive.file_name) == ("https://drive.google.com/file/d/r/view", None)
    assert (got["u"].drive.file_name, got["u"].content_text) == ("unknown-name", "abc")
    assert (got["t"].seq, got["t"].drive.trashed) == (3, True)


def test_delta_without_a_folder_takes_all(spark):
    got = by_id(drive.drive_delta(feed(spark, *CHANGES), content(spark), None, 0))
    assert set(got) == {"r", "t", "o", "n", "u", "m"}


def test_token_bounds_the_delta(spark):
    everything = feed(spark, *CHANGES)
    assert set(by_id(drive.drive_delta(everything, content(spark), "fold", 6))) == {"u", "m"}
    assert drive.drive_delta(everything, content(spark), "fold", None).count() == 0


def test_next_token(spark):
    def tokens(**given):
        return spark.createDataFrame([(k, v, None) for k, v in given.items()], "task_id string, start_token string, next_token long")

    held = tokens(first=None, all="0", some="6", end="8", later="99")
    got = {r.task_id: (r.next_token, r.n_changes) for r in drive.drive_next_token(feed(spark, *CHANGES), held).collect()}
    assert got == {"first": (8, 0), "all": (8, 8), "some": (8, 2), "end": (8, 0), "later": (99, 0)}
    empty = feed(spark, *CHANGES).where("false")
    assert [r.next_token for r in drive.drive_next_token(empty, tokens(a="5", b=None)).orderBy("task_id").collect()] == [5, 0]


def test_start_token_goes_first(spark):
    rows = spark.createDataFrame([("5", "7"), ("", "7"), (None, "7"), (None, None)], "s string, n string")
    got = [r[0] for r in rows.select(drive.effective_token(F.col("s"), F.col("n"))).collect()]
    assert got == ["5", "7", "7", None]


def test_resume_and_edges(spark):
    listing = files(spark, file("a"), file("b", parents=["fold", "two"]), file("c", parents=None))
    assert [r.id for r in drive.drive_listing(listing, "fold", resume_after="a").collect()] == ["b"]
    assert {tuple(r) for r in drive.drive_folder_edges(listing).collect()} == {("a", "fold"), ("b", "fold"), ("b", "two")}


def test_pages_of_the_feed(spark):
    got = drive.changes_per_page(feed(spark, *CHANGES), 3).orderBy("page").collect()
    assert [tuple(r) for r in got] == [(0, 3), (1, 3), (2, 2)]
    gaps = spark.createDataFrame([(s,) for s in (3, 10, 11, 500)], "seq long")
    assert [tuple(r) for r in drive.changes_per_page(gaps, 2, token=10).orderBy("page").collect()] == [(0, 2), (1, 1)]
    assert drive.changes_per_page(gaps.where("false"), 2).count() == 0


def test_next_token_counts_across_gaps(spark):
    seqs = [0, 5, 5, 70, 10**9, 10**12, 10**12 + 1]
    held = spark.createDataFrame([(str(t), str(t), None) for t in [*seqs, 6, 71, 10**12 + 2]], "task_id string, start_token string, next_token string")
    got = {int(r.task_id): (r.next_token, r.n_changes) for r in drive.drive_next_token(spark.createDataFrame([(s,) for s in seqs], "seq long"), held).collect()}
    assert got == {t: (10**12 + 2, sum(s >= t for s in seqs)) for t in {*seqs, 6, 71, 10**12 + 2}}


def test_newest_changes_are_those_that_a_corpus_keeps(spark):
    """Found before contents are looked up: unreadable live files and repeated rows do not hide what came before."""
    from feedloom.operators.changes import latest_changes
    from feedloom.session import Staging

    def one(k, **more):
        return (k, False, file(k, **more))

    rows = [one("a"), one("a"), ("b", True, None), one("b"), one("gone"), one("c"), ("c", True, None), ("lost", True, None), one("lost"),
            one("d"), one("d", trashed=True), one("e", parents=["other"]), ("f", False, None), one("g"), one("g")]
    changes = feed(spark, *rows)
    changes = changes.unionByName(changes.where("fileId in ('a', 'g')"))
    stored = content(spark, a="1", b="2", c="3", d="4", e="5", g="7", lost=None)
    stored = stored.unionByName(stored.where("file_id = 'g'").withColumn("content", F.lit(None).cast("binary")))
    for staging in (None, Staging(spark, "t")):
        full = drive.drive_delta(changes, stored, "fold", 0)
        last = drive.drive_delta(changes, stored, "fold", 0, newest=True, staging=staging)
        key = lambda df: sorted((r.entity_key, r.seq, r.change_op, r.content_text) for r in latest_changes(df).collect())
        assert key(last) == key(full) and len(key(full)) == 6
        assert last.where("id = 'a'").select("seq").distinct().count() == 1

"""Operator inputs derived from the given tables: every row of a table takes part.

Which variant a row becomes (a bad signature, a failed fetch, a ping) follows from arithmetic on
its id, so the expected results can be stated in SQL without repeating the work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SITE = "https://www.example.com"
SEED = f"{SITE}/p/0"
GIT_SECRET = "git-secret"
CHANNEL = "channel-1"
REPOS = 20

RULES = (
    "task_id string, start_url string, max_depth int, recursive boolean, sitemap_discovery boolean,"
    " allowed_domains array<string>, include_paths array<string>, exclude_paths array<string>"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _rows(spark: SparkSession, sf_dir: str, name: str) -> Column:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").agg(F.count(F.lit(1))).scalar()


def messy_urls(spark, sf_dir) -> DataFrame:
    """Page addresses written in thirteen ways, all but one of which have a known normal form."""
    url = F.col("url")
    scheme, host = F.regexp_extract(url, "^(https?)", 1), F.regexp_extract(url, "//([^/]*)", 1)
    rest = F.regexp_replace(url, "^https?://[^/]*", "")
    port = F.when(scheme == "http", ":80").otherwise(":443")
    sep = F.lit("://")
    kind = F.col("page_id") % 8
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.when(F.col("page_id") % 32 == 8, F.concat(F.lit("http://0x7F.1/"), F.col("page_id").cast("string")))
        .when(F.col("page_id") % 32 == 16, F.concat(F.lit("http://1.2.3.256/"), F.col("page_id").cast("string")))
        .when(F.col("page_id") % 96 == 24, F.concat(F.lit("http://MÜNCHEN.Example/"), F.col("page_id").cast("string")))
        .when(F.col("page_id") % 96 == 56, F.concat(F.lit("http://[0:0::0001]:80/"), F.col("page_id").cast("string")))
        .when(F.col("page_id") % 96 == 88, F.concat(F.lit("http://[::FFFF:1.2.3.4]/"), F.col("page_id").cast("string")))
        .when(kind == 1, F.concat(F.upper(scheme), sep, F.upper(host), rest))
        .when(kind == 2, F.concat(scheme, sep, host, port, rest))
        .when(kind == 3, F.concat(scheme, sep, host, F.lit("/./a/%2E%2e"), rest))
        .when(kind == 4, F.concat(F.lit("  "), url, F.lit("\t\n")))
        .when(kind == 5, F.concat(scheme, F.lit(":/"), host, rest))
        .when(kind == 6, F.concat(scheme, sep, host, F.lit("/ü x{y}"), rest))
        .when(kind == 7, F.concat(scheme, sep, host))
        .otherwise(url)
        .alias("url"),
    )


def raw_pages(spark, sf_dir) -> DataFrame:
    """The page table as a snapshot; some requests failed, some answered with JSON."""
    n = F.col("page_id")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        "url",
        F.when(n % 13 == 5, 503).when(n % 17 != 3, 200).alias("status_code"),
        F.when(n % 10 == 9, "application/json").otherwise("text/html; charset=utf-8").alias("content_type"),
        F.when(n % 10 == 9, F.concat(F.lit('{"page": '), n.cast("string"), F.lit("}")))
        .otherwise(F.col("html"))
        .alias("body"),
    )


def odd_addresses(spark, sf_dir) -> DataFrame:
    """For each page an address that no crawl may request: other schemes, no valid host, no scheme."""
    n = F.col("page_id")
    kinds = ["mailto:a@example.com/en/", "ftp://example.com/en/x", "http://no host.example.com/en/x", "http://example.com:99999/en/x", "example.com/en/x", "javascript:void(0)"]
    url = F.lit(kinds[0])
    for i, kind in enumerate(kinds[1:], 1):
        url = F.when(n % len(kinds) == i, kind).otherwise(url)
    return table(spark, sf_dir, "pages").select("page_id", url.alias("url"))


def html_pages(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id", "url", F.lit("text/html").alias("content_type"), F.col("html").alias("body")
    )


def site_pages(spark, sf_dir) -> DataFrame:
    """All pages as one linked site; about one link in seventeen leads nowhere."""
    pages = table(spark, sf_dir, "pages")
    n = F.col("page_id")
    size = _rows(spark, sf_dir, "pages")
    size = size + F.floor(size / 16)

    def link(a: int, b: int) -> Column:
        return F.concat(F.lit('<a href="/p/'), ((n * a + b) % F.col("__size")).cast("string"), F.lit('">next</a>'))

    return pages.withColumn("__size", size).select(
        F.concat(F.lit(f"{SITE}/p/"), n.cast("string")).alias("url"),
        F.lit(200).alias("status_code"),
        F.when(n % 10 == 9, "application/json").otherwise("text/html; charset=utf-8").alias("content_type"),
        F.concat(
            F.col("html"),
            link(7, 1),
            link(5, 2),
            link(3, 4),
            link(1, 1),
            F.lit('<a href="https://other.example.net/x">x</a><a href="mailto:a@b.c">m</a>'),
        ).alias("body"),
    )


def crawl_tasks(spark) -> DataFrame:
    return spark.createDataFrame(
        [
            ("narrow", SEED, 6, True, False, ["example.com"], ["/p/"], ["/p/7"]),
            ("wide", SEED, 6, True, False, ["example.com"], None, ["/p/7"]),
            ("shallow", SEED, None, True, False, None, None, None),
        ],
        RULES,
    )


def sitemap_tasks(spark) -> DataFrame:
    return spark.createDataFrame(
        [
            ("mapped", SEED, 1, True, True, ["example.com"], ["/p/1", "/p/2"], ["/p/11"]),
            ("unmapped", "https://plain.example.com/p/0", 1, True, True, None, None, None),
            ("plain", SEED, 1, True, False, ["example.com"], ["/p/"], None),
        ],
        RULES,
    )


def page_host() -> Column:
    return F.regexp_extract("url", "//([^/]*)", 1)


def hosts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "pages").select(page_host().alias("host")).distinct()


def robots(spark, sf_dir) -> DataFrame:
    """One row per host; the length of its name decides what the robots file says."""
    host = F.col("host")
    kind = F.length(host) % 4
    https = F.concat(F.lit("https://"), host)
    return hosts(spark, sf_dir).select(
        "host",
        F.when(kind == 0, F.concat(F.lit("User-agent: *\r\nSitemap: "), https, F.lit("/sm.xml \r\n")))
        .when(kind == 1, F.concat(F.lit("SITEMAP:"), https, F.lit("/sm.xml\nSitemap: "), https, F.lit("/second.xml")))
        .when(kind == 2, F.lit("User-agent: *\nDisallow: /private"))
        .alias("body"),
    )


def known_sitemaps(spark, sf_dir) -> DataFrame:
    """Hosts whose name has an even number of letters offer the usual file, under both schemes, one of them twice."""
    name = F.when(F.length("host") % 8 < 4, "/sitemap.xml").otherwise("/other.xml")
    return hosts(spark, sf_dir).select(
        F.explode(
            F.array(
                *[F.concat(F.lit(f"{scheme}://"), F.col("host"), name) for scheme in ("http", "https", "https")]
            )
        ).alias("url"),
        F.lit("<urlset></urlset>").alias("body"),
    )


CHUNK = 25


def sitemaps(spark, sf_dir) -> DataFrame:
    """A tree of sitemap indexes over the site, at most 25 pages and 28 names per file.
    A third of the files is in the table twice.

    Index j names urlset j, the indexes 25j+1 to 25j+25, itself, a broken file and a missing one.
    """
    pages = table(spark, sf_dir, "pages")
    n = F.col("page_id")
    address = F.concat(F.lit(f"{SITE}/p/"), n.cast("string"))
    loc = (
        F.when(n % 5 == 1, F.concat(address, F.lit("?a=1&amp;b=&#50;")))
        .when(n % 5 == 2, F.concat(F.lit("<![CDATA["), address, F.lit("?a=1&b=2]]>")))
        .when(n % 5 == 3, F.concat(F.lit(" "), address, F.lit("\n")))
        .when(n % 5 == 4, F.concat(F.lit("/p/"), n.cast("string")))
        .otherwise(address)
    )
    entry = F.concat(F.lit("<url><lastmod>2024</lastmod><loc>"), loc, F.lit("</loc></url>"))
    chunks = (
        pages.select(F.floor(n / CHUNK).alias("j"), entry.alias("entry"))
        .groupBy("j")
        .agg(F.array_join(F.collect_list("entry"), "").alias("entries"))
        .withColumn("__last", F.floor((_rows(spark, sf_dir, "pages") - 1) / CHUNK))
    )
    j = F.col("j")

    def name(kind: str, k: Column) -> Column:
        return F.concat(F.lit(f"{SITE}/{kind}"), k.cast("string"), F.lit(".xml"))

    def item(text: Column) -> Column:
        return F.concat(F.lit("<sitemap><loc>"), text, F.lit("</loc></sitemap>"))

    below = F.filter(F.sequence(j * CHUNK + 1, j * CHUNK + CHUNK), lambda k: k <= F.col("__last"))
    index = F.concat(
        F.lit('<?xml version="1.0"?><sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'),
        item(name("set", j)),
        item(name("index", j)),
        item(name("bad", j)),
        item(name("missing", j)),
        F.array_join(F.transform(below, lambda k: item(name("index", k))), ""),
        F.lit("</sitemapindex>"),
    )
    urlset = F.concat(F.lit("<urlset><!-- <url><loc>no</loc></url> -->"), F.col("entries"), F.lit("</urlset>"))
    rows = F.array(
        F.struct(name("index", j).alias("url"), index.alias("body")),
        F.struct(name("set", j).alias("url"), urlset.alias("body")),
        F.struct(name("bad", j).alias("url"), F.lit("<urlset><url>").alias("body")),
    )
    return chunks.select(F.inline(F.when(j % 3 == 1, F.concat(rows, rows)).otherwise(rows)))


def site_robots(spark) -> DataFrame:
    return spark.createDataFrame(
        [("www.example.com", f"Sitemap: {SITE}/index0.xml"), ("plain.example.com", "User-agent: *")],
        "host string, body string",
    )


def _repo(n: Column) -> Column:
    return F.concat(F.lit("org/r"), (n % REPOS).cast("string"))


def _path(n: Column) -> Column:
    text = n.cast("string")
    return (
        F.when(n % 20 == 0, F.concat(F.lit(".hidden/d"), text, F.lit(".txt")))
        .when(n % 23 == 0, F.concat(F.lit("a/.env"), text))
        .when(n % 29 == 0, F.concat(F.lit("_u/d"), text, F.lit(".txt")))
        .otherwise(F.concat(F.lit("docs/"), (n % 7).cast("string"), F.lit("/d"), text, F.lit(".txt")))
    )


def repo_files(spark, sf_dir) -> DataFrame:
    """Every document as a file; some are unreadable, some end in a byte that is not UTF-8.

    Some commits are on two branches.
    """
    n = F.col("doc_id")
    raw = F.col("text").cast("binary")
    branches = F.when(n % 41 == 0, F.array(F.lit("dev"))).when(n % 7 == 3, F.array(F.lit("main"), F.lit("dev"))).otherwise(F.array(F.lit("main")))
    return table(spark, sf_dir, "documents").select("*", F.explode(branches).alias("branch")).select(
        F.concat(F.lit("https://github.com/"), _repo(n)).alias("repo"),
        "branch",
        F.sha2(_repo(n), 256).alias("commit_sha"),
        _path(n).alias("path"),
        F.when(n % 31 != 0, F.when(n % 37 == 0, F.concat(raw, F.unhex(F.lit("ff")))).otherwise(raw)).alias("content"),
    )


def push_events(spark, sf_dir) -> DataFrame:
    """Every event as a push: pings, malformed bodies and missing parts among them."""
    e = F.col("event_id")
    docs = F.col("docs")
    parts = (
        table(spark, sf_dir, "events")
        .select("event_id", _rows(spark, sf_dir, "documents").alias("docs"))
        .select(
            "event_id",
            _repo(e).alias("repo"),
            _path((e % REPOS) + REPOS * ((e * 7) % F.floor(docs / REPOS))).alias("same_repo"),
            _path((e * 11 + 3) % docs).alias("other_repo"),
        )
        .withColumn("after", F.sha2(F.when(e % 23 == 0, "gone").otherwise(F.col("repo")), 256))
        .withColumn(
            "head",
            F.concat(
                F.expr("""concat('{"id": "', after, '", "message": "change", "author": {"name": "ann"}')"""),
                F.when(e % 19 == 0, "").otherwise(
                    F.expr(
                        """concat(', "added": ["', same_repo, '"], "modified": ["', other_repo, '", "', same_repo,
                                  '"], "removed": ["old/', event_id, '"]')"""
                    )
                ),
                F.lit("}"),
            ),
        )
    )
    ref = F.when(e % 7 == 0, "refs/tags/v1").otherwise("refs/heads/main")
    commits = F.when(e % 13 == 0, "").otherwise(
        F.expr("""concat(', "commits": [{"id": "c', event_id, '", "added": ["x.txt", "y.txt"], "removed": []}, ', head, ']')""")
    )
    body = F.concat(
        F.lit('{"ref": "'),
        ref,
        F.expr(
            """concat('", "after": "', after, '", "repository": {"id": 1, "full_name": "', repo,
                      '", "html_url": "https://github.com/', repo, '"}, "pusher": {"name": "bob"}')"""
        ),
        commits,
        F.lit(', "head_commit": '),
        F.when(e % 17 == 0, "null").otherwise(F.col("head")),
        F.when(e % 53 == 0, "} trailing").otherwise("}"),
    )
    ping = F.lit('{"zen": "Keep it simple.", "hook_id": null}')
    return parts.select("event_id", F.when(e % 11 == 0, ping).otherwise(body).alias("body"))


MIMES = (
    "application/vnd.google-apps.document",
    "application/vnd.google-apps.spreadsheet",
    "application/vnd.google-apps.presentation",
    "text/plain",
    "application/json",
    "image/jpeg",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
)


def _mime(n: Column) -> Column:
    out = F.lit(None).cast("string")
    for i, mime in enumerate(MIMES):
        out = F.when(n % 8 == i, mime).otherwise(out)
    return out


def _view(n: Column) -> Column:
    return F.when(n % 3 == 1, "").when(n % 3 == 2, F.concat(F.lit("https://view.example.com/"), n.cast("string")))


def _download(n: Column) -> Column:
    return F.when(n % 9 != 0, F.concat(F.lit("https://get.example.com/"), n.cast("string")))


def _parents(n: Column) -> Column:
    return F.when(n % 37 != 0, F.array(F.concat(F.lit("fold"), (n % 4).cast("string")), F.lit("shared")))


def drive_files(spark, sf_dir) -> DataFrame:
    n = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("f"), n.cast("string")).alias("id"),
        F.when(n % 31 != 0, F.concat(F.lit("doc "), n.cast("string"))).alias("name"),
        _mime(n).alias("mimeType"),
        _view(n).alias("webViewLink"),
        _download(n).alias("webContentLink"),
        F.when(n % 11 != 0, F.concat(F.col("n_chars").cast("string"), F.lit(" bytes"))).alias("size"),
        F.when(n % 6 != 0, F.lit("2024-01-01T00:00:00Z")).alias("createdTime"),
        F.lit("2024-02-01T00:00:00Z").alias("modifiedTime"),
        _parents(n).alias("parents"),
        (n % 13 == 0).alias("trashed"),
    )


def drive_content(spark, sf_dir) -> DataFrame:
    n = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("f"), n.cast("string")).alias("file_id"),
        F.when(n % 19 != 0, F.col("text").cast("binary")).alias("content"),
        F.when(n % 38 == 0, "Backend Error").alias("error"),
    )


def drive_changes(spark, sf_dir) -> DataFrame:
    """Every event as a change of the file its user stands for, so files repeat a lot."""
    docs = _rows(spark, sf_dir, "documents")
    n, e = F.col("n"), F.col("event_id")
    file = F.struct(
        F.concat(F.lit("f"), n.cast("string")).alias("id"),
        F.when(n % 31 != 0, F.concat(F.lit("doc "), n.cast("string"))).alias("name"),
        _mime(n).alias("mimeType"),
        _view(n).alias("webViewLink"),
        _download(n).alias("webContentLink"),
        F.when(e % 12 != 0, (e * 3).cast("string")).alias("size"),
        F.lit("2024-01-01T00:00:00Z").alias("createdTime"),
        F.lit("2024-02-01T00:00:00Z").alias("modifiedTime"),
        _parents(n).alias("parents"),
        (F.col("event_type") == "signup").alias("trashed"),
    )
    return (
        table(spark, sf_dir, "events")
        .select("event_id", "event_type", (F.col("user_id") % docs).alias("n"))
        .select(
            F.col("event_id").alias("seq"),
            F.when(e % 41 != 0, F.concat(F.lit("f"), n.cast("string"))).alias("fileId"),
            (F.col("event_type") == "error").alias("removed"),
            F.when(F.col("event_type") != "view", file).alias("file"),
        )
    )


def _sign(body: Column) -> Column:
    """HMAC-SHA256 by its definition, the two key blocks being literals."""
    key = GIT_SECRET.encode().ljust(64, b"\0")
    inner, outer = (F.unhex(F.lit(bytes(b ^ mask for b in key).hex())) for mask in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, F.encode(body, "UTF-8")), 256))), 256)


def deliveries(spark, sf_dir) -> DataFrame:
    """Every event as a delivery to one of three services, with all the ways to be refused."""
    e = F.col("event_id")
    kind = e % 7
    service = F.when(e % 3 == 0, "git-crawler").when(e % 3 == 1, "googledrive-crawler").otherwise("unknown-svc")
    named = F.when(
        e % 19 != 0, F.concat(F.lit(', "repository": {"full_name": "org/src'), (e % 20).cast("string"), F.lit('"}'))
    ).otherwise(', "repository": null')
    deleted = (
        F.when(e % 8 == 0, "true").when(e % 8 == 1, '""').when(e % 8 == 2, '"no"').when(e % 8 == 3, "0e5")
        .when(e % 8 == 4, 'true, "deleted": -0.0').otherwise("0")
    )
    git_body = F.concat(F.lit('{"note": "ü", "deleted": '), deleted, named, F.when(e % 17 == 0, "} x").otherwise("}"))
    body = F.when(e % 29 != 0, F.when(service == "git-crawler", git_body).otherwise(""))
    event = F.when(e % 5 == 0, "pull_request").when(e % 5 == 1, "issues").otherwise("push")
    good = F.concat(F.lit("sha256="), _sign(F.coalesce(F.col("body"), F.lit(""))))
    signature = (
        F.when(kind <= 2, good)
        .when(kind == 3, F.concat(F.lit("sha256="), F.sha2(F.lit("wrong"), 256)))
        .when(kind == 4, F.replace(good, F.lit("sha256="), F.lit("sha1=")))
        .when(kind == 6, F.lit("sha256=unchecked"))
    )
    states = F.array(*[F.lit(s) for s in ("exists", "add", "update", "not_exists", "trash", "sync")])
    uri = F.when(
        kind != 4,
        F.concat(
            F.lit("https://www.googleapis.com/drive/v3/files/fold"),
            (e % 8).cast("string"),
            F.when(kind == 5, "/").otherwise(""),
            F.lit("?alt=json"),
        ),
    )
    is_git = service == "git-crawler"
    def header(name, value: Column) -> Column:
        return F.struct((F.lit(name) if isinstance(name, str) else name).alias("k"), value.alias("v"))

    entries = F.array(
        header("x-github-event", F.when(is_git, event)),
        header(F.when(e % 2 == 0, "x-hub-signature-256").otherwise("x-hub-signature"), F.when(is_git, F.col("signature"))),
        header("x-goog-channel-id", F.when(~is_git, F.when(kind == 3, "other").otherwise(CHANNEL))),
        header("x-goog-resource-uri", F.when(~is_git, uri)),
        header("x-goog-resource-state", F.when(~is_git, F.get(states, (e % 6).cast("int")))),
    )
    return (
        table(spark, sf_dir, "events")
        .select("event_id", service.alias("service"), body.alias("body"))
        .withColumn("signature", signature)
        .select(
            "event_id",
            F.concat(F.lit("/hook/"), F.col("service"), F.when(kind == 6, "/open").otherwise("")).alias("endpoint_id"),
            "service",
            F.map_from_entries(F.filter(entries, lambda x: x["v"].isNotNull())).alias("headers"),
            "body",
            F.when(kind == 6, "").when(is_git, GIT_SECRET).otherwise(CHANNEL).alias("secret"),
        )
    )


def registry(spark, sf_dir) -> DataFrame:
    """Every supplier as a registered source: repositories and folders by turns."""
    k = F.col("s_suppkey")
    half = F.floor(k / 2).cast("string")
    return table(spark, sf_dir, "supplier").select(
        F.when(k % 2 == 0, F.concat(F.lit("https://github.com/org/src"), half))
        .otherwise(F.concat(F.lit("fold"), half))
        .alias("source_identifier"),
        F.transform(
            F.sequence(F.lit(0), (k % 4).cast("int")),
            lambda i: F.concat(F.lit("task"), k.cast("string"), F.lit("-"), i.cast("string")),
        ).alias("registered_tasks"),
        (k % 9 != 0).alias("webhook_flag"),
    )


def endpoints(spark) -> DataFrame:
    return spark.createDataFrame(
        [
            ("/hook/git-crawler", GIT_SECRET, None),
            ("/hook/googledrive-crawler", None, CHANNEL),
            ("/hook/git-crawler/open", "", None),
        ],
        "endpoint_id string, secret string, external_webhook_id string",
    )


def tasks(spark, sf_dir) -> DataFrame:
    """Every supplier as a task definition of one of four kinds, complete or not."""
    k = F.col("s_suppkey")
    kind = k % 4
    depth = F.when(k % 8 >= 4, ', "maxDepth": 3, "depth": 9').otherwise("")
    web = F.concat(F.lit('{"recursiveCrawling": true'), F.when(k % 5 == 0, "").otherwise(', "startUrl": "https://a.example.com"'), depth, F.lit("}"))
    git = F.concat(F.lit('{"branch": "main"'), F.when(k % 5 == 0, ', "repoUrl": ""').otherwise(', "repoUrl": "https://github.com/org/x"'), depth, F.lit("}"))
    folder = F.when(k % 5 == 0, "").when(k % 10 == 4, ', "folderId": "your_google_drive_folder_id"').otherwise(', "folderId": "fold1"')
    key = (
        F.when(k % 7 == 0, "")
        .when(k % 7 == 1, ', "serviceAccountKey": "{broken"')
        .when(k % 7 == 2, r', "serviceAccountKey": "{\"client_email\": \"a@b.c\"}"')
        .when(k % 7 == 3, ', "serviceAccountKeyPath": "/keys/a.json"')
        .otherwise(r', "serviceAccountKey": "{\"client_email\": \"a@b.c\", \"private_key\": \"k\"}"')
    )
    drive = F.concat(F.lit('{"pageSize": 50'), folder, key, F.lit("}"))
    plugin = (
        F.when(kind == 0, "http-crawler")
        .when(kind == 1, F.when(k % 3 == 0, "Git-Crawler").otherwise("git"))
        .when(kind == 2, F.when(k % 3 == 0, "googledrive-crawler").otherwise("gdrive-crawler"))
        .otherwise("s3")
    )
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("task"), k.cast("string")).alias("task_id"),
        plugin.alias("plugin_type"),
        F.when(kind == 0, web).when(kind == 1, git).when(kind == 2, drive).otherwise("{}").alias("config"),
    )


def run_definitions(spark, sf_dir) -> DataFrame:
    """Every supplier as a task: crawls of one page, scans and deltas, and some that cannot run."""
    k = F.col("s_suppkey")
    kind, number = k % 28, k.cast("string")
    key = r'"serviceAccountKey": "{\"client_email\": \"a@b.c\", \"private_key\": \"k\"}"'

    def config(*parts) -> Column:
        return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))

    git, drive = kind.isin(2, 3, 8), kind.isin(4, 5, 6, 9)
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("task"), number).alias("task_id"),
        F.when(git, "git").when(drive, "gdrive-crawler").otherwise("http-crawler").alias("plugin_type"),
        F.when(kind == 1, config(f'{{"startUrl": "{SITE}/none/', number, '"}'))
        .when(kind == 2, config('{"repoUrl": "https://github.com/org/r', (k % REPOS).cast("string"), '"}'))
        .when(kind == 3, config('{"repoUrl": "https://github.com/org/lost', number, '"}'))
        .when(kind == 4, config('{"folderId": "fold', (k % 3).cast("string"), f'", {key}}}'))
        .when(kind == 5, config('{"folderId": "lost', number, f'", {key}}}'))
        .when(kind == 6, config(f"{{{key}}}"))
        .when(kind == 8, config('{"repoUrl": "https://github.com/org/any"}'))
        .when(kind == 9, config(f'{{"folderId": "fold1", {key}}}'))
        .otherwise(config(f'{{"startUrl": "{SITE}/p/', (k % 20).cast("string"), '"}'))
        .alias("config"),
        F.when(kind == 9, "100").alias("start_page_token"),
    )


def run_inputs(spark, sf_dir) -> dict[str, DataFrame]:
    """Tables for all plugins; pushes and the drive feed are routed to the first tasks that take them."""
    pushes, feed = push_events(spark, sf_dir), drive_changes(spark, sf_dir)
    return {
        "pages": site_pages(spark, sf_dir),
        "repo_files": repo_files(spark, sf_dir),
        "pushes": pushes.withColumn("task_id", F.concat(F.lit("task"), (F.col("event_id") % 2 * 28 + 8).cast("string"))),
        "drive_files": drive_files(spark, sf_dir),
        "drive_content": drive_content(spark, sf_dir),
        "drive_changes": feed.withColumn("task_id", F.lit("task9")),
    }


def validated(pages: DataFrame, turn: int) -> DataFrame:
    """With validators: of the body where it was edited; some change by themselves, some servers give none."""
    n, edited = F.col("page_id"), F.col("body").endswith("<!-- edited -->")
    return pages.withColumn("validator", F.when(n % 5 != 0, F.concat_ws("-", n, edited, F.when(n % 9 == 0, F.lit(turn)))))


def later_pages(spark, sf_dir, *keep: str) -> DataFrame:
    """The page table at a later poll: some pages moved, some were edited."""
    n = F.col("page_id")
    return table(spark, sf_dir, "pages").select(
        *keep,
        F.when(n % 11 == 0, F.concat(F.lit("https://moved.example.com/"), n.cast("string"))).otherwise(F.col("url")).alias("url"),
        F.when(n % 7 == 0, F.concat(F.col("html"), F.lit("<!-- edited -->"))).otherwise(F.col("html")).alias("body"),
    )


def summary_tasks(spark) -> DataFrame:
    """Definitions behind the records of all sources: five that can run, two that cannot."""
    key = r'"serviceAccountKey": "{\"client_email\": \"a@b.c\", \"private_key\": \"k\"}"'
    start, repo = f'{{"startUrl": "{SEED}"}}', '{"repoUrl": "https://github.com/org/r1"}'
    rows = [("web-1", "http-crawler", start), ("web-2", "http-crawler", start), ("git-1", "git", repo), ("drive-1", "gdrive-crawler", f'{{"folderId": "fold1", {key}}}'),
            ("idle-1", "git", repo), ("lost-1", "http-crawler", "{}"), ("lost-2", "no-such-crawler", "{}")]
    return spark.createDataFrame(rows, "task_id string, plugin_type string, config string")


def tree_path() -> Column:
    """Where a document lies in the tree: folders by language and source, some hidden, some names with an underscore."""
    n = F.col("doc_id")
    name = F.concat(F.when(n % 20 == 0, ".d").when(n % 29 == 0, "_d").otherwise("d"), n.cast("string"), F.lit(".txt"))
    return F.concat_ws("/", F.coalesce("lang", F.lit("und")), F.when(n % 23 == 0, ".git").otherwise(F.concat(F.lit("part "), (n % 7).cast("string"))), name)


def write_tree(spark, sf_dir, root: str) -> None:
    """A file for each document below ``root``, written by tasks."""

    def write(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for path, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store.create_dir(f"{base}/{path.rpartition('/')[0]}", recursive=True)
                with store.open_output_stream(f"{base}/{path}") as out:
                    out.write((text or "").encode())
        yield from ()

    table(spark, sf_dir, "documents").select(tree_path().alias("path"), "text").mapInArrow(write, "path string").write.format("noop").mode("overwrite").save()

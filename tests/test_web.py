"""Crawls over small hand-made sites."""

import random

import pytest
from pyspark.sql import functions as F

from feedloom.operators import sitemaps, web
from querybook.inputs import RULES

HTML = "text/html; charset=utf-8"


def site(spark, pages):
    """pages: {url: (status, type, body)} or {url: [links]}."""
    rows = []
    for url, page in pages.items():
        if isinstance(page, list):
            page = (200, HTML, "".join(f'<a href="{link}">x</a>' for link in page))
        rows.append((url, *page))
    return spark.createDataFrame(rows, "url string, status_code int, content_type string, body string")


def task(spark, start, depth=1, recursive=True, sitemap=False, allowed=None, include=None, exclude=None):
    return spark.createDataFrame([("t", start, depth, recursive, sitemap, allowed, include, exclude)], RULES)


def reached(records):
    return {(r.url, r.depth, r.status_code) for r in records.select("url", "web.depth", "status_code").collect()}


H = "https://example.com"


def test_single_page(spark):
    got = web.crawl(task(spark, H, recursive=False), site(spark, {f"{H}/": ["/a"]}), run_ts=F.lit("2024-01-01").cast("timestamp"))
    rows = got.collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.id, r.url, r.status_code, r.content_text) == (f"{H}/", f"{H}/", 200, '<a href="/a">x</a>')
    assert (r.web.content_type, r.web.depth, r.error, r.fetched_at.year) == (HTML, 0, None, 2024)
    assert (r.source, r.change_type, r.change_op, r.content_kind) == ("web", None, "UPSERT", "text")


def test_recursion_stops_at_the_depth(spark):
    pages = site(spark, {f"{H}/": ["/a"], f"{H}/a": ["/b"], f"{H}/b": ["/c"], f"{H}/c": []})
    assert reached(web.crawl(task(spark, H, 1), pages)) == {(f"{H}/", 0, 200), (f"{H}/a", 1, 200)}
    assert len(reached(web.crawl(task(spark, H, 9), pages))) == 4


def test_no_depth_means_start_page_only(spark):
    pages = site(spark, {f"{H}/": ["/a"], f"{H}/a": []})
    assert reached(web.crawl(task(spark, H, None), pages)) == {(f"{H}/", 0, 200)}
    assert reached(web.crawl(task(spark, H, -1), pages)) == set()


def test_loops_and_repeats_are_taken_once(spark):
    pages = site(spark, {f"{H}/": ["/a", "/a", "/"], f"{H}/a": ["/", "/a"]})
    assert reached(web.crawl(task(spark, H, 5), pages)) == {(f"{H}/", 0, 200), (f"{H}/a", 1, 200)}


def test_only_html_is_searched_for_links(spark):
    link = '<a href="/x">x</a>'
    pages = site(spark, {f"{H}/": ["/j", "/n", "/h"], f"{H}/j": (200, "application/json", link),
                         f"{H}/n": (200, None, link), f"{H}/h": (200, "TEXT/HTML", link)})
    assert {u for u, _, _ in reached(web.crawl(task(spark, H, 3), pages))} == {f"{H}/", f"{H}/j", f"{H}/n", f"{H}/h"}


def test_failures_are_rows_and_not_followed(spark):
    pages = site(spark, {f"{H}/": ["/gone", "/down", "/dead"], f"{H}/down": (503, HTML, '<a href="/x">'),
                         f"{H}/dead": (None, None, None)})
    got = {r.url: r for r in web.crawl(task(spark, H, 3), pages).collect()}
    assert len(got) == 4
    gone = got[f"{H}/gone"]
    assert (gone.status_code, gone.error) == (404, "Request failed with status code 404")
    assert gone.content_text == "Error fetching: Request failed with status code 404"
    assert (gone.content_kind, gone.change_op, gone.web.depth) == ("error", "NONE", 1)
    assert got[f"{H}/down"].status_code == 503 and got[f"{H}/dead"].status_code == 500


def test_missing_start_url_crawls_nothing(spark):
    assert web.crawl(task(spark, None), site(spark, {f"{H}/": []})).count() == 0
    assert web.crawl(task(spark, ""), site(spark, {f"{H}/": []})).count() == 0


def test_the_start_page_is_not_filtered(spark):
    pages = site(spark, {f"{H}/": ["/docs/a", "/blog", "https://other.com/docs/b"], f"{H}/docs/a": []})
    got = web.crawl(task(spark, H, 2, allowed=["example.com"], include=["/docs"]), pages)
    assert reached(got) == {(f"{H}/", 0, 200), (f"{H}/docs/a", 1, 200)}


def test_a_start_page_outside_the_rules_is_followed(spark):
    pages = site(spark, {"https://other.net/": [f"{H}/docs", f"{H}/blog"], f"{H}/docs": ["/docs/2"], f"{H}/blog": ["/docs/3"],
                         f"{H}/docs/2": [], f"{H}/docs/3": []})
    got = web.crawl(task(spark, "https://other.net", 3, allowed=["example.com"], include=["/docs"]), pages)
    assert reached(got) == {("https://other.net/", 0, 200), (f"{H}/docs", 1, 200), (f"{H}/docs/2", 2, 200)}


def test_many_rules_and_shared_edges(spark):
    pages = site(spark, {f"{H}/": [f"/{i}" for i in range(30)], **{f"{H}/{i}": ["/"] for i in range(30)}})
    rows = [(f"t{i}", H, 2, True, False, None, [f"/{i}"], None) for i in range(25)]
    tasks = spark.createDataFrame(rows, RULES)
    want = {(f"t{i}", f"{H}/{j}") for i in range(25) for j in range(30) if str(j).startswith(str(i))} | {(f"t{i}", f"{H}/") for i in range(25)}
    for edges in (None, web.link_edges(pages)):
        got = web.crawl(tasks, pages, edges=edges).select("task_id", "url").collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_unfetchable_addresses(spark):
    front = spark.createDataFrame([("relative/x",), ("mailto:a@b.c",), ("http://",)], "url string")
    got = {r.url: (r.status_code, r.error) for r in web.web_fetch(front, site(spark, {f"{H}/": []})).collect()}
    assert got == {
        "relative/x": (500, "Invalid URL"),
        "mailto:a@b.c": (500, "Unsupported protocol mailto:"),
        "http://": (500, "Invalid URL"),
    }


def test_a_fragment_is_not_part_of_the_request(spark):
    pages = site(spark, {f"{H}/": ["/a#one", "/a#two", "/a"], f"{H}/a": ["#three"]})
    assert reached(web.crawl(task(spark, H, 2), pages)) == {
        (f"{H}/", 0, 200), (f"{H}/a#one", 1, 200), (f"{H}/a#two", 1, 200), (f"{H}/a", 1, 200), (f"{H}/a#three", 2, 200)}


def test_snapshot_keeps_the_newest_copy(spark):
    pages = spark.createDataFrame(
        [("http://h/a", 1, "old"), ("http://h/a#x", 2, "new"), ("http://h/b#y", 1, "only")], "url string, at int, body string"
    )
    assert {(r.url, r.body) for r in web.page_snapshot(pages, "at").collect()} == {("http://h/a#x", "new"), ("http://h/b#y", "only")}


@pytest.mark.parametrize("partitions", [1, 7])
def test_depths_are_shortest_distances(spark, partitions):
    """A random graph with one hub that a third of all links lead to, against plain search."""
    rng = random.Random(7)
    n = 120
    out = {i: [0 if rng.random() < 1 / 3 else rng.randrange(n) for _ in range(3)] for i in range(n)}
    out[5] = list(range(40))
    pages = site(spark, {f"{H}/{i}": [f"/{j}" for j in js] for i, js in out.items()}).repartition(partitions)
    depth, level = {5: 0}, [5]
    while level:
        level = list({j for i in level for j in out[i]} - set(depth))
        last = max(depth.values()) + 1
        depth.update({j: last for j in level})
    want = {(f"{H}/{i}", d, 200) for i, d in depth.items() if d <= 4}
    assert reached(web.crawl(task(spark, f"{H}/5", 4), pages)) == want


def test_tasks_do_not_share_what_they_visited(spark):
    pages = site(spark, {f"{H}/": ["/a"], f"{H}/a": ["/b"], f"{H}/b": []})
    both = task(spark, H, 2).union(task(spark, f"{H}/a", 1).withColumn("task_id", F.lit("u")))
    got = web.crawl(both, pages).select("task_id", "url", "web.depth").collect()
    assert {tuple(r) for r in got} == {
        ("t", f"{H}/", 0), ("t", f"{H}/a", 1), ("t", f"{H}/b", 2), ("u", f"{H}/a", 0), ("u", f"{H}/b", 1)}


def maps(spark, rows):
    return spark.createDataFrame(rows, "url string, body string")


def robots(spark, rows=()):
    return spark.createDataFrame(list(rows), "host string, body string")


SET = f"<urlset><url><loc>{H}/a</loc></url><url><loc>{H}/private/b</loc></url></urlset>"


def test_crawl_from_the_robots_sitemap(spark):
    pages = site(spark, {f"{H}/": ["/z"], f"{H}/a": ["/c"], f"{H}/c": []})
    got = sitemaps.crawl_from_sitemap(
        task(spark, H, 0, sitemap=True, exclude=["/private"]), pages,
        robots(spark, [("example.com", f"User-agent: *\nSitemap: {H}/s.xml")]), maps(spark, [(f"{H}/s.xml", SET)]))
    assert reached(got) == {(f"{H}/a", 0, 200)}


def test_fallback_sitemap_and_none_at_all(spark):
    pages = site(spark, {f"{H}/": ["/z"], f"{H}/a": []})
    t = task(spark, H, 0, sitemap=True)
    fallback = maps(spark, [(f"{H}/sitemap.xml", SET)])
    assert reached(sitemaps.crawl_from_sitemap(t, pages, robots(spark), fallback)) == {(f"{H}/a", 0, 200), (f"{H}/private/b", 0, 404)}
    assert reached(sitemaps.crawl_from_sitemap(t, pages, robots(spark), maps(spark, []))) == {(f"{H}/", 0, 200)}


def test_a_named_but_missing_sitemap_has_no_fallback(spark):
    pages = site(spark, {f"{H}/": []})
    t = task(spark, H, 0, sitemap=True)
    named = robots(spark, [("example.com", f"Sitemap: {H}/missing.xml")])
    assert reached(sitemaps.crawl_from_sitemap(t, pages, named, maps(spark, [(f"{H}/sitemap.xml", SET)]))) == set()
    empty = robots(spark, [("example.com", "Sitemap:")])
    assert reached(sitemaps.crawl_from_sitemap(t, pages, empty, maps(spark, [(f"{H}/sitemap.xml", SET)]))) == {(f"{H}/", 0, 200)}


def test_nested_indexes_with_a_cycle(spark):
    def index(*names):
        return "<sitemapindex>" + "".join(f"<sitemap><loc>{H}/{n}</loc></sitemap>" for n in names) + "</sitemapindex>"

    table = maps(spark, [(f"{H}/i0", index("i0", "i1", "s0", "none")), (f"{H}/i1", index("i0", "s1", "s0")),
                         (f"{H}/s0", SET), (f"{H}/s1", f"<urlset><url><loc>{H}/d</loc></url></urlset>")])
    starts = spark.createDataFrame([("t", f"{H}/i0")], "task_id string, sitemap_url string")
    got = sitemaps.sitemap_urls(starts, table, exclude=["/private"]).collect()
    assert {(r.sitemap_url, r.loc, r.allowed) for r in got} == {
        (f"{H}/s0", f"{H}/a", True), (f"{H}/s0", f"{H}/private/b", False), (f"{H}/s1", f"{H}/d", True)}
    assert len(got) == 3


def test_sitemap_addresses_are_compared_in_normal_form(spark):
    table = maps(spark, [("HTTPS://example.com:443/i", f"<sitemapindex><sitemap><loc>\n {H}/s </loc></sitemap></sitemapindex>"), (f"{H}/s", SET)])
    starts = spark.createDataFrame([("t", f" {H}/i")], "task_id string, sitemap_url string")
    assert {r.sitemap_url for r in sitemaps.sitemap_urls(starts, table).collect()} == {f"{H}/s"}


def test_snapshot_addresses_need_no_normal_form(spark):
    pages = site(spark, {"https://example.com": ["/a b"], "HTTPS://EXAMPLE.com/a b": []})
    assert reached(web.crawl(task(spark, H, 1), pages)) == {(f"{H}/", 0, 200), (f"{H}/a%20b", 1, 200)}


def test_a_relative_entry_is_allowed_but_cannot_be_fetched(spark):
    table = maps(spark, [(f"{H}/s.xml", "<urlset><url><loc>/rel</loc></url></urlset>")])
    got = sitemaps.crawl_from_sitemap(
        task(spark, H, 0, sitemap=True), site(spark, {f"{H}/rel": []}),
        robots(spark, [("example.com", f"Sitemap: {H}/s.xml")]), table)
    assert reached(got) == {("/rel", 0, 500)}


def test_a_port_is_not_part_of_the_robots_host(spark):
    seeds = spark.createDataFrame([("t", f"{H}:8443/x")], "task_id string, url string")
    row = sitemaps.discover_sitemaps(seeds, robots(spark, [("example.com", "Sitemap: s")]), maps(spark, [])).first()
    assert (row.host, row.sitemap_url) == ("example.com", "s")

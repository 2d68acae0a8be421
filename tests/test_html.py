from html import unescape

from pyspark.sql import functions as F

from feedloom.functions import crypto, html, jsontext

PAGE = """<a href="/1">x</a><!-- <a href="/c"> --><script>var t="<a href='/s'>"</script>
<A title="a > b href=no" data-href='/dh' class=x HREF = '/2&amp;a=1&#38;b&copy;&#x1F600;&lt;'>y</a>
<a href=/3/x>z</a><abbr href="/no">q</abbr><a name=x href>e</a><a href="">e</a><a
href="/4"/><a x="1"href="/5"><a href="/6" href="/7"><textarea><a href=/t></textarea><a / href='q"q'>
<style>a{}</style><article href="/no"><a hreflang="en" href="?x=1#y">"""


def links(spark, page, base="https://h.com/d/", **how):
    df = spark.createDataFrame([(page, base)], "page string, base string")
    return df.select(html.page_links(F.col("page"), F.col("base"), **how)).first()[0]


def test_page_links(spark):
    h = "https://h.com"
    assert links(spark, PAGE) == [
        f"{h}/1",
        f"{h}/2&a=1&b%C2%A9%F0%9F%98%80%3C",
        f"{h}/3/x",
        f"{h}/4",
        f"{h}/5",
        f"{h}/6",
        f"{h}/d/q%22q",
        f"{h}/d/?x=1#y",
    ]


def test_comments_and_scripts_hold_no_links(spark):
    page = '<p><a href="/a">1</a><!-- <a href="/no"> --><a class=k href=\'b?c&amp;d\'>2</a><script>"<a href=/s>"</script>'
    assert links(spark, page) == ["https://h.com/a", "https://h.com/d/b?c&d"]


def test_no_page(spark):
    assert links(spark, None) in (None, [])
    assert links(spark, "no markup") == []


def test_large_and_hostile_pages(spark):
    """Whole pages are read, and neither length nor broken markup exhausts the matcher's stack."""
    big = "<p>" + "word " * 400_000 + "</p>" + '<a href="/end">'
    attributes = "<a " + " ".join(f'k{i}="v>{i}"' for i in range(20_000)) + ' href="/many">'
    unclosed = "<!-- " + "<a href=/x>" * 50_000
    quotes = "<a title=\"" + "x" * 200_000
    assert links(spark, big) == ["https://h.com/end"]
    assert links(spark, attributes) == ["https://h.com/many"]
    assert links(spark, unclosed) == []
    assert links(spark, quotes) == []


def test_decode_entities_in_one_pass(spark):
    texts = ["&amp;lt;", "&#38;amp;", "a&amp;&lt;b", "&nosuch;", "&", "&;", "&copy", "&hearts;&#x41;&#65;", "&#0;", "&amp &lt&gt", "&#65 &#x41.", "&hearts",
             "&#x0000000000041;&#00000000000000065;", "&#99999999999999999999;&#xfffffffffffffffffff;", "&#;", "&#x;", "&#xg"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in rows.select(html.decode_entities(F.col("t"))).collect()]
    assert got == [unescape(t) for t in texts]


def test_names_without_a_semicolon_in_addresses(spark):
    assert links(spark, '<a href="/q?a=1&copy=2&lt=3&amp&b=&reg">') == ["https://h.com/q?a=1&copy=2&lt=3&&b=%C2%AE"]
    assert links(spark, '<a href="/q?a=1&notit=2&notit;&#x0000041;">') == ["https://h.com/q?a=1&notit=2&notit;A"]


def test_sitemaps(spark):
    urlset = """<?xml version="1.0"?><urlset xmlns="x"><url><loc> https://a/?x=1&amp;y=2 </loc>
    <image:image><image:loc>no</image:loc></image:image></url><!-- <url><loc>c</loc></url> -->
    <url><lastmod>1</lastmod><loc><![CDATA[https://b/?a&b]]></loc></url><url><loc>cut"""
    index = "<sitemapindex><sitemap><loc>s1</loc></sitemap><sitemap><loc>s2</loc></sitemap></sitemapindex>"
    rows = spark.createDataFrame([(urlset,), (index,), ("junk",), ("<urlset><url>",)], "b string")
    got = rows.select(html.sitemap_locs(F.col("b")).alias("l"), html.is_sitemap_index(F.col("b")).alias("i")).collect()
    assert got[0].l == [" https://a/?x=1&y=2 ", "https://b/?a&b", "cut"] and not got[0].i
    assert got[1].l == ["s1", "s2"] and got[1].i
    assert not got[2].l and not got[3].l


def test_robots(spark):
    rows = spark.createDataFrame(
        [("User-agent: *\r\nSITEMAP: https://a/s.xml \r\nSitemap: x",), (" sitemap: no\n",), ("Sitemap:\n",), (None,)],
        "b string",
    )
    assert [r[0] for r in rows.select(html.robots_sitemap(F.col("b"))).collect()] == ["https://a/s.xml", None, "", None]


def test_hmac(spark):
    import hashlib
    import hmac

    keys = ["k", "ключ", "x" * 63, "x" * 64, "y" * 65, "6\\" * 10, "6" * 64, "z" * 200]
    body = '{"a":"ü"}'
    rows = spark.createDataFrame([(k, body) for k in keys], "k string, b string")
    got = rows.select("k", crypto.hmac_sha256_hex(crypto.hmac_pads(F.col("k")), F.col("b")).alias("h")).collect()
    assert all(r.h == hmac.new(r.k.encode(), body.encode(), hashlib.sha256).hexdigest() for r in got)


def test_is_json(spark):
    good = ['{"a":1}', "5", '"x"', " [1, 2] ", "true", '{"a":1,"a":{"b":2,"b":[]}}', "-0.5e3"]
    bad = ['{"a":1} x', "", "{'a':1}", "nul", "1,2", '{"a":', None, "NaN", "1]", "1],[2", '1}', '1,"b":2', "01", '"a\nb"', "null", "[1,]"]
    rows = spark.createDataFrame([(t,) for t in good + bad], "t string")
    got = [r[0] for r in rows.select(jsontext.is_json(F.col("t"))).collect()]
    assert got == [True] * len(good) + [False] * len(bad)


def test_has_keys(spark):
    rows = spark.createDataFrame([('{"a":null,"b":1}',), ('{"b":1}',), ("[1]",), ("x",), (None,)], "t string")
    assert [r[0] for r in rows.select(jsontext.has_keys(F.col("t"), "a", "b")).collect()] == [True, False, False, False, False]

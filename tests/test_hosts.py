"""Host names and IPv6 addresses against Python's codecs."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from feedloom.functions import hosts, urls


def evaluate(spark, items, sql):
    rows = spark.createDataFrame(list(enumerate(items)), "i int, t string").select("i", F.expr(sql).alias("v"))
    return [r.v for r in rows.orderBy("i").collect()]


def test_labels_are_the_codecs(spark):
    random.seed(7)
    letters = "abcxyz019-" + "äöüßéñçøåþ" + "αβγδεжщы" + "中文字漢語" + "한국" + "عربي" + "😀🙂" + "\u0301"
    labels = ["münchen", "ü", "bücher", "straße", "例え", "почта", "ñandú-2", "😀", "a" * 50 + "ü" * 10, "üa" * 25, "𐍈𐍈a"]
    labels += ["".join(random.choices(letters, k=random.randint(1, 30))) for _ in range(400)]
    labels = [x for x in labels if not x.isascii()]
    got = evaluate(spark, labels, hosts.ascii_label("t"))
    assert got == ["xn--" + x.encode("punycode").decode() for x in labels]


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("München.DE", "xn--mnchen-3ya.de"), ("ＡＢＣ。ｃｏｍ", "abc.com"), ("a\u00adb.example", "ab.example"), ("ΣΑΣ.gr", "xn--" + "σασ".encode("punycode").decode() + ".gr"),
        ("straße.de", "xn--strae-oqa.de"), ("faß.ẞ", "xn--fa-hia.xn--zca"), ("xn--mnchen-3ya.ü", "xn--mnchen-3ya.xn--tda"),
    ],
)
def test_names(spark, name, want):
    assert evaluate(spark, [name], hosts.ascii_domain("t")) == [want]


def plain_ipv6(text):
    try:
        packed = ipaddress.IPv6Address(text).packed
        groups = [packed[i] * 256 + packed[i + 1] for i in range(0, 16, 2)]
    except ValueError:
        return None
    best = max(((n, -i) for i in range(8) for n in range(2, 9 - i) if not any(groups[i : i + n])), default=None)
    shown = [f"{g:x}" for g in groups]
    if best is None:
        return f"[{':'.join(shown)}]"
    n, at = best[0], -best[1]
    return f"[{':'.join(shown[:at])}::{':'.join(shown[at + n :])}]"


def test_addresses(spark):
    random.seed(8)
    items = ["::", "::1", "0:0::1", "1::", "::ffff:1.2.3.4", "1:2:3:4:5:6:1.2.3.4", "1:2:3:4:5:6:7:8", "0:0:0:0:0:0:0:0", "1:0:0:2:0:0:0:3", "1:0:0:2:0:0:3:4", "0:1:0:0:1:0:0:1",
             "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "1::2::3", ":::", "12345::", "g::", "::1.2.3", "::1.2.3.256", "::01.2.3.4", "1.2.3.4", ":1:2:3:4:5:6:7", "1:2:3:4:5:6:7:", "2001:0DB8::00FF", ""]
    for _ in range(400):
        groups = [random.choice(["0", "0", "0000", f"{random.randrange(1 << 16):x}"]) for _ in range(8)]
        at, n = random.randrange(8), random.randrange(0, 9)
        items.append(":".join(groups) if random.random() < 0.5 else ":".join(groups[:at]) + "::" + ":".join(groups[at + n :]))
    items = [x for x in items if "::" not in x or len([g for g in x.split(":") if g]) <= 7]
    got = evaluate(spark, [f"[{x}]" for x in items], hosts.short_ipv6("t"))
    assert dict(zip(items, got, strict=True)) == {x: plain_ipv6(x) for x in items}


def test_in_addresses(spark):
    pairs = [
        ("http://MÜNCHEN.de/ü", "http://xn--mnchen-3ya.de/%C3%BC"), ("http://[0:0::1]:80/", "http://[::1]/"), ("https://[::FFFF:1.2.3.4]:8443/x", "https://[::ffff:102:304]:8443/x"),
        ("http://b%C3%BCcher.de", "http://xn--bcher-kva.de/"), ("http://[1:2]/", "http://[1:2]/"), ("http://１２７.１/", "http://127.0.0.1/"), ("http://ex ample.ü/", "http://ex ample.ü/"),
    ]
    rows = spark.createDataFrame(pairs, "url string, want string")
    assert [(r.v, r.want) for r in rows.select(urls.normalize_url(F.col("url")).alias("v"), "want").collect() if r.v != r.want] == []
    found = spark.createDataFrame([("https://h.com/", "//Bücher.de/x")], "base string, link string").select(urls.resolve_url(F.col("link"), F.col("base")).alias("v"))
    assert found.first().v == "https://xn--bcher-kva.de/x"

"""Phrases, counts, cuts and ranks against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from feedloom.llm import collocations as c


def pieces(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall("[^ \t]+", p) for p in re.split("[.,;:!?\n\x0b\x0c\r]", text)]


def plain(rows, least, top):
    f, n, order = Counter(), Counter(), {}
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    often = {k: v for k, v in f.items() if v >= least and len(k[1]) > 1}
    out = {}
    for (lang, p), a in often.items():
        score, _, l, r = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        inside = any(
            lang == other and len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (other, q), b in often.items()
        )
        if not inside:
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    for lang, found in out.items():
        order[lang] = [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])]
    return sorted(x for found in order.values() for x in found)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def corpus():
    random.seed(9)
    words = ["a", "b", "B", "ça", "d\x01", "e", "it's", "g", "É", "🙂", "x-1"]
    made = []
    for k in range(220):
        text = ""
        for _ in range(random.randint(0, 60)):
            text += random.choice(words) + random.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ; "])
            if random.random() < 0.1:
                text += "every time it rains "
        made.append((text, random.choice(["en", "fr", None, ""])))
    return [*made, *made[:40], (None, "en"), ("", None), (" . ,", "fr"), ("z " * 20000, "de"), ("z z z z z z z", "de"), ("y, " * 300, "nl")]


@pytest.mark.parametrize("bits", [64, 10])
def test_against_plain(spark, monkeypatch, bits):
    """With ten bits almost all fingerprints collide; counts must still be exact."""
    monkeypatch.setattr(c, "FINGERPRINT", np.uint64((1 << bits) - 1))
    monkeypatch.setattr(c, "HELD", 3000)
    monkeypatch.setattr(c, "DISTINCT", 500)
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1, "q") for r in rows], "text string, lang string, n int, phrase string").repartition(6)
    want = plain(rows, 12, 15)
    assert got(c.collocations(docs, least_count=12, top=15)) == want
    assert len({w[0] for w in want}) >= 4 and any(len(w[2].split(" ")) >= 4 for w in want)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = plain([(r.text, r.lang) for r in docs.select("text", "lang").collect()], 100, 2000)
    assert got(c.collocations(docs)) == want


def test_nothing(spark):
    assert c.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0
    assert c.collocations(spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")).count() == 0


def test_wide_products(spark):
    """The score's products pass 64 bits."""
    expr = "(cast(cast(a AS decimal(18,0)) * 1000 AS decimal(21,0)) * cast(n AS decimal(16,0))) div (cast(l AS decimal(18,0)) * cast(r AS decimal(18,0)))"
    a, n, l, r = 10**13, 3 * 10**15 + 7, 10**13 + 3, 2 * 10**13 + 1
    assert spark.createDataFrame([(a, n, l, r)], "a long, n long, l long, r long").selectExpr(expr).first()[0] == 1000 * a * n // (l * r)

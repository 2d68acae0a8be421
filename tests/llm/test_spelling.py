"""Words, near words, forms and roots against plain counting and comparison."""

import random
import re
import zlib
from collections import Counter

import numpy as np

from feedloom.llm import spelling as s


def plain_counts(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def edits(word, letters):
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    return {x for a, b in cuts for x in ([a + b[1:]] if b else []) + [a + c + b for c in letters] + ([a + c + b[1:] for c in letters] if b else [])} - {word}


def plain(rows):
    counts = plain_counts(rows)
    letters = sorted(set("".join(counts)))
    near = {w: [x for x in edits(w, letters) if x in counts] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), counts[w], len(near[w]), counts.get(form[w])) for w in counts) if counts else []


def got(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def test_one_edit():
    random.seed(1)
    for _ in range(4000):
        a = "".join(random.choices("ab", k=random.randint(1, 6)))
        b = "".join(random.choices("ab", k=random.randint(1, 6)))
        assert s.one_edit(a, b) == (b in edits(a, "ab") and a != b)


def test_distances_are_those_of_the_letters():
    words = ["abcde", "abcd", "Àbcde".lower(), "aaaaa", "straße", "ÿÿÿÿÿ", "×÷abc"]
    held = s.letter_counts(words)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            one, two = Counter(a), Counter(b)
            assert s.squared_distances(held, held)[i, j] == sum((one[c] - two[c]) ** 2 for c in set(a + b))
    assert held.sum(axis=1).tolist() == [len(w) for w in words]


def test_against_plain(spark, monkeypatch):
    monkeypatch.setattr(s, "BLOCK", 8)
    monkeypatch.setattr(s, "HELD_WORDS", 50)
    random.seed(2)
    short = ["".join(random.choices("abé", k=random.randint(5, 7))) for _ in range(500)]
    longer = ["pre" + "".join(random.choices("xyz", k=random.randint(2, 5))) + "fix" for _ in range(200)]
    chain = ["aaaaab"] * 3 + ["aaaaabb"] * 6 + ["aaaaabbb"] * 12 + ["aaaaabbbb"] * 24 + ["aaaaabbbbb"] * 48 + ["aaaaabbbbbb"] * 96
    words = short * 2 + random.choices(short, k=4000) + longer * 3 + random.choices(longer, k=900) + chain * 2
    random.shuffle(words)
    rows = [(k % 40, " -1".join(words[k * 20 : k * 20 + 20]).title() if k % 3 else " ".join(words[k * 20 : k * 20 + 20])) for k in range(len(words) // 20 + 1)]
    rows += [(None, "nobody Nobody NOBODY"), (50, None), (51, ""), (52, "ÀÉÀÉÀÉ àéàéàé ÀÉÀÉÀÉ ÀÉÀÉÀÉ" * 2), (53, "x" * 30000), (53, "straße×÷ straße×÷ straße×÷")]
    want = plain(rows)
    docs = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int")
    assert got(s.variant_groups(docs)) == want
    assert sum(r[4] for r in want) > 500 and any(r[2] != (r[1] or r[0]) for r in want)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = plain([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert got(s.variant_groups(docs)) == want


def test_nothing(spark):
    assert s.variant_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert s.variant_groups(spark.createDataFrame([(1, None), (1, "a b c")], "doc_id long, text string")).count() == 0


def test_products_are_exact():
    big = np.full((1, s._LETTERS), 1000, np.float32)
    assert s.squared_distances(big, big)[0, 0] == 0

"""Scores against plain counting, probabilities that sum to one, and exchange that raises the likelihood."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedloom.llm import brown
from feedloom.llm.common import fold_of
from feedloom.session import Staging


def plain_tokens(text):
    return [*text.encode().lower().split(), b"\n"]


def number(word):
    return int(brown.END) if word == b"\n" else brown.word_hash(word)


def family(word):
    return int(brown.family_of(np.array([number(word)], np.uint64))[0])


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def test_tokens():
    batch = ["", "A\xa0B \tÉx\x0b\x0cy\x1cz\r", "b", " ", "Éx a"]
    hashes, owner = brown.tokens(pa.array(batch))
    want = [(t, w) for t, text in enumerate(batch) for w in plain_tokens(text)]
    assert want[1:4] == [(1, "a\xa0b".encode()), (1, "Éx".encode()), (1, b"y\x1cz")]
    assert owner.tolist() == [t for t, _ in want] and hashes.tolist() == [number(w) for _, w in want]
    assert len(set(hashes.tolist())) == len({w for _, w in want})
    assert family(b"aBx") == family(b"bx") != family(b"xy")


def test_ranks():
    hashes = np.unique(np.random.default_rng(3).integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2))
    np.random.default_rng(4).shuffle(hashes)
    hashes[:3] = [0, 2**64 - 1, 2**63]
    known = brown.Known.of(hashes)
    assert known.rank(hashes).tolist() == list(range(len(hashes)))
    assert set(known.rank(hashes[5:] + np.uint64(1)).tolist()) == {-1}
    assert brown.Known.of(hashes[:0]).rank(hashes[:2]).tolist() == [-1, -1] and brown.Known.of(hashes[:1]).rank(hashes[:2]).tolist() == [0, -1]


def test_best_classes_are_those_of_the_likelihood():
    rng = np.random.default_rng(5)
    pairs = rng.integers(0, 300, (4, 4)).astype(float)
    for _ in range(30):
        seen = rng.integers(0, 3, 8) * rng.integers(1, 12, 8)
        own = int(rng.integers(0, 4))
        base = pairs.copy()
        base[own] += seen[:4]
        base[:, own] += seen[4:]
        gains = []
        for c in range(4):
            moved = base.copy()
            moved[c] += seen[:4]
            moved[:, c] += seen[4:]
            # As best_classes has it: rows and columns of the class alone, the others' totals unchanged.
            x = brown._xlogx
            gains.append(sum(x(base[c] + seen[:4]) - x(base[c])) + sum(x(base[:, c] + seen[4:]) - x(base[:, c]))
                         - (x(base.sum(1)[c] + seen[:4].sum()) - x(base.sum(1)[c])) - (x(base.sum(0)[c] + seen[4:].sum()) - x(base.sum(0)[c])))
        at = np.flatnonzero(seen)
        found = brown.best_classes(np.zeros(len(at), np.int64), at, seen[at], np.array([own]), base)
        if len(at):
            assert found[0] in (own, int(np.argmax(gains)))


def plain_seen(numbers, classes, size):
    seen = np.zeros((3, len(classes), size))
    for a, b in zip(numbers, numbers[1:], strict=False):
        seen[0, a, classes[b]] += 1
        seen[1, b, classes[a]] += 1
        seen[2, a, 0] += a == b
    return seen


def test_exchange_raises_the_likelihood():
    random.seed(1)
    numbers = [random.choice(range(10 * (i % 4), 10 * (i % 4) + 10)) for i in range(8000)]
    classes = np.arange(40) % 4
    first = brown.likelihood(brown.transitions(plain_seen(numbers, classes, 4), classes))
    for _ in range(4):
        classes = brown.exchange(plain_seen(numbers, classes, 4), classes)
    last = brown.likelihood(brown.transitions(plain_seen(numbers, classes, 4), classes))
    assert last > first + 1000


def words(n, seed, kind=50):
    random.seed(seed)
    return " ".join(f"{random.choice('abc')}{random.randrange(kind)}" for _ in range(n))


@pytest.fixture
def docs(spark):
    rows = [(i, words(random.Random(i).randint(0, 60), i)) for i in range(120)] + [(600 + i, f"only{i} rare{i} a1 rare{i // 2}") for i in range(20)] + [(500, None), (501, ""), (None, "a1 b2 zzz"), (7, "a1"), (502, "x" * 500 + " a1 " * 3000)]
    return spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int")


def class_finder(model, rare):
    known = model.known
    held = dict(zip(known.hashes.tolist(), model.classes[known.ranks].tolist(), strict=True))
    held |= {r.h % (1 << 64): r.cls for r in rare.collect()}
    return lambda word: held[number(word)] if number(word) in held else int(model.families[family(word)])


@pytest.mark.parametrize("most", [1_000_000, 60])
def test_scores(spark, docs, monkeypatch, most):
    monkeypatch.setattr(brown, "KNOWN_WORDS", most)
    monkeypatch.setattr(brown, "BUCKETS", 7)
    monkeypatch.setattr(brown, "HELD", 500)
    monkeypatch.setattr(brown, "UNIT_SHARE", 0.005)
    learn = fold_of(F.col("doc_id"), 3) != 0
    staging = Staging(spark, "t")
    model, counts, rare = brown.fit(docs.where(learn), staging, n_classes=8, rounds=2)
    rows = docs.withColumn("learn", learn).collect()
    want = Counter(w for r in rows if r.learn for w in plain_tokens(r.text or ""))
    assert {r.h: r.n for r in counts.collect()} == {signed(number(w)): n for w, n in want.items()}
    assert (model.n, model.v) == (sum(want.values()), len(want))
    assert (rare.count() > 20) == (most == 60) and len(model.counts) + rare.count() == len(want)
    class_of = class_finder(model, rare)
    per_class = Counter()
    for w, n in want.items():
        per_class[class_of(w)] += n
    assert {c: n for c, n in enumerate(model.totals.tolist()) if n} == per_class

    def probability(word, before):
        if word not in want:
            return model.unknown
        return (1 - model.unknown) * 10 ** model.transition[class_of(before), class_of(word)] * want[word] / model.totals[class_of(word)]

    for before in (b"\n", b"a1", b"never seen"):
        assert math.isclose(sum(probability(w, before) for w in want) + probability(b"?", before), 1, rel_tol=1e-9)
    found = brown.class_scores(docs, model, rare).collect()
    assert len(found) == len(rows)
    expected = []
    for r in rows:
        own = plain_tokens(r.text or "")
        score = sum(math.log10(probability(w, b)) for b, w in zip([b"\n", *own], own, strict=False))
        base = sum(math.log10((want[w] + 0.1) / (model.n + 0.1 * (model.v + 1))) for w in own)
        expected.append((r.doc_id or 0, len(own), sum(w in want for w in own), round(base, 4), round(score, 4)))
    assert sorted((r.doc_id or 0, r.n_tokens, r.n_known, round(r.base_score, 4), round(r.score, 4)) for r in found) == sorted(expected)
    assert {r.train_tokens for r in found} == {model.n}


def test_held_out_perplexity(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fold = fold_of(F.col("doc_id"), 10)
    held = brown.score_documents(docs, learn=fold != 0).where(fold == 0)
    score, base, n = held.agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert score > base + 0.05 * n
    (worst,) = held.agg(F.max(brown.perplexity(F.col("score"), F.col("n_tokens")))).first()
    assert worst > 1


def test_empty(spark):
    schema = "doc_id long, text string"
    assert brown.score_documents(spark.createDataFrame([], schema)).count() == 0
    rows = brown.score_documents(spark.createDataFrame([(1, "a b")], schema), learn=F.lit(False)).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows] == [(3, 0, 0, 0.0, 0.0)]


@pytest.mark.parametrize("most", [1_000_000, 20])
def test_rare_words_are_clustered_one_by_one(spark, monkeypatch, most):
    # Words that end alike, in two places of a sentence: in one family, they had one class.
    monkeypatch.setattr(brown, "KNOWN_WORDS", most)
    monkeypatch.setattr(brown, "UNIT_SHARE", 0.02)
    rows = [(i, " ".join(f"a {random.Random(i).choice(['p', f'p{i % 40}zz'])} c b {random.Random(-i).choice(['q', f'q{i % 40}zz'])} d" for _ in range(3))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model, counts, rare = brown.fit(docs, Staging(spark, "t"), n_classes=8, rounds=3)
    found = Counter(w for r in rows for w in plain_tokens(r[1]))
    assert counts.count() == len(found)
    class_of = class_finder(model, rare)
    p, q = ({class_of(w) for w in found if w[:1] == kind and w.endswith(b"zz")} for kind in (b"p", b"q"))
    assert not p & q and sum(model.totals) == sum(found.values())


def test_contexts_are_plain_counts(spark, monkeypatch):
    monkeypatch.setattr(brown, "BUCKETS", 3)
    monkeypatch.setattr(brown, "HELD", 40)
    texts = [words(30, k, 6) for k in range(20)] + ["", "never"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    names = sorted({w for t in texts for w in plain_tokens(t)} - {b"never"})
    hashes = np.array([number(w) for w in names], np.uint64)
    classes, families = np.arange(len(names)) % 4, np.arange(brown.FAMILIES) % 4
    known = brown.Known.of(hashes)
    class_of = {w: int(c) for w, c in zip(names, classes, strict=True)} | {b"never": family(b"never") % 4}
    want, pairs = Counter(), np.zeros(16)
    for t in texts:
        own = [b"\n", *plain_tokens(t)]
        for a, b in zip(own, own[1:], strict=False):
            pairs[class_of[a] * 4 + class_of[b]] += 1
            if a in names:
                want[names.index(a), class_of[b]] += 1
            if b in names:
                want[names.index(b), 4 + class_of[a]] += 1
    seen = brown.contexts(brown.token_stream(docs, known), known, classes, families, 4, 5).cache()
    got = Counter()
    for row in seen.where("bucket >= 0").collect():
        for w, at, n in zip(*brown._places(row["bucket"], row["keys"], 8, 3), np.frombuffer(row["counts"], np.int64), strict=True):
            got[int(w), int(at)] += int(n)
    assert got == want
    assert brown._array(seen, brown.ALL_PAIRS, 16).tolist() == pairs.tolist()
    seen.unpersist()

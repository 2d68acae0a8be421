"""Classes and links against all pairs."""

import random

import numpy as np
from pyspark.sql import functions as F

from feedloom.llm import jaccard as j
from feedloom.llm.components import components
from feedloom.session import Staging


def plain_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def plain(rows):
    """class_id and n_links by doc, from all pairs."""
    sets = [frozenset(plain_set(t)) for _, t in rows]
    distinct = list(dict.fromkeys(sets))
    parent = {s: s for s in distinct}

    def find(s):
        while parent[s] is not s:
            s = parent[s]
        return s

    links = dict.fromkeys(distinct, 0)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if len(a & b) >= 0.8 * len(a | b) and a and b:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    least = {}
    for (doc, _), s in zip(rows, sets, strict=True):
        root = find(s)
        least[root] = min(least.get(root, doc), doc)
    return {doc: (least[find(s)], links[s], sets.count(s)) for (doc, _), s in zip(rows, sets, strict=True)}


def got(df):
    return {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in df.collect()}


def text(n, seed):
    random.seed(seed)
    return " ".join(random.choices([f"w{i}" for i in range(3000)], k=n))


def test_similar_is_exact():
    random.seed(3)
    sets = [np.unique(np.array(random.choices(range(60 + 20000 * (k % 2)), k=random.randint(0, 50 + 9000 * (k % 2))), np.uint64)) for k in range(40)]
    found = j.similar(sets, 0.3)
    for i, a in enumerate(sets):
        for k, b in enumerate(sets):
            shared, whole = len(set(a) & set(b)), len(set(a) | set(b))
            assert found[i, k] == (shared >= 0.3 * whole - 1e-6)


def test_runs_reach_the_target():
    assert j.runs_for(0.8, 0.9995) >= 5 and j.runs_for(0.8, 0.9) < j.runs_for(0.8, 0.9999)


def test_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(j, "SMALL", 6)
    monkeypatch.setattr(j, "BLOCK", 16)
    passage = text(60, 999)
    rows = [(k, text(random.Random(k).randint(40, 160), k)) for k in range(150)]
    rows += [(200 + k, text(80, 5000 + k) + " " + passage) for k in range(60)]  # a passage in common
    base = text(150, 77).split()
    for k in range(70):  # a large group of near copies
        words = list(base)
        for at in random.Random(k).sample(range(150), k % 5):
            words[at] = f"x{k}"
        rows.append((400 + k, " ".join(words)))
    rows += [(600 + k, rows[k][1].upper()) for k in range(30)] + [(700, None), (701, ""), (702, " "), (703, "two words"), (704, "Two  words"), (705, "y " * 5000)]
    docs = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id long, text string, set_id string, n int")
    found, want = got(j.near_duplicates(docs)), plain(rows)
    assert found == want
    assert sum(n > 10 for _, n, _ in want.values()) > 30


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = plain([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    found = got(j.near_duplicates(docs))
    assert len({c for c, _, _ in want.values()}) < len(want)
    assert sum(found[d] == w for d, w in want.items()) / len(want) > 0.998


def test_edges(spark):
    schema = "doc_id long, text string"
    assert j.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (None, "only one without a name here")]
    found = sorted((r.doc_id or 0, r.class_id, r.n_copies) for r in j.near_duplicates(spark.createDataFrame(rows, schema)).collect() if r.class_id)
    assert found == [(0, 3, 3), (3, 3, 3), (3, 3, 3)]


def test_components(spark):
    random.seed(8)
    path = [(i, i + 1) for i in range(60)]
    star = [(100, 100 + i) for i in range(1, 50)]
    mixed = [(random.randint(200, 400), random.randint(200, 400)) for _ in range(110)]
    edges = path + star + mixed
    random.shuffle(edges)
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    table = spark.createDataFrame(edges, "u long, v long")
    found = {r.u: r.v for r in components(table, Staging(spark, "t")).collect()}
    assert {x: find(x) for x in parent if find(x) != x} == found
    assert components(table.where(F.lit(False)), Staging(spark, "t")).count() == 0


def test_columns_of_any_name_stay(spark):
    rows = [("keep1", 1.5, "a b c d e f", 1), ("keep2", 2.5, "a b c d e f", 2), ("keep3", 3.5, None, 3)]
    docs = spark.createDataFrame(rows, "__id string, __tie double, text string, doc_id int")
    found = j.drop_near_duplicates(docs)
    assert found.schema == docs.schema
    assert sorted(map(tuple, found.collect()), key=str) == [rows[0], rows[2]]

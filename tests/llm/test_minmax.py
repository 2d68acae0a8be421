"""Classes against all pairs; the estimate from least and greatest values against the true similarity."""

import random

import numpy as np
import pyarrow as pa

from feedloom.llm import minmax as m


def small(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain_set(text):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    words = [w for w in small(text).split(" ") if w]
    return frozenset(tuple(words[i : i + 4]) for i in range(len(words) - 3)) if len(words) >= 4 else frozenset([tuple(words)]) - {()}


def plain(rows):
    """(n_shingles, component_id, kept) by doc."""
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for k in range(i):
            if a and sets[k] and 100 * len(a & sets[k]) >= 80 * len(a | sets[k]):
                root[find(i)] = find(k)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return {doc: (len(s), least[find(i)], doc == least[find(i)]) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def text(n, seed):
    return " ".join(random.Random(seed).choices([f"w{i}" for i in range(3000)], k=n))


def test_values_estimate_without_bias_and_vary_less():
    rng = np.random.default_rng(5)
    both, lows = [], []
    for _ in range(400):
        union = rng.integers(0, 1 << 63, 20).astype(np.uint64)
        a, b = m.min_max(union[:18]), m.min_max(union[2:])
        assert len(a) == 2 * m.PERMUTATIONS
        both.append((a == b).mean())
        lows.append((a == b)[: m.PERMUTATIONS].mean())
        assert abs(m.estimate(m.marks(a), m.marks(b)) - both[-1]) < 0.06
    assert abs(np.mean(both) - 0.8) < 0.02 and abs(np.mean(lows) - 0.8) < 0.02
    assert np.var(both) < 0.55 * np.var(lows)


def test_bands_meet():
    rng = np.random.default_rng(6)
    met = 0
    for _ in range(500):
        union = rng.integers(0, 1 << 63, 100).astype(np.uint64)
        a, b = m.bands(m.min_max(union[:90])), m.bands(m.min_max(union[10:]))
        assert len(set(a.tolist())) == 2 * m.PERMUTATIONS // m.ROWS
        met += bool(set(a.tolist()) & set(b.tolist()))
    assert met >= 499


def test_long_sets_in_parts():
    values = np.random.default_rng(7).integers(0, 1 << 63, 3 * m._PART + 5).astype(np.uint64)
    whole = np.array([[v * odd % (1 << 64) for v in values.tolist()] for odd in m._ODD.tolist()], object)
    assert m.min_max(values).tolist() == whole.min(axis=1).tolist() + whole.max(axis=1).tolist()


def test_sets():
    batch = ["A b c d e", "a B\tc\nd e ", "a b", "", "x y z w"]
    sets = m.word_sets(pa.array(batch))
    assert [len(s) for s in sets] == [2, 2, 1, 0, 1] and (sets[0] == sets[1]).all()


def test_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(m, "BLOCK_SETS", 16)
    monkeypatch.setattr(m, "BLOCK_WORDS", 4000)
    passage = text(70, 999)
    rows = [(1000 - k, text(random.Random(k).randint(3, 160), k)) for k in range(150)]
    rows += [(2000 + k, text(40, 5000 + k) + " " + passage) for k in range(80)]  # most of a text in common, no links
    rows += [(2100 + k, text(19 + k % 4, 6000 + k) + " " + passage) for k in range(40)]  # near the threshold
    words = text(120, 77).split()
    for k in range(90):  # copies of copies: a chain whose ends are unlike
        words[random.Random(k).randrange(120)] = f"x{k}"
        rows.append((3000 + k, " ".join(words)))
    base = text(150, 78).split()
    for k in range(120):  # a large group
        edited = list(base)
        for at in random.Random(k).sample(range(150), k % 4):
            edited[at] = f"y{k}"
        rows.append((4000 + k, " ".join(edited)))
    rows += [(5000 + k, rows[k][1].upper()) for k in range(30)]
    rows += [(6000, None), (6001, ""), (6002, " \n"), (6003, "two words"), (6004, "Two  words"), (6005, "É b"), (6006, "é b"), (6007, "y " * 9000), (6008, "y y y y")]
    docs = spark.createDataFrame([(*r, "z", 1, "q") for r in rows], "doc_id long, text string, set_id string, n int, leaf string")
    found, want = got(m.near_duplicate_classes(docs)), plain(rows)
    assert found == want
    assert len({c for _, c, _ in want.values()}) < len(want) - 200


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = plain([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert got(m.near_duplicate_classes(docs)) == want


def test_odd_rows(spark):
    schema = "doc_id long, text string"
    assert m.near_duplicate_classes(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (None, "only one without a name here"), (None, ""), (9, "a b c d e f")]
    found = sorted(map(str, m.near_duplicate_classes(spark.createDataFrame(rows, schema)).collect()))
    assert found == sorted(
        f"Row(doc_id={d}, n_shingles={n}, component_id={c}, kept={k})"
        for d, n, c, k in [(None, 3, 3, False), (3, 3, 3, True), (3, 3, 3, True), (None, 3, None, True), (None, 0, None, True), (9, 3, 3, False)]
    )
    texts_as_ids = spark.createDataFrame([("b", "a b c d e"), ("a", "a b c d e")], "name string, body string")
    assert {r.component_id for r in m.near_duplicate_classes(texts_as_ids, id_col="name", text_col="body").collect()} == {"a"}

"""Search against a plain edit distance at every place of every text."""

import random

import numpy as np
import pytest

from feedloom.llm import decontamination as d


def least_edits(window, text):
    """The least edit distance of the window to any part of the text."""
    row = np.arange(len(window) + 1)
    best = row[-1]
    for sign in text:
        new = [0]
        for i, w in enumerate(window):
            new.append(min(row[i] + (w != sign), row[i + 1] + 1, new[i] + 1))
        row = np.array(new)
        best = min(best, row[-1])
    return best


def words(n, seed):
    random.seed(seed)
    return " ".join("".join(random.choices("abcdefghij", k=random.randint(1, 8))) for _ in range(n))


def changed(text, edits, seed):
    random.seed(seed)
    letters = list(text)
    for _ in range(edits):
        at = random.randrange(len(letters))
        kind = random.randrange(3)
        if kind == 0:
            letters[at] = "z"
        elif kind == 1:
            del letters[at]
        else:
            letters.insert(at, "z")
    return "".join(letters)


@pytest.mark.parametrize("size", [10, 19, 25, 50, 99, 100])
def test_lemma_leaves_a_gram(size):
    assert d.needed(size, d.budget(size)) >= 1


def test_every_place_of_every_text():
    item = words(40, 1)
    pieces = d.windows(d.normal(item))
    assert len(pieces) > 1 and all(len(p) == d.WINDOW for p in pieces)
    block = d.block_of([(7, p) for p in pieces] + [(8, "tiny words here")])
    batch = [words(10, s) + " " + changed(item, s % 14, s) + " " + words(8, s + 99) for s in range(40)] + ["", "x", item, "tiny words", "a tiny words here."]
    found = {(t, w): e for t, w, e, _, _ in d.search(batch, block, block.seen())}
    want = {}
    for t, text in enumerate(batch):
        for w, piece in enumerate([*pieces, "tiny words here"]):
            if (e := least_edits(piece, d.normal(text))) <= d.budget(len(piece)):
                want[t, w] = e
    assert found == want and len(want) > 50


def test_places():
    text = "  Ein, «Haus»  İs_x! "
    cleaned, place = d.normal(text), d.places(text)
    assert [text[i].lower()[0] for i, c in zip(place, cleaned, strict=False) if c.isalnum() and c != "̇"] == [c for c in cleaned if c.isalnum()]


SCHEMA = "doc_id long, text string, item_id string, windows int"


@pytest.mark.parametrize("block_chars", [d.BLOCK_CHARS, 60])
def test_rows(spark, block_chars):
    item, other = words(40, 5), words(30, 6)
    text = "Before. " + item.upper().replace(" ", ", ", 3) + " After " + words(30, 8)
    rows = [(1, text), (1, text), (2, words(300, 7)), (3, None), (4, ""), (None, other), (5, words(20_000, 9) + " " + item + " " + words(9, 3))]
    docs = spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA)
    benchmark = spark.createDataFrame([(1, item, 1), (2, other, 1), (3, None, 1), (4, "", 1), (5, "and", 1)], "item_id long, text string, doc_id int")
    found = {(r.doc_id, r.item_id): r for r in d.find_leaks(docs, benchmark, block_chars=block_chars).collect()}
    assert set(found) == {(1, 1), (None, 2), (5, 1)}
    one = found[1, 1]
    assert one.edits == 0 and text[one.start : one.end].lower().startswith(item[:2]) and abs(one.start - 8) <= 1
    kept = d.drop_leaks(docs, benchmark, block_chars=block_chars)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]
    assert d.find_leaks(docs.limit(0), benchmark).count() == 0
    assert d.find_leaks(docs, benchmark.limit(0)).count() == 0 and d.drop_leaks(docs, benchmark.limit(0)).count() == len(rows)


def items_block(items):
    found = [(i, *piece) for i, item in enumerate(items) for piece in d.pieces(d.normal(item))]
    return d.block_of([(i, w) for i, w, _ in found], [e for _, _, e in found])


@pytest.mark.parametrize("size", [50, 60, 75, 92, 100, 110, 120, 130, 140])
def test_copied_runs_at_every_offset(size):
    item = d.normal(words(60, 11))
    block = items_block([item])
    batch = [f"zz {item[at : at + size]} zz" for at in range(len(item) - size + 1)]
    found = {t for t, _, _, _, _ in d.search(batch, block, block.seen())}
    # A space at either end of a run is one character less of it.
    assert found >= {t for t, at in enumerate(range(len(batch))) if len(item[at : at + size].strip()) >= d.RUN}


def test_runs_come_besides_windows():
    text = d.normal(words(60, 12))
    found = d.pieces(text)
    assert [w for w, _ in found[: len(d.windows(text))]] == d.windows(text)
    assert all(e == d.budget(len(w)) for w, e in found if len(w) == d.WINDOW)
    assert d.pieces("") == [] and d.pieces("ab c") == [("ab c", 0)]


def test_short_items_as_whole_words(spark):
    docs = spark.createDataFrame([(1, "It is 42, Ab-c!"), (2, "it is 421 abc"), (3, None), (4, "")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, "42"), (2, "AB c."), (3, "?"), (4, "ab")], "item_id long, text string")
    found = {(r.doc_id, r.item_id): (r.windows, r.edits, r.start, r.end) for r in d.find_leaks(docs, benchmark).collect()}
    assert found == {(1, 1): (1, 0, 6, 8), (1, 2): (1, 0, 10, 14), (1, 4): (1, 0, 10, 12)}
    assert sorted(r.doc_id for r in d.drop_leaks(docs, benchmark, short_items=True).collect()) == [2, 3, 4]


def test_short_items_are_reported_but_cost_nothing(spark):
    docs = spark.createDataFrame([(1, "yes it is 42"), (2, "no")], "doc_id long, text string")
    items = spark.createDataFrame([("a", "yes"), ("b", "42")], "item_id string, text string")
    assert {(r.doc_id, r.item_id) for r in d.find_leaks(docs, items).collect()} == {(1, "a"), (1, "b")}
    assert d.drop_leaks(docs, items).count() == 2
    assert [r.doc_id for r in d.drop_leaks(docs, items, short_items=True).collect()] == [2]

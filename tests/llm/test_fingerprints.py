"""Chunk boundaries and the next document against plain Python."""

import hashlib
import random

import numpy as np

from feedloom.llm import fingerprints as fp


def plain_hash(data, i):
    h = 0
    for b in data[max(0, i - 31) : i + 1]:
        h = (h * 2 + int(fp.GEAR[b])) % 2**32
    return h


def plain_ends(data):
    ends, start = [], 0
    while start < len(data):
        for end in range(start + 1, len(data) + 1):
            size, top = end - start, plain_hash(data, end - 1) >> 25
            if size == fp.MOST or end == len(data) or size >= fp.LEAST and (top == 0 or size > fp.NORMAL and top < 4):
                break
        ends.append(end)
        start = end
    return ends


def test_boundaries():
    random.seed(1)
    batch = [bytes(random.choices(b"abcdefgh \n", k=n)) for n in (0, 1, 31, 32, 33, 500, 3000)] + [b"a" * 2000, b""]
    assert fp.chunk_ends(batch) == [plain_ends(t) for t in batch]
    assert fp.chunk_ends([b""]) == [[]]


def test_shift_resistant():
    random.seed(2)
    text = "".join(random.choices("abcdefghij ", k=5000))
    a, b = fp.chunk_sets([text, "inserted at the start " + text])
    assert fp.containment(a, b) > 0.95
    assert fp.containment({}, {}) == 1 and fp.containment({}, a) == 0 and fp.containment(a, {}) == 0


def test_next_document(spark):
    random.seed(3)
    rows = [(i * 7 % 101, "".join(random.choices("äbc de", k=random.choice([0, 1, 40, 900])))) for i in range(101)]
    rows += [(500, None), (501, "x" * 30_000)]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, __range string").repartition(5)
    found = {r.doc_id: r for r in fp.fingerprints_of_edits(docs).collect()}
    assert len(found) == len(rows)
    ordered = sorted((i, t or "") for i, t in rows)
    for k, (i, text) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        own, other, after = fp.chunk_sets([text, changed, following])
        assert found[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert found[i].n_chars == len(text) and found[i].fingerprint == fp.written(own)
        assert found[i].edited_fingerprint == fp.written(other)
        assert found[i].near_edited == fp.containment(own, other) and found[i].near_next == fp.containment(own, after)


def test_edges(spark):
    schema = "doc_id long, text string"
    assert fp.fingerprints_of_edits(spark.createDataFrame([], schema)).count() == 0
    (one,) = fp.fingerprints_of_edits(spark.createDataFrame([(1, "a b")], schema)).collect()
    assert one.edited_sha256 == hashlib.sha256(b"a a").hexdigest()
    same = [(None, "n"), (None, "n"), (4, "t" * 300), (4, "t" * 300), (4, "u")]
    found = fp.fingerprints_of_edits(spark.createDataFrame(same, schema)).collect()
    assert sorted(str(r.doc_id) for r in found) == ["4", "4", "4", "None", "None"]
    docs = fp.fingerprint_documents(spark.createDataFrame(same, schema)).collect()
    assert len({r.fingerprint for r in docs}) == 3
    assert np.all(fp.gear_hashes(np.zeros(0, np.uint8)) == 0)

"""Fixed forms against the plain patterns; beliefs against sums over all labellings."""

import itertools
import random
import re
import time

import numpy as np

from feedloom.llm import pii


def plain(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"\D", "", m.group())
        if 16 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub(r"\D", "", m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def test_base_spans_are_the_patterns(spark, data):
    texts = [r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    random.seed(5)
    texts += ["".join(random.choices("a.@1-+ 0(", k=80)) for _ in range(3000)]
    texts += ["4111111111111111", "a@b@c.d@e.f", "@a.b", "256.1.1.1 001.2.3.4", "1.2.3.4.5.6.7.8", "٣.٣.٣.٣", "9" * 3000, "a" * 3000 + "@", "x@y.z" * 500]
    assert [pii.base_spans(t) for t in texts] == [plain(t) for t in texts]
    assert sum(map(len, map(plain, texts))) > 100


def mention(start, key, label, *features):
    return pii.Mention(start, start + 5, key, label, (*features, *[0.0] * (pii.N_FEATURES - len(features))))


def test_beliefs_on_a_tree_are_exact():
    random = np.random.default_rng(4)
    k = len(pii.LABELS)
    model = pii.SkipChain(random.normal(0, 1, (pii.N_FEATURES, k)), random.normal(0, 1, (k, k)), 2 * np.eye(k))
    found = [mention(0, "a", 0, 1, 0, 1), mention(20, "b", 0, 1, 1), mention(500, "a", 2, 1), mention(520, "c", 0, 0, 1)]
    chain, skip = pii.edges(found)
    assert chain == [(0, 1), (2, 3)] and skip == [(0, 2)]
    total = np.zeros((4, k))
    for labels in itertools.product(range(k), repeat=4):
        if labels[2] != 2:
            continue
        log = sum(np.array(m.features) @ model.unary[:, y] for m, y in zip(found, labels, strict=True) if not m.label)
        log += sum(model.chain[labels[i], labels[j]] for i, j in chain) + sum(model.skip[labels[i], labels[j]] for i, j in skip)
        for i, y in enumerate(labels):
            total[i, y] += np.exp(log)
    assert np.allclose(model.marginals(found), total / total.sum(1, keepdims=True), atol=5e-3)


FULL = "Call +1 (319) 555-5132 or write to ann.lee@mail.example.com. "


def test_distant_mentions_agree(spark, data):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    model = pii.fit_on(docs)
    filler = "of the and to in that " * 200
    text = FULL + filler + "Again 555-5132, or ann.lee (at) mail.example.com there. " + filler + "Not 555-9999."
    found = pii.added_spans(pii.mentions(text, pii.base_spans(text)), model)
    assert [(k, text[s:e]) for k, s, e in found] == [("phone", "555-5132"), ("email", "ann.lee (at) mail.example.com")]
    clean = "In 1999 and 2001-02 some 1,234,567 units, 12/05/2020, page 3(4), meet (at) noon: 7 of 9."
    assert pii.added_spans(pii.mentions(clean, pii.base_spans(clean)), model) == []


def test_rows(spark):
    rows = [(1, FULL, "x"), (1, FULL, "x"), (None, None, "y"), (3, "", "z"), (4, "1 " * 20_000 + "10.0.0.1", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    found = pii.find_pii(docs).collect()
    assert sorted((r.doc_id or 0, len(r.base)) for r in found) == [(0, 0), (1, 2), (1, 2), (3, 0), (4, 1)]
    cleaned = {r.doc_id: r for r in pii.redact(docs).collect()}
    assert cleaned[1].text == "Call [PHONE] or write to [EMAIL]. " and cleaned[1].spans == "x"
    assert cleaned[None].text is None and cleaned[4].text.endswith("[IP]")
    assert pii.find_pii(docs.limit(0)).count() == 0
    assert pii.redact_text("abcdef", [("ip", 1, 3), ("card", 2, 5)]) == "a[IP]f"


def seen(text):
    return [(text[m.start : m.end], pii.LABELS[m.label]) for m in pii.mentions(text, pii.base_spans(text))]


def test_mentions_are_whole():
    assert seen("9" * 26) == [("9" * 26, "none")]
    name = "n" * 100
    assert seen(f"{name} (at) host.org") == [(f"{name} (at) host.org", "none")]
    assert seen("ann (At) host (Dot) org") == [("ann (At) host (Dot) org", "none")]
    assert seen("ask bob@localhost now") == [("bob@localhost", "none")]
    assert seen("call 555-123-4567 10.0.0.1") == [("555-123-4567", "none"), ("10.0.0.1", "ip")]
    assert seen("10.0.0.1 555-123-4567") == [("10.0.0.1", "ip"), ("555-123-4567", "none")]
    assert seen("555-5132 555-9921") == [("555-5132", "none"), ("555-9921", "none")]
    assert seen("(319) 555 51 32") == [("(319) 555 51 32", "none")]
    assert seen("@ @@ (at) a@ 12 34") == []
    assert [t for t, _ in seen("1 " * 40)] == [("1 " * 19).strip(), ("1 " * 19).strip()]


def test_linked_by_their_own_digits():
    found = pii.mentions("555-5132 555-9921 and then 555-5132", [])
    assert pii.edges(found)[1] == [(0, 2)]


def test_long_texts_take_no_time():
    start = time.perf_counter()
    for text in ("x" * 300_000 + "(at", "a(at)" * 60_000, "1-" * 150_000, "1 " * 150_000, "a.b@" * 60_000, "x@y " * 60_000):
        pii.mentions(text, pii.base_spans(text))
    assert time.perf_counter() - start < 20

"""Each stage on its own input against a plain version, and the whole."""

import numpy as np

import corpus_pipeline
from feedloom.llm import decontamination, jaccard, packing, pii, quality

from .test_jaccard import plain

SF = "/root/testdata/sf0.01"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "pii", "packing"]
    outs = [{r.doc_id: r for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == columns
            outs.append({r.doc_id: r for r in docs.collect()})
            assert docs.count() == len(outs[-1])
    raw, good, distinct, clean, redacted = outs

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    wrong = sum((i in good) != bool(q) for i, q in labels.items())
    assert wrong / len(labels) < 0.02 and 0.8 < len(good) / len(raw) < 0.95

    classes = plain([(i, r.text) for i, r in good.items()])
    assert set(distinct) == {i for i, (least, _, _) in classes.items() if least == i}

    items = [decontamination.normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    whole = {i for i, r in distinct.items() if any(t in decontamination.normal(r.text) for t in items)}
    assert whole and not whole & set(clean) and len(distinct) - len(clean) <= len(whole) + 2

    assert set(redacted) == set(clean)
    touched = {i for i, r in clean.items() if pii.base_spans(r.text)}
    assert touched and all(redacted[i] == clean[i] for i in set(clean) - touched)
    assert not any(pii.base_spans(redacted[i].text) for i in touched)
    assert all(r.n_chars == len(r.text) for r in redacted.values())

    rows = docs.collect()
    encode = packing.word_encoder(packing.default_tokenizer())
    ids = {}
    for r in sorted(rows, key=lambda r: r.start):
        ids.setdefault(r.doc_id, []).extend(r.ids)
    (some, *_) = encode([redacted[i].text for i in sorted(redacted)][:1])
    assert ids[min(redacted)] == [*np.frombuffer(some, "<u4").tolist(), packing.END_ID]
    assert set(ids) == set(redacted)


def test_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, tie long, label int"
    rows = [(1, None, None, None, None, 1, 1), (1, None, None, None, None, 1, 1), (None, "", "en", None, 0, 1, 1), (2, "a b c d e f g", "en", "s", 13, 1, 1),
            (2, "a b c d e f g", "en", "s", 13, 1, 1), (3, "A b c d e f g", "en", "s", 13, 1, 1)]
    docs = spark.createDataFrame(rows, schema)
    assert quality.keep_good(docs, spark.createDataFrame([], "doc_id long, quality int")).count() == len(rows)
    kept = jaccard.drop_near_duplicates(docs).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [(0, ""), (2, "a b c d e f g")]
    assert jaccard.drop_near_duplicates(docs).columns == docs.columns
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0

"""Exact round trip: pieces give back each document's ids, in order, each id once."""

import random
import zlib

import numpy as np
import pytest

pytest.importorskip("tokenizers")

from feedloom.llm import packing  # noqa: E402


def plain_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    tokenizer.encode_special_tokens = True
    return [[*tokenizer.encode(text, add_special_tokens=False).ids, 2] for text in texts]


CASES = ["", None, " ", "a", "The  end.\nIt's 'twas we'll! ÀÉ Straße x́ é.", "ΑΣ. ΟΔΟΣ ΣΣ, İstanbul", "a\x1cb c\td", "<|endoftext|> x",
         "z" * 5000 + " " + "y!" * 2500, "word, " * 9000, "word, " * 9000, "12,345 (a) [b]! ***&&&", "I.́ x,́ Å ﬁne"]


def test_word_by_word_ids_are_the_tokenizers(data, spark):
    texts = [r.text for r in spark.read.parquet(f"{data}/documents.parquet").select("text").collect()]
    texts += [t or "" for t in CASES]
    random.seed(3)
    texts += ["".join(random.choice("aB é.!'s\ńΣ1 ") for _ in range(60)) for _ in range(200)]
    encode = packing.word_encoder(packing.default_tokenizer())
    assert [np.frombuffer(b, "<u4").tolist() + [2] for b in encode(texts)] == plain_ids(texts)


def test_long_words_are_not_kept():
    encode = packing.word_encoder(packing.default_tokenizer())
    encode([" ".join(f"{c * 90}!! short{c},, " for c in "abcdefgh")])
    (held,) = (c.cell_contents for c in encode.__closure__ if isinstance(c.cell_contents, packing._Recent))
    assert "shorta,," in held.new and all(len(w) <= packing.WORD_CHARS for w in held.new)


@pytest.mark.parametrize("total", [1, 2, 3, 4095, 4096, 4097, 12_345])
def test_lengths(total):
    lengths = packing.binary_lengths(total, 4096)
    assert sum(lengths) == total and all(n & (n - 1) == 0 and n <= 4096 for n in lengths)
    assert lengths == sorted(lengths, reverse=True)


def test_round_trip(spark):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(CASES)] + [(None, "no id", "x", 1)], "doc_id long, text string, sequence_id string, length int")
    rows = packing.pack_power_of_two(docs.repartition(3)).collect()
    want = dict(zip([*range(len(CASES)), None], plain_ids([*(t or "" for t in CASES), "no id"]), strict=True))
    for doc, ids in want.items():
        own = sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.start)
        assert [i for r in own for i in r.ids] == ids
        assert [r.start for r in own] == list(np.cumsum([0, *(r.length for r in own)])[:-1])
        assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.doc_tokens == len(ids) for r in own)
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
    by_id = [r.length for r in sorted(rows, key=lambda r: r.sequence_id)]
    assert by_id == sorted(by_id, reverse=True) and {r.offset for r in rows} == {0}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_power_of_two(docs).count() == 0


def test_workers_keep_words_only_while_their_tasks_encode():
    from feedloom.llm import common
    from feedloom.llm.packing import default_tokenizer, word_encoder

    path = default_tokenizer()
    first = common._begun(lambda: word_encoder(path))
    assert common._begun(lambda: word_encoder(path)) is first
    assert common._begun(lambda: None) is None
    assert not common._KEPT and common._begun(lambda: word_encoder(path)) is not first

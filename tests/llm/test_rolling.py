"""Words and the hashes of their runs against plain string handling."""

import random
import re

import pyarrow as pa

from feedloom.llm.rolling import Hasher, Words, byte_kinds

ALPHABET = "aAbB zé\t\n.,;\r\x0b\x0c🙂\x01"


def small(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def test_words_pieces_and_runs():
    random.seed(4)
    batch = ["".join(random.choices(ALPHABET, k=random.randint(0, 40))) for _ in range(300)] + ["", "", " ", "a" * 3000]
    words = Words(pa.array(batch).slice(1), byte_kinds(b" \t", b".,;\n\x0b\x0c\r"))
    want = [
        (t, p, small(w))
        for t, text in enumerate(batch[1:])
        for p, piece in enumerate(re.split("[.,;\n\x0b\x0c\r]", text))
        for w in re.findall("[^ \t]+", piece)
    ]
    spelled = [small(bytes(words.data[s:e]).decode()) for s, e in zip(words.start, words.end, strict=True)]
    assert [(t, w) for t, _, w in want] == list(zip(words.text.tolist(), spelled, strict=True))
    for i in range(1, len(want)):
        assert (want[i][:2] == want[i - 1][:2]) == (words.piece[i] == words.piece[i - 1])
    hasher = Hasher()
    hashes = hasher.of_words(words)
    by_run = {}
    for size, runs in hasher.of_runs(hashes, [1, 2, 3, 5]).items():
        assert len(runs) == len(want) - size + 1
        for i, run in enumerate(runs.tolist()):
            by_run.setdefault(run, set()).add(tuple(spelled[i : i + size]))
    assert all(len(texts) == 1 for texts in by_run.values())
    assert len(by_run) == len({t for texts in by_run.values() for t in texts})


def test_nothing():
    for batch in ([], [""], ["", " "]):
        words = Words(pa.array(batch, pa.string()), byte_kinds(b" "))
        assert len(words) == 0 and Hasher().of_runs(Hasher().of_words(words), [1, 4])[4].size == 0 and words.first.tolist() == [0] * (len(batch) + 1)

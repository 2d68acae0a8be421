"""Spelling variants: Gram matrices of letter counts over blocks of words whose lengths are equal or adjacent."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from feedloom.session import Staging

from .common import small_batches, texts

LEAST_LENGTH, LEAST_COUNT = 5, 3
# One occurrence of a word in so many of its documents is read with a letter missing.
MISREAD = 97
# A word that is this many times as frequent as a near one is that one's form.
RATIO = 2
# Words that a task multiplies with as many others at a time.
BLOCK = 512
# Distinct words a task counts before it hands them on.
HELD_WORDS = 200_000

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_SMALL = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
# Columns of the letter counts: a-z, then U+00C0 to U+00FF.
_COLUMN = np.full(256, -1)
_COLUMN[97:123] = np.arange(26)
_COLUMN[192:256] = 26 + np.arange(64)
_LETTERS = 26 + 64


def occurrences(doc_id: str, text: str, least_length: int = LEAST_LENGTH) -> Iterator[tuple[str, int]]:
    """The text's words and how often each is there: runs of letters, A-Z made small, misread ones with a letter less."""
    runs: Counter[str] = Counter()
    for run, times in Counter(_RUN.findall(text)).items():
        runs[run.lower() if run.isascii() else run.translate(_SMALL)] += times
    prefix = zlib.crc32(f"{doc_id}:".encode())
    for run, times in runs.items():
        chance = zlib.crc32(run.encode(), prefix)
        if not chance % MISREAD:
            at = chance % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= least_length:
            yield run, times


def word_counts(docs: DataFrame, *, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word and n, of words with enough letters and occurrences. Tasks count what they read before it moves."""
    source = texts(docs).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text")
    small_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]):
        held: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for word, times in occurrences(doc_id, text, least_length):
                    held[word] += times
                if len(held) > HELD_WORDS:
                    yield _counts(held)
                    held.clear()
        yield _counts(held)

    counted = source.mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _counts(held: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])


def letter_counts(words: list[str]) -> np.ndarray:
    """A row for each word: how often it has each letter."""
    sizes = [len(w) for w in words]
    letters = _COLUMN[np.frombuffer("".join(words).encode("latin-1"), np.uint8)]
    out = np.zeros((len(words), _LETTERS), np.float32)
    np.add.at(out, (np.repeat(np.arange(len(words)), sizes), letters), 1)
    return out


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Between all rows of two blocks, from their product; whole numbers, exact in single precision."""
    return (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point leads from one word to the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))  # noqa: B905
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


class _Pending:
    """Rows of consecutive groups, put off until they make a block that is worth a product."""

    def __init__(self):
        self.group: list[int] = []
        self.rows: list[tuple] = []
        self.last, self.count = None, 0

    def add(self, key: tuple, row: tuple) -> None:
        if key != self.last:
            self.last, self.count = key, self.count + 1
        self.group.append(self.count)
        self.rows.append((*key, *row))

    def near(self) -> Iterator[tuple[int, int]]:
        """The near pairs of the block, by place.

        Of a group, only pairs with a word of its own length count: two longer ones meet in the next
        length's groups. Two words that have the first part in common as well as the last meet by the first.
        """
        base, side, _, first, second, own, words, _ = zip(*self.rows, strict=True)
        held = letter_counts(words)
        good = squared_distances(held, held) <= 2
        group = np.array(self.group)
        good &= group[:, None] == group[None, :]
        shorter = np.array([len(w) for w in words]) == np.array(base)
        good &= shorter[:, None] | shorter[None, :]
        block, within = np.array(own), np.array(first) == np.array(second)
        good &= within[:, None] | (block[:, None] != block[None, :])
        good &= np.triu(np.ones(good.shape, bool), 1)
        for i, j in np.argwhere(good).tolist():
            a, b, part = words[i], words[j], base[i] // 2
            if not (side[i] and a[:part] == b[:part]) and one_edit(a, b):
                yield i, j

    def take(self) -> list[tuple]:
        """word, n_near, form and its n of the block's words with a near one; the block is done with."""
        found: dict[int, list] = {}
        for pair in self.near() if self.rows else ():
            for i, j in (pair, pair[::-1]):
                place = (-self.rows[j][7], self.rows[j][6])
                one = found.setdefault(i, [0, place])
                one[0] += 1
                one[1] = min(one[1], place)
        out = [(self.rows[i][6], count, word, -n) for i, (count, (n, word)) in found.items()]
        self.__init__()
        return out


def _neighbours(words: DataFrame, least_length: int) -> DataFrame:
    """word, n_near, form, form_n of the words that have a near one, form being the near word of largest n.

    Words of lengths L and L or L + 1 that are one edit apart have the first L // 2 code points in
    common or the last L - L // 2. Each word is dealt to the groups of both parts for its own length
    and the next shorter one, so that a group's blocks of letter counts stay small.
    """
    size = F.length("word")

    def part(base, side: int):
        half = F.floor(base / 2)
        text = F.substring("word", F.lit(1), half) if side == 0 else F.substring("word", size - base + half + 1, base - half)
        return F.struct(base.cast("int").alias("base"), F.lit(side).alias("side"), text.alias("part"))

    places = F.array(*(part(size - shorter, side) for shorter in (0, 1) for side in (0, 1)))
    dealt = words.select("word", "n", F.explode(F.filter(places, lambda p: p.base >= least_length)).alias("at")).select("at.*", "word", "n")
    keys = ["base", "side", "part"]
    sizes = dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sizes = sizes.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")).drop("size")
    rows = (
        dealt.join(sizes, keys)
        .withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(*keys, F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "word", "n")
    )
    schema = "word string, n_near long, form string, form_n long"
    fields = to_arrow_schema(StructType.fromDDL(schema))
    small_batches(words.sparkSession)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(fields)], schema=fields)

    def run(batches: Iterable[pa.RecordBatch]):
        pending = _Pending()
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if len(pending.rows) >= BLOCK and row[:5] != pending.last:
                    yield batch_of(pending.take())
                pending.add(row[:5], row[5:])
        yield batch_of(pending.take())

    order = [*keys, "a", "b"]
    found = rows.repartition(*order).sortWithinPartitions(*order).mapInArrow(run, schema)
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form"))).alias("best"))
    return best.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def _roots(forms: DataFrame, staging: Staging) -> DataFrame:
    """word and the end of its chain, for words with a form. Chains are halved each round; they are short, as n doubles."""
    ends, k = staging.write(forms.select("word", F.col("form").alias("root")), "roots-0"), 0
    while True:
        k += 1
        onward = ends.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = staging.write(ends.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), f"roots-{k}")
        ends = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return ends


def variant_groups(
    docs: DataFrame, *, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """word, form, root, n, n_near and form_n for every word of the texts with ``least_length`` letters and ``least_count`` occurrences.

    Words are the maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z made small; in one of 97 pairs of
    document and word (by crc32) the word is read with a letter missing, in all of the document. Two
    words are near if one inserted, deleted or replaced code point makes one the other. ``form`` is the
    near word of largest n (of equals the first in code-point order) if it has ``ratio`` times the
    word's n, ``root`` the end of the chain of forms. A null or empty text has no words, a null id is
    read as an empty one, repeated rows count as often as they are there; an empty table gives an empty one.
    Texts are read whole; other columns are not read.

    Letter counts of near words have a squared distance of at most two: blocks of words of equal or
    adjacent lengths are multiplied as matrices, and only pairs within that distance are compared by
    letters. All pairs that can be near share a group, so none is lost.
    """
    staging = Staging(docs.sparkSession, "spelling")
    words = staging.write(word_counts(texts(docs, id_col, text_col), least_length=least_length, least_count=least_count), "words")
    near = words.join(_neighbours(words, least_length), "word", "left")
    enough = F.col("form_n") >= ratio * F.col("n")
    formed = staging.write(
        near.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("form")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n")
        ),
        "forms",
    )
    ends = _roots(formed.where("form IS NOT NULL"), staging)
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

"""Class-based language model: exchange clustering, class transitions and word emissions."""

from __future__ import annotations

from collections.abc import Iterable
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.session import Staging

from .common import small_batches, texts
from .rolling import Hasher, byte_kinds, mixed
from .rolling import Words as Split

CLASSES, ROUNDS = 64, 4
# Every training word has a class of its own choice. The most frequent ones, this many at most, are
# known to every task and choose again in each round: those with at least UNIT_SHARE of all tokens, at most
# 20,000, one after the other, the others, in tasks, all at once. Rarer words choose once, when the
# classes of those are settled. Words unknown to the training texts have the class of a family that
# shares their last two bytes.
KNOWN_WORDS, UNIT_SHARE, FAMILIES = 1_000_000, 5e-5, 128
# Weight, in tokens, of the classes' own shares in each transition.
TRANSITION_PRIOR = 20.0
# Groups of known words whose contexts are summed up together.
BUCKETS = 256
# Words weighed at a time, counts up to which they are weighed by products, and entries a task keeps before it sums them up.
PART, SMALL, HELD = 4096, 6, 4_000_000
# Rows of numbers in a batch.
NUMBER_ROWS = 65_536

_SPACES = byte_kinds(b" \t\n\v\f\r")
_HASHER = Hasher(0xA0761D6478BD642F)
_U = np.uint64
# The word that stands for a text's end, and before its first word.
END = _U(0xE7037ED1A0B428DB)
# Families by the last byte and the one before it, A-Z as small letters.
_SMALL = np.arange(256)
_SMALL[65:91] += 32
_FAMILY = mixed(np.arange(1 << 16, dtype=_U)) % _U(FAMILIES)


def tokens(batch: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts in turn, each text with its end after it, as hashes, and the text's number.

    Words stand between ASCII white space, A to Z in lower case. A hash has the word's family in its lowest
    bits and 57 bits of its own above. Two of a billion distinct words share one with a chance of one in thirty;
    they would count as one.
    """
    words = Split(batch, _SPACES)
    n = len(batch)
    size = len(words) + n
    place = np.arange(len(words)) + words.text
    ends = words.first[1:] + np.arange(n)
    last = _SMALL[words.data[words.end - 1]]
    before = np.where(words.end - words.start > 1, _SMALL[words.data[words.end - 2]], 0) if len(words) else last
    hashes, owner = np.empty(size, _U), np.empty(size, np.int64)
    hashes[place] = _HASHER.of_words(words) & ~_U(FAMILIES - 1) | _FAMILY[last * 256 + before]
    hashes[ends] = END
    owner[place], owner[ends] = words.text, np.arange(n)
    return hashes, owner


def family_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes & _U(FAMILIES - 1)).astype(np.int64)


def word_hash(word: bytes) -> int:
    return int(tokens(pa.array([word.decode()]))[0][0])


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and their sums."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order], first)


def _tally(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of the parts, in order, and how often each is there. The list is emptied first."""
    values = np.concatenate(parts)
    parts.clear()
    values.sort()
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    return values[first], np.diff(np.append(first, len(values)))


def word_counts(docs: DataFrame) -> DataFrame:
    """h (a word's hash) and n over all texts."""
    small_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]):
        held: list[np.ndarray] = []

        def rows():
            h, n = _tally(held)
            return pa.RecordBatch.from_pydict({"h": h.astype(np.int64), "n": n})

        for batch in batches:
            held.append(tokens(batch.column(0))[0])
            if sum(map(len, held)) > HELD:
                yield rows()
        if held:
            yield rows()

    return docs.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def number_batches(spark: SparkSession) -> None:
    """Larger batches, for tables of numbers only."""
    small_batches(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(NUMBER_ROWS))


@contextmanager
def no_old_shuffles(spark: SparkSession):
    """Within, the shuffle files of a written table go when it is written."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@dataclass(frozen=True)
class Known:
    """The words that every task knows: hashes in order, the rank of each, and where those with the same leading bits begin."""

    hashes: np.ndarray
    ranks: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, hashes: np.ndarray) -> Known:
        """From the words' hashes by rank."""
        order = np.argsort(hashes)
        bits = max(len(hashes).bit_length(), 1)
        starts = np.searchsorted(hashes[order] >> _U(64 - bits), np.arange((1 << bits) + 1, dtype=_U))
        return cls(hashes[order], order.astype(np.int32), starts.astype(np.int32))

    def rank(self, hashes: np.ndarray) -> np.ndarray:
        """The rank of each word, -1 for unknown ones."""
        out = np.full(len(hashes), -1, np.int32)
        if not len(self.hashes):
            return out
        lead = hashes >> _U(64 - int(len(self.starts) - 1).bit_length() + 1)
        at, end, left = self.starts[lead], self.starts[lead + _U(1)], np.arange(len(hashes))
        while len(left):
            within = at < end
            left, at, end = left[within], at[within], end[within]
            same = self.hashes[at] == hashes[left]
            out[left[same]] = self.ranks[at[same]]
            left, at, end = left[~same], at[~same] + 1, end[~same]
        return out


def token_stream(docs: DataFrame, known: Known) -> DataFrame:
    """The texts as numbers, some hundred texts in a row: ranks of the words, -1 for rare ones, and the rare ones' hashes."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(known)

    def run(batches: Iterable[pa.RecordBatch]):
        table = shared.value
        for batch in batches:
            hashes, _ = tokens(batch.column(0))
            rank = table.rank(hashes)
            yield pa.RecordBatch.from_pydict({"ranks": [_blob(rank, np.int32)], "rare": [_blob(hashes[rank < 0], np.uint64)]})

    return docs.select("text").mapInArrow(run, "ranks binary, rare binary")


def _tokens_of(ranks: bytes, rare: bytes, classes: np.ndarray, families: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranks, classes and (of rare words only) hashes of a row of ``token_stream``, an end before all."""
    rank, rare = np.frombuffer(ranks, np.int32), np.frombuffer(rare, np.uint64)
    hashes = np.zeros(len(rank), _U)
    unknown = rank < 0
    hashes[unknown] = rare
    # A rank of -1 has the last place of the table, which is overwritten.
    cls = np.append(classes, 0)[rank]
    cls[unknown] = families[family_of(rare)]
    return rank, cls, hashes


def _blob(x: np.ndarray, kind: type) -> bytes:
    return x.astype(kind).tobytes()


_CONTEXTS = "bucket int, keys binary, counts binary"
# Buckets of other things than contexts: class pairs over all words, those of known words only, repeats of exchanged words.
ALL_PAIRS, KNOWN_PAIRS, REPEATS = -1, -2, -3


@dataclass(frozen=True)
class Start:
    """The end that goes before the first text of a row: its rank (-1 if it is rare), its class."""

    rank: int
    cls: int


def _start(known: Known, classes: np.ndarray, families: np.ndarray) -> Start:
    rank = int(known.rank(np.array([END]))[0])
    return Start(rank, int(classes[rank]) if rank >= 0 else int(families[family_of(np.array([END]))[0]]))


def contexts(stream: DataFrame, known: Known, classes: np.ndarray, families: np.ndarray, n_classes: int, n_heads: int) -> DataFrame:
    """How often each class follows a known word (at its number) or goes before it (n_classes more), by buckets of words.

    A row holds the sums of one bucket, as arrays: keys are (rank // BUCKETS) * 2 * n_classes + place. Few
    long rows move instead of one for each count, and there are as many buckets whatever the input.
    """
    spark = stream.sparkSession
    small_batches(spark)
    shared, slots, wide = spark.sparkContext.broadcast((classes, families)), 2 * n_classes, 1 << 40
    start = _start(known, classes, families)

    def row(bucket: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"bucket": pa.array([bucket], pa.int32()), "keys": [_blob(keys, np.uint32)], "counts": [_blob(counts, np.int64)]})

    def count(batches: Iterable[pa.RecordBatch]):
        classes, families = shared.value
        held, pairs, twice = [], np.zeros((2, n_classes * n_classes), np.int64), np.zeros(n_heads, np.int64)

        def out():
            keys, counts = _tally(held)
            cuts = np.searchsorted(keys, np.arange(BUCKETS + 1) * wide).tolist()
            for bucket, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                if a < b:
                    yield row(bucket, keys[a:b] - bucket * wide, counts[a:b])

        for batch in batches:
            for ranks, rare in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rank, cls, _ = _tokens_of(ranks, rare, classes, families)
                first, before = np.concatenate([[start.rank], rank[:-1]]).astype(np.int64), np.concatenate([[start.cls], cls[:-1]])
                second = rank.astype(np.int64)
                both = before * n_classes + cls
                inside = (first >= 0) & (second >= 0)
                pairs[0] += np.bincount(both, minlength=n_classes * n_classes)
                pairs[1] += np.bincount(both[inside], minlength=n_classes * n_classes)
                same = first[(first == second) & inside & (first < n_heads)]
                twice += np.bincount(same, minlength=n_heads)
                for word, place in ((first, cls), (second, before + n_classes)):
                    own = word >= 0
                    word = word[own]
                    held.append(word % BUCKETS * wide + word // BUCKETS * slots + place[own])
                if sum(map(len, held)) > HELD:
                    yield from out()
        if held:
            yield from out()
        for bucket, values in ((ALL_PAIRS, pairs[0]), (KNOWN_PAIRS, pairs[1]), (REPEATS, twice)):
            at = np.flatnonzero(values)
            yield row(bucket, at, values[at])

    def merge(batches: Iterable[pa.RecordBatch]):
        bucket, held = None, []

        def summed():
            return _summed(*(np.concatenate(c) for c in zip(*held, strict=True)))

        for batch in batches:
            for own, keys, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != bucket:
                    if held:
                        yield row(bucket, *summed())
                    bucket, held = own, []
                held.append((np.frombuffer(keys, np.uint32), np.frombuffer(counts, np.int64)))
                if sum(len(k) for k, _ in held) > HELD:
                    held = [summed()]
        if held:
            yield row(bucket, *summed())

    found = stream.mapInArrow(count, _CONTEXTS).repartition("bucket").sortWithinPartitions("bucket")
    return found.mapInArrow(merge, _CONTEXTS)


def _array(seen: DataFrame, bucket: int, size: int) -> np.ndarray:
    """One of the dense counts among the contexts."""
    out = np.zeros(size)
    for row in seen.where(F.col("bucket") == bucket).collect():
        out[np.frombuffer(row["keys"], np.uint32)] = np.frombuffer(row["counts"], np.int64)
    return out


def _places(bucket: int, keys: bytes, slots: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranks and places of a bucket's keys."""
    keys = np.frombuffer(keys, np.uint32).astype(np.int64)
    return keys // slots * buckets + bucket, keys % slots


def head_contexts(seen: DataFrame, twice: np.ndarray, n_classes: int) -> np.ndarray:
    """[side, unit, class] of the words exchanged one by one; at side 2, class 0 the unit itself."""
    n_heads, slots = len(twice), 2 * n_classes
    small_batches(seen.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            for bucket, keys, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                word, _ = _places(bucket, keys, slots, BUCKETS)
                n = int(np.searchsorted(word, n_heads))
                yield pa.RecordBatch.from_pydict({"bucket": pa.array([bucket], pa.int32()), "keys": [keys[: 4 * n]], "counts": [counts[: 8 * n]]})

    out = np.zeros((3, n_heads, n_classes))
    for row in seen.where("bucket >= 0").mapInArrow(run, _CONTEXTS).collect():
        word, at = _places(row["bucket"], row["keys"], slots, BUCKETS)
        out[at // n_classes, word, at % n_classes] = np.frombuffer(row["counts"], np.int64)
    out[2, :, 0] = twice
    return out


def best_classes(row: np.ndarray, at: np.ndarray, n: np.ndarray, classes: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The class of each row that adds most to the likelihood, with all others where they are and its own counts left out.

    ``row`` in order, ``at`` and ``n`` the places and counts of its contexts. What a count adds in each class
    hangs on place and count alone: for small counts, most by far, it is looked up by matrix products.
    """
    size, out = len(pairs), classes.copy()
    if not len(row):
        return out
    # By side and class of a neighbour, what each class of the word has with it; and with all.
    sides, totals = np.concatenate([pairs.T, pairs]), (pairs.sum(1), pairs.sum(0))
    added = [_xlogx(sides + k) - _xlogx(sides) for k in range(1, SMALL + 1)]
    for low in range(0, len(classes), PART):
        high = min(low + PART, len(classes))
        a, b = np.searchsorted(row, [low, high])
        r, place, count = row[a:b] - low, at[a:b], n[a:b]
        own = classes[low:high]
        gain = np.zeros((high - low, size))
        for k, table in enumerate(added, 1):
            here = count == k
            if here.any():
                marks = np.zeros((high - low, 2 * size))
                marks[r[here], place[here]] = 1
                gain += marks @ table
        for i in np.array_split(np.flatnonzero(count > SMALL), 1 + (b - a) // 20_000):
            if len(i):
                held, more = sides[place[i]], count[i][:, None].astype(float)
                heads = np.flatnonzero(np.diff(r[i], prepend=-1))
                gain[r[i[heads]]] += np.add.reduceat(_xlogx(held + more) - _xlogx(held), heads, axis=0)
        mine, more = sides[place, own[r]], count.astype(float)
        stay = np.bincount(r, _xlogx(mine) - _xlogx(np.maximum(mine - more, 0)), high - low)
        for side, total in zip((place < size, place >= size), totals, strict=True):
            sums = np.bincount(r[side], more[side], high - low)
            gain -= _xlogx(total + sums[:, None]) - _xlogx(total)
            kept = total[own]
            stay -= _xlogx(kept) - _xlogx(np.maximum(kept - sums, 0))
        best = gain.argmax(1)
        out[low:high] = np.where(gain[np.arange(high - low), best] > stay + 1e-9, best, own)
    return out


def choose(seen: DataFrame, pairs: np.ndarray, classes: np.ndarray, n_heads: int) -> np.ndarray:
    """For each known word that is not exchanged one by one the best class; the others' as they are."""
    spark = seen.sparkSession
    small_batches(spark)
    shared, slots = spark.sparkContext.broadcast((pairs, classes)), 2 * len(pairs)

    def run(batches: Iterable[pa.RecordBatch]):
        pairs, classes = shared.value
        for batch in batches:
            for bucket, keys, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                word, at = _places(bucket, keys, slots, BUCKETS)
                rare = word >= n_heads
                words, row = np.unique(word[rare], return_inverse=True)
                found = best_classes(row, at[rare], np.frombuffer(counts, np.int64)[rare], classes[words], pairs)
                yield pa.RecordBatch.from_pydict({"w": pa.array(words, pa.int32()), "cls": pa.array(found, pa.int32())})

    out = classes.copy()
    found = seen.where("bucket >= 0").mapInArrow(run, "w int, cls int").toArrow()
    out[found["w"].to_numpy()] = found["cls"].to_numpy()
    return out


def rare_classes(stream: DataFrame, known: Known, classes: np.ndarray, families: np.ndarray, pairs: np.ndarray) -> DataFrame:
    """Of every training word that tasks do not know: h, c (its count) and cls (the class it chooses).

    Its contexts are brought together, neighbours of its kind counting by their family's class. Rows with ``pair``
    have the class pairs of these words in c: with the class chosen, each pair of neighbours once.
    """
    spark, n_classes = stream.sparkSession, len(pairs)
    small_batches(spark)
    shared = spark.sparkContext.broadcast((classes, families, pairs))
    start = _start(known, classes, families)
    # Places: classes that follow, those of known words before, those of other words before.
    entry = pa.schema([("h", pa.int64()), ("at", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterable[pa.RecordBatch]):
        classes, families, _ = shared.value
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def rows():
            h, at = (np.concatenate(c) for c in zip(*held, strict=True))
            held.clear()
            order = np.lexsort((at, h))
            h, at = h[order], at[order]
            first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (at[1:] != at[:-1])])) if len(h) else np.zeros(0, np.int64)
            n = np.diff(np.append(first, len(h)))
            return pa.RecordBatch.from_arrays([pa.array(h[first].astype(np.int64)), pa.array(at[first], pa.int32()), pa.array(n)], schema=entry)

        for batch in batches:
            for ranks, rare in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rank, cls, hashes = _tokens_of(ranks, rare, classes, families)
                before, prior = np.concatenate([[start.cls], cls[:-1]]), np.concatenate([[start.rank >= 0], rank[:-1] >= 0])
                at = np.flatnonzero(rank < 0)
                side = np.where(prior[at], n_classes, 2 * n_classes)
                onward = at[at + 1 < len(rank)]
                held += [(hashes[onward], cls[onward + 1]), (hashes[at], side + before[at])]
                if start.rank < 0:
                    held.append((np.array([END]), cls[:1]))
                if sum(len(h) for h, _ in held) > HELD:
                    yield rows()
        if held:
            yield rows()

    def decide(batches: Iterable[pa.RecordBatch]):
        _, families, pairs = shared.value
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)]
        found_pairs = np.zeros((n_classes, n_classes), np.int64)

        def rows(h, at, n):
            words, row = np.unique(h, return_inverse=True)
            joint = np.where(at >= 2 * n_classes, at - n_classes, at)
            keys, counts = _summed(row * 2 * n_classes + joint, n)
            own = families[family_of(words.astype(_U))]
            cls = best_classes(keys // (2 * n_classes), keys % (2 * n_classes), counts, own, pairs)
            total = np.bincount(row, np.where(at >= n_classes, n, 0), len(words)).astype(np.int64)
            own = cls[row]
            ahead, known_before = at < n_classes, (at >= n_classes) & (at < 2 * n_classes)
            np.add.at(found_pairs, (own[ahead], at[ahead]), n[ahead])
            np.add.at(found_pairs, (at[known_before] - n_classes, own[known_before]), n[known_before])
            return pa.RecordBatch.from_pydict(
                {"pair": pa.array(np.zeros(len(words), bool)), "h": words, "c": total, "cls": pa.array(cls, pa.int32())}
            )

        for batch in batches:
            held = [np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns, strict=True)]
            whole = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            if whole:
                yield rows(*(h[:whole] for h in held))
            held = [h[whole:] for h in held]
            if len(held[0]) > HELD:
                # One word with very many entries: they are summed up.
                keys, n = _summed(held[1], held[2])
                held = [np.full(len(keys), held[0][0]), keys, n]
        if len(held[0]):
            yield rows(*held)
        at = np.flatnonzero(found_pairs)
        yield pa.RecordBatch.from_pydict({"pair": pa.array(np.ones(len(at), bool)), "h": at, "c": found_pairs.ravel()[at], "cls": pa.array(np.zeros(len(at)), pa.int32())})

    entries = stream.mapInArrow(count, "h long, at int, n long")
    number_batches(spark)
    return entries.repartition("h").sortWithinPartitions("h").mapInArrow(decide, "pair boolean, h long, c long, cls int")


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def transitions(seen: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """How often each class follows each."""
    out = np.zeros((seen.shape[2], seen.shape[2]))
    np.add.at(out, classes, seen[0])
    return out


def likelihood(n: np.ndarray) -> float:
    """What the choice of classes adds to the log-likelihood of the training text."""
    return float(_xlogx(n).sum() - _xlogx(n.sum(1)).sum() - _xlogx(n.sum(0)).sum())


def exchange(seen: np.ndarray, classes: np.ndarray, pairs: np.ndarray | None = None) -> np.ndarray:
    """One round: each unit in turn goes to the class where it adds most to the likelihood.

    ``pairs`` has the class counts if there are other words than the units.
    Class counts are kept up with every move; a unit's contexts are those of the round's start.
    """
    classes, n = classes.copy(), transitions(seen, classes) if pairs is None else pairs.copy()
    diagonal = np.arange(len(n))
    totals = n.sum(1), n.sum(0)
    for u in np.argsort(-seen[0].sum(1), kind="stable"):
        after, before, own = seen[0, u], seen[1, u], seen[2, u, 0]
        a = classes[u]
        after, before = after.copy(), before.copy()
        after[a] -= own
        before[a] -= own
        ahead, behind = after.sum() + own, before.sum() + own
        if not ahead + behind:
            continue

        def move(to: int, sign: int, after=after, before=before, own=own, ahead=ahead, behind=behind) -> None:
            n[to] += sign * after
            n[:, to] += sign * before
            n[to, to] += sign * own
            totals[0][to] += sign * ahead
            totals[1][to] += sign * behind

        move(a, -1)
        # Contexts of the round's start may ask for more than is left by now.
        held = np.maximum(n, 0)
        rows = _xlogx(held + after) - _xlogx(held)
        columns = _xlogx(held + before[:, None]) - _xlogx(held)
        gain = rows.sum(1) - rows[diagonal, diagonal] + columns.sum(0) - columns[diagonal, diagonal]
        same = held[diagonal, diagonal]
        gain += _xlogx(same + after + before + own) - _xlogx(same)
        for total, more in zip(totals, (ahead, behind), strict=True):
            gain -= _xlogx(np.maximum(total, 0) + more) - _xlogx(np.maximum(total, 0))
        best = int(gain.argmax()) if gain.max() > gain[a] + 1e-9 else a
        classes[u] = best
        move(best, 1)
    return classes


@dataclass(frozen=True)
class BrownModel:
    known: Known
    counts: np.ndarray  # of the known words, by rank
    classes: np.ndarray  # theirs
    families: np.ndarray  # the class of each family
    transition: np.ndarray  # log10 of the probability of a class after another, for known words
    totals: np.ndarray  # tokens of each class
    unknown: float  # probability of an unknown word
    n: int  # training tokens
    v: int  # distinct ones

    @property
    def base_total(self) -> float:
        return self.n + 0.1 * (self.v + 1)


def _least_known(counts: DataFrame, most: int) -> int:
    """The least count with which a word is known, so that no more than ``most`` are."""
    spread = counts.groupBy(F.least("n", F.lit(1 << 16)).alias("n")).agg(F.count(F.lit(1)).alias("words")).toArrow()
    n, words = spread["n"].to_numpy(), spread["words"].to_numpy()
    order = np.argsort(-n)
    fits = np.cumsum(words[order]) <= most
    return int(n[order][fits].min()) if fits.any() else 1 << 16


def fit(docs: DataFrame, staging: Staging, *, n_classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[BrownModel, DataFrame, DataFrame]:
    """The model of all texts of ``docs``, the counts of all their words, and the rare words' counts and classes, staged."""
    docs, spark = texts(docs), docs.sparkSession
    with no_old_shuffles(spark):
        counts = staging.write(word_counts(docs), "words")
    n, v, once = counts.agg(F.sum("n"), F.count(F.lit(1)), F.count(F.when(F.col("n") == 1, 1))).first()
    n = n or 0
    frequent = counts.where(F.col("n") >= _least_known(counts, KNOWN_WORDS)).orderBy(F.desc("n"), "h").limit(KNOWN_WORDS).toArrow()
    hashes, known_counts = frequent["h"].to_numpy().astype(_U), frequent["n"].to_numpy()
    known, family = Known.of(hashes), family_of(hashes)
    n_heads = int((known_counts >= max(2, UNIT_SHARE * n)).sum())
    families = np.arange(FAMILIES) % n_classes
    classes = np.where(np.arange(len(hashes)) < n_heads, np.arange(len(hashes)) % n_classes, family % n_classes)
    scratch, best, twice = Staging(spark, "brown-contexts"), None, None
    with no_old_shuffles(spark):
        stream = scratch.write(token_stream(docs, known), "stream")
        for k in range(rounds + 1):
            seen = scratch.write(contexts(stream, known, classes, families, n_classes, n_heads), "seen")
            found = _array(seen, ALL_PAIRS, n_classes * n_classes).reshape(n_classes, n_classes)
            twice = _array(seen, REPEATS, n_heads) if twice is None else twice
            if best is None or likelihood(found) > likelihood(best[1]):
                best = classes, found, _array(seen, KNOWN_PAIRS, n_classes * n_classes).reshape(n_classes, n_classes)
            if k < rounds:
                heads = exchange(head_contexts(seen, twice, n_classes), classes[:n_heads], found)
                classes = choose(seen, found, classes, n_heads)
                classes[:n_heads] = heads
        classes, found, pairs = best
        rest = staging.write(rare_classes(stream, known, classes, families, found), "rare")
        scratch.remove()
    rare = rest.where("not pair").select("h", "c", "cls")
    pairs = pairs.copy()
    for row in rest.where("pair").groupBy("h").agg(F.sum("c").alias("c")).collect():
        pairs[divmod(row.h, n_classes)] += row.c
    # A family has the class that holds most tokens of its words, those exchanged one by one aside.
    held, totals = np.zeros((FAMILIES, n_classes)), np.bincount(classes, known_counts, n_classes).astype(float)
    for row in rare.groupBy(F.col("h").bitwiseAND(FAMILIES - 1).alias("family"), "cls").agg(F.sum("c").alias("c")).collect():
        held[row.family, row.cls] += row.c
        totals[row.cls] += row.c
    np.add.at(held, (family[n_heads:], classes[n_heads:]), known_counts[n_heads:])
    families = np.where(held.any(1), held.argmax(1), families)
    shares = totals / max(totals.sum(), 1)
    smooth = (pairs + TRANSITION_PRIOR * shares) / (pairs.sum(1, keepdims=True) + TRANSITION_PRIOR)
    with np.errstate(divide="ignore"):
        transition = np.log10(smooth)
    unknown = 1.0 if not n else min(0.5, (once + 0.5) / (n + 1))
    return BrownModel(known, known_counts, classes, families, transition, totals, unknown, n, v), counts, rare


_ROWS = "h long, prev long, before int, own int, after int, k long, part double, n_tokens long, n_known long, base double"


def class_scores(docs: DataFrame, model: BrownModel, rare: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row; a null text counts as empty.

    A known word has the probability (1 - unknown) P(class | class before) n(word) / n(class), an
    unknown one ``unknown``: together one. Words known to every task are added up where they are read.
    The others are looked up by a join on the word, with the transitions to and from them; where two are
    neighbours, the first is looked up for the second.
    """
    spark = docs.sparkSession
    small_batches(spark)
    source = texts(docs).withColumn("key", F.monotonically_increasing_id()).select("doc_id", "text", "key")
    id_type = source.schema["doc_id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(model)

    # ``prev`` is the word before if that is to be looked up as well, with ``before`` its family's class; ``after`` is -1 without a known word next.
    def run(batches: Iterable[pa.RecordBatch]):
        m = shared.value
        start = _start(m.known, m.classes, m.families).cls
        with np.errstate(divide="ignore"):
            out_of = np.log10(1 - m.unknown) - np.log10(m.totals)
        for batch in batches:
            n = batch.num_rows
            hashes, owner = tokens(batch.column(1))
            if not n:
                continue
            rank = m.known.rank(hashes)
            here = rank >= 0
            cls = np.where(here, np.append(m.classes, 0)[rank], m.families[family_of(hashes)])
            first = np.concatenate([[True], owner[1:] != owner[:-1]])
            last = np.append(first[1:], True)
            before, prior = np.concatenate([[start], cls[:-1]]), np.concatenate([[True], here[:-1]])
            before, prior = np.where(first, start, before), first | prior
            c = np.where(here, np.append(m.counts, 0)[rank], 0)
            part = np.zeros(len(hashes))
            both = here & prior
            part[both] = m.transition[before[both], cls[both]]
            part[here] += out_of[cls[here]] + np.log10(c[here])
            base = np.where(here, np.log10((c + 0.1) / m.base_total), 0.0)
            sums = (np.bincount(owner, x, n) for x in (part, here, base))
            part, known, base = sums
            keys = batch.column(2).to_numpy()
            empty = pa.nulls(n, pa.int64())
            zero = pa.array(np.zeros(n), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), batch.column(0), empty, empty, zero, zero, zero, pa.array(np.zeros(n), pa.int64()), pa.array(part),
                 pa.array(np.bincount(owner, minlength=n)), pa.array(known, pa.int64()), pa.array(base)], names=names,
            )
            at = np.flatnonzero(~here)
            following = np.minimum(at + 1, len(hashes) - 1)
            after = np.where(~last[at] & here[following], cls[following], -1)
            fields = np.stack([keys[owner[at]], hashes[at].astype(np.int64), np.where(prior[at], 0, hashes[np.maximum(at - 1, 0)].astype(np.int64)), prior[at], before[at], cls[at], after], axis=1)
            found, k = np.unique(fields, axis=0, return_counts=True)
            size, nothing = len(found), np.zeros(len(found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[:, 0]), pa.nulls(size, batch.column(0).type), pa.array(found[:, 1]), pa.array(found[:, 2], mask=found[:, 3] > 0),
                 *(pa.array(found[:, i], pa.int32()) for i in (4, 5, 6)), pa.array(k), pa.array(nothing), *[pa.array(nothing, pa.int64())] * 2, pa.array(nothing)], names=names,
            )

    schema = f"key long, doc_id {id_type}, {_ROWS}"
    names = ["key", "doc_id", "h", "prev", "before", "own", "after", "k", "part", "n_tokens", "n_known", "base"]
    with no_old_shuffles(spark):
        rows = Staging(spark, "brown-rows").write(source.mapInArrow(run, schema), "rows")
    size = len(model.totals)
    with np.errstate(divide="ignore", invalid="ignore"):
        out_of = (np.log10(1 - model.unknown) - np.log10(model.totals)).tolist()
    moves, out_of = F.array(*map(F.lit, model.transition.ravel().tolist())), F.array(*map(F.lit, out_of))
    loose, classes = rows.where("k > 0"), rare.select("h", "c", "cls")
    first = loose.where("prev is not null").join(classes.select(F.col("h").alias("prev"), F.col("cls").alias("found")), "prev", "left")
    first = first.withColumn("before", F.coalesce("found", "before")).select(*rows.columns)
    loose = loose.where("prev is null").unionByName(first).join(classes, "h", "left")
    k, c, own, after = F.col("k"), F.coalesce("c", F.lit(0)), F.coalesce("cls", "own"), F.col("after")
    entry = F.when(c > 0, F.get(moves, F.col("before") * size + own) + F.get(out_of, own) + F.log10(c)).otherwise(float(np.log10(model.unknown)))
    found = loose.select(
        "key", "doc_id", "n_tokens", F.when(c > 0, k).otherwise(0).alias("n_known"), (k * F.log10((c + 0.1) / model.base_total)).alias("base"),
        (k * (entry + F.when(after >= 0, F.get(moves, own * size + after)).otherwise(0.0))).alias("part"),
    )
    return (
        rows.where("k = 0").select(*found.columns).unionByName(found)
        .groupBy("key")
        .agg(
            F.max("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
            F.lit(model.n).cast("long").alias("train_tokens"), F.sum("base").alias("base_score"), F.sum("part").alias("score"),
        )
        .drop("key")
    )


def perplexity(score: Column, n_tokens: Column) -> Column:
    return F.pow(F.lit(10.0), -score / n_tokens)


def score_documents(docs: DataFrame, *, learn: Column | None = None, n_classes: int = CLASSES, rounds: int = ROUNDS) -> DataFrame:
    """``class_scores`` of all rows, by the model of those under ``learn``, a condition on the columns of ``docs``."""
    staging = Staging(docs.sparkSession, "brown")
    model, _, rare = fit(docs if learn is None else docs.where(learn), staging, n_classes=n_classes, rounds=rounds)
    return class_scores(docs, model, rare)

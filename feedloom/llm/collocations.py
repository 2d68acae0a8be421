"""Collocations: fingerprints of all runs of words from prefix polynomials, counted by shuffles that only frequent ones pass."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import Staging

from .common import small_batches
from .rolling import Hasher, Words, byte_kinds, mixed

LONGEST = 5
LEAST_COUNT = 100
TOP = 2000
# Sizes of runs that are counted by themselves, so that the next pass is spared what cannot be frequent.
FILTERED = 3
# Bits of a filter: so many for each fingerprint in it, within these bounds (the upper one is 32 MB).
BITS_EACH, LEAST_BITS, MOST_BITS = 64, 20, 28
# Fingerprints a task holds before it sums them up, and distinct ones before it hands them on.
HELD, DISTINCT = 1 << 21, 1 << 20
# Ranges of fingerprints for each shuffle partition.
RANGES_EACH = 4
# Parts of a language in which its best phrases are found first.
RANK_PARTS = 64

_KINDS = byte_kinds(b" \t", b".,;:!?\n\x0b\x0c\r")
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] += 32
_U = np.uint64
# Bits of a fingerprint that are used; fewer make collisions, for tests.
FINGERPRINT = _U(0xFFFFFFFFFFFFFFFF)
_FIRST, _SECOND = Hasher(), Hasher(0xC2B2AE3D27D4EB4F)


class _Runs:
    """Fingerprints of a batch's runs of words, by size, and a second hash of their letters. Both hang on the language too."""

    def __init__(self, batch: pa.RecordBatch, mask: np.uint64):
        self.words = Words(batch.column("text"), _KINDS)
        langs = np.array([xxhash.xxh3_64_intdigest(x.as_py()) for x in batch.column("lang")], _U)
        self.lang = langs[self.words.text]
        self.mask = mask
        self.hashes = _FIRST.of_words(self.words)
        self.first = _FIRST.of_runs(self.hashes, list(range(1, LONGEST + 1)))
        self.second: dict[int, np.ndarray] = {}

    def fingerprints(self, size: int) -> np.ndarray:
        runs = self.first[size]
        return mixed(runs ^ self.lang[: len(runs)]) & self.mask

    def checks(self, size: int) -> np.ndarray:
        if not self.second:
            self.second = _SECOND.of_runs(_SECOND.of_words(self.words), list(range(1, LONGEST + 1)))
        runs = self.second[size]
        return mixed(runs ^ self.lang[: len(runs)])

    def whole(self, size: int) -> np.ndarray:
        """The runs that lie in one piece."""
        piece, n = self.words.piece, max(len(self.words) - size + 1, 0)
        return piece[:n] == piece[size - 1 : size - 1 + n]

    def possible(self, filters: list[Broadcast], longest: int) -> dict[int, np.ndarray]:
        """By size, the runs in one piece that may be frequent: both their parts of one word less may be, and a filter for the size lets them pass."""
        out, runs = {}, np.ones(len(self.words), bool)
        for size in range(1, longest + 1):
            if size > 1:
                runs = runs[:-1] & runs[1:]
            if size == 2:
                runs &= self.whole(2)
            if size <= len(filters):
                runs = runs & _in(filters[size - 1], self.fingerprints(size))
            out[size] = runs
        return out


def _in(bits: Broadcast, prints: np.ndarray) -> np.ndarray:
    held = bits.value
    at = prints >> _U(64 - int(np.log2(len(held) * 8)))
    return (held[at >> _U(3)] >> (at & _U(7)).astype(np.uint8)) & 1 > 0


def _filter(found: DataFrame, value: Column) -> Broadcast:
    """A bit array of the leading bits of some 64-bit values, of bounded size. What it lets through by chance costs
    work downstream, never a result; with more values than bits it lets everything through."""
    spark = found.sparkSession
    count = found.count()
    width = min(max(int(count * BITS_EACH).bit_length(), LEAST_BITS), MOST_BITS)
    at = F.shiftrightunsigned(value, 64 - width)
    packed = found.select(F.shiftright(at, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int")).alias("bit"))
    rows = packed.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    held = np.zeros(1 << (width - 6), np.int64)
    held[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return spark.sparkContext.broadcast(held.view(np.uint8))


def _summed(parts: list[list[np.ndarray]], whole: bool) -> list[np.ndarray]:
    """Counts by fingerprint, with ``whole`` by second hash too: fingerprints, hashes, sizes, least pointers, counts, in order."""
    prints, checks, sizes, ties, counts = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((checks, prints)) if whole else np.argsort(prints)
    prints, checks, sizes, ties, counts = (c[order] for c in (prints, checks, sizes, ties, counts))
    if not len(prints):
        return [prints, checks, sizes, ties, counts]
    new = np.ones(len(prints), bool)
    new[1:] = (prints[1:] != prints[:-1]) | (checks[1:] != checks[:-1])
    at = np.flatnonzero(new)
    return [prints[at], checks[at], sizes[at], np.minimum.reduceat(ties, at), np.add.reduceat(counts, at)]


_TYPES = (np.uint64, np.uint64, np.int32, np.int64, np.int64)
_SENT = "bucket int, prints binary, checks binary, sizes binary, ties binary, counts binary"


def _frequent(docs: DataFrame, filters: list[Broadcast], sizes: range, least_count: int, *, whole: bool) -> DataFrame:
    """Runs of these sizes that may be frequent and are, by fingerprint: print and n; with ``whole`` by second hash
    too, with size and a pointer to a text (tie).

    Tasks sum up what they read and send it on as arrays, one row for each range of fingerprints: few long rows
    move instead of one for each run. There are as many ranges as fill the shuffle partitions evenly.
    """
    spark = docs.sparkSession
    small_batches(spark)
    mask, most, distinct = FINGERPRINT, HELD, DISTINCT
    buckets = RANGES_EACH * int(spark.conf.get("spark.sql.shuffle.partitions"))
    edges = np.array([-(-(b << 64) // buckets) for b in range(1, buckets)], _U)
    names = ["bucket", "prints", "checks", "sizes", "ties", "counts"]

    def sent(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        cuts = [0, *np.searchsorted(columns[0], edges).tolist(), len(columns[0])]
        for bucket, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if a < b:
                # What is not counted by is not sent.
                blobs = [c[a:b].astype(t).tobytes() if whole or i in (0, 4) else b"" for i, (c, t) in enumerate(zip(columns, _TYPES, strict=True))]
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), *(pa.array([x], pa.binary()) for x in blobs)], names=names)

    def count(batches: Iterable[pa.RecordBatch]):
        held, size = [], 0
        for batch in batches:
            runs = _Runs(batch, mask)
            chosen = runs.possible(filters, sizes[-1])
            tie = batch.column("tie").to_numpy()[runs.words.text] if whole else None
            for length in sizes:
                at = np.flatnonzero(chosen[length])
                none = np.zeros(len(at), np.int64)
                checks, ties = (runs.checks(length)[at], tie[at]) if whole else (none.astype(_U), none)
                held.append([runs.fingerprints(length)[at], checks, np.full(len(at), length, np.int32), ties, none + 1])
                size += len(at)
            if size > most:
                held = [_summed(held, whole)]
                size = len(held[0][0])
                if size > distinct:
                    yield from sent(held.pop())
                    size = 0
        if held:
            yield from sent(_summed(held, whole))

    def merge(batches: Iterable[pa.RecordBatch]):
        bucket, held, size = None, [], 0

        def often() -> pa.RecordBatch:
            prints, checks, lengths, ties, counts = _summed(held, whole)
            kept = counts >= least_count
            columns = {"print": prints.astype(np.int64), "n": counts}
            if whole:
                columns |= {"check": checks.astype(np.int64), "size": lengths, "tie": ties}
            return pa.RecordBatch.from_pydict({name: c[kept] for name, c in columns.items()})

        for batch in batches:
            for own, *blobs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != bucket:
                    if held:
                        yield often()
                    bucket, held, size = own, [], 0
                n = len(blobs[0]) // 8
                held.append([np.frombuffer(x, t) if x else np.zeros(n, t) for x, t in zip(blobs, _TYPES, strict=True)])
                size += n
                if size > most:
                    held = [_summed(held, whole)]
                    size = len(held[0][0])
        if held:
            yield often()

    dealt = docs.mapInArrow(count, _SENT).repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(merge, "print long, n long" + (", check long, size int, tie long" if whole else ""))


def _totals(docs: DataFrame) -> DataFrame:
    """How many words each language has: lang, n."""
    small_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            words = Words(batch.column("text"), _KINDS)
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(np.diff(words.first))], names=["lang", "n"])

    return docs.mapInArrow(run, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n"))


def _phrases(docs: DataFrame, wanted: Broadcast) -> DataFrame:
    """The words of the runs that pointers name, from the texts they point to. Each task gives a run once in a while."""
    small_batches(docs.sparkSession)
    mask = FINGERPRINT

    def run(batches: Iterable[pa.RecordBatch]):
        seen: set[tuple[int, int, int]] = set()
        for batch in batches:
            runs = _Runs(batch, mask)
            words = runs.words
            letters, langs = _SMALL[words.data], batch.column("lang")
            ties = batch.column("tie").to_numpy()
            own = ties.astype(_U)[words.text]
            rows = []
            for size in range(1, LONGEST + 1):
                prints = runs.fingerprints(size)
                at = np.flatnonzero(_in(wanted, prints ^ own[: len(prints)]) & runs.whole(size))
                checks = runs.checks(size)
                keys = (c.tolist() for c in (prints[at].astype(np.int64), checks[at].astype(np.int64), ties[words.text[at]]))
                for i, *key in zip(at.tolist(), *keys, strict=True):
                    if tuple(key) not in seen:
                        seen.add(tuple(key))
                        spelled = " ".join(letters[words.start[k] : words.end[k]].tobytes().decode() for k in range(i, i + size))
                        rows.append((*key, langs[words.text[i]].as_py(), spelled))
            if len(seen) > DISTINCT:
                seen.clear()
            yield pa.RecordBatch.from_pydict(
                {name: pa.array([r[i] for r in rows], kind) for i, (name, kind) in enumerate([("print", pa.int64()), ("check", pa.int64()), ("tie", pa.int64()), ("lang", pa.string()), ("phrase", pa.string())])}
            )

    return docs.mapInArrow(run, "print long, check long, tie long, lang string, phrase string")


def frequent_phrases(docs: DataFrame, staging: Staging, *, least_count: int = LEAST_COUNT) -> DataFrame:
    """lang, phrase, size and f of every phrase of one to five words with that many occurrences. ``docs``: lang, text, tie.

    Words first, then pairs of frequent words, then threes of frequent pairs, then all longer runs whose
    threes are frequent: a phrase is never more frequent than a part of it, so nothing is lost. Each pass
    drops what cannot be frequent by filters of bounded size; tasks sum up before the shuffle. Counting by fingerprint alone can
    only be too high, as different runs may share one; the last pass counts by a second, independent
    hash of the letters as well. Only runs that are frequent by both are spelled out, once, from the
    text that their pointer names, where both hashes are worked out again.
    """
    filters: list[Broadcast] = []
    for size in range(1, FILTERED + 1):
        often = staging.write(_frequent(docs, list(filters), range(size, size + 1), least_count, whole=False).select("print"), f"often-{size}")
        filters.append(_filter(often, F.col("print")))
    found = staging.write(_frequent(docs, filters, range(1, LONGEST + 1), least_count, whole=True), "frequent")
    spelled = _phrases(docs, _filter(found, F.col("print").bitwiseXOR(F.col("tie"))))
    named = found.join(spelled.dropDuplicates(["print", "check", "tie"]), ["print", "check", "tie"])
    return staging.write(named.select("lang", "phrase", "size", F.col("n").alias("f")), "phrases")


def _part(start: Column, size: Column) -> Column:
    return F.array_join(F.slice("words", start, size), " ")


def collocations(
    docs: DataFrame, *, least_count: int = LEAST_COUNT, top: int = TOP, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """Each language's ``top`` phrases of two to five words: lang, rank, phrase, a, l, r, n, score.

    Texts, A-Z made small, are cut into pieces at ``.,;:!?`` and line ends, pieces into words at spaces
    and tabs. ``n`` is the number of the language's words, ``a`` of the phrase's occurrences, ``l`` and
    ``r`` of those of its parts at the cut that scores lowest (of equal scores the first), ``score`` the
    whole part of 1000 * a * n / (l * r). A phrase inside a longer frequent one that is as frequent is left
    out. Ranks go by score, a, then bytes. A null language is ``und``, a null text has no words, repeated rows
    count as often as they are there; an empty table gives an empty one. Only text and lang are read, texts whole.
    """
    text, lang = F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    source = docs.select(lang.alias("lang"), text.alias("text"), F.xxhash64(text).alias("tie"))
    staging = Staging(docs.sparkSession, "collocations")
    phrases = frequent_phrases(source, staging, least_count=least_count)
    totals = staging.write(_totals(source.select("lang", "text")), "totals")

    longer = phrases.where("size >= 2").withColumn("words", F.split("phrase", " "))
    cuts = longer.select("lang", "phrase", F.col("f").alias("a"), "size", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    parts = cuts.select("lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("left"), _part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    known = phrases.select("lang", "phrase", "f")
    cut = (
        parts.join(known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
        .join(known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
        .join(totals, "lang")
    )
    # Products of 37 digits at most; the quotient is at most ten times n.
    score = "(cast(cast(a AS decimal(18,0)) * 1000 AS decimal(21,0)) * cast(n AS decimal(16,0))) div (cast(l AS decimal(18,0)) * cast(r AS decimal(18,0)))"
    scored = cut.withColumn("score", F.expr(score))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # The parts of two words and more of each candidate, with its own count.
    inner = longer.where("size > 2").select("lang", "words", "size", "f", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("width"))
    inner = inner.select("lang", "f", "words", "width", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("width") + 1)).alias("at"))
    covered = inner.select("lang", _part(F.col("at"), F.col("width")).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("over"))
    left = best.join(covered, ["lang", "phrase"], "left").where("over IS NULL OR over < a")
    rows = left.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    some = rows.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

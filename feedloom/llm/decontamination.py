"""Benchmark decontamination: q-gram counts in overlapping diagonal bands, verified by banded alignment."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filter_texts, map_columns, texts

# Items are searched in windows of WINDOW characters, one every STEP; shorter ones as a whole.
WINDOW, STEP = 100, 50
# And in runs of RUN characters, one every RUN_STEP, with RUN_EDITS edits: of RUN or more characters
# copied from any place of an item, 2 * RUN_EDITS + 1 starts in a row fit, and RUN_STEP is no more.
RUN, RUN_STEP, RUN_EDITS = 50, 5, 2
Q = 10
EDIT_RATE = 0.08
# Characters of windows in one block of the query set; for each block the documents are read once.
BLOCK_CHARS = 1 << 20
# Characters hashed and windows aligned at a time.
PART_CHARS, PART_WINDOWS = 1 << 20, 2048

_SIGNS = re.compile(r"[\W_]+")
_ONE_SIGN = re.compile(r"[\W_]")
# Between documents: more than any budget, so that no alignment goes across.
_GAP = "\n" * (int(WINDOW * EDIT_RATE) + 2)


def normal(text: str) -> str:
    """Lower case, with one space for each run of other signs than letters and digits."""
    return _SIGNS.sub(" ", text.lower()).strip()


def budget(size: int, rate: float = EDIT_RATE) -> int:
    """Edits allowed in a window: its share, and no more than leave one q-gram that must be untouched."""
    return max(0, min(int(size * rate), size // Q - 1))


def needed(size, edits):
    """The q-gram lemma: a window with so few edits shares at least so many q-grams."""
    return size + 1 - Q * (edits + 1)


def windows(text: str) -> list[str]:
    """The windows of a normalised item, the last one at its end. An item under Q characters has none."""
    if len(text) < Q:
        return []
    return _cut(text, WINDOW, STEP)


def _cut(text: str, size: int, step: int) -> list[str]:
    last = max(0, len(text) - size)
    return [text[at : at + size] for at in sorted({*range(0, last, step), last})]


def pieces(text: str) -> list[tuple[str, int]]:
    """All that is searched of a normalised item, each with its edits: windows and runs, or under Q characters the whole."""
    if len(text) < Q:
        return [(text, 0)] if text else []
    runs = _cut(text, RUN, RUN_STEP) if len(text) > RUN else []
    return [(w, budget(len(w))) for w in windows(text)] + [(r, RUN_EDITS) for r in runs]


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(letters: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the Q characters that begin at each place."""
    n = len(letters) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(Q):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= letters[i : i + n]
    return out


@dataclass(frozen=True)
class Queries:
    """A block of the query set: its windows, and every q-gram of theirs with its window and place, by hash."""

    items: list
    letters: np.ndarray  # of all windows
    starts: np.ndarray
    sizes: np.ndarray
    edits: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # of a hash in window and place
    window: np.ndarray
    place: np.ndarray
    short: dict[str, list[int]]  # windows under Q characters, found as whole words

    def seen(self) -> np.ndarray:
        """A bit for 22 bits of each hash, to pass over most grams of a document at once."""
        bits = np.zeros(1 << 22, bool)
        bits[(self.hashes >> np.uint64(42)).astype(np.int64)] = True
        return bits


def block_of(found: list[tuple], edits: list[int] | None = None) -> Queries:
    """From (item, window) pairs and the edits of each, by default those of ``budget``."""
    sizes = np.array([len(w) for _, w in found], np.int64)
    letters = codes("".join(w for _, w in found))
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    hashes, owner = gram_hashes(letters), np.repeat(np.arange(len(found)), sizes)
    place = np.arange(len(letters)) - starts[owner]
    whole = np.flatnonzero(place <= sizes[owner] - Q)
    order = whole[np.argsort(hashes[whole], kind="stable")]
    distinct, first = np.unique(hashes[order], return_index=True)
    edits = np.array([budget(int(n)) for n in sizes] if edits is None else edits, np.int64)
    short: dict[str, list[int]] = {}
    for i in np.flatnonzero(sizes < Q).tolist():
        short.setdefault(found[i][1], []).append(i)
    return Queries([i for i, _ in found], letters, starts, sizes, edits, distinct, np.append(first, len(order)), owner[order], place[order], short)


def blocks(benchmark: DataFrame, *, item_col: str = "item_id", text_col: str = "text", block_chars: int = BLOCK_CHARS, short_items: bool = True) -> Iterator[Queries]:
    """The query set in blocks of bounded size, on request without items under Q characters. Null and empty texts have no windows."""
    rows, edits, size = [], [], 0
    for row in benchmark.select(F.col(item_col).alias("i"), F.col(text_col).alias("t")).where("t is not null").toLocalIterator():
        cleaned = normal(row.t)
        for window, most in pieces(cleaned) if short_items or len(cleaned) >= Q else ():
            rows.append((row.i, window))
            edits.append(most)
            size += len(window)
            if size >= block_chars:
                yield block_of(rows, edits)
                rows, edits, size = [], [], 0
    if rows:
        yield block_of(rows, edits)


def candidates(letters: np.ndarray, queries: Queries, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows and bands of diagonals with as many shared q-grams as the lemma asks for.

    With c = edits + 1, band j has the 2c diagonals from j * c on. The diagonals of one alignment lie
    among c consecutive ones, so they are all in some band.
    """
    if not len(queries.hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys = []
    bands = len(letters) + 4 * WINDOW
    for at in range(0, max(1, len(letters)), PART_CHARS):
        hashes = gram_hashes(letters[at : at + PART_CHARS + Q - 1])
        likely = np.flatnonzero(seen[(hashes >> np.uint64(42)).astype(np.int64)])
        slot = np.searchsorted(queries.hashes, hashes[likely])
        slot[slot == len(queries.hashes)] = 0
        hit = queries.hashes[slot] == hashes[likely]
        likely, slot = likely[hit], slot[hit]
        times = queries.first[slot + 1] - queries.first[slot]
        entry = np.repeat(queries.first[slot] - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum())
        window = queries.window[entry]
        # Places before the text's start are moved up, so that all diagonals are positive.
        diagonal = np.repeat(likely + at, times) - queries.place[entry] + 2 * WINDOW
        band = diagonal // (queries.edits[window] + 1)
        keys += [window * bands + band, window * bands + band - 1]
    found, counts = np.unique(np.concatenate(keys), return_counts=True)
    window, band = found // bands, found % bands
    enough = counts >= needed(queries.sizes, queries.edits)[window]
    return window[enough], band[enough]


def align(letters: np.ndarray, queries: Queries, window: np.ndarray, band: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least edits of each window within its band, and where in the text that alignment begins and ends."""
    padded = np.concatenate([np.full(2 * WINDOW, 10, np.uint32), letters, np.full(3 * WINDOW, 10, np.uint32)])
    edits, begins, ends = (np.zeros(len(window), np.int64) for _ in range(3))
    kinds = np.stack([queries.sizes[window], queries.edits[window]], axis=1)
    for size, most in np.unique(kinds, axis=0):
        own = np.flatnonzero((kinds == (size, most)).all(axis=1))
        for at in range(0, len(own), PART_WINDOWS):
            part = own[at : at + PART_WINDOWS]
            wide = 2 * (most + 1)
            start = band[part] * (most + 1)
            steps = np.arange(wide)
            # Cost in the high bits, the place where the alignment began in the low ones.
            one = np.int64(1 << 32)
            row = np.broadcast_to(steps, (len(part), wide)).astype(np.int64)
            slope = steps * one
            for i in range(size):
                letter = queries.letters[queries.starts[window[part]] + i]
                text = padded[start[:, None] + i + steps]
                step = row + (text != letter[:, None]) * one
                step[:, :-1] = np.minimum(step[:, :-1], row[:, 1:] + one)
                row = np.minimum.accumulate(step - slope, axis=1) + slope
            best = row.argmin(axis=1)
            least = row[np.arange(len(part)), best]
            edits[part] = least >> 32
            begins[part] = start + (least & (one - 1)) - 2 * WINDOW
            ends[part] = start + size + best - 2 * WINDOW
    return edits, begins, ends


def short_hits(cleaned: list[str], queries: Queries) -> Iterator[tuple[int, int, int, int, int]]:
    """The first place of each short window in each text, as whole words."""
    spaces = {window.count(" ") for window in queries.short}
    for t, text in enumerate(cleaned):
        words, seen = text.split(" "), set()
        starts = np.cumsum([0] + [len(w) + 1 for w in words]).tolist()
        for i in range(len(words)):
            for n in spaces:
                part = words[i] if not n else " ".join(words[i : i + n + 1])
                if part in queries.short and part not in seen:
                    seen.add(part)
                    for window in queries.short[part]:
                        yield t, window, 0, starts[i], starts[i] + len(part)


def search(batch: list[str], queries: Queries, seen: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(number of the text, window, edits, begin, end) of each window found; places in the normalised text."""
    cleaned = [normal(text) for text in batch]
    letters = codes(_GAP.join(cleaned))
    short = list(short_hits(cleaned, queries)) if queries.short else []
    window, band = candidates(letters, queries, seen)
    if not len(window):
        return sorted(short)
    edits, begins, ends = align(letters, queries, window, band)
    good = edits <= queries.edits[window]
    sizes = np.array([len(t) + len(_GAP) for t in cleaned])
    starts = np.cumsum(sizes) - sizes
    owner = np.searchsorted(starts, ends[good] - 1, side="right") - 1
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for key, found in zip(
        zip(owner.tolist(), window[good].tolist(), strict=True),
        zip(edits[good].tolist(), (begins[good] - starts[owner]).tolist(), (ends[good] - starts[owner]).tolist(), strict=True),
        strict=True,
    ):
        best[key] = min(best.get(key, found), found)
    return sorted(short + [(*key, *found) for key, found in best.items()])


def places(text: str) -> np.ndarray:
    """For each character of the normalised text, its place in the text. Signs at either end are cut off."""
    out, space = [], True
    for i, sign in enumerate(text):
        for low in sign.lower():
            if not _ONE_SIGN.match(low):
                out.append(i)
                space = False
            elif not space:
                out.append(i)
                space = True
    return np.array(out, np.int64)


_LEAK = "windows long, edits long, start long, end long"


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row for each doc_id and item_id of which a document holds a window within its edit budget.

    ``windows`` counts the item's windows and runs found, ``edits`` is the least of theirs, ``start`` and
    ``end`` span them in code points. Null texts hold nothing, null and empty items are in no document,
    and items under Q characters where they stand as whole words; repeated rows count as one document. The benchmark is the query set: its
    blocks, of bounded size, go to all tasks, and the documents are read once for each.
    """
    source = texts(docs, id_col, text_col)
    id_type, item_type = source.schema["doc_id"].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    schema = f"doc_id {id_type}, item_id {item_type}, {_LEAK}"
    spark, found = docs.sparkSession, None
    for block in blocks(benchmark, item_col=item_col, block_chars=block_chars):
        rows = map_columns(source, schema, _leaks(spark.sparkContext.broadcast(block)))
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        return spark.createDataFrame([], schema)
    return found.groupBy("doc_id", "item_id").agg(
        F.sum("windows").alias("windows"), F.min("edits").alias("edits"), F.min("start").alias("start"), F.max("end").alias("end")
    )


def _leaks(block):
    def make():
        queries = block.value
        seen = queries.seen()

        def work(ids, batch):
            rows: dict[tuple[int, int], list] = {}
            for text, window, edits, begin, end in search(batch, queries, seen):
                rows.setdefault((text, queries.items[window]), []).append((edits, begin, end))
            out, at = [], {}
            for (text, item), found in rows.items():
                if text not in at:
                    at[text] = places(batch[text])
                place, last = at[text], len(at[text]) - 1
                start, end = min(f[1] for f in found), max(f[2] for f in found)
                out.append((ids[text], item, len(found), min(f[0] for f in found), place[min(max(start, 0), last)], place[min(end - 1, last)] + 1))
            return [list(c) for c in zip(*out, strict=True)] or [[]] * 6

        return work

    return make


def drop_leaks(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", block_chars: int = BLOCK_CHARS, short_items: bool = False) -> DataFrame:
    """The rows of ``docs`` whose text holds no window of any item; columns as they are, no row moves.

    An item under Q characters, such as ``yes`` or ``42``, is a word of ordinary texts: that a document has it is
    reported by :func:`find_leaks`, but costs it its place only with ``short_items``.
    """
    for block in blocks(benchmark, item_col=item_col, block_chars=block_chars, short_items=short_items):
        docs = filter_texts(docs, text_col, _clean(docs.sparkSession.sparkContext.broadcast(block)))
    return docs


def _clean(block):
    def make():
        queries = block.value
        seen = queries.seen()

        def keep(batch):
            leaked = {found[0] for found in search(batch, queries, seen)}
            return [i not in leaked for i in range(len(batch))]

        return keep

    return make

"""Near-duplicate search by min-max hashing: each permutation gives a set its least and its greatest value."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from feedloom.session import Staging

from .common import grouped, small_batches, texts
from .components import components
from .rolling import Hasher, Words, byte_kinds, mixed

WORDS = 4
PERCENT = 80
# Permutations, and values in a band. A band holds least values of ROWS permutations, or their greatest ones.
PERMUTATIONS, ROWS = 40, 4
# Deviations below the threshold at which an estimate from all values still sends a pair to the exact check.
DEVIATIONS = 4.5
# Sets, and words in them, that a task compares with as many others at a time.
BLOCK_SETS, BLOCK_WORDS = 512, 1 << 21

_SPACES = byte_kinds(b" \t\n\v\f\r")
_HASHER = Hasher()
_U = np.uint64
_ODD = mixed(np.arange(1, PERMUTATIONS + 1, dtype=_U) << _U(17)) | _U(1)
_PART = 2048


def word_sets(batch: pa.Array, size: int = WORDS) -> list[np.ndarray]:
    """For each text the sorted set of its hashed runs of ``size`` words; fewer words are one run, no words the empty set."""
    words = Words(batch, _SPACES)
    hashes = _HASHER.of_words(words)
    runs = _HASHER.of_runs(hashes, list(range(1, size + 1)))
    out = []
    for at, end in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        n = end - at
        out.append(np.unique(runs[size][at : end - size + 1]) if n >= size else runs[n][at : at + 1] if n else hashes[:0])
    return out


def min_max(values: np.ndarray) -> np.ndarray:
    """The set's values: the least one under each permutation, then the greatest ones.

    A permutation is hashed once for both. Two sets agree in a value with the probability of their
    Jaccard similarity, so the share of equal values is an unbiased estimate of it; as a set's least
    and greatest element are rarely lost together, it varies less than that of as many permutations'
    least values alone.
    """
    low = high = None
    for at in range(0, len(values), _PART):
        turned = values[at : at + _PART] * _ODD[:, None]
        least, most = turned.min(axis=1), turned.max(axis=1)
        low, high = (least, most) if low is None else (np.minimum(low, least), np.maximum(high, most))
    return np.concatenate([low, high])


def bands(values: np.ndarray) -> np.ndarray:
    """A number for each run of ROWS values, none shared by two bands but by chance."""
    held = values.reshape(-1, ROWS)
    out = np.arange(1, len(held) + 1, dtype=_U) << _U(33)
    for k in range(ROWS):
        out = mixed(out * _U(0x9E3779B97F4A7C15) + held[:, k])
    return out.astype(np.int64)


def marks(values: np.ndarray) -> bytes:
    """A byte of each value, to estimate a similarity from."""
    return (mixed(values) & _U(255)).astype(np.uint8).tobytes()


def estimate(a: bytes, b: bytes) -> float:
    return float((np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)).mean())


def signatures(docs: DataFrame, *, words: int) -> DataFrame:
    """For each row: doc_id, tie (a hash of its text), set_id (128 bits of its set), n (the set's size), bands and marks."""
    source = texts(docs).select("doc_id", F.xxhash64("text").alias("tie"), "text")
    id_type = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, tie long, set_id binary, n long, bands array<long>, marks binary"
    small_batches(docs.sparkSession)
    fields = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            sets = word_sets(batch.column(2), words)
            values = [min_max(s) if len(s) else None for s in sets]
            columns = [
                batch.column(0),
                batch.column(1),
                [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                [len(s) for s in sets],
                [None if v is None else bands(v) for v in values],
                [None if v is None else marks(v) for v in values],
            ]
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, fields, strict=True)], schema=fields
            )

    return source.mapInArrow(run, schema)


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted sets have in common."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    shared = _shared(a, b)
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _with_pivot(rows: list[tuple], percent: int, words: int) -> Iterable[tuple]:
    """An edge from each member to the pivot that it is similar to. Rows: is_pivot, set_id, text."""
    sets = word_sets(pa.array([r[2] for r in rows]), words)
    pivots = {r[1]: s for r, s in zip(rows, sets, strict=True) if r[0]}
    return [(r[1], p) for r, s in zip(rows, sets, strict=True) if not r[0] for p, own in pivots.items() if p != r[1] and _linked(s, own, percent)]


def _to_compare(first: int, second: int, leaf: int, rows: list[tuple], percent: int) -> np.ndarray:
    """The pairs of a block of a bucket that may be links and are not known to hang together. Each pair is
    compared in one block of one bucket: the least bucket that both sets are in.

    Rows: set_id, block, n, marks, leaves, label.
    """
    size = len(rows)
    blocks, n = np.array([r[1] for r in rows]), np.array([r[2] for r in rows], float)
    held = np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(size, -1)
    share = percent / 100
    least = share - DEVIATIONS * np.sqrt(share * (1 - share) / held.shape[1])
    good = np.array([(held == own).mean(axis=1) for own in held]) >= least
    good &= np.minimum.outer(n, n) >= share * np.maximum.outer(n, n) - 1e-6
    labels = np.unique(np.array([r[5] for r in rows], object), return_inverse=True)[1]
    good &= labels[:, None] != labels[None, :]
    good &= np.triu(np.ones((size, size), bool), 1) if first == second else blocks[:, None] < blocks[None, :]
    for i, j in np.argwhere(good):
        if min(set(rows[i][4]).intersection(rows[j][4])) != leaf:
            good[i, j] = False
    return good


def _likely(key: tuple, rows: list[tuple], percent: int) -> Iterable[tuple]:
    leaf, first, second = key
    good = _to_compare(first, second, leaf, rows, percent)
    return [(*key, *r) for r, keep in zip(rows, good.any(axis=0) | good.any(axis=1), strict=True) if keep]


def _links(key: tuple, rows: list[tuple], percent: int, words: int) -> Iterable[tuple]:
    """A spanning forest of the links among a block's sets. Rows as in ``_to_compare``, then text."""
    leaf, first, second = key
    good = _to_compare(first, second, leaf, rows, percent)
    sets = word_sets(pa.array([r[6] for r in rows]), words)
    parent: dict[bytes, bytes] = {}

    def find(label: bytes) -> bytes:
        while parent.get(label, label) != label:
            label = parent[label]
        return label

    out = []
    for i, j in np.argwhere(good):
        a, b = find(rows[i][5]), find(rows[j][5])
        if a != b and _linked(sets[i], sets[j], percent):
            parent[a] = b
            out.append((rows[i][0], rows[j][0]))
    return out


def _blocks(n: Column) -> Column:
    """How many blocks the sets of these sizes make."""
    return F.greatest(F.ceil(F.count(n) / BLOCK_SETS), F.ceil(F.sum(n) / BLOCK_WORDS)).cast("int")


def near_duplicate_classes(
    docs: DataFrame, *, percent: int = PERCENT, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``.

    A text is the set of its distinct runs of ``words`` words, lower-cased A-Z; with fewer words the
    whole sequence is the one run. Rows whose sets have 100 * intersection >= percent * union are
    linked, those with equal sets too; ``component_id`` is the least doc_id that links lead to. A null
    or empty text has an empty set and is linked with nothing. Rows without an id take part; their
    component is that of the others, null if none of them has an id. ``kept`` marks the rows whose own
    id the component has (null for null), so repeated rows are kept together. An empty table gives an
    empty one; other columns are not read.

    Sets that agree in one of 20 bands of four values are candidates: of links at the threshold, one
    in 40,000 shares no band. Buckets are first compared with one of their sets, which joins groups of
    near copies in linear time; only buckets that still hold several components are compared pair by
    pair, in blocks, over all of the bucket. Every link is confirmed on the whole sets.
    """
    source = texts(docs, id_col, text_col)
    staging = Staging(docs.sparkSession, "minmax")
    rows = staging.write(signatures(source, words=words), "signatures")
    classes = staging.write(
        rows.where("n > 0").groupBy("set_id").agg(
            F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "tie")).alias("row"),
            F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("marks").alias("marks"),
        ).withColumn("number", F.xxhash64("set_id")),
        "sets",
    )
    placed = classes.select("set_id", "number", "n", F.explode("bands").alias("leaf"))
    buckets = placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("size"), F.min("number").alias("pivot")).where("size > 1")
    members = staging.write(placed.join(buckets, "leaf").select("leaf", "set_id", "number", "n", "pivot"), "members")

    # The texts of sets that share a bucket with another: moved once.
    wanted = classes.join(members.select("set_id").distinct(), "set_id", "left_semi").select("set_id", "number", "n", "marks", "row.*")
    body = source.select(F.col("doc_id").alias("own_id"), F.xxhash64("text").alias("own_tie"), "text")
    found = body.join(wanted.select("set_id", "number", "doc_id", "tie"), F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_tie") == F.col("tie")))
    bodies = staging.write(found.dropDuplicates(["set_id"]).select("set_id", "number", "text"), "texts")

    # Each set with the pivot it shares most bands with.
    choice = members.where("number != pivot").groupBy("set_id", "pivot").agg(F.count(F.lit(1)).alias("times"))
    choice = choice.groupBy("set_id").agg(F.max(F.struct("times", "pivot")).alias("best")).select("set_id", "best.pivot")
    choice = staging.write(choice.join(classes.select("set_id", "n"), "set_id"), "choice")
    counts = choice.groupBy("pivot").agg(_blocks(F.col("n")).alias("blocks"))
    dealt = choice.join(counts, "pivot").select("pivot", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int").alias("block"), "set_id")
    stars = dealt.join(bodies, "set_id").select("pivot", "block", F.lit(False).alias("is_pivot"), "set_id", "text")
    centres = dealt.select("pivot", "block").distinct().join(bodies, F.col("pivot") == F.col("number"))
    stars = stars.unionByName(centres.select("pivot", "block", F.lit(True).alias("is_pivot"), "set_id", "text"))
    edges = staging.write(
        grouped(stars, ["pivot", "block"], "u binary, v binary", lambda _, r: _with_pivot(r, percent, words)), "stars"
    )
    first = components(edges, Staging(docs.sparkSession, "minmax-stars"))

    # What is left: buckets with several components. The pivot's component is compared with the others only.
    label = F.coalesce("v", "set_id")
    labelled = staging.write(members.join(first.withColumnRenamed("u", "set_id"), "set_id", "left").select("leaf", "set_id", "number", "n", "pivot", label.alias("label")), "labels")
    spread = labelled.groupBy("leaf").agg(
        F.min(F.xxhash64("label")).alias("low"), F.max(F.xxhash64("label")).alias("high"), F.max(F.when(F.col("number") == F.col("pivot"), F.col("label"))).alias("of_pivot")
    )
    left = labelled.join(spread.where("low != high").select("leaf", "of_pivot"), "leaf")
    left = staging.write(left.select("leaf", "set_id", "n", "label", (F.col("label") == F.col("of_pivot")).alias("main")), "open")
    sizes = left.groupBy("leaf").agg(_blocks(F.when(F.col("main"), F.col("n"))).alias("mains"), _blocks(F.when(~F.col("main"), F.col("n"))).alias("others"))
    lists = left.groupBy("set_id").agg(F.collect_list("leaf").alias("leaves"))
    every = F.sequence(F.lit(0), F.col("mains") + F.col("others") - 1)
    spot = F.xxhash64("set_id")
    pairs = (
        left.join(sizes, "leaf")
        .withColumn("block", F.when(F.col("main"), F.pmod(spot, F.col("mains"))).otherwise(F.col("mains") + F.pmod(spot, F.col("others"))).cast("int"))
        .withColumn("other", F.explode(F.when(F.col("main"), F.slice(every, F.col("mains") + 1, F.col("others"))).otherwise(every)))
        .join(lists, "set_id")
        .join(classes.select("set_id", "marks"), "set_id")
        .select("leaf", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "set_id", "block", "n", "marks", "leaves", "label")
    )
    keys, schema = ["leaf", "a", "b"], "leaf long, a int, b int, set_id binary, block int, n long, marks binary, leaves array<long>, label binary"
    likely = staging.write(grouped(pairs, keys, schema, lambda k, r: _likely(k, r, percent)), "likely")
    more = staging.write(
        grouped(likely.join(bodies.select("set_id", "text"), "set_id").select(*likely.columns, "text"), keys, "u binary, v binary", lambda k, r: _links(k, r, percent, words)),
        "links",
    )

    joined = components(edges.unionByName(more), Staging(docs.sparkSession, "minmax-all"))
    sets = classes.select("set_id", "least").join(joined.withColumnRenamed("u", "set_id"), "set_id", "left").withColumn("root", F.coalesce("v", "set_id"))
    named = sets.groupBy("root").agg(F.min("least").alias("component_id"))
    members = sets.join(named, "root").select("set_id", "component_id")
    linked = rows.where("n > 0").select("doc_id", "n", "set_id").join(members, "set_id").select("doc_id", "n", "component_id")
    alone = rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )

"""N-gram Jaccard join by chosen paths: sets are split on sampled shared tokens until buckets are small."""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.session import Staging

from .common import fresh_names, grouped, map_columns, texts
from .components import components

WORDS = 5
SIMILARITY = 0.8
TARGET_RECALL = 0.9995
# Children of a node at each level: below the first, a bucket over SMALL sets is split again.
BRANCHES = (1, 2, 1)
SMALL = 64
# Buckets that the last level leaves large are compared in blocks of so many sets.
BLOCK = 512
# Bytes of the sketch that rules out pairs before their sets are fetched, and the deviations allowed for.
SKETCH, DEVIATIONS = 128, 4.5

_ODD = np.uint64(0x9E3779B97F4A7C15)


def runs_for(similarity: float = SIMILARITY, target: float = TARGET_RECALL) -> int:
    """How many runs find a pair of just that similarity with the target's probability, if all levels are needed."""
    found = 1.0
    for branches in reversed(BRANCHES):
        found = 1 - (1 - similarity * found) ** branches
    return math.ceil(math.log(1 - target) / math.log(1 - found))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def shingles(text: str, hashes: dict[str, int], size: int = WORDS) -> np.ndarray:
    """The set of hashed runs of ``size`` words, sorted. Fewer words are one run; no words are the empty set."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    for word in words:
        if word not in hashes:
            hashes[word] = xxhash.xxh3_64_intdigest(word)
    values = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    n = len(words) - width + 1
    out = np.full(n, np.uint64(width))
    for i in range(width):
        out = out * _ODD + values[i : i + n]
    return np.unique(_mixed(out))


def _least(tokens: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """For each seed, the least of the tokens' hashes under it; tokens are taken in parts to bound memory."""
    odd = _mixed(seeds) | np.uint64(1)
    best = np.full(len(seeds), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(tokens), 4096):
        best = np.minimum(best, (tokens[at : at + 4096, None] * odd).min(axis=0))
    return best


def paths(tokens: np.ndarray, runs: int) -> np.ndarray:
    """The nodes a set passes, by run: the first level's, then the others' in turn.

    At a node, each child samples a token of the set by a hash that the node seeds; sets that share
    the sampled token share the child.
    """
    nodes = seeds = np.arange(1, runs + 1, dtype=np.uint64)[:, None] << np.uint64(40)
    out = []
    for branches in BRANCHES:
        seeds = np.repeat(nodes, branches, axis=1) + np.tile(np.arange(branches, dtype=np.uint64), nodes.shape[1])
        chosen = _least(tokens, seeds.ravel()).reshape(seeds.shape)
        nodes = _mixed(chosen ^ _mixed(seeds))
        out.append(nodes)
    return np.concatenate(out, axis=1)


_SKETCH_SEEDS = np.arange(1, SKETCH + 1, dtype=np.uint64) << np.uint64(20)


def sketch(tokens: np.ndarray) -> bytes:
    """A byte of each of SKETCH least hashes; two sets agree in about the share of bytes of their similarity."""
    return (_mixed(_least(tokens, _SKETCH_SEEDS)) & np.uint64(255)).astype(np.uint8).tobytes()


def signatures(docs: DataFrame, *, words: int, runs: int) -> DataFrame:
    """For each row: doc_id, tie (a hash of its text), set_id (of its set), n (its size), paths and sketch.

    Rows whose set is empty have neither.
    """
    source = texts(docs).withColumn("tie", F.xxhash64("text"))

    def make():
        hashes: dict[str, int] = {}

        def work(ids, batch, ties):
            if len(hashes) > 200_000:
                hashes.clear()
            out = []
            for doc, text, tie in zip(ids, batch, ties, strict=True):
                tokens = shingles(text, hashes, words)
                own = (paths(tokens, runs).astype(np.int64).ravel(), sketch(tokens)) if len(tokens) else (None, None)
                out.append((doc, tie, xxhash.xxh3_128_digest(tokens.tobytes()), len(tokens), *own))
            return [list(c) for c in zip(*out, strict=True)] or [[]] * 6

        return work

    id_type = source.schema["doc_id"].dataType.simpleString()
    return map_columns(source, f"doc_id {id_type}, tie long, set_id binary, n int, paths array<long>, sketch binary", make)


def _leaves(sets: DataFrame, runs: int, staging: Staging) -> DataFrame:
    """(leaf, set_id, size) of the buckets in which sets are compared: those of two sets and more.

    A bucket of up to SMALL sets is a leaf; larger ones are split into their children, and those of
    the last level are leaves whatever their size. All sets of a bucket agree on that, as it hangs on
    the bucket's count alone.
    """
    width = sum(math.prod(BRANCHES[: i + 1]) for i in range(len(BRANCHES)))
    # Each run's nodes level by level: below[l] lists the columns of level l's nodes.
    levels, at = [], 0
    for i in range(len(BRANCHES)):
        size = math.prod(BRANCHES[: i + 1])
        levels.append(list(range(at, at + size)))
        at += size

    def node(run: int, column: int) -> Column:
        return F.element_at("paths", run * width + column + 1)

    # The nodes of a level's subtree, as nested arrays: [node, [child, ...], ...].
    def subtree(run: int, level: int, k: int) -> Column:
        kids = [subtree(run, level + 1, k * BRANCHES[level + 1] + j) for j in range(BRANCHES[level + 1])] if level + 1 < len(BRANCHES) else []
        own = [node(run, levels[level][k]).alias("node")]
        return F.struct(*own, F.array(*kids).alias("kids")) if kids else F.struct(*own)

    rows = sets.select("set_id", F.explode(F.array(*(subtree(r, 0, 0) for r in range(runs)))).alias("at"))
    found = []
    for level in range(len(BRANCHES)):
        rows = staging.write(rows, f"level-{level}")
        sizes = rows.groupBy(F.col("at.node").alias("leaf")).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        sized = rows.withColumn("leaf", F.col("at.node")).join(sizes, "leaf")
        last = level + 1 == len(BRANCHES)
        found.append((sized if last else sized.where(F.col("size") <= SMALL)).select("leaf", "set_id", "size"))
        if not last:
            rows = sized.where(F.col("size") > SMALL).select("set_id", F.explode("at.kids").alias("at"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    # Two children may sample the same token of a set.
    return out.distinct()


def _met_before(leaf: int, leaves: list[list[int]]) -> np.ndarray:
    """Whether two sets share a leaf of a lower number, where they are compared instead."""
    lower = [[k for k in own if k < leaf] for own in leaves]
    number = {k: i for i, k in enumerate({k for own in lower for k in own})}
    held = np.zeros((len(leaves), len(number)), np.float32)
    for i, own in enumerate(lower):
        held[i, [number[k] for k in own]] = 1
    return held @ held.T > 0


def _compared(first: int, second: int, blocks: np.ndarray) -> np.ndarray:
    """The pairs that this pair of blocks is to compare, each in both directions."""
    n = len(blocks)
    if first == second:
        return ~np.eye(n, dtype=bool)
    return blocks[:, None] != blocks[None, :]


def _likely(key: tuple, rows: list[tuple], similarity: float) -> Iterable[tuple]:
    """Of a bucket's sets, those with a partner that their sizes and sketches allow and that they do not meet elsewhere."""
    leaf, first, second = key
    blocks, n = np.array([r[1] for r in rows]), np.array([r[2] for r in rows], float)
    marks = np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(len(rows), SKETCH)
    agree = np.array([(marks == own).mean(axis=1) for own in marks])
    least = similarity - DEVIATIONS * math.sqrt(similarity * (1 - similarity) / SKETCH)
    good = (agree >= least) & (np.minimum.outer(n, n) >= similarity * np.maximum.outer(n, n))
    good &= _compared(first, second, blocks) & ~_met_before(leaf, [r[4] for r in rows])
    return [(*key, r[0], r[1], r[4], r[5], r[6]) for r, keep in zip(rows, good.any(axis=1), strict=True) if keep]


def similar(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Which pairs of sets have the Jaccard similarity or more; exact, from counts of shared tokens."""
    sizes = np.array([len(s) for s in sets], float)
    owner = np.repeat(np.arange(len(sets)), sizes.astype(int))
    _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    kept = times[token] > 1
    owner, token = owner[kept], token[kept]
    number = np.cumsum(times > 1) - 1
    token = number[token]
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(token[-1]) + 1 if len(token) else 0, 4096):
        low, high = np.searchsorted(token, [at, at + 4096])
        held = np.zeros((len(sets), 4096), np.float32)
        held[owner[low:high], token[low:high] - at] = 1
        shared += held @ held.T
    union = sizes[:, None] + sizes[None, :] - shared
    return shared >= similarity * union - 1e-6


def _verified(key: tuple, rows: list[tuple], similarity: float, words: int) -> Iterable[tuple]:
    """For each set of a bucket with links: how many, and one edge to the least set it hangs together with."""
    leaf, first, second = key
    rows = list({r[0]: r for r in rows}.values())
    hashes: dict[str, int] = {}
    linked = similar([shingles(r[3], hashes, words) for r in rows], similarity)
    linked &= _compared(first, second, np.array([r[1] for r in rows])) & ~_met_before(leaf, [r[2] for r in rows])
    degrees = linked.sum(axis=1)
    ids = [r[0] for r in rows]
    order = sorted(range(len(rows)), key=lambda i: ids[i])
    root = [-1] * len(rows)
    for start in order:
        if root[start] < 0:
            root[start], front = start, [start]
            while front:
                for j in np.flatnonzero(linked[front.pop()]).tolist():
                    if root[j] < 0:
                        root[j] = start
                        front.append(j)
    return [(ids[i], ids[root[i]], int(degrees[i])) for i in range(len(rows)) if degrees[i]]


def _joined(docs: DataFrame, similarity: float, words: int, target_recall: float) -> tuple[DataFrame, DataFrame]:
    """The signatures of all rows; and for every set its component's root, its first row, its least id, n_links and n_copies."""
    runs = runs_for(similarity, target_recall)
    staging = Staging(docs.sparkSession, "jaccard")
    rows = staging.write(signatures(docs, words=words, runs=runs), "signatures")
    classes = staging.write(
        rows.groupBy("set_id").agg(
            F.min(F.struct("doc_id", "tie")).alias("row"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n_copies"),
            F.first("n").alias("n"), F.first("paths").alias("paths"), F.first("sketch").alias("sketch"),
        ),
        "sets",
    )
    sets = classes.where("n > 0")
    leaves = staging.write(_leaves(sets, runs, staging), "leaves")
    # At most runs times the last level's nodes: a short list.
    lists = leaves.groupBy("set_id").agg(F.sort_array(F.collect_list(F.struct("leaf", "size"))).alias("own"))
    number = F.ceil(F.col("size") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")
    dealt = (
        sets.select("set_id", "n", "sketch", "row")
        .join(lists, "set_id")
        .withColumn("leaves", F.col("own.leaf"))
        .withColumn("own", F.explode("own"))
        .select("set_id", "n", "sketch", "leaves", "row.*", "own.*")
        .withColumn("blocks", number)
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("leaf", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "set_id", "block", "n", "sketch", "leaves", "doc_id", "tie")
    )
    keys = ["leaf", "a", "b"]
    id_type = docs.schema["doc_id"].dataType.simpleString()
    likely = staging.write(
        grouped(dealt, keys, f"leaf long, a int, b int, set_id binary, block int, leaves array<long>, doc_id {id_type}, tie long", lambda k, r: _likely(k, r, similarity)),
        "likely",
    )
    body = docs.select(F.col("doc_id").alias("__doc"), F.xxhash64("text").alias("__tie"), "text")
    fetched = likely.join(body, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("tie") == F.col("__tie")))
    links = staging.write(
        grouped(
            fetched.select(*keys, "set_id", "block", "leaves", "text"), keys, "set_id binary, root binary, links long",
            lambda k, r: _verified(k, r, similarity, words),
        ),
        "links",
    )
    joined = components(links.select(F.col("set_id").alias("u"), F.col("root").alias("v")), staging)
    counted = links.groupBy("set_id").agg(F.sum("links").alias("n_links"))
    members = (
        classes.select("set_id", "row", "least", "n_copies")
        .join(joined.withColumnRenamed("u", "set_id"), "set_id", "left")
        .join(counted, "set_id", "left")
        .select("set_id", F.coalesce("v", "set_id").alias("root"), "row", "least", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )
    return rows, staging.write(members, "members")


def near_duplicates(
    docs: DataFrame, *, similarity: float = SIMILARITY, words: int = WORDS, target_recall: float = TARGET_RECALL, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, class_id, n_links and n_copies for every row of ``docs``.

    Texts are sets of runs of ``words`` lower-cased words. Rows with equal sets (empty ones too) are
    copies: they are one set, which is searched once. ``n_links`` counts the other sets at least as
    similar as ``similarity``, ``class_id`` is the least doc_id among all rows that links and copies
    hold together (null only if they have none). Pairs are verified exactly; one that is that similar
    is found with ``target_recall`` or more. A pair is compared in one bucket only, and buckets give
    counts and a spanning forest, never their pairs.
    """
    rows, members = _joined(texts(docs, id_col, text_col), similarity, words, target_recall)
    named = members.groupBy("root").agg(F.min("least").alias("class_id"))
    found = members.join(named, "root").select("set_id", "class_id", "n_links", "n_copies")
    return rows.select("doc_id", "set_id").join(found, "set_id").select("doc_id", "class_id", "n_links", "n_copies")


def drop_near_duplicates(
    docs: DataFrame, *, similarity: float = SIMILARITY, words: int = WORDS, target_recall: float = TARGET_RECALL, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of ``docs`` for each class of ``near_duplicates``: its least doc_id's, rows without an id first. Columns as they are."""
    _, members = _joined(texts(docs, id_col, text_col), similarity, words, target_recall)
    # Keys without nulls, so that the join's partitioning and order serve to drop repeated rows too.
    key_id, key_tie = keys = fresh_names(docs, "__id", "__tie")
    kept = members.groupBy("root").agg(F.min("row").alias("row")).select(
        F.coalesce(F.col("row.doc_id").cast("string"), F.lit("")).alias(key_id), F.col("row.tie").alias(key_tie)
    )
    own = {key_id: F.coalesce(F.col(id_col).cast("string"), F.lit("")), key_tie: F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))}
    return docs.withColumns(own).join(kept, keys, "left_semi").dropDuplicates(keys).select(*docs.columns)

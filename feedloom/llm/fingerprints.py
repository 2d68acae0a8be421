"""Content-defined chunking: normalised gear-hash boundaries and chunk digest sets weighted by length."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import map_columns, small_batches, texts

# Chunk sizes in bytes. Up to NORMAL a boundary needs HARD_BITS zero bits, beyond it EASY_BITS.
LEAST, NORMAL, MOST = 32, 64, 256
HARD_BITS, EASY_BITS = 7, 5
# Ranges of the id for each shuffle partition: more of them even out what one partition gets.
RANGES = 4

GEAR = np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=4).digest(), "little") for b in range(256)], np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """At each byte, the gear hash of the 32 bytes that end there: sum of GEAR[byte] << age."""
    h = GEAR[data]
    for width in (1, 2, 4, 8, 16):
        if len(h) > width:
            h[width:] += h[:-width] << np.uint32(width)
    return h


def chunk_ends(batch: list[bytes]) -> list[list[int]]:
    """The ends of each text's chunks. A chunk has at least LEAST bytes, as many as the hash looks
    back on, so a boundary depends on its own text only, and on the bytes just before it."""
    top = gear_hashes(np.frombuffer(b"".join(batch), np.uint8)) >> np.uint32(32 - HARD_BITS)
    easy = np.flatnonzero(top < 1 << (HARD_BITS - EASY_BITS))
    hard = top[easy] == 0
    places, strict = easy.tolist(), hard.tolist()
    out, k, base = [], 0, 0
    for text in batch:
        end, start, ends = base + len(text), base, []
        least, normal, most = start + LEAST, start + NORMAL, start + MOST
        while k < len(places) and places[k] < end:
            cut = places[k] + 1
            if cut > most:
                start = most
            elif cut < least or cut <= normal and not strict[k]:
                k += 1
                continue
            else:
                start = cut
                k += 1
            ends.append(start - base)
            least, normal, most = start + LEAST, start + NORMAL, start + MOST
        while start + MOST < end:
            start += MOST
            ends.append(start - base)
        if start < end:
            ends.append(end - base)
        out.append(ends)
        base = end
    return out


def chunk_sets(batch: list[str]) -> list[dict[int, int]]:
    """Each text's chunk digests and their lengths in bytes; repeated chunks count once."""
    data = [text.encode("utf-8", "surrogatepass") for text in batch]
    out = []
    for text, ends in zip(data, chunk_ends(data), strict=True):
        start, own = 0, {}
        for end in ends:
            own[xxhash.xxh3_64_intdigest(text[start:end])] = end - start
            start = end
        out.append(own)
    return out


def containment(own: dict[int, int], other: dict[int, int]) -> float:
    """The share of ``own``'s bytes whose chunks are in ``other``; an empty set is contained in anything empty only."""
    total = sum(own.values())
    if not total:
        return float(not other)
    return sum(length for digest, length in own.items() if digest in other) / total


def written(chunks: dict[int, int]) -> str:
    """A fingerprint as text: digest:length, by digest; empty for an empty text."""
    return ",".join(f"{digest:016x}:{length}" for digest, length in sorted(chunks.items()))


def fingerprint_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint of every row; a null text counts as empty, an empty one has the empty fingerprint."""
    source = texts(docs, id_col, text_col)

    def make():
        return lambda ids, batch: (ids, [written(c) for c in chunk_sets(batch)])

    return map_columns(source, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, fingerprint string", make)


def _ranges(docs: DataFrame, key: Column, parts: int) -> tuple[Column, int]:
    """The number of the row's range of keys, out of about ``parts`` of equal size, and how many there are."""
    probabilities = [i / parts for i in range(1, parts)]
    bounds = sorted(set(docs.select(key.alias("k")).approxQuantile("k", probabilities, 1 / (8 * parts))))
    bounds = [min(int(b), (1 << 63) - 1) for b in bounds]
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    if not groups:
        return F.lit(0), 1

    def passed(values) -> Column:
        return F.size(F.filter(values, lambda b: b <= key))

    # Two short searches instead of one through all bounds.
    coarse = passed(F.array(*(F.lit(g[0]).cast("long") for g in groups)))
    fine = F.element_at(F.array(*(F.array(*(F.lit(b).cast("long") for b in g)) for g in groups)), F.greatest(coarse, F.lit(1)))
    return F.greatest(coarse - 1, F.lit(0)) * step + passed(fine), len(bounds) + 1


def with_next(docs: DataFrame, schema: str, work, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``work(ids, texts, next_texts)`` over batches of documents, each with the next one by ascending id.

    After the last comes the first. Null ids come first; rows of one id follow each other by the
    hash of their text. Texts move once: rows are dealt over ranges of the id, and the first row of
    each range is also sent to the range before. A single document is its own next.
    """
    spark = docs.sparkSession
    small_batches(spark)
    lowest = -(1 << 63)
    source = texts(docs, id_col, text_col).withColumns(
        {"__key": F.coalesce(F.col("doc_id").cast("long"), F.lit(lowest)), "__tie": F.xxhash64("text")}
    )
    narrow = source.select("__key", "__tie")
    parts = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucket, _ = _ranges(narrow, F.col("__key"), parts)
    source, narrow = source.withColumn("__range", bucket), narrow.withColumn("__range", bucket)
    # One row a range, of which there are as many as ``parts``.
    firsts = narrow.groupBy("__range").agg(F.min(F.struct("__key", "__tie")).alias("f")).select("__range", "f.*").collect()
    firsts.sort(key=lambda r: r["__range"])
    before = [(r["__key"], r["__tie"], firsts[i - 1]["__range"]) for i, r in enumerate(firsts)]
    to = F.broadcast(spark.createDataFrame(before, "__key long, __tie long, __to int"))
    places = F.array(F.struct(F.col("__range").alias("r"), F.lit(0).alias("copy")))
    copies = F.array(F.struct(F.col("__to").alias("r"), F.lit(1).alias("copy")))
    dealt = (
        source.join(to, ["__key", "__tie"], "left")
        .withColumn("__p", F.explode(F.when(F.col("__to").isNull(), places).otherwise(F.concat(places, copies))))
        .select(F.col("__p.r").alias("__range"), F.col("__p.copy").alias("__copy"), "__key", "__tie", "doc_id", "text")
        .repartition(parts // RANGES, "__range")
        .sortWithinPartitions("__range", "__copy", "__key", "__tie")
        .select("__range", "__copy", "doc_id", "text")
    )
    fields = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterable[pa.RecordBatch]):
        held = None
        for batch in batches:
            ids, own, following = [], [], []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # Of repeated rows that all came as copies, the first is the next document.
                if held is not None and held[0] == row[0] and not held[1]:
                    ids.append(held[2])
                    own.append(held[3])
                    following.append(row[3])
                held = row
            out = work(ids, own, following)
            yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(out, fields, strict=True)], schema=fields)

    return dealt.mapInArrow(run, schema)


def edited(text: str, following: str) -> str:
    """``text`` with its last half, rounded down, replaced by as many characters of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints_of_edits(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint beside that of its edited text, and how much of it they share.

    ``near_edited`` and ``near_next`` are the length-weighted containment of the document's chunks
    in the edited text's and in the next document's: 1 for equal texts, 0 where no chunk is shared.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {id_type}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def work(ids, own, following):
        changed = [edited(a, b) for a, b in zip(own, following, strict=True)]
        sets, changed_sets = chunk_sets(own), chunk_sets(changed)
        # Most often the next document is the next row.
        next_sets = [
            sets[i + 1] if i + 1 < len(own) and own[i + 1] == text else chunk_sets([text])[0] for i, text in enumerate(following)
        ]
        return (
            ids,
            [len(t) for t in own],
            [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
            [written(s) for s in sets],
            [written(s) for s in changed_sets],
            [containment(a, b) for a, b in zip(sets, changed_sets, strict=True)],
            [containment(a, b) for a, b in zip(sets, next_sets, strict=True)],
        )

    return with_next(docs, schema, work, id_col=id_col, text_col=text_col)

"""Power-of-two packing: documents cut into pieces of binary lengths, equal lengths bucketed."""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import Staging

from .common import kept, map_columns, texts

TOKENIZER = "word_bpe_49k.json"
MAX_TOKENS = 4096
END_ID = 2
# Words of up to WORD_CHARS characters are remembered by a worker, the latest CACHED_WORDS to twice as many.
WORD_CHARS = 64
CACHED_WORDS = 200_000
# Words that are encoded as one text.
JOINED_WORDS = 500


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


class _Recent:
    """A bounded table: entries not asked for while ``size`` others came in are forgotten."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def missing(self, keys: Iterable[str]) -> list[str]:
        out = []
        for key in keys:
            if key in self.new:
                continue
            if key in self.old:
                self.new[key] = self.old[key]
            else:
                out.append(key)
        return out

    def turn(self) -> None:
        if len(self.new) > self.size:
            self.old, self.new = self.new, {}


# Letters and then signs: the vocabulary splits between them, and its merges never cross the split.
_LETTERS_SIGNS = re.compile(r"([^\W\d_]+)([.,;:!?|*&%$#)\]}\"]+)")


def _gathered(found: list[bytes], index: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """The ids of texts whose words are given by number, from the ids of each distinct word."""
    ids, sizes = np.frombuffer(b"".join(found), "<u4"), np.array([len(f) // 4 for f in found], np.int64)
    first = np.cumsum(sizes) - sizes
    counts = sizes[index]
    ends = np.concatenate([[0], np.cumsum(counts)])
    data = ids[np.repeat(first[index] - ends[:-1], counts) + np.arange(ends[-1])].tobytes() if len(index) else b""
    at = (4 * ends[offsets - offsets[0]]).tolist()
    return [data[a:b] for a, b in zip(at, at[1:], strict=False)]


def word_encoder(path: str):
    """:func:`_word_encoder` as the worker keeps it while its tasks encode."""
    return kept(("word_encoder", path), lambda: _word_encoder(path))


def _word_encoder(path: str):
    """A function from texts to their ids as bytes of little-endian unsigned 32-bit numbers.

    The vocabulary lowers case and never joins characters across a space or line end, so a text's
    ids are those of its words in turn. Strings of special tokens in a text are ordinary text.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    known = _Recent(CACHED_WORDS)

    def direct(fresh: list[str]):
        """Pairs of words and ids. Words of letters are encoded as one text, each of them being one of its words."""
        plain, others = [], []
        for word in fresh:
            (plain if word.isalpha() and len(word) <= WORD_CHARS else others).append(word)
        for at in range(0, len(plain), JOINED_WORDS):
            part = plain[at : at + JOINED_WORDS]
            found = tokenizer.encode(" ".join(part), add_special_tokens=False)
            owners = np.array(found.word_ids, np.int64)
            edges = np.searchsorted(owners, np.arange(len(part) + 1)).tolist()
            # Letters that the vocabulary does not take for such make more words than were given.
            if len(owners) and owners[-1] + 1 == len(part):
                data = np.array(found.ids, "<u4").tobytes()
                yield from ((word, data[4 * a : 4 * b]) for word, a, b in zip(part, edges, edges[1:], strict=False))
            else:
                others += part
        for key, found in zip(others, tokenizer.encode_batch_fast(others, add_special_tokens=False), strict=True):
            yield key, array("I", found.ids).tobytes()

    def encode(batch: list[str]) -> list[bytes]:
        # Where lowering is not letter by letter, it is left to the tokenizer.
        lowered = [(text if "\u03a3" in text or "\u0130" in text else text.lower()).replace("\n", " ") for text in batch]
        # Each batch's distinct words are looked up once; the words themselves stay numbers.
        split = pc.split_pattern(pa.array(lowered, pa.large_string()), " ")
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        fresh = known.missing(words)
        # Long words are encoded whole, so that nothing of them is kept.
        pairs = {word: found.groups() for word in fresh if len(word) <= WORD_CHARS and (found := _LETTERS_SIGNS.fullmatch(word))}
        keys = {word for word in fresh if word not in pairs}
        known.new.update(direct([*keys, *known.missing(set().union(*pairs.values()) - keys)]))
        table = known.new
        for word, (letters, signs) in pairs.items():
            table[word] = table[letters] + table[signs]
        found = [table[word] for word in words]
        for word in fresh:
            if len(word) > WORD_CHARS:
                del table[word]
        known.turn()
        return _gathered(found, coded.indices.to_numpy(), split.offsets.to_numpy())

    return encode


def binary_lengths(total: int, most: int) -> list[int]:
    """``total`` as multiples of ``most`` and then falling powers of two."""
    rest = total % most
    return [most] * (total // most) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def cut_documents(
    docs: DataFrame,
    *,
    tokenizer: str | None = None,
    max_tokens: int = MAX_TOKENS,
    end_id: int = END_ID,
    with_ids: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens and, if asked for, ids.

    Every document ends in ``end_id``, so a null or empty text is one piece of length 1. Repeated
    rows are packed as often as they occur.
    """
    if max_tokens & (max_tokens - 1) or max_tokens < 1:
        raise ValueError("max_tokens must be a power of two")
    path = tokenizer or default_tokenizer()
    end = np.array([end_id], "<u4").tobytes()
    source = texts(docs, id_col, text_col)
    id_type = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long"

    def make():
        encode = word_encoder(path)

        def work(ids, batch):
            out = [[], [], [], [], [], []]
            for doc, found in zip(ids, encode(batch), strict=True):
                data = found + end
                total, start = len(data) // 4, 0
                for length in binary_lengths(total, max_tokens):
                    piece = data[4 * start : 4 * (start + length)]
                    row = (doc, start, length, zlib.crc32(piece), total, np.frombuffer(piece, "<u4").astype(np.int32) if with_ids else None)
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                    start += length
            return out if with_ids else out[:5]

        return work

    return map_columns(source, schema + (", ids array<int>" if with_ids else ""), make)


def pack_power_of_two(docs: DataFrame, **options) -> DataFrame:
    """Pieces of ``cut_documents`` with the sequence that holds each: sequence_id and offset.

    A piece is as long as a power of two, so it is a sequence by itself: offset is 0, there is no
    padding, and no sequence crosses documents. Sequences of one length have consecutive ids,
    longest first, so a batch of equal lengths is a range of ids. The pieces are staged, longest
    first in each file; a sequence's id is the number of rows of its length in earlier files, added
    to its place in its own. Only counts by file and length are summed and joined. An empty table gives no rows.
    """
    spark = docs.sparkSession
    pieces = cut_documents(docs, **options).sortWithinPartitions(F.desc("length"))
    staged = Staging(spark, "packing")
    staged.write(pieces, "pieces")
    rows = (
        spark.read.schema(pieces.schema)
        .parquet(f"{staged.path}/pieces")
        .withColumns({"__file": F.col("_metadata.file_path"), "__row": F.col("_metadata.row_index")})
    )
    counts = rows.groupBy("length", "__file").agg(F.count(F.lit(1)).alias("__n"), F.min("__row").alias("__first"))
    # A row for each file and length, written down so that the planner knows whether it is small.
    counts = staged.write(counts, "counts")
    earlier = Window.partitionBy("length").orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    longer = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    # One row for each length that there is, 13 at most.
    lengths = counts.groupBy("length").agg(F.sum("__n").alias("__all"))
    lengths = lengths.select("length", F.coalesce(F.sum("__all").over(longer), F.lit(0)).alias("__longer"))
    before = F.coalesce(F.sum("__n").over(earlier), F.lit(0)) + F.col("__longer")
    runs = counts.join(lengths, "length").select("length", "__file", "__first", before.alias("__before"))
    return rows.join(staged.write(runs, "runs"), ["length", "__file"]).select(
        *(c for c in pieces.columns),
        (F.col("__before") + F.col("__row") - F.col("__first")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )

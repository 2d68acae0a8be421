"""Secret scans: known forms, and strings that a tokenizer's vocabulary finds improbable."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame

from .common import map_columns, texts

VOCABULARY = "byte_bpe_50k.tiktoken"

# Strings of MIN_CHARS and more are put to the test. A string is random below this many characters a
# token: by the least length each bound holds from, first for strings of letters, alone or joined by
# signs, then for all others. Short words, and invented ones above all, take nearly as many tokens
# as random letters do, so the shorter a string is the fewer characters a token it may have.
MIN_CHARS = 8
LETTER_BOUNDS = ((20, 2.1), (16, 1.55), (8, 1.2))
MIXED_BOUNDS = ((16, 2.3), (8, 1.6))
# Of joined letters, groups from this length on count.
MIN_GROUP = 4
# A worker remembers so many strings of at most so many characters.
REMEMBERED, REMEMBERED_CHARS = 200_000, 64
# Longer strings are put to the vocabulary in parts of this length.
PART_CHARS = 512

KINDS = ("assign", "access", "hex", "entropy")

_ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A run that is too short fails whole, so a hit begins where its run does.
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_WORD = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
_LONG = re.compile(r"[0-9a-f]{24}")

# Lengths in hex digits of md5, sha1, sha224, sha256, sha384 and sha512.
DIGEST_LENGTHS = frozenset({32, 40, 56, 64, 96, 128})
_ALL_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_NAMED_DIGEST = re.compile(r"(?:md5|sha-?(?:1|224|256|384|512)|git|commit|checksum|digest|etag|integrity)[^A-Za-z0-9]{1,3}$", re.IGNORECASE)
_UUID = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}(?![0-9A-Fa-f])")
_SIGNS = re.compile(r"[+/_=-]+")
# A part of a name: letters of one case, a short number, words told apart by capitals.
_NAME = re.compile(r"[a-z]+|[A-Z]+|[0-9]{1,4}|[a-z]*(?:[A-Z][a-z]+)+[0-9]{0,3}")
_GROUP = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed kinds, each leftmost and not overlapping within its kind."""
    found = [(m.start(), "assign", m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    found += [(m.start(), "access", m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if _LONG.search(text):
        found += [(m.start(), "hex", m.end()) for m in _HEX.finditer(text)]
    return found


def _below(bounds: tuple[tuple[int, float], ...], chars: int, tokens: int) -> bool:
    """Whether so many characters in so many tokens are random by the bound for that length."""
    return next((chars < bound * tokens for least, bound in bounds if chars >= least), False)


def _is_random(word: str, tokens: Callable[[str], int]) -> bool:
    """The token test. Names, words joined by signs or capitals, are judged by their groups of letters."""
    # Repeats of a few characters, rules of signs among them.
    if 3 * len(set(word)) < min(len(word), 24):
        return False
    parts = [part for part in _SIGNS.split(word) if part]
    if all(map(_NAME.fullmatch, parts)):
        groups = [g for part in parts for g in _GROUP.findall(part) if len(g) >= MIN_GROUP]
        return _below(LETTER_BOUNDS, sum(map(len, groups)), sum(map(tokens, groups)))
    if word.isdigit():
        return False
    return _below(MIXED_BOUNDS, len(word), tokens(word))


def _strings(word: str) -> list[tuple[int, int]]:
    """The parts of a string that are no UUID: all of it, or what stands before, between and after UUIDs without its outer signs."""
    cuts = [m.span() for m in _UUID.finditer(word)]
    if not cuts:
        return [(0, len(word))]
    out, at = [], 0
    for start, end in [*cuts, (len(word), len(word))]:
        part = word[at:start]
        left = at + len(part) - len(part.lstrip("+/_=-"))
        out.append((left, left + len(part.strip("+/_=-"))))
        at = end
    return [(a, b) for a, b in out if b - a >= MIN_CHARS]


@functools.lru_cache(1)
def token_test(path: str) -> Callable[[str], tuple[tuple[int, int], ...]]:
    """The random parts of a string, by the vocabulary; remembered by a worker between tasks."""
    import base64

    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def tokens(text: str) -> int:
        return sum(len(encoding.encode_ordinary(text[at : at + PART_CHARS])) for at in range(0, len(text), PART_CHARS))

    def parts(word: str) -> tuple[tuple[int, int], ...]:
        return tuple((a, b) for a, b in _strings(word) if _is_random(word[a:b], tokens))

    remembered = functools.lru_cache(REMEMBERED)(parts)
    return lambda word: remembered(word) if len(word) <= REMEMBERED_CHARS else parts(word)


def random_spans(text: str, random_parts: Callable[[str], tuple[tuple[int, int], ...]]) -> list[tuple[int, str, int]]:
    """Strings that take unusually many tokens for their length, known digests and identifiers left out.

    Every run of letters, digits and ``+/_=-`` is put to the test, whatever its cases. Left out are
    UUIDs (what a run holds beside one is tested), numbers, and hex strings of a digest's length or
    after a digest's name.
    """
    out = []
    for m in _WORD.finditer(text):
        for a, b in random_parts(m.group()):
            start, end = m.start() + a, m.start() + b
            digest = _ALL_HEX.fullmatch(text, start, end) and (end - start in DIGEST_LENGTHS or _NAMED_DIGEST.search(text[max(0, start - 16) : start]))
            if not digest:
                out.append((start, "entropy", end))
    return out


def find_secrets(docs: DataFrame, *, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans, an array of (kind, start, end), for every row; a null text counts as empty.

    The fixed kinds come first; the token test adds ``entropy`` spans for strings no fixed span
    covers. Places are code points, end exclusive.
    """
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path(VOCABULARY)
    path = vocabulary
    source = texts(docs, id_col, text_col)

    def make():
        random_parts = token_test(path)

        def work(ids, batch):
            out = []
            for text in batch:
                base = base_spans(text)
                taken = np.array([(s, e) for s, _, e in base]).reshape(-1, 2)
                more = [s for s in random_spans(text, random_parts) if not ((taken[:, 0] < s[2]) & (s[0] < taken[:, 1])).any()]
                out.append([{"kind": k, "start": s, "end": e} for s, k, e in sorted(base + more, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))])
            return ids, out

        return work

    schema = f"doc_id {source.schema['doc_id'].dataType.simpleString()}, spans array<struct<kind:string,start:long,end:long>>"
    return map_columns(source, schema, make)

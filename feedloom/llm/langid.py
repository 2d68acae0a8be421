"""Language identification by error-correcting output codes over character n-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold_columns, map_columns

# N-grams are counted in this many slots of a hash.
SLOTS = 1 << 14
# Up to this many languages the code has every split of them; beyond, CODE_BITS random ones.
EXHAUSTIVE, CODE_BITS = 5, 63
# Log-odds a character at which a bit counts as sure, and the share of the loss under which the choice is ambiguous.
MARGIN, AMBIGUOUS = 0.05, 0.02
SMOOTHING = 0.5
UNKNOWN = "und"

_PRIMES = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def gram_counts(text: str) -> np.ndarray | None:
    """Counts of the hashed 1-, 2- and 3-grams of lower-cased letters; all else is one mark between words. None without a letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = codes >= 0xC0
    letter |= (codes >= 97) & (codes <= 122)
    if (other := np.unique(codes[letter & (codes >= 0xC0)])).size:
        # Beyond ASCII, what counts as a letter is asked once for each distinct character.
        signs = other[[not chr(c).isalpha() for c in other.tolist()]]
        if signs.size:
            letter &= ~np.isin(codes, signs)
    if not letter.any():
        return None
    clean = np.where(letter, codes, np.uint32(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    clean = np.concatenate([[np.uint32(32)], clean[keep], [np.uint32(32)]]).astype(np.uint32)
    one = clean * _PRIMES[0]
    two = one[:-1] ^ (clean[1:] * _PRIMES[1])
    three = two[:-1] ^ (clean[2:] * _PRIMES[2])
    shift = np.uint32(32 - SLOTS.bit_length() + 1)
    hashed = np.concatenate([h * np.uint32(0x27D4EB2F) >> shift for h in (one, two, three)])
    return np.bincount(hashed, minlength=SLOTS)


def code_matrix(n: int) -> np.ndarray:
    """A codeword of +1 and -1 a row, for ``n`` classes: all splits in two, or random ones with distinct rows."""
    if n < 2:
        return np.zeros((n, 0))
    if n <= EXHAUSTIVE:
        splits = [[1 if k == 0 or not (bits >> (k - 1)) & 1 else -1 for k in range(n)] for bits in range(1, 1 << (n - 1))]
        return np.array(splits, float).T.reshape(n, -1)
    random = np.random.default_rng(7)
    best, best_distance = None, -1.0
    for _ in range(50):
        code = np.where(random.random((n, CODE_BITS)) < 0.5, 1.0, -1.0)
        code[:, np.abs(code.sum(0)) == n] = np.where(np.arange(n) % 2, 1.0, -1.0)[:, None]
        distance = (CODE_BITS - code @ code.T)[~np.eye(n, dtype=bool)].min()
        if distance > best_distance:
            best, best_distance = code, distance
    return best


@dataclass(frozen=True)
class LanguageCode:
    """``weights[slot, bit]``: log-odds of the two sides of each split; ``reliability[bit]`` weighs its loss."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    reliability: np.ndarray

    def predict(self, text: str) -> tuple[str, float, bool]:
        """The language, a score from 0 to 1 (one less its share of the losses, scaled), and whether the next is as near."""
        counts = gram_counts(text)
        if counts is None or not self.languages:
            return UNKNOWN, 0.0, False
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        used = np.flatnonzero(counts)
        margins = counts[used] @ self.weights[used] / counts[used].sum() / MARGIN
        # Loss-weighted decoding: the logistic loss of each bit under each codeword.
        losses = (np.logaddexp(0, -self.code * np.clip(margins, -30, 30)) * self.reliability).sum(1)
        order = np.argsort(losses, kind="stable")
        share = np.exp(-(losses - losses[order[0]]))
        gap = (losses[order[1]] - losses[order[0]]) / losses[order[1]]
        return self.languages[order[0]], float(1 / share.sum()), bool(gap < AMBIGUOUS)


def fit_code(counts: dict[str, np.ndarray]) -> LanguageCode:
    """A binary classifier for each split, from the languages' n-gram counts: each language weighs the same on its side."""
    languages = sorted(counts)
    code = code_matrix(len(languages))
    if len(languages) < 2:
        return LanguageCode(languages, code, np.zeros((SLOTS, 0)), np.zeros(0))
    shares = np.array([(counts[k] + SMOOTHING) / (counts[k].sum() + SMOOTHING * SLOTS) for k in languages])
    sides = [np.stack([shares[column == side].mean(0) for column in code.T], axis=1) for side in (1, -1)]
    weights = np.log(sides[0]) - np.log(sides[1])
    # How far apart the sides are, as each language's own mean margin has it: the least of them.
    apart = np.array([min(row[b] * float(shares[k] @ weights[:, b]) for k, row in enumerate(code)) for b in range(code.shape[1])])
    reliability = np.clip(apart / MARGIN, 0.05, 1.0)
    return LanguageCode(languages, code, weights, reliability)


def learn_languages(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> LanguageCode:
    """From all rows with a text and a language: each task adds up its n-grams by language, so only slots move.

    The model has SLOTS numbers for each language and each bit of the code, however many documents.
    """
    source = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    )

    def make():
        sums: dict[str, np.ndarray] = {}

        def take(batch, languages):
            for text, lang in zip(batch, languages, strict=True):
                if (counts := gram_counts(text)) is not None:
                    sums.setdefault(lang, np.zeros(SLOTS, np.int64)).__iadd__(counts)

        def finish():
            found = [(lang, np.flatnonzero(own), own) for lang, own in sums.items()]
            return (
                [lang for lang, slots, _ in found for _ in range(len(slots))],
                np.concatenate([slots for _, slots, _ in found] or [np.zeros(0, np.int64)]),
                np.concatenate([own[slots] for _, slots, own in found] or [np.zeros(0, np.int64)]),
            )

        return take, finish

    rows = fold_columns(source, "lang string, slot long, n long", make).groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    counts: dict[str, np.ndarray] = {}
    languages = np.array(rows["lang"].to_pylist(), object)
    slots, n = rows["slot"].to_numpy(), rows["n"].to_numpy()
    for lang in sorted(set(languages.tolist())):
        own = counts[lang] = np.zeros(SLOTS)
        own[slots[languages == lang]] = n[languages == lang]
    return fit_code(counts)


def identify(docs: DataFrame, model: LanguageCode, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score and ambiguous for every row. A text that is null or has no letter is ``und`` with score 0."""

    def make():
        def work(ids, batch):
            found = [model.predict(text or "") for text in batch]
            return ids, [f[0] for f in found], [f[1] for f in found], [f[2] for f in found]

        return work

    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, lang_pred string, score double, ambiguous boolean"
    return map_columns(docs.select(F.col(id_col), F.col(text_col)), schema, make)


def language_ids(docs: DataFrame, *, learn: Column | None = None) -> DataFrame:
    """Learned from the rows of ``docs`` under ``learn``, then predicted for all from their texts alone."""
    return identify(docs, learn_languages(docs if learn is None else docs.where(learn)))

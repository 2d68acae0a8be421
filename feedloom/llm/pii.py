"""Personal data: fixed forms, and a skip-chain conditional random field over all mentions of a document."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_columns, replace_texts, texts

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)

# The field is fitted on at most this many mentions, those with the least hashes of document and place.
FIT_MENTIONS = 20_000
# Mentions this many characters apart or less are neighbours in the chain.
CHAIN_CHARS = 80
ROUNDS, DAMPING, SURE = 12, 0.3, 0.5
# Before any evidence, linked mentions are taken to agree so many times out of one more.
PRIOR_AGREEMENT = 60

_BEFORE_AT = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit run that does not begin a hit cannot hold one further on: what follows it is the same.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]|[\[(][aA][tT][\])]")

# Mentions: mail-like strings, also with the sign written out, and groups of digits with signs between them.
_AT = re.compile(r"@|\s?[\[(](?i:at)[\])]\s?")
_NAME_SIGN = re.compile(r"[\w.%+-]")
_PLACE = re.compile(r"[\w-]++(?:\s?(?:\.|[\[(](?i:dot)[\])])\s?[\w-]++)*+")
_DIGITS = re.compile(r"[+(]{0,2}[0-9]++(?:[\x20().\-/]{1,2}[0-9]++)*+")
_CHUNK = re.compile(r"[^\x20]+")
# A number of its own has so many digits; groups with spaces between them make one of at most so many.
WHOLE_DIGITS, MOST_DIGITS = 7, 19
_NOT_DIGIT = re.compile(r"[^0-9]")
_WRITTEN_AT = re.compile(r"[\[(]at[\])]", re.IGNORECASE)
_WRITTEN = re.compile(r"\s|[\[(](?i:dot)[\])]")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(int(d) * 2 - 9 * (d > "4") for d in digits[-2::-2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # All starts within one run of name characters share the same sign and domain, so the first decides.
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and _BEFORE_AT.match(text, start - 1):
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            last = found.end()
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed forms, by kind in the order of KINDS and then by start."""
    if not _ANY.search(text):
        return []
    out = [("email", *span) for span in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


@dataclass(frozen=True)
class Mention:
    start: int
    end: int
    key: str  # mentions with the same key are linked
    label: int  # of the fixed form that it is part of, 0 for none
    features: tuple[float, ...]


def _mails(text: str, first: int, end: int) -> Iterator[tuple[int, int]]:
    """Strings around an at sign, or one written out, between two places."""
    at = first
    while sign := _AT.search(text, at, end):
        start = sign.start()
        while start > first and _NAME_SIGN.match(text, start - 1):
            start -= 1
        place = _PLACE.match(text, sign.end(), end) if start < sign.start() else None
        at = place.end() if place else sign.end()
        if place:
            yield start, at
            first = at


def _numbers(text: str, first: int, end: int) -> Iterator[tuple[int, int]]:
    """Groups of digits between two places. At a space a new number begins where both sides could be one, or the two are too long together."""
    for m in _DIGITS.finditer(text, first, end):
        start = last = None
        held = 0
        for chunk in _CHUNK.finditer(text, *m.span()):
            n = sum(map(str.isdigit, chunk.group()))
            if start is not None and (held >= WHOLE_DIGITS and n >= WHOLE_DIGITS or held + n > MOST_DIGITS):
                if held >= WHOLE_DIGITS:
                    yield start, last
                start, held = None, 0
            start, last, held = chunk.start() if start is None else start, chunk.end(), held + n
        if held >= WHOLE_DIGITS:
            yield start, last


def mentions(text: str, base: list[tuple[str, int, int]]) -> list[Mention]:
    """The fixed forms, and in what is left between them all other strings that look a little like one, by start."""
    if not _ANY.search(text):
        return []
    spans = [(start, end, LABELS.index(kind)) for kind, start, end in base]
    at = 0
    for start, end in [*sorted((s, e) for s, e, _ in spans), (len(text), len(text))]:
        if at < start:
            mails = list(_mails(text, at, start))
            spans += [(a, b, 0) for a, b in mails]
            left = at
            for a, b in [*mails, (start, start)]:
                spans += [(c, d, 0) for c, d in _numbers(text, left, a)]
                left = b
        at = max(at, end)
    return [_mention(text, *span) for span in sorted(set(spans))]


def _mention(text: str, start: int, end: int, label: int) -> Mention:
    own = text[start:end]
    mail = "@" in own or bool(_WRITTEN_AT.search(own))
    digits = _NOT_DIGIT.sub("", own)
    if mail:
        key = _WRITTEN.sub(lambda m: "." if m.group()[0] in "[(" else "", _WRITTEN_AT.sub("@", own)).lower()
    else:
        key = digits[-7:] if len(digits) <= 15 else digits
    parts = own.split(".")
    quad = len(parts) == 4 and all(p.isdigit() and len(p) <= 3 for p in parts)
    n = len(digits)
    features = (
        1.0,
        "@" in own,
        mail and "@" not in own,
        quad,
        quad and all(int(p) <= 255 for p in parts),
        not mail and own.startswith("+"),
        not mail and "(" in own,
        not mail and "-" in own,
        not mail and "/" in own,
        not mail and not quad and n < 8,
        not mail and not quad and 8 <= n <= 15,
        not mail and 16 <= n <= 19,
        not mail and n > 19,
        not mail and 16 <= n <= 19 and luhn(digits),
    )
    return Mention(start, end, key, label, tuple(map(float, features)))


def edges(found: list[Mention]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chain edges between neighbours, and skip edges from each mention to the one before with its key.

    Mentions that are alike form a chain of skip edges, not all pairs, so there are fewer edges than mentions.
    """
    chain = [(i, i + 1) for i in range(len(found) - 1) if found[i + 1].start - found[i].end <= CHAIN_CHARS]
    seen: dict[str, int] = {}
    skip = []
    for i, m in enumerate(found):
        if m.key in seen:
            skip.append((seen[m.key], i))
        seen[m.key] = i
    return chain, skip


@dataclass(frozen=True)
class SkipChain:
    unary: np.ndarray  # features x labels
    chain: np.ndarray  # labels x labels, log potentials
    skip: np.ndarray

    def marginals(self, found: list[Mention]) -> np.ndarray:
        """Beliefs of each mention's labels by loopy sum-product. A mention of a fixed form keeps its label."""
        local = np.array([m.features for m in found]) @ self.unary
        for i, m in enumerate(found):
            if m.label:
                local[i] = -30.0
                local[i, m.label] = 30.0
        chain, skip = edges(found)
        if not chain and not skip:
            return _normal(local)
        pairs = np.array(chain + skip)
        table = np.array([self.chain] * len(chain) + [self.skip] * len(skip))
        source = np.concatenate([pairs[:, 0], pairs[:, 1]])
        target = np.concatenate([pairs[:, 1], pairs[:, 0]])
        table = np.concatenate([table, table.transpose(0, 2, 1)])
        back = np.roll(np.arange(len(source)), len(pairs))
        messages = np.zeros((len(source), len(LABELS)))
        for _ in range(ROUNDS):
            belief = local.copy()
            np.add.at(belief, target, messages)
            out = np.logaddexp.reduce((belief[source] - messages[back])[:, :, None] + table, axis=1)
            out -= out.max(axis=1, keepdims=True)
            change = np.abs(out - messages).max()
            messages = DAMPING * messages + (1 - DAMPING) * out
            if change < 1e-3:
                break
        belief = local.copy()
        np.add.at(belief, target, messages)
        return _normal(belief)


def _normal(log: np.ndarray) -> np.ndarray:
    p = np.exp(log - log.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


N_FEATURES = len(_mention("0", 0, 1, 0).features)


def fit(features: np.ndarray, labels: np.ndarray, before: np.ndarray, alike: np.ndarray, *, steps: int = 300, penalty: float = 0.02) -> SkipChain:
    """Local weights by penalised logistic regression, edge potentials from how often linked labels agree.

    ``before`` and ``alike`` are the labels of a mention's neighbour in the chain and of the mention
    before with its key, -1 for none. The fixed forms are the labels, so an unmarked mention that
    resembles one is taken as an honest doubt: it counts a quarter. A mention without any feature of
    its own is none of the kinds: that counts as much as all mentions.
    """
    x = np.concatenate([features.reshape(-1, N_FEATURES), np.eye(1, N_FEATURES)])
    y = np.eye(len(LABELS))[np.append(labels, 0)]
    weights = np.where(labels > 0, 1.0, 0.25)
    weights = np.append(weights, weights.sum())
    unary, total = np.zeros((N_FEATURES, len(LABELS))), max(weights.sum(), 1)
    for _ in range(steps if len(labels) else 0):
        gradient = x.T @ ((_normal(x @ unary) - y) * weights[:, None]) / total + penalty * unary
        unary -= 1.0 * gradient
    chain = np.zeros((len(LABELS), len(LABELS)))
    both = before >= 0
    counts = np.full_like(chain, 5.0)
    np.add.at(counts, (before[both], labels[both]), 1)
    expected = counts.sum(1, keepdims=True) * counts.sum(0, keepdims=True) / counts.sum()
    chain = np.clip(np.log(counts / expected), -1, 1)
    linked = (alike > 0) & (labels > 0)
    agree, total = (alike[linked] == labels[linked]).sum(), linked.sum()
    strength = np.clip(np.log((PRIOR_AGREEMENT + agree) / (1 + total - agree)), 1.0, 6.0)
    return SkipChain(unary, chain, strength * np.eye(len(LABELS)))


def fit_on(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", limit: int = FIT_MENTIONS) -> SkipChain:
    """Fitted on a bounded sample of the mentions of ``docs``, as the fixed forms label them. Without any, all weights are 0."""

    def make():
        def work(ids, batch):
            rows = []
            for doc, text in zip(ids, batch, strict=True):
                found = mentions(text, base_spans(text))
                chain, skip = edges(found)
                previous, alike = {j: i for i, j in chain}, {j: i for i, j in skip}
                rows += [
                    (doc, m.start, m.features, m.label, found[previous[i]].label if i in previous else -1, found[alike[i]].label if i in alike else -1)
                    for i, m in enumerate(found)
                ]
            return [list(c) for c in zip(*rows, strict=True)] or [[]] * 6

        return work

    source = texts(docs, id_col, text_col)
    rows = map_columns(source, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, start long, features array<double>, label int, before int, alike int", make)
    found = rows.orderBy(F.xxhash64("doc_id", "start"), "start", "label").limit(limit).toArrow()
    columns = (np.array(found[c].to_pylist(), int) for c in ("label", "before", "alike"))
    return fit(np.array(found["features"].to_pylist(), float), *columns)


def added_spans(found: list[Mention], model: SkipChain) -> list[tuple[str, int, int]]:
    """Mentions outside the fixed forms that the field gives a kind."""
    if all(m.label for m in found):
        return []
    beliefs = model.marginals(found)
    best = beliefs.argmax(axis=1)
    return [(LABELS[k], m.start, m.end) for m, k, b in zip(found, best, beliefs, strict=True) if not m.label and k and b[k] > SURE]


def _spans(rows: list[tuple[str, int, int]]) -> list[dict]:
    return [dict(zip(("kind", "start", "end"), row, strict=True)) for row in rows]


_SPANS = "array<struct<kind:string,start:long,end:long>>"


def find_pii(docs: DataFrame, model: SkipChain | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base and added for every row: spans of the fixed forms, and those the field adds.

    A null text counts as empty. Places are code points, end exclusive. Repeated rows give equal results.
    """
    model = model or fit_on(docs, id_col=id_col, text_col=text_col)
    source = texts(docs, id_col, text_col)

    def make():
        def work(ids, batch):
            base = [base_spans(text) for text in batch]
            added = [added_spans(mentions(text, own), model) for text, own in zip(batch, base, strict=True)]
            return ids, [_spans(b) for b in base], [_spans(a) for a in added]

        return work

    return map_columns(source, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, base {_SPANS}, added {_SPANS}", make)


def redact_text(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Each span replaced by its kind in brackets; of spans that overlap, the union by the first's kind."""
    out, last, kinds = [], 0, []
    for kind, start, end in sorted(spans, key=lambda s: (s[1], s[2])):
        if kinds and start < last:
            last = max(last, end)
            continue
        out += [text[last:start], f"[{kind.upper()}]"]
        kinds.append(kind)
        last = end
    return "".join(out) + text[last:]


def redact(docs: DataFrame, model: SkipChain | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the same columns and rows, personal data in the text replaced. Null texts stay null."""
    model = model or fit_on(docs, id_col=id_col, text_col=text_col)

    def make():
        def clean(text):
            base = base_spans(text)
            found = mentions(text, base)
            return redact_text(text, base + added_spans(found, model)) if found else text

        return clean

    return replace_texts(docs, text_col, make)

"""Fixed forms against the plain patterns; the token test on random strings, digests and names."""

import hashlib
import random
import re
import time

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from feedloom.llm import queries, secrets  # noqa: E402


def plain(text):
    assign = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
    out = [(m.start(), "assign", m.end()) for m in assign.finditer(text) if len(m.group(2)) >= 6]
    out += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    return out + [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]


def test_base_spans_are_the_patterns(spark, data):
    texts = [r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    random.seed(5)
    parts = ["token", "API_KEY", "apikey", "=", ":", " ", '"', "'", "abc", "AKIA", "A" * 17, "0a" * 13, "x/", "passw", "word", "ſecret", "toKen"]
    texts += ["".join(random.choices(parts, k=12)) for _ in range(3000)] + ["f" * 5000, "secret=" * 900]
    assert [secrets.base_spans(t) for t in texts] == [plain(t) for t in texts]
    assert sum(map(len, map(plain, texts))) > 1000


def parts():
    return secrets.token_test(public_tokenizers.path(secrets.VOCABULARY))


def found(text):
    return [text[s:e] for s, _, e in secrets.random_spans(text, parts())]


def plain_random(text):
    """The rule as the docstrings put it, string by string and without anything remembered."""
    import base64

    import tiktoken

    with open(public_tokenizers.path(secrets.VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    uuid = r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}(?![0-9A-Fa-f])"

    def below(chars, tokens, *bounds):
        for least, bound in bounds:
            if chars >= least:
                return chars / tokens < bound
        return False

    out = []
    for run in re.finditer("[A-Za-z0-9+/_=-]+", text):
        inside, pieces = [m.span() for m in re.finditer(uuid, run[0])], []
        if inside:
            at = 0
            for s, e in [*inside, (len(run[0]), len(run[0]))]:
                m = re.search("[A-Za-z0-9](.*[A-Za-z0-9])?", run[0][at:s])
                if m:
                    pieces.append((run.start() + at + m.start(), m[0]))
                at = e
        else:
            pieces.append((run.start(), run[0]))
        for start, word in pieces:
            if len(word) < 8 or len(set(word)) * 3 < min(24, len(word)):
                continue
            names = [p for p in re.split("[+/_=-]", word) if p]
            if all(re.fullmatch("[a-z]+|[A-Z]+|[0-9]{1,4}|[a-z]*([A-Z][a-z]+)+[0-9]{0,3}", p) for p in names):
                groups = [g for p in names for g in re.findall("[A-Z]?[a-z]+|[A-Z]+", p) if len(g) >= 4]
                random_ = below(sum(map(len, groups)), sum(len(encoding.encode_ordinary(g)) for g in groups) or 1, (20, 2.1), (16, 1.55), (8, 1.2))
            elif re.fullmatch("[0-9]+", word):
                continue
            else:
                random_ = below(len(word), len(encoding.encode_ordinary(word)), (16, 2.3), (8, 1.6))
            hexed = re.fullmatch("[0-9a-f]+|[0-9A-F]+", word)
            named = re.search(r"(md5|sha-?(1|224|256|384|512)|git|commit|checksum|digest|etag|integrity)[^A-Za-z0-9]{1,3}$", text[max(0, start - 16) : start], re.I)
            if random_ and not (hexed and (len(word) in (32, 40, 56, 64, 96, 128) or named)):
                out.append((start, "entropy", start + len(word)))
    return out


def test_added_spans_are_the_rule():
    rng = random.Random(11)
    alphabets = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef", "aB3xYz9QwErTy+/", "0123456789", "ab", "Zk9Qp7Lm"]
    words = ["report", "Sunday", "user_name", "getUserName", "123e4567-e89b-12d3-a456-426614174000", "sha256:", "commit ", "digest=", "-", "=", "_", "/", "Information"]
    texts = []
    for _ in range(1500):
        text = ""
        for _ in range(rng.randint(1, 5)):
            text += rng.choice(words) if rng.random() < 0.5 else "".join(rng.choices(rng.choice(alphabets), k=rng.randint(3, 40)))
            text += rng.choice(["", " ", "-", "_", " ", "."])
        texts.append(text)
    got = [secrets.random_spans(t, parts()) for t in texts]
    assert got == [plain_random(t) for t in texts]
    assert sum(map(len, got)) > 500


def test_one_case_short_and_joined_keys():
    rng = random.Random(12)
    lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    for alphabet in (lower, upper):
        keys = ["".join(rng.choices(alphabet, k=rng.randint(20, 40))) for _ in range(200)]
        assert sum(found(f"see {k} there") == [k] for k in keys) > 180
    keys = ["-".join("".join(rng.choices(upper, k=5)) for _ in range(4)) for _ in range(200)]
    assert sum(found(k) == [k] for k in keys) > 150
    keys = ["".join(rng.choices(lower + upper + "0123456789", k=rng.randint(8, 15))) for _ in range(200)]
    assert sum(found(k) == [k] for k in keys) > 130
    assert found("123e4567-e89b-12d3-a456-426614174000-Zk9Qp2xW7tLm4RvB") == ["Zk9Qp2xW7tLm4RvB"]


def test_many_groups_take_no_time():
    start = time.perf_counter()
    found("ab-" * 10_000 + "a1B2")
    found("aB" * 10_000 + "-1x9")
    found("Ab" * 10_000 + "99999-")
    found("x" * 300_000)
    assert time.perf_counter() - start < 4


def test_memory_is_bounded():
    assert secrets.REMEMBERED * secrets.REMEMBERED_CHARS <= 16 << 20
    long = "".join(random.Random(3).choices("abcdefghijklmnopqrstuvwxyzABC0123456789", k=5000))
    held = parts().__closure__
    assert found(long) == [long]
    assert not any(getattr(c.cell_contents, "cache_info", None) and c.cell_contents.cache_info().maxsize is None for c in held)


def test_random_strings():
    random.seed(6)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(random.choices(alphabet, k=random.randint(20, 44))) for _ in range(200)]
    assert sum(found(f"see {k} there") == [k] for k in keys) > 195


@pytest.mark.parametrize(
    "text",
    [
        "", "plain words only here and there", "getUserAccountByIdentifier", "some_long_snake_case_name_2024", "a-very-long-slug-of-a-page",
        hashlib.md5(b"x").hexdigest(), "sha256:" + hashlib.sha256(b"x").hexdigest(), "commit 3f2a9c0d1b7e4f5a6c8d",
        "123e4567-e89b-12d3-a456-426614174000", "4401158938931030", "desschheiteinberundverlich", "INTERNATIONALIZATIONS", "=" * 40, "0" * 30,
    ],
)
def test_names_and_digests_are_left(text):
    assert found(text) == []


def test_rows(spark):
    key = "Zx9qLm2VtR7wKp4YcB8nHd3F"
    rows = [(1, f"password = hunter22 and {key}", 0), (1, None, 0), (None, "", 0), (2, "x " * 30_000 + "AKIA" + "Z" * 16, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    got = sorted(([(s.kind, s.start, s.end) for s in r.spans] for r in secrets.find_secrets(docs).collect()), key=len)
    assert got == [[], [], [("access", 60_000, 60_020)], [("assign", 0, 19), ("entropy", 24, 48)]]
    assert secrets.find_secrets(docs.limit(0)).count() == 0


def test_query_columns(spark):
    rows = queries.op9_secrets(spark, "/root/testdata/sf0.01").collect()
    assert any(r.n_assign for r in rows)
    for r in rows:
        base = [s for s in r.spans.split(",") if s and not s.startswith("entropy")]
        assert len(base) == r.n_assign + r.n_access + r.n_hex
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()

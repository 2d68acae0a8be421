"""SQL with the same rows, where SQL can express an operator and is fast on whole tables."""

from __future__ import annotations

# Of equal payloads from 1000 bytes on, the last page keeps its body and the others refer to it.
OP7 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
     d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS payload_digest FROM p),
     m AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS last FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to,
       true AS digest_ok
FROM m
"""

# All runs of one to five words of each piece; the lowest-scoring cut; parts that a longer phrase always covers.
OP13 = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
     p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
     w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
     t AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
     s AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
     g AS (SELECT lang, ws, i, unnest(range(1, least(5, len(ws) - i + 1) + 1)) AS size FROM s),
     f AS (SELECT lang, array_to_string(ws[i:i + size - 1], ' ') AS phrase, size, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
     c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE size >= 2),
     k AS (SELECT lang, phrase, ws, f AS a, size, unnest(range(1, size)) AS k FROM c),
     x AS (SELECT k.lang, k.phrase, k.a, k.k, l.f AS l, r.f AS r, t.n, ((1000::HUGEINT * k.a * t.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
           FROM k JOIN t USING (lang)
           JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(k.ws[1:k.k], ' ')
           JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(k.ws[k.k + 1:k.size], ' ')),
     b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
     u AS (SELECT lang, ws, size, f, unnest(range(2, size)) AS width FROM c),
     v AS (SELECT lang, ws, f, width, unnest(range(1, size - width + 2)) AS i FROM u),
     o AS (SELECT lang, array_to_string(ws[i:i + width - 1], ' ') AS phrase, max(f) AS over FROM v GROUP BY ALL),
     e AS (SELECT b.* FROM b LEFT JOIN o USING (lang, phrase) WHERE o.over IS NULL OR o.over < b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM e QUALIFY rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op7_warc": OP7,
    "op13_collocations": OP13,
}

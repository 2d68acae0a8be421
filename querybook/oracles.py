"""The same results in SQL, stated from the rules by which the inputs were derived."""

from __future__ import annotations

SITE = "https://www.example.com"

# Links of the raw pages: root-relative, double-quoted hrefs outside comments and scripts.
_LINKS = """
hrefs AS (
  SELECT page_id, regexp_extract(url, '^(https?://[^/]*)', 1) AS origin,
         unnest(regexp_extract_all(
           regexp_replace(html, '(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>', '', 'g'),
           '<a [^>]*href="([^"]*)"', 1)) AS href
  FROM pages),
links AS (
  SELECT page_id, origin || array_to_string(list_transform(string_split(href, ''),
           lambda c: CASE WHEN regexp_matches(c, '^[!-~]$') AND c NOT IN ('"', '<', '>', '`', '{', '}')
                     THEN c ELSE url_encode(c) END), '') AS link_url
  FROM hrefs)"""

# The linked site: one row per page, and the targets of its own four links plus its raw hrefs.
_SITE = f"""
n AS (SELECT count(*) AS n, count(*) + count(*) // 16 AS m FROM pages),
site AS (
  SELECT page_id, '{SITE}/p/' || page_id AS url,
         CASE WHEN page_id % 10 = 9 THEN 'application/json' ELSE 'text/html; charset=utf-8' END AS content_type
  FROM pages),
{_LINKS.strip()},
targets AS (
  SELECT s.url AS src, '{SITE}/p/' || ((p.a * page_id + p.b) % n.m) AS dst
  FROM site s, n, (VALUES (7, 1), (5, 2), (3, 4), (1, 1)) p(a, b) WHERE s.page_id % 10 <> 9
  UNION
  SELECT '{SITE}/p/' || page_id, '{SITE}' || regexp_replace(link_url, '^https?://[^/]*', '')
  FROM links WHERE page_id % 10 <> 9
  UNION
  SELECT url, 'https://other.example.net/x' FROM site WHERE page_id % 10 <> 9)"""


def _crawl(seeds: str, rules: str) -> str:
    """Breadth-first levels; ``rules`` is (task_id, max_depth, domain, includes, exclude)."""
    return f"""
rules AS ({rules}),
seeds AS ({seeds}),
walk AS (
  SELECT task_id, url, 0 AS depth FROM seeds
  UNION
  SELECT w.task_id, t.dst, w.depth + 1
  FROM walk w JOIN rules r ON r.task_id = w.task_id JOIN targets t ON t.src = w.url
  WHERE w.depth < r.max_depth
    AND (r.domain IS NULL OR ends_with(regexp_extract(t.dst, '//([^/]*)', 1), r.domain))
    AND (r.include IS NULL OR starts_with(regexp_extract(t.dst, '//[^/]*(/[^?#]*)', 1), r.include))
    AND (r.exclude IS NULL OR NOT starts_with(regexp_extract(t.dst, '//[^/]*(/[^?#]*)', 1), r.exclude)))
SELECT w.task_id, w.url, min(w.depth) AS depth,
       CASE WHEN NOT starts_with(w.url, 'http') THEN 500 WHEN any_value(s.url) IS NULL THEN 404 ELSE 200 END AS status_code
FROM walk w LEFT JOIN site s ON s.url = w.url
GROUP BY w.task_id, w.url"""


_SITEMAP_ENTRIES = f"""
entries AS (
  SELECT '{SITE}/set' || (page_id // 25) || '.xml' AS sitemap_url, page_id,
         CASE page_id % 5 WHEN 1 THEN '{SITE}/p/' || page_id || '?a=1&b=2'
                          WHEN 2 THEN '{SITE}/p/' || page_id || '?a=1&b=2'
                          WHEN 3 THEN ' {SITE}/p/' || page_id || chr(10)
                          WHEN 4 THEN '/p/' || page_id
                          ELSE '{SITE}/p/' || page_id END AS loc,
         ((page_id::VARCHAR LIKE '1%') OR (page_id::VARCHAR LIKE '2%')) AND page_id::VARCHAR NOT LIKE '11%' AS allowed
  FROM pages)"""

_DOCS = "docs AS (SELECT count(*) AS n FROM documents)"


def _path(n: str) -> str:
    return (
        f"CASE WHEN {n} % 20 = 0 THEN '.hidden/d' || ({n}) || '.txt' WHEN {n} % 23 = 0 THEN 'a/.env' || ({n})"
        f" WHEN {n} % 29 = 0 THEN '_u/d' || ({n}) || '.txt'"
        f" ELSE 'docs/' || (({n}) % 7) || '/d' || ({n}) || '.txt' END"
    )


_VISIBLE_FILES = f"""
files AS (
  SELECT 'https://github.com/org/r' || (doc_id % 20) AS repo, {_path('doc_id')} AS path,
         length(text) + CASE WHEN doc_id % 37 = 0 THEN 1 ELSE 0 END AS n_chars,
         sha256(text || CASE WHEN doc_id % 37 = 0 THEN chr(65533) ELSE '' END) AS content_sha256
  FROM documents
  WHERE doc_id % 41 <> 0 AND doc_id % 31 <> 0 AND doc_id % 20 <> 0 AND doc_id % 23 <> 0)"""

_PUSHES = f"""
{_DOCS},
pushes AS (
  SELECT event_id AS e, event_id % 20 AS r,
         CASE WHEN event_id % 11 = 0 THEN 'ping' WHEN event_id % 13 = 0 OR event_id % 53 = 0 THEN 'bad' ELSE 'push' END AS outcome,
         CASE WHEN event_id % 7 = 0 THEN 'refs/tags/v1' ELSE 'main' END AS branch,
         sha256(CASE WHEN event_id % 23 = 0 THEN 'gone' ELSE 'org/r' || (event_id % 20) END) AS after,
         (event_id % 20) + 20 * ((event_id * 7) % (docs.n // 20)) AS d1, (event_id * 11 + 3) % docs.n AS d2
  FROM events, docs),
touched AS (
  SELECT e, r, branch, after, 'added' AS kind, d1 AS d, {_path('d1')} AS path FROM pushes WHERE outcome = 'push' AND e % 19 <> 0
  UNION ALL
  SELECT e, r, branch, after, 'modified', d2, {_path('d2')} FROM pushes WHERE outcome = 'push' AND e % 19 <> 0
  UNION ALL
  SELECT e, r, branch, after, 'modified', d1, {_path('d1')} FROM pushes WHERE outcome = 'push' AND e % 19 <> 0
  UNION ALL
  SELECT e, r, branch, after, 'removed', NULL, 'old/' || e FROM pushes WHERE outcome = 'push' AND e % 19 <> 0)"""

_MIME = """CASE doc_id % 8 WHEN 0 THEN 'application/vnd.google-apps.document'
  WHEN 1 THEN 'application/vnd.google-apps.spreadsheet' WHEN 2 THEN 'application/vnd.google-apps.presentation'
  WHEN 3 THEN 'text/plain' WHEN 4 THEN 'application/json' WHEN 5 THEN 'image/jpeg'
  WHEN 6 THEN 'application/vnd.openxmlformats-officedocument.wordprocessingml.document'
  ELSE 'application/octet-stream' END"""


def _drive_url(n: str) -> str:
    return (
        f"CASE WHEN {n} % 3 = 2 THEN 'https://view.example.com/' || {n}"
        f" WHEN {n} % 9 <> 0 THEN 'https://get.example.com/' || {n}"
        f" ELSE 'https://drive.google.com/file/d/f' || {n} || '/view' END"
    )


def _kind(n: str) -> str:
    return f"CASE WHEN {n} % 8 IN (5, 7) THEN 'binary' ELSE 'text' END"


def _drive_scan(where: str) -> str:
    return f"""
SELECT 'f' || doc_id AS id, {_drive_url('doc_id')} AS url,
       CASE WHEN failed THEN 500 ELSE 200 END AS status_code,
       CASE WHEN failed THEN 'error' WHEN trashed OR text = '' THEN 'empty' ELSE {_kind('doc_id')} END AS content_kind,
       CASE WHEN trashed THEN 'DELETE' END AS change_type,
       CASE WHEN failed THEN 'gdrive_full_scan_fetch_failed' WHEN trashed THEN 'gdrive_full_scan_trash'
            ELSE 'gdrive_full_scan' END AS ingestion_type,
       'doc ' || doc_id AS file_name,
       CASE WHEN failed THEN NULL WHEN doc_id % 11 = 0 THEN 0 ELSE n_chars END AS file_size
FROM (SELECT *, doc_id % 13 = 0 AS trashed, doc_id % 13 <> 0 AND doc_id % 19 = 0 AS failed FROM documents)
WHERE doc_id % 31 <> 0 AND doc_id % 37 <> 0 AND {where}"""


_CHANGES = f"""
{_DOCS},
feed AS (
  SELECT event_id AS seq, event_type, user_id % docs.n AS n, d.text = '' AS blank,
         CASE WHEN event_id % 41 = 0 THEN NULL
              WHEN event_type = 'error' THEN 'removed' WHEN event_type = 'view' THEN NULL
              WHEN event_type = 'signup' THEN 'trashed' ELSE 'live' END AS action
  FROM events, docs LEFT JOIN documents d ON d.doc_id = user_id % docs.n)"""


def _delta(inside: str, since: int) -> str:
    return f"""
delta AS (
  SELECT seq, n, 'f' || n AS id, action, blank, action = 'live' AND n % 19 = 0 AS failed
  FROM feed WHERE seq >= {since} AND (action IN ('removed', 'trashed') OR (action = 'live' AND {inside})))"""


_VERDICTS = """
verdicts AS (
  SELECT event_id, e, k, svc, secret, sig_error, CASE
      WHEN e % 29 = 0 THEN 'Invalid webhook body type.'
      WHEN svc = 2 THEN 'No handler found for webhook service: unknown-svc'
      WHEN svc = 0 AND e % 17 = 0 THEN 'Invalid JSON payload.'
      WHEN svc = 0 AND k = 4 THEN 'Unsupported signature algorithm.'
      WHEN svc = 0 AND k = 3 THEN 'Invalid webhook signature.'
      WHEN svc = 0 AND e % 19 = 0 THEN 'Could not extract externalResourceId (repository full name).'
      WHEN svc = 1 AND k = 3 THEN 'Invalid channel ID or token mismatch.'
      WHEN svc = 1 AND k IN (4, 5) THEN 'Could not extract actual Drive folder ID from x-goog-resource-uri.'
    END AS failure
  FROM (SELECT event_id, event_id AS e, event_id % 7 AS k, event_id % 3 AS svc, event_id % 7 <> 6 AS secret,
               event_id % 3 = 0 AND event_id % 7 = 5 AS sig_error FROM events)),
judged AS (
  SELECT event_id, failure IS NULL AND NOT sig_error AS is_valid,
    CASE WHEN failure IS NULL THEN CASE svc WHEN 0 THEN 'https://github.com/org/src' || (e % 20) ELSE 'fold' || (e % 8) END END AS external_resource_id,
    CASE WHEN failure IS NULL THEN CASE
      WHEN svc = 0 AND e % 5 = 0 THEN 'UPSERT' WHEN svc = 0 AND e % 5 = 1 THEN 'UNKNOWN'
      WHEN svc = 0 THEN CASE WHEN e % 8 IN (0, 2) THEN 'DELETE' ELSE 'UPSERT' END
      WHEN e % 6 < 3 THEN 'UPSERT' WHEN e % 6 < 5 THEN 'DELETE' ELSE 'UNKNOWN' END END AS change_type,
    CASE WHEN failure IS NOT NULL THEN failure WHEN sig_error THEN 'Webhook signature validation skipped or failed.' END AS error
  FROM verdicts)"""

_UNIFIED = f"""
unified AS (
  SELECT 'web' AS source, '{SITE}/p/' || page_id || '#part' AS id, '{SITE}/p/' || page_id || '#part' AS url,
         200 AS status_code, NULL AS change_type, 'UPSERT' AS change_op,
         '{SITE}/p/' || page_id || '#part' AS entity_key, 'web-1' AS task_id FROM pages
  UNION ALL
  SELECT 'web', '{SITE}/p/' || page_id || '/gone', '{SITE}/p/' || page_id || '/gone', 404, NULL, 'NONE',
         '{SITE}/p/' || page_id || '/gone', 'web-2' FROM pages
  UNION ALL
  SELECT 'git', repo || '-' || path, repo || '/blob/main/' || path, 200, 'full_scan', 'UPSERT',
         'git:' || substr(repo, 20) || ':main:' || path, 'git-1' FROM files
  UNION ALL
  SELECT 'drive', id, url, status_code, change_type,
         CASE WHEN status_code >= 400 THEN 'NONE' WHEN change_type = 'DELETE' THEN 'DELETE' ELSE 'UPSERT' END,
         'drive:' || id, 'drive-1' FROM ({_drive_scan('doc_id % 4 = 1')}))"""

_DOC_TYPES = f"SELECT {_MIME} AS mime_type, doc_id FROM documents"

ORACLES: dict[str, str] = {
    "url_normalize": """
SELECT page_id, CASE WHEN page_id % 32 = 8 THEN 'http://127.0.0.1/' || page_id WHEN page_id % 32 = 16 THEN 'http://1.2.3.256/' || page_id
    WHEN page_id % 96 = 24 THEN 'http://xn--mnchen-3ya.example/' || page_id WHEN page_id % 96 = 56 THEN 'http://[::1]/' || page_id
    WHEN page_id % 96 = 88 THEN 'http://[::ffff:102:304]/' || page_id
    ELSE CASE page_id % 8
    WHEN 6 THEN regexp_replace(url, '^(https?://[^/]*)', '\\1/%C3%BC%20x%7By%7D')
    WHEN 7 THEN regexp_extract(url, '^(https?://[^/]*)', 1) || '/'
    ELSE url END END AS url_norm
FROM pages""",
    "url_filter": f"""
WITH {_LINKS},
odd AS (SELECT page_id, ['mailto:a@example.com/en/', 'ftp://example.com/en/x', 'http://no host.example.com/en/x', 'http://example.com:99999/en/x',
                         'example.com/en/x', 'javascript:void(0)'][page_id % 6 + 1] AS url FROM pages),
candidates AS (SELECT page_id, url FROM pages UNION ALL SELECT page_id, link_url FROM links),
parts AS (SELECT page_id, url, regexp_extract(url, '//([^/]*)', 1) AS host,
                 regexp_extract(url, '//[^/]*(/[^?#]*)', 1) AS path FROM candidates)
SELECT page_id, url,
       (ends_with(host, 'example.com') OR ends_with(host, 'le.org'))
       AND (starts_with(path, '/en/') OR starts_with(path, '/fr/') OR starts_with(path, '/d') OR starts_with(path, '/The'))
       AND NOT (starts_with(path, '/en/1') OR starts_with(path, '/de/2')) AS allowed
FROM parts
UNION ALL SELECT page_id, url, false FROM odd""",
    "extract_links": f"WITH {_LINKS} SELECT page_id, link_url FROM links",
    "web_fetch": f"""
WITH {_LINKS},
front AS (SELECT url FROM pages UNION SELECT link_url FROM links),
snapshot AS (
  SELECT *, split_part(url, '#', 1) AS k,
         row_number() OVER (PARTITION BY split_part(url, '#', 1) ORDER BY url DESC) AS rn FROM pages),
got AS (
  SELECT f.url, s.page_id AS p, s.html, CASE WHEN s.page_id IS NULL THEN 404 WHEN s.page_id % 13 = 5 THEN 503
                WHEN s.page_id % 17 = 3 THEN 500 ELSE 200 END AS status_code
  FROM front f LEFT JOIN snapshot s ON s.k = split_part(f.url, '#', 1) AND s.rn = 1)
SELECT url, status_code,
       CASE WHEN status_code = 200 THEN CASE WHEN p % 10 = 9 THEN 'application/json' ELSE 'text/html; charset=utf-8' END END AS content_type,
       CASE WHEN status_code <> 200 THEN 'error' WHEN p % 10 = 9 THEN 'json' ELSE 'text' END AS content_kind,
       status_code <> 200 AS is_error,
       sha256(CASE WHEN status_code <> 200 THEN 'Error fetching: Request failed with status code ' || status_code
                   WHEN p % 10 = 9 THEN '{{"page": ' || p || '}}' ELSE html END) AS content_sha256
FROM got""",
    "crawl": f"WITH RECURSIVE {_SITE}, "
    + _crawl(
        f"SELECT task_id, '{SITE}/p/0' AS url FROM rules",
        "SELECT 'narrow' AS task_id, 6 AS max_depth, 'example.com' AS domain, '/p/' AS include, '/p/7' AS exclude"
        " UNION ALL SELECT 'wide', 6, 'example.com', NULL, '/p/7' UNION ALL SELECT 'shallow', 0, NULL, NULL, NULL",
    ),
    "sitemap_discover": """
SELECT page_id::VARCHAR AS task_id, host, CASE
    WHEN length(host) % 4 IN (0, 1) THEN 'https://' || host || '/sm.xml'
    WHEN length(host) % 8 < 4 THEN scheme || '://' || host || '/sitemap.xml' END AS sitemap_url
FROM (SELECT page_id, regexp_extract(url, '^(https?)', 1) AS scheme, regexp_extract(url, '//([^/]*)', 1) AS host FROM pages)""",
    "sitemap_urls": f"WITH {_SITEMAP_ENTRIES} SELECT sitemap_url, loc, allowed FROM entries",
    "sitemap_url_counts": f"WITH {_SITEMAP_ENTRIES} SELECT sitemap_url, count(*) AS n_urls FROM entries GROUP BY 1",
    "crawl_from_sitemap": f"WITH RECURSIVE {_SITE}, {_SITEMAP_ENTRIES}, "
    + _crawl(
        f"""SELECT 'mapped' AS task_id, CASE WHEN page_id % 5 = 3 THEN '{SITE}/p/' || page_id ELSE loc END AS url
            FROM entries WHERE allowed
            UNION ALL SELECT 'unmapped', 'https://plain.example.com/p/0' UNION ALL SELECT 'plain', '{SITE}/p/0'""",
        "SELECT 'mapped' AS task_id, 1 AS max_depth, 'example.com' AS domain, '/p/1' AS include, '/p/11' AS exclude"
        " UNION ALL SELECT 'mapped', 1, 'example.com', '/p/2', '/p/11'"
        " UNION ALL SELECT 'unmapped', 1, NULL, NULL, NULL UNION ALL SELECT 'plain', 1, 'example.com', '/p/', NULL",
    ),
    "git_full_scan": f"""
WITH {_VISIBLE_FILES}
SELECT repo || '-' || path AS id, repo || '/blob/main/' || path AS url, 200 AS status_code,
       'full_scan' AS change_type, n_chars, content_sha256 FROM files""",
    "git_push_status": f"""
WITH {_PUSHES}
SELECT e AS event_id, CASE WHEN outcome = 'bad' THEN 500 ELSE 200 END AS code,
       CASE outcome WHEN 'ping' THEN 'GitHub ''ping'' event processed successfully (no data ingested).'
                    WHEN 'push' THEN 'Webhook processed and files ingested.'
                    ELSE 'Git operation failed: Invalid GitHub Push webhook payload structure.' END AS message,
       CASE WHEN outcome = 'push' THEN branch END AS branch
FROM pushes""",
    "git_push_delta": f"""
WITH {_PUSHES},
found AS (
  SELECT t.*, CASE WHEN doc.doc_id % 31 <> 0 THEN length(doc.text) + CASE WHEN doc.doc_id % 37 = 0 THEN 1 ELSE 0 END END AS n,
         doc.text || CASE WHEN doc.doc_id % 37 = 0 THEN chr(65533) ELSE '' END AS body
  FROM touched t LEFT JOIN documents doc ON doc.doc_id = t.d AND doc.doc_id % 20 = t.r AND t.e % 23 <> 0
  WHERE t.e % 17 <> 0)
SELECT e AS event_id,
       'org/r' || r || '-' || path || CASE WHEN failed THEN '-error' ELSE '' END AS id,
       CASE WHEN NOT failed THEN 'https://github.com/org/r' || r || '/blob/' || branch || '/' || path END AS url,
       CASE WHEN failed THEN 500 ELSE 200 END AS status_code, kind AS change_type, after AS commit_sha,
       CASE WHEN failed THEN length('Error reading file: ' || message) WHEN kind = 'removed' THEN 0 ELSE n END AS n_chars,
       sha256(CASE WHEN failed THEN 'Error reading file: ' || message WHEN kind = 'removed' THEN '' ELSE body END) AS content_sha256,
       CASE WHEN failed THEN NULL ELSE 'change' END AS commit_message, CASE WHEN failed THEN NULL ELSE 'bob' END AS pusher,
       CASE WHEN failed THEN NULL ELSE 'ann' END AS commit_author,
       CASE WHEN failed THEN message END AS error
FROM (SELECT *, kind <> 'removed' AND n IS NULL AS failed,
             'ENOENT: no such file or directory, open ''' || path || '''' AS message FROM found)""",
    "push_commit_files": f"""
WITH {_PUSHES}
SELECT e AS event_id, 'org/r' || r AS repo, 'c' || e AS commit_id, p AS path, 'added' AS kind
FROM pushes, (VALUES ('x.txt'), ('y.txt')) v(p) WHERE outcome = 'push'
UNION ALL
SELECT e, 'org/r' || r, after, path, kind FROM touched""",
    "drive_full_scan": _drive_scan("doc_id % 4 = 1 AND doc_id % 13 <> 0"),
    "drive_full_scan_trash": _drive_scan("true"),
    "drive_scan_counts": """
SELECT count(*) AS listed, count(*) FILTER (doc_id % 31 <> 0) AS ingested
FROM documents WHERE doc_id % 4 = 1 AND doc_id % 37 <> 0 AND doc_id % 13 <> 0""",
    "drive_resume": """
SELECT 'f' || doc_id AS id FROM documents
WHERE doc_id % 4 = 1 AND doc_id % 37 <> 0 AND doc_id % 31 <> 0 AND doc_id % 13 <> 0 AND 'f' || doc_id > 'f5'""",
    "drive_delta": f"""
WITH {_CHANGES}, {_delta('n % 4 = 1 AND n % 37 <> 0', 100)}
SELECT seq, id,
       CASE WHEN action = 'removed' THEN 'https://drive.google.com/file/d/' || id || '/view' ELSE {_drive_url('n')} END AS url,
       CASE WHEN failed THEN 500 ELSE 200 END AS status_code,
       CASE WHEN failed THEN 'error' WHEN action <> 'live' OR blank THEN 'empty' ELSE {_kind('n')} END AS content_kind,
       CASE WHEN failed THEN NULL WHEN action = 'live' THEN 'UPSERT' ELSE 'DELETE' END AS change_type,
       CASE WHEN failed THEN 'gdrive_full_scan_fetch_failed' WHEN action = 'live' THEN 'gdrive_delta_sync'
            WHEN action = 'trashed' THEN 'gdrive_delta_sync_trash' ELSE 'gdrive_delta_sync_removal' END AS ingestion_type,
       CASE WHEN action = 'removed' THEN NULL WHEN n % 31 = 0 THEN 'unknown-name' ELSE 'doc ' || n END AS file_name,
       CASE WHEN action = 'removed' OR failed THEN NULL WHEN seq % 12 = 0 THEN 0 ELSE seq * 3 END AS file_size
FROM delta""",
    "drive_next_token": """
SELECT 'first' AS task_id, max(event_id) + 1 AS next_token, 0 AS n_changes FROM events
UNION ALL SELECT 'begin', max(event_id) + 1, count(*) FROM events
UNION ALL SELECT 'middle', max(event_id) + 1, count(*) FROM events WHERE event_id >= 500
UNION ALL SELECT 'beyond', 1000000000000, 0""",
    "drive_change_pages": "SELECT event_id // 100 AS page, count(*) AS n FROM events GROUP BY 1",
    "drive_content_plan": f"""
SELECT mime_type, CASE doc_id % 8 WHEN 0 THEN 'text/plain' WHEN 1 THEN 'text/csv' WHEN 2 THEN 'application/pdf' END AS export_mime,
       CASE WHEN doc_id % 8 IN (5, 7) THEN 'binary' ELSE 'text' END AS content_kind, count(*) AS n
FROM ({_DOC_TYPES}) GROUP BY ALL""",
    "drive_folder_edges": """
SELECT 'f' || doc_id AS file_id, 'fold' || (doc_id % 4) AS parent_id FROM documents WHERE doc_id % 37 <> 0
UNION ALL SELECT 'f' || doc_id, 'shared' FROM documents WHERE doc_id % 37 <> 0""",
    "webhook_verdict": f"WITH {_VERDICTS} SELECT event_id, is_valid, external_resource_id, change_type, error FROM judged",
    "webhook_route": f"""
WITH {_VERDICTS},
registry AS (
  SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'https://github.com/org/src' ELSE 'fold' END || (s_suppkey // 2) AS source_identifier,
         unnest(list_transform(range(s_suppkey % 4 + 1), lambda i: 'task' || s_suppkey || '-' || i)) AS task_id
  FROM supplier WHERE s_suppkey % 9 <> 0)
SELECT event_id, task_id, change_type FROM judged JOIN registry ON source_identifier = external_resource_id WHERE is_valid""",
    "task_validate": """
SELECT 'task' || k AS task_id, plugin AS plugin_type, coalesce(code, 200) AS code, message,
       CASE plugin WHEN 'http' THEN CASE WHEN k % 8 >= 4 THEN 3 ELSE 1 END
                   WHEN 'git' THEN CASE WHEN k % 8 >= 4 THEN 9 ELSE 1 END END AS effective_depth,
       CASE plugin WHEN 'http' THEN CASE WHEN k % 8 >= 4 THEN 3 ELSE 0 END
                   WHEN 'git' THEN CASE WHEN k % 8 >= 4 THEN 9 ELSE 1 END END AS run_depth,
       CASE plugin WHEN 'http' THEN true END AS effective_recursive, CASE plugin WHEN 'http' THEN false END AS effective_sitemap,
       CASE plugin WHEN 'http' THEN 30000 END AS effective_timeout_ms, CASE plugin WHEN 'git' THEN 'main' END AS effective_branch,
       CASE plugin WHEN 'drive' THEN 'service_account' END AS effective_auth_type, CASE plugin WHEN 'drive' THEN 50 END AS effective_page_size
FROM (
  SELECT *, CASE WHEN message LIKE 'Invalid service%' THEN 500 WHEN message IS NOT NULL THEN 400 END AS code
  FROM (
    SELECT s_suppkey AS k, CASE s_suppkey % 4 WHEN 0 THEN 'http' WHEN 1 THEN 'git' WHEN 2 THEN 'drive' ELSE 'unknown' END AS plugin,
      CASE WHEN s_suppkey % 4 = 3 THEN 'Unsupported plugin type: s3'
           WHEN s_suppkey % 4 = 0 THEN CASE WHEN s_suppkey % 5 = 0 THEN 'Missing ''startUrl'' configuration for standard crawl.' END
           WHEN s_suppkey % 4 = 1 THEN CASE WHEN s_suppkey % 5 = 0 THEN 'Missing ''repoUrl'' configuration for Git crawl.' END
           WHEN s_suppkey % 5 = 0 OR s_suppkey % 10 = 4 THEN 'Missing or invalid ''folderId'' in configuration. Client not initialized.'
           WHEN s_suppkey % 7 = 0 THEN 'Missing service account key configuration. Client not initialized.'
           WHEN s_suppkey % 7 = 1 THEN 'Invalid service account key: not valid JSON'
           WHEN s_suppkey % 7 = 2 THEN 'Incomplete service account key. Client not initialized.' END AS message
    FROM supplier))""",
    "unified_records": f"""
WITH {_VISIBLE_FILES}, {_UNIFIED}
SELECT source, id, url, status_code, change_type, change_op, entity_key FROM unified""",
    "run_summary": f"""
WITH {_VISIBLE_FILES}, {_UNIFIED}
SELECT task_id, count(*) AS crawled_count, count(*) FILTER (status_code >= 400) AS error_count, true AS success, 200 AS code
FROM unified GROUP BY task_id
UNION ALL SELECT 'idle-1', 0, 0, true, 200 UNION ALL SELECT 'lost-1', 0, 0, false, 400 UNION ALL SELECT 'lost-2', 0, 0, false, 400""",
    "task_runs": f"""
WITH {_PUSHES}, {_CHANGES.replace(_DOCS + ",", "", 1).strip()}, {_delta('n % 4 = 1 AND n % 37 <> 0', 100)}, {_VISIBLE_FILES},
pushed AS (
  SELECT 28 * (t.e % 2) + 8 AS k, t.kind <> 'removed' AND (doc.doc_id IS NULL OR doc.doc_id % 31 = 0) AS failed
  FROM touched t LEFT JOIN documents doc ON doc.doc_id = t.d AND doc.doc_id % 20 = t.r AND t.e % 23 <> 0
  WHERE t.e % 17 <> 0),
done AS (
  SELECT k, count(*) AS n, count(*) FILTER (failed) AS bad FROM pushed GROUP BY k
  UNION ALL SELECT 9, count(*), count(*) FILTER (failed) FROM delta
  UNION ALL SELECT s_suppkey, (SELECT count(*) FROM files WHERE repo = 'https://github.com/org/r' || (s_suppkey % 20)), 0
            FROM supplier WHERE s_suppkey % 28 = 2
  UNION ALL SELECT s_suppkey, count(*), count(*) FILTER (status_code >= 400)
            FROM supplier JOIN ({_drive_scan('doc_id % 13 <> 0')}) f ON substr(f.id, 2)::BIGINT % 4 = s_suppkey % 3
            WHERE s_suppkey % 28 = 4 GROUP BY ALL
  UNION ALL SELECT s_suppkey, 1, CASE WHEN s_suppkey % 28 = 1 THEN 1 ELSE 0 END FROM supplier WHERE s_suppkey % 28 NOT IN (2, 3, 4, 5, 6, 8, 9)),
judged AS (
  SELECT s_suppkey AS k, CASE WHEN s_suppkey % 28 IN (2, 3, 8) THEN 'git' WHEN s_suppkey % 28 IN (4, 5, 6, 9) THEN 'drive' ELSE 'http' END AS plugin,
    CASE WHEN s_suppkey % 28 = 3 THEN 'Git operation failed: repository or branch not found: https://github.com/org/lost' || s_suppkey || ' main'
         WHEN s_suppkey % 28 = 8 AND s_suppkey > 36 THEN 'Git operation failed: repository or branch not found: https://github.com/org/any main'
         WHEN s_suppkey % 28 = 5 THEN 'Google Drive folder not found: lost' || s_suppkey
         WHEN s_suppkey % 28 = 6 THEN 'Missing or invalid ''folderId'' in configuration. Client not initialized.' END AS problem
  FROM supplier)
SELECT 'task' || j.k AS task_id, plugin AS plugin_type, problem IS NULL AS success,
       CASE WHEN problem IS NULL THEN 200 WHEN j.k % 28 = 6 THEN 400 ELSE 500 END AS code,
       coalesce(problem, CASE plugin WHEN 'http' THEN 'HTTP crawl successful.' WHEN 'git' THEN 'Repository cloned/pulled and files read successfully'
                                     ELSE 'Google Drive folder scan successful.' END) AS message,
       coalesce(n, 0) AS crawled_count, coalesce(bad, 0) AS error_count
FROM judged j LEFT JOIN done d ON d.k = j.k""",
    "apply_changes": f"""
WITH {_CHANGES}, {_delta('n % 37 <> 0', 0)},
log AS (
  SELECT 'drive:' || id AS entity_key, -1 AS seq, 'live' AS action FROM ({_drive_scan('doc_id % 13 <> 0')}) WHERE status_code = 200
  UNION ALL
  SELECT 'drive:' || id, seq, action FROM delta WHERE NOT failed),
ranked AS (SELECT *, row_number() OVER (PARTITION BY entity_key ORDER BY seq DESC) AS rn FROM log)
SELECT entity_key, seq AS last_op_seq, 200 AS status_code FROM ranked WHERE rn = 1 AND action = 'live'""",
    "corpus_streams": f"""
WITH {_PUSHES}, {_CHANGES.replace(_DOCS + ",", "", 1).strip()}, {_delta('n % 37 <> 0', 0)},
pushed AS (
  SELECT 'git:org/r' || t.r || ':' || t.branch || ':' || t.path AS entity_key, t.e AS seq, t.kind,
         CASE t.kind WHEN 'added' THEN 0 WHEN 'removed' THEN 3 ELSE CASE WHEN t.d = t.d1 THEN 2 ELSE 1 END END AS pos,
         t.kind <> 'removed' AND (doc.doc_id IS NULL OR doc.doc_id % 31 = 0) AS failed
  FROM (SELECT t.*, p.d1 FROM touched t JOIN pushes p USING (e)) t
  LEFT JOIN documents doc ON doc.doc_id = t.d AND doc.doc_id % 20 = t.r AND t.e % 23 <> 0
  WHERE t.e % 17 <> 0),
log AS (
  SELECT entity_key, seq, pos, kind <> 'removed' AS live FROM pushed WHERE NOT failed
  UNION ALL SELECT 'drive:' || id, seq, 0, action = 'live' FROM delta WHERE NOT failed),
ranked AS (SELECT *, row_number() OVER (PARTITION BY entity_key ORDER BY seq DESC, pos DESC) AS rn FROM log)
SELECT entity_key, seq AS last_op_seq, 'UPSERT' AS change_op FROM ranked WHERE rn = 1 AND live""",
    "poll_diff": """
WITH later AS (
  SELECT CASE WHEN page_id % 11 = 0 THEN 'https://moved.example.com/' || page_id ELSE url END AS url,
         CASE WHEN page_id % 7 = 0 THEN html || '<!-- edited -->' ELSE html END AS body FROM pages)
SELECT coalesce(l.url, p.url) AS url,
       CASE WHEN p.url IS NULL THEN 'added' WHEN l.url IS NULL THEN 'removed' ELSE 'modified' END AS change
FROM pages p FULL JOIN later l ON l.url = p.url
WHERE p.url IS NULL OR l.url IS NULL OR sha256(p.html) <> sha256(l.body)""",
}

# The same addresses from a clustered snapshot.
ORACLES["bucketed_fetch"] = ORACLES["web_fetch"]
# The feed from its token on, by the tokens of three streams; half of it was there at the handshake.
ORACLES["drive_feed_stream"] = " UNION ALL ".join(
    f"SELECT '{run}' AS run, * FROM ({ORACLES['drive_delta']}) WHERE seq >= {token}" for run, token in (("backlog", 100), ("held", 250), ("handshake", 500))
)
# The last change of each file, of those that are there.
ORACLES["corpus_levels"] = f"""
WITH {_CHANGES}, {_delta('n % 37 <> 0', 0)},
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM delta WHERE NOT failed)
SELECT 'drive:' || id AS entity_key, seq AS last_op_seq, 200 AS status_code FROM ranked WHERE rn = 1 AND action = 'live'"""
# Records by the tasks they are numbered to; tasks with number 12 have no destination.
ORACLES["delivered_records"] = f"""
WITH {_VISIBLE_FILES}, {_UNIFIED},
numbered AS (SELECT *, length(id) % 13 AS number, CASE task_id WHEN 'web-1' THEN 0 WHEN 'web-2' THEN 1 WHEN 'git-1' THEN 2 ELSE 3 END AS i FROM unified)
SELECT 'place ' || ((i * 13 + number) % 50) AS destination, CASE WHEN source = 'web' THEN 'first' ELSE 'second' END AS run, id, status_code, change_op
FROM numbered WHERE number < 12"""
ORACLES["tree_files"] = """
SELECT 'https://github.com/org/tree-' || path AS id, 'https://github.com/org/tree/blob/main/' || path AS url, length(text) AS n_chars, sha256(text) AS content_sha256
FROM (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, 'und') || '/part ' || (doc_id % 7) || '/' || CASE WHEN doc_id % 29 = 0 THEN '_d' ELSE 'd' END || doc_id || '.txt' AS path
      FROM documents WHERE doc_id % 20 <> 0 AND doc_id % 23 <> 0)"""
ORACLES["poll_index"] = f"SELECT 0 AS poll, url, 'added' AS change FROM pages UNION ALL SELECT 1, url, change FROM ({ORACLES['poll_diff']})"

"""The schemas shared by all operators, as DDL texts."""

from __future__ import annotations

WEB_INFO = "struct<content_type string, depth int>"
GIT_INFO = (
    "struct<file_path string, commit_sha string, commit_message string, repo string, branch string,"
    " pusher string, commit_author string>"
)
DRIVE_INFO = (
    "struct<file_id string, file_name string, mime_type string, file_size bigint, ingestion_type string,"
    " created_time string, modified_time string, parents array<string>, trashed boolean>"
)

# One row per fetched, listed or changed item, whatever its source; failures are rows too.
RECORD = {
    "source": "string",
    "id": "string",
    "url": "string",
    "status_code": "int",
    "fetched_at": "timestamp",
    "content_kind": "string",
    "content_text": "string",
    "content_binary": "binary",
    "change_type": "string",
    "change_op": "string",
    "entity_key": "string",
    "web": WEB_INFO,
    "git": GIT_INFO,
    "drive": DRIVE_INFO,
    "error": "string",
    "task_id": "string",
}
RECORD_DDL = ", ".join(f"{name} {kind}" for name, kind in RECORD.items())

PAGE = (
    "url string, status_code int, content_type string, body string, error string, fetched_at timestamp"
)
REPO_FILE = ("repo string, branch string, commit_sha string, path string, content binary")
DRIVE_FILE = (
    "id string, name string, mimeType string, webViewLink string, webContentLink string, size string,"
    " createdTime string, modifiedTime string, parents array<string>, trashed boolean"
)
DRIVE_CHANGE = f"seq bigint, fileId string, removed boolean, file struct<{DRIVE_FILE}>"
DRIVE_CONTENT = ("file_id string, content binary, error string")

_COMMIT = (
    "struct<id string, message string, timestamp string, url string,"
    " author struct<name string, email string, username string>,"
    " added array<string>, modified array<string>, removed array<string>>"
)
PUSH = (
    "ref string, before string, after string,"
    " repository struct<id bigint, name string, full_name string, html_url string>,"
    " pusher struct<name string, email string>,"
    f" commits array<{_COMMIT}>, head_commit {_COMMIT}"
)
PUSH_EVENT = ("event_id bigint, body string")

DELIVERY = (
    "event_id bigint, endpoint_id string, service string, headers map<string,string>, body string"
)
REGISTRY = (
    "source_identifier string, endpoint_id string, secret string, external_webhook_id string,"
    " registered_tasks array<string>, webhook_flag boolean, start_page_token string,"
    " next_page_token string"
)
WEB_CONFIG = (
    "startUrl string, maxDepth int, recursiveCrawling boolean, sitemapDiscovery boolean,"
    " allowedDomains array<string>, excludePaths array<string>, includePaths array<string>,"
    " requestTimeoutMs int, userAgent string, headers map<string,string>"
)
GIT_CONFIG = ("repoUrl string, branch string, depth int")
DRIVE_CONFIG = (
    "folderId string, authType string, serviceAccountKeyPath string, serviceAccountKey string, pageSize int"
)

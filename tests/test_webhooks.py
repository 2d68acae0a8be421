import hashlib
import hmac
import json

import pytest
from pyspark.sql import functions as F

from feedloom.operators import webhooks

SECRET = "s3cret"


def sign(body, secret=SECRET, algorithm="sha256"):
    return f"{algorithm}=" + hmac.new(secret.encode(), body.encode(), hashlib.sha256).hexdigest()


def raw(spark, *rows):
    """rows: (service, headers, secret, body)"""
    data = [(i, s, h, k, b) for i, (s, h, k, b) in enumerate(rows)]
    return spark.createDataFrame(data, "event_id bigint, service string, headers map<string,string>, secret string, body string")


def judge(spark, service, headers, secret, body):
    return webhooks.normalize_webhooks(raw(spark, (service, headers, secret, body))).first()


BODY = json.dumps({"repository": {"full_name": "u/r"}, "note": "ü"}, ensure_ascii=False)
GIT, DRIVE = "git-crawler", "googledrive-crawler"


@pytest.mark.parametrize("header", ["x-hub-signature-256", "x-hub-signature"])
def test_signed_push(spark, header):
    r = judge(spark, GIT, {"x-github-event": "push", header: sign(BODY)}, SECRET, BODY)
    assert (r.is_valid, r.external_resource_id, r.change_type, r.error) == (True, "https://github.com/u/r", "UPSERT", None)
    assert r.payload == BODY


@pytest.mark.parametrize(
    "service, headers, secret, body, error",
    [
        (GIT, {}, SECRET, None, "Invalid webhook body type."),
        ("other", {}, None, None, "Invalid webhook body type."),
        ("other", {}, None, "{}", "No handler found for webhook service: other"),
        ("Git-Crawler", {}, None, "{}", "No handler found for webhook service: Git-Crawler"),
        (GIT, {}, None, "{broken", "Invalid JSON payload."),
        (GIT, {}, None, BODY + "x", "Invalid JSON payload."),
        (GIT, {}, None, "", "Invalid JSON payload."),
        (GIT, {"x-hub-signature-256": sign(BODY, algorithm="sha1")}, SECRET, BODY, "Unsupported signature algorithm."),
        (GIT, {"x-hub-signature-256": sign(BODY, "wrong")}, SECRET, BODY, "Invalid webhook signature."),
        (GIT, {"x-hub-signature-256": sign(BODY).upper().replace("SHA", "sha")}, SECRET, BODY, "Invalid webhook signature."),
        (GIT, {"x-hub-signature-256": "sha256"}, SECRET, BODY, "Invalid webhook signature."),
        (GIT, {}, SECRET, BODY, "Webhook signature validation skipped or failed."),
        (GIT, {"x-hub-signature-256": ""}, SECRET, BODY, "Webhook signature validation skipped or failed."),
        (GIT, {}, None, "{}", "Could not extract externalResourceId (repository full name)."),
        (GIT, {}, None, "5", "Could not extract externalResourceId (repository full name)."),
        (GIT, {}, None, '{"repository": null}', "Could not extract externalResourceId (repository full name)."),
        (GIT, {}, None, '{"repository": {"full_name": ""}}', "Could not extract externalResourceId (repository full name)."),
        (DRIVE, {"x-goog-channel-id": "other"}, "ch", "", "Invalid channel ID or token mismatch."),
        (DRIVE, {}, "ch", "", "Invalid channel ID or token mismatch."),
        (DRIVE, {}, None, "", "Could not extract actual Drive folder ID from x-goog-resource-uri."),
        (DRIVE, {"x-goog-resource-uri": "not a url"}, None, "", "Could not extract actual Drive folder ID from x-goog-resource-uri."),
        (DRIVE, {"x-goog-resource-uri": "https://h/files/"}, None, "", "Could not extract actual Drive folder ID from x-goog-resource-uri."),
    ],
)
def test_refused(spark, service, headers, secret, body, error):
    r = judge(spark, service, headers, secret, body)
    assert (r.is_valid, r.error) == (False, error)
    if "skipped" not in error:
        assert (r.external_resource_id, r.change_type, r.payload) == (None, None, None)


@pytest.mark.parametrize(
    "event, deleted, change",
    [
        ("push", "false", "UPSERT"), ("push", "true", "DELETE"), ("push", "0", "UPSERT"), ("push", '""', "UPSERT"),
        ("push", "null", "UPSERT"), ("push", '"no"', "DELETE"), ("push", "{}", "DELETE"), ("push", "[]", "DELETE"),
        ("pull_request", "true", "UPSERT"), ("issues", "false", "UNKNOWN"), (None, "false", "UNKNOWN"),
    ],
)
def test_git_change_types(spark, event, deleted, change):
    headers = {"x-github-event": event} if event else {}
    r = judge(spark, GIT, headers, "", '{"repository": {"full_name": "u/r"}, "deleted": %s}' % deleted)
    assert (r.is_valid, r.change_type) == (True, change)


@pytest.mark.parametrize(
    "state, change",
    [("exists", "UPSERT"), ("add", "UPSERT"), ("update", "UPSERT"), ("not_exists", "DELETE"), ("trash", "DELETE"),
     ("sync", "UNKNOWN"), ("changed", "UNKNOWN"), (None, "UNKNOWN")],
)
def test_drive_states(spark, state, change):
    headers = {"x-goog-channel-id": "ch", "x-goog-resource-id": "rid",
               "x-goog-resource-uri": "https://www.googleapis.com/drive/v3/files/F1?alt=json"}
    if state:
        headers["x-goog-resource-state"] = state
    r = judge(spark, DRIVE, headers, "ch", "")
    assert (r.is_valid, r.external_resource_id, r.change_type) == (True, "F1", change)
    payload = json.loads(r.payload)
    assert payload["channelResourceId"] == "rid" and payload["x-goog-channel-id"] == "ch"
    assert payload.get("resourceState") == payload.get("x-goog-resource-state") == state


def test_registry_gives_the_secret_and_it_does_not_leak(spark):
    registry = spark.createDataFrame(
        [("/git", SECRET, None), ("/drive", "unused", "ch")], "endpoint_id string, secret string, external_webhook_id string"
    )
    data = [
        (1, "/git", GIT, {"x-hub-signature-256": sign(BODY)}, BODY),
        (2, "/git", GIT, {"x-hub-signature-256": sign(BODY, "no")}, BODY),
        (3, "/drive", DRIVE, {"x-goog-channel-id": "ch", "x-goog-resource-uri": "https://h/f/F1"}, ""),
        (4, "/drive", DRIVE, {"x-goog-channel-id": "unused", "x-goog-resource-uri": "https://h/f/F1"}, ""),
    ]
    df = spark.createDataFrame(data, "event_id bigint, endpoint_id string, service string, headers map<string,string>, body string")
    verdicts = webhooks.normalize_webhooks(df, registry)
    assert verdicts.columns == ["event_id", "is_valid", "payload", "external_resource_id", "change_type", "error"]
    assert {r.event_id: r.is_valid for r in verdicts.collect()} == {1: True, 2: False, 3: True, 4: False}


def test_route(spark):
    verdicts = spark.createDataFrame(
        [(1, True, "a", "UPSERT"), (2, False, "a", "UPSERT"), (3, True, "off", "DELETE"), (4, True, "b", "DELETE"), (5, True, "none", "UPSERT"), (6, True, "zero", "UPSERT")],
        "event_id bigint, is_valid boolean, external_resource_id string, change_type string",
    )
    registry = spark.createDataFrame(
        [("a", ["t1", "t2"], True), ("off", ["t3"], False), ("b", ["t1"], True), ("zero", [], True)],
        "source_identifier string, registered_tasks array<string>, webhook_flag boolean",
    )
    got = {tuple(r) for r in webhooks.route(verdicts, registry).collect()}
    assert got == {(1, "t1", "UPSERT"), (1, "t2", "UPSERT"), (4, "t1", "DELETE")}

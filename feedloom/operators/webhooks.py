"""Webhook deliveries: authenticate, classify and route them.

Every delivery is judged on its own, so the same code serves tables and streams. Secrets are
used on the way and never selected into a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.crypto import hmac_pads, hmac_sha256_hex
from ..functions.jsontext import is_json
from ..functions.urls import parse_absolute, url_path
from ..functions.values import first_text, is_blank, json_truthy, let
from ..plans.lookup import lookup

# The services deliveries name, exactly so.
GIT_SERVICE = "git-crawler"
DRIVE_SERVICE = "googledrive-crawler"

# What a refused delivery says.
BAD_BODY = "Invalid webhook body type."
NO_HANDLER = "No handler found for webhook service: "
BAD_JSON = "Invalid JSON payload."
BAD_ALGORITHM = "Unsupported signature algorithm."
BAD_SIGNATURE = "Invalid webhook signature."
NO_REPOSITORY = "Could not extract externalResourceId (repository full name)."
BAD_CHANNEL = "Invalid channel ID or token mismatch."
NO_FOLDER = "Could not extract actual Drive folder ID from x-goog-resource-uri."
NOT_SIGNED = "Webhook signature validation skipped or failed."

# Resource states by what they say about the folder.
UPSERT_STATES = ("exists", "add", "update")
DELETE_STATES = ("not_exists", "trash")

# Headers a drive notification's payload is made of.
DRIVE_PAYLOAD_HEADERS = (
    "x-goog-channel-id",
    "x-goog-message-number",
    "x-goog-resource-state",
    "x-goog-resource-uri",
)


def _header(name: str) -> Column:
    return F.try_element_at("headers", F.lit(name))


def _with_secrets(deliveries: DataFrame, registry: DataFrame | None, on: str, spread: tuple[str, ...]) -> DataFrame:
    """Adds ``__secret`` and ``__pads``; with a registry, key blocks are made once per entry."""
    if registry is None:
        secret = F.nullif(F.col("secret"), F.lit(""))
        return deliveries.withColumn("__secret", secret).withColumn(
            "__pads", F.when(F.col("service") == GIT_SERVICE, hmac_pads(F.col("__secret")))
        )
    entries = registry.select(
        F.col(on),
        F.nullif(F.col("secret"), F.lit("")).alias("__git_secret"),
        F.nullif(F.col("external_webhook_id"), F.lit("")).alias("__channel"),
        hmac_pads(F.nullif(F.col("secret"), F.lit(""))).alias("__pads"),
    )
    return lookup(deliveries, entries, [on]).withColumn(
        "__secret", F.when(F.col("service") == DRIVE_SERVICE, F.col("__channel")).otherwise(F.col("__git_secret"))
    )


def _git_result() -> Column:
    secret, body = F.col("__secret"), F.col("body")
    signature = first_text(_header("x-hub-signature-256"), _header("x-hub-signature"))
    signed = secret.isNotNull() & signature.isNotNull()
    parts = F.split(signature, "=")
    bad_algorithm = signed & (F.get(parts, F.lit(0)) != "sha256")
    matches = hmac_sha256_hex(F.col("__pads"), body).eqNullSafe(F.get(parts, F.lit(1)))
    event = _header("x-github-event")

    def judged(doc: Column) -> Column:
        name, deleted = doc["repository"]["full_name"], doc["deleted"]
        error = (
            F.when(~is_json(body), BAD_JSON)
            .when(bad_algorithm, BAD_ALGORITHM)
            .when(signed & ~matches, BAD_SIGNATURE)
            .when(~json_truthy(name), NO_REPOSITORY)
        )
        return F.struct(
            error.alias("error"),
            signed.alias("validated"),
            F.concat(F.lit("https://github.com/"), F.variant_get(name, "$", "string")).alias("resource"),
            F.when(event == "push", F.when(json_truthy(deleted), "DELETE").otherwise("UPSERT"))
            .when(event == "pull_request", "UPSERT")
            .otherwise("UNKNOWN")
            .alias("change"),
            body.alias("payload"),
        )

    # Field by field, so that repeated keys do no harm.
    return let(F.from_json(body, "deleted variant, repository struct<full_name variant>"), judged)


def _drive_result() -> Column:
    secret, state = F.col("__secret"), _header("x-goog-resource-state")
    resource = F.element_at(F.split(url_path(parse_absolute(_header("x-goog-resource-uri"))), "/"), -1)
    error = F.when(
        secret.isNotNull() & ~secret.eqNullSafe(_header("x-goog-channel-id")),
        BAD_CHANNEL,
    ).when(is_blank(resource), NO_FOLDER)
    payload = F.to_json(
        F.struct(
            _header("x-goog-resource-id").alias("channelResourceId"),
            state.alias("resourceState"),
            *[_header(h).alias(h) for h in DRIVE_PAYLOAD_HEADERS],
        )
    )
    return F.struct(
        error.alias("error"),
        secret.isNotNull().alias("validated"),
        resource.alias("resource"),
        F.when(state.isin(*UPSERT_STATES), "UPSERT")
        .when(state.isin(*DELETE_STATES), "DELETE")
        .otherwise("UNKNOWN")
        .alias("change"),
        payload.alias("payload"),
    )


def normalize_webhooks(
    deliveries: DataFrame,
    registry: DataFrame | None = None,
    *,
    keep: tuple[str, ...] = ("event_id",),
    on: str = "endpoint_id",
) -> DataFrame:
    """``keep`` plus is_valid, payload, external_resource_id, change_type and error per delivery.

    ``deliveries(service, headers, body)`` carries its own ``secret`` column, or gets it from
    ``registry`` (at most one entry per ``on``), where drive channels are checked against
    ``external_webhook_id``. Without a secret nothing is checked. The first failing check, in the
    order body, service, JSON, signature, resource, gives the error.
    """
    service = F.col("service")
    refused = F.when(F.col("body").isNull(), BAD_BODY).when(
        ~F.coalesce(service.isin(GIT_SERVICE, DRIVE_SERVICE), F.lit(False)),
        F.concat(F.lit(NO_HANDLER), F.coalesce(service, F.lit("undefined"))),
    )
    r = F.col("__result")
    success = F.col("__refused").isNull() & r["error"].isNull()
    unchecked = F.col("__secret").isNotNull() & ~r["validated"]
    return (
        _with_secrets(deliveries, registry, on, keep)
        .select(
            *keep,
            "__secret",
            refused.alias("__refused"),
            F.when(
                refused.isNull(), F.when(service == GIT_SERVICE, _git_result()).otherwise(_drive_result())
            ).alias("__result"),
        )
        .select(
            *keep,
            F.coalesce(success & ~unchecked, F.lit(False)).alias("is_valid"),
            F.when(success, r["payload"]).alias("payload"),
            F.when(success, r["resource"]).alias("external_resource_id"),
            F.when(success, r["change"]).alias("change_type"),
            F.coalesce(
                F.col("__refused"),
                r["error"],
                F.when(success & unchecked, NOT_SIGNED),
            ).alias("error"),
        )
    )


def route(verdicts: DataFrame, registry: DataFrame, *, keep: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """``keep``, ``task_id`` and ``change_type`` for every task registered for a valid delivery.

    The registry has one entry per source; only those whose webhook is active count.
    """
    valid = verdicts.where("is_valid").select(
        *keep, "change_type", F.col("external_resource_id").alias("source_identifier")
    )
    active = registry.where("webhook_flag").select("source_identifier", F.col("registered_tasks").alias("__tasks"))
    return lookup(valid, active, ["source_identifier"]).select(
        *keep, F.explode("__tasks").alias("task_id"), "change_type"
    )

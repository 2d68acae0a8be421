"""Readers for the inputs in the forms they are usually kept in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DELIVERY, DRIVE_CHANGE, DRIVE_FILE, PAGE, PUSH_EVENT, REGISTRY


def _read(spark: SparkSession, path: str, kind: str, schema: str) -> DataFrame:
    return spark.read.format(kind).schema(schema).load(path)


def pages(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame:
    return _read(spark, path, kind, PAGE)


def robots(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    return _read(spark, path, kind, "host string, body string")


def sitemaps(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    return _read(spark, path, kind, "url string, body string")


def deliveries(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    return _read(spark, path, kind, DELIVERY)


def push_events(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    return _read(spark, path, kind, PUSH_EVENT)


def registry(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    return _read(spark, path, kind, REGISTRY)


def tasks(spark: SparkSession, path: str) -> DataFrame:
    """Task definitions as JSON documents: the plugin and its configuration sit under ``source``."""
    nested = spark.read.schema(
        "id string, name string, enabled boolean, currentStatus string, startPageToken string,"
        " nextPageToken string, trigger struct<type string, expression string>,"
        " source struct<pluginType string, config string>, destination struct<pluginType string, config string>"
    ).json(path, multiLine=True)
    return nested.select(
        F.col("id").alias("task_id"),
        F.col("source")["pluginType"].alias("plugin_type"),
        F.col("source")["config"].alias("config"),
        "name",
        F.coalesce("enabled", F.lit(True)).alias("enabled"),
        F.col("trigger")["type"].alias("trigger_type"),
        F.col("currentStatus").alias("status"),
        F.col("startPageToken").alias("start_page_token"),
        F.col("nextPageToken").alias("next_page_token"),
        "destination",
    )


def drive_listing(spark: SparkSession, path: str) -> DataFrame:
    """Files from saved listing responses, one JSON document per page of the listing.

    All pages are read, so the page size does not matter.
    """
    page = spark.read.schema(f"files array<struct<{DRIVE_FILE}>>").json(path, multiLine=True)
    return page.select(F.inline("files"))


def drive_changes(spark: SparkSession, path: str) -> DataFrame:
    """The change feed as a table with a position ``seq`` per change; sorted by it, reads from a
    token touch only the files behind it."""
    return _read(spark, path, "parquet", DRIVE_CHANGE)


def drive_change_pages(spark: SparkSession, path: str) -> DataFrame:
    """Changes from saved feed responses: pages with ``pageToken``, the position of their first change."""
    change = f"struct<fileId string, removed boolean, file struct<{DRIVE_FILE}>>"
    page = spark.read.schema(f"pageToken bigint, changes array<{change}>").json(path, multiLine=True)
    return page.select("pageToken", F.posexplode("changes").alias("__pos", "__change")).select(
        (F.col("pageToken") + F.col("__pos")).alias("seq"), "__change.*"
    )

"""Records that share what they hold: contents written once by digest, scans written once for all tasks that ask for them.

Operators are handed stand-ins of contents, which they judge as they would judge the contents: NULL, empty, text or not
UTF-8, JSON or not. What they make of them refers to the contents, and :meth:`Shared.of` puts these in again.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import lossy_utf8
from ..session import Staging
from .lookup import first_per_key, wanted_rows

# The SHA-256 digest of the content that a record refers to, NULL for one that has its own.
CONTENT = "__content_sha256"
# The scan a record is of, for all tasks that ask for it; NULL for a record of the task it names.
SCAN = "__scan"

_PREFIX = "sha256:"
_STAND_IN = f'^\ufffd?"?{_PREFIX}([0-9a-f]{{64}})"?$'


def stand_in(content: Column) -> Column:
    """For a binary content: NULL, empty, or a short one that is UTF-8 if the content is."""
    name = F.encode(F.concat(F.lit(_PREFIX), F.sha2(content, 256)), "UTF-8")
    whole = F.is_valid_utf8(content.cast("string"))
    return F.when(F.length(content) == 0, content).when(content.isNotNull(), F.when(whole, name).otherwise(F.concat(F.unhex(F.lit("ff")), name)))


def text_stand_in(text: Column, json: Column) -> Column:
    """For a text: NULL, empty, or a short one that is JSON where the text is meant as ``json`` and is."""
    name = F.concat(F.lit(_PREFIX), F.sha2(text.cast("binary"), 256))
    quoted = F.concat(F.lit('"'), name, F.lit('"'))
    return F.when(text == "", text).when(text.isNotNull(), F.when(json & F.try_parse_json(text).isNotNull(), quoted).otherwise(name))


def referring(records: DataFrame) -> DataFrame:
    """Records made of stand-ins, with the digests in CONTENT; an empty text or binary marks what the content goes to."""
    text, binary = F.col("content_text"), F.col("content_binary")
    digest = F.regexp_extract(F.coalesce(text, binary.cast("string")), _STAND_IN, 1)
    refers = F.col(CONTENT).isNotNull()
    return records.withColumn(CONTENT, F.unhex(F.nullif(digest, F.lit("")))).withColumns(
        {
            "content_text": F.when(refers & text.isNotNull(), "").otherwise(text),
            "content_binary": F.when(refers & binary.isNotNull(), F.unhex(F.lit(""))).otherwise(binary),
        }
    )


def write_contents(records: DataFrame, stores: Mapping[str, DataFrame], staging: Staging) -> DataFrame:
    """``(CONTENT, content)`` of the contents that written ``records`` refer to, each from the first store that holds it.

    ``stores`` has a table ``content`` for each source of records. Contents are written where they are read; only beyond
    the keys that a look-up tells all tasks does each move once. What a store holds several times may be there as often.
    """
    kept = None
    for number, (source, rows) in enumerate(stores.items()):
        due = records.where(F.col(CONTENT).isNotNull() & (F.col("source") == source)).select(CONTENT).distinct()
        if kept is not None:
            due = due.join(kept.select(CONTENT).distinct(), CONTENT, "left_anti")
        due = staging.write(due, f"due/{source}")
        rows = rows.where(F.length("content") > 0).select(F.unhex(F.sha2("content", 256)).alias(CONTENT), "content")
        near = wanted_rows(due, rows, [CONTENT])
        near = rows.join(due, CONTENT, "left_semi") if near is rows else near
        staging.write(near, f"contents/store={number}")
        kept = staging.spark.read.schema(f"{CONTENT} binary, content binary, store int").parquet(f"{staging.path}/contents")
    return kept


@dataclass(frozen=True)
class Shared:
    """Written records, the ``(SCAN, task_id)`` of tasks that ask for a scan, and the contents that records refer to."""

    rows: DataFrame
    holders: DataFrame | None = None
    contents: DataFrame | None = None

    def of(self, tasks: DataFrame | None = None) -> DataFrame:
        """The records of each task, whole; of those in ``tasks(task_id)`` if given."""
        rows, holders = self.rows, self.holders
        columns = [c for c in rows.columns if c not in (SCAN, CONTENT)]
        own = rows if SCAN not in rows.columns else rows.where(F.col(SCAN).isNull())
        own = own if tasks is None else own.join(tasks, "task_id", "left_semi")
        found = own.drop(SCAN)
        if holders is not None:
            holders = holders if tasks is None else holders.join(tasks, "task_id", "left_semi")
            scanned = rows.where(F.col(SCAN).isNotNull()).drop("task_id").join(holders, SCAN)
            found = found.unionByName(scanned.drop(SCAN))
        if self.contents is None:
            return found.select(*columns)
        contents = first_per_key(self.contents, [CONTENT], [F.asc("store")]).select(CONTENT, F.col("content").alias("__content"))
        text, content = F.col("content_text"), F.col("__content")
        met = found.where(F.col(CONTENT).isNotNull()).join(contents, CONTENT, "left").withColumns(
            {
                # Pages are kept as the texts they are.
                "content_text": F.when(text.isNotNull(), F.when(F.col("source") == "web", content.cast("string")).otherwise(lossy_utf8(content))),
                "content_binary": F.when(F.col("content_binary").isNotNull(), content),
            }
        )
        return found.where(F.col(CONTENT).isNull()).select(*columns).unionByName(met.select(*columns))

    def counted(self) -> DataFrame:
        """``(task_id, crawled_count, error_count)``: the records of each task, counted once for each scan."""
        total = lambda rows, *by: rows.groupBy(*by).agg(F.sum("crawled_count").alias("crawled_count"), F.sum("error_count").alias("error_count"))
        each = self.rows.select(
            "task_id", *([SCAN] if self.holders is not None else []),
            F.lit(1).cast("bigint").alias("crawled_count"), (F.coalesce(F.col("status_code") >= 400, F.lit(False))).cast("bigint").alias("error_count"),
        )
        if self.holders is None:
            return total(each, "task_id")
        by = total(each, "task_id", SCAN)
        scanned = by.where(F.col(SCAN).isNotNull()).drop("task_id").join(self.holders, SCAN)
        return total(by.where(F.col(SCAN).isNull()).drop(SCAN).unionByName(scanned.drop(SCAN)), "task_id")

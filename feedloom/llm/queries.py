"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import brown, collocations, decontamination, fingerprints, jaccard, langid, minmax, packing, pii, quality, secrets, spelling, warc
from .common import fold_of, table


def _written(spans: Column) -> Column:
    """kind:start:end, comma-joined in the order of the array."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = fold_of(F.col("doc_id"), 3)
    found = quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn=fold != 1)
    return found.select("doc_id", (fold == 1).alias("held_out"), "score", "predicted")


def op3_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = fold_of(F.col("doc_id"), 10)
    found = brown.score_documents(table(spark, sf_dir, "documents"), learn=fold != 0)
    return found.select(
        "doc_id", (fold == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
        brown.perplexity(F.col("score"), F.col("n_tokens")).alias("perplexity"),
    )


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = fold_of(F.col("doc_id"), 5)
    found = langid.language_ids(table(spark, sf_dir, "documents"), learn=fold != 0)
    return found.select("doc_id", (fold == 0).alias("held_out"), "lang_pred", "score", "ambiguous")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array(*map(F.lit, pii.KINDS))
    order = F.sort_array(
        F.transform(
            F.concat("base", "added"),
            lambda s: F.struct(F.array_position(kinds, s.kind).alias("k"), s.start.alias("start"), s.end.alias("end"), s.kind.alias("kind")),
        )
    )
    return pii.find_pii(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *(_count(F.col("base"), kind) for kind in pii.KINDS),
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(order).alias("spans"),
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok"
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_power_of_two(table(spark, sf_dir, "documents"), with_ids=False).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.filter("spans", lambda s: s.kind != "entropy")
    return secrets.find_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *(_count(F.col("spans"), kind) for kind in ("assign", "access", "hex")),
        F.sha2(_written(base), 256).alias("base_sha256"),
        _written(F.col("spans")).alias("spans"),
    )


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints_of_edits(table(spark, sf_dir, "documents"))


def op11_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicate_classes(table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_quality": op2_quality,
    "op3_brown": op3_brown,
    "op4_jaccard": op4_jaccard,
    "op5_language": op5_language,
    "op6_pii": op6_pii,
    "op7_warc": op7_warc,
    "op8_packing": op8_packing,
    "op9_secrets": op9_secrets,
    "op10_fingerprints": op10_fingerprints,
    "op11_minmax": op11_minmax,
    "op12_spelling": op12_spelling,
    "op13_collocations": op13_collocations,
}

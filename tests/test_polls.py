"""Polls that read only what may have changed."""

from pyspark.sql import functions as F

from feedloom.sinks.clustered import Clustered, bucket_of
from feedloom.sinks.polls import PollIndex


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), "url string, validator string, body string")


def poll(index, found):
    return {tuple(r) for r in index.poll(found.select("url", "validator"), found.select("url", "body")).collect()}


def test_changes_between_polls(spark, tmp_path):
    index = PollIndex(spark, str(tmp_path / "i"))
    assert poll(index, pages(spark, ("a", "1", "x"), ("b", None, "x"), ("c", "1", "x"), ("d", "1", None), (None, "1", "z"))) == {(u, "added") for u in "abcd"}
    assert poll(index, pages(spark, ("a", "1", "x"), ("b", None, "x"), ("c", "2", "x"), ("d", "1", None))) == set()
    # The same validator: the body is not looked at.
    assert poll(index, pages(spark, ("a", "1", "other"), ("b", None, "y"), ("c", "3", "y"), ("e", "1", ""))) == {("b", "modified"), ("c", "modified"), ("d", "removed"), ("e", "added")}
    assert poll(index, pages(spark, ("a", "1", "x"), ("d", "9", None))) == {("b", "removed"), ("c", "removed"), ("e", "removed"), ("d", "added")}
    (tmp_path / "i" / "version=99").mkdir()  # a poll that did not end
    assert poll(index, pages(spark, ("a", "1", "x"), ("d", "9", None))) == set()
    assert poll(index, pages(spark)) == {("a", "removed"), ("d", "removed")} and index.read().count() == 0


def test_only_the_buckets_of_changed_addresses_are_opened(spark, tmp_path, monkeypatch):
    first = spark.range(400).select(F.concat(F.lit("u"), "id").alias("url"), F.lit("1").alias("validator"), F.col("id").cast("string").alias("body"))
    index = PollIndex(spark, str(tmp_path / "i"))
    index.poll(first.select("url", "validator"), first.select("url", "body"))
    edited = first.withColumns({"validator": F.when(F.col("url") == "u7", "2").otherwise("1"), "body": F.when(F.col("url") == "u7", "new").otherwise(F.col("body"))})
    store = Clustered.write(edited.select("url", "body"), str(tmp_path / "s"), "url", 16)
    opened, holding = [], store.holding
    monkeypatch.setattr(store, "holding", lambda keys, column: opened.append(holding(keys, column)) or opened[-1])
    assert {tuple(r) for r in index.poll(edited.select("url", "validator"), store).collect()} == {("u7", "modified")}
    hit = edited.where("url = 'u7'").select(bucket_of(F.col("url"), 16)).first()[0]
    assert [f.rsplit("/", 1)[1] for f in opened[0].inputFiles()] == [f.rsplit("/", 1)[1] for f in store.files()[hit]]

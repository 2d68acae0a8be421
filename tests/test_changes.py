import random

import pytest
from pyspark.sql import functions as F

from feedloom.operators import changes, records
from feedloom.plans.lookup import lookup, lookup_staged
from feedloom.schemas import RECORD_DDL
from feedloom.session import Staging


def rows(spark, *items):
    """items: (seq, key, op, text)"""
    data = [(seq, "i" + key, key, op, text) for seq, key, op, text in items]
    return spark.createDataFrame(data, "seq bigint, id string, entity_key string, change_op string, content_text string")


def state(df):
    return {r.entity_key: r.content_text for r in df.collect()}


@pytest.mark.parametrize("staged", [False, True])
def test_later_changes_win_and_deletes_remove(spark, staged):
    staging = Staging(spark, "t") if staged else None
    first = changes.apply_changes(None, rows(
        spark, (1, "a", "UPSERT", "a1"), (2, "a", "UPSERT", "a2"), (3, "b", "UPSERT", "b"), (4, "b", "DELETE", ""), (5, "c", "UPSERT", "c"),
        (6, "c", "NONE", "failed")))
    assert state(first) == {"a": "a2", "c": "c"}
    delta = rows(spark, (7, "c", "DELETE", ""), (8, "d", "UPSERT", "d"), (9, "a", "NONE", "x"), (10, "b", "UPSERT", "again"))
    second = changes.apply_changes(first, delta, staging=staging)
    assert state(second) == {"a": "a2", "d": "d", "b": "again"}
    assert state(changes.apply_changes(second, delta)) == state(second)


def test_older_changes_do_not_replace_newer_copies(spark):
    stored = rows(spark, (10, "a", "UPSERT", "new"), (10, "b", "UPSERT", "new"))
    late = rows(spark, (5, "a", "UPSERT", "old"), (6, "b", "DELETE", ""))
    assert state(changes.apply_changes(stored, late)) == {"a": "new", "b": "new"}


def test_same_position_is_settled_by_id(spark):
    tied = spark.createDataFrame(
        [(1, "x", "k", "UPSERT", "x"), (1, "y", "k", "UPSERT", "y")],
        "seq bigint, id string, entity_key string, change_op string, content_text string")
    assert state(changes.apply_changes(None, tied)) == {"k": "y"}


def test_one_entity_with_a_third_of_all_changes(spark):
    rng = random.Random(3)
    items = [(i, "hot" if rng.random() < 1 / 3 else f"k{rng.randrange(300)}", rng.choice(["UPSERT", "UPSERT", "DELETE", "NONE"]), str(i)) for i in range(4000)]
    want = {}
    for seq, key, op, text in items:
        if op == "UPSERT":
            want[key] = text
        elif op == "DELETE":
            want.pop(key, None)
    cut = 2500
    before = changes.apply_changes(None, rows(spark, *items[:cut]))
    assert state(changes.apply_changes(before, rows(spark, *items[cut:]).repartition(5))) == want


def test_change_op(spark):
    df = spark.createDataFrame(
        [("added", 200, "UPSERT"), ("modified", 200, "UPSERT"), ("full_scan", 200, "UPSERT"), (None, 200, "UPSERT"), ("UPSERT", 200, "UPSERT"),
         ("removed", 200, "DELETE"), ("DELETE", 200, "DELETE"), ("added", 500, "NONE"), (None, 404, "NONE"), ("DELETE", 500, "NONE"), ("UNKNOWN", 200, "NONE")],
        "t string, s int, want string")
    assert all(r.want == r.got for r in df.select("want", records.change_op(F.col("t"), F.col("s")).alias("got")).collect())


def test_poll_diff(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", None), ("d", "x"), ("d", "y"), ("e", "x"), ("e", "y")], "url string, body string")
    new = spark.createDataFrame([("a", "2"), ("c", None), ("d", "y"), ("d", "x"), ("e", "x"), ("e", "z"), ("f", "1")], "url string, body string")
    assert {tuple(r) for r in changes.poll_diff(old, new).collect()} == {("a", "modified"), ("b", "removed"), ("e", "modified"), ("f", "added")}


def test_records_have_one_schema(spark):
    part = records.to_records(spark.range(2), source=F.lit("web"), id=F.lit("x"), status_code=F.lit(404), task_id=F.lit("t"))
    empty = spark.createDataFrame([], RECORD_DDL)
    assert part.schema.simpleString() == empty.schema.simpleString()
    both = records.unify(part, part.withColumn("seq", F.lit(1)))
    assert both.count() == 4
    outcomes = spark.createDataFrame([("t", 200), ("u", 500), ("v", 200)], "task_id string, code int")
    summary = {r.task_id: (r.crawled_count, r.error_count, r.success, r.code) for r in records.run_summary(both, outcomes).collect()}
    assert summary == {"t": (4, 4, True, 200), "u": (0, 0, False, 500), "v": (0, 0, True, 200)}
    with pytest.raises(ValueError):
        records.to_records(part, status_code=F.lit(200), nonsense=F.lit(1))


@pytest.mark.parametrize("how", [lookup, lookup_staged])
def test_lookup_is_a_left_join(spark, how):
    rng = random.Random(11)
    data = [(i, rng.choice(["hot", "hot", None, f"k{rng.randrange(40)}"]), rng.randrange(3)) for i in range(600)]
    left = spark.createDataFrame(data, "n int, k string, j int")
    right = spark.createDataFrame([("hot", j, f"hot{j}") for j in range(2)] + [(f"k{i}", 0, f"v{i}") for i in range(0, 80, 2)], "k string, j int, v string")
    got = how(left, right, ["k", "j"])
    want = left.join(right, ["k", "j"], "left").select("k", "j", "n", "v")
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


@pytest.mark.parametrize("how", [lookup, lookup_staged])
def test_lookup_moves_each_body_once(spark, how, tmp_path):
    """With broadcasts off, the long column is in one exchange, whatever the left side's size."""
    spark.range(100).select(F.col("id").cast("string").alias("k"), F.col("id").alias("body")).write.parquet(str(tmp_path / "r"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        right = spark.read.parquet(str(tmp_path / "r"))
        got = how(spark.range(7).select((F.col("id") % 3).cast("string").alias("k"), F.col("id").alias("n")), right, ["k"])
        plan = got._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.split("\n") if "Scan parquet" in line and "body" in line.split("ReadSchema")[-1]]
        assert len(scans) == 1 and "SortAggregate" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_ties_in_one_push_follow_the_list_of_files(spark):
    schema = "seq bigint, pos int, id string, entity_key string, change_op string, content_text string"
    rows = [(1, 0, "a", "a", "UPSERT", "x"), (1, 1, "a", "a", "DELETE", ""), (1, 0, "b", "b", "DELETE", ""), (1, 1, "b", "b", "UPSERT", "y")]
    for order in (rows, rows[::-1]):
        kept = changes.apply_changes(None, spark.createDataFrame(order, schema).coalesce(1)).collect()
        assert [(r.entity_key, r.content_text) for r in kept] == [("b", "y")]
    without = [spark.createDataFrame(order, schema).drop("pos").coalesce(1) for order in (rows, rows[::-1])]
    first, second = (sorted(map(tuple, changes.latest_changes(df).collect())) for df in without)
    assert first == second


def test_poll_diff_compares_all_of_a_digest(spark):
    before = spark.createDataFrame([("u", "x"), ("v", "1"), ("v", "2"), ("w", None)], "url string, body string")
    after = spark.createDataFrame([("u", "x"), ("v", "2"), ("v", "1"), ("w", "")], "url string, body string")
    assert [tuple(r) for r in changes.poll_diff(before, after).collect()] == [("w", "modified")]


def test_a_staged_side_that_repeats_itself_is_not_broadcast(spark):
    """Its files are small whatever its rows weigh: only hashes of its keys go to all tasks."""
    left = Staging(spark, "t").write(spark.range(5000).select(F.lit("k1").alias("k"), F.lit("wide" * 500).alias("w")), "left")
    right = spark.range(50).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("body"))
    got = lookup_staged(left, right, ["k"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [k" in plan and plan.count("BroadcastExchange") == 1 and "__mark" in plan.split("BroadcastExchange")[1]
    assert got.where("body = 1").count() == 5000


def test_long_lists_of_keys_are_not_broadcast_at_all(spark, monkeypatch):
    monkeypatch.setattr("feedloom.plans.lookup.FEW_KEYS", 10)
    left = Staging(spark, "t").write(spark.range(40).select((F.col("id") % 20).alias("k"), "id"), "left")
    right = spark.range(0, 30, 2).select(F.col("id").alias("k"), F.col("id").alias("body"))
    got = lookup_staged(left, right, ["k"])
    assert "BroadcastExchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.where("body is null").count() == 20 and got.count() == 40

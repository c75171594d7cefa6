import datetime as dt

import pytest
from pyspark.sql import functions as F

from roadevents.operators import dedup
from roadevents.operators.merge import (
    merge_upsert,
    require_unique_keys,
    without_replayed,
)

SCHEMA = "startDate string, linkId long, v string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_first_per_key_follows_the_order_column(spark):
    frame = spark.createDataFrame(
        [("s", 1, "b", 2), ("s", 1, "a", 1), ("s", None, "c", 3), ("s", None, "d", 4)],
        SCHEMA + ", seq long",
    )
    assert [r[2] for r in rows(dedup.dedup_first(frame))] == ["a", "c"]


def test_latest_null_keys_group_and_null_recency_wins(spark):
    frame = spark.createDataFrame(
        [(None, "old", 1), (None, "new", 2), (5.0, "dated", 9), (5.0, "undated", None)],
        "coordX double, v string, createdAt long",
    )
    kept = dedup.dedup_latest(frame, ["coordX"])
    assert {r.v for r in kept.collect()} == {"new", "undated"}


def test_latest_ties(spark):
    frame = spark.createDataFrame(
        [("k", 1, "a", 7), ("k", 1, "b", 8)], "k string, createdAt long, v string, place long"
    )
    assert dedup.dedup_latest(frame, ["k"], tiebreak=["place"]).first().v == "b"
    picks = {dedup.dedup_latest(frame.repartition(n), ["k"]).first().v for n in (1, 2, 3)}
    assert len(picks) == 1


def test_snapshot_latest_and_distinct(spark):
    old = spark.createDataFrame([("k", 1, "a"), ("l", 1, "b")], "k string, createdAt long, v string")
    new = spark.createDataFrame([(2, "c", "k")], "createdAt long, v string, k string")
    assert rows(dedup.snapshot_latest(old, new, ["k"])) == [("k", 2, "c"), ("l", 1, "b")]
    assert dedup.distinct_rows(old.union(old)).count() == 2


def test_unique_id(spark):
    frame = spark.createDataFrame([("s", 1, "x"), ("s", None, "y")], SCHEMA)
    assert [r.unique_id for r in dedup.with_unique_id(frame).collect()] == ["s_1", "s_"]


def test_a_key_with_most_rows_is_ranked_before_the_shuffle(spark):
    frame = spark.range(1000).select(
        F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("createdAt"),
    )
    kept = dedup.dedup_latest(frame, ["k"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert plan.index("row_number(), 1, Final") < exchange < plan.index("row_number(), 1, Partial")
    assert kept.where("k = 0").first().createdAt == 998
    assert kept.count() == 334


@pytest.fixture
def pair(spark):
    target = spark.createDataFrame(
        [("s", 1, "t1"), ("s", 2, "t2"), ("s", None, "t3"), (None, 4, "t4"), ("d", 9, "d1"), ("d", 9, "d2")],
        SCHEMA,
    )
    batch = spark.createDataFrame(
        [("s", 2, "n2"), ("s", 3, "n3"), ("s", None, "n4"), ("d", 9, "n9")], SCHEMA
    )
    return target, batch


def test_merge(pair):
    target, batch = pair
    assert rows(merge_upsert(target, batch)) == rows_sorted(
        [
            ("s", 1, "t1"), ("s", 2, "n2"), ("s", 3, "n3"), ("s", None, "t3"),
            ("s", None, "n4"), (None, 4, "t4"), ("d", 9, "n9"), ("d", 9, "n9"),
        ]
    )


def rows_sorted(values):
    return sorted(values, key=repr)


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_merge_with_unique_target_and_any_join_strategy(spark, pair, threshold):
    target, batch = pair
    target = target.dropDuplicates(["startDate", "linkId"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        short = rows(merge_upsert(target, batch, unique_target=True))
        assert short == rows(merge_upsert(target, batch))
        assert len(short) == 7
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_merge_stamp(spark, pair):
    target, batch = pair
    target = target.withColumn("ingestion_timestamp", F.lit("2024-01-01").cast("timestamp_ntz"))
    merged = merge_upsert(target, batch, stamp=F.lit("2024-02-01").cast("timestamp_ntz"))
    stamped = {r.v: r.ingestion_timestamp for r in merged.collect()}
    assert stamped["t1"] == dt.datetime(2024, 1, 1)
    assert stamped["n2"] == stamped["n3"] == dt.datetime(2024, 2, 1)


def test_late_end_reaches_the_table(spark):
    schema = "startDate string, linkId long, endDate string"
    target = spark.createDataFrame([("s", 1, None)], schema)
    batch = spark.createDataFrame([("s", 1, "e")], schema)
    assert rows(merge_upsert(target, batch)) == [("s", 1, "e")]


def test_rows_without_a_complete_key_are_spread_over_tasks(spark):
    target = spark.range(4000).selectExpr(
        "cast(null as string) startDate", "cast(null as long) linkId", "string(id) v"
    )
    batch = spark.createDataFrame([("s", 1, "n")], SCHEMA)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        merged = merge_upsert(target, batch, unique_target=False)
        sizes = [
            r["count"]
            for r in merged.where("v <> 'n'").groupBy(F.spark_partition_id()).count().collect()
        ]
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert sum(sizes) == 4000 and len(sizes) == 4 and max(sizes) < 1300


def test_a_target_key_with_most_rows_is_split(spark):
    target = spark.range(0, 60000, 1, 8).selectExpr(
        "if(id % 3 > 0, 'hot', string(id)) startDate", "1L linkId", "uuid() v"
    )
    batch = spark.range(0, 60000, 3, 8).selectExpr("string(id) startDate", "1L linkId", "'n' v")
    batch = batch.union(spark.createDataFrame([("hot", 1, "n")], SCHEMA))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        merged = merge_upsert(target, batch)
        assert {r.v for r in merged.collect()} == {"n"}
        executed = merged._jdf.queryExecution().executedPlan().toString()
        assert merged.count() == 60000
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert "SortMergeJoin(skew=true)" in executed


def test_repeated_batch_keys_are_refused(spark):
    batch = spark.createDataFrame([("s", 1, "a"), ("s", 1, "b")], SCHEMA)
    with pytest.raises(ValueError, match="several rows"):
        require_unique_keys(batch)
    require_unique_keys(spark.createDataFrame([("s", None, "a"), ("s", None, "b")], SCHEMA))


def test_without_replayed(spark, pair):
    target, batch = pair
    replayed = spark.createDataFrame([("s", None, "t3"), ("s", None, "n4"), ("s", 1, "t1")], SCHEMA)
    assert rows(without_replayed(target, replayed)) == [("s", 1, "t1"), ("s", None, "n4")]

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_per_key
from tidemark.operators.lookup import LookupPolicy, fits_broadcast, lookup_join

TINY = LookupPolicy(broadcast_rows=2)


def test_latest_uses_every_order_column_and_puts_nulls_last(spark):
    frame = spark.createDataFrame(
        [("a", 1, 5, "old"), ("a", 2, 1, "tie-low"), ("a", 2, 2, "tie-high"), ("b", None, 9, "null"), ("b", 0, 0, "set")],
        "k string, t int, s int, v string",
    )
    assert rows(latest_per_key(frame, ["k"], ["t", "s"]), "k", "v") == [("a", "tie-high"), ("b", "set")]


def test_latest_limits_a_hot_key_before_the_shuffle(spark):
    frame = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    latest = latest_per_key(frame, ["k"], ["id"])
    assert latest.where("k = 0").first()["id"] == 2997
    text = plan(latest)
    assert text.count("WindowGroupLimit") == 2
    assert text.rindex("WindowGroupLimit") > text.index("Exchange")


@pytest.fixture
def tables(spark):
    fact = spark.createDataFrame(
        [(i, "hot" if i % 3 == 0 else f"k{i % 7}") for i in range(60)] + [(100, None), (101, "unknown")],
        "id int, k string",
    )
    reference = spark.createDataFrame([("hot", "H"), *[(f"k{i}", f"v{i}") for i in range(6)]], "k string, name string")
    return fact, reference


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_every_way_of_joining_gives_the_same_rows(spark, tables, how):
    fact, reference = tables
    expected = rows(fact.join(reference, "k", how))
    broadcast, shuffled = lookup_join(fact, reference, "k", how), lookup_join(fact, reference, "k", how, TINY)
    assert rows(broadcast) == expected
    assert rows(shuffled) == expected
    assert "BroadcastHashJoin" in plan(broadcast)


def test_beyond_the_limit_both_sides_are_shuffled(spark, tables):
    fact, reference = tables
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(lookup_join(fact, reference, "k", "inner", TINY))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("SortMergeJoin") == 1 and "Broadcast" not in text and "SinglePartition" not in text


def test_broadcast_limits_are_measured(spark):
    frame = spark.createDataFrame([("x" * 1000,)] * 3, "v string")
    assert fits_broadcast(frame, LookupPolicy(broadcast_rows=3, broadcast_bytes=4000))
    assert not fits_broadcast(frame, LookupPolicy(broadcast_rows=2))
    assert not fits_broadcast(frame, LookupPolicy(broadcast_bytes=2900))
    assert fits_broadcast(frame.where("false"))

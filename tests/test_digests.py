import random

from helpers import plan, rows
from pyspark.sql import functions as F

from tidemark.operators.digests import _bit, _places, _probe, BLOCK_BITS, HASHES, day_filters, days_that_may_hold, differing, file_digests, row_digests


def frame(spark, *data):
    return spark.createDataFrame(list(data), "day string, id int, v double")


def test_row_digests_depend_on_rows_not_on_their_order(spark):
    data = [("d1", 1, 0.5), ("d1", 2, None), ("d1", 2, None), ("d2", 3, 1.0), (None, 4, 1.0)]
    day = F.col("day")
    first = row_digests(frame(spark, *data), day)
    assert set(first) == {"d1", "d2"}
    assert row_digests(frame(spark, *data[::-1]).repartition(3), day) == first
    changed = row_digests(frame(spark, *data[:2], ("d1", 2, 0.0), data[3]), day)
    assert differing(first, changed) == ["d1"]
    # One of two equal rows less is a change, which an exclusive or would not see.
    assert differing(first, row_digests(frame(spark, *data[:2], data[3]), day)) == ["d1"]
    assert differing(first, row_digests(frame(spark, *data[3:]), day)) == ["d1"]
    assert row_digests(frame(spark, *data), day, ["v"]) == row_digests(frame(spark, *[(d, i, 7.0) for d, i, _ in data]), day, ["v"])


def test_file_digests_tell_new_files_without_reading_rows(spark, folder):
    frame(spark, ("d1", 1, 1.0), ("d2", 2, 1.0)).write.partitionBy("day").mode("append").parquet(folder)
    first = file_digests(spark.read.parquet(folder), F.col("day"))
    assert file_digests(spark.read.parquet(folder), F.col("day")) == first
    frame(spark, ("d2", 3, 1.0), ("d3", 4, 1.0)).write.partitionBy("day").mode("append").parquet(folder)
    assert differing(first, file_digests(spark.read.parquet(folder), F.col("day"))) == ["d2", "d3"]
    assert file_digests(frame(spark, ("d1", 1, 1.0)), F.col("day")) is None


def ids(spark, data):
    return spark.createDataFrame(data, "day string, event_id string")


def test_day_filters_find_every_day_and_few_others(spark):
    rng = random.Random(1)
    days = {f"d{k}": [f"e{rng.getrandbits(60)}" for _ in range(n)] for k, n in enumerate([1, 30, 1500, 9000])}
    filters = day_filters(ids(spark, [(d, e) for d, own in days.items() for e in own])).cache()
    assert rows(filters.groupBy("day").agg(F.first("blocks"), F.count("*"))) == [("d0", 1, 1), ("d1", 1, 1), ("d2", 2, 2), ("d3", 16, 16)]
    for day, own in days.items():
        asked = ids(spark, [("x", e) for e in rng.sample(own, min(3, len(own)))]).select("event_id")
        assert day in days_that_may_hold(asked, filters)
    unknown = ids(spark, [("x", f"unknown {k}") for k in range(200)]).select("event_id")
    assert days_that_may_hold(unknown, filters) == []
    assert days_that_may_hold(unknown.limit(0), filters) == [] == days_that_may_hold(unknown, filters.limit(0))


def test_filters_keep_their_size_per_id(spark):
    data = spark.range(20_000).select(F.lit("d").alias("day"), F.col("id").cast("string").alias("event_id"))
    filters = day_filters(data)
    bits = filters.agg(F.sum(F.length("bitmap") * 8)).first()[0]
    assert bits <= 20_000 * 2 * BLOCK_BITS / 1024
    set_bits = filters.agg(F.sum(F.bitmap_count("bitmap"))).first()[0]
    assert 0.5 * 20_000 * HASHES < set_bits <= 20_000 * HASHES


def test_filters_are_the_bitmaps_of_the_engine_without_its_sort_of_bits(spark):
    data = ids(spark, [(day, f"e{k}") for day, n in (("d0", 1), ("d1", 40), ("d2", 1000), ("d3", 3000)) for k in range(n)])
    placed = _places(data, ["day"]).join(day_filters(data).select("day", "blocks").distinct(), "day")
    bits = placed.select("day", F.pmod("at", "blocks").alias("block"), F.explode(F.array(*[_bit(k) for k in range(HASHES)])).alias("bit"))
    expected = bits.groupBy("day", "block").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    assert rows(day_filters(data), "day", "block", "bitmap") == rows(expected)
    assert "SortAggregate" not in plan(day_filters(data))


def test_filters_are_probed_by_compiled_conditions(spark, folder):
    data = ids(spark, [(day, f"{day} e{k}") for day, n in (("d0", 5), ("d1", 1500)) for k in range(n)])
    day_filters(data).write.parquet(f"{folder}/filters")
    probe = _probe(data.select("event_id"), spark.read.parquet(f"{folder}/filters"), [1, 2])
    assert "lambda" not in plan(probe)
    found = dict(rows(probe.groupBy("day").count()))
    # Each id is found on its own day; hardly another one is.
    assert 5 <= found["d0"] <= 10 and 1500 <= found["d1"] <= 1505

import pytest
from helpers import rows, ts
from pyspark.sql import functions as F

from tidemark.operators.upsert import latest_across_epochs
from tidemark.sources.changelog import ChangeTable
from tidemark.sources.days import day_of, read_days, write_days
from tidemark.sources.files import child_folders
from tidemark.sources.tables import append_partitioned, load_seed, read_seed

SCHEMA = "k string, v string, t int, is_deleted boolean"


@pytest.fixture
def table(spark, folder):
    return ChangeTable(spark, folder, ["k"], ["t"], "is_deleted", parts=2)


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_batches_accumulate_and_replays_change_nothing(spark, table):
    assert table.append(frame(spark, ("a", "1", 1, False), ("b", "1", 1, False)), 0)
    assert table.append(frame(spark, ("a", "2", 2, False), ("b", "1", 2, True), ("c", "1", 1, False)), 1)
    assert not table.append(frame(spark, ("a", "replayed", 9, False)), 1)
    assert table.version() == 1
    assert rows(table.read(), "k", "v") == [("a", "2"), ("c", "1")]
    assert rows(table.read(include_deleted=True), "k") == [("a",), ("b",), ("c",)]


def test_batch_counters_of_two_writers_are_independent(spark, table):
    assert table.append(frame(spark, ("a", "1", 1, False)), 5, "first")
    assert table.append(frame(spark, ("b", "1", 1, False)), 0, "second")
    assert not table.append(frame(spark, ("c", "1", 1, False)), 5, "first")
    assert rows(table.read(), "k") == [("a",), ("b",)]


def test_a_fold_changes_nothing_for_readers(spark, table):
    table.append(frame(spark, *[(f"k{i}", "1", 1, False) for i in range(40)], ("gone", "1", 3, True)), 0)
    assert table.fold() and not table.fold()
    table.append(frame(spark, ("k0", "2", 2, False), ("gone", "older", 2, False)), 1)
    before = rows(table.read(), "k", "v")
    open_reader = table.read()
    assert table.fold() and rows(table.read(), "k", "v") == before and table.version() == 1
    assert rows(open_reader, "k", "v") == before
    # A batch that was folded is known; its folder goes with the next fold.
    assert not table.append(frame(spark, ("k0", "replayed", 9, False)), 1)
    table.append(frame(spark, ("k1", "3", 3, False)), 2)
    assert table.fold()
    assert child_folders(spark, f"{table._path}/log") == ["default-000000000002"]
    assert dict(rows(table.read(), "k", "v")) == {**dict(before), "k1": "3"}


def test_a_batch_writes_what_it_brings_and_no_more(spark, table, folder):
    table.append(frame(spark, *[(f"key {i}", "some text " * 10, 1, False) for i in range(20_000)]), 0)
    table.fold()

    def size(name):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path).getLength()

    whole = size("base")
    for batch in (1, 2, 3):
        table.append(frame(spark, *[(f"key {i * 997}", "changed", batch + 1, False) for i in range(20)]), batch)
        assert size(f"log/default-{batch:012d}") < whole / 20
    assert size("base") == whole
    assert table.read().where("v = 'changed'").count() == 20


def test_only_changed_keys_of_the_base_are_compared(spark, table):
    table.append(frame(spark, *[(f"k{i}", "1", 1, False) for i in range(100)]), 0)
    table.fold()
    table.append(frame(spark, ("k0", "2", 2, False)), 1)
    plan = table.read()._jdf.queryExecution().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan


def test_columns_may_come_and_go(spark, folder):
    table = ChangeTable(spark, folder, ["k"], ["t"])
    table.append(spark.createDataFrame([("a", 1, "x"), ("b", 1, "x")], "k string, t int, gone string"), 0)
    table.fold()
    table.append(spark.createDataFrame([("a", 2, 0.5)], "k string, t int, added double"), 1)
    assert rows(table.read().select("k", "t", "added")) == [("a", 2, 0.5), ("b", 1, None)]


def test_a_batch_that_broke_off_is_not_read(spark, table, folder):
    table.append(frame(spark, ("a", "1", 1, False)), 0)
    frame(spark, ("a", "torn", 5, False)).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{folder}/log/default-000000000001"
    )
    assert rows(table.read(), "v") == [("1",)]
    assert table.append(frame(spark, ("a", "whole", 5, False)), 1)
    assert rows(table.read(), "v") == [("whole",)]


def test_reading_before_the_first_batch_is_an_error(table):
    with pytest.raises(FileNotFoundError):
        table.read()


# Per row: key, epoch, position, time, name.
CHANGES = [
    ("a", 0, 5, 50, "old log"), ("a", 1, 0, 20, "stale replay"), ("a", 0, 6, 10, "last of the old log"),
    ("b", 0, 9, 50, "old log"), ("b", 1, 3, 60, "first of the new"), ("b", 1, 4, 1, "last of the new"),
    ("c", 2, 0, None, "no time"), ("d", 0, 1, 7, "same time, older log"), ("d", 1, 1, 7, "same time, newer log"),
]


def test_epochs_are_compared_by_time_and_positions_within_them(spark, folder):
    schema = "k string, e long, s long, t long, v string"
    expected = {"a": "last of the old log", "b": "last of the new", "c": "no time", "d": "same time, newer log"}
    frame_ = spark.createDataFrame(CHANGES, schema)
    assert dict(rows(latest_across_epochs(frame_, ["k"], "e", "t", ["s"]), "k", "v")) == expected
    # However the log is cut into batches, whenever it is folded, and if a batch comes once more.
    log = sorted(CHANGES, key=lambda c: (c[1], c[2]))
    for number, step in enumerate((1, 3, 4)):
        table = ChangeTable(spark, f"{folder}/{number}", ["k"], ["s"], epoch=("e", "t"))
        for batch, k in enumerate(range(0, len(log), step)):
            table.append(spark.createDataFrame(log[k : k + step], schema), batch)
            if batch % 2 == number % 2:
                table.fold()
        table.append(spark.createDataFrame(log[:2], schema), 0, "again")
        assert dict(rows(table.read(), "k", "v")) == expected


def test_days_that_are_not_replaced_stay_where_they_are(spark, folder):
    def events(*data):
        return spark.createDataFrame([(k, ts(t)) for k, t in data], "k string, t timestamp_ntz")

    first = write_days(events(("a", "2024-01-01"), ("b", "2024-01-02"), ("c", "2024-01-03")), folder, "one", day_of("t"))
    second = {**first, **write_days(events(("d", "2024-01-02")), folder, "two", day_of("t"))}
    schema = events().schema
    assert rows(read_days(spark, folder, second, schema), "k") == [("a",), ("c",), ("d",)]
    assert rows(read_days(spark, folder, second, schema, ["2024-01-02", "2024-02-01"]), "k") == [("d",)]
    few = read_days(spark, folder, second, schema, but=["2024-01-02"])
    assert rows(few, "k") == [("a",), ("c",)] and not any("two" in f for f in few.inputFiles())
    assert read_days(spark, folder, second, schema, []).select(F.count("*")).first()[0] == 0


def test_partitioned_append_round_trip(spark, folder):
    data = [(i, ts("2024-01-01").date() if i % 3 else None, "4G" if i % 2 else "5G") for i in range(30)]
    frame_ = spark.createDataFrame(data, "id int, event_date date, network_type string")
    append_partitioned(frame_, folder, max_records_per_file=5)
    back = spark.read.parquet(folder).select("id", "event_date", "network_type")
    assert rows(back) == rows(frame_)
    pruned = back.where("network_type = '4G'")
    assert "PartitionFilters: [isnotnull(network_type" in pruned._jdf.queryExecution().toString()


def test_seed_is_typed_and_strict(spark, tmp_path):
    header = "cell_id,province,district,latitude,longitude,region,vendor,band,site_capacity_gbps,active_from\n"
    good = tmp_path / "good.csv"
    good.write_text(header + "C1,P,D,21.5,105.1,North,V,n78,18.0,2024-01-01\nC2,P,D,21.5,105.1,North,V,n78,,2024-01-01\n")
    load_seed(spark, str(good), str(tmp_path / "table"))
    table = spark.read.parquet(str(tmp_path / "table"))
    assert dict(table.dtypes)["active_from"] == "date"
    assert rows(table, "cell_id", "site_capacity_gbps") == [("C1", 18.0), ("C2", None)]
    bad = tmp_path / "bad.csv"
    bad.write_text(header + "C1,P,D,north,105.1,North,V,n78,18.0,2024-01-01\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        read_seed(spark, str(bad)).collect()

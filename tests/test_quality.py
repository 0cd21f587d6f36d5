import pytest
from helpers import rows, ts

from tidemark.operators.lookup import LookupPolicy
from tidemark.operators.quality import (
    WARN,
    AcceptedRange,
    AcceptedValues,
    CoordinateBox,
    Freshness,
    NotEmpty,
    NotNull,
    References,
    Unique,
    blocking,
    quality_report,
    table_report,
)
from tidemark.plans.suites import freshness_report


def table(spark):
    return spark.createDataFrame(
        [("a", 1.0, 10.0, 105.0), ("a", 5.0, 8.0, 102.0), ("b", None, 23.6, 105.0), (None, 6.0, None, 105.0), (None, 0.0, 9.0, 111.0)],
        "k string, n double, latitude double, longitude double",
    )


def test_not_null(spark):
    assert NotNull("k").violations(table(spark)).count() == 2
    assert NotNull("longitude").violations(table(spark)).count() == 0


def test_unique_ignores_null(spark):
    assert rows(Unique("k").violations(table(spark))) == [("a", 2)]
    assert rows(Unique("n").violations(table(spark))) == []


def test_accepted_values_pass_null(spark):
    assert rows(AcceptedValues("k", ("a",)).violations(table(spark)), "k") == [("b",)]
    assert AcceptedValues("k", ("a", "b")).violations(table(spark)).count() == 0


def test_accepted_range_is_inclusive_and_optional(spark):
    frame = table(spark)
    assert rows(AcceptedRange("n", 1.0, 5.0).violations(frame), "n") == [(0.0,), (6.0,)]
    assert rows(AcceptedRange("n", minimum=1.0).violations(frame), "n") == [(0.0,)]
    assert rows(AcceptedRange("n", maximum=5.0).violations(frame), "n") == [(6.0,)]
    assert AcceptedRange("n").violations(frame).count() == 0


def test_coordinate_box_fails_null(spark):
    assert rows(CoordinateBox().violations(table(spark)), "latitude", "longitude") == [
        (None, 105.0),
        (9.0, 111.0),
        (23.6, 105.0),
    ]


def test_references_give_every_orphan_row(spark):
    parents = spark.createDataFrame([("a",), ("a",), (None,)], "id string")
    children = spark.createDataFrame([("a",), ("x",), ("x",), ("y",), (None,)], "k string")
    for policy in (LookupPolicy(), LookupPolicy(broadcast_rows=0)):
        assert rows(References("k", parents, "id", policy).violations(children)) == [("x",), ("x",), ("y",)]


def test_not_empty(spark):
    assert rows(NotEmpty().violations(table(spark).where("false"))) == [(0,)]
    assert NotEmpty().violations(table(spark)).count() == 0


def test_freshness(spark):
    now = ts("2024-01-01 12:00:00")
    for newest, expected in (("11:55:00", "pass"), ("11:54:59", "warn"), ("11:30:00", "warn"), ("11:29:59", "error")):
        frame = spark.createDataFrame([(ts(f"2024-01-01 {newest}"),), (None,)], "ingested_at timestamp_ntz")
        assert Freshness().status(frame, now).first().status == expected
    assert Freshness().status(frame.where("false"), now).first().status == "error"


def test_freshness_of_sources(spark):
    now = ts("2024-01-01 12:00:00")
    plans = spark.createDataFrame([(ts("2024-01-01 11:50:00"),)], "ingested_at timestamp_ntz")
    limits = {"plans": Freshness(), "none": Freshness()}
    report = freshness_report({"plans": plans, "none": plans.where("false"), "other": plans}, now, limits)
    assert rows(report, "table_name", "status") == [("none", "error"), ("plans", "warn")]
    assert rows(freshness_report({"bronze_telecom_events": plans}, now), "status") == [("warn",)]
    with pytest.raises(ValueError, match="none of"):
        freshness_report({"other": plans})


def test_report_counts_all_row_checks_in_one_scan(spark):
    checks = [
        NotEmpty(),
        NotNull("k", severity=WARN),
        AcceptedRange("n", 1.0, 5.0),
        CoordinateBox(),
        Unique("k"),
        NotNull("longitude"),
    ]
    report = table_report("t", table(spark), checks)
    assert rows(report, "check_name", "severity", "violations", "status") == [
        ("accepted_range(n)", "error", 2, "fail"),
        ("coordinate_box(latitude,longitude)", "error", 3, "fail"),
        ("not_empty", "error", 0, "pass"),
        ("not_null(k)", "warn", 2, "fail"),
        ("not_null(longitude)", "error", 0, "pass"),
        ("unique(k)", "error", 1, "fail"),
    ]
    assert rows(blocking(report), "check_name") == [("accepted_range(n)",), ("coordinate_box(latitude,longitude)",), ("unique(k)",)]


def test_report_of_an_empty_table(spark):
    report = quality_report([("t", table(spark).where("false"), [NotEmpty(), NotNull("k"), Unique("k")])])
    assert rows(report, "check_name", "violations") == [("not_empty", 1), ("not_null(k)", 0), ("unique(k)", 0)]

import itertools
import json

import pytest
from helpers import plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.changes import flatten_envelopes, parse_changes, parse_envelopes, snapshot_with_changes
from tidemark.operators.upsert import latest_changes, live_rows, merge_statement, sync_schema, upsert
from tidemark.plans.bronze import accepted_events, decode_events, type_events
from tidemark.schemas import PLAN_PAYLOAD, SUBSCRIBER_PAYLOAD

SCHEMA = "k string, v string, t int, is_deleted boolean"
ORDER = ["t"]


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def records(spark, *values):
    data = [(v if v is None else json.dumps(v) if not isinstance(v, str) else v, i) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "value string, offset long").withColumn(
        "timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp")
    )


def test_parse_accepts_wrapped_and_plain_records(spark):
    row = {"plan_id": "P", "monthly_fee": 5.5, "created_at": 1704067200123, "updated_at": 1704067200456}
    parsed = parse_changes(records(spark, row, {"payload": {**row, "__deleted": "true"}}), PLAN_PAYLOAD)
    assert "__deleted" not in parsed.columns
    assert rows(parsed, "change_seq", "plan_id", "monthly_fee", "is_deleted") == [(0, "P", 5.5, False), (1, "P", 5.5, True)]
    assert parsed.select(F.unix_millis("created_at"), F.unix_millis("updated_at")).first() == (1704067200123, 1704067200456)


def test_the_wrapper_is_found_however_its_name_is_written(spark):
    spelled = '{"\\u0070ayload": {"plan_id": "P", "plan_name": "b"}}'
    named = {"plan_id": "P", "plan_name": 'a "payload" \\'}
    parsed = parse_changes(records(spark, named, spelled, "{'payload': {'plan_id': 'P', 'plan_name': 'c'}}"), PLAN_PAYLOAD)
    assert rows(parsed, "change_seq", "plan_name") == [(0, 'a "payload" \\'), (1, "b"), (2, "c")]


def test_a_delete_without_row_image_is_ordered_by_the_broker_time(spark):
    parsed = parse_changes(
        records(spark, {"subscriber_id": "s", "__deleted": "true"}, {"subscriber_id": "s", "updated_at": 0, "__deleted": "true"}),
        SUBSCRIBER_PAYLOAD,
    )
    assert {r.change_ts.isoformat() for r in parsed.collect()} == {"2024-01-01T00:00:00"}


@pytest.mark.parametrize("key", ["plan_id", None])
def test_envelopes_are_parsed_as_if_flattened_and_read_again(spark, key):
    old = {"plan_id": "P", "plan_name": 'a "b" \\ \n é payload', "monthly_fee": 1e-7, "voice_minutes": -3, "created_at": 1704067200123}
    values = [
        {"before": None, "after": old, "op": "r"}, {"before": old, "after": {"plan_id": "", "monthly_fee": "NaN"}, "op": "u"},
        {"payload": {"before": old, "after": None, "op": "d"}}, {"before": None, "after": None, "op": "d"}, None, "{broken",
        {"before": None, "after": {"plan_id": "Q", "voice_minutes": "no number", "updated_at": 5}, "op": "c"}, {"op": "u"}, {},
    ]
    source = records(spark, *values).withColumns({"key": F.lit("K").cast("binary"), "partition": F.lit(2)})
    source = source.withColumn("value", F.col("value").cast("binary"))
    stamp = F.col("kafka_timestamp")
    whole = parse_envelopes(source, PLAN_PAYLOAD, key, stamp, True)
    steps = parse_changes(flatten_envelopes(source, PLAN_PAYLOAD, key), PLAN_PAYLOAD, stamp, True)
    assert whole.dtypes == steps.dtypes
    found = [sorted(map(str, x.collect())) for x in (whole, steps)]
    assert found[0] == found[1] and len(found[0]) >= 4 + (key is not None)
    # Only the envelope is read as JSON, and no row is written.
    assert plan(whole).count("from_json") == 1 and "to_json" not in plan(whole)


def test_envelopes_are_flattened(spark):
    old, new = {"plan_id": "P", "plan_name": "old"}, {"plan_id": "P", "plan_name": "new"}
    flat = flatten_envelopes(
        records(
            spark,
            {"before": None, "after": old, "op": "r"},
            {"before": old, "after": new, "op": "u"},
            {"payload": {"before": new, "after": None, "op": "d"}},
            None,
            {"before": None, "after": None, "op": "t"},
        ),
        PLAN_PAYLOAD,
    )
    parsed = parse_changes(flat, PLAN_PAYLOAD)
    assert rows(parsed, "change_seq", "plan_name", "is_deleted") == [(0, "old", False), (1, "new", False), (2, "new", True)]


def test_snapshot_rows_come_before_changes(spark):
    changes = spark.createDataFrame([("a", "changed", 5, 0, False)], "k string, v string, t int, change_seq long, is_deleted boolean")
    snapshot = spark.createDataFrame([("a", "copied", 5), ("b", "copied", 5)], "k string, v string, t int")
    both = snapshot_with_changes(snapshot, changes)
    assert set(both.columns) == set(changes.columns)
    assert rows(latest_changes(both, ["k"], ["t", "change_seq"]), "k", "v") == [("a", "changed"), ("b", "copied")]


@pytest.mark.parametrize(
    "change,expected",
    [
        (("a", "new", 2, False), [("a", "new"), ("b", "kept")]),
        (("a", "same time", 1, False), [("a", "same time"), ("b", "kept")]),
        (("a", "older", 0, False), [("a", "stored"), ("b", "kept")]),
        (("a", "stored", 2, True), [("b", "kept")]),
        (("a", "stored", 0, True), [("a", "stored"), ("b", "kept")]),
        (("c", "added", 0, False), [("a", "stored"), ("b", "kept"), ("c", "added")]),
        (("c", "unknown", 9, True), [("a", "stored"), ("b", "kept")]),
        ((None, "no key", 9, False), [("a", "stored"), ("b", "kept")]),
    ],
)
def test_upsert_rules(spark, change, expected):
    target = frame(spark, ("a", "stored", 1, False), ("b", "kept", 1, False))
    state = upsert(target, frame(spark, change), ["k"], ORDER)
    assert rows(live_rows(state), "k", "v") == expected
    assert rows(live_rows(upsert(state, frame(spark, change), ["k"], ORDER)), "k", "v") == expected


def test_an_older_insert_cannot_bring_a_deleted_key_back(spark):
    state = upsert(frame(spark, ("a", "x", 1, False)), frame(spark, ("a", "x", 5, True)), ["k"], ORDER)
    assert rows(live_rows(upsert(state, frame(spark, ("a", "late", 3, False)), ["k"], ORDER))) == []


def test_two_changes_of_a_key_in_one_batch(spark):
    changes = frame(spark, ("a", "second", 2, False), ("a", "first", 1, False), ("b", "first", 1, False), ("b", "gone", 2, True))
    assert rows(live_rows(upsert(changes.where("false"), changes, ["k"], ORDER)), "k", "v") == [("a", "second")]


def test_any_order_of_batches_gives_the_same_state(spark):
    batches = [("a", "v1", 1, False), ("a", "v3", 3, False), ("a", "gone", 2, True), ("b", "gone", 4, True), ("b", "v2", 2, False)]
    results = set()
    for order in itertools.islice(itertools.permutations(batches), 0, 120, 17):
        state = frame(spark).where("false")
        for change in order:
            state = upsert(state, frame(spark, change), ["k"], ORDER)
        results.add(tuple(rows(live_rows(state), "k", "v")))
    assert results == {(("a", "v3"),)}


_CHANGE = st.tuples(st.sampled_from("abc"), st.integers(0, 30), st.booleans())


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_CHANGE, min_size=1, max_size=12, unique_by=lambda c: (c[0], c[1])), st.integers(0, 12))
def test_upsert_in_two_batches_equals_brute_force(spark, changes, cut):
    data = [(k, f"v{t}", t, gone) for k, t, gone in changes]
    state = frame(spark).where("false")
    for part in (data[:cut], data[cut:]):
        state = upsert(state, frame(spark, *part) if part else frame(spark).where("false"), ["k"], ORDER)
    newest = {}
    for k, v, t, gone in data:
        if k not in newest or t > newest[k][1]:
            newest[k] = (v, t, gone)
    assert rows(live_rows(state), "k", "v") == sorted((k, v) for k, (v, _, gone) in newest.items() if not gone)


def test_schema_sync_adds_and_drops(spark):
    target = spark.createDataFrame([("a", 1, "x")], "k string, n int, gone string")
    source = spark.createDataFrame([("a", 2, 0.5)], "k string, n long, added double")
    synced = sync_schema(target, source)
    assert synced.dtypes == source.dtypes
    assert rows(synced) == [("a", 1, None)]


def test_merge_statement_is_valid_sql(spark):
    parser = spark._jsparkSession.sessionState().sqlParser()
    for delete_col in ("is_deleted", None):
        text = merge_statement("bronze.subs", ["k", "v", "t", "is_deleted"], ["k"], ORDER, delete_col)
        assert "MergeIntoTable" in parser.parsePlan(text.replace("{changes}", "changes")).toString()
    assert "then delete" in merge_statement("x", ["k", "t"], ["k"], ORDER)


def test_a_filter_on_parsed_fields_does_not_parse_again(spark):

    source = spark.createDataFrame([(b"k", b"{}", 0)], "key binary, value binary, offset long").withColumn(
        "timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp")
    )
    assert plan(accepted_events(type_events(decode_events(source)))).count("from_json") == 1
    changes = parse_changes(source, PLAN_PAYLOAD)
    assert plan(live_rows(changes).where("monthly_fee > 0")).count("from_json") == 1

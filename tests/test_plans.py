"""What the physical plans must and must not hold."""

import re

import pytest

from tests.compare import TESTDATA
from tripstream import catalog
from tripstream.operators import enrichment

SF = str(TESTDATA / "sf0.001")
BATCH = [n for n in catalog.queries() if not n.startswith("stream_")]


def plan(spark, name, joins="any"):
    return plan_of(spark, lambda: catalog.queries()[name](spark, SF), joins)


def plan_of(spark, query, joins="any"):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if joins == "shuffled":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return query()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", BATCH)
def test_no_python_in_tables(spark, name):
    text = plan(spark, name)
    assert not re.search(r"Python|ArrowEval|MapInPandas|CartesianProduct|BroadcastNestedLoop", text)


@pytest.mark.parametrize(
    "name,shuffles",
    [("ride_cleansing", 0), ("ride_starts", 0), ("ride_starts_sampled", 0), ("registry_union_all", 0),
     ("tips_per_driver_hour", 1), ("hourly_tips_max", 2), ("rides_fares_pairs", 1),
     ("rides_fares_waiting", 1), ("rides_fares_join_bucketed", 0), ("rides_fares_pairs_bucketed", 0), ("registry_union", 1), ("registry_intersect", 1), ("registry_except", 1)],
)
def test_shuffles(spark, name, shuffles):
    assert len(re.findall(r"Exchange (?:hash|range|Single|RoundRobin)", plan(spark, name, joins="shuffled"))) == shuffles


@pytest.mark.parametrize("name,scans,shuffles", [("enrichment_outcomes", 2, 3), ("unmatched_fares", 2, 3), ("unmatched_rides", 2, 3), ("registry_renumbered", 2, 2)])
def test_each_input_is_scanned_once(spark, name, scans, shuffles):
    text = plan(spark, name, joins="shuffled")
    assert len(re.findall(r"FileScan", text)) == scans
    assert len(re.findall(r"Exchange (?:hash|range|Single|RoundRobin)", text)) <= shuffles


def test_scans_read_needed_columns_and_push_filters(spark):
    text = plan(spark, "hourly_tips_max")
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in text
    assert "EqualTo(event_type,view)" in plan(spark, "ride_starts")
    assert "EqualTo(event_type,purchase)" in plan(spark, "rides_fares_pairs")


def test_partial_aggregation_comes_before_each_shuffle(spark):
    text = plan(spark, "hourly_tips_max")
    assert "partial_sum(" in text and "partial_max(" in text


def test_records_without_id_are_spread_by_a_second_join_key(spark):
    for name in ("unmatched_fares", "unmatched_rides", "enrichment_outcomes"):
        assert re.search(r"SortMergeJoin \[ride_id#\w+, aside#\w+\]", plan(spark, name, joins="shuffled"))
    text = plan(spark, "unmatched_fares_within", joins="shuffled")
    assert re.search(r"SortMergeJoin \[ride_id#\w+, aside#\w+, bucket#\w+\]", text)


def test_what_a_filter_rules_out_is_not_shuffled(spark, tmp_path):
    rides = spark.range(0, 1000, 10).selectExpr("id AS ride_id", "timestamp_seconds(id) AS event_time")
    fares = spark.range(1000).selectExpr("id AS ride_id", "timestamp_seconds(id) AS event_time", "1.0D AS tip")
    for df, name in ((rides, "rides"), (fares, "fares")):
        df.write.parquet(f"{tmp_path}/{name}")
    tables = [spark.read.parquet(f"{tmp_path}/{n}") for n in ("rides", "fares")]
    text = plan_of(spark, lambda: enrichment.unmatched_fares_filtered(*tables), joins="shuffled")
    ruled_out = text[: text.index("SortMergeJoin")]
    # In its part of the union only the filter itself is exchanged.
    assert ruled_out.count("Exchange hash") == ruled_out.count("BroadcastExchange") == 1
    assert re.search(r"Exchange hashpartitioning\(word#", ruled_out)

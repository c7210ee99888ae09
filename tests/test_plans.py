"""Shape of the physical plans: what is shuffled, pushed down and joined how."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from alertweave import plans
from alertweave.operators import correlate, dedup, maintenance, mapping, reads, sequence
from alertweave.operators.maintenance import MaintenanceWindow
from alertweave.plans import fixtures
from alertweave.sources import tables

FOLDER = "/root/testdata/sf0.001"
QUERIES = plans.load()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    [
        "w1_latest_alerts",
        "w3_classify_duplicates",
        "c3_sessionize",
        "e3_effective_enrichments",
        "a4_incident_rollup",
        "j13_first_window_joined",
        "t1_query_incidents_page",
        "a9_spammy_alerts",
        "a3_dedup_report",
        "j11_map_lookup",
        "j12_map_lookup_multi",
    ],
)
def test_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_scan_reads_only_what_is_asked(spark):
    out = sequence.with_scans(
        tables.alerts(spark, FOLDER), sequence.unresolved_counter_scan()
    ).select("alert_id", "unresolved_counter")
    for line in plan(out).splitlines():
        if "FileScan" in line:
            assert "props" not in line.split("ReadSchema")[1]
            assert "value" not in line.split("ReadSchema")[1]


def test_filter_reaches_the_scan(spark):
    events = tables.read_table(spark, FOLDER, "events")
    text = plan(reads.filter_alerts(events, "user_id = 3"))
    assert "PushedFilters" in text and "EqualTo(user_id,3)" in text


@pytest.mark.parametrize("held", [10**9, 50])
def test_scans_read_and_shuffle_rows_once(spark, held):
    """Without any broadcast by size; hot keys bring a table of places and one of carried values."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        alerts = tables.alerts(spark, FOLDER)
        text = plan(sequence.with_sequence_features(alerts, max_rows=held))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffles = [x for x in text.splitlines() if "Exchange hashpartitioning" in x]
    assert len(shuffles) == 1
    assert ("_slot" in shuffles[0]) == (held == 50)
    assert sum("FileScan" in x and "events.parquet" in x for x in text.splitlines()) == 1
    assert "SortMergeJoin" not in text


def test_rules_need_one_scan_and_no_shuffle(spark):
    rules = fixtures.correlation_rules()
    out = correlate.group_key(
        correlate.match_rules(tables.alerts(spark, FOLDER), rules), rules
    )
    text = plan(out)
    assert text.count("FileScan") == 1 and "Exchange" not in text
    windows = [MaintenanceWindow(*w) for w in fixtures.WINDOWS]
    text = plan(maintenance.first_window(tables.alerts(spark, FOLDER), windows))
    assert text.count("FileScan") == 1 and "Exchange" not in text


def test_top_rows_are_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["t3_latest_logs"](spark, FOLDER))
    page = reads.page(tables.incidents(spark, FOLDER), reads.sort_by("-severity"), 25, 10)
    assert "TakeOrderedAndProject" in plan(page)


def test_aggregates_combine_on_the_map_side(spark):
    text = plan(sequence.latest_alerts(tables.alerts(spark, FOLDER)))
    assert "partial_max_by" in text
    text = plan(dedup.dedup_counts(dedup_input(spark)))
    assert "partial_count" in text


def dedup_input(spark):
    return spark.createDataFrame(
        [("r", "p", "grafana", "full")],
        "dedup_rule_id string, provider_id string, provider_type string, dedup_type string",
    )


def test_null_times_and_keys_are_kept(spark):
    now = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [("t", "a", 1, now, "firing"), ("t", None, 2, now, "firing"), ("t", "a", 3, None, "x")],
        "tenant_id string, fingerprint string, alert_id long, ts timestamp, status string",
    )
    assert sequence.with_sequence_features(df).count() == 3


def test_regex_rules_read_as_written(spark):
    pattern, names = mapping.java_regex(r"(?P<host_name>\w+)-(\d)(?P<last>x)?(?P=host_name)\Z")
    assert pattern == r"(?U)(\w+)-(\d)(x)?\1\z"
    assert names == {"host_name": 1, "last": 3}
    df = spark.createDataFrame([("größe-1größe", "p")], "name string, provider_type string")
    out = mapping.extract(df, [mapping.ExtractionRule(1, "name", r"(?P<w>\w+)-(?P<none>q)?")])
    assert out.select("w", "none").first() == ("größe", None)


def test_missing_columns_match_nothing(spark):
    df = spark.createDataFrame([(1, "a")], "alert_id long, name string")
    assert reads.filter_alerts(df, "nope = 'x'").count() == 0
    assert reads.filter_alerts(df, "").count() == 1
    assert reads.filter_alerts(df, "name ===").count() == 0

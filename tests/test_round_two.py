"""Cases that the given tables do not have: null keys, long fingerprints, many sub-rules."""

from __future__ import annotations

import datetime
import time

from pyspark.sql import functions as F

from alertweave.functions import predicates, scalars
from alertweave.operators import correlate, enrich, maintenance, mapping, reads, scan
from alertweave.operators.maintenance import MaintenanceWindow
from alertweave.operators.throttle import throttle
from alertweave.streaming import state as keyed_state


def test_throttle_takes_null_keys(spark):
    start = datetime.datetime(2024, 1, 1)
    rows = [(k, start + datetime.timedelta(minutes=m), m) for k in ("a", None) for m in (0, 10, 70)]
    events = spark.createDataFrame(rows, "k string, ts timestamp, id long")
    got = {(r.k, r.id) for r in throttle(events, ["k"], 3600, 7200).collect()}
    assert got == {("a", 0), ("a", 70), (None, 0), (None, 70)}


def test_throttle_tells_keys_of_any_type_apart(spark):
    start = datetime.datetime(2024, 1, 1)
    micro = datetime.timedelta(microseconds=1)
    keys = [(start, 1 << 60), (start + micro, 1 << 60), (start, (1 << 60) + 1), (start, None), (None, None)]
    rows = [(*k, start + datetime.timedelta(seconds=s), f"{i}.{s}") for i, k in enumerate(keys) for s in (0, 5, 3700)]
    rows += [(*keys[0], None, "no time"), (*keys[0], start, "0.00")]
    events = spark.createDataFrame(rows, "k timestamp, n long, ts timestamp, id string")
    got = {(r.k, r.n, r.id) for r in throttle(events, ["k", "n"], 3600, 3600).collect()}
    assert got == {(*k, f"{i}.{s}") for i, k in enumerate(keys) for s in (0, 3700)}
    assert throttle(events.limit(0), ["k", "n"]).collect() == []


def test_long_fingerprints_stay_apart(spark):
    rows = [("x" * 300 + "1",), ("x" * 300 + "2",), ("short",)]
    df = spark.createDataFrame(rows, "given string")
    key = scalars.default_fingerprint(F.col("given"), F.lit("n"), F.lit("p"))
    found = {r[0] for r in df.select(key).collect()}
    assert len(found) == 3 and "short" in found


def test_empty_api_key_is_nobody(spark):
    df = spark.createDataFrame([({"status": "resolved", "ticket_url": "t"}, "")], "e map<string,string>, k string")
    action, _ = enrich.classify_change(F.col("e"), F.lit("me"), F.col("k"))
    assert df.select(action).first()[0] == enrich.TICKET_ASSIGNED


def test_following_value_is_linear(spark):
    rows = spark.range(40_000).select(
        F.lit("t").alias("tenant_id"),
        F.lit("f").alias("fingerprint"),
        F.timestamp_micros("id").alias("ts"),
        F.col("id").alias("alert_id"),
        F.when(F.col("id") % 1000 == 999, F.col("id")).alias("v"),
    )
    begin = time.perf_counter()
    out = scan.run_scans(rows, [scan.following_first("next", F.col("v"))])
    later = F.floor((F.col("alert_id") + 1) / 1000) * 1000 + 999
    wrong = out.filter(~F.col("next").eqNullSafe(F.when(F.col("alert_id") < 39_999, later)))
    assert wrong.count() == 0
    assert time.perf_counter() - begin < 20


def test_a_bad_predicate_leaves_the_others_be(spark):
    df = spark.createDataFrame(
        [("t", 1, "5", 5), ("t", 2, "abc", 6), ("t", 3, None, None)],
        "tenant_id string, alert_id long, name string, k int",
    )
    bad = ["k = 'abc'", "nope = 1", "no_such_function(k)", "k ===", "year(array(k)) = 1"]
    presets = {"good": "k >= 5", "mixed": "name > 3", "text": "k = '5'", "all": ""}
    presets |= {f"bad{i}": p for i, p in enumerate(bad)}
    hits = {r.preset: r.n for r in reads.preset_hits(df, presets).collect()}
    assert hits == {"good": 2, "mixed": 1, "text": 1, "all": 3}
    assert set(predicates.predicate_errors(df, list(presets.values()))) == set(bad[1:])
    rules = [
        correlate.CorrelationRule(name, "t", name, (p,), 60)
        for name, p in {"bad": bad[0], "worse": bad[3], "fine": "k = 6"}.items()
    ]
    matched = correlate.match_rules(df, rules).collect()
    assert [(r.rule_id, r.alert_id) for r in matched] == [("fine", 2)]
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_windows_hold_alerts_without_status_or_id(spark):
    at = datetime.datetime(2024, 1, 1, 12)
    df = spark.createDataFrame(
        [("t", None, at, None), ("t", 1, at, "resolved"), ("u", 2, at, "firing"), (None, 3, at, None)],
        "tenant_id string, alert_id long, ts timestamp, status string",
    )
    day = ("2024-01-01", "2024-01-02 00:00:00")
    few = [
        MaintenanceWindow(7, "t", "o'clock", *day, None, suppress=True, ignore_statuses=("resolved",)),
        MaintenanceWindow(8, "t", "bad", *day, "status ==="),
    ]
    later = [MaintenanceWindow(10 + i, "u", "x", "2031-01-01", "2032-01-01", f"alert_id > {i % 5}") for i in range(400)]
    for windows in (few, few + later):
        marked = maintenance.first_window(df, windows)
        assert {(r.alert_id, r.tenant_id): r.window_id for r in marked.collect()} == {
            (None, "t"): 7, (1, "t"): None, (2, "u"): None, (3, None): None
        }
        plan = marked._jdf.queryExecution().optimizedPlan().toString()
        assert "from_json" not in plan.lower() and "jsontostructs" not in plan.lower()
    kept, audit = maintenance.apply_maintenance(df.withColumn("fingerprint", F.lit("f")), few)
    assert {r.status for r in kept.collect()} == {"suppressed", "resolved", "firing", None}
    assert "o'clock" in audit.first().description


def test_late_rows_do_not_take_sessions_back(spark):
    rules = [correlate.CorrelationRule("r", "t", "r", ("true",), 3600)]
    state = spark.createDataFrame([], keyed_state.SESSION_STATE)
    # minutes of a day, a batch per list: late but near, on time, far too late, on time, a new session
    batches = [[(720, 1, "resolved")], [(660, 2, "firing")], [(750, 3, "resolved")],
               [(-4000, 4, "firing")], [(790, 5, "resolved"), (700, 6, "resolved")], [(900, 7, "firing")]]
    got = {}
    for batch in batches:
        rows = [
            ("t", "r", "k", datetime.datetime(2024, 1, 9) + datetime.timedelta(minutes=m), i, s)
            for m, i, s in batch
        ]
        keyed = spark.createDataFrame(
            rows, "tenant_id string, rule_id string, group_key string, ts timestamp, alert_id long, status string"
        )
        placed = keyed_state.sessions_with_state(keyed, rules, state)
        got |= {r.alert_id: (r.session_no, r.opened) for r in placed.collect()}
        after = keyed_state.next_session_state(state, placed).collect()
        state = spark.createDataFrame(after, keyed_state.SESSION_STATE)
    assert got == {1: (0, False), 2: (0, True), 3: (0, True), 4: (1, True), 5: (0, True), 6: (0, True), 7: (2, True)}
    assert [(r.session_no, r.max_no, r.last_ts.hour) for r in after] == [(2, 2, 15)]


def test_multi_level_lookups_keep_to_their_condition(spark):
    older = {"x": {"region": "old"}}
    alerts = spark.createDataFrame(
        [
            ("t1", 1, "high", ["a", "b"], older),
            ("t2", 1, "high", ["b"], older),
            ("t1", 2, "low", ["a"], older),
            ("t1", 3, "high", ["none"], older),
            ("t1", 4, "high", None, None),
            (None, None, "high", ["a"], None),
        ],
        "tenant_id string, alert_id long, severity string, customers array<string>, "
        "found map<string,map<string,string>>",
    )
    rows = spark.createDataFrame([(1, "a", "north"), (2, "b", "south")], "row_idx long, customers string, region string")
    rule = mapping.MappingRule(
        7, [["customers"]], [], condition="severity = 'high'", multi_level=True,
        new_property_name="found", lookup="rows",
    )
    north, south = {"customers": "a", "region": "north"}, {"customers": "b", "region": "south"}
    want = {
        ("t1", 1): ({"a": north, "b": south}, "success"),
        ("t2", 1): ({"b": south}, "success"),
        ("t1", 2): (older, "skipped"),
        ("t1", 3): (older, "failure"),
        ("t1", 4): (None, "skipped"),
        (None, None): ({"a": north}, "success"),
    }
    out = mapping.map_alerts(alerts, [rule], {"rows": rows}).collect()
    assert {(r.tenant_id, r.alert_id): (r.found, r.enrichment_events[-1].status) for r in out} == want
    assert len(out) == len(want)
    texts = alerts.withColumn("found", F.lit("as it was"))
    got = {(r.tenant_id, r.alert_id): r.found for r in mapping.map_lookup_multi(texts, rule, rows).collect()}
    assert got["t1", 2] == "as it was" and "south" in got["t2", 1]

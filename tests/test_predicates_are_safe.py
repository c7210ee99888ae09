"""Stored predicates and lookup cells that cannot end a job for the others."""

from __future__ import annotations

import pytest

from alertweave.functions import predicates
from alertweave.operators import correlate, mapping, reads
from alertweave.operators.correlate import CorrelationRule
from alertweave.operators.maintenance import MaintenanceWindow, first_window

BAD = [
    "nofunc(name)",
    "name =",
    "nope = 1",
    "count(name) > 0",
    "name rlike '('",
    r"name rlike r'['",
    "name like 'a\\\\'",
    "raise_error('x') is null",
    "assert_true(false) is null",
    "regexp_extract(name, '(a)', 5) = 'a'",
    "size(sequence(1, 10, -1)) > 0",
    "row_number() over (order by alert_id) = 1",
    "explode(array(true))",
    "exists (select 1)",
    "name rlike name",
    "element_at(array(1), 0) = 1",
    "repeat(name, 1000000000) = 'x'",
    "name",
    "'unclosed",
    "; drop",
]
# mixed types select nothing and raise nothing
MIXED = ["alert_id = 'abc'", "name > 3", "alert_id = severity", "cast(name as int) = 1", "1 / 0 = alert_id"]
GOOD = "lower(severity) in ('high', 'low') and name like 'a%' and name rlike '^a.$' and not (alert_id is null)"
ROWS = [(1, "t0", "ab", "high"), (2, "t0", "b(", "low"), (3, "t1", "ac", "low"), (4, "t1", None, None)]


@pytest.fixture(scope="module")
def alerts(spark):
    return spark.createDataFrame(ROWS, "alert_id long, tenant_id string, name string, severity string")


@pytest.mark.parametrize("predicate", [*BAD[:17], *BAD[18:], *MIXED])
def test_a_bad_filter_selects_nothing(alerts, predicate):
    assert reads.filter_alerts(alerts, predicate).collect() == []


def test_a_good_filter_selects(alerts):
    assert [r.alert_id for r in reads.filter_alerts(alerts, GOOD).collect()] == [1, 3]
    assert predicates.predicate_errors(alerts, [GOOD, *MIXED]) == {}
    assert set(predicates.predicate_errors(alerts, BAD[:17])) == set(BAD[:17])


def test_bad_rules_leave_the_others_be(spark, alerts):
    rules = [CorrelationRule(f"bad{i}", "t0", "bad", (p,), 60) for i, p in enumerate([*BAD, *MIXED])]
    rules.append(CorrelationRule("good", "t0", "good", (GOOD,), 60))
    got = correlate.match_rules(alerts, rules).collect()
    assert [(r.alert_id, r.rule_id) for r in got if r.rule_id == "good"] == [(1, "good")]
    assert {r.rule_id for r in got} <= {"good", f"bad{BAD.index('name')}"}
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    window = "2024-01-01", "2100-01-01"
    windows = [MaintenanceWindow(i, "t0", "w", *window, p) for i, p in enumerate([*BAD[:17], *MIXED])]
    timed = alerts.selectExpr("*", "timestamp'2025-01-01' AS ts", "'firing' AS status")
    windows.append(MaintenanceWindow(99, "t0", "w", *window, "name = 'ab'"))
    assert {r.alert_id: r.window_id for r in first_window(timed, windows).collect()} == {1: 99, 2: None, 3: None, 4: None}
    hits = reads.preset_hits(alerts, {str(i): p for i, p in enumerate([*BAD[:17], *MIXED])} | {"good": GOOD})
    assert {(r.tenant_id, r.preset, r.n) for r in hits.collect()} == {("t0", "good", 1), ("t1", "good", 1)}


@pytest.mark.parametrize("predicate", ["alert_id = severity", "nofunc(name)", "name rlike '('"])
def test_conditions_of_rules(spark, alerts, predicate):
    rules = [
        mapping.ExtractionRule(1, "name", "(?P<first>.)", priority=2, condition=predicate),
        mapping.ExtractionRule(2, "name", "(?P<second>.)", condition="alert_id = 1"),
    ]
    out = mapping.extract(alerts, rules).orderBy("alert_id").collect()
    assert [(r["first"], r["second"]) for r in out] == [(None, "a"), (None, None), (None, None), (None, None)]
    lookup = spark.createDataFrame([(0, "ab", "x")], "row_idx int, name string, team string")
    for condition, team in ((predicate, None), ("severity = 'high'", "x")):
        rule = mapping.MappingRule(1, [["name"]], ["team"], condition=condition)
        found = mapping.map_lookup(alerts, rule, lookup)
        assert {r.alert_id: r.team for r in found.collect()} == {1: team, 2: None, 3: None, 4: None}
        assert not [c for c in found.columns if c.startswith("_")]


def test_rules_of_tenants(spark, alerts):
    rules = [mapping.ExtractionRule(1, "name", "(?P<first>.)", tenant_id="t1")]
    got = {r.alert_id: r["first"] for r in mapping.extract(alerts, rules).collect()}
    assert got == {1: None, 2: None, 3: "a", 4: None}
    lookup = spark.createDataFrame(
        [(0, "t0", ".*", "zero"), (1, "t1", ".*", "one")], "row_idx int, tenant_id string, name string, team string"
    )
    rules = [mapping.MappingRule(i, [["name"]], ["team"], lookup="l", tenant_id=t) for i, t in enumerate(("t0", "t1"))]
    got = {r.alert_id: r.team for r in mapping.map_alerts(alerts, rules, {"l": lookup}).collect()}
    assert got == {1: "zero", 2: "zero", 3: "one", 4: None}

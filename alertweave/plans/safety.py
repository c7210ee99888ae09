"""Stored predicates, conditions and lookup cells that fail beside ones that work."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertweave.operators import correlate, mapping, reads
from alertweave.operators.correlate import CorrelationRule
from alertweave.operators.mapping import ExtractionRule, MappingRule
from alertweave.plans.registry import query
from alertweave.plans.sql import ALERTS
from alertweave.sources import tables

# each selects nothing: mixed types, unknown names, bad syntax, bad patterns, more than a row
FAILING = [
    "name > 3",
    "alert_id = 'abc'",
    "nofunc(name)",
    "name =",
    "name rlike '('",
    "count(name) > 0",
    "raise_error('x') is null",
    "row_number() over (order by ts) = 1",
]
WORKING = "severity in ('high', 'critical') and name like 'alert-1%'"


@query(
    "p16_type_mismatch",
    f"""WITH {ALERTS} SELECT alert_id, severity FROM alerts
WHERE severity IN ('high', 'critical') AND name LIKE 'alert-1%'""",
)
def type_mismatch(spark, folder):
    alerts = tables.alerts(spark, folder)
    found = [reads.filter_alerts(alerts, p) for p in [*FAILING, WORKING]]
    return reduce(DataFrame.unionByName, found).select("alert_id", "severity")


@query(
    "c1_bad_rule_beside_good",
    f"""WITH {ALERTS} SELECT alert_id, concat('good-', tenant_id) AS rule_id FROM alerts
WHERE severity IN ('high', 'critical') AND name LIKE 'alert-1%'""",
)
def bad_rule_beside_good(spark, folder):
    rules = [
        CorrelationRule(f"{'good' if p == WORKING else f'bad{i}'}-{t}", t, "rule", (p,), 60)
        for t in ("t0", "t1", "t2")
        for i, p in enumerate([*FAILING, WORKING])
    ]
    return correlate.match_rules(tables.alerts(spark, folder), rules).select("alert_id", "rule_id")


@query(
    "e10_condition_mismatch",
    f"""WITH {ALERTS} SELECT alert_id, NULL::VARCHAR AS lost,
  CASE WHEN severity = 'low' THEN regexp_extract(name, 'alert-(\\d)', 1) END AS number
FROM alerts""",
)
def condition_mismatch(spark, folder):
    rules = [
        ExtractionRule(1, "name", r"alert-(?P<lost>\d)", priority=2, condition="alert_id = severity"),
        ExtractionRule(2, "name", r"alert-(?P<number>\d)", condition="severity = 'low'"),
    ]
    out = mapping.extract(tables.alerts(spark, folder), rules)
    return out.select("alert_id", "lost", "number")


@query(
    "j11_bad_cell",
    f"""WITH {ALERTS} SELECT alert_id, CASE WHEN name LIKE 'alert-1%' THEN 'one'
  WHEN service LIKE '%svc-2%' THEN 'two' END AS team FROM alerts""",
)
def bad_cell(spark, folder):
    rows = spark.createDataFrame(
        [(1, "alert-(", "none", "bad"), (40, "[", "[", "bad"), (10**8, "^alert-1", "x", "one"), (10**9, "y", "svc-2", "two")],
        "row_idx int, name string, service string, team string",
    )
    rule = MappingRule(1, [["name"], ["service"]], ["team"])
    return mapping.map_lookup(tables.alerts(spark, folder), rule, rows).select("alert_id", "team")


@query(
    "e13_rules_per_tenant",
    f"""WITH {ALERTS} SELECT alert_id, CASE tenant_id WHEN 't0' THEN 'zero' WHEN 't1' THEN 'one' END
  AS team, CASE WHEN tenant_id = 't1' THEN regexp_extract(name, 'alert-(\\d)', 1) END AS number
FROM alerts""",
)
def rules_per_tenant(spark, folder):
    """One lookup table with rows of every tenant; each rule reads its tenant's only."""
    rows = spark.createDataFrame(
        [(0, "t0", "alert", "zero"), (1, "t1", "alert", "one"), (2, "t2", "alert", "two")],
        "row_idx int, tenant_id string, name string, team string",
    )
    alerts = mapping.extract(
        tables.alerts(spark, folder),
        [ExtractionRule(1, "name", r"alert-(?P<number>\d)", tenant_id="t1")],
    )
    rules = [
        MappingRule(i, [["name"]], ["team"], lookup="teams", tenant_id=t) for i, t in enumerate(("t0", "t1"))
    ]
    return mapping.map_alerts(alerts, rules, {"teams": rows}).select("alert_id", "team", "number")

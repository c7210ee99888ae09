"""Rule tables the named queries use, as rows for Spark and as SQL values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DEDUP_RULES = [
    ("d1", "t0", "p-1", "grafana", True, ["name", "severity"], True),
    ("d2", "t1", None, "sentry", True, ["severity"], True),
    ("d3", "t2", "p-2", "datadog", True, ["severity"], False),
    ("d4", "t2", "p-3", "sentry", False, ["severity"], True),
    ("d5", "t9", "p-3", "sentry", True, ["severity"], True),
]


def sql_value(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, list):
        return "[" + ", ".join(sql_value(v) for v in value) + "]"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def sql_rows(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(sql_value(v) for v in r) + ")" for r in rows)


DEDUP_RULES_SQL = sql_rows(DEDUP_RULES)


def dedup_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        DEDUP_RULES,
        "rule_id string, tenant_id string, provider_id string, provider_type string, "
        "full_deduplication boolean, ignore_fields array<string>, enabled boolean",
    )

# row_idx, service, provider_type, name, owner, tier; null cells and padding on purpose
LOOKUP_ROWS = [
    (0, "svc-1$", "grafana", None, " team-a ", "1"),
    (1, "svc-(2|3)$", "*", None, "team-b", None),
    (2, None, None, "alert-1", "team-c", "3"),
    (3, "svc-5", "*", None, "team-d", "4"),
    (4, "*", "sentry", None, "team-e", "5"),
]
LOOKUP_SQL = sql_rows(LOOKUP_ROWS)


def lookup_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        LOOKUP_ROWS,
        "row_idx int, service string, provider_type string, name string, owner string, "
        "tier string",
    )


WINDOWS = [
    # id, tenant, name, start, end, predicate, suppress, enabled, ignored statuses
    (1, "t0", "night", "2024-01-03 00:00:00", "2024-01-06 00:00:00", "severity = 'low'",
     True, True, ()),
    (2, "t0", "all", "2024-01-05 00:00:00", "2024-01-08 00:00:00", "", False, True, ()),
    (3, "t1", "off", "2024-01-01 00:00:00", "2024-02-01 00:00:00", "", False, False, ()),
    (4, "t1", "kept", "2024-01-10 00:00:00", "2024-01-20 00:00:00", "k > 50", True, True,
     ("resolved",)),
    (5, "t2", "gone", "2024-01-10 00:00:00", "2024-01-20 00:00:00",
     "labels['nope'] = 'x'", True, True, ()),
    (6, "t2", "drop", "2024-01-12 00:00:00", "2024-01-14 00:00:00",
     "provider_type = 'grafana'", False, True, ()),
]

TENANTS = ("t0", "t1", "t2")
TEMPLATE = "{{ alert.service }} by {{ alert.provider_type }} in {{ alert.region }}"


def correlation_rules():
    """Per tenant: gap sessions by service, two sub-rules, no key, deleted, threshold with a
    template, and a multi-level rule."""
    from alertweave.operators.correlate import CorrelationRule

    severe = "severity in ('high', 'critical')"
    rules = []
    for t in TENANTS:
        rules += [
            CorrelationRule(f"r1-{t}", t, "by service", (severe,), 21600, ("service",)),
            CorrelationRule(
                f"r2-{t}",
                t,
                "two sources",
                ("provider_type = 'sentry'", "provider_type = 'grafana' and k > 50"),
                3600,
                ("name",),
                create_on="all",
                prefix="INC",
            ),
            CorrelationRule(f"r3-{t}", t, "no key", ("severity = 'critical'",), 7200),
            CorrelationRule(
                f"r4-{t}", t, "deleted", ("true",), 60, ("service",), is_deleted=True
            ),
            CorrelationRule(
                f"r5-{t}",
                t,
                "named",
                ("k % 2 = 0",),
                86400,
                ("service", "provider_type"),
                threshold=5,
                name_template=TEMPLATE,
            ),
        ]
    return rules

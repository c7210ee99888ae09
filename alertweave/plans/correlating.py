"""Rules to incidents."""

from __future__ import annotations

from pyspark.sql import functions as F

from alertweave.functions.scalars import severity_rank
from alertweave.operators import (
    correlate,
    dedup,
    incidents,
    lineage,
    resolution,
    sequence,
)
from alertweave.operators.correlate import CorrelationRule
from alertweave.plans import fixtures
from alertweave.plans.registry import query
from alertweave.plans.sql import ALERTS, RANKED
from alertweave.sources import tables

RULES = fixtures.correlation_rules()

# one row per alert and rule: rule kind, matched sub-rules, key, timeframe
KEYED = f"""{RANKED},
counted AS (SELECT *, count(*) FILTER (status = 'resolved') OVER (PARTITION BY tenant_id,
    fingerprint ORDER BY ts, alert_id) AS gr FROM ranked),
unresolved AS (SELECT *, row_number() OVER (PARTITION BY tenant_id, fingerprint, gr
    ORDER BY ts, alert_id) - CASE WHEN gr > 0 THEN 1 ELSE 0 END AS unresolved_counter
  FROM counted),
keyed AS (
  SELECT *, concat('r1-', tenant_id) AS rule_id, [0] AS matched, service AS group_key,
    21600 AS timeframe_s, 1 AS threshold, 1 AS n_sub
  FROM unresolved WHERE severity IN ('high', 'critical')
  UNION ALL SELECT *, concat('r2-', tenant_id), CASE WHEN provider_type = 'sentry' THEN [0]
    ELSE [1] END, name, 3600, 1, 2 FROM unresolved
  WHERE provider_type = 'sentry' OR (provider_type = 'grafana' AND k > 50)
  UNION ALL SELECT *, concat('r3-', tenant_id), [0], 'none', 7200, 1, 1
  FROM unresolved WHERE severity = 'critical'
  UNION ALL SELECT *, concat('r5-', tenant_id), [0], concat(service, ',', provider_type),
    86400, 5, 1 FROM unresolved WHERE k % 2 = 0)"""

SESSIONS = f"""{KEYED},
gaps AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) > CAST(timeframe_s AS BIGINT) * 1000000
    THEN 1 ELSE 0 END AS brk FROM keyed
  WINDOW w AS (PARTITION BY tenant_id, rule_id, group_key ORDER BY ts, alert_id)),
numbered AS (SELECT *, CAST(sum(brk) OVER (PARTITION BY tenant_id, rule_id, group_key
    ORDER BY ts, alert_id) AS BIGINT) AS session_no FROM gaps),
fired AS (SELECT *, count(*) FILTER (status = 'firing') OVER (PARTITION BY tenant_id, rule_id,
    group_key, session_no ORDER BY ts, alert_id) AS fires FROM numbered),
sessions AS (SELECT *, concat_ws('/', tenant_id, rule_id, group_key, session_no)
    AS incident_id FROM fired WHERE fires > 0)"""


def sessions(spark, folder, counted=False):
    """Correlated alerts; with their unresolved counters only where these are needed."""
    alerts = tables.alerts(spark, folder).withColumn(
        "severity_rank", severity_rank(F.col("severity"))
    )
    if counted:
        counter = sequence.unresolved_counter_scan()
        alerts = lineage.cut(sequence.with_scans(alerts, counter))
    keyed = correlate.group_key(correlate.match_rules(alerts, RULES), RULES)
    return correlate.sessionize(keyed, RULES)


@query(
    "c1_match_rules",
    f"""WITH {KEYED} SELECT alert_id, rule_id, array_to_string(matched, ',') AS matched
FROM keyed""",
)
def match_rules(spark, folder):
    alerts = tables.alerts(spark, folder)
    subs = F.array_join(F.col("matched").cast("array<string>"), ",")
    return correlate.match_rules(alerts, RULES).select(
        "alert_id", "rule_id", subs.alias("matched")
    )


@query(
    "c2_group_key",
    f"WITH {KEYED} SELECT alert_id, rule_id, group_key FROM keyed",
)
def group_key(spark, folder):
    keyed = correlate.group_key(
        correlate.match_rules(tables.alerts(spark, folder), RULES), RULES
    )
    return keyed.select("alert_id", "rule_id", "group_key")


MULTI = [
    CorrelationRule(
        f"m-{t}",
        t,
        "customers",
        ("severity = 'critical'",),
        3600,
        ("doc.customers",),
        multi_level=True,
        multi_level_property="name",
    )
    for t in fixtures.TENANTS
]


@query(
    "c2_group_key_multi_level",
    f"""WITH {ALERTS} SELECT DISTINCT alert_id, CASE WHEN k % 10 = 0 THEN 'none'
  ELSE concat('c', unnest([user_id % 5, k % 3])) END AS group_key FROM alerts
WHERE severity = 'critical' AND k IS NOT NULL""",
)
def group_key_multi_level(spark, folder):
    def named(number):
        return F.struct(F.concat(F.lit("c"), number).alias("name"), F.lit("x").alias("age"))

    k = F.col("k")
    customers = F.struct(
        named(F.col("user_id") % 5).alias("1"), named(k % 3).alias("2")
    )
    doc = F.when(k % 10 == 0, F.lit('{"other": 1}')).otherwise(
        F.to_json(F.struct(customers.alias("customers")))
    )
    alerts = tables.alerts(spark, folder).withColumn("doc", doc)
    keyed = correlate.group_key(correlate.match_rules(alerts, MULTI), MULTI)
    return keyed.select("alert_id", "group_key")


@query(
    "c3_sessionize",
    f"WITH {SESSIONS} SELECT alert_id, rule_id, incident_id FROM sessions",
)
def sessionize(spark, folder):
    return sessions(spark, folder).select("alert_id", "rule_id", "incident_id")


GATED = f"""{SESSIONS},
steps AS (SELECT *, lag(unresolved_counter) OVER (PARTITION BY incident_id, fingerprint
    ORDER BY ts, alert_id) AS before FROM sessions),
totals AS (SELECT *, count(*) FILTER (before IS NULL) OVER w AS n_keys,
    sum(unresolved_counter - coalesce(before, 0)) OVER w AS n_open FROM steps
  WINDOW w AS (PARTITION BY incident_id ORDER BY ts, alert_id)),
gates AS (SELECT incident_id, min(CASE WHEN greatest(n_keys, n_open) >= threshold
    AND (rule_id NOT LIKE 'r2%' OR len(matched) = n_sub) THEN ts END) AS visible_since,
    CAST(max(greatest(n_keys, n_open)) AS BIGINT) AS max_alerts
  FROM totals GROUP BY incident_id)"""


@query("c4_gate_visibility", f"WITH {GATED} SELECT * FROM gates")
def gate_visibility(spark, folder):
    linked = lineage.cut(sessions(spark, folder, counted=True))
    return correlate.gate_visibility(linked, RULES)


@query(
    "c5_gate_all_history",
    f"""WITH {SESSIONS},
newest AS (SELECT incident_id, fingerprint, last(status ORDER BY ts, alert_id) AS status,
    last(matched ORDER BY ts, alert_id) AS matched FROM sessions WHERE rule_id LIKE 'r2%'
  GROUP BY ALL),
met AS (SELECT incident_id, bool_and(status = 'firing') AS all_firing,
    bool_or(list_contains(matched, 0)) AND bool_or(list_contains(matched, 1)) AS all_matched
  FROM newest GROUP BY incident_id)
SELECT *, all_firing AND all_matched AS conditions_met FROM met""",
)
def gate_all_history(spark, folder):
    return correlate.gate_all_history(sessions(spark, folder), RULES)


@query(
    "c6_block_reopen",
    f"""WITH {ALERTS},
a AS (SELECT *, CASE WHEN k % 4 = 0 THEN 'maintenance' END AS previous_status FROM alerts),
r AS (SELECT tenant_id, fingerprint, max(ts) AS resolved FROM a WHERE status = 'resolved'
  GROUP BY ALL)
SELECT alert_id FROM a LEFT JOIN r USING (tenant_id, fingerprint)
WHERE NOT coalesce(previous_status = 'maintenance' AND resolved > ts, false)""",
)
def block_reopen(spark, folder):
    before = F.when(F.col("k") % 4 == 0, "maintenance")
    alerts = tables.alerts(spark, folder).withColumn("previous_status", before)
    return correlate.block_reopen(alerts).select("alert_id")


@query(
    "c8_link_alerts",
    f"""WITH {SESSIONS} SELECT incident_id, tenant_id, fingerprint, min(ts) AS linked_at
FROM sessions GROUP BY ALL""",
)
def link_alerts(spark, folder):
    return correlate.link_alerts(sessions(spark, folder))


INCIDENT_ROWS = f"""{SESSIONS},
incident_rows AS (SELECT incident_id, tenant_id, rule_id, group_key, session_no,
    min(ts) AS start_ts, max(ts) AS last_ts, count(*) AS n_events,
    max(severity_rank) AS severity_rank FROM sessions GROUP BY ALL)"""


@query(
    "c14_past_incident_chain",
    f"""WITH {INCIDENT_ROWS} SELECT incident_id, lag(incident_id) OVER (PARTITION BY tenant_id,
  rule_id, group_key ORDER BY start_ts, incident_id) AS past_incident_id FROM incident_rows""",
)
def past_incident_chain(spark, folder):
    rows = correlate.session_incidents(sessions(spark, folder))
    return correlate.past_incident_chain(rows).select("incident_id", "past_incident_id")


NAMED = f"""{INCIDENT_ROWS},
values_ AS (SELECT incident_id, ts, alert_id, unnest([service, provider_type, 'N/A']) AS value,
    unnest([0, 1, 2]) AS var FROM sessions WHERE rule_id LIKE 'r5%'),
firsts AS (SELECT incident_id, value, min({{'v': var, 't': ts, 'i': alert_id}}) AS fa FROM values_ GROUP BY ALL),
listed AS (SELECT incident_id,
    coalesce(string_agg(value, ',' ORDER BY fa) FILTER (fa.v = 0), '') AS s,
    coalesce(string_agg(value, ',' ORDER BY fa) FILTER (fa.v = 1), '') AS p
  FROM firsts GROUP BY incident_id),
names AS (SELECT r.*, CASE WHEN rule_id LIKE 'r1%' THEN 'by service'
    WHEN rule_id LIKE 'r2%' THEN concat('INC-', row_number() OVER (PARTITION BY tenant_id
      ORDER BY start_ts, incident_id), ' - two sources')
    WHEN rule_id LIKE 'r3%' THEN 'no key'
    ELSE concat(s, ' by ', p, ' in N/A') END AS name
  FROM incident_rows r LEFT JOIN listed USING (incident_id))"""


@query("c9_name_incidents", f"WITH {NAMED} SELECT incident_id, name FROM names")
def name_incidents(spark, folder):
    linked = lineage.cut(sessions(spark, folder))
    rows = correlate.session_incidents(linked).withColumn("creation_time", F.col("start_ts"))
    numbered = sequence.running_number(rows)
    return correlate.name_incidents(linked, numbered, RULES).select("incident_id", "name")


@query(
    "a12_opened_per_rule",
    f"""WITH {INCIDENT_ROWS} SELECT tenant_id, rule_id, count(*) AS n FROM incident_rows
GROUP BY ALL""",
)
def opened_per_rule(spark, folder):
    rows = correlate.session_incidents(sessions(spark, folder))
    return rows.groupBy("tenant_id", "rule_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "flagship_incidents",
    f"""WITH {RANKED},
hashed AS (SELECT *, lag(content_hash) OVER (PARTITION BY tenant_id, fingerprint
    ORDER BY ts, alert_id) AS before FROM ranked),
kept AS (SELECT * FROM hashed WHERE before IS NULL OR before <> content_hash),
keyed AS (
  SELECT *, concat('r1-', tenant_id) AS rule_id, service AS group_key, 21600 AS timeframe_s
  FROM kept WHERE severity IN ('high', 'critical')
  UNION ALL SELECT *, concat('r3-', tenant_id), 'none', 7200 FROM kept
  WHERE severity = 'critical'),
gaps AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) > CAST(timeframe_s AS BIGINT) * 1000000
    THEN 1 ELSE 0 END AS brk FROM keyed
  WINDOW w AS (PARTITION BY tenant_id, rule_id, group_key ORDER BY ts, alert_id)),
numbered AS (SELECT *, CAST(sum(brk) OVER (PARTITION BY tenant_id, rule_id, group_key
    ORDER BY ts, alert_id) AS BIGINT) AS session_no FROM gaps),
fired AS (SELECT *, count(*) FILTER (status = 'firing') OVER (PARTITION BY tenant_id, rule_id,
    group_key, session_no ORDER BY ts, alert_id) AS fires FROM numbered),
sessions AS (SELECT *, concat_ws('/', tenant_id, rule_id, group_key, session_no)
    AS incident_id FROM fired WHERE fires > 0)
SELECT incident_id, tenant_id, rule_id, group_key, min(ts) AS start_time,
  max(ts) AS last_seen_time, max(severity_rank) AS severity,
  count(DISTINCT fingerprint) AS alerts_count,
  array_to_string(list_sort(list(DISTINCT service)), ',') AS services
FROM sessions GROUP BY ALL""",
)
def flagship_incidents(spark, folder):
    """Alerts to incidents: deduplicate, match two rules, sessionize, roll up."""
    rules = [r for r in RULES if r.rule_id[:2] in ("r1", "r3")]
    alerts = tables.alerts(spark, folder).withColumn(
        "severity_rank", severity_rank(F.col("severity"))
    )
    # the alerts that stay are a table of their own; correlation starts from it
    kept = lineage.cut(
        dedup.drop_full_duplicates(dedup.classify_duplicates(alerts)).select(
            "tenant_id", "fingerprint", "alert_id", "ts", "service", "status", "severity",
            "severity_rank", "provider_type", "name", "k", "labels",
        )
    )
    keyed = correlate.group_key(correlate.match_rules(kept, rules), rules)
    return incidents.rollup_sessions(correlate.sessionize(keyed, rules)).select(
        "incident_id",
        "tenant_id",
        "rule_id",
        "group_key",
        "start_time",
        "last_seen_time",
        "severity",
        "alerts_count",
        F.array_join("services", ",").alias("services"),
    )


RESOLVING = [
    rule
    for t in fixtures.TENANTS
    for rule in (
        CorrelationRule(
            f"l-{t}", t, "last", ("severity in ('high', 'critical')",), 86400, ("service",),
            resolve_on="last_resolved",
        ),
        CorrelationRule(
            f"a-{t}", t, "all", ("k > 20 and status <> 'acknowledged'",), 86400, ("service",),
            resolve_on="all_resolved",
        ),
    )
]


@query(
    "c3_sessions_with_resolution",
    f"""WITH {RANKED},
keyed AS (SELECT *, concat('l-', tenant_id) AS rule_id FROM ranked
    WHERE severity IN ('high', 'critical')
  UNION ALL SELECT *, concat('a-', tenant_id) FROM ranked
    WHERE k > 20 AND status <> 'acknowledged'),
gaps AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) > 86400000000
    THEN 1 ELSE 0 END AS brk FROM keyed
  WINDOW w AS (PARTITION BY rule_id, service ORDER BY ts, alert_id)),
timed AS (SELECT *, CAST(sum(brk) OVER (PARTITION BY rule_id, service ORDER BY ts, alert_id)
    AS BIGINT) AS session_no FROM gaps),
ended AS (SELECT *, coalesce(min(CASE WHEN status = 'resolved' THEN ts END) OVER (
    PARTITION BY rule_id, service, session_no, fingerprint ORDER BY ts, alert_id
    ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), TIMESTAMP '9999-12-31') AS until FROM timed),
covered AS (SELECT *, max(CASE WHEN status <> 'resolved' THEN until END) OVER w AS cover,
    count(*) FILTER (status = 'resolved') OVER w AS done FROM ended
  WINDOW w AS (PARTITION BY rule_id, service, session_no ORDER BY ts, alert_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
parts AS (SELECT *, CASE WHEN rule_id LIKE 'l%' THEN done ELSE CAST(sum(CASE WHEN cover IS NULL
    OR cover < ts THEN 1 ELSE 0 END) OVER (PARTITION BY rule_id, service, session_no
    ORDER BY ts, alert_id) AS BIGINT) END AS part_no FROM covered),
fired AS (SELECT *, count(*) FILTER (status = 'firing') OVER (PARTITION BY rule_id, service,
    session_no, part_no ORDER BY ts, alert_id) AS fires FROM parts)
SELECT alert_id, concat(tenant_id, '/', rule_id, '/', service, '/', session_no, '.', part_no)
  AS incident_id FROM fired WHERE fires > 0""",
)
def sessions_with_resolution(spark, folder):
    keyed = correlate.group_key(
        correlate.match_rules(tables.alerts(spark, folder), RESOLVING), RESOLVING
    )
    narrow = keyed.select(
        *correlate.INCIDENT_KEY, "fingerprint", "alert_id", "ts", "status"
    )
    out = resolution.sessions_with_resolution(narrow, RESOLVING)
    return out.select("alert_id", "incident_id")

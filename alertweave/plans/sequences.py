"""Per-key sequence features and deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from alertweave.operators import dedup, sequence
from alertweave.plans.registry import query
from alertweave.plans.sql import ALERTS, INCIDENTS
from alertweave.sources import tables

KEY_WINDOW = "OVER (PARTITION BY tenant_id, fingerprint ORDER BY ts, alert_id)"
BEFORE = (
    "OVER (PARTITION BY tenant_id, fingerprint ORDER BY ts, alert_id "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
)


@query(
    "w1_latest_alerts",
    f"""WITH {ALERTS}
SELECT tenant_id, fingerprint, arg_max(alert_id, (ts, alert_id)) AS alert_id, max(ts) AS ts,
  arg_max(content_hash, (ts, alert_id)) AS content_hash,
  arg_max(status, (ts, alert_id)) AS status, min(ts) AS first_ts
FROM alerts GROUP BY tenant_id, fingerprint""",
)
def latest_alerts(spark, folder):
    return sequence.latest_alerts(tables.alerts(spark, folder))


@query(
    "w2_previous_alert",
    f"""WITH {ALERTS}
SELECT alert_id, lag(alert_id) {KEY_WINDOW} AS previous_id, lag(ts) {KEY_WINDOW} AS previous_ts,
  lag(status) {KEY_WINDOW} AS previous_status FROM alerts""",
)
def previous_alert(spark, folder):
    out = sequence.previous_alert(tables.alerts(spark, folder))
    return out.select("alert_id", "previous_id", "previous_ts", "previous_status")


@query(
    "w2_previous_resolved_alert",
    f"""WITH {ALERTS}
SELECT alert_id,
  last_value(CASE WHEN status = 'resolved' THEN alert_id END IGNORE NULLS) {BEFORE} AS previous_id,
  last_value(CASE WHEN status = 'resolved' THEN ts END IGNORE NULLS) {BEFORE} AS previous_ts
FROM alerts""",
)
def previous_resolved_alert(spark, folder):
    out = sequence.previous_alert(tables.alerts(spark, folder), status="resolved")
    return out.select("alert_id", "previous_id", "previous_ts")


CLASSES = f"""{ALERTS},
before AS (SELECT *, lag(content_hash) {KEY_WINDOW} AS before_hash FROM alerts),
classes AS (SELECT *, CASE WHEN before_hash IS NULL THEN 'none'
  WHEN before_hash = content_hash THEN 'full' ELSE 'partial' END AS dedup_type FROM before)"""


@query(
    "w3_classify_duplicates",
    f"WITH {CLASSES} SELECT alert_id, dedup_type FROM classes",
)
def classify_duplicates(spark, folder):
    out = dedup.classify_duplicates(tables.alerts(spark, folder))
    return out.select("alert_id", "dedup_type")


@query(
    "w4_touch_last_received",
    f"""WITH {CLASSES},
kept AS (SELECT *, count(*) FILTER (dedup_type <> 'full') {KEY_WINDOW} AS g FROM classes)
SELECT tenant_id, fingerprint, arg_min(alert_id, (ts, alert_id)) AS alert_id, min(ts) AS ts,
  max(ts) AS last_received, count(*) AS n_received
FROM kept GROUP BY tenant_id, fingerprint, g""",
)
def touch_last_received(spark, folder):
    return dedup.touch_last_received(
        dedup.classify_duplicates(tables.alerts(spark, folder))
    )


@query(
    "w5_firing_start",
    f"""WITH {ALERTS},
runs AS (SELECT *, count(*) FILTER (status <> 'firing') {KEY_WINDOW} AS g FROM alerts)
SELECT alert_id, CASE WHEN status = 'firing' THEN min(ts) FILTER (status = 'firing')
  OVER (PARTITION BY tenant_id, fingerprint, g) END AS firing_start FROM runs""",
)
def firing_start(spark, folder):
    out = sequence.with_scans(tables.alerts(spark, folder), sequence.firing_start_scan())
    return out.select("alert_id", "firing_start")


@query(
    "w6_firing_since_resolved",
    f"""WITH {ALERTS},
runs AS (SELECT *, count(*) FILTER (status = 'resolved') {KEY_WINDOW} AS g FROM alerts),
open AS (SELECT *, row_number() OVER (PARTITION BY tenant_id, fingerprint, g
  ORDER BY ts, alert_id) AS rn FROM runs WHERE status <> 'resolved'),
firsts AS (SELECT tenant_id, fingerprint, g, ts FROM open WHERE rn = 1 AND status = 'firing')
SELECT r.alert_id, CASE WHEN r.status <> 'resolved' THEN f.ts END AS firing_since_resolved
FROM runs r LEFT JOIN firsts f USING (tenant_id, fingerprint, g)""",
)
def firing_since_resolved(spark, folder):
    out = sequence.with_scans(
        tables.alerts(spark, folder), sequence.firing_since_resolved_scan()
    )
    return out.select("alert_id", "firing_since_resolved")


def _counter_sql(word: str, name: str) -> str:
    return f"""WITH {ALERTS},
runs AS (SELECT *, count(*) FILTER (status = '{word}') {KEY_WINDOW} AS g FROM alerts)
SELECT alert_id, row_number() OVER (PARTITION BY tenant_id, fingerprint, g
  ORDER BY ts, alert_id) - CASE WHEN g > 0 THEN 1 ELSE 0 END AS {name} FROM runs"""


@query("w7_firing_counter", _counter_sql("acknowledged", "firing_counter"))
def firing_counter(spark, folder):
    out = sequence.with_scans(tables.alerts(spark, folder), sequence.firing_counter_scan())
    return out.select("alert_id", "firing_counter")


@query("w8_unresolved_counter", _counter_sql("resolved", "unresolved_counter"))
def unresolved_counter(spark, folder):
    out = sequence.with_scans(
        tables.alerts(spark, folder), sequence.unresolved_counter_scan()
    )
    return out.select("alert_id", "unresolved_counter")


@query(
    "w10_started_at",
    f"WITH {ALERTS} SELECT alert_id, min(ts) {BEFORE} AS started_at FROM alerts",
)
def started_at(spark, folder):
    out = sequence.with_scans(tables.alerts(spark, folder), sequence.started_at_scan())
    return out.select("alert_id", "started_at")


@query(
    "w11_carry_assignee",
    f"""WITH {ALERTS},
a AS (SELECT *, CASE WHEN k % 10 = 0 THEN concat('user', k) END AS assignee FROM alerts)
SELECT alert_id, CASE WHEN status <> 'resolved' THEN
  last_value(assignee IGNORE NULLS) {KEY_WINDOW} ELSE assignee END AS carried_assignee
FROM a""",
)
def carry_assignee(spark, folder):
    given = F.when(F.col("k") % 10 == 0, F.concat(F.lit("user"), "k"))
    alerts = tables.alerts(spark, folder).withColumn("assignee", given)
    return sequence.carry_assignee(alerts, "assignee").select("alert_id", "carried_assignee")


@query(
    "w12_running_number",
    f"""WITH {INCIDENTS} SELECT incident_id, row_number() OVER (PARTITION BY tenant_id
  ORDER BY creation_time, incident_id) AS running_number FROM incidents""",
)
def running_number(spark, folder):
    out = sequence.running_number(tables.incidents(spark, folder))
    return out.select("incident_id", "running_number")


@query(
    "sequence_features_one_pass",
    f"""WITH {ALERTS},
runs AS (SELECT *, count(*) FILTER (status = 'acknowledged') {KEY_WINDOW} AS ga,
  count(*) FILTER (status = 'resolved') {KEY_WINDOW} AS gr,
  count(*) FILTER (status <> 'firing') {KEY_WINDOW} AS gf FROM alerts)
SELECT alert_id,
  CASE WHEN status = 'firing' THEN min(ts) FILTER (status = 'firing')
    OVER (PARTITION BY tenant_id, fingerprint, gf) END AS firing_start,
  row_number() OVER (PARTITION BY tenant_id, fingerprint, ga ORDER BY ts, alert_id)
    - CASE WHEN ga > 0 THEN 1 ELSE 0 END AS firing_counter,
  row_number() OVER (PARTITION BY tenant_id, fingerprint, gr ORDER BY ts, alert_id)
    - CASE WHEN gr > 0 THEN 1 ELSE 0 END AS unresolved_counter,
  min(ts) {BEFORE} AS started_at FROM runs""",
)
def sequence_features(spark, folder):
    out = sequence.with_sequence_features(tables.alerts(spark, folder))
    return out.select(
        "alert_id", "firing_start", "firing_counter", "unresolved_counter", "started_at"
    )

"""Incident lifecycle, reads, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from alertweave.operators import health, incidents, mapping, reads, sequence
from alertweave.operators.reads import IncidentTables
from alertweave.plans.mappings import EXTRACTED, extracted
from alertweave.plans.registry import query
from alertweave.plans.sql import (
    ALERTS,
    ENRICHMENTS,
    INCIDENTS,
    LATEST_LINE,
    LINE_ALERTS,
    LINKS,
    LIVE,
)
from alertweave.sources import tables

SUMMARY = f"""{LATEST_LINE},
spans AS (SELECT tenant_id, fingerprint, min(ts) AS first_ts, max(ts) AS last_ts
  FROM line_alerts GROUP BY ALL),
summary AS (SELECT l.*, s.first_ts, s.last_ts FROM latest_line l
  JOIN spans s USING (tenant_id, fingerprint)),
{LIVE}, {INCIDENTS}"""
EFFECTIVE = f"""{SUMMARY}, {ENRICHMENTS},
effective AS (SELECT s.*, coalesce(e_status, status) AS effective_status FROM summary s
  LEFT JOIN enrichments e USING (tenant_id, fingerprint))"""


def summary(spark, folder):
    return incidents.key_summary(tables.line_alerts(spark, folder))


def live(spark, folder):
    return incidents.live_links(tables.links(spark, folder))


def effective(spark, folder):
    return incidents.effective_status(summary(spark, folder), tables.enrichments(spark, folder))


def latest_line(spark, folder):
    rows = tables.line_alerts(spark, folder).withColumn("content_hash", F.col("status"))
    return sequence.latest_alerts(rows).select(
        "tenant_id", "fingerprint", "alert_id", "ts", "status"
    )


ROLLED = f"""{SUMMARY},
rolled AS (SELECT l.incident_id, list(DISTINCT source) AS srcs, list(DISTINCT service) AS svcs,
    max(severity_rank) AS sev, count(*) AS n, min(first_ts) AS f, max(last_ts) AS t
  FROM live l JOIN summary s USING (tenant_id, fingerprint) GROUP BY l.incident_id)"""


@query(
    "a4_incident_rollup",
    f"""WITH {ROLLED}
SELECT i.incident_id, coalesce(n, 0) AS alerts_count, f AS start_time, t AS last_seen_time,
  CASE WHEN forced_severity THEN severity ELSE coalesce(sev, severity) END AS severity,
  array_to_string(list_sort(list_distinct(sources || coalesce(srcs, []))), ',') AS sources,
  array_to_string(list_sort(list_distinct(affected_services || coalesce(svcs, []))), ',')
    AS services
FROM incidents i LEFT JOIN rolled USING (incident_id)""",
)
def incident_rollup(spark, folder):
    out = incidents.incident_rollup(
        tables.incidents(spark, folder), live(spark, folder), summary(spark, folder)
    )
    return out.select(
        "incident_id",
        "alerts_count",
        "start_time",
        "last_seen_time",
        "severity",
        F.array_join("sources", ",").alias("sources"),
        F.array_join("affected_services", ",").alias("services"),
    )


@query(
    "a5_incident_rollup_after_unlink",
    f"""WITH {ROLLED},
edges AS (SELECT incident_id, tenant_id, fingerprint, bool_or(deleted_at IS NULL) AS alive
  FROM links GROUP BY ALL),
gone AS (SELECT e.incident_id, list(DISTINCT source) AS srcs, list(DISTINCT service) AS svcs
  FROM edges e JOIN summary s USING (tenant_id, fingerprint) WHERE NOT alive GROUP BY ALL),
both_ AS (SELECT i.*, r.n, r.f, r.t, r.sev, coalesce(r.srcs, []) AS ls,
    coalesce(r.svcs, []) AS lv, coalesce(g.srcs, []) AS gs, coalesce(g.svcs, []) AS gv
  FROM incidents i LEFT JOIN rolled r USING (incident_id) LEFT JOIN gone g USING (incident_id))
SELECT incident_id, coalesce(n, 0) AS alerts_count, f AS start_time, t AS last_seen_time,
  CASE WHEN forced_severity THEN severity ELSE coalesce(sev, 1) END AS severity,
  array_to_string(list_sort(list_distinct(list_filter(sources, lambda x: NOT
    (list_contains(gs, x) AND NOT list_contains(ls, x))))), ',') AS sources,
  array_to_string(list_sort(list_distinct(list_filter(affected_services, lambda x: NOT
    (list_contains(gv, x) AND NOT list_contains(lv, x))))), ',') AS services
FROM both_""",
)
def incident_rollup_after_unlink(spark, folder):
    out = incidents.incident_rollup_after_unlink(
        tables.incidents(spark, folder), tables.links(spark, folder), summary(spark, folder)
    )
    return out.select(
        "incident_id",
        "alerts_count",
        "start_time",
        "last_seen_time",
        "severity",
        F.array_join("sources", ",").alias("sources"),
        F.array_join("affected_services", ",").alias("services"),
    )


@query(
    "a7_count_links",
    f"WITH {LIVE} SELECT incident_id, count(*) AS n FROM live GROUP BY incident_id",
)
def count_links(spark, folder):
    return live(spark, folder).groupBy("incident_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "a8_firing_total",
    f"""WITH {LATEST_LINE}, {LIVE} SELECT incident_id, CAST(greatest(count(*),
  sum(coalesce(CASE WHEN unresolved_counter > 0 THEN unresolved_counter END, 1))) AS BIGINT)
  AS firing_total FROM live JOIN latest_line USING (tenant_id, fingerprint)
GROUP BY incident_id""",
)
def firing_total(spark, folder):
    at = F.struct("ts", "alert_id")
    counters = (
        tables.line_alerts(spark, folder)
        .groupBy("tenant_id", "fingerprint")
        .agg(F.max_by("unresolved_counter", at).alias("u"))
        .select(
            "tenant_id",
            "fingerprint",
            F.when(F.col("u") > 0, F.col("u")).alias("unresolved_counter"),
        )
    )
    return incidents.firing_total(live(spark, folder), counters)


@query(
    "j15_all_in_status",
    f"""WITH {EFFECTIVE},
flags AS (SELECT l.incident_id, bool_and(effective_status = 'resolved') AS f FROM live l
  JOIN effective USING (tenant_id, fingerprint) GROUP BY l.incident_id)
SELECT incident_id, coalesce(f, false) AS all_in_status FROM incidents
LEFT JOIN flags USING (incident_id)""",
)
def all_in_status(spark, folder):
    out = incidents.all_in_status(
        tables.incidents(spark, folder),
        live(spark, folder),
        effective(spark, folder),
        "resolved",
    )
    return out.select("incident_id", "all_in_status")


@query(
    "w9_edge_alert_resolved",
    f"""WITH {EFFECTIVE} SELECT l.incident_id,
  arg_min(effective_status = 'resolved', (last_ts, fingerprint)) AS first_alert,
  arg_max(effective_status = 'resolved', (last_ts, fingerprint)) AS last_alert
FROM live l JOIN effective USING (tenant_id, fingerprint) GROUP BY l.incident_id""",
)
def edge_alert_resolved(spark, folder):
    out = incidents.alert_status_flags(live(spark, folder), effective(spark, folder))
    return out.select("incident_id", "first_alert", "last_alert")


@query(
    "c10_resolve_incidents",
    f"""WITH {EFFECTIVE},
flags AS (SELECT l.incident_id, bool_and(effective_status = 'resolved') AS a,
  arg_min(effective_status = 'resolved', (last_ts, fingerprint)) AS f,
  arg_max(effective_status = 'resolved', (last_ts, fingerprint)) AS t
  FROM live l JOIN effective USING (tenant_id, fingerprint) GROUP BY l.incident_id)
SELECT incident_id, CASE WHEN coalesce(CASE resolve_on WHEN 'all_resolved' THEN a
  WHEN 'first_resolved' THEN f WHEN 'last_resolved' THEN t END, false) THEN 'resolved'
  ELSE status END AS status FROM incidents LEFT JOIN flags USING (incident_id)""",
)
def resolve_incidents(spark, folder):
    out = incidents.resolve_incidents(
        tables.incidents(spark, folder), live(spark, folder), effective(spark, folder)
    )
    return out.select("incident_id", "status")


STATUS_OPS = """status_ops AS (SELECT l_orderkey AS incident_id, l_shipdate AS ts,
  l_orderkey * 100000000 + l_partkey * 10000 + l_suppkey * 10 + l_linenumber AS seq,
  CASE l_linenumber % 3 WHEN 0 THEN 'resolved' WHEN 1 THEN 'acknowledged' ELSE 'firing' END
    AS status, concat('user-', l_suppkey % 10) AS actor
  FROM lineitem)"""


def status_ops(spark, folder):
    n = F.col("l_linenumber") % 3
    key = F.col("l_orderkey") * 100000000 + F.col("l_partkey") * 10000
    return tables.read_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("incident_id"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        (key + F.col("l_suppkey") * 10 + F.col("l_linenumber")).alias("seq"),
        F.when(n == 0, "resolved").when(n == 1, "acknowledged").otherwise("firing").alias("status"),
        F.concat(F.lit("user-"), F.col("l_suppkey") % 10).alias("actor"),
    )


@query(
    "c11_change_status",
    f"""WITH {INCIDENTS}, {STATUS_OPS},
newest AS (SELECT incident_id, arg_max(status, (ts, seq)) AS s, arg_max(actor, (ts, seq)) AS a,
  max(CASE WHEN status = 'resolved' THEN ts END) AS e FROM status_ops GROUP BY incident_id)
SELECT incident_id, coalesce(s, status) AS status, coalesce(a, assignee) AS assignee,
  e AS end_time FROM incidents LEFT JOIN newest USING (incident_id)""",
)
def change_status(spark, folder):
    out = incidents.change_status(tables.incidents(spark, folder), status_ops(spark, folder))
    return out.select("incident_id", "status", "assignee", "end_time")


@query(
    "c11_cascade_status",
    f"""WITH {LIVE}, {STATUS_OPS} SELECT tenant_id, fingerprint, ts, seq, status AS value
FROM status_ops JOIN live USING (incident_id) WHERE status <> 'firing'""",
)
def cascade_status(spark, folder):
    out = incidents.cascade_status(status_ops(spark, folder), live(spark, folder))
    return out.select("tenant_id", "fingerprint", "ts", "seq", "value")


@query(
    "c11_status_audit",
    f"""WITH {INCIDENTS}, {STATUS_OPS},
j AS (SELECT o.*, i.status AS before, i.assignee FROM status_ops o JOIN incidents i
  USING (incident_id))
SELECT incident_id, ts, actor, 'Incident status changed' AS action,
  concat('Incident status changed from ', before, ' to ', status) AS description FROM j
UNION ALL SELECT incident_id, ts, actor, 'Incident assigned',
  concat('Incident self-assigned to ', actor) FROM j WHERE actor <> assignee""",
)
def status_audit(spark, folder):
    own = tables.incidents(spark, folder).select(
        "incident_id", F.col("status").alias("before"), "assignee"
    )
    ops = status_ops(spark, folder).join(own, "incident_id")
    return incidents.status_audit(ops, F.col("before"), F.col("assignee"))


@query(
    "c12_force_severity",
    f"""WITH {INCIDENTS},
pinned AS (SELECT l_orderkey AS incident_id, CAST(arg_max(l_linenumber,
    (l_shipdate, l_linenumber * 100000000 + l_partkey)) % 5 + 1 AS INT) AS p
  FROM lineitem GROUP BY l_orderkey)
SELECT incident_id, coalesce(p, severity) AS severity, p IS NOT NULL OR forced_severity
  AS forced_severity FROM incidents LEFT JOIN pinned USING (incident_id)""",
)
def force_severity(spark, folder):
    ops = tables.read_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("incident_id"),
        F.col("l_shipdate").alias("ts"),
        (F.col("l_linenumber") * 100000000 + F.col("l_partkey")).alias("seq"),
        (F.col("l_linenumber") % 5 + 1).alias("severity"),
    )
    out = incidents.force_severity(tables.incidents(spark, folder), ops)
    return out.select("incident_id", "severity", "forced_severity")


LINK_OPS = """link_ops AS (SELECT l_orderkey AS incident_id, concat('t', l_orderkey % 3)
    AS tenant_id, concat('part-', l_partkey % 50) AS fingerprint, l_shipdate AS ts,
    l_orderkey * 100000000 + l_partkey * 10000 + l_suppkey * 10 + l_linenumber AS seq,
    CASE WHEN l_returnflag = 'R' THEN 'unlink' ELSE 'link' END AS action FROM lineitem)"""


@query(
    "c13_unlink_alerts",
    f"""WITH {LINK_OPS} SELECT incident_id, tenant_id, fingerprint,
  min(CASE WHEN action = 'link' THEN ts END) AS linked_at,
  CASE WHEN arg_max(action, (ts, seq)) = 'unlink' THEN max(ts) END AS deleted_at
FROM link_ops GROUP BY ALL""",
)
def unlink_alerts(spark, folder):
    key = F.col("l_orderkey") * 100000000 + F.col("l_partkey") * 10000
    ops = tables.read_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("incident_id"),
        F.concat(F.lit("t"), F.col("l_orderkey") % 3).alias("tenant_id"),
        F.concat(F.lit("part-"), F.col("l_partkey") % 50).alias("fingerprint"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        (key + F.col("l_suppkey") * 10 + F.col("l_linenumber")).alias("seq"),
        F.when(F.col("l_returnflag") == "R", "unlink").otherwise("link").alias("action"),
    )
    return incidents.apply_link_ops(ops)


@query(
    "c15_format_incidents",
    f"""WITH {INCIDENTS} SELECT incident_id, CASE WHEN incident_id % 9 = 0 THEN 'firing'
  ELSE status END AS status, coalesce(user_generated_name, ai_generated_name) AS display_name,
  CASE severity WHEN 1 THEN 'low' WHEN 2 THEN 'info' WHEN 3 THEN 'warning' WHEN 4 THEN 'high'
    ELSE 'critical' END AS severity FROM incidents""",
)
def format_incidents(spark, folder):
    odd = F.when(F.col("incident_id") % 9 == 0, "lost").otherwise(F.col("status"))
    rows = tables.incidents(spark, folder).withColumn("status", odd)
    out = incidents.format_incidents(rows)
    return out.select("incident_id", "status", "display_name", "severity")


OPS = """ops AS (
  SELECT o_orderkey AS incident_id, concat('t', o_orderkey % 3) AS tenant_id,
    o_orderdate AS ts, 0 AS seq, 'create' AS action, concat('n-', o_orderpriority)
    AS user_generated_name, NULL AS assignee, 'firing' AS status, 1 AS severity,
    NULL AS same_incident_in_the_past_id, 'made' AS user_summary, false AS generated_by_ai
  FROM orders WHERE o_orderkey % 7 <> 0
  UNION ALL SELECT l_orderkey, concat('t', l_orderkey % 3), TIMESTAMP '2010-01-01'
    + to_days(CAST(l_linenumber AS INT)), l_orderkey * 100000000 + l_partkey * 10000
    + l_suppkey * 10 + l_linenumber,
    CASE WHEN l_quantity > 47 THEN 'delete' ELSE 'update' END,
    CASE WHEN l_linenumber % 2 = 0 THEN concat('renamed-', l_partkey) END,
    CASE WHEN l_linenumber % 3 = 0 THEN concat('user-', l_suppkey) END,
    CASE WHEN l_linenumber = 4 THEN 'acknowledged' END, NULL,
    CASE WHEN l_linenumber % 2 = 1 THEN l_partkey END,
    CASE WHEN l_linenumber % 4 > 0 THEN concat('s-', l_partkey) END, l_linenumber % 2 = 0
  FROM lineitem)"""


def incident_ops(spark, folder):
    text, number = F.lit(None).cast("string"), F.lit(None).cast("long")
    orders = tables.read_table(spark, folder, "orders")
    line = tables.read_table(spark, folder, "lineitem")
    n = F.col("l_linenumber")
    created = orders.filter("o_orderkey % 7 <> 0").select(
        F.col("o_orderkey").alias("incident_id"),
        F.concat(F.lit("t"), F.col("o_orderkey") % 3).alias("tenant_id"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.lit(0).cast("long").alias("seq"),
        F.lit("create").alias("action"),
        F.concat(F.lit("n-"), "o_orderpriority").alias("user_generated_name"),
        text.alias("assignee"),
        F.lit("firing").alias("status"),
        F.lit(1).alias("severity"),
        number.alias("same_incident_in_the_past_id"),
        F.lit("made").alias("user_summary"),
        F.lit(False).alias("generated_by_ai"),
    )
    key = F.col("l_orderkey") * 100000000 + F.col("l_partkey") * 10000
    changed = line.select(
        F.col("l_orderkey").alias("incident_id"),
        F.concat(F.lit("t"), F.col("l_orderkey") % 3).alias("tenant_id"),
        (F.lit("2010-01-01").cast("timestamp") + F.make_dt_interval(days=n)).alias("ts"),
        (key + F.col("l_suppkey") * 10 + n).alias("seq"),
        F.when(F.col("l_quantity") > 47, "delete").otherwise("update").alias("action"),
        F.when(n % 2 == 0, F.concat(F.lit("renamed-"), "l_partkey")).alias(
            "user_generated_name"
        ),
        F.when(n % 3 == 0, F.concat(F.lit("user-"), "l_suppkey")).alias("assignee"),
        F.when(n == 4, "acknowledged").alias("status"),
        F.lit(None).cast("int").alias("severity"),
        F.when(n % 2 == 1, F.col("l_partkey")).alias("same_incident_in_the_past_id"),
        F.when(n % 4 > 0, F.concat(F.lit("s-"), "l_partkey")).alias("user_summary"),
        (n % 2 == 0).alias("generated_by_ai"),
    )
    return created.unionByName(changed)


@query(
    "s12_apply_incident_ops",
    f"""WITH {OPS},
folded AS (SELECT incident_id, tenant_id, bool_or(action = 'create') AS created,
  last(CASE WHEN action = 'delete' THEN 'deleted' ELSE status END ORDER BY ts, seq)
    FILTER (action = 'delete' OR status IS NOT NULL) AS status,
  last(user_generated_name ORDER BY ts, seq) FILTER (user_generated_name IS NOT NULL)
    AS user_generated_name,
  last(assignee ORDER BY ts, seq) FILTER (assignee IS NOT NULL) AS assignee,
  last(severity ORDER BY ts, seq) FILTER (severity IS NOT NULL) AS severity,
  last(same_incident_in_the_past_id ORDER BY ts, seq) FILTER (action <> 'delete')
    AS same_incident_in_the_past_id,
  last(user_summary ORDER BY ts, seq) FILTER (action <> 'delete'
    AND (NOT generated_by_ai OR user_summary IS NOT NULL)) AS user_summary,
  last(user_summary ORDER BY ts, seq) FILTER (action <> 'delete' AND generated_by_ai)
    AS generated_summary
  FROM ops GROUP BY incident_id, tenant_id)
SELECT * EXCLUDE (created) FROM folded WHERE created""",
)
def apply_incident_ops(spark, folder):
    return incidents.apply_incident_ops(incident_ops(spark, folder))


@query(
    "j18_new_links",
    f"""WITH {LINKS}, cand AS (SELECT l_orderkey AS incident_id,
  concat('t', l_orderkey % 3) AS tenant_id, concat('part-', p) AS fingerprint
  FROM (SELECT l_orderkey, unnest([l_partkey, l_partkey + 1]) AS p FROM lineitem))
SELECT DISTINCT 'live' AS kind, c.* FROM cand c WHERE NOT EXISTS (SELECT 1 FROM links l
  WHERE l.incident_id = c.incident_id AND l.tenant_id = c.tenant_id
    AND l.fingerprint = c.fingerprint AND l.deleted_at IS NULL)
UNION ALL SELECT DISTINCT 'never', c.* FROM cand c WHERE NOT EXISTS (SELECT 1 FROM links l
  WHERE l.incident_id = c.incident_id AND l.tenant_id = c.tenant_id
    AND l.fingerprint = c.fingerprint)""",
)
def new_links(spark, folder):
    part = F.explode(F.array("l_partkey", F.col("l_partkey") + 1)).alias("p")
    candidates = (
        tables.read_table(spark, folder, "lineitem")
        .select(
            F.col("l_orderkey").alias("incident_id"),
            F.concat(F.lit("t"), F.col("l_orderkey") % 3).alias("tenant_id"),
            part,
        )
        .withColumn("fingerprint", F.concat(F.lit("part-"), "p"))
    )
    links = tables.links(spark, folder)
    kinds = {"live": False, "never": True}
    parts = [
        incidents.new_links(candidates, links, exclude_unlinked=flag).withColumn(
            "kind", F.lit(kind)
        )
        for kind, flag in kinds.items()
    ]
    return parts[0].unionByName(parts[1])


# ---- reads

EVENTS_SQL = f"""{LATEST_LINE}, {LIVE}, {INCIDENTS}, {ENRICHMENTS},
ie AS (SELECT o_orderkey AS incident_id,
  CASE WHEN o_orderkey % 17 = 0 THEN 'acknowledged' END AS ie_status FROM orders),
base AS (SELECT i.* REPLACE (coalesce(ie_status, status) AS status),
    same_incident_in_the_past_id IS NOT NULL AS has_linked_incident
  FROM incidents i LEFT JOIN ie USING (incident_id) WHERE is_visible),
chain AS (SELECT l.incident_id, a.service, coalesce(e_status, a.status) AS a_status
  FROM live l LEFT JOIN latest_line a USING (tenant_id, fingerprint)
  LEFT JOIN enrichments e USING (tenant_id, fingerprint))"""


def incident_enrichments(spark, folder):
    key = F.col("o_orderkey")
    # every incident has an operation; most have no value for the status
    value = F.when(key % 17 == 0, "acknowledged")
    return tables.read_table(spark, folder, "orders").select(
        F.concat(F.lit("t"), key % 3).alias("tenant_id"),
        key.cast("string").alias("key"),
        F.create_map(F.lit("status"), value).alias("enrichments"),
    )


def incident_tables(spark, folder):
    alerts = tables.line_alerts(spark, folder).withColumns(
        {
            "event": F.to_json(F.struct("service", "status", "severity_rank")),
            "provider_type": F.col("source"),
        }
    )
    return IncidentTables(
        tables.incidents(spark, folder).withColumn("alerts_count", F.lit(0)),
        incident_enrichments(spark, folder),
        tables.links(spark, folder),
        latest_line(spark, folder),
        alerts,
        tables.enrichments(spark, folder),
    )


def by_alert(fields):
    return fields.where("alert.status", lambda c: c == "firing") & fields.where(
        "alert.service", lambda c: c.isin("svc-1", "svc-2", "svc-3")
    )


def by_incident(fields):
    return fields.where("status", lambda c: c == "acknowledged") & fields.where(
        "hasLinkedIncident", lambda c: c
    )


BY_ALERT = """incident_id IN (SELECT incident_id FROM chain WHERE a_status = 'firing'
  AND service IN ('svc-1', 'svc-2', 'svc-3'))"""


@query(
    "t1_query_incidents_page",
    f"""WITH {EVENTS_SQL} SELECT incident_id, status, creation_time FROM base
WHERE NOT is_candidate AND {BY_ALERT}
ORDER BY creation_time DESC NULLS LAST, incident_id LIMIT 25 OFFSET 10""",
)
def query_incidents_page(spark, folder):
    page, _ = reads.query_incidents(
        incident_tables(spark, folder),
        by_alert,
        sort="-creation_time",
        offset=10,
        candidate=False,
    )
    status = F.coalesce(
        F.try_element_at("incident_enrichments", F.lit("status")), F.col("status")
    )
    return page.select("incident_id", status.alias("status"), "creation_time")


@query(
    "t1_query_incidents_without_alerts",
    f"""WITH {EVENTS_SQL} SELECT incident_id, severity FROM base
WHERE NOT is_candidate AND status = 'acknowledged' AND has_linked_incident
ORDER BY severity NULLS LAST, incident_id LIMIT 25""",
)
def query_incidents_without_alerts(spark, folder):
    page, _ = reads.query_incidents(
        incident_tables(spark, folder), by_incident, sort="severity", candidate=False
    )
    return page.select("incident_id", "severity")


@query(
    "a6_count_incidents",
    f"""WITH {EVENTS_SQL} SELECT count(*) AS total FROM base
WHERE NOT is_candidate AND {BY_ALERT}""",
)
def count_incidents(spark, folder):
    _, total = reads.query_incidents(
        incident_tables(spark, folder), by_alert, candidate=False
    )
    return total


def _sorted_sql(option: str) -> str:
    name = option.removeprefix("-")
    way = "DESC" if option.startswith("-") else "ASC"
    return f"""SELECT '{option}' AS option, incident_id FROM (SELECT incident_id FROM counted
  ORDER BY {name} {way} NULLS LAST, incident_id LIMIT 40 OFFSET 5)"""


OPTIONS = [d + f for f in reads.SORT_FIELDS for d in ("", "-")]


@query(
    "t2_sort_options",
    f"""WITH {LIVE}, {INCIDENTS},
n AS (SELECT incident_id, count(*) AS alerts_count FROM live GROUP BY incident_id),
counted AS (SELECT i.*, coalesce(alerts_count, 0) AS alerts_count FROM incidents i
  LEFT JOIN n USING (incident_id))
{" UNION ALL ".join(_sorted_sql(o) for o in OPTIONS)}""",
)
def sort_options(spark, folder):
    n = live(spark, folder).groupBy("incident_id").agg(F.count(F.lit(1)).alias("alerts_count"))
    rows = (
        tables.incidents(spark, folder)
        .join(n, "incident_id", "left")
        .na.fill(0, ["alerts_count"])
    )
    out = None
    for option in OPTIONS:
        part = reads.page(rows, reads.sort_by(option), limit=40, offset=5).select(
            F.lit(option).alias("option"), "incident_id"
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "j3_incidents_with_alerts",
    f"""WITH {EVENTS_SQL} SELECT i.incident_id, c.service, c.a_status
FROM incidents i LEFT JOIN chain c USING (incident_id)""",
)
def incidents_with_alerts(spark, folder):
    t = incident_tables(spark, folder)
    rows = reads.incidents_with_alerts(t.incidents.select("tenant_id", "incident_id"), t)
    enriched = F.try_element_at("enrichments", F.lit("status"))
    status = F.coalesce(enriched, F.get_json_object("event", "$.status"))
    service = F.get_json_object("event", "$.service")
    return rows.select("incident_id", service.alias("service"), status.alias("a_status"))


@query(
    "j4_incidents_with_enrichment",
    f"""WITH {INCIDENTS} SELECT incident_id, CASE WHEN incident_id % 17 = 0
  THEN 'acknowledged' ELSE status END AS status FROM incidents""",
)
def incidents_with_enrichment(spark, folder):
    rows = reads.incidents_with_enrichment(
        tables.incidents(spark, folder), incident_enrichments(spark, folder)
    )
    enriched = F.try_element_at("incident_enrichments", F.lit("status"))
    return rows.select("incident_id", F.coalesce(enriched, "status").alias("status"))


@query(
    "j5_flag_linked_incident",
    f"""WITH {INCIDENTS} SELECT incident_id, same_incident_in_the_past_id IS NOT NULL
  AS has_linked_incident FROM incidents""",
)
def flag_linked_incident(spark, folder):
    out = reads.flag_linked_incident(tables.incidents(spark, folder))
    return out.select("incident_id", "has_linked_incident")


@query(
    "j6_alerts_of_incidents",
    f"""WITH {LATEST_LINE}, {LIVE} SELECT incident_id, alert_id, service FROM live
JOIN latest_line USING (tenant_id, fingerprint)
WHERE incident_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""",
)
def alerts_of_incidents(spark, folder):
    ids = (
        tables.read_table(spark, folder, "orders")
        .filter("o_orderstatus = 'P'")
        .select(F.col("o_orderkey").alias("incident_id"))
    )
    alerts = tables.line_alerts(spark, folder).select(
        "tenant_id", "fingerprint", "alert_id", "service"
    )
    out = reads.alerts_of_incidents(
        ids, live(spark, folder), latest_line(spark, folder), alerts
    )
    return out.select("incident_id", "alert_id", "service").distinct()


@query(
    "j7_incidents_of_alerts",
    f"""WITH {LIVE}, {INCIDENTS} SELECT incident_id, fingerprint, status FROM live
JOIN incidents USING (tenant_id, incident_id)
WHERE fingerprint IN (SELECT concat('part-', p_partkey) FROM part WHERE p_size = 7)
  AND tenant_id = 't1'""",
)
def incidents_of_alerts(spark, folder):
    keys = (
        tables.read_table(spark, folder, "part")
        .filter("p_size = 7")
        .select(
            F.lit("t1").alias("tenant_id"),
            F.concat(F.lit("part-"), "p_partkey").alias("fingerprint"),
        )
    )
    out = reads.incidents_of_alerts(
        keys, live(spark, folder), tables.incidents(spark, folder)
    )
    return out.select("incident_id", "fingerprint", "status")


PAGE_INCIDENT = 7


@query(
    "j8_incident_alert_page",
    f"""WITH {LATEST_LINE}, {LINKS},
edges AS (SELECT incident_id, tenant_id, fingerprint, min(linked_at) AS linked_at,
  max(deleted_at) AS deleted_at FROM links WHERE incident_id = {PAGE_INCIDENT} GROUP BY ALL),
rows_ AS (SELECT e.*, l.alert_id, l.ts FROM edges e JOIN latest_line l
  USING (tenant_id, fingerprint))
SELECT fingerprint, alert_id, linked_at, deleted_at, (SELECT count(*) FROM rows_) AS total
FROM rows_ ORDER BY ts DESC, fingerprint LIMIT 25""",
)
def incident_alert_page(spark, folder):
    page, total = reads.incident_alert_page(
        tables.links(spark, folder),
        latest_line(spark, folder),
        PAGE_INCIDENT,
        include_unlinked=True,
    )
    joined = page.withColumn("_k", F.lit(1)).join(total.withColumn("_k", F.lit(1)), "_k")
    return joined.select("fingerprint", "alert_id", "linked_at", "deleted_at", "total")


@query(
    "j9_linked_providers",
    f"""WITH {ALERTS} SELECT tenant_id, provider_type, provider_id, max(ts) AS last_alert_ts
FROM alerts WHERE provider_type <> 'group' AND NOT coalesce(provider_id = 'p-1'
  AND tenant_id IN (SELECT concat('t', r_regionkey) FROM region), false) GROUP BY ALL""",
)
def linked_providers(spark, folder):
    installed = tables.read_table(spark, folder, "region").select(
        F.concat(F.lit("t"), "r_regionkey").alias("tenant_id"),
        F.lit("p-1").alias("provider_id"),
    )
    return reads.linked_providers(tables.alerts(spark, folder), installed)


@query(
    "j19_resolve_provider",
    """SELECT event_id, CASE WHEN user_id % 2 = 0 THEN 'given' WHEN user_id % 30 < 25
  THEN concat('id-', user_id % 30) END AS provider_id FROM events""",
)
def resolve_provider(spark, folder):
    user = F.col("user_id")
    events = tables.read_table(spark, folder, "events").select(
        "event_id",
        F.lit("t0").alias("tenant_id"),
        F.concat(F.lit("NATION_"), user % 30).alias("provider_name"),
        F.when(user % 2 == 0, "given").alias("provider_id"),
        F.lit(None).cast("string").alias("provider_type"),
    )
    providers = tables.read_table(spark, folder, "nation").select(
        F.lit("t0").alias("tenant_id"),
        F.col("n_name").alias("provider_name"),
        F.concat(F.lit("id-"), "n_nationkey").alias("provider_id"),
        F.lit("grafana").alias("provider_type"),
    )
    return reads.resolve_provider(events, providers).select("event_id", "provider_id")


@query(
    "t3_latest_logs",
    f"""WITH {ALERTS} SELECT provider_type, alert_id AS log_id, position FROM (
  SELECT *, row_number() OVER (PARTITION BY provider_type ORDER BY ts DESC, alert_id DESC)
    AS position FROM alerts) WHERE position <= 20""",
)
def latest_logs(spark, folder):
    logs = tables.alerts(spark, folder).select(
        "provider_type", F.col("alert_id").alias("log_id"), "ts"
    )
    out = reads.latest_logs(logs, "provider_type", 20)
    return out.select("provider_type", "log_id", F.col("position").cast("long").alias("position"))


@query(
    "t4_enrichment_event_page",
    f"""WITH {EXTRACTED} SELECT alert_id, ts FROM x2
ORDER BY ts DESC, alert_id LIMIT 25 OFFSET 50""",
)
def enrichment_event_page(spark, folder):
    events = mapping.enrichment_outcomes(extracted(spark, folder), "alert_id", "ts")
    return reads.enrichment_event_page(events, 1, offset=50).select("alert_id", "ts")


@query(
    "t5_alerts_by_fingerprints",
    f"""WITH {LINE_ALERTS} SELECT alert_id, ts FROM line_alerts WHERE tenant_id = 't2'
  AND fingerprint IN (SELECT concat('part-', p_partkey) FROM part WHERE p_size = 9)""",
)
def alerts_by_fingerprints(spark, folder):
    keys = (
        tables.read_table(spark, folder, "part")
        .filter("p_size = 9")
        .select(
            F.lit("t2").alias("tenant_id"),
            F.concat(F.lit("part-"), "p_partkey").alias("fingerprint"),
        )
    )
    out = reads.alerts_by_fingerprints(tables.line_alerts(spark, folder), keys)
    return out.select("alert_id", "ts")


@query(
    "t6_rules_by_priority",
    """SELECT p_partkey AS rule_id, p_size AS priority FROM part WHERE p_partkey % 4 <> 0""",
)
def rules_by_priority(spark, folder):
    rules = tables.read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("rule_id"),
        F.col("p_size").alias("priority"),
        (F.col("p_partkey") % 4 == 0).alias("disabled"),
    )
    return reads.rules_by_priority(rules).select("rule_id", "priority")


# ---- sets and reports


@query(
    "u1_union_sets",
    f"""WITH {INCIDENTS} SELECT incident_id, array_to_string(list_sort(list_distinct(
  sources || affected_services)), ',') AS both_sets FROM incidents""",
)
def union_sets(spark, folder):
    both = incidents.union_sets(F.col("sources"), F.col("affected_services"))
    return tables.incidents(spark, folder).select(
        "incident_id", F.array_join(both, ",").alias("both_sets")
    )


@query(
    "u2_remove_from_set",
    f"""WITH {INCIDENTS} SELECT incident_id, array_to_string(list_sort(list_distinct(
  list_filter(affected_services, lambda x: x <> 'svc-0'))), ',') AS rest FROM incidents""",
)
def remove_from_set(spark, folder):
    rest = incidents.remove_from_set(F.col("affected_services"), F.array(F.lit("svc-0")))
    return tables.incidents(spark, folder).select(
        "incident_id", F.array_join(rest, ",").alias("rest")
    )


@query(
    "u3_diff_ignoring",
    f"""WITH {ALERTS} SELECT alert_id, severity, 'left' AS side FROM alerts
  WHERE alert_id % 50 = 0
UNION ALL SELECT alert_id, 'changed', 'right' FROM alerts WHERE alert_id % 50 = 0""",
)
def diff_ignoring(spark, folder):
    left = tables.alerts(spark, folder).select("alert_id", "severity", "ts")
    changed = F.when(F.col("alert_id") % 50 == 0, "changed").otherwise(F.col("severity"))
    right = left.withColumns(
        {"severity": changed, "ts": F.col("ts") + F.expr("interval 1 second")}
    )
    return reads.diff_ignoring(left, right, ["ts"])


@query(
    "a9_spammy_alerts",
    f"""WITH {ALERTS},
pairs AS (SELECT a.tenant_id, a.fingerprint, count(*) AS n FROM alerts a JOIN alerts b
  ON a.tenant_id = b.tenant_id AND a.fingerprint = b.fingerprint
  AND (a.ts < b.ts OR (a.ts = b.ts AND a.alert_id < b.alert_id))
  AND b.ts - a.ts <= INTERVAL 1 HOUR GROUP BY ALL HAVING count(*) >= 3)
SELECT tenant_id, date_trunc('hour', ts) AS hour, count(*) AS n FROM alerts
JOIN pairs USING (tenant_id, fingerprint) GROUP BY ALL""",
)
def spammy_alerts(spark, folder):
    return health.spammy_alerts(tables.alerts(spark, folder))


PAYLOAD_SQL = f"""{ALERTS},
fields AS (SELECT tenant_id, ts, provider_type, provider_id, unnest(list_filter([
  'kind', 'props.k', CASE WHEN k % 100 = 1 THEN 'rare' END], lambda x: x IS NOT NULL)) AS field
  FROM alerts),
catalog_ AS (SELECT tenant_id, field,
  arg_max(provider_type, {{'t': ts, 'p': provider_type}}) AS provider_type,
  max(coalesce(ts, ts)) AS ts FROM fields GROUP BY ALL),
catalog AS (SELECT DISTINCT c.tenant_id, c.field, f.provider_type, f.provider_id FROM catalog_ c
  JOIN fields f ON f.tenant_id = c.tenant_id AND f.field = c.field AND f.ts = c.ts)"""


def payloads(spark, folder):
    event = F.to_json(
        F.struct(
            F.col("event_type").alias("kind"),
            F.from_json("props", "k int").alias("props"),
            F.when(F.col("k") % 100 == 1, F.lit('{"not": "an object"}')).alias("rare"),
        )
    )
    return tables.alerts(spark, folder).withColumn("event", event)


@query("a10_field_catalog", f"WITH {PAYLOAD_SQL} SELECT * FROM catalog")
def field_catalog(spark, folder):
    return health.field_catalog(payloads(spark, folder))


@query(
    "a11_fields_per_provider",
    f"""WITH {PAYLOAD_SQL} SELECT tenant_id, provider_type, provider_id,
  array_to_string(list_sort(list(DISTINCT field)), ',') AS fields FROM catalog GROUP BY ALL""",
)
def fields_per_provider(spark, folder):
    out = health.fields_per_provider(health.field_catalog(payloads(spark, folder)))
    return out.withColumn("fields", F.array_join("fields", ","))


PRESETS = {
    "feed": "",
    "severe": "severity in ('high', 'critical') and status = 'firing'",
    "small": "value < 5 or labels['k'] = '1'",
    "missing": "labels['nope'] = 'x'",
}


@query(
    "a13_preset_hits",
    f"""WITH {ALERTS}, hits AS (SELECT tenant_id, unnest(list_filter(['feed',
  CASE WHEN severity IN ('high', 'critical') AND status = 'firing' THEN 'severe' END,
  CASE WHEN value < 5 OR k = 1 THEN 'small' END], lambda x: x IS NOT NULL)) AS preset FROM alerts)
SELECT tenant_id, preset, count(*) AS n FROM hits GROUP BY ALL""",
)
def preset_hits(spark, folder):
    return reads.preset_hits(tables.alerts(spark, folder), PRESETS)


@query(
    "a14_distinct_services",
    f"""WITH {LATEST_LINE}, {LIVE} SELECT DISTINCT tenant_id, 'service' AS kind,
  service AS value FROM latest_line SEMI JOIN live USING (tenant_id, fingerprint)
UNION ALL SELECT DISTINCT tenant_id, 'source', source FROM latest_line
SEMI JOIN live USING (tenant_id, fingerprint)""",
)
def distinct_services(spark, folder):
    parts = [
        reads.distinct_values(live(spark, folder), summary(spark, folder), c).select(
            "tenant_id", F.lit(c).alias("kind"), F.col(c).alias("value")
        )
        for c in ("service", "source")
    ]
    return parts[0].unionByName(parts[1])


@query(
    "j16_topology_coverage",
    f"""WITH {ALERTS}, services AS (SELECT s_suppkey AS service_id,
  concat('t', s_suppkey % 3) AS tenant_id, concat('svc-', s_suppkey % 25) AS service
  FROM supplier)
SELECT service_id, EXISTS (SELECT 1 FROM alerts a WHERE a.tenant_id = s.tenant_id
  AND a.service = s.service) AS covered FROM services s""",
)
def topology_coverage(spark, folder):
    key = F.col("s_suppkey")
    services = tables.read_table(spark, folder, "supplier").select(
        key.alias("service_id"),
        F.concat(F.lit("t"), key % 3).alias("tenant_id"),
        F.concat(F.lit("svc-"), key % 25).alias("service"),
    )
    out = health.topology_coverage(services, tables.alerts(spark, folder))
    return out.select("service_id", "covered")


PATTERNS = {"mail": "[a-z]+@[a-z]+", "digits": "[0-9]{4}", "never": "qqqzzz[0-9]+xx"}


@query(
    "j17_rule_usage",
    " UNION ALL ".join(
        f"""SELECT '{n}' AS rule, count(*) FILTER (regexp_matches(text, '{p}')) AS n,
  bool_or(regexp_matches(text, '{p}')) AS used FROM documents"""
        for n, p in PATTERNS.items()
    ),
)
def rule_usage(spark, folder):
    docs = tables.read_table(spark, folder, "documents")
    return health.rule_usage(docs, PATTERNS, "text")


@query(
    "j17_rule_usage_totals",
    f"""WITH u AS ({" UNION ALL ".join(
        f"SELECT bool_or(regexp_matches(text, '{p}')) AS used FROM documents"
        for p in PATTERNS.values())})
SELECT count(*) AS total, count(*) FILTER (used) AS used, count(*) FILTER (NOT used) AS unused
FROM u""",
)
def rule_usage_totals(spark, folder):
    docs = tables.read_table(spark, folder, "documents")
    return health.rule_usage_totals(health.rule_usage(docs, PATTERNS, "text"))


@query(
    "a12_pipeline_counters",
    """SELECT concat('t', user_id % 3) AS tenant_id, count(*) AS events_in,
  count(*) FILTER (event_id % 19 <> 0) AS events_out,
  count(*) FILTER (event_id % 19 = 0) AS events_error FROM events GROUP BY ALL""",
)
def pipeline_counters(spark, folder):
    events = tables.read_table(spark, folder, "events").select(
        F.concat(F.lit("t"), F.col("user_id") % 3).alias("tenant_id"),
        (F.col("event_id") % 19 == 0).alias("is_error"),
    )
    return health.pipeline_counters(events)

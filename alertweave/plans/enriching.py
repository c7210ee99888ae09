"""Enrichment operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from alertweave.functions import scalars
from alertweave.operators import dedup, enrich, reads, sequence
from alertweave.plans.registry import query
from alertweave.plans.sequences import CLASSES, KEY_WINDOW
from alertweave.plans.sql import ALERTS, ENRICHMENTS, LATEST_LINE, LINE_ALERTS
from alertweave.sources import tables

# operations: every event sets fields of its key, 30 minutes after it came
OPS = f"""{ALERTS},
ops AS (SELECT tenant_id, fingerprint, ts + INTERVAL 30 MINUTE AS ts, alert_id AS seq,
    k % 4 < 2 AS disposable, k % 16 = 5 AS force,
    ['owner', CASE k % 3 WHEN 0 THEN 'status' WHEN 1 THEN 'note' ELSE 'dismissed' END] AS fields,
    [concat('o', k), CASE k % 3 WHEN 0 THEN 'suppressed'
      WHEN 1 THEN CASE k % 7 WHEN 0 THEN ' ' WHEN 1 THEN NULL ELSE concat('n', k) END
      ELSE 'true' END] AS vals
  FROM alerts),
op_fields AS (SELECT tenant_id, fingerprint, ts, seq, disposable, force,
    unnest(fields) AS field, unnest(vals) AS value FROM ops)"""


def ops(spark, folder):
    k = F.col("k")
    second = F.when(k % 3 == 0, "status").when(k % 3 == 1, "note").otherwise("dismissed")
    note = F.when(k % 7 == 0, " ").when(k % 7 != 1, F.concat(F.lit("n"), k))
    value = F.when(k % 3 == 0, "suppressed").when(k % 3 == 1, note).otherwise("true")
    return tables.alerts(spark, folder).select(
        "tenant_id",
        "fingerprint",
        (F.col("ts") + F.expr("interval 30 minutes")).alias("ts"),
        F.col("alert_id").alias("seq"),
        (k % 4 < 2).alias("disposable"),
        (k % 16 == 5).alias("force"),
        F.create_map(F.lit("owner"), F.concat(F.lit("o"), k), second, value).alias("enrichments"),
    )


def field_ops(spark, folder):
    return enrich.explode_ops(ops(spark, folder).drop("force"))


def entries(df, *keys):
    return df.select(*keys, F.explode("enrichments").alias("field", "value"))


@query(
    "e1_fold_enrichments",
    f"""WITH {OPS},
cut AS (SELECT tenant_id, fingerprint, max((ts, seq)) AS cut FROM ops WHERE force GROUP BY ALL),
newest AS (SELECT tenant_id, fingerprint, field, max((ts, seq)) AS at FROM op_fields
  WHERE NOT (field = 'note' AND value IS NOT NULL AND trim(value) = '') GROUP BY ALL)
SELECT n.tenant_id, n.fingerprint, n.field, o.value FROM newest n
JOIN op_fields o ON o.tenant_id = n.tenant_id AND o.fingerprint = n.fingerprint
  AND o.field = n.field AND (o.ts, o.seq) = n.at
LEFT JOIN cut c ON c.tenant_id = n.tenant_id AND c.fingerprint = n.fingerprint
WHERE o.value IS NOT NULL AND (c.cut IS NULL OR n.field = 'note' OR n.at >= c.cut)""",
)
def fold_enrichments(spark, folder):
    keys = ["tenant_id", "fingerprint"]
    return entries(enrich.fold_enrichments(ops(spark, folder).drop("disposable"), keys), *keys)


@query(
    "e2_broadcast_enrichment",
    f"""WITH {ALERTS} SELECT DISTINCT tenant_id, fingerprint, 'ticket-1' AS ticket,
  CAST(NULL AS VARCHAR) AS status FROM alerts WHERE severity = 'critical'""",
)
def broadcast_enrichment(spark, folder):
    keys = tables.alerts(spark, folder).filter("severity = 'critical'").select(
        "tenant_id", "fingerprint"
    )
    out = enrich.broadcast_enrichment(keys, {"ticket_url": "ticket-1", "status": None})
    return out.select(
        "tenant_id",
        "fingerprint",
        F.col("enrichments")["ticket_url"].alias("ticket"),
        F.col("enrichments")["status"].alias("status"),
    )


PLACED = f"""{OPS},
spans AS (SELECT tenant_id, fingerprint, alert_id, ts AS from_ts, lead(ts) {KEY_WINDOW} AS to_ts,
  lead(status) {KEY_WINDOW} AS next_status FROM alerts),
placed AS (SELECT o.*, s.alert_id, s.to_ts, s.next_status FROM op_fields o JOIN spans s
  ON s.tenant_id = o.tenant_id AND s.fingerprint = o.fingerprint AND o.ts >= s.from_ts
  AND (s.to_ts IS NULL OR o.ts < s.to_ts))"""


@query(
    "e3_effective_enrichments",
    f"""WITH {PLACED},
newest AS (SELECT alert_id, field, last(value ORDER BY ts, seq) AS value FROM placed
  WHERE disposable GROUP BY ALL)
SELECT alert_id, field, value FROM newest WHERE value IS NOT NULL""",
)
def effective_enrichments(spark, folder):
    out = enrich.effective_enrichments(tables.alerts(spark, folder), field_ops(spark, folder))
    return out.select("alert_id", "field", "value")


DISPOSED = f"""{PLACED},
written AS (SELECT tenant_id, fingerprint, ts, seq, field, value FROM placed
  UNION ALL SELECT tenant_id, fingerprint, to_ts, -1, field,
    CASE WHEN field = 'dismissed' THEN 'false' END FROM placed
    WHERE disposable AND to_ts IS NOT NULL AND next_status <> 'resolved'
  UNION ALL SELECT tenant_id, fingerprint, max(ts), -1, f, NULL FROM alerts,
    (VALUES ('assignees'), ('status'), ('dismissed'), ('dismissUntil')) v(f)
    WHERE status = 'resolved' GROUP BY tenant_id, fingerprint, f),
ordered AS (SELECT *, row_number() OVER (PARTITION BY tenant_id, fingerprint, field
  ORDER BY ts DESC, seq DESC, value NULLS LAST) AS rn FROM written
  WHERE NOT coalesce(field = 'note' AND trim(value) = '', false))"""


@query(
    "e4_e5_current_enrichments",
    f"""WITH {DISPOSED} SELECT tenant_id, fingerprint, field, value FROM ordered
WHERE rn = 1 AND value IS NOT NULL""",
)
def current_enrichments(spark, folder):
    out = enrich.current_enrichments(tables.alerts(spark, folder), field_ops(spark, folder))
    return entries(out, "tenant_id", "fingerprint")


@query(
    "e4_reset_dismissal",
    f"""WITH {DISPOSED} SELECT tenant_id, fingerprint, value AS dismissed FROM ordered
WHERE rn = 1 AND field = 'dismissed' AND value = 'false'""",
)
def reset_dismissal(spark, folder):
    out = enrich.current_enrichments(tables.alerts(spark, folder), field_ops(spark, folder))
    return out.select(
        "tenant_id", "fingerprint", F.col("enrichments")["dismissed"].alias("dismissed")
    ).filter("dismissed = 'false'")


@query(
    "e5_made_permanent",
    f"""WITH {PLACED}
SELECT alert_id, seq, field, CASE WHEN field IN ('status', 'dismissed') THEN NULL
  ELSE value END AS value FROM placed WHERE disposable AND next_status = 'resolved'""",
)
def made_permanent(spark, folder):
    placed = enrich.place_ops(tables.alerts(spark, folder), field_ops(spark, folder))
    kept = F.when(~F.col("field").isin(*enrich.DISPOSE_KEYS), F.col("value"))
    return placed.filter(
        F.col("disposable") & (F.col("next_status") == "resolved")
    ).select("alert_id", "seq", "field", kept.alias("value"))


@query(
    "e6_overlay",
    f"""WITH {ALERTS} SELECT alert_id,
  CASE WHEN k % 2 = 0 THEN 'over' ELSE CAST(k AS VARCHAR) END AS k_text,
  CAST(user_id AS VARCHAR) AS "user", CASE WHEN k % 2 = 0 THEN 'x' END AS extra FROM alerts""",
)
def overlay(spark, folder):
    enr = F.when(
        F.col("k") % 2 == 0,
        F.create_map(F.lit("k"), F.lit(" over "), F.lit("extra"), F.lit("x")),
    )
    m = enrich.overlay(F.col("labels"), enr)
    return tables.alerts(spark, folder).select(
        "alert_id",
        m["k"].alias("k_text"),
        m["user"].alias("user"),
        F.try_element_at(m, F.lit("extra")).alias("extra"),
    )


@query(
    "e7_enriched_fields",
    f"""WITH {ENRICHMENTS} SELECT tenant_id, fingerprint,
  CASE WHEN e_status IS NULL THEN '' ELSE 'note,status' END AS fields FROM enrichments""",
)
def enriched_fields(spark, folder):
    names = F.array_join(F.array_sort(enrich.enriched_fields(F.col("enrichments"))), ",")
    return tables.enrichments(spark, folder).select(
        "tenant_id", "fingerprint", names.alias("fields")
    )


CHANGE = """changes AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'api-1' END AS api,
  event_id % 7 AS kind FROM events),
described AS (SELECT event_id, CASE
  WHEN kind < 2 AND api IS NULL AND kind = 0 THEN 'alert manually resolved'
  WHEN kind < 2 AND api IS NULL THEN 'alert status manually changed'
  WHEN kind = 0 THEN 'alert automatically resolved by API'
  WHEN kind = 1 THEN 'alert status changed by API'
  WHEN kind = 2 THEN 'alert was assigned with ticket'
  WHEN kind = 3 THEN 'a comment was added to the alert' ELSE 'alert enriched' END AS action,
  CASE WHEN kind = 0 AND api IS NULL THEN 'Alert status was changed to resolved by me@x'
  WHEN kind = 0 THEN 'Alert status was changed to resolved by API `api-1`'
  WHEN kind = 1 AND api IS NULL THEN 'Alert status was changed to firing by me@x - With note: n'
  WHEN kind = 1 THEN 'Alert status was changed to firing by API `api-1` - With note: n'
  WHEN kind = 2 THEN 'Ticket assigned by me@x - url - With note: n'
  WHEN kind = 3 THEN 'Comment added by me@x - n'
  WHEN kind = 4 THEN 'Alert enriched by me@x - {"note":""}'
  ELSE 'Alert enriched by me@x - {"team":"a"}' END AS description FROM changes)"""


@query("e8_classify_change", f"WITH {CHANGE} SELECT * FROM described")
def classify_change(spark, folder):
    def m(*pairs):
        return F.create_map(*[F.lit(x) for x in pairs])

    kind = F.col("event_id") % 7
    enr = (
        F.when(kind == 0, m("status", "resolved"))
        .when(kind == 1, m("status", "firing", "note", "n"))
        .when(kind == 2, m("ticket_url", "url", "note", "n"))
        .when(kind == 3, m("note", "n"))
        .when(kind == 4, m("note", ""))
        .otherwise(m("team", "a"))
    )
    api = F.when(F.col("event_id") % 2 == 0, "api-1")
    action, text = enrich.classify_change(enr, F.lit("me@x"), api)
    events = tables.read_table(spark, folder, "events")
    return events.select("event_id", action.alias("action"), text.alias("description"))


@query(
    "e9_audit_rows",
    f"""WITH {CLASSES} SELECT tenant_id, fingerprint, ts, 'system' AS actor,
  CASE WHEN dedup_type = 'full' THEN 'alert was deduplicated' WHEN status = 'resolved'
    THEN 'alert automatically resolved' ELSE 'alert was triggered' END AS action,
  CASE WHEN dedup_type = 'full' THEN 'Alert was deduplicated'
    ELSE 'Alert status: ' || status END AS description FROM classes""",
)
def audit_rows(spark, folder):
    return enrich.lifecycle_audit(dedup.classify_duplicates(tables.alerts(spark, folder)))


@query(
    "a15_audit_counts",
    f"""WITH {CLASSES} SELECT CASE WHEN dedup_type = 'full' THEN 'alert was deduplicated'
  WHEN status = 'resolved' THEN 'alert automatically resolved' ELSE 'alert was triggered' END
  AS action, count(*) AS n FROM classes GROUP BY ALL""",
)
def audit_counts(spark, folder):
    classes = dedup.classify_duplicates(tables.alerts(spark, folder))
    return enrich.audit_counts(enrich.lifecycle_audit(classes))


@query(
    "e11_render",
    f"""WITH {ALERTS} SELECT alert_id, 'svc ' || service || ' on ' || coalesce(provider_id, '')
  || '!' AS text FROM alerts""",
)
def render(spark, folder):
    text = enrich.render("svc {{ service }} on {{provider_id}}!")
    return tables.alerts(spark, folder).select("alert_id", text.alias("text"))


@query(
    "e12_html_unescape",
    """SELECT doc_id, md5(replace(replace(replace(text, '&lt;', '<'), '&gt;', '>'), '&amp;', '&'))
  AS text_md5 FROM documents""",
)
def html_unescape(spark, folder):
    """Whole texts escaped and decoded again; the SQL states what must come back."""
    escaped = F.col("text")
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        escaped = F.replace(escaped, F.lit(plain), F.lit(entity))
    docs = tables.read_table(spark, folder, "documents").withColumn("text", escaped)
    return docs.select(
        "doc_id", F.md5(scalars.html_unescape(F.col("text"))).alias("text_md5")
    )


@query(
    "e15_enrich_from_results",
    f"""WITH {ALERTS} SELECT alert_id, 'k' AS field, CAST(k AS VARCHAR) AS value,
  false AS disposable FROM alerts WHERE k IS NOT NULL
UNION ALL SELECT alert_id, 'first', event_type, true FROM alerts
UNION ALL SELECT alert_id, 'team', 'ops', false FROM alerts""",
)
def enrich_from_results(spark, folder):
    result = F.concat(
        F.lit('{"deep": '), "props", F.lit(', "list": [{"t": "'), "event_type", F.lit('"}]}')
    )
    alerts = tables.alerts(spark, folder).withColumns(
        {"result": result, "seq": F.col("alert_id")}
    )
    spec = [
        {"key": "k", "value": "results.deep.k"},
        {"key": "first", "value": "results.list[0].t", "disposable": True},
        {"key": "gone", "value": "results.deep.none"},
        {"key": "team", "value": "ops"},
    ]
    out = enrich.enrich_from_results(alerts, "result", spec)
    return out.select(F.col("seq").alias("alert_id"), "field", "value", "disposable")


@query(
    "e16_visible_assignee",
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'raw' WHEN 1 THEN 'iso' END AS assignee
FROM events""",
)
def visible_assignee(spark, folder):
    ts = F.col("ts").cast("timestamp")
    raw = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    kind = F.col("event_id") % 3
    stored = F.when(kind == 0, F.create_map(raw, F.lit("raw"))).when(
        kind == 1, F.create_map(scalars.iso_millis(ts), F.lit("iso"))
    )
    events = tables.read_table(spark, folder, "events")
    return events.select("event_id", enrich.visible_assignee(raw, stored).alias("assignee"))


JOINED = f"""{LINE_ALERTS}, {ENRICHMENTS},
joined AS (SELECT a.*, e.e_status, e.e_note FROM line_alerts a
  LEFT JOIN enrichments e USING (tenant_id, fingerprint)),
effective AS (SELECT * REPLACE (coalesce(e_status, status) AS status) FROM joined)"""


@query(
    "j1_with_enrichment",
    f"""WITH {JOINED} SELECT alert_id, status, trim(e_note) AS note,
  CASE WHEN status = 'resolved' THEN 0 ELSE unresolved_counter END AS unresolved_counter,
  CASE WHEN e_status IS NULL THEN '' ELSE 'note,status' END AS fields FROM effective""",
)
def with_enrichment(spark, folder):
    alerts = tables.line_alerts(spark, folder).withColumn("note", F.lit(None).cast("string"))
    out = enrich.with_enrichment(
        alerts, tables.enrichments(spark, folder), ["status", "note"],
        ["tenant_id", "fingerprint"],
    )
    return out.select(
        "alert_id",
        "status",
        "note",
        "unresolved_counter",
        F.array_join(F.array_sort("enriched_fields"), ",").alias("fields"),
    )


@query(
    "j2_with_instance_enrichment",
    f"""WITH {ALERTS} SELECT alert_id, CASE WHEN alert_id % 9 = 0 THEN 'acknowledged'
  ELSE status END AS status FROM alerts""",
)
def with_instance_enrichment(spark, folder):
    alerts = tables.alerts(spark, folder).withColumn("key", F.col("alert_id").cast("string"))
    value = F.when(F.col("event_id") % 9 == 0, "acknowledged")
    enr = tables.read_table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("key"),
        F.create_map(F.lit("status"), value).alias("enrichments"),
    )
    return enrich.with_enrichment(alerts, enr, ["status"], ["key"]).select("alert_id", "status")


@query(
    "s8_enrich_snapshot",
    f"""WITH {LATEST_LINE}, {ENRICHMENTS} SELECT tenant_id, fingerprint, alert_id,
  coalesce(e_status, status) AS status, trim(e_note) AS note
FROM latest_line LEFT JOIN enrichments USING (tenant_id, fingerprint)""",
)
def enrich_snapshot(spark, folder):
    alerts = tables.line_alerts(spark, folder).withColumns(
        {"content_hash": F.col("status"), "note": F.lit(None).cast("string")}
    )
    snapshot = sequence.latest_alerts(alerts).withColumn("note", F.lit(None).cast("string"))
    out = enrich.with_enrichment(
        snapshot, tables.enrichments(spark, folder), ["status", "note"],
        ["tenant_id", "fingerprint"],
    )
    return out.select("tenant_id", "fingerprint", "alert_id", "status", "note")


@query(
    "s10_group_pulled_alerts",
    f"""WITH {JOINED} SELECT tenant_id, fingerprint, alert_id, status,
  row_number() OVER (PARTITION BY tenant_id, fingerprint ORDER BY ts, alert_id) AS position
FROM effective""",
)
def group_pulled_alerts(spark, folder):
    out = reads.group_pulled_alerts(
        tables.line_alerts(spark, folder), tables.enrichments(spark, folder), ["status"]
    )
    return out.select("tenant_id", "fingerprint", "alert_id", "status", "position")

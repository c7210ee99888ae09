"""Sources, decoding and scalar normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from alertweave.functions import nested, paths, scalars
from alertweave.operators import normalize
from alertweave.plans.registry import query
from alertweave.plans.sql import ALERTS, LATEST_LINE
from alertweave.sources import envelope, tables


def messages(spark, folder):
    """Envelope messages built from ``events``; some are broken on purpose."""
    e = tables.read_table(spark, folder, "events")
    key = F.col("event_id")
    event = F.to_json(F.struct("event_type", "value"))
    body = F.to_json(
        F.struct(
            F.when(key % 17 != 0, F.concat(F.lit("t"), F.col("user_id") % 3)).alias("tenant_id"),
            event.alias("event"),
            F.concat(F.lit("trace-"), key).alias("trace_id"),
            F.when(key % 10 == 0, F.lit("incident")).alias("event_type"),
            F.when(key % 7 == 0, F.lit(False)).alias("notify_client"),
            F.when(key % 13 == 0, F.lit("incident"))
            .otherwise(F.lit("grafana"))
            .alias("provider_type"),
        )
    )
    return e.select(key, F.when(key % 19 == 0, "not valid json").otherwise(body).alias("value"))


@query("s9_read_tables", "SELECT event_id, user_id, event_type, value FROM events")
def read_tables(spark, folder):
    events = tables.read_tables(spark, folder, "events")["events"]
    return events.select("event_id", "user_id", "event_type", "value")


@query(
    "s2_decode_envelope",
    """SELECT event_id, concat('t', user_id % 3) AS tenant_id,
  concat('trace-', event_id) AS trace_id, event_id % 7 <> 0 AS notify_client,
  CASE WHEN event_id % 10 = 0 THEN 'incident' ELSE 'alert' END AS event_type,
  event_type AS inner_type
FROM events WHERE event_id % 17 <> 0 AND event_id % 19 <> 0""",
)
def decode_envelope(spark, folder):
    good, _ = envelope.decode_envelope(messages(spark, folder))
    inner = paths.json_text(F.col("event"), "event_type").alias("inner_type")
    return good.select(
        "event_id", "tenant_id", "trace_id", "notify_client", "event_type", inner
    )


@query(
    "s2_undecodable_messages",
    """SELECT event_id, CASE WHEN event_id % 19 = 0 THEN 'not valid JSON'
  ELSE 'tenant_id or event missing' END AS error
FROM events WHERE event_id % 17 = 0 OR event_id % 19 = 0""",
)
def undecodable_messages(spark, folder):
    _, bad = envelope.decode_envelope(messages(spark, folder))
    return bad.select("event_id", "error")


@query(
    "s3_route_events",
    """SELECT event_id, CASE WHEN event_id % 10 = 0 OR event_id % 13 = 0 THEN 'incident'
  ELSE 'alert' END AS route FROM events WHERE event_id % 17 <> 0 AND event_id % 19 <> 0""",
)
def route_events(spark, folder):
    good, _ = envelope.decode_envelope(messages(spark, folder))
    alerts, incidents = envelope.route_events(good)
    return alerts.select("event_id", F.lit("alert").alias("route")).unionByName(
        incidents.select("event_id", F.lit("incident").alias("route"))
    )


DIRTY_TEXT = """dirty AS (SELECT *, CASE event_id % 6
  WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+02:00'
  WHEN 1 THEN CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR)
  WHEN 2 THEN CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) || '.5Z'
  WHEN 3 THEN '' WHEN 4 THEN 'yesterday'
  ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' END AS received FROM events),
read AS (SELECT *, CASE event_id % 6
  WHEN 0 THEN date_trunc('millisecond', ts) - INTERVAL 2 HOUR
  WHEN 1 THEN date_trunc('second', ts)
  WHEN 2 THEN date_trunc('second', ts) + INTERVAL 500 MILLISECOND
  WHEN 5 THEN date_trunc('second', ts) END AS last_received FROM dirty)"""


def dirty_times(spark, folder):
    ts = F.col("ts").cast("timestamp")
    kind = F.col("event_id") % 6
    seconds = F.unix_seconds(ts).cast("string")
    text = (
        F.when(
            kind == 0,
            F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+02:00")),
        )
        .when(kind == 1, seconds)
        .when(kind == 2, F.concat(seconds, F.lit(".5Z")))
        .when(kind == 3, F.lit(""))
        .when(kind == 4, F.lit("yesterday"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    )
    return tables.read_table(spark, folder, "events").withColumn("received", text)


@query("n3_parse_last_received", f"WITH {DIRTY_TEXT} SELECT event_id, last_received FROM read")
def parse_last_received(spark, folder):
    return dirty_times(spark, folder).select(
        "event_id", scalars.parse_last_received(F.col("received")).alias("last_received")
    )


@query(
    "s4_dead_letters",
    f"""WITH {DIRTY_TEXT} SELECT event_id, true AS is_error,
  'invalid date format: ' || received AS error_message FROM read WHERE last_received IS NULL""",
)
def dead_letters(spark, folder):
    df = dirty_times(spark, folder)
    valid = scalars.parse_last_received(F.col("received")).isNotNull()
    error = F.concat(F.lit("invalid date format: "), F.col("received"))
    _, bad = envelope.dead_letters(df, valid, error)
    return bad.select("event_id", "is_error", "error_message")


@query(
    "n4_iso_millis",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.') || strftime(ts, '%g') || 'Z' AS iso
FROM events""",
)
def iso_millis(spark, folder):
    events = tables.read_table(spark, folder, "events")
    return events.select("event_id", scalars.iso_millis(F.col("ts")).alias("iso"))


@query(
    "n1_normalize_alerts",
    """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN sha256(props) ELSE
    CAST(event_id AS VARCHAR) END AS id,
  CASE WHEN user_id % 7 = 0 THEN 'critical' WHEN user_id % 7 = 1 THEN 'low'
    ELSE 'info' END AS severity,
  CASE WHEN event_type = 'purchase' THEN 'resolved' ELSE 'firing' END AS status
FROM events""",
)
def normalize_alerts(spark, folder):
    user = F.col("user_id")
    dirty = tables.read_table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_id") % 5 != 0, F.col("event_id").cast("string")).alias("id"),
        F.when(user % 7 == 0, "critical")
        .when(user % 7 == 1, "low")
        .when(user % 7 == 2, "fatal")
        .alias("severity"),
        F.when(F.col("event_type") == "purchase", "resolved")
        .when(F.col("event_type") == "click", "unheard")
        .alias("status"),
        "props",
    )
    return normalize.normalize_alerts(dirty, payload=F.col("props")).drop("props")


@query(
    "n1_normalize_numeric_severity",
    """SELECT p_partkey, CASE p_size % 8 WHEN 1 THEN 'low' WHEN 2 THEN 'info' WHEN 3 THEN
  'warning' WHEN 4 THEN 'high' WHEN 5 THEN 'critical' ELSE 'info' END AS severity FROM part""",
)
def normalize_numeric_severity(spark, folder):
    parts = tables.read_table(spark, folder, "part").select(
        "p_partkey",
        F.col("p_partkey").cast("string").alias("id"),
        (F.col("p_size") % 8).alias("severity"),
        F.lit("firing").alias("status"),
    )
    return normalize.normalize_alerts(parts).select("p_partkey", "severity")


@query(
    "n2_severity_rank_label",
    f"""WITH {ALERTS} SELECT alert_id, CASE severity WHEN 'low' THEN 1 WHEN 'info' THEN 2
  WHEN 'warning' THEN 3 WHEN 'high' THEN 4 ELSE 5 END AS rank, severity AS label FROM alerts""",
)
def severity_rank_label(spark, folder):
    rank = scalars.severity_rank(F.col("severity"))
    return tables.alerts(spark, folder).select(
        "alert_id", rank.alias("rank"), scalars.severity_label(rank).alias("label")
    )


@query(
    "n5_normalize_url",
    """WITH urls AS (SELECT page_id, trim(CASE page_id % 4 WHEN 0 THEN ' ' || url || ' a b%é '
    WHEN 1 THEN substr(url, strpos(url, '//') + 2) WHEN 2 THEN '  ' ELSE url END) AS u FROM pages),
schemed AS (SELECT page_id, u, CASE WHEN starts_with(u, 'http') THEN u
  ELSE 'https://' || u END AS s FROM urls)
SELECT page_id, CASE WHEN u <> '' THEN replace(replace(replace(replace(replace(url_encode(s),
  '%2F', '/'), '%3A', ':'), '%3F', '?'), '%3D', '='), '%26', '&') END AS url FROM schemed""",
)
def normalize_url(spark, folder):
    kind, url = F.col("page_id") % 4, F.col("url")
    dirty = (
        F.when(kind == 0, F.concat(F.lit(" "), url, F.lit(" a b%é ")))
        .when(kind == 1, F.substring_index(url, "//", -1))
        .when(kind == 2, F.lit("  "))
        .otherwise(url)
    )
    pages = tables.read_table(spark, folder, "pages")
    return pages.select("page_id", scalars.normalize_url(dirty).alias("url"))


@query(
    "n6_effective_dismissed",
    """SELECT event_id, CASE WHEN event_id % 4 = 3 THEN false WHEN event_id % 5 = 0 THEN true
  WHEN event_id % 5 = 1 THEN true WHEN event_id % 5 = 2 THEN ts < TIMESTAMP '2024-01-15'
  ELSE ts < TIMESTAMP '2024-01-20' END AS dismissed FROM events""",
)
def effective_dismissed(spark, folder):
    kind = F.col("event_id") % 5
    until = (
        F.when(kind == 0, "forever")
        .when(kind == 2, "2024-01-15T00:00:00.000Z")
        .when(kind > 2, "2024-01-20T00:00:00.000Z")
    )
    flag = F.when(F.col("event_id") % 4 == 3, "no").otherwise("True")
    events = tables.read_table(spark, folder, "events")
    dismissed = scalars.effective_dismissed(flag, until, F.col("ts").cast("timestamp"))
    return events.select("event_id", dismissed.alias("dismissed"))


@query(
    "n7_effective_deleted",
    "SELECT event_id, event_id % 3 = 0 AS deleted FROM events",
)
def effective_deleted(spark, folder):
    iso = scalars.iso_millis(F.col("ts"))
    marked = F.when(F.col("event_id") % 3 == 0, F.array(F.lit("other"), iso)).when(
        F.col("event_id") % 3 == 1, F.array(F.lit("other"))
    )
    events = tables.read_table(spark, folder, "events")
    return events.select("event_id", scalars.effective_deleted(iso, marked).alias("deleted"))


@query(
    "n8_default_fingerprint",
    """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN CASE WHEN length(text) > 255 THEN sha256(text) ELSE text END
  WHEN doc_id % 3 = 1 THEN sha256(source) ELSE sha256(text) END AS fingerprint FROM documents""",
)
def default_fingerprint(spark, folder):
    key = F.col("doc_id") % 3
    given = F.when(key == 0, F.col("text"))
    name = F.when(key == 1, F.col("source")).otherwise(F.lit(""))
    docs = tables.read_table(spark, folder, "documents")
    fingerprint = scalars.default_fingerprint(given, name, F.col("text"))
    return docs.select("doc_id", fingerprint.alias("fingerprint"))


@query(
    "n9_fingerprint_by",
    f"""WITH {ALERTS} SELECT alert_id,
  sha256(concat(name, coalesce(provider_id, ''), k)) AS fingerprint, name AS no_fields
FROM alerts""",
)
def fingerprint_by(spark, folder):
    fields = [F.col("name"), F.col("provider_id"), F.col("labels")["k"]]
    return tables.alerts(spark, folder).select(
        "alert_id",
        scalars.fingerprint_by(fields, F.col("name")).alias("fingerprint"),
        scalars.fingerprint_by([], F.col("name")).alias("no_fields"),
    )


@query(
    "n11_strip_nul",
    """SELECT doc_id, md5(text) AS text_md5, md5('v' || source) AS map_md5 FROM documents""",
)
def strip_nul(spark, folder):
    nul = F.lit("\x00")
    dirty = F.concat(nul, F.col("text"), nul)
    labels = F.create_map(F.lit("k"), F.concat(F.lit("v"), nul, F.col("source")))
    docs = tables.read_table(spark, folder, "documents")
    return docs.select(
        "doc_id",
        F.md5(scalars.strip_nul(dirty)).alias("text_md5"),
        F.md5(scalars.strip_nul_map(labels)["k"]).alias("map_md5"),
    )


@query(
    "n12_drop_unsafe_keys",
    """SELECT event_id, CASE WHEN event_id % 4 < 3 THEN 1 ELSE 2 END AS n_keys,
  CAST(event_id AS VARCHAR) AS safe FROM events""",
)
def drop_unsafe_keys(spark, folder):
    kind = F.col("event_id") % 4
    second = (
        F.when(kind == 0, "@a").when(kind == 1, " b").when(kind == 2, "\\c").otherwise("d@")
    )
    value = F.col("event_id").cast("string")
    kept = scalars.drop_unsafe_keys(F.create_map(F.lit("safe"), value, second, value))
    events = tables.read_table(spark, folder, "events")
    return events.select(
        "event_id", F.size(kept).alias("n_keys"), kept["safe"].alias("safe")
    )


@query(
    "n11_strip_nul_nested",
    """SELECT doc_id, md5(text) AS text_md5, 'v' || source AS listed,
  CASE WHEN doc_id % 3 = 0 THEN NULL ELSE lang END AS mapped FROM documents""",
)
def strip_nul_nested(spark, folder):
    """Texts three levels down: an object, its list, the objects of the list."""
    nul = F.lit("\x00")
    mapped = F.when(F.col("doc_id") % 3 != 0, F.concat("lang", nul))
    inner = F.create_map(F.lit("s"), F.concat(F.lit("v"), nul, "source"), F.lit("l"), mapped)
    value = F.struct(F.concat(nul, "text").alias("text"), F.array(inner).alias("parts"))
    docs = tables.read_table(spark, folder, "documents").withColumn("value", value)
    clean = nested.strip_nul_deep(F.col("value"), docs.schema["value"].dataType)
    return docs.select("doc_id", clean.alias("c")).select(
        "doc_id",
        F.md5("c.text").alias("text_md5"),
        F.col("c.parts")[0]["s"].alias("listed"),
        F.col("c.parts")[0]["l"].alias("mapped"),
    )


@query(
    "n12_drop_unsafe_keys_nested",
    """SELECT event_id, 'safe,parts' AS fields, CASE WHEN event_id % 4 < 3 THEN 1 ELSE 2 END
    AS n_keys, CAST(event_id AS VARCHAR) AS safe, 'name' AS inner_fields FROM events""",
)
def drop_unsafe_keys_nested(spark, folder):
    """Names three levels down: an object, its list, the objects and maps of the list."""
    kind = F.col("event_id") % 4
    second = F.when(kind == 0, "@a").when(kind == 1, " b").when(kind == 2, "\\c").otherwise("d@")
    text = F.col("event_id").cast("string")
    inner = F.struct(text.alias("name"), text.alias("$ref"))
    part = F.struct(
        F.create_map(F.lit("safe"), text, second, text).alias("labels"), inner.alias("inner")
    )
    value = F.struct(text.alias("safe"), text.alias("@id"), F.array(part).alias("parts"))
    events = tables.read_table(spark, folder, "events").withColumn("value", value)
    clean = nested.drop_unsafe_keys_deep(F.col("value"), events.schema["value"].dataType)
    kept = events.select("event_id", clean.alias("c"))
    fields = kept.schema["c"].dataType
    inside = fields["parts"].dataType.elementType["inner"].dataType
    first = F.col("c.parts")[0]
    return kept.select(
        "event_id",
        F.lit(",".join(fields.names)).alias("fields"),
        F.size(first["labels"]).alias("n_keys"),
        first["labels"]["safe"].alias("safe"),
        F.lit(",".join(inside.names)).alias("inner_fields"),
    )


@query(
    "n13_paths",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS plain,
  event_type AS bracketed, CAST(user_id AS VARCHAR) AS escaped, 'src0' AS source FROM events""",
)
def dotted_paths(spark, folder):
    doc = F.to_json(
        F.struct(
            F.struct(F.col("event_type").alias("b.c")).alias("a"),
            F.struct(F.col("user_id").alias("x.y")).alias("r"),
        )
    )
    sources = F.array(F.lit("src0"), F.lit("src1"))
    events = tables.read_table(spark, folder, "events").withColumn("doc", doc)
    return events.select(
        "event_id",
        paths.json_text(F.col("props"), "k").alias("plain"),
        paths.json_text(F.col("doc"), "a.[b.c]").alias("bracketed"),
        paths.json_text(F.col("doc"), "r.x@@y").alias("escaped"),
        paths.first_source(sources).alias("source"),
    )


@query(
    "n14_prepare_alerts",
    f"""WITH {ALERTS} SELECT alert_id, CASE WHEN alert_id % 2 = 0 THEN 'unknown' ELSE 's' END
    AS source, CASE WHEN alert_id % 3 = 0 THEN CAST(alert_id AS VARCHAR) ELSE name END AS name,
  'fixed' AS fingerprint, 'key-1' AS api_key_ref FROM alerts""",
)
def prepare_alerts(spark, folder):
    key = F.col("alert_id")
    alerts = tables.alerts(spark, folder).withColumns(
        {
            "id": key.cast("string"),
            "source": F.when(key % 4 == 0, F.array().cast("array<string>")).when(
                key % 2 == 1, F.array(F.lit("s"))
            ),
            "name": F.when(key % 3 != 0, F.col("name")),
        }
    )
    out = normalize.prepare_alerts(alerts, fingerprint="fixed", api_key="key-1")
    return out.select(
        "alert_id", F.col("source")[0].alias("source"), "name", "fingerprint", "api_key_ref"
    )


@query(
    "n15_queue_defaults",
    f"""WITH {ALERTS} SELECT alert_id,
  CASE WHEN k % 2 = 0 THEN name ELSE 'alert-from-event-queue' END AS name,
  'alert-from-event-queue' AS environment, service,
  CASE WHEN k % 3 = 0 THEN severity ELSE 'info' END AS severity,
  CASE WHEN k % 3 = 0 THEN status ELSE 'firing' END AS status, 'queue' AS source,
  'q-1' AS provider_id, false AS pushed FROM alerts""",
)
def queue_defaults(spark, folder):
    k = F.col("k")
    text = F.lit(None).cast("string")
    alerts = tables.alerts(spark, folder).withColumns(
        {
            "name": F.when(k % 2 == 0, F.col("name")),
            "severity": F.when(k % 3 == 0, F.col("severity")),
            "status": F.when(k % 3 == 0, F.col("status")),
            "environment": text,
            "message": text,
            "description": text,
            "source": F.lit(None).cast("array<string>"),
            "pushed": F.lit(None).cast("boolean"),
        }
    )
    out = normalize.queue_defaults(alerts, "queue", "q-1")
    return out.select(
        "alert_id",
        "name",
        "environment",
        "service",
        "severity",
        "status",
        F.col("source")[0].alias("source"),
        "provider_id",
        "pushed",
    )


@query(
    "n16_format_by_provider",
    f"""WITH {ALERTS}
SELECT alert_id, 0 AS part, upper(name) AS name FROM alerts WHERE provider_type = 'grafana'
UNION ALL SELECT alert_id, p, concat(name, '-', p) FROM alerts,
  (VALUES (1), (2)) AS v(p) WHERE provider_type = 'sentry' AND k % 2 = 0
UNION ALL SELECT alert_id, 0, name FROM alerts WHERE provider_type IN ('prometheus', 'datadog')""",
)
def format_by_provider(spark, folder):
    def upper(df):
        return df.withColumn("name", F.upper("name"))

    def exploded(df):
        parts = F.when(F.col("k") % 2 == 0, F.array(F.lit(1), F.lit(2)))
        out = df.drop("part").withColumn("part", F.explode(parts))
        return out.withColumn("name", F.concat_ws("-", "name", "part"))

    alerts = tables.alerts(spark, folder).select(
        "alert_id", "provider_type", "name", "k", F.lit(0).alias("part")
    )
    out = normalize.format_by_provider(alerts, {"grafana": upper, "sentry": exploded})
    return out.select("alert_id", "part", "name")


@query(
    "udf2_parse_bodies",
    f"""WITH {ALERTS} SELECT alert_id, CASE provider_type WHEN 'grafana' THEN
  json_extract_string(props, '$.k') ELSE props END AS body FROM alerts""",
)
def parse_bodies(spark, folder):
    alerts = tables.alerts(spark, folder).withColumn("body", F.col("props"))
    parsers = {"grafana": lambda c: paths.json_text(c, "k")}
    return normalize.parse_bodies(alerts, parsers).select("alert_id", "body")


@query(
    "n17_project_fields",
    f"WITH {ALERTS} SELECT severity AS level, alert_id, service FROM alerts",
)
def project_fields(spark, folder):
    return normalize.project_fields(
        tables.alerts(spark, folder),
        visible=["alert_id", "severity", "service"],
        order=["severity", "hidden"],
        rename={"severity": "level"},
    )


@query(
    "n18_remap_fields",
    f"WITH {ALERTS} SELECT alert_id, name AS shown FROM alerts",
)
def remap_fields(spark, folder):
    fields = paths.FieldMap({"title": [paths.Plain("old_name")]}).remap({"old_name": "name"})
    return tables.alerts(spark, folder).select(
        "alert_id", fields.resolve("title").alias("shown")
    )


@query(
    "n19_validate_description_format",
    """SELECT doc_id, CASE lang WHEN 'en' THEN 'markdown' WHEN 'de' THEN 'html'
  WHEN 'fr' THEN NULL ELSE lang END AS format FROM documents
WHERE lang IN ('en', 'de', 'fr')""",
)
def validate_description_format(spark, folder):
    lang = F.col("lang")
    given = F.when(lang == "en", "markdown").when(lang == "de", "html").when(
        lang != "fr", lang
    )
    docs = tables.read_table(spark, folder, "documents").select("doc_id", given.alias("format"))
    valid = scalars.valid_description_format(F.col("format"))
    good, _ = envelope.dead_letters(docs, valid, F.lit("description format"))
    return good


@query(
    "n20_event_timestamp",
    f"""WITH {ALERTS} SELECT alert_id, CASE WHEN alert_id % 10 = 0 THEN TIMESTAMP '2023-12-31'
  ELSE date_trunc('millisecond', ts) END AS timestamp,
  CASE WHEN alert_id % 4 = 0 THEN concat('src-', k) ELSE provider_type END AS provider_type
FROM alerts""",
)
def event_timestamp(spark, folder):
    key = F.col("alert_id")
    alerts = tables.alerts(spark, folder).withColumns(
        {
            "timestamp_forced": F.when(key % 10 == 0, F.lit("2023-12-31").cast("timestamp")),
            "received": F.col("ts"),
            "provider_type": F.when(key % 4 != 0, F.col("provider_type")),
            "source": F.array(F.concat(F.lit("src-"), "k")),
        }
    )
    return normalize.event_timestamp(alerts).select("alert_id", "timestamp", "provider_type")


@query(
    "s6_latest_wins_snapshot",
    f"""WITH {LATEST_LINE} SELECT tenant_id, fingerprint, alert_id, ts, status FROM latest_line""",
)
def latest_wins_snapshot(spark, folder):
    rows = tables.line_alerts(spark, folder).select(
        "tenant_id", "fingerprint", "alert_id", "ts", "status"
    )
    late = F.col("ts") < F.lit("1996-01-01").cast("timestamp")
    return envelope.latest_wins(
        rows.filter(~late), rows.filter(late), ["tenant_id", "fingerprint"], ["ts", "alert_id"]
    )


@query(
    "s7_search_snapshot",
    f"""WITH {LATEST_LINE} SELECT tenant_id, fingerprint, alert_id, severity_rank FROM latest_line
WHERE severity_rank >= 4 AND status = 'firing'""",
)
def search_snapshot(spark, folder):
    rows = tables.line_alerts(spark, folder).select(
        "tenant_id", "fingerprint", "alert_id", "ts", "status", "severity_rank"
    )
    snapshot = envelope.latest_wins(
        None, rows, ["tenant_id", "fingerprint"], ["ts", "alert_id"]
    )
    found = envelope.search_snapshot(
        snapshot, (F.col("severity_rank") >= 4) & (F.col("status") == "firing")
    )
    return found.select("tenant_id", "fingerprint", "alert_id", "severity_rank")


@query(
    "s11_flatten_rule_config",
    """SELECT s_suppkey, concat('prov-', s_suppkey) AS provider_name, s_name AS provider_type,
  r AS rule_name, CASE r WHEN 'r1' THEN 'name,' || s_nationkey ELSE '' END AS fields,
  r = 'r1' AS full_deduplication
FROM supplier, (VALUES ('r1'), ('r2')) AS v(r)""",
)
def flatten_rule_config(spark, folder):
    rule1 = F.concat(
        F.lit('{"r1": {"fingerprint_fields": ["name", "'),
        F.col("s_nationkey"),
        F.lit('"], "full_deduplication": true}, "r2": {}}'),
    )
    config = F.concat(
        F.lit('{"prov-'),
        F.col("s_suppkey"),
        F.lit('": {"type": "'),
        F.col("s_name"),
        F.lit('", "deduplication_rules": '),
        rule1,
        F.lit("}}"),
    )
    suppliers = tables.read_table(spark, folder, "supplier")
    flat = envelope.flatten_rule_config(suppliers.select("s_suppkey", config.alias("config")))
    return flat.select(
        "s_suppkey",
        "provider_name",
        "provider_type",
        "rule_name",
        F.array_join("fingerprint_fields", ",").alias("fields"),
        "full_deduplication",
    )

"""The adapters of ``sources.tables`` as SQL, for the checking queries."""

ALERTS = """
alerts AS (
  SELECT event_id AS alert_id,
    concat('t', user_id % 3) AS tenant_id,
    sha256(concat('user-', user_id)) AS fingerprint,
    concat('alert-', user_id % 20) AS name,
    concat('svc-', user_id % 20) AS service,
    CASE user_id % 4 WHEN 0 THEN 'prometheus' WHEN 1 THEN 'grafana'
      WHEN 2 THEN 'datadog' ELSE 'sentry' END AS provider_type,
    CASE WHEN user_id % 7 = 0 THEN NULL ELSE concat('p-', user_id % 4) END AS provider_id,
    CASE event_type WHEN 'purchase' THEN 'resolved' WHEN 'signup' THEN 'acknowledged'
      ELSE 'firing' END AS status,
    CASE WHEN value < 5 THEN 'low' WHEN value < 15 THEN 'info' WHEN value < 40
      THEN 'warning' WHEN value < 100 THEN 'high' ELSE 'critical' END AS severity,
    ts, CAST(json_extract_string(props, '$.k') AS INT) AS k,
    user_id, event_type, value, props,
    sha256(concat_ws('|', concat('alert-', user_id % 20),
      CASE WHEN value < 5 THEN 'low' WHEN value < 15 THEN 'info' WHEN value < 40
        THEN 'warning' WHEN value < 100 THEN 'high' ELSE 'critical' END,
      CASE event_type WHEN 'purchase' THEN 'resolved' WHEN 'signup' THEN 'acknowledged'
        ELSE 'firing' END)) AS content_hash
  FROM events)"""

RANKED = f"""{ALERTS},
ranked AS (
  SELECT *, CASE severity WHEN 'low' THEN 1 WHEN 'info' THEN 2 WHEN 'warning' THEN 3
    WHEN 'high' THEN 4 ELSE 5 END AS severity_rank
  FROM alerts)"""

LINE_ALERTS = """
line_alerts AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CAST(l_quantity AS BIGINT), strftime(l_shipdate, '%Y%m%d')) AS alert_id,
    concat('t', l_orderkey % 3) AS tenant_id,
    concat('part-', l_partkey) AS fingerprint,
    CASE WHEN l_linestatus = 'F' THEN 'resolved' WHEN l_returnflag = 'A'
      THEN 'acknowledged' ELSE 'firing' END AS status,
    CAST(least(5, floor(l_quantity / 10) + 1) AS INT) AS severity_rank,
    concat('svc-', l_suppkey % 25) AS service,
    concat('src-', l_linenumber % 4) AS source,
    l_shipdate AS ts, CAST(l_quantity AS BIGINT) % 7 AS unresolved_counter
  FROM lineitem)"""

LINKS = """
links AS (
  SELECT l_orderkey AS incident_id, concat('t', l_orderkey % 3) AS tenant_id,
    concat('part-', l_partkey) AS fingerprint, l_shipdate AS linked_at,
    CASE WHEN l_returnflag = 'R' THEN l_shipdate END AS deleted_at
  FROM lineitem)"""

INCIDENTS = """
incidents AS (
  SELECT o_orderkey AS incident_id, concat('t', o_orderkey % 3) AS tenant_id,
    CASE WHEN o_orderkey % 5 <> 0 THEN concat('inc-', o_orderpriority) END
      AS user_generated_name,
    concat('ai-', o_orderpriority) AS ai_generated_name,
    CASE o_orderstatus WHEN 'F' THEN 'resolved' WHEN 'P' THEN 'acknowledged'
      ELSE 'firing' END AS status,
    CAST(substr(o_orderpriority, 1, 1) AS INT) AS severity,
    o_orderdate AS creation_time,
    CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate END AS start_time,
    o_orderdate + to_days(CAST(o_orderkey % 30 AS INT)) AS last_seen_time,
    o_orderkey % 4 = 0 AS is_predicted, o_orderkey % 10 = 0 AS is_candidate,
    o_orderkey % 13 <> 0 AS is_visible, o_orderkey % 3 = 0 AS forced_severity,
    o_orderkey % 6 AS rule_id,
    CASE WHEN o_orderkey % 8 = 0 THEN o_orderkey - 8 END AS same_incident_in_the_past_id,
    concat('user-', o_custkey % 10) AS assignee,
    CASE o_orderkey % 4 WHEN 0 THEN 'all_resolved' WHEN 1 THEN 'first_resolved'
      WHEN 2 THEN 'last_resolved' ELSE 'never' END AS resolve_on,
    [concat('svc-', o_custkey % 25), 'svc-0'] AS affected_services,
    [concat('src-', o_orderkey % 4)] AS sources
  FROM orders)"""

ENRICHMENTS = """
enrichments AS (
  SELECT concat('t', p_partkey % 3) AS tenant_id, concat('part-', p_partkey) AS fingerprint,
    CASE WHEN p_partkey % 5 <> 0 THEN NULL WHEN p_partkey % 2 = 0 THEN 'resolved'
      ELSE 'acknowledged' END AS e_status,
    CASE WHEN p_partkey % 5 = 0 THEN concat(' ', p_brand, ' ') END AS e_note
  FROM part)"""

# newest line alert per key
LATEST_LINE = f"""{LINE_ALERTS},
latest_line AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY tenant_id, fingerprint
      ORDER BY ts DESC, alert_id DESC) AS rn FROM line_alerts) WHERE rn = 1)"""

LIVE = f"""{LINKS},
live AS (SELECT DISTINCT incident_id, tenant_id, fingerprint FROM links
  WHERE deleted_at IS NULL)"""

"""Extraction, lookup, topology and maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from alertweave.operators import maintenance, mapping
from alertweave.operators.maintenance import MaintenanceWindow
from alertweave.operators.mapping import ExtractionRule, MappingRule
from alertweave.plans import fixtures
from alertweave.plans.registry import query
from alertweave.plans.sql import ALERTS
from alertweave.sources import tables

EXTRACTIONS = [
    ExtractionRule(1, "name", r"alert-(?P<number>\d)(?P<rest>\d)?", priority=5),
    ExtractionRule(2, "{{ service }}/{{ number }}", r"svc-\d+/(?P<again>1)$", priority=3),
    ExtractionRule(3, "severity", r"(?P<number>[ch]\w+)", priority=1, condition="k > 50"),
    ExtractionRule(4, "name", r"(?P<source>alert)-(?P<never>\d)", condition="*", disabled=True),
    ExtractionRule(5, "provider_id", r"(?P<source>p)-(?P<digit>\d)", priority=2, condition="*"),
]

EXTRACTED = f"""{ALERTS},
x1 AS (SELECT *, regexp_extract(name, 'alert-(\\d)(\\d)?', 1) AS n1,
  nullif(regexp_extract(name, 'alert-(\\d)(\\d)?', 2), '') AS rest FROM alerts),
x2 AS (SELECT *, CASE WHEN n1 = '1' THEN '1' END AS again,
  CASE WHEN k > 50 AND severity IN ('critical', 'high') THEN severity ELSE n1 END AS number,
  nullif(regexp_extract(provider_id, 'p-(\\d)', 1), '') AS digit FROM x1)"""


def extracted(spark, folder):
    return mapping.extract(tables.alerts(spark, folder), EXTRACTIONS)


@query(
    "e10_extract",
    f"WITH {EXTRACTED} SELECT alert_id, number, rest, again, digit FROM x2",
)
def extract(spark, folder):
    return extracted(spark, folder).select("alert_id", "number", "rest", "again", "digit")


@query(
    "e10_extract_from_texts",
    r"""SELECT doc_id, nullif(regexp_extract(text, '([A-Za-z0-9]+)@([A-Za-z0-9.]+)', 1), '')
  AS mailbox, nullif(regexp_extract(text, '([A-Za-z0-9]+)@([A-Za-z0-9.]+)', 2), '') AS host
FROM documents""",
)
def extract_from_texts(spark, folder):
    """Whole texts, entities decoded first."""
    escaped = F.replace(F.col("text"), F.lit("&"), F.lit("&amp;"))
    docs = tables.read_table(spark, folder, "documents").withColumn("text", escaped)
    rule = ExtractionRule(1, "text", r"(?P<mailbox>[A-Za-z0-9]+)@(?P<host>[A-Za-z0-9.]+)")
    return mapping.extract(docs, [rule]).select("doc_id", "mailbox", "host")


@query(
    "e14_extraction_outcomes",
    f"""WITH {EXTRACTED} SELECT alert_id, 1 AS rule_id, 'success' AS status, n1 AS number FROM x2
UNION ALL SELECT alert_id, 2, CASE WHEN again IS NULL THEN 'skipped' ELSE 'success' END, NULL
  FROM x2
UNION ALL SELECT alert_id, 3, CASE WHEN k > 50 AND severity IN ('critical', 'high')
  THEN 'success' ELSE 'skipped' END, CASE WHEN k > 50 AND severity IN ('critical', 'high')
  THEN severity END FROM x2
UNION ALL SELECT alert_id, 5, CASE WHEN digit IS NULL THEN 'skipped' ELSE 'success' END, NULL
  FROM x2""",
)
def extraction_outcomes(spark, folder):
    out = mapping.enrichment_outcomes(extracted(spark, folder), "alert_id")
    number = F.try_element_at("fields", F.lit("number"))
    return out.select("alert_id", "rule_id", "status", number.alias("number"))


LOOKUP_RULE = MappingRule(
    10,
    matchers=[["service", "provider_type"], ["name"]],
    fields=["name", "owner", "tier"],
    lookup="owners",
    priority=5,
)

LOOKED_UP = f"""{ALERTS},
cells(row_idx, c_service, c_provider, c_name, owner, tier)
  AS (VALUES {fixtures.LOOKUP_SQL}),
hits AS (SELECT a.alert_id, min(c.row_idx) AS row_idx FROM alerts a JOIN cells c ON
  ((c_service = '*' OR (c_service <> '*' AND regexp_matches(a.service, c_service))) AND
   (c_provider = '*' OR (c_provider <> '*' AND regexp_matches(a.provider_type, c_provider))))
  OR regexp_matches(a.name, c_name) GROUP BY a.alert_id),
looked AS (SELECT a.*, trim(c.owner) AS owner, c.tier, h.row_idx FROM alerts a
  LEFT JOIN hits h USING (alert_id) LEFT JOIN cells c USING (row_idx))"""


@query("j11_map_lookup", f"WITH {LOOKED_UP} SELECT alert_id, name, owner, tier FROM looked")
def map_lookup(spark, folder):
    out = mapping.map_lookup(
        tables.alerts(spark, folder), LOOKUP_RULE, fixtures.lookup_rows(spark)
    )
    return out.select("alert_id", "name", "owner", "tier")


@query(
    "j11_map_lookup_in_blocks",
    f"WITH {LOOKED_UP} SELECT alert_id, owner, tier FROM looked",
)
def map_lookup_in_blocks(spark, folder):
    """Lookup rows whose numbers are far apart."""
    rows = fixtures.lookup_rows(spark).withColumn("row_idx", F.col("row_idx") * 400_000_000)
    out = mapping.map_lookup(tables.alerts(spark, folder), LOOKUP_RULE, rows)
    return out.select("alert_id", "owner", "tier")


@query(
    "e14_mapping_outcomes",
    f"""WITH {LOOKED_UP} SELECT alert_id, 10 AS rule_id,
  CASE WHEN row_idx IS NULL THEN 'failure' ELSE 'success' END AS status, owner FROM looked""",
)
def mapping_outcomes(spark, folder):
    out = mapping.map_lookup(
        tables.alerts(spark, folder), LOOKUP_RULE, fixtures.lookup_rows(spark)
    )
    events = mapping.enrichment_outcomes(out, "alert_id")
    owner = F.try_element_at("fields", F.lit("owner"))
    return events.select("alert_id", "rule_id", "status", owner.alias("owner"))


@query(
    "j12_map_lookup_multi",
    """SELECT e.event_id, n.n_name AS element, r.r_name AS region FROM events e
JOIN nation n ON n.n_nationkey IN (e.user_id % 25, e.event_id % 30)
JOIN region r ON r.r_regionkey = n.n_regionkey""",
)
def map_lookup_multi(spark, folder):
    user, event = F.col("user_id"), F.col("event_id")

    def tag(number):
        return F.concat(F.lit("id:NATION_"), number)

    alerts = tables.read_table(spark, folder, "events").select(
        event.alias("alert_id"), F.array(tag(user % 25), tag(event % 30)).alias("customers")
    )
    names = tables.read_table(spark, folder, "nation").join(
        tables.read_table(spark, folder, "region"),
        F.col("n_regionkey") == F.col("r_regionkey"),
    )
    rows = names.select(
        F.col("n_nationkey").alias("row_idx"),
        F.col("n_name").alias("customers"),
        F.concat(F.lit(" "), "r_name").alias("region"),
    )
    rule = MappingRule(
        11, [["customers"]], [], multi_level=True, new_property_name="found",
        prefix_to_remove="id:",
    )
    out = mapping.map_lookup_multi(alerts.withColumn("found", F.lit(None)), rule, rows)
    return out.select(
        F.col("alert_id").alias("event_id"), F.explode("found").alias("element", "v")
    ).select("event_id", "element", F.col("v")["region"].alias("region"))


@query(
    "j12_condition_and_outcomes",
    """WITH hits AS (
  SELECT e.event_id, n.n_name AS element, r.r_name AS region FROM events e
  JOIN nation n ON n.n_nationkey IN (e.event_id % 30, e.event_id % 60)
  JOIN region r ON r.r_regionkey = n.n_regionkey
  WHERE e.event_type = 'error')
SELECT e.event_id, CASE WHEN e.event_type <> 'error' THEN 'skipped'
    WHEN h.event_id IS NULL THEN 'failure' ELSE 'success' END AS status,
  coalesce(h.element, 'before') AS element, coalesce(h.region, 'kept') AS region
FROM events e LEFT JOIN hits h ON h.event_id = e.event_id""",
)
def map_lookup_multi_where(spark, folder):
    """A rule with a condition over all alerts, which have an older value."""
    event = F.col("event_id")

    def tag(number):
        return F.concat(F.lit("NATION_"), number)

    older = F.create_map(F.lit("before"), F.create_map(F.lit("region"), F.lit("kept")))
    alerts = tables.read_table(spark, folder, "events").select(
        event.alias("alert_id"),
        "event_type",
        F.array(tag(event % 30), tag(event % 60)).alias("customers"),
        older.alias("found"),
    )
    names = tables.read_table(spark, folder, "nation").join(
        tables.read_table(spark, folder, "region"),
        F.col("n_regionkey") == F.col("r_regionkey"),
    )
    rows = names.select(
        F.col("n_nationkey").alias("row_idx"),
        F.col("n_name").alias("customers"),
        F.col("r_name").alias("region"),
    )
    rule = MappingRule(
        12, [["customers"]], [], condition="event_type = 'error'", multi_level=True,
        new_property_name="found",
    )
    out = mapping.map_lookup_multi(alerts, rule, rows)
    status = F.element_at(mapping.OUTCOMES, -1)["status"]
    return out.select(
        F.col("alert_id").alias("event_id"),
        status.alias("status"),
        F.explode("found").alias("element", "v"),
    ).select("event_id", "status", "element", F.col("v")["region"].alias("region"))


TOPOLOGY = """
services AS (SELECT s_suppkey AS service_id, concat('t', s_suppkey % 3) AS tenant_id,
    concat('svc-', s_suppkey % 15) AS service, n_name AS team, r_name AS environment,
    CASE WHEN s_suppkey % 2 = 0 THEN concat('repo-', s_suppkey) END AS repository, n_nationkey
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey),
filled AS (SELECT * EXCLUDE (repository), coalesce(repository, CASE WHEN n_nationkey % 2 = 0
  THEN concat('app-', n_nationkey) END) AS repository FROM services),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tenant_id, service
  ORDER BY service_id) AS rn FROM filled) WHERE rn = 1)"""


def topology(spark, folder):
    """Services, applications and the bridge between them."""
    nation = tables.read_table(spark, folder, "nation")
    key = F.col("s_suppkey")
    services = (
        tables.read_table(spark, folder, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(
            tables.read_table(spark, folder, "region"),
            F.col("n_regionkey") == F.col("r_regionkey"),
        )
        .select(
            key.alias("service_id"),
            F.concat(F.lit("t"), key % 3).alias("tenant_id"),
            F.concat(F.lit("svc-"), key % 15).alias("service"),
            F.col("n_name").alias("team"),
            F.col("r_name").alias("environment"),
            F.when(key % 2 == 0, F.concat(F.lit("repo-"), key)).alias("repository"),
        )
    )
    number = F.col("n_nationkey")
    applications = nation.select(
        number.alias("application_id"),
        F.when(number % 2 == 0, F.concat(F.lit("app-"), number))
        .otherwise("")
        .alias("repository"),
    )
    bridge = tables.read_table(spark, folder, "supplier").select(
        key.alias("service_id"), F.col("s_nationkey").alias("application_id")
    )
    return services, applications, bridge


TOPOLOGY_RULE = MappingRule(
    12, [["service"]], ["team", "environment", "repository"], kind="topology", priority=9
)


@query(
    "j10_topology_lookup",
    f"""WITH {ALERTS}, {TOPOLOGY} SELECT a.alert_id, f.team, f.environment, f.repository
FROM alerts a LEFT JOIN firsts f USING (tenant_id, service)""",
)
def topology_lookup(spark, folder):
    out = mapping.topology_lookup(
        tables.alerts(spark, folder), TOPOLOGY_RULE, *topology(spark, folder)
    )
    return out.select("alert_id", "team", "environment", "repository")


@query(
    "e13_map_alerts",
    f"""WITH {LOOKED_UP}, {TOPOLOGY},
one AS (SELECT l.*, f.team FROM looked l LEFT JOIN firsts f USING (tenant_id, service))
SELECT alert_id, owner, team, CASE WHEN owner = 'team-e' THEN 'last' ELSE tier END AS tier
FROM one""",
)
def map_alerts(spark, folder):
    services, applications, bridge = topology(spark, folder)
    last = MappingRule(13, [["owner"]], ["tier"], lookup="last", priority=1)
    off = MappingRule(14, [["name"]], ["owner"], lookup="owners", priority=99, disabled=True)
    lookups = {
        "owners": fixtures.lookup_rows(spark),
        "last": spark.createDataFrame(
            [(0, "team-e", "last")], "row_idx int, owner string, tier string"
        ),
        "services": services,
        "applications": applications,
        "bridge": bridge,
    }
    rules = [last, LOOKUP_RULE, off, TOPOLOGY_RULE]
    out = mapping.map_alerts(tables.alerts(spark, folder), rules, lookups)
    return out.select("alert_id", "owner", "team", "tier")


WINDOWS = [MaintenanceWindow(*w) for w in fixtures.WINDOWS]

MARKED = f"""{ALERTS},
marked AS (SELECT *, CASE
  WHEN tenant_id = 't0' AND severity = 'low' AND ts >= TIMESTAMP '2024-01-03'
    AND ts < TIMESTAMP '2024-01-06' THEN 1
  WHEN tenant_id = 't0' AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-08' THEN 2
  WHEN tenant_id = 't1' AND k > 50 AND status <> 'resolved' AND ts >= TIMESTAMP '2024-01-10'
    AND ts < TIMESTAMP '2024-01-20' THEN 4
  WHEN tenant_id = 't2' AND provider_type = 'grafana' AND ts >= TIMESTAMP '2024-01-12'
    AND ts < TIMESTAMP '2024-01-14' THEN 6 END AS window_id FROM alerts)"""


@query(
    "j13_first_window",
    f"WITH {MARKED} SELECT alert_id, window_id FROM marked",
)
def first_window(spark, folder):
    out = maintenance.first_window(tables.alerts(spark, folder), WINDOWS)
    return out.select("alert_id", "window_id")


@query(
    "j13_first_window_joined",
    f"WITH {MARKED} SELECT alert_id, window_id FROM marked",
)
def first_window_joined(spark, folder):
    """Among many windows, which take the same way as few."""
    later = [
        MaintenanceWindow(100 + i, f"t{i % 3}", "later", "2030-01-01", "2031-01-01", "k >= 0")
        for i in range(300)
    ]
    out = maintenance.first_window(tables.alerts(spark, folder), [*later, *WINDOWS])
    return out.select("alert_id", "window_id")


@query(
    "j13_apply_maintenance",
    f"""WITH {MARKED} SELECT alert_id,
  CASE WHEN window_id IN (1, 4) THEN 'suppressed' ELSE status END AS status,
  CAST(NULL AS VARCHAR) AS previous_status FROM marked
WHERE window_id IS NULL OR window_id IN (1, 4)""",
)
def apply_maintenance(spark, folder):
    kept, _ = maintenance.apply_maintenance(tables.alerts(spark, folder), WINDOWS)
    return kept.select("alert_id", "status", "previous_status")


@query(
    "j13_apply_maintenance_recoverable",
    f"""WITH {MARKED} SELECT alert_id,
  CASE WHEN window_id IN (1, 4) THEN 'maintenance' ELSE status END AS status,
  CASE WHEN window_id IN (1, 4) THEN status END AS previous_status FROM marked
WHERE window_id IS NULL OR window_id IN (1, 4)""",
)
def apply_maintenance_recoverable(spark, folder):
    kept, _ = maintenance.apply_maintenance(
        tables.alerts(spark, folder), WINDOWS, strategy=maintenance.RECOVER
    )
    return kept.select("alert_id", "status", "previous_status")


@query(
    "j13_maintenance_audit",
    f"""WITH {MARKED} SELECT tenant_id, fingerprint, ts, 'Alert is in maintenance window' AS action,
  CASE window_id WHEN 1 THEN 'Alert suppressed due to maintenance rule `night`'
    WHEN 2 THEN 'Alert in maintenance due to rule `all`'
    WHEN 4 THEN 'Alert suppressed due to maintenance rule `kept`'
    ELSE 'Alert in maintenance due to rule `drop`' END AS description
FROM marked WHERE window_id IS NOT NULL""",
)
def maintenance_audit(spark, folder):
    _, audit = maintenance.apply_maintenance(tables.alerts(spark, folder), WINDOWS)
    return audit.drop("actor")


RECOVER_AS_OF = "2024-01-07 00:00:00"


@query(
    "j14_recover_maintenance",
    f"""WITH {ALERTS},
held AS (SELECT * FROM alerts WHERE status = 'acknowledged'),
traced AS (SELECT *, concat_ws(',',
    CASE WHEN tenant_id = 't0' AND ts > TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-08'
      THEN 2 END,
    CASE WHEN tenant_id = 't1' AND k > 50 AND ts > TIMESTAMP '2024-01-10'
      AND ts < TIMESTAMP '2024-01-20' THEN 4 END,
    CASE WHEN tenant_id = 't2' AND provider_type = 'grafana' AND ts > TIMESTAMP '2024-01-12'
      AND ts < TIMESTAMP '2024-01-14' THEN 6 END) AS trace FROM held)
SELECT alert_id, CASE WHEN trace = '' THEN 'acknowledged' ELSE 'maintenance' END AS status,
  CASE WHEN trace = '' THEN 'maintenance' ELSE 'acknowledged' END AS previous_status,
  trace FROM traced""",
)
def recover_maintenance(spark, folder):
    alerts = tables.alerts(spark, folder)
    held = alerts.filter("status = 'acknowledged'").withColumns(
        {"previous_status": F.col("status"), "status": F.lit("maintenance")}
    )
    out = maintenance.recover_maintenance(
        held, WINDOWS, F.lit(RECOVER_AS_OF).cast("timestamp")
    )
    trace = F.array_join("maintenance_trace", ",")
    return out.select("alert_id", "status", "previous_status", trace.alias("trace"))


@query(
    "a12_silenced_per_window",
    f"""WITH {MARKED} SELECT tenant_id, window_id, count(*) AS n FROM marked
WHERE window_id IS NOT NULL GROUP BY ALL""",
)
def silenced_per_window(spark, folder):
    return maintenance.silenced_per_window(
        maintenance.first_window(tables.alerts(spark, folder), WINDOWS)
    )


@query(
    "c7_skip_maintenance",
    f"""WITH {MARKED} SELECT alert_id, window_id IN (1, 4) IS TRUE AS bypassed FROM marked
WHERE window_id IS NULL OR window_id IN (1, 4)""",
)
def skip_maintenance(spark, folder):
    kept, _ = maintenance.apply_maintenance(
        tables.alerts(spark, folder), WINDOWS, strategy=maintenance.RECOVER
    )
    run, held = maintenance.skip_maintenance(kept)
    return run.select("alert_id", F.lit(False).alias("bypassed")).unionByName(
        held.select("alert_id", F.lit(True).alias("bypassed"))
    )


@query(
    "a7_enrichment_events_per_rule",
    f"""WITH {EXTRACTED} SELECT 1 AS rule_id, 'success' AS status, count(*) AS n FROM x2
  GROUP BY ALL
UNION ALL SELECT 2, CASE WHEN again IS NULL THEN 'skipped' ELSE 'success' END, count(*) FROM x2
  GROUP BY ALL
UNION ALL SELECT 3, CASE WHEN k > 50 AND severity IN ('critical', 'high') THEN 'success'
  ELSE 'skipped' END, count(*) FROM x2 GROUP BY ALL
UNION ALL SELECT 5, CASE WHEN digit IS NULL THEN 'skipped' ELSE 'success' END, count(*) FROM x2
  GROUP BY ALL""",
)
def enrichment_events_per_rule(spark, folder):
    events = mapping.enrichment_outcomes(extracted(spark, folder), "alert_id")
    return events.groupBy("rule_id", "status").agg(F.count(F.lit(1)).alias("n"))

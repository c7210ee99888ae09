"""Deduplication rules and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from alertweave.functions import scalars
from alertweave.operators import dedup
from alertweave.plans import fixtures
from alertweave.plans.registry import query
from alertweave.plans.sequences import CLASSES, KEY_WINDOW
from alertweave.plans.sql import ALERTS
from alertweave.sources import tables

RULED = f"""{ALERTS},
rules(rule_id, tenant_id, provider_id, provider_type, full_deduplication, ignore_fields, enabled)
AS (VALUES {fixtures.DEDUP_RULES_SQL}),
ruled AS (SELECT a.*, coalesce(r.rule_id, sha256(concat(coalesce(a.provider_id, 'None'), '_',
    a.provider_type))) AS dedup_rule_id, r.rule_id IS NULL AS dedup_rule_default,
  CASE WHEN r.full_deduplication THEN r.ignore_fields ELSE ['lastReceived'] END AS ign
  FROM alerts a LEFT JOIN rules r ON r.enabled AND r.tenant_id = a.tenant_id
    AND r.provider_id IS NOT DISTINCT FROM a.provider_id
    AND r.provider_type = a.provider_type)"""


def ruled_alerts(spark, folder):
    return dedup.attach_dedup_rule(
        tables.alerts(spark, folder), fixtures.dedup_rules(spark)
    )


@query(
    "j20_attach_dedup_rule",
    f"""WITH {RULED} SELECT alert_id, dedup_rule_id, dedup_rule_default,
  array_to_string(ign, ',') AS ignore_fields FROM ruled""",
)
def attach_dedup_rule(spark, folder):
    return ruled_alerts(spark, folder).select(
        "alert_id",
        "dedup_rule_id",
        "dedup_rule_default",
        F.array_join("dedup_ignore_fields", ",").alias("ignore_fields"),
    )


RULE_CLASSES = f"""{RULED},
hashed AS (SELECT *, concat_ws('|', CASE WHEN list_contains(ign, 'name') THEN '' ELSE name END,
  CASE WHEN list_contains(ign, 'severity') THEN '' ELSE severity END, status) AS h FROM ruled),
before AS (SELECT *, lag(h) {KEY_WINDOW} AS before_hash FROM hashed),
classes AS (SELECT *, CASE WHEN before_hash IS NULL THEN 'none' WHEN before_hash = h
  THEN 'full' ELSE 'partial' END AS dedup_type FROM before)"""


def rule_classes(spark, folder):
    fields = {n: F.col(n) for n in ("name", "severity", "status")}
    hashed = ruled_alerts(spark, folder).withColumn("h", dedup.hash_by_rule(fields))
    return dedup.classify_duplicates(hashed, "h")


@query(
    "w3_classify_duplicates_by_rule",
    f"WITH {RULE_CLASSES} SELECT alert_id, dedup_rule_id, dedup_type FROM classes",
)
def classify_by_rule(spark, folder):
    return rule_classes(spark, folder).select("alert_id", "dedup_rule_id", "dedup_type")


COUNTS = f"""{RULE_CLASSES},
counts AS (SELECT dedup_rule_id, provider_id, provider_type,
  count(*) FILTER (dedup_type = 'full') AS full_count,
  count(*) FILTER (dedup_type = 'partial') AS partial_count,
  count(*) FILTER (dedup_type = 'none') AS none_count
  FROM classes GROUP BY ALL)"""


@query("a1_dedup_counts", f"WITH {COUNTS} SELECT * FROM counts")
def dedup_counts(spark, folder):
    return dedup.dedup_counts(rule_classes(spark, folder))


AS_OF = "2024-01-30 12:30:00"


@query(
    "a2_dedup_hourly",
    f"""WITH {RULED},
spine AS (SELECT DISTINCT dedup_rule_id, unnest(generate_series(TIMESTAMP '2024-01-29 13:00:00',
  TIMESTAMP '2024-01-30 12:00:00', INTERVAL 1 HOUR)) AS hour FROM ruled),
n AS (SELECT dedup_rule_id, date_trunc('hour', ts) AS hour, count(*) AS n FROM ruled
  GROUP BY ALL)
SELECT s.dedup_rule_id, s.hour, coalesce(n.n, 0) AS n FROM spine s
LEFT JOIN n USING (dedup_rule_id, hour)""",
)
def dedup_hourly(spark, folder):
    as_of = F.lit(AS_OF).cast("timestamp")
    return dedup.dedup_hourly(ruled_alerts(spark, folder), as_of)


@query(
    "a3_dedup_report",
    f"""WITH {COUNTS},
totals AS (SELECT dedup_rule_id, CAST(sum(full_count) AS BIGINT) AS full_count,
  CAST(sum(partial_count) AS BIGINT) AS partial_count,
  CAST(sum(none_count) AS BIGINT) AS none_count FROM counts GROUP BY dedup_rule_id),
all_rules AS (SELECT rule_id AS dedup_rule_id, false AS is_default FROM rules WHERE enabled
  UNION ALL SELECT DISTINCT sha256(concat(coalesce(provider_id, 'None'), '_', provider_type)),
    true FROM alerts)
SELECT dedup_rule_id, is_default, coalesce(full_count, 0) AS full_count,
  coalesce(partial_count, 0) AS partial_count, coalesce(none_count, 0) AS none_count,
  coalesce(full_count + partial_count + none_count, 0) AS ingested,
  round(coalesce(100.0 * (full_count + partial_count)
    / nullif(full_count + partial_count + none_count, 0), 0), 6) AS dedup_ratio
FROM all_rules LEFT JOIN totals USING (dedup_rule_id)""",
)
def dedup_report(spark, folder):
    custom = fixtures.dedup_rules(spark).filter("enabled").select(
        F.col("rule_id").alias("dedup_rule_id"), F.lit(False).alias("is_default")
    )
    default = (
        tables.alerts(spark, folder)
        .select(
            dedup.default_rule_id(F.col("provider_id"), F.col("provider_type")).alias(
                "dedup_rule_id"
            ),
            F.lit(True).alias("is_default"),
        )
        .distinct()
    )
    counts = dedup.dedup_counts(rule_classes(spark, folder))
    report = dedup.dedup_report(custom.unionByName(default), counts)
    return report.withColumn("dedup_ratio", F.round("dedup_ratio", 6))


@query(
    "n10_content_hash",
    f"""WITH {ALERTS} SELECT alert_id, sha256(concat_ws('|', name, coalesce(provider_id, chr(1)),
  status)) AS hash FROM alerts""",
)
def content_hash(spark, folder):
    fields = {n: F.col(n) for n in ("status", "severity", "name", "provider_id")}
    return tables.alerts(spark, folder).select(
        "alert_id", scalars.content_hash(fields, ignore=("severity",)).alias("hash")
    )


@query(
    "a12_dedup_counters",
    f"""WITH {CLASSES} SELECT provider_type, dedup_type <> 'none' AS duplicated, count(*) AS n
FROM classes GROUP BY ALL""",
)
def dedup_counters(spark, folder):
    classes = dedup.classify_duplicates(tables.alerts(spark, folder))
    duplicated = (F.col("dedup_type") != "none").alias("duplicated")
    return classes.groupBy("provider_type", duplicated).agg(F.count(F.lit(1)).alias("n"))


# per provider type, the fields a provider's alerts are fingerprinted by
PROVIDER_FIELDS = {"grafana": ["service", "k"], "sentry": ["name"]}


@query(
    "udf4_fingerprint_by_provider",
    f"""WITH {ALERTS} SELECT alert_id, CASE provider_type WHEN 'grafana'
  THEN sha256(concat(service, k)) WHEN 'sentry' THEN sha256(name) ELSE name END AS fingerprint
FROM alerts""",
)
def fingerprint_by_provider(spark, folder):
    fingerprint = scalars.fingerprint_by_provider(
        F.col("provider_type"),
        {t: [F.col(f) for f in fields] for t, fields in PROVIDER_FIELDS.items()},
        F.col("name"),
    )
    return tables.alerts(spark, folder).select("alert_id", fingerprint.alias("fingerprint"))

"""Incident lifecycle: links, roll-ups, status, severity, operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertweave.functions.scalars import INCIDENT_STATUSES, SEVERITIES, severity_label
from alertweave.operators import enrich
from alertweave.operators.scan import ALERT_KEY

LOW = 1
RESOLVED, DELETED = "resolved", "deleted"
CASCADING = ("resolved", "acknowledged")


def live_links(links: DataFrame) -> DataFrame:
    """Distinct edges that are not unlinked."""
    return (
        links.filter(F.col("deleted_at").isNull())
        .select("incident_id", *ALERT_KEY)
        .distinct()
    )


def apply_link_ops(ops: DataFrame) -> DataFrame:
    """Newest link or unlink operation per edge; an unlink sets ``deleted_at``."""
    newest = ops.groupBy("incident_id", *ALERT_KEY).agg(
        F.max_by(F.struct("ts", "action"), F.struct("ts", "seq")).alias("_op"),
        F.min(F.when(F.col("action") == "link", F.col("ts"))).alias("linked_at"),
    )
    unlinked = F.col("_op.action") == "unlink"
    return newest.select(
        "incident_id",
        *ALERT_KEY,
        "linked_at",
        F.when(unlinked, F.col("_op.ts")).alias("deleted_at"),
    )


def new_links(
    candidates: DataFrame, links: DataFrame, exclude_unlinked: bool = False
) -> DataFrame:
    """Candidate edges that are not linked yet, optionally also never unlinked."""
    edge = ["incident_id", *ALERT_KEY]
    known = links if exclude_unlinked else links.filter(F.col("deleted_at").isNull())
    return candidates.select(*edge).distinct().join(known.select(*edge), edge, "left_anti")


def key_summary(alerts: DataFrame) -> DataFrame:
    """Per alert key: newest service, source, severity, status; first and last time."""
    newest = F.max_by(
        F.struct("service", "source", "severity_rank", "status"), F.struct("ts", "alert_id")
    )
    grouped = alerts.groupBy(*ALERT_KEY).agg(
        newest.alias("_n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )
    return grouped.select(*ALERT_KEY, "_n.*", "first_ts", "last_ts")


def _set(name: str) -> Column:
    return F.array_sort(F.collect_set(name))


def incident_rollup(incidents: DataFrame, live: DataFrame, summary: DataFrame) -> DataFrame:
    """Sources, services, severity, count and times of each incident's live alerts, added
    to what the incident had. Keys are reduced before they meet the links."""
    rolled = (
        live.join(summary, list(ALERT_KEY))
        .groupBy("incident_id")
        .agg(
            _set("source").alias("_sources"),
            _set("service").alias("_services"),
            F.max("severity_rank").alias("_severity"),
            F.count(F.lit(1)).alias("alerts_count"),
            F.min("first_ts").alias("start_time"),
            F.max("last_ts").alias("last_seen_time"),
        )
    )
    base = incidents.drop("alerts_count", "start_time", "last_seen_time")
    joined = base.join(rolled, "incident_id", "left")
    empty = F.array().cast("array<string>")
    return joined.withColumns(
        {
            "sources": union_sets(F.col("sources"), F.coalesce("_sources", empty)),
            "affected_services": union_sets(
                F.col("affected_services"), F.coalesce("_services", empty)
            ),
            "severity": F.when(F.col("forced_severity"), F.col("severity")).otherwise(
                F.coalesce(F.col("_severity"), F.col("severity"))
            ),
            "alerts_count": F.coalesce("alerts_count", F.lit(0)),
        }
    ).drop("_sources", "_services", "_severity")


def rollup_sessions(sessions: DataFrame) -> DataFrame:
    """Incidents straight from correlated alerts: reduced per key, then per incident."""
    per_key = sessions.groupBy(
        "incident_id", "tenant_id", "rule_id", "group_key", "fingerprint", "service"
    ).agg(
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.max("severity_rank").alias("severity_rank"),
    )
    return per_key.groupBy("incident_id", "tenant_id", "rule_id", "group_key").agg(
        F.min("first_ts").alias("start_time"),
        F.max("last_ts").alias("last_seen_time"),
        F.max("severity_rank").alias("severity"),
        F.count_distinct("fingerprint").alias("alerts_count"),
        _set("service").alias("services"),
    )


def incident_rollup_after_unlink(
    incidents: DataFrame, links: DataFrame, summary: DataFrame
) -> DataFrame:
    """Roll-up after links were deleted. A removed alert's service or source goes only if
    no live alert of the incident has it; without live alerts the severity is low."""
    edge = ["incident_id", *ALERT_KEY]
    state = links.groupBy(*edge).agg(
        F.bool_or(F.col("deleted_at").isNull()).alias("_live")
    )
    rows = state.join(summary, list(ALERT_KEY))
    live = F.col("_live")

    def collected(name: str, test: Column) -> Column:
        return F.collect_set(F.when(test, F.col(name)))

    rolled = rows.groupBy("incident_id").agg(
        collected("service", live).alias("_live_services"),
        collected("service", ~live).alias("_gone_services"),
        collected("source", live).alias("_live_sources"),
        collected("source", ~live).alias("_gone_sources"),
        F.max(F.when(live, F.col("severity_rank"))).alias("_severity"),
        F.count_if(live).alias("_count"),
        F.min(F.when(live, F.col("first_ts"))).alias("start_time"),
        F.max(F.when(live, F.col("last_ts"))).alias("last_seen_time"),
    )
    base = incidents.drop("alerts_count", "start_time", "last_seen_time")
    joined = base.join(rolled, "incident_id", "left")

    def left_over(old: str, gone: str, alive: str) -> Column:
        empty = F.array().cast("array<string>")
        drop = F.array_except(F.coalesce(gone, empty), F.coalesce(alive, empty))
        return remove_from_set(F.col(old), drop)

    return joined.withColumns(
        {
            "affected_services": left_over(
                "affected_services", "_gone_services", "_live_services"
            ),
            "sources": left_over("sources", "_gone_sources", "_live_sources"),
            "severity": F.when(F.col("forced_severity"), F.col("severity")).otherwise(
                F.coalesce(F.col("_severity"), F.lit(LOW))
            ),
            "alerts_count": F.coalesce("_count", F.lit(0)),
        }
    ).drop(*[c for c in rolled.columns if c.startswith("_")])


def union_sets(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_union(a, b))


def remove_from_set(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_except(a, b))


def effective_status(summary: DataFrame, enrichments: DataFrame | None) -> DataFrame:
    """Status per key, the enriched one first."""
    if enrichments is None:
        return summary.withColumn("effective_status", F.col("status"))
    joined = summary.join(enrichments, list(ALERT_KEY), "left")
    enriched = F.try_element_at("enrichments", F.lit("status"))
    return joined.withColumn("effective_status", F.coalesce(enriched, F.col("status")))


def all_in_status(
    incidents: DataFrame, live: DataFrame, effective: DataFrame, status: str
) -> DataFrame:
    """Whether every live alert of an incident has the status; false without alerts."""
    flags = (
        live.join(effective, list(ALERT_KEY))
        .groupBy("incident_id")
        .agg(F.bool_and(F.col("effective_status") == status).alias("all_in_status"))
    )
    return incidents.join(flags, "incident_id", "left").withColumn(
        "all_in_status", F.coalesce("all_in_status", F.lit(False))
    )


def alert_status_flags(
    live: DataFrame, effective: DataFrame, status: str = RESOLVED
) -> DataFrame:
    """Per incident: whether all, the earliest and the latest live alert have the status."""
    rows = live.join(effective, list(ALERT_KEY))
    hit = F.col("effective_status") == status
    at = F.struct("last_ts", "fingerprint")
    return rows.groupBy("incident_id").agg(
        F.bool_and(hit).alias("all_alerts"),
        F.min_by(hit, at).alias("first_alert"),
        F.max_by(hit, at).alias("last_alert"),
    )


def resolve_incidents(
    incidents: DataFrame, live: DataFrame, effective: DataFrame
) -> DataFrame:
    """Apply each incident's resolve policy to its status, in one pass over its alerts."""
    flags = alert_status_flags(live, effective)
    policy = F.col("resolve_on")
    resolve = (
        F.when(policy == "all_resolved", F.col("all_alerts"))
        .when(policy == "first_resolved", F.col("first_alert"))
        .when(policy == "last_resolved", F.col("last_alert"))
    )
    joined = incidents.join(flags, "incident_id", "left")
    return joined.withColumn(
        "status",
        F.when(F.coalesce(resolve, F.lit(False)), RESOLVED).otherwise(F.col("status")),
    ).drop("all_alerts", "first_alert", "last_alert")


def change_status(incidents: DataFrame, ops: DataFrame) -> DataFrame:
    """Newest status operation (ts, seq, status, actor) per incident: the actor becomes the
    assignee, a resolve sets the end time."""
    newest = ops.groupBy("incident_id").agg(
        F.max_by(F.struct("status", "actor", "ts"), F.struct("ts", "seq")).alias("_op"),
        F.max(F.when(F.col("status") == RESOLVED, F.col("ts"))).alias("_ended"),
    )
    joined = incidents.join(newest, "incident_id", "left")
    return joined.withColumns(
        {
            "status": F.coalesce("_op.status", "status"),
            "assignee": F.coalesce("_op.actor", "assignee"),
            "end_time": F.col("_ended"),
        }
    ).drop("_op", "_ended")


def cascade_status(ops: DataFrame, live: DataFrame) -> DataFrame:
    """Resolved and acknowledged operations as disposable status operations on the
    incident's live alerts."""
    return (
        ops.filter(F.col("status").isin(*CASCADING))
        .join(live, "incident_id")
        .select(
            *ALERT_KEY,
            "ts",
            "seq",
            F.lit("status").alias("field"),
            F.col("status").alias("value"),
            F.lit(True).alias("disposable"),
        )
    )


def status_audit(ops: DataFrame, before: Column, assignee_before: Column) -> DataFrame:
    """Audit rows of status operations; a new assignee adds a row."""
    changed = F.struct(
        F.lit(enrich.INCIDENT_STATUS_CHANGED).alias("action"),
        F.concat(
            F.lit("Incident status changed from "), before, F.lit(" to "), F.col("status")
        ).alias("description"),
    )
    assigned = F.struct(
        F.lit(enrich.INCIDENT_ASSIGNED).alias("action"),
        F.concat(F.lit("Incident self-assigned to "), F.col("actor")).alias("description"),
    )
    is_new = ~F.col("actor").eqNullSafe(assignee_before)
    rows = F.array_compact(F.array(changed, F.when(is_new, assigned)))
    return ops.select("incident_id", "ts", "actor", F.explode(rows).alias("_a")).select(
        "incident_id", "ts", "actor", "_a.*"
    )


def force_severity(incidents: DataFrame, ops: DataFrame) -> DataFrame:
    """Newest severity operation pins the severity."""
    newest = ops.groupBy("incident_id").agg(
        F.max_by("severity", F.struct("ts", "seq")).alias("_pinned")
    )
    joined = incidents.join(newest, "incident_id", "left")
    return joined.withColumns(
        {
            "forced_severity": F.col("_pinned").isNotNull() | F.col("forced_severity"),
            "severity": F.coalesce("_pinned", "severity"),
        }
    ).drop("_pinned")


def apply_incident_ops(ops: DataFrame) -> DataFrame:
    """Final incidents from a log of create, update and delete operations.

    Null fields of an update change nothing, except the link to a past incident, which the
    newest operation sets. A delete is a status. A generated summary goes to its own column
    (and to the user's when it is not null). Operations on ids never created are dropped.
    """
    at = F.struct("ts", "seq")
    generated = F.coalesce(F.col("generated_by_ai"), F.lit(False))
    status = F.when(F.col("action") == "delete", DELETED).otherwise(F.col("status"))

    def newest(value: Column, test: Column) -> Column:
        return F.max_by(value, F.when(test, at))

    edits = F.col("action") != "delete"
    summary = F.col("user_summary")
    own = F.col("incident_id"), F.col("tenant_id")
    folded = ops.groupBy(*own).agg(
        F.bool_or(F.col("action") == "create").alias("_created"),
        newest(status, status.isNotNull()).alias("status"),
        *[
            newest(F.col(c), F.col(c).isNotNull()).alias(c)
            for c in ("user_generated_name", "assignee", "severity")
        ],
        newest(F.col("same_incident_in_the_past_id"), edits).alias(
            "same_incident_in_the_past_id"
        ),
        newest(summary, edits & (~generated | summary.isNotNull())).alias("user_summary"),
        newest(summary, edits & generated).alias("generated_summary"),
    )
    return folded.filter("_created").drop("_created")


def format_incidents(incidents: DataFrame) -> DataFrame:
    """Unknown status becomes firing; display name is the user's or the generated one;
    severity as its word."""
    return incidents.withColumns(
        {
            "status": F.when(F.col("status").isin(*INCIDENT_STATUSES), F.col("status")).otherwise(
                "firing"
            ),
            "display_name": F.coalesce("user_generated_name", "ai_generated_name"),
            "severity": F.coalesce(
                severity_label(F.col("severity")), F.lit(SEVERITIES[LOW - 1])
            ),
        }
    )


def firing_total(live: DataFrame, counters: DataFrame) -> DataFrame:
    """Per incident: the larger of its link count and the sum of unresolved counters (a
    missing counter counts as one)."""
    return (
        live.join(counters, list(ALERT_KEY), "left")
        .groupBy("incident_id")
        .agg(
            F.greatest(
                F.count(F.lit(1)), F.sum(F.coalesce("unresolved_counter", F.lit(1)))
            ).alias("firing_total")
        )
    )

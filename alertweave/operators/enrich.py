"""Enrichments: folding operations, disposable fields, overlays, audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertweave.functions import paths
from alertweave.functions.scalars import iso_millis
from alertweave.operators.scan import (
    ALERT_KEY,
    MAX_ROWS,
    following_first,
    run_scans,
    running_last,
)

NOTE = "note"
DISPOSABLE = "disposable_"
# fixed values: fields that a resolved alert removes instead of making them permanent
DISPOSE_KEYS = ("assignees", "status", "dismissed", "dismissUntil")

# fixed values: texts of the audit actions
TRIGGERED = "alert was triggered"
RESOLVED = "alert automatically resolved"
API_RESOLVED = "alert automatically resolved by API"
MANUALLY_RESOLVED = "alert manually resolved"
STATUS_CHANGED = "alert status manually changed"
API_STATUS_CHANGED = "alert status changed by API"
DEDUPLICATED = "alert was deduplicated"
TICKET_ASSIGNED = "alert was assigned with ticket"
ENRICHED = "alert enriched"
COMMENTED = "a comment was added to the alert"
IN_MAINTENANCE = "Alert is in maintenance window"
MAINTENANCE_OVER = "Alert has been removed from maintenance window"
INCIDENT_STATUS_CHANGED = "Incident status changed"
INCIDENT_ASSIGNED = "Incident assigned"


def fold_fields(
    rows: DataFrame, keys: list[str], order: list[str], forced: str = "forced"
) -> DataFrame:
    """Field operations to the final map per key.

    ``rows`` has the keys, the order columns, ``field``, ``value`` (null deletes) and a
    flag marking the row that starts a replacement of everything older. Both steps
    combine on the map side; the second sees one row per key and field.
    """
    blank_note = (
        (F.col("field") == NOTE) & F.col("value").isNotNull() & (F.trim("value") == "")
    )
    at = F.struct(*order)
    newest = (
        rows.filter(~F.coalesce(blank_note, F.lit(False)))
        .groupBy(*keys, "field")
        .agg(F.max_by("value", at).alias("value"), F.max(at).alias("at"))
    )
    cut = F.max(F.when(F.col("field") == F.lit(forced), F.col("at"))).alias("cut")
    entry = F.when(
        F.col("value").isNotNull() & (F.col("field") != forced),
        F.struct("field", "value", "at"),
    )
    folded = newest.groupBy(*keys).agg(F.collect_list(entry).alias("entries"), cut)
    alive = F.filter(
        "entries",
        lambda entry_: F.col("cut").isNull()
        | (entry_["field"] == NOTE)
        | (entry_["at"] >= F.col("cut")),
    )
    return folded.select(
        *keys,
        F.map_from_entries(
            F.transform(alive, lambda entry_: F.struct(entry_["field"], entry_["value"]))
        ).alias("enrichments"),
    )


FORCED = "\u0000forced"


def explode_ops(ops: DataFrame) -> DataFrame:
    """One row per field of each operation, and a marker row for a forced one."""
    keep = [c for c in ops.columns if c not in ("enrichments", "force")]
    fields = ops.select(*keep, F.explode("enrichments").alias("field", "value"))
    if "force" not in ops.columns:
        return fields
    marks = ops.filter("force").select(
        *keep, F.lit(FORCED).alias("field"), F.lit(None).cast("string").alias("value")
    )
    return fields.unionByName(marks)


def fold_enrichments(ops: DataFrame, keys: list[str]) -> DataFrame:
    """Operations (keys, ts, seq, enrichments, force) to one map per key.

    New keys win, null deletes, a blank note keeps the old one, a forced operation
    replaces everything but the note.
    """
    return fold_fields(explode_ops(ops), keys, ["ts", "seq"], forced=FORCED)


def broadcast_enrichment(keys: DataFrame, enrichments: dict[str, str | None]) -> DataFrame:
    """The same map for many keys, as operation rows."""
    entries = [F.lit(x) for kv in enrichments.items() for x in kv]
    return keys.distinct().withColumn(
        "enrichments", F.create_map(*entries).cast("map<string,string>")
    )


def place_ops(
    alerts: DataFrame, ops: DataFrame, max_rows: int = MAX_ROWS
) -> DataFrame:
    """Each field operation with the key's alert it falls on and the alert after that.

    Alerts and operations form one sequence per key, so this is two ordered scans and no
    range join. An operation at the time of an alert belongs to that alert.
    """
    info = F.struct("alert_id", "ts", "status")
    marks = alerts.select(
        *ALERT_KEY, "ts", F.lit(0).alias("_kind"), "alert_id", info.alias("_alert")
    )
    rows = ops.withColumn("_kind", F.lit(1))
    order = ("ts", "_kind", "alert_id", "seq")
    both = marks.unionByName(rows, allowMissingColumns=True)
    placed = run_scans(
        both,
        [
            running_last("_on", F.col("_alert"), order),
            following_first("_next", F.col("_alert"), order),
        ],
        order=order,
        max_rows=max_rows,
    )
    return placed.filter(F.col("_kind") == 1).select(
        *ops.columns,
        F.col("_on.alert_id").alias("alert_id"),
        F.col("_next.ts").alias("next_ts"),
        F.col("_next.status").alias("next_status"),
    )


def effective_enrichments(
    alerts: DataFrame, ops: DataFrame, max_rows: int = MAX_ROWS
) -> DataFrame:
    """Disposable fields per alert instance: set while it was the key's newest alert."""
    placed = place_ops(alerts, ops, max_rows).filter(
        F.col("disposable") & F.col("alert_id").isNotNull()
    )
    newest = placed.groupBy(*ALERT_KEY, "alert_id", "field").agg(
        F.max_by("value", F.struct("ts", "seq")).alias("value")
    )
    return newest.filter(F.col("value").isNotNull())


def instance_maps(effective: DataFrame) -> DataFrame:
    return effective.groupBy(*ALERT_KEY, "alert_id").agg(
        F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("enrichments")
    )


def dispose(
    alerts: DataFrame, ops: DataFrame, max_rows: int = MAX_ROWS
) -> DataFrame:
    """Field operations with the effect of later alerts written out as operations.

    The next alert ends a disposable field (a dismissal becomes false); a resolved one
    makes it permanent instead, and removes the ``DISPOSE_KEYS`` of its key.
    """
    placed = place_ops(alerts, ops, max_rows)
    cols = [*ALERT_KEY, "ts", "seq", "field", "value"]
    ended = placed.filter(
        F.col("disposable")
        & F.col("next_ts").isNotNull()
        & (F.col("next_status") != "resolved")
    ).select(
        *ALERT_KEY,
        F.col("next_ts").alias("ts"),
        F.lit(-1).cast("long").alias("seq"),
        "field",
        F.when(F.col("field") == "dismissed", "false").alias("value"),
    )
    resolved = (
        alerts.filter(F.col("status") == "resolved")
        .groupBy(*ALERT_KEY)
        .agg(F.max("ts").alias("ts"))
        .select(
            *ALERT_KEY,
            "ts",
            F.lit(-1).cast("long").alias("seq"),
            F.explode(F.array(*[F.lit(k) for k in DISPOSE_KEYS])).alias("field"),
            F.lit(None).cast("string").alias("value"),
        )
    )
    return placed.select(*cols).unionByName(ended).unionByName(resolved)


def current_enrichments(
    alerts: DataFrame, ops: DataFrame, max_rows: int = MAX_ROWS
) -> DataFrame:
    """The enrichment map per key after all alerts and operations."""
    rows = dispose(alerts, ops, max_rows)
    return fold_fields(rows, list(ALERT_KEY), ["ts", "seq"], forced=FORCED)


def overlay(event: Column, enrichments: Column) -> Column:
    """Enrichment over event, texts trimmed; a null map changes nothing."""
    enr = F.transform_values(enrichments, lambda key_, value_: F.trim(value_))
    kept = F.map_filter(event, lambda key_, value_: ~F.map_contains_key(enr, key_))
    return F.when(enrichments.isNull(), event).otherwise(F.map_concat(kept, enr))


def enriched_fields(enrichments: Column) -> Column:
    return F.filter(
        F.map_keys(enrichments),
        lambda key_: ~key_.startswith(DISPOSABLE) & (key_ != "assignees"),
    )


def visible_assignee(last_received: Column, assignees: Column) -> Column:
    """Assignee stored under the alert's time, as given or as ISO milliseconds."""
    iso = iso_millis(F.try_to_timestamp(last_received))
    return F.coalesce(
        F.nullif(F.try_element_at(assignees, last_received), F.lit("")),
        F.nullif(F.try_element_at(assignees, iso), F.lit("")),
    )


def with_enrichment(
    alerts: DataFrame, enrichments: DataFrame, fields: list[str], keys: list[str]
) -> DataFrame:
    """Left join on ``keys``; the named text columns take the enriched value; counters
    follow the effective status."""
    joined = alerts.join(enrichments, keys, "left")
    enr = F.col("enrichments")
    cols = {f: F.coalesce(F.trim(F.try_element_at(enr, F.lit(f))), F.col(f)) for f in fields}
    cols["enriched_fields"] = F.coalesce(
        enriched_fields(enr), F.array().cast("array<string>")
    )
    out = joined.withColumns(cols)
    fixes = {"firing_counter": "acknowledged", "unresolved_counter": "resolved"}
    return out.withColumns(
        {
            c: F.when(F.col("status") == word, F.lit(0)).otherwise(F.col(c))
            for c, word in fixes.items()
            if c in alerts.columns
        }
    )


def classify_change(enrichments: Column, email: Column, api_key: Column) -> tuple[Column, Column]:
    """Audit action and description of an enrichment, from its keys and its actor."""
    status = F.try_element_at(enrichments, F.lit("status"))
    ticket = F.try_element_at(enrichments, F.lit("ticket_url"))
    note = F.nullif(F.try_element_at(enrichments, F.lit(NOTE)), F.lit(""))
    # a status set with an empty key is nobody's change: the other keys describe it
    nobody = F.coalesce(F.length(api_key) == 0, F.lit(False))
    has_status = F.map_contains_key(enrichments, F.lit("status")) & ~nobody
    has_ticket = F.map_contains_key(enrichments, F.lit("ticket_url"))
    by_api = F.coalesce(F.length(api_key) > 0, F.lit(False))
    resolves = F.coalesce(status == "resolved", F.lit(False))
    action = (
        F.when(has_status & ~by_api & resolves, MANUALLY_RESOLVED)
        .when(has_status & ~by_api, STATUS_CHANGED)
        .when(has_status & resolves, API_RESOLVED)
        .when(has_status, API_STATUS_CHANGED)
        .when(has_ticket, TICKET_ASSIGNED)
        .when(note.isNotNull(), COMMENTED)
        .otherwise(ENRICHED)
    )
    changed = F.concat(F.lit("Alert status was changed to "), status, F.lit(" by "))
    text = (
        F.when(has_status & ~by_api, F.concat(changed, email))
        .when(has_status, F.concat(changed, F.lit("API `"), api_key, F.lit("`")))
        .when(has_ticket, F.concat(F.lit("Ticket assigned by "), email, F.lit(" - "), ticket))
        .when(
            note.isNotNull(), F.concat(F.lit("Comment added by "), email, F.lit(" - "), note)
        )
        .otherwise(
            F.concat(
                F.lit("Alert enriched by "), email, F.lit(" - "), F.to_json(enrichments)
            )
        )
    )
    noted = note.isNotNull() & (has_status | has_ticket)
    suffix = F.when(noted, F.concat(F.lit(" - With note: "), note)).otherwise(F.lit(""))
    return action, F.concat(text, suffix)


def audit_rows(
    df: DataFrame, action: Column, description: Column, actor: Column
) -> DataFrame:
    """One audit row per input row."""
    return df.select(
        *ALERT_KEY,
        "ts",
        actor.alias("actor"),
        action.alias("action"),
        description.alias("description"),
    )


def lifecycle_audit(classified: DataFrame) -> DataFrame:
    """Audit rows of ingestion: triggered, resolved or deduplicated, in one projection."""
    full = F.col("dedup_type") == "full"
    resolved = F.col("status") == "resolved"
    action = F.when(full, DEDUPLICATED).when(resolved, RESOLVED).otherwise(TRIGGERED)
    text = (
        F.when(full, "Alert was deduplicated")
        .otherwise(F.concat(F.lit("Alert status: "), F.col("status")))
    )
    return audit_rows(classified, action, text, F.lit("system"))


def audit_counts(audit: DataFrame) -> DataFrame:
    return audit.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


def enrich_from_results(
    df: DataFrame, results: str, spec: list[dict], order: tuple[str, str] = ("ts", "seq")
) -> DataFrame:
    """Operation rows from a JSON result column.

    Each spec entry has ``key``, ``value`` and optionally ``disposable``. A value of the
    form ``results.a.b`` or ``results[0].a`` picks from the result; other text is literal.
    A path that is not there gives no row.
    """
    picks = []
    for entry in spec:
        value = entry["value"]
        if value.startswith(("results.", "results[")):
            col = F.get_json_object(F.col(results), "$" + value[len("results"):])
        else:
            col = F.lit(value)
        picks.append(
            F.struct(
                F.lit(entry["key"]).alias("field"),
                col.alias("value"),
                F.lit(bool(entry.get("disposable", False))).alias("disposable"),
            )
        )
    exploded = df.select(*ALERT_KEY, *order, F.explode(F.array(*picks)).alias("_p"))
    return exploded.filter(F.col("_p.value").isNotNull()).select(
        *ALERT_KEY, *order, "_p.field", "_p.value", "_p.disposable"
    )


def render(template: str, resolve=None) -> Column:
    """``{{ a.b }}`` parts replaced by the field's text, blank when missing."""
    resolve = resolve or (lambda path: F.col(paths.split_path(path)[0]))
    parts: list[Column] = []
    rest = template
    while "{{" in rest and "}}" in rest:
        before, _, tail = rest.partition("{{")
        name, _, rest = tail.partition("}}")
        if before:
            parts.append(F.lit(before))
        parts.append(F.coalesce(resolve(name.strip()).cast("string"), F.lit("")))
    if rest:
        parts.append(F.lit(rest))
    return F.concat(*parts) if parts else F.lit("")

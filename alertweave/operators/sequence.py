"""Per-fingerprint sequence features. Rows of a key are ordered by (ts, alert_id)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertweave.operators.scan import (
    ALERT_KEY,
    ALERT_ORDER,
    MAX_ROWS,
    Scan,
    first_before,
    lag_struct,
    run_scans,
    running_last,
    segment_first,
    since_reset,
)


def is_status(word: str) -> Column:
    return F.coalesce(F.col("status") == word, F.lit(False))


def firing_start_scan() -> Scan:
    """Start of the current run of firing alerts; null on other alerts."""
    return segment_first("firing_start", ~is_status("firing"), F.col("ts"))


def firing_since_resolved_scan() -> Scan:
    """First non-resolved alert after the last resolved one, if that alert was firing."""
    value = F.when(is_status("firing"), F.col("ts"))
    return segment_first("firing_since_resolved", is_status("resolved"), value)


def firing_counter_scan() -> Scan:
    return since_reset("firing_counter", is_status("acknowledged"))


def unresolved_counter_scan() -> Scan:
    return since_reset("unresolved_counter", is_status("resolved"))


def started_at_scan() -> Scan:
    """First time of the key as known before the current alert."""
    return first_before("started_at", F.col("ts"))


def with_sequence_features(
    alerts: DataFrame, max_rows: int = MAX_ROWS
) -> DataFrame:
    """All counters and start times in one pass."""
    scans = [
        firing_start_scan(),
        firing_since_resolved_scan(),
        firing_counter_scan(),
        unresolved_counter_scan(),
        started_at_scan(),
    ]
    return run_scans(alerts, scans, max_rows=max_rows)


def with_scans(
    alerts: DataFrame, *scans: Scan, max_rows: int = MAX_ROWS
) -> DataFrame:
    return run_scans(alerts, list(scans), max_rows=max_rows)


def latest_alerts(alerts: DataFrame) -> DataFrame:
    """Latest id, time, hash and status and first time per key; map-side combined."""
    latest = F.max_by(
        F.struct("alert_id", "ts", "content_hash", "status"), F.struct(*ALERT_ORDER)
    )
    grouped = alerts.groupBy(*ALERT_KEY).agg(
        latest.alias("_l"), F.min("ts").alias("first_ts")
    )
    return grouped.select(
        *ALERT_KEY,
        F.col("_l.alert_id").alias("alert_id"),
        F.col("_l.ts").alias("ts"),
        F.col("_l.content_hash").alias("content_hash"),
        F.col("_l.status").alias("status"),
        "first_ts",
    )


def previous_alert(
    alerts: DataFrame, status: str | None = None, max_rows: int = MAX_ROWS
) -> DataFrame:
    """Id, time and status of the key's previous alert, optionally the previous one that
    had a given status."""
    fields = {"alert_id": F.col("alert_id"), "ts": F.col("ts"), "status": F.col("status")}
    if status is None:
        scan = lag_struct("_previous", fields)
    else:
        kept = F.when(is_status(status), F.struct(*[c.alias(n) for n, c in fields.items()]))
        scan = _exclusive_last("_previous", kept)
    out = with_scans(alerts, scan, max_rows=max_rows)
    return out.select(
        *alerts.columns,
        F.col("_previous.alert_id").alias("previous_id"),
        F.col("_previous.ts").alias("previous_ts"),
        F.col("_previous.status").alias("previous_status"),
    )


def _exclusive_last(name: str, value: Column) -> Scan:
    """Newest non-null value strictly before each row."""
    base = running_last(name, value)

    def local(w, run):
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        return [{f"_{name}_l": F.last(value, ignorenulls=True).over(before)}]

    return Scan(local, base.summary, base.carry, base.final, base.carried)


def carry_assignee(
    alerts: DataFrame, assignee: str, max_rows: int = MAX_ROWS
) -> DataFrame:
    """The newest assignee set at or before an alert goes with it, unless it is resolved."""
    scan = running_last("_carried", F.col(assignee))
    out = with_scans(alerts, scan, max_rows=max_rows)
    own = F.col(assignee)
    carried = F.when(~is_status("resolved"), F.coalesce(own, F.col("_carried"))).otherwise(own)
    return out.withColumn("carried_assignee", carried).drop("_carried")


def running_number(incidents: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Per-tenant sequence number by (creation_time, incident_id)."""
    scan = since_reset("running_number", F.lit(False))
    return run_scans(
        incidents,
        [scan],
        keys=("tenant_id",),
        order=("creation_time", "incident_id"),
        max_rows=max_rows,
    )

"""Maintenance windows: silencing and recovery."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertweave.functions.predicates import attach_tests
from alertweave.operators import enrich

MAINTENANCE = "maintenance"
SUPPRESSED = "suppressed"
RECOVER = "recover_previous_status"
# windows by predicate number and tenant
WINDOW_TABLE = (
    "map<string,array<struct<window_id:int,start:timestamp,end:timestamp,"
    "ignored:array<string>>>>"
)


@dataclass(frozen=True)
class MaintenanceWindow:
    window_id: int
    tenant_id: str
    name: str
    start: str
    end: str
    predicate: str
    suppress: bool = False
    enabled: bool = True
    ignore_statuses: tuple[str, ...] = field(default=())


def _held_by(
    alerts: DataFrame,
    windows: list[MaintenanceWindow],
    test: Callable[[Column], Column],
) -> DataFrame:
    """Add ``_held``, the ids of the windows whose tenant, predicate and ``test`` hold.

    The windows are one constant, so there is neither join nor shuffle, whatever their
    number, and a row needs no id. An alert meets only the windows of its tenant whose
    predicate it matches.
    """
    rows, tests = attach_tests(alerts, [w.predicate for w in windows])
    numbers = {p: i for i, p in enumerate(tests)}
    table: dict[str, list[dict]] = {}
    for w in windows:
        row = {
            "window_id": w.window_id,
            "start": w.start,
            "end": w.end,
            "ignored": list(w.ignore_statuses),
        }
        table.setdefault(f"{numbers[w.predicate]}/{w.tenant_id}", []).append(row)
    windows_of = F.from_json(F.lit(json.dumps(table)), WINDOW_TABLE)
    which = F.array_compact(
        F.array(*[F.when(t, F.lit(str(i))) for i, t in enumerate(tests.values())])
    )
    lists = F.transform(
        which,
        lambda i: F.try_element_at(windows_of, F.concat(i, F.lit("/"), F.col("tenant_id"))),
    )
    met = F.filter(F.flatten(F.array_compact(lists)), test)
    held = F.transform(met, lambda w: w["window_id"])
    return rows.withColumn("_held", held).select(*alerts.columns, "_held")


def first_window(alerts: DataFrame, windows: list[MaintenanceWindow]) -> DataFrame:
    """Add ``window_id``, the smallest id of an enabled window the alert falls into.

    An alert without a status has none that a window ignores.
    """
    enabled = [w for w in windows if w.enabled]
    if not enabled:
        return alerts.withColumn("window_id", F.lit(None).cast("int"))
    ts = F.col("ts")

    def inside(w: Column) -> Column:
        ignored = F.coalesce(F.array_contains(w["ignored"], F.col("status")), F.lit(False))
        return (ts >= w["start"]) & (ts < w["end"]) & ~ignored

    held = _held_by(alerts, enabled, inside)
    return held.withColumn("window_id", F.array_min("_held")).drop("_held")


def _by_window(windows: list[MaintenanceWindow], value, type_: str) -> Column:
    values = json.dumps({str(w.window_id): value(w) for w in windows})
    table = F.from_json(F.lit(values), f"map<string,{type_}>")
    return F.try_element_at(table, F.col("window_id").cast("string"))


def apply_maintenance(
    alerts: DataFrame,
    windows: list[MaintenanceWindow],
    strategy: str = "default",
) -> tuple[DataFrame, DataFrame]:
    """Kept alerts and audit rows of the silenced ones.

    A suppressing window keeps the alert as ``suppressed``, or under the recovery strategy
    as ``maintenance`` with its previous status; any other window drops it.
    """
    marked = first_window(alerts, windows)
    ids = [w for w in windows if w.enabled]
    if not ids:
        empty = marked.filter(F.lit(False))
        audit = enrich.audit_rows(empty, F.lit(""), F.lit(""), F.lit(""))
        return marked.withColumn("previous_status", F.lit(None).cast("string")), audit
    suppress = F.coalesce(_by_window(ids, lambda w: w.suppress, "boolean"), F.lit(False))
    hit = F.col("window_id").isNotNull()
    word = MAINTENANCE if strategy == RECOVER else SUPPRESSED
    before = F.when(suppress, F.col("status")) if strategy == RECOVER else F.lit(None)
    kept = marked.filter(~hit | suppress).withColumns(
        {
            "previous_status": before.cast("string"),
            "status": F.when(suppress, F.lit(word)).otherwise(F.col("status")),
        }
    )
    name = _by_window(ids, lambda w: w.name, "string")
    text = F.concat(
        F.when(suppress, F.lit("Alert suppressed due to maintenance rule `")).otherwise(
            F.lit("Alert in maintenance due to rule `")
        ),
        name,
        F.lit("`"),
    )
    audit = enrich.audit_rows(
        marked.filter(hit), F.lit(enrich.IN_MAINTENANCE), text, F.lit("system")
    )
    return kept, audit


def recover_maintenance(
    alerts: DataFrame, windows: list[MaintenanceWindow], as_of: Column
) -> DataFrame:
    """Alerts in maintenance with ``maintenance_trace`` (windows that still hold them) and
    ``recovered``; a recovered one swaps its status with the previous one."""
    inside = alerts.filter(F.col("status") == MAINTENANCE)
    ts = F.col("ts")

    def holds(w: Column) -> Column:
        return (ts > w["start"]) & (ts < w["end"]) & (w["end"] > as_of)

    enabled = [w for w in windows if w.enabled]
    if enabled:
        held = _held_by(inside, enabled, holds)
        traced = held.withColumn("maintenance_trace", F.array_sort("_held")).drop("_held")
    else:
        traced = inside.withColumn("maintenance_trace", F.array().cast("array<int>"))
    free = F.size("maintenance_trace") == 0
    status, before = F.col("status"), F.col("previous_status")
    return traced.withColumn("recovered", free).withColumns(
        {
            "status": F.when(free, before).otherwise(status),
            "previous_status": F.when(free, status).otherwise(before),
        }
    )


def skip_maintenance(alerts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Alerts for correlation, and those in maintenance that bypass it."""
    held = F.coalesce(F.col("status") == MAINTENANCE, F.lit(False))
    return alerts.filter(~held), alerts.filter(held)


def silenced_per_window(audit_source: DataFrame) -> DataFrame:
    """Silenced alerts counted per tenant and window."""
    return (
        audit_source.filter(F.col("window_id").isNotNull())
        .groupBy("tenant_id", "window_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )

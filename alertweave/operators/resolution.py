"""Sessions that end early because the incident is resolved on the way.

``correlate.session_rows`` splits by time only. A rule that resolves when all its alerts
are resolved, or at a resolved alert, closes its incident inside such a session; the next
firing alert then opens another one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertweave.operators import correlate
from alertweave.operators.correlate import INCIDENT_KEY, CorrelationRule
from alertweave.operators.lineage import cut
from alertweave.operators.scan import (
    MAX_ROWS,
    following_first,
    max_before,
    run_scans,
    running_sum,
)

SESSION = (*INCIDENT_KEY, "session_no")
ALL, LAST = "all_resolved", "last_resolved"
FAR = "9999-12-31 00:00:00"


def sessions_with_resolution(
    keyed: DataFrame, rules: list[CorrelationRule], max_rows: int = MAX_ROWS
) -> DataFrame:
    """Alerts of incidents under each rule's resolve policy; ``part_no`` counts the
    incidents of a time session.

    ``never`` keeps the session whole. ``last_resolved`` ends a part at each resolved
    alert. ``all_resolved`` ends it when every key that came in the part is resolved.
    ``first_resolved`` is left whole here; its status is set by ``resolve_incidents``. The
    status of a key is that of its matched alerts.
    """
    rows = cut(correlate.session_rows(keyed, rules, max_rows).drop("opened"))
    policy = correlate.rule_value(rules, lambda r: r.resolve_on, "string")
    whole = rows.filter(~policy.isin(ALL, LAST)).withColumn("part_no", F.lit(0).cast("long"))
    parts = whole.unionByName(_last_parts(rows.filter(policy == LAST), max_rows))
    if any(r.resolve_on == ALL for r in correlate.active_rules(rules)):
        split = _all_parts(rows.filter(policy == ALL), max_rows)
        parts = parts.unionByName(split)
    return _opened(parts)


def _is(word: str) -> Column:
    return F.coalesce(F.col("status") == word, F.lit(False))


def _firsts(parts: DataFrame) -> DataFrame:
    """First firing alert of each part; parts without one never open."""
    at = F.struct("ts", "alert_id")
    return parts.groupBy(*SESSION, "part_no").agg(
        F.min(F.when(_is("firing"), at)).alias("_first")
    )


def _opened(parts: DataFrame) -> DataFrame:
    joined = parts.join(_firsts(parts), [*SESSION, "part_no"])
    open_rows = joined.filter(F.struct("ts", "alert_id") >= F.col("_first")).drop("_first")
    incident = F.concat_ws("/", *INCIDENT_KEY, F.concat_ws(".", "session_no", "part_no"))
    return open_rows.withColumn("incident_id", incident)


def _last_parts(rows: DataFrame, max_rows: int) -> DataFrame:
    resolved = _is("resolved").cast("int")
    out = run_scans(
        rows, [running_sum("_done", resolved)], keys=SESSION, max_rows=max_rows
    )
    # the resolved alert itself still belongs to the part it ends
    return out.withColumn("part_no", (F.col("_done") - resolved).cast("long")).drop("_done")


def _all_parts(rows: DataFrame, max_rows: int) -> DataFrame:
    """An unresolved alert covers the time until its key is resolved; parts are the
    stretches without uncovered time.

    An alert that comes before the first firing one of its stretch is not part of an
    incident and covers nothing. Leaving such alerts out may split a stretch further, so
    this repeats until there are none; each round handles all sessions at once.
    """
    at = F.struct("ts", "alert_id")
    ended = following_first("_end", F.when(_is("resolved"), at))
    never = F.struct(F.lit(FAR).cast("timestamp").alias("ts"), F.col("alert_id"))
    timed = run_scans(
        rows, [ended], keys=(*SESSION, "fingerprint"), max_rows=max_rows
    ).withColumns({"_end": F.coalesce("_end", never), "_out": F.lit(False)})
    current = cut(timed)
    while True:
        counts = ~_is("resolved") & ~F.col("_out")
        covered = run_scans(
            current,
            [max_before("_cover", F.when(counts, F.col("_end")))],
            keys=SESSION,
            max_rows=max_rows,
        )
        starts = F.coalesce((F.col("_cover") < at).cast("int"), F.lit(1))
        parts = cut(
            run_scans(
                covered.withColumn("_start", starts),
                [running_sum("part_no", F.col("_start"))],
                keys=SESSION,
                max_rows=max_rows,
            ).drop("_cover", "_start")
        )
        marked = parts.join(_firsts(parts), [*SESSION, "part_no"]).withColumn(
            "_early", F.coalesce(at < F.col("_first"), F.lit(True)) & counts
        )
        if marked.filter("_early").isEmpty():
            break
        current = cut(
            marked.withColumn("_out", F.col("_out") | F.col("_early")).drop(
                "part_no", "_first", "_early"
            )
        )
    return parts.withColumn("part_no", F.col("part_no").cast("long")).drop("_end", "_out")

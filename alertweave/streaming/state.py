"""Per-key state across micro-batches.

A micro-batch runs through the same scans as a batch job; what it cannot know,
the state of each key before it, is one row per key joined in. A hot key is therefore
split here too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertweave.operators import correlate, sequence
from alertweave.operators.scan import (
    ALERT_KEY,
    MAX_ROWS,
    lag_struct,
    run_scans,
    running_sum,
)
from alertweave.operators.sequence import is_status

KEY_STATE = (
    "tenant_id string, fingerprint string, alert_id long, ts timestamp, "
    "content_hash string, status string, first_ts timestamp, firing_counter long, "
    "unresolved_counter long, firing_start timestamp, firing_since_resolved timestamp"
)
SESSION_STATE = (
    "tenant_id string, rule_id string, group_key string, start_ts timestamp, "
    "last_ts timestamp, session_no long, max_no long, "
    "fired struct<ts:timestamp,alert_id:long>"
)


def _with_state(rows: DataFrame, state: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Left join of the state, its columns prefixed with ``p_``; null is a key like any other."""
    rest = [F.col(c).alias(f"p_{c}") for c in state.columns if c not in keys]
    right = state.select(*rest, F.struct(*keys).alias("_state_key"))
    return rows.join(right, F.struct(*keys) == F.col("_state_key"), "left").drop("_state_key")


def classify_with_state(
    batch: DataFrame, state: DataFrame, max_rows: int | None = MAX_ROWS
) -> DataFrame:
    """``dedup_type`` against the previous row of the batch, else the key's state."""
    scan = lag_struct("_before", {"h": F.col("content_hash")})
    rows = _with_state(
        run_scans(batch, [scan], max_rows=max_rows),
        state.select(*ALERT_KEY, "content_hash"),
        ALERT_KEY,
    )
    before = F.coalesce(F.col("_before.h"), F.col("p_content_hash"))
    kind = (
        F.when(before.isNull(), "none")
        .when(before == F.col("content_hash"), "full")
        .otherwise("partial")
    )
    return rows.withColumn("dedup_type", kind).drop("_before", "p_content_hash")


def features_with_state(
    batch: DataFrame,
    state: DataFrame,
    max_rows: int | None = MAX_ROWS,
    parts: tuple[str, ...] = (),
) -> DataFrame:
    """Counters and start times that continue from the key's state.

    A value of the batch alone is complete once the batch holds a reset of that value for
    the key; until then the state adds to it or replaces it. Rows of a key that differ in the
    columns ``parts`` do not count for each other.
    """
    resets = {
        "_acked": is_status("acknowledged"),
        "_resolved": is_status("resolved"),
        "_stopped": ~is_status("firing"),
    }
    scans = [
        sequence.firing_start_scan(),
        sequence.firing_since_resolved_scan(),
        sequence.firing_counter_scan(),
        sequence.unresolved_counter_scan(),
        sequence.started_at_scan(),
        *[running_sum(n, c.cast("int")) for n, c in resets.items()],
    ]
    rows = _with_state(
        run_scans(batch, scans, (*ALERT_KEY, *parts), max_rows=max_rows),
        state.drop("alert_id", "content_hash"),
        ALERT_KEY,
    )

    def counter(name: str, seen: str) -> Column:
        carried = F.when(F.col(seen) == 0, F.coalesce(f"p_{name}", F.lit(0))).otherwise(0)
        return F.col(name) + carried

    def start(name: str, seen: str, continues: Column) -> Column:
        goes_on = (F.col(seen) == 0) & F.coalesce(continues, F.lit(False))
        return F.when(goes_on, F.col(f"p_{name}")).otherwise(F.col(name))

    known = F.col("p_status")
    out = rows.withColumns(
        {
            "firing_counter": counter("firing_counter", "_acked"),
            "unresolved_counter": counter("unresolved_counter", "_resolved"),
            "firing_start": start("firing_start", "_stopped", known == "firing"),
            "firing_since_resolved": start(
                "firing_since_resolved", "_resolved", known != "resolved"
            ),
            "started_at": F.coalesce("p_first_ts", "started_at"),
        }
    )
    return out.drop(*resets, *[c for c in out.columns if c.startswith("p_")])


def next_key_state(state: DataFrame, rows: DataFrame) -> DataFrame:
    """State after a batch: the newest row per key; an older one never replaces a newer."""
    rest = [c for c in state.columns if c not in (*ALERT_KEY, "first_ts")]
    new = rows.select(*ALERT_KEY, F.col("ts").alias("first_ts"), *rest)
    both = state.select(*new.columns).unionByName(new)
    return (
        both.groupBy(*ALERT_KEY)
        .agg(
            F.min("first_ts").alias("first_ts"),
            F.max_by(F.struct(*rest), F.struct("ts", "alert_id")).alias("_row"),
        )
        .select(*ALERT_KEY, "first_ts", *[F.col(f"_row.{c}").alias(c) for c in rest])
        .select(*state.columns)
    )


def sessions_with_state(
    keyed: DataFrame,
    rules: list[correlate.CorrelationRule],
    state: DataFrame,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """All matched rows of a batch with their session number and ``opened``.

    A session of the batch goes on with the key's open session if the gap between the two,
    on either side, is within the timeframe; any other one gets the key's next number, in
    order of time. So late rows widen the open session or stand for themselves: the state
    holds no closed sessions, and late rows do not join two that were apart.
    """
    keys = correlate.INCIDENT_KEY
    at = F.struct("ts", "alert_id")
    rows = correlate.session_rows(keyed, rules, max_rows)
    own = rows.groupBy(*keys, "session_no").agg(
        F.min("ts").alias("_from"),
        F.max("ts").alias("_to"),
        F.first("timeframe_s").alias("_limit"),
        F.min(F.when(F.col("opened"), at)).alias("_fire"),
    )
    met = _with_state(own, state.withColumnRenamed("session_no", "open_no"), keys)

    def near(later: str, earlier: str) -> Column:
        gap = F.unix_micros(later) - F.unix_micros(earlier)
        return F.coalesce(gap <= F.col("_limit").cast("long") * 1_000_000, F.lit(False))

    met = met.withColumn("_goes_on", near("_from", "p_last_ts") & near("p_start_ts", "_to"))
    whole = Window.partitionBy(*keys)
    so_far = whole.orderBy("session_no").rowsBetween(Window.unboundedPreceding, 0)
    new = F.sum((~F.col("_goes_on")).cast("int")).over(so_far)
    fired = F.min(F.when(F.col("_goes_on"), F.col("_fire"))).over(whole)
    session = F.struct(*keys, "session_no")
    met = met.select(
        session.alias("_session"),
        F.when(F.col("_goes_on"), F.col("p_open_no"))
        .otherwise(F.coalesce("p_max_no", F.lit(-1)) + new)
        .alias("_no"),
        F.when(F.col("_goes_on"), F.least("p_fired", fired)).alias("_fired"),
    )
    return (
        rows.join(met, session == F.col("_session"))
        .withColumns(
            {
                "opened": F.col("opened") | F.coalesce(at >= F.col("_fired"), F.lit(False)),
                "session_no": F.col("_no"),
            }
        )
        .drop("_no", "_fired", "_session")
    )


def next_session_state(state: DataFrame, placed: DataFrame) -> DataFrame:
    """Session state after a batch: the session of each key that reaches furthest, since
    when it is open, and the largest number given. Late rows never take it back."""
    keys = correlate.INCIDENT_KEY
    rest = ("start_ts", "last_ts", "session_no", "fired")
    seen = placed.select(
        *keys,
        "session_no",
        F.col("session_no").alias("max_no"),
        F.col("ts").alias("start_ts"),
        F.col("ts").alias("last_ts"),
        F.when(F.col("opened"), F.struct("ts", "alert_id")).alias("fired"),
    )
    sessions = (
        state.unionByName(seen.select(*state.columns))
        .groupBy(*keys, "session_no")
        .agg(
            F.min("start_ts").alias("start_ts"),
            F.max("last_ts").alias("last_ts"),
            F.max("max_no").alias("max_no"),
            F.min("fired").alias("fired"),
        )
    )
    return (
        sessions.groupBy(*keys)
        .agg(
            F.max("max_no").alias("max_no"),
            F.max_by(F.struct(*rest), F.struct("last_ts", "session_no")).alias("_s"),
        )
        .select(*keys, "max_no", *[F.col(f"_s.{c}").alias(c) for c in rest])
        .select(*state.columns)
    )

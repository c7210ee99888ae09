"""Deduplication: rules, classes and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertweave.operators.scan import MAX_ROWS, lag_struct, run_scans, running_sum

# fixed values
NO_PROVIDER = "unknown"
DEFAULT_IGNORE = "lastReceived"
HOURS = 24


def default_rule_id(provider_id: Column, provider_type: Column) -> Column:
    """Stable id of the generated default rule of a provider."""
    anonymous = provider_id.isNull() & (F.lower(provider_type) == NO_PROVIDER)
    kind = F.when(anonymous, F.lit("None")).otherwise(provider_type)
    text = F.concat_ws("_", F.coalesce(provider_id, F.lit("None")), kind)
    return F.sha2(text, 256)


def attach_dedup_rule(events: DataFrame, rules: DataFrame) -> DataFrame:
    """The enabled custom rule of (tenant, provider id, provider type), else the default.

    ``rules`` holds one row per rule with ``ignore_fields`` as an array. A rule without
    full deduplication gets the default ignore list. Two rules of one provider: the
    smallest id wins, so the join never fans out.
    """
    kind = F.coalesce(F.nullif(F.col("provider_type"), F.lit("")), F.lit(NO_PROVIDER))
    one = (
        rules.filter("enabled")
        .groupBy("tenant_id", "provider_id", "provider_type")
        .agg(
            F.min_by(
                F.struct("rule_id", "full_deduplication", "ignore_fields"), F.col("rule_id")
            ).alias("_rule")
        )
        .select(
            F.col("tenant_id").alias("_t"),
            F.col("provider_id").alias("_p"),
            F.col("provider_type").alias("_k"),
            "_rule",
        )
    )
    joined = events.withColumn("_kind", kind).join(
        one,
        (F.col("tenant_id") == F.col("_t"))
        & F.col("provider_id").eqNullSafe(F.col("_p"))
        & (F.col("_kind") == F.col("_k")),
        "left",
    )
    custom = F.col("_rule").isNotNull()
    default_list = F.array(F.lit(DEFAULT_IGNORE))
    return joined.withColumns(
        {
            "dedup_rule_id": F.coalesce(
                F.col("_rule.rule_id"), default_rule_id(F.col("provider_id"), F.col("_kind"))
            ),
            "dedup_rule_default": ~custom,
            "dedup_ignore_fields": F.when(
                custom & F.col("_rule.full_deduplication"), F.col("_rule.ignore_fields")
            ).otherwise(default_list),
        }
    ).drop("_t", "_p", "_k", "_rule", "_kind")


def hash_by_rule(fields: dict[str, Column]) -> Column:
    """Content hash that leaves out the fields of the row's ``dedup_ignore_fields``."""
    ignored = F.col("dedup_ignore_fields")
    parts = [
        F.when(F.array_contains(ignored, n), F.lit("\u0002")).otherwise(
            F.coalesce(c.cast("string"), F.lit("\u0001"))
        )
        for n, c in sorted(fields.items())
    ]
    return F.sha2(F.concat_ws("|", *parts), 256)


def classify_duplicates(
    alerts: DataFrame, hash_col: str = "content_hash", max_rows: int = MAX_ROWS
) -> DataFrame:
    """``dedup_type``: full (same hash as the key's previous alert), partial (the key is
    known with another hash) or none."""
    scan = lag_struct("_before", {"h": F.col(hash_col)})
    out = run_scans(alerts, [scan], max_rows=max_rows)
    before = F.col("_before")
    kind = (
        F.when(before.isNull(), "none")
        .when(before.getField("h") == F.col(hash_col), "full")
        .otherwise("partial")
    )
    return out.withColumn("dedup_type", kind).drop("_before")


def drop_full_duplicates(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("dedup_type") != "full")


def touch_last_received(
    classified: DataFrame, max_rows: int = MAX_ROWS
) -> DataFrame:
    """Kept alerts; the full duplicates that follow one advance its last_received."""
    kept = (F.col("dedup_type") != "full").cast("int")
    grouped = run_scans(classified, [running_sum("_kept", kept)], max_rows=max_rows)
    order = F.struct("ts", "alert_id")
    return (
        grouped.groupBy("tenant_id", "fingerprint", "_kept")
        .agg(
            F.min_by("alert_id", order).alias("alert_id"),
            F.min("ts").alias("ts"),
            F.max("ts").alias("last_received"),
            F.count(F.lit(1)).alias("n_received"),
        )
        .drop("_kept")
    )


def dedup_counts(dedup_events: DataFrame) -> DataFrame:
    """Full, partial and none counts by rule and provider."""
    kind = F.coalesce(F.nullif(F.col("provider_type"), F.lit("")), F.lit(NO_PROVIDER))
    return dedup_events.groupBy(
        "dedup_rule_id", "provider_id", kind.alias("provider_type")
    ).agg(
        *[
            F.count_if(F.col("dedup_type") == t).alias(f"{t}_count")
            for t in ("full", "partial", "none")
        ]
    )


def dedup_hourly(dedup_events: DataFrame, as_of: Column) -> DataFrame:
    """24 dense hourly counts per rule, up to the hour of ``as_of``.

    The events are counted by (rule, hour) first; the spine is joined to the few rules.
    """
    last = F.date_trunc("hour", as_of)
    hours = dedup_events.select("dedup_rule_id", F.date_trunc("hour", "ts").alias("hour"))
    first = last - F.make_interval(hours=F.lit(HOURS - 1))
    counts = (
        hours.filter(F.col("hour").between(first, last))
        .groupBy("dedup_rule_id", "hour")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    step = F.expr("interval 1 hour")
    spine = (
        dedup_events.select("dedup_rule_id")
        .distinct()
        .withColumn("hour", F.explode(F.sequence(first, last, step)))
    )
    return spine.join(counts, ["dedup_rule_id", "hour"], "left").select(
        "dedup_rule_id", "hour", F.coalesce("n", F.lit(0)).alias("n")
    )


def dedup_report(rules: DataFrame, counts: DataFrame) -> DataFrame:
    """Per rule: ingested, duplicate ratio in percent; default rules first; empty when the
    only rule is an unused default."""
    totals = counts.groupBy("dedup_rule_id").agg(
        *[F.sum(f"{t}_count").alias(f"{t}_count") for t in ("full", "partial", "none")]
    )
    joined = rules.join(totals, "dedup_rule_id", "left").na.fill(
        0, ["full_count", "partial_count", "none_count"]
    )
    dup = F.col("full_count") + F.col("partial_count")
    ingested = dup + F.col("none_count")
    report = joined.withColumns(
        {
            "ingested": ingested,
            "dedup_ratio": F.coalesce(
                F.try_divide(dup * F.lit(100.0), ingested), F.lit(0.0)
            ),
        }
    )
    # the empty state: one default rule that never saw an alert
    n_rules = rules.agg(F.count(F.lit(1))).scalar()
    kept = report.filter((n_rules > 1) | (F.col("ingested") > 0))
    # one row per rule: a range sort would run the whole plan once more to sample it
    return kept.repartition(1).sortWithinPartitions(
        F.col("is_default").desc(), "dedup_rule_id"
    )

"""Watermarked windows and the keyed throttle on streams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from alertweave.operators.correlate import INCIDENT_KEY, CorrelationRule, active_rules
from alertweave.operators.throttle import INTERVAL_SECONDS, MICROS, passed_since

ROCKSDB = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def tumbling_counts(
    stream: DataFrame, keys: list[str], window: str = "1 hour", delay: str = "1 hour"
) -> DataFrame:
    """Counts per key and tumbling window; combined on the map side before the shuffle."""
    timed = stream.withWatermark("ts", delay) if stream.isStreaming else stream
    grouped = timed.groupBy(F.window("ts", window).alias("_w"), *keys)
    return grouped.agg(F.count(F.lit(1)).alias("n")).select(
        F.col("_w.start").alias("hour"), *keys, "n"
    )


def session_gap(rules: list[CorrelationRule]) -> Column:
    """The timeframe of the row's rule as the gap of its session window."""
    gap = F.lit("0 seconds")
    for rule in active_rules(rules):
        own = F.lit(f"{rule.timeframe_s} seconds")
        gap = F.when(F.col("rule_id") == rule.rule_id, own).otherwise(gap)
    return gap


def session_windows(
    keyed: DataFrame, rules: list[CorrelationRule], delay: str = "1 day"
) -> DataFrame:
    """Sessions per (tenant, rule, key) as native session windows, with the first firing
    alert; rows of a session that never fired are to be left out by the reader."""
    timed = keyed.withWatermark("ts", delay) if keyed.isStreaming else keyed
    window = F.session_window("ts", session_gap(rules)).alias("_w")
    return (
        timed.groupBy(window, *INCIDENT_KEY)
        .agg(
            F.count(F.lit(1)).alias("n"),
            # not the window's start: Catalyst would push a filter on it below the merging
            F.min("ts").alias("first_ts"),
            F.min(F.when(F.col("status") == "firing", F.col("ts"))).alias("opened_at"),
            F.max("ts").alias("last_ts"),
        )
        .select(*INCIDENT_KEY, "first_ts", "opened_at", "last_ts", "n")
    )


class ThrottleProcessor(StatefulProcessor):
    """Per key, one number: the time from which the key may notify again."""

    def __init__(self, interval: int):
        self.interval = interval

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ready = handle.getValueState("ready", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before = int(self.ready.get()[0]) if self.ready.exists() else np.iinfo(np.int64).min
        out, after = passed_since(rows, before, self.interval)
        self.ready.update((after,))
        yield out

    def close(self) -> None:
        pass


def throttle_stream(
    stream: DataFrame, keys: list[str], interval_seconds: int = INTERVAL_SECONDS
) -> DataFrame:
    """Events (keys, ts, id) that pass the throttle, across micro-batches.

    Only time and id of an event reach Python, and one micro-batch bounds what a key can
    bring at once; limit it with the source's options.
    """
    narrow = stream.select(*keys, "ts", "id")
    processor = ThrottleProcessor(interval_seconds * MICROS)
    return narrow.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=T.StructType(narrow.schema.fields),
        outputMode="Append",
        timeMode="None",
    )

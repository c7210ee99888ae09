"""At most one event per key and interval, greedily from the first one."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertweave.operators.scan import chunk_of

MICROS = 1_000_000
# fixed value: seconds between two notifications of a key
INTERVAL_SECONDS = 15
CHUNK_SECONDS = 300


def emitted(ts: np.ndarray, ready: int, interval: int) -> list[int]:
    """Positions of the emitted events of a sorted run that may emit from ``ready`` on."""
    out = []
    at = int(np.searchsorted(ts, ready))
    while at < len(ts):
        out.append(at)
        at = int(np.searchsorted(ts, ts[at] + interval))
    return out


def chunk_exits(ts: np.ndarray, start: int, interval: int) -> tuple[list[int], list[int]]:
    """For each event that can be the first one emitted in a chunk, the last one emitted.

    Only events up to the first one an interval into the chunk can be first. Entries with
    the same exit are merged into the latest of them. Every event points to the one emitted
    after it; following all pointers at once, twice as far each time, leads to the exits.
    """
    after = np.searchsorted(ts, ts + interval)
    last = np.where(after < len(ts), after, np.arange(len(ts)))
    while not np.array_equal(further := last[last], last):
        last = further
    last_entry = int(np.searchsorted(ts, start + interval))
    entries = ts[: last_entry + 1]
    exits = ts[last[: last_entry + 1]]
    keep = np.append(exits[1:] != exits[:-1], True)
    return entries[keep].tolist(), exits[keep].tolist()


# the columns that stand for the keys, and that mark the first row of a group
KEY = "_throttle_key"
FIRST = "_first"


def marked(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Rows dealt by ``by`` and in order, with a mark at the first one of each group.

    Spark compares the values, so that any type of key, null included, is told apart exactly.
    """
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn(FIRST, place == 1).sortWithinPartitions(*by, *order)


def marked_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The groups of a partition of ``marked`` rows, each whole, also across batches."""
    pending: list[pa.RecordBatch] = []
    for batch in batches:
        starts = np.flatnonzero(batch.column(FIRST).to_numpy(zero_copy_only=False)).tolist()
        edges, first = [0, *starts, batch.num_rows], set(starts)
        for start, end in zip(edges, edges[1:]):
            if pending and end > start and start in first:
                yield pa.Table.from_batches(pending)
                pending = []
            if end > start:
                pending.append(batch.slice(start, end - start))
    if pending:
        yield pa.Table.from_batches(pending)


def throttle(
    events: DataFrame,
    keys: list[str],
    interval_seconds: int = INTERVAL_SECONDS,
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """Events (keys, ts, id) that pass the throttle; null is a key value like any other.

    Which event passes depends on all before it, so the rows of a key are cut into time
    chunks: each chunk is reduced to the few pairs (first passed, last passed) it can have,
    the pairs of a key are walked in order to find the time each chunk starts from, and
    the chunks are then evaluated side by side. Events at one instant are one, with the least
    id; events without a time never pass. Keys may be of any type that can be grouped by, and
    come back as they are.
    """
    if chunk_seconds < interval_seconds:
        raise ValueError("a chunk must be at least as long as the interval")
    # a struct is never null itself, so it joins by equality
    named = events.filter("ts is not null").select(F.struct(*keys).alias(KEY), "ts", "id")
    found = _throttle(named, interval_seconds * MICROS, chunk_seconds)
    return found.select(*[F.col(f"{KEY}.`{k}`").alias(k) for k in keys], "ts", "id")


def _throttle(events: DataFrame, interval: int, chunk_seconds: int) -> DataFrame:
    span = chunk_seconds * MICROS
    group = [KEY, "chunk"]
    key_type = events.schema[KEY]
    instants = (
        events.groupBy(KEY, "ts")
        .agg(F.min("id").alias("id"))
        .withColumns({"chunk": chunk_of("ts", chunk_seconds), "at": F.unix_micros("ts")})
    )

    def exits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in marked_groups(batches):
            chunk = part.column("chunk")[0].as_py()
            first, last = chunk_exits(part.column("at").to_numpy(), chunk * span, interval)
            n = len(first)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(KEY).take(pa.array([0] * n)).combine_chunks(),
                    *[pa.array(c, pa.int64()) for c in ([chunk] * n, first, last)],
                ],
                [*group, "entry", "exit"],
            )

    def starts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in marked_groups(batches):
            chunks, entries, exits = (part.column(c).to_numpy() for c in ("chunk", "entry", "exit"))
            edges = np.flatnonzero(np.diff(chunks, prepend=chunks[0] - 1)).tolist()
            ready, readies = int(np.iinfo(np.int64).min), []
            for start, end in zip(edges, [*edges[1:], len(chunks)]):
                readies.append(ready)
                at = start + int(np.searchsorted(entries[start:end], ready))
                if at < end:
                    ready = int(exits[at]) + interval
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(KEY).take(pa.array(edges)).combine_chunks(),
                    pa.array(chunks[edges], pa.int64()),
                    pa.array(readies, pa.int64()),
                ],
                [*group, "ready"],
            )

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in marked_groups(batches):
            ready = part.column("ready")[0].as_py()
            kept = emitted(part.column("at").to_numpy(), ready, interval)
            yield from part.select([KEY, "ts", "id"]).take(pa.array(kept, pa.int64())).to_batches()

    pairs = marked(instants.select(*group, "at"), group, ["at"]).mapInArrow(
        exits_of, T.StructType([key_type]).add("chunk", "long").add("entry", "long").add("exit", "long")
    )
    starts = marked(pairs, [KEY], ["chunk", "entry"]).mapInArrow(
        starts_of, T.StructType([key_type]).add("chunk", "long").add("ready", "long")
    )
    return marked(instants.join(starts, group), group, ["at"]).mapInArrow(
        passed, T.StructType([key_type, events.schema["ts"], events.schema["id"]])
    )


def passed_since(
    pdfs: Iterator[pd.DataFrame], ready: int, interval: int
) -> tuple[pd.DataFrame, int]:
    """Rows of one micro-batch of a key that pass, and the time the key is ready again."""
    rows = pd.concat(list(pdfs)).sort_values(["ts", "id"])
    at = rows["ts"].astype("datetime64[us]").astype("int64").to_numpy()
    kept = emitted(at, ready, interval)
    if kept:
        ready = int(at[kept[-1]]) + interval
    return rows.iloc[kept], ready

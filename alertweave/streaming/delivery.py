"""Delivery of micro-batches: retries with back-off, then only the failing messages aside.

A batch whose work fails is tried again a few times. If it goes on failing, its messages are
written once, spread by a hash of their content, and searched by halves of the hash range, so one
failing message among n costs about log2(n) trial runs, each of which reads its range only. The
messages found go to the output ``undelivered`` with their error; all others are processed as one
batch, in their order, so state and results are those of a batch without the failing messages.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertweave.streaming.store import Store

HASH = "_delivery_hash"
INCOMING = "incoming"
UNDELIVERED = "undelivered"
UNDELIVERED_SCHEMA = "raw string, error string"
ERROR_LENGTH = 2_000

# raises if the rows cannot be processed
Check = Callable[[DataFrame], None]


@dataclass(frozen=True)
class Delivery:
    """How a failing batch is treated.

    More than ``max_failures`` different failing messages of a batch are taken for an outage: the
    stream stops with ``DeliveryFailed``, nothing is set aside, and the batch is replayed when
    the stream starts again.
    """

    attempts: int = 3
    backoff_seconds: float = 1.0
    max_failures: int = 100
    sleep: Callable[[float], None] = time.sleep


class DeliveryFailed(RuntimeError):
    """A batch fails for a reason that is not one of its messages, or for too many of them."""


class Trial(Store):
    """A store that reads the snapshots of another one and writes to a folder of its own."""

    def __init__(self, base: Store, batch_id: int):
        super().__init__(base.spark, f"{base.path}/_trial/{batch_id}")
        self.base = base

    def snapshot(
        self, name: str, schema: T.StructType, before: int | None = None
    ) -> DataFrame:
        return self.base.snapshot(name, schema, before)

    def cut(self, rows: DataFrame) -> DataFrame:
        """The rows as a table of their own, in place of the one before.

        Spark may evaluate an expression that raises before the filter that leaves its row out;
        rows that are not in the table cannot raise.
        """
        path = f"{self.path}/rows"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)


def retried(work: Callable[[], None], policy: Delivery) -> None:
    """Run ``work`` up to ``attempts`` times; each pause is twice the one before.

    What the analyser refuses does not depend on rows or luck and is raised at once.
    """
    for attempt in range(1, policy.attempts + 1):
        try:
            work()
            return
        except AnalysisException:
            raise
        except Exception:
            if attempt == policy.attempts:
                raise
            policy.sleep(policy.backoff_seconds * 2 ** (attempt - 1))


def deliver(
    batch: DataFrame,
    batch_id: int,
    store: Store,
    work: Callable[[DataFrame, Store], None],
    policy: Delivery,
    checks: tuple[Check, ...] = (),
) -> None:
    """Run ``work(rows, store)`` on the batch, or on all of it that does not fail.

    ``checks`` are cheaper parts of the work, searched first. What they leave is processed for
    good; only if that fails too, or if they found nothing, is the whole work searched, on a
    ``Trial``. Equal messages share their fate. A message is set aside only if it fails alone. A
    replay of the batch replaces what it set aside before.
    """
    try:
        retried(lambda: work(batch, store), policy)
    except AnalysisException:
        raise
    except Exception:
        rows = spread(batch, store, batch_id)
        trial = Trial(store, batch_id)
        failed: dict[int, str] = {}
        for check in checks:
            failed |= _search(rows, failed, check, trial, policy)
        if not (failed and _done(lambda: _work_without(rows, failed, trial, work), policy)):
            failed |= _search(rows, failed, lambda part: work(part, trial), trial, policy)
            retried(lambda: _work_without(rows, failed, trial, work), policy)
        store.append(UNDELIVERED, _undelivered(store, batch_id, failed), batch_id)
    else:
        none = store.spark.createDataFrame([], UNDELIVERED_SCHEMA)
        store.append(UNDELIVERED, none, batch_id)


def _search(
    rows: DataFrame, failed: dict[int, str], check: Check, trial: Trial, policy: Delivery
) -> dict[int, str]:
    allowed = policy.max_failures - len(failed)
    return failing(without(rows, failed), check, allowed, trial.cut, whole=not failed)


def _work_without(
    rows: DataFrame,
    failed: dict[int, str],
    trial: Trial,
    work: Callable[[DataFrame, Store], None],
) -> None:
    work(trial.cut(without(rows, failed).drop(HASH)), trial.base)


def _done(work: Callable[[], None], policy: Delivery) -> bool:
    try:
        retried(work, policy)
    except AnalysisException:
        raise
    except Exception:
        return False
    return True


def spread(batch: DataFrame, store: Store, batch_id: int) -> DataFrame:
    """The batch as a table in order of the hash of its messages; a range reads its files only."""
    content = F.to_json(F.struct(*[F.col(f"`{c}`") for c in batch.columns]))
    hashed = batch.withColumn(HASH, F.xxhash64(content))
    ordered = hashed.repartitionByRange(HASH).sortWithinPartitions(HASH)
    store.append(INCOMING, ordered, batch_id)
    return _incoming(store, batch_id, ordered.schema)


def _incoming(store: Store, batch_id: int, schema: T.StructType | None = None) -> DataFrame:
    reader = store.spark.read if schema is None else store.spark.read.schema(schema)
    return reader.parquet(f"{store.path}/{INCOMING}/batch={batch_id}")


def failing(
    rows: DataFrame,
    check: Check,
    allowed: int,
    cut: Callable[[DataFrame], DataFrame] = lambda part: part,
    whole: bool = False,
) -> dict[int, str]:
    """Hash and error of every message on which ``check`` fails; ``cut`` parts rows from others.
    All rows of a table, ``whole``, have none to be parted from.
    """

    def error_of(part: DataFrame) -> str | None:
        try:
            alone = part.drop(HASH)
            check(alone if whole and part is rows else cut(alone))
        except AnalysisException:
            raise
        except Exception as error:
            return str(error)[:ERROR_LENGTH]
        return None

    found: dict[int, str] = {}
    # ranges that fail, or are taken to fail since the rest of their range does not
    todo: list[tuple[DataFrame, str]] = []
    first = error_of(rows)
    if first is not None:
        if error_of(rows.filter(F.lit(False))) is not None:
            raise DeliveryFailed(f"fails without messages: {first}")
        todo.append((rows, first))
    while todo:
        part, error = todo.pop()
        low, high = part.agg(F.min(HASH), F.max(HASH)).first()
        if low == high:
            own = error_of(part)
            if own is None:
                raise DeliveryFailed(f"messages fail together, but not alone: {error}")
            found[low] = own
            if len(found) > allowed:
                raise DeliveryFailed(f"over {allowed} failing messages, one of them: {own}")
            continue
        middle = (low + high) // 2
        left = rows.filter(F.col(HASH).between(low, middle))
        right = rows.filter(F.col(HASH).between(middle + 1, high))
        in_left = error_of(left)
        if in_left is None:
            todo.append((right, error))
            continue
        todo.append((left, in_left))
        in_right = error_of(right)
        if in_right is not None:
            todo.append((right, in_right))
    return found


def without(rows: DataFrame, found: dict[int, str]) -> DataFrame:
    return rows.filter(~F.col(HASH).isin(list(found))) if found else rows


def _undelivered(store: Store, batch_id: int, failed: dict[int, str]) -> DataFrame:
    """The messages set aside as JSON, one row for each time they came."""
    errors = store.spark.createDataFrame(list(failed.items()), f"{HASH} long, error string")
    rows = _incoming(store, batch_id)
    content = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != HASH]))
    return rows.join(F.broadcast(errors), HASH).select(content.alias("raw"), "error")

"""Ordered per-key scans that never put a hot key into one task.

A key with at most ``max_rows`` rows is one window group, as in any window. The rows of a key
with more are cut into slots of about that size, at places of the whole order, so that rows
at one instant are cut too. Each slot is reduced to one summary row, the summaries of a key are
scanned in order, and the value carried into a slot is added to its rows.

Keys are counted first, which reads the key columns only and combines before the shuffle. Places to
cut at and carried values are small tables, at most ``MAX_SLOTS`` rows and one for each hot key,
which are written once and broadcast. So the rows are read once and shuffled once, by key and
slot, whether there are hot keys or not; for hot keys alone their summaries are read ahead.

Several scans over the same key and order share one pass: ``run_scans``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from alertweave.operators.lineage import cut

SLOT = "_slot"
# the struct of the key columns, which is never null and compares null-safely
KEY = "_key"
# rows of a key that one task sorts
MAX_ROWS = 1_000_000
# slots of all hot keys together; with more rows than they hold, slots hold more
MAX_SLOTS = 100_000
# rows of a hot key that are looked at for each slot
SLOT_SAMPLE = 16
ALERT_KEY = ("tenant_id", "fingerprint")
ALERT_ORDER = ("ts", "alert_id")

Cols = dict[str, Column]


@dataclass(frozen=True)
class Scan:
    """One running computation, as four small projections.

    ``local(w, run)``   steps over the rows of a slot (``w`` ordered, ``run`` up to
                        and including the current row)
    ``summary``         aggregates of a slot over source and local columns
    ``carry(w, prior)`` steps over the summaries of a key; ``prior`` ends one slot
                        before the current one
    ``final``           output columns from local and carried ones; carried ones are null
                        where the key has one slot only
    """

    local: Callable[[WindowSpec, WindowSpec], list[Cols]]
    summary: Cols
    carry: Callable[[WindowSpec, WindowSpec], list[Cols]]
    final: Cols
    carried: tuple[str, ...] = field(default=())
    # the windows that it is given run from the last row to the first
    backwards: bool = False


def chunk_of(ts: str, seconds: float) -> Column:
    """Number of the time chunk a row lies in; grows with time."""
    return F.floor(F.unix_micros(F.col(ts)) / F.lit(int(seconds * 1_000_000)))


def run_scans(
    df: DataFrame,
    scans: list[Scan],
    keys: tuple[str, ...] = ALERT_KEY,
    order: tuple[str, ...] = ALERT_ORDER,
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """Add the output columns of all scans.

    Rows that agree in key and order have no order among them. Without ``max_rows`` keys are
    not counted: the caller knows by ``has_hot_key`` that none is hot.
    """
    final: Cols = {}
    carried: list[str] = []
    for scan in scans:
        final.update(scan.final)
        carried.extend(scan.carried)
    cuts = None if max_rows is None else _slot_cuts(df, keys, order, max_rows)
    if cuts is None:
        rows, local = _local_steps(df, scans, keys, order)
        # only analysed, for the types
        types = _summaries(rows.withColumn(SLOT, F.lit(0)), scans, keys).schema
        joined = rows.withColumns({c: F.lit(None).cast(types[c].dataType) for c in carried})
        return joined.withColumns(final).drop(*local, *carried)
    cuts = F.broadcast(cuts)
    placed = df.withColumn(KEY, F.struct(*keys)).join(cuts, KEY, "left")
    before = F.filter("_cuts", lambda c: c <= F.struct(*order))
    placed = placed.withColumn(SLOT, F.coalesce(F.size(before), F.lit(0)))
    hot, _ = _local_steps(placed.filter("_cuts is not null"), scans, keys, order, SLOT)
    carry = cut(_summaries(hot, scans, keys).select(KEY, SLOT, *carried))
    rows, local = _local_steps(placed.drop("_cuts"), scans, keys, order, SLOT)
    joined = rows.join(F.broadcast(carry), [KEY, SLOT], "left").withColumns(final)
    kept = [c for c in joined.columns if c not in {KEY, SLOT, *local, *carried}]
    return joined.select(*[F.col(f"`{c}`") for c in kept])


def has_hot_key(
    df: DataFrame, keys: tuple[str, ...] = ALERT_KEY, max_rows: int = MAX_ROWS
) -> bool:
    """Whether a key has more than ``max_rows`` rows; if none has, none has in a part of them."""
    return _counted(df, keys, max_rows)[1] > max_rows


def _counted(
    df: DataFrame, keys: tuple[str, ...], max_rows: int
) -> tuple[DataFrame, int, int]:
    """Rows of each key, those of the largest, and the limit beyond which a key is hot."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total, largest = counted.agg(F.sum("_n"), F.max("_n")).first()
    return counted, largest or 0, max(max_rows, (total or 0) // MAX_SLOTS)


def _slot_cuts(
    df: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], max_rows: int
) -> DataFrame | None:
    """For every hot key the places in its order where it is cut; None if no key is hot."""
    counted, largest, limit = _counted(df, keys, max_rows)
    if largest <= limit:
        return None
    hot = counted.filter(F.col("_n") > limit).select(F.struct(*keys).alias(KEY))
    step = max(1, limit // SLOT_SAMPLE)
    rows = df.select(F.struct(*keys).alias(KEY), F.struct(*order).alias("_at"))
    rows = rows.filter(F.pmod(F.xxhash64(KEY, "_at"), F.lit(step)) == 0)
    found = rows.join(cut(hot), KEY).groupBy(KEY).agg(F.collect_list("_at").alias("_cuts"))
    every = max(1, limit // step)
    places = F.filter(F.sort_array("_cuts"), lambda _, i: (i % every == 0) & (i > 0))
    return cut(found.select(KEY, F.array_distinct(places).alias("_cuts")))


def _local_steps(
    rows: DataFrame, scans: list[Scan], keys: tuple[str, ...], order: tuple[str, ...], *slot: str
) -> tuple[DataFrame, list[str]]:
    group = Window.partitionBy(*keys, *slot)
    w, back = group.orderBy(*order), group.orderBy(*[F.desc(c) for c in order])
    steps = [_over(scan.local, back if scan.backwards else w, 0) for scan in scans]
    return _apply_steps(rows, steps)


def _summaries(rows: DataFrame, scans: list[Scan], keys: tuple[str, ...]) -> DataFrame:
    """One row per key and slot with what is carried into it."""
    summary = {name: c for scan in scans for name, c in scan.summary.items()}
    by = [KEY] if KEY in rows.columns else list(keys)
    slots = rows.groupBy(*by, SLOT).agg(*[c.alias(n) for n, c in summary.items()])
    group = Window.partitionBy(*by)
    w, back = group.orderBy(SLOT), group.orderBy(F.desc(SLOT))
    steps = [_over(scan.carry, back if scan.backwards else w, -1) for scan in scans]
    return _apply_steps(slots, steps)[0]


def _over(steps: Callable, w: WindowSpec, end: int) -> list[Cols]:
    return steps(w, w.rowsBetween(Window.unboundedPreceding, end))


def _apply_steps(df: DataFrame, plans: list[list[Cols]]) -> tuple[DataFrame, list[str]]:
    """Apply the steps of several scans level by level; also the names they added."""
    names: list[str] = []
    for level in range(max(len(steps) for steps in plans)):
        cols: Cols = {}
        for steps in plans:
            if level < len(steps):
                cols.update(steps[level])
        df = df.withColumns(cols)
        names.extend(cols)
    return df, names


def _order(order: tuple[str, ...]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def lag_struct(name: str, fields: Cols, order: tuple[str, ...] = ALERT_ORDER) -> Scan:
    """``name`` = struct of ``fields`` of the key's previous row, null on the first."""
    value = F.struct(*[c.alias(n) for n, c in fields.items()])
    p = f"_{name}"
    return Scan(
        local=lambda w, run: [{f"{p}_l": F.lag(value).over(w)}],
        summary={f"{p}_last": F.max_by(value, _order(order))},
        carry=lambda w, prior: [{f"{p}_c": F.lag(f"{p}_last").over(w)}],
        final={name: F.coalesce(F.col(f"{p}_l"), F.col(f"{p}_c"))},
        carried=(f"{p}_c",),
    )


def lead_struct(name: str, fields: Cols, order: tuple[str, ...] = ALERT_ORDER) -> Scan:
    """``name`` = struct of ``fields`` of the key's next row, null on the last."""
    value = F.struct(*[c.alias(n) for n, c in fields.items()])
    p = f"_{name}"
    return Scan(
        local=lambda w, run: [{f"{p}_l": F.lead(value).over(w)}],
        summary={f"{p}_first": F.min_by(value, _order(order))},
        carry=lambda w, prior: [{f"{p}_c": F.lead(f"{p}_first").over(w)}],
        final={name: F.coalesce(F.col(f"{p}_l"), F.col(f"{p}_c"))},
        carried=(f"{p}_c",),
    )


def running_sum(name: str, value: Column) -> Scan:
    """Inclusive running sum of ``value`` over the key."""
    p = f"_{name}"
    return Scan(
        local=lambda w, run: [{f"{p}_l": F.sum(value).over(run)}],
        summary={f"{p}_t": F.sum(value)},
        carry=lambda w, prior: [{f"{p}_c": F.sum(f"{p}_t").over(prior)}],
        final={name: F.coalesce(F.col(f"{p}_c"), F.lit(0)) + F.col(f"{p}_l")},
        carried=(f"{p}_c",),
    )


def running_last(name: str, value: Column, order: tuple[str, ...] = ALERT_ORDER) -> Scan:
    """Newest non-null ``value`` at or before each row."""
    p = f"_{name}"
    return Scan(
        local=lambda w, run: [{f"{p}_l": F.last(value, ignorenulls=True).over(run)}],
        summary={f"{p}_t": F.max_by(value, F.when(value.isNotNull(), _order(order)))},
        carry=lambda w, prior: [{f"{p}_c": F.last(f"{p}_t", ignorenulls=True).over(prior)}],
        final={name: F.coalesce(F.col(f"{p}_l"), F.col(f"{p}_c"))},
        carried=(f"{p}_c",),
    )


def first_before(name: str, value: Column) -> Scan:
    """Smallest ``value`` of the rows before each row; null on the key's first row."""
    p = f"_{name}"
    return Scan(
        local=lambda w, run: [
            {f"{p}_l": F.min(value).over(w.rowsBetween(Window.unboundedPreceding, -1))}
        ],
        summary={f"{p}_t": F.min(value)},
        carry=lambda w, prior: [{f"{p}_c": F.min(f"{p}_t").over(prior)}],
        final={name: F.least(F.col(f"{p}_l"), F.col(f"{p}_c"))},
        carried=(f"{p}_c",),
    )


def since_reset(name: str, reset: Column) -> Scan:
    """Rows since the last row where ``reset`` holds (0 on such a row); before any
    reset, rows since the start of the key."""
    p = f"_{name}"
    return Scan(
        # row numbers grow, so the newest reset is the one with the largest number
        local=lambda w, run: [
            {f"{p}_n": F.row_number().over(w)},
            {f"{p}_r": F.max(F.when(reset, F.col(f"{p}_n"))).over(run)},
        ],
        summary={
            f"{p}_rows": F.count(F.lit(1)),
            f"{p}_end": F.max(F.when(reset, F.col(f"{p}_n"))),
        },
        carry=lambda w, prior: [
            {f"{p}_base": F.coalesce(F.sum(f"{p}_rows").over(prior), F.lit(0))},
            {f"{p}_c": F.max(F.col(f"{p}_base") + F.col(f"{p}_end")).over(prior)},
        ],
        final={
            name: F.coalesce(f"{p}_base", F.lit(0))
            + F.col(f"{p}_n")
            - F.coalesce(
                F.coalesce(f"{p}_base", F.lit(0)) + F.col(f"{p}_r"), F.col(f"{p}_c"), F.lit(0)
            )
        },
        carried=(f"{p}_base", f"{p}_c"),
    )


def segment_first(
    name: str, reset: Column, value: Column, order: tuple[str, ...] = ALERT_ORDER
) -> Scan:
    """``value`` of the first row of the current run of rows without ``reset``; null on
    the reset rows themselves."""
    p = f"_{name}"
    boxed = F.struct(value.alias("v"))
    return Scan(
        local=lambda w, run: [
            {f"{p}_p": F.lag(reset).over(w), f"{p}_f": F.first(boxed).over(run)},
            {f"{p}_l": F.last(F.when(F.col(f"{p}_p"), boxed), ignorenulls=True).over(run)},
        ],
        summary={
            f"{p}_end": F.max_by(reset, _order(order)),
            f"{p}_start": F.max_by(F.col(f"{p}_l"), _order(order)),
            f"{p}_first": F.min_by(boxed, _order(order)),
        },
        carry=lambda w, prior: [
            {f"{p}_prev": F.lag(f"{p}_end").over(w)},
            {
                f"{p}_s": F.coalesce(
                    F.col(f"{p}_start"),
                    F.when(
                        F.coalesce(F.col(f"{p}_prev"), F.lit(True)), F.col(f"{p}_first")
                    ),
                )
            },
            {f"{p}_c": F.last(f"{p}_s", ignorenulls=True).over(prior)},
        ],
        final={
            name: F.when(
                ~reset,
                F.coalesce(
                    F.col(f"{p}_l"),
                    F.when(~F.col(f"{p}_prev"), F.col(f"{p}_c")),
                    F.col(f"{p}_f"),
                ).getField("v"),
            )
        },
        carried=(f"{p}_prev", f"{p}_c"),
    )


def following_first(
    name: str, value: Column, order: tuple[str, ...] = ALERT_ORDER
) -> Scan:
    """Nearest non-null ``value`` strictly after each row."""
    p = f"_{name}"

    # read backwards, what follows a row is a running frame before it
    def after(w: WindowSpec) -> WindowSpec:
        return w.rowsBetween(Window.unboundedPreceding, -1)

    return Scan(
        backwards=True,
        local=lambda w, run: [{f"{p}_l": F.last(value, ignorenulls=True).over(after(w))}],
        summary={f"{p}_t": F.min_by(value, F.when(value.isNotNull(), _order(order)))},
        carry=lambda w, prior: [
            {f"{p}_c": F.last(f"{p}_t", ignorenulls=True).over(after(w))}
        ],
        final={name: F.coalesce(F.col(f"{p}_l"), F.col(f"{p}_c"))},
        carried=(f"{p}_c",),
    )


def max_before(name: str, value: Column) -> Scan:
    """Largest ``value`` of the rows strictly before each row."""
    p = f"_{name}"
    return Scan(
        local=lambda w, run: [
            {f"{p}_l": F.max(value).over(w.rowsBetween(Window.unboundedPreceding, -1))}
        ],
        summary={f"{p}_t": F.max(value)},
        carry=lambda w, prior: [{f"{p}_c": F.max(f"{p}_t").over(prior)}],
        final={name: F.greatest(F.col(f"{p}_l"), F.col(f"{p}_c"))},
        carried=(f"{p}_c",),
    )

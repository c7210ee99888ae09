"""Periodic runs of words by internal pattern matching, and texts collapsed to one period.

A run is a stretch of words in which words ``period`` apart agree, that no neighbouring word
extends, and that holds at least ``MIN_POWERS`` periods and ``MIN_WORDS`` words; ``period`` is
the smallest one of the stretch.

The words of many documents are numbered, document by document, and put into one suffix array by
prefix doubling; the ranks of every round stay, so that a dyadic block of 2**j words is one
interval of the array. For blocks at every half of their length a wavelet matrix over the
array answers where the block occurs next, which is the range successor of its own place in its
interval. Occurrences of a block in the window after it are an arithmetic progression, whose step
is the distance to the next one: that is a candidate period if it is at most the block and more
than half of it. Both ends of the stretch come from the ranks, by doubling steps.

Every run is found: with period q and 2**j the least power of two that is q at least, a run of
4q words holds a block of 2**j words that starts at a multiple of half of that and that occurs
again q later inside the run, and no earlier, as the run's period is primitive.

Defined results: null, empty and blank texts have no words, no runs and an empty collapsed text;
texts are read whole, however long; a text is one task's work, and nothing is shared between
rows, so repeated rows repeat their result; an empty table gives an empty table; columns that
are not kept are ignored, and a kept column named like a result gives way to the result.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame

from alertweave.llm.common import append_columns

MIN_POWERS = 4
MIN_WORDS = 6

RUN = "struct<start: long, length: long, period: long>"
FIELDS = f"n_words long, runs array<{RUN}>, strongest {RUN}, collapsed string"


def suffix_array(words: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in order, and the ranks of every round.

    ``ranks[j][i]`` is where the suffixes begin that share the first 2**j words of suffix i.
    Rounds end when no block occurs twice. A block that occurs twice must not reach the end.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")
    suffixes = order.astype(np.int32)
    place = np.arange(n)
    new = np.append(True, words[order[1:]] != words[order[:-1]])
    first = np.maximum.accumulate(np.where(new, place, 0))
    rank = np.empty(n, np.int32)
    rank[order] = first
    ranks = []
    width = 1
    active = order[~(new & np.append(new[1:], True))]
    while len(active):
        ranks.append(rank)
        old = rank[active].astype(np.int64)
        key = old * n + rank[active + width]
        by_key = np.argsort(key, kind="stable")
        key, old, active = key[by_key], old[by_key], active[by_key]
        place = np.arange(len(active))
        group = np.append(True, old[1:] != old[:-1])
        offset = place - np.maximum.accumulate(np.where(group, place, 0))
        suffixes[old + offset] = active
        new = np.append(True, key[1:] != key[:-1])
        rank = rank.copy()
        rank[active] = (old + offset)[np.maximum.accumulate(np.where(new, place, 0))]
        active = active[~(new & np.append(new[1:], True))]
        width *= 2
    return suffixes, ranks


class WaveletMatrix:
    """Numbers by their bits, the highest first; queries come as arrays."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = []
        for bit in reversed(range(max(1, int(values.max()).bit_length()))):
            zero = (values >> bit) & 1 == 0
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(zero, out=before[1:])
            self.levels.append((bit, before))
            values = np.concatenate([values[zero], values[~zero]])

    def successors(self, low: np.ndarray, high: np.ndarray, than: np.ndarray) -> np.ndarray:
        """The least value greater than ``than`` in places ``low`` to ``high``; -1 where none is."""
        limit = than + 1
        rank = np.zeros(len(low), np.int64)
        a, b = low, high
        for bit, before in self.levels:
            x, y = before[a], before[b]
            one = (limit >> bit) & 1 == 1
            rank += np.where(one, y - x, 0)
            a, b = np.where(one, before[-1] + a - x, x), np.where(one, before[-1] + b - y, y)
        # a limit beyond the highest bit is beyond every value
        rank = np.where(limit >> len(self.levels) > 0, high - low, rank)
        found = rank < high - low
        out = np.full(len(low), -1, np.int64)
        a, b, rank = low[found], high[found], rank[found]
        value = np.zeros(len(a), np.int64)
        for bit, before in self.levels:
            x, y = before[a], before[b]
            one = rank >= y - x
            rank = np.where(one, rank - (y - x), rank)
            value += one.astype(np.int64) << bit
            a, b = np.where(one, before[-1] + a - x, x), np.where(one, before[-1] + b - y, y)
        out[found] = value
        return out


def periodic_runs(words: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and period.

    ``words`` are numbers; each text ends with a number that occurs nowhere else.
    """
    suffixes, ranks = suffix_array(words)
    none = np.zeros((0, 3), np.int64)
    if not ranks:
        return none
    wavelet = WaveletMatrix(suffixes)
    places, periods = [], []
    for j, rank in enumerate(ranks):
        block = 1 << j
        at = np.arange(0, len(words), max(1, block // 2))
        low = rank[at].astype(np.int64)
        size = np.bincount(rank, minlength=len(words))[low]
        at, low, size = (x[size > 1] for x in (at, low, size))
        step = wavelet.successors(low, low + size, at) - at
        fits = (step <= block) & (2 * step > block)
        places.append(at[fits])
        periods.append(step[fits])
    at, period = np.concatenate(places), np.concatenate(periods)
    start, stop = at.copy(), at + period
    for j in reversed(range(len(ranks))):
        rank, block = ranks[j], 1 << j
        same = rank[stop - period] == rank[stop]
        stop = stop + np.where(same, block, 0)
        before = start - block
        inside = before >= 0
        same = inside & (rank[np.where(inside, before, 0)] == rank[np.where(inside, before + period, 0)])
        start = np.where(same, before, start)
    length = stop - start
    runs = np.stack([start, length, period], axis=1)[length >= np.maximum(MIN_WORDS, MIN_POWERS * period)]
    return np.unique(runs, axis=0) if len(runs) else none


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with most periods; ties go to the least start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def read_texts(texts: list[str | None]) -> list[list]:
    """The fields of ``FIELDS`` for each text."""
    split = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
    numbers: list[int] = []
    begins, base = [], 0
    for words in split:
        begins.append(len(numbers))
        if len(words) >= MIN_WORDS:
            known: dict[bytes, int] = {}
            numbers += [known.setdefault(w, base + len(known)) for w in words]
            base += len(known) + 1
            numbers.append(base - 1)
    found: list[list] = [[] for _ in texts]
    if numbers:
        runs = periodic_runs(np.array(numbers, np.int64))
        owners = np.searchsorted(begins, runs[:, 0], side="right") - 1
        for owner, (start, length, period) in zip(owners.tolist(), runs.tolist(), strict=True):
            found[owner].append((start - begins[owner], length, period))
    return [
        [len(words) for words in split],
        [[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs in found],
        [r and dict(zip(("start", "length", "period"), r, strict=True)) for r in map(strongest, found)],
        [collapsed(words, runs) for words, runs in zip(split, found, strict=True)],
    ]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words joined by a space, of every run its first period only."""
    if runs:
        depth = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            depth[start + period] += 1
            depth[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]
    return b" ".join(words).decode("utf-8", "surrogatepass")


def find_runs(docs: DataFrame, text: str = "text", keep: Iterable[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with ``n_words``, all ``runs``, the ``strongest`` and the ``collapsed`` text."""
    return append_columns(docs, text, keep, FIELDS, lambda: read_texts)

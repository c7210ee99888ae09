"""Benchmark decontamination with one Aho-Corasick automaton.

Texts are normalised to words (A-Z lower-cased; digits, a-z and everything beyond ASCII are
letters). Every window of ten item words is a pattern over the normalised text; one scan of a
document finds all of them, and word numbers lead back to offsets in the original text.

Defined results: null or wordless texts have no words and no hits; an item without words has
no window; items that repeat an id are one item; an item with null id is known as "null"; a
document of any length is scanned whole; an empty benchmark gives no hits.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertweave.llm.common import append_columns

WINDOW = 10
# bytes of item texts in one automaton; a larger benchmark is scanned in several passes
BLOCK_BYTES = 16 << 20

# letters of a word in the original text
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
# byte by byte: lower case for A-Z, a blank for what separates words
FOLD = bytes(
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80
    else c + 32 if 0x41 <= c <= 0x5A
    else 0x20
    for c in range(256)
)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split(b" ")


def normalised(text: str | None) -> tuple[str, int]:
    """Words, each with a blank before and after it, and their number."""
    found = [w for w in words(text) if w]
    if not found:
        return "", 0
    return f" {b' '.join(found).decode('utf-8', 'surrogatepass')} ", len(found)


def automaton(items: list[tuple[str, str | None]], window: int) -> ahocorasick.Automaton | None:
    """Pattern of every window, with its number of words and the items that hold it."""
    patterns: dict[str, tuple[int, set[str]]] = {}
    for item, text in items:
        # only a blank parts words: other white space beyond ASCII is a letter here
        found = normalised(text)[0].split(" ")[1:-1]
        for i in range(max(1, len(found) - window + 1) if found else 0):
            part = found[i : i + window]
            patterns.setdefault(f" {' '.join(part)} ", (len(part), set()))[1].add(item)
    if not patterns:
        return None
    out = ahocorasick.Automaton()
    for pattern, value in patterns.items():
        out.add_word(pattern, value)
    out.make_automaton()
    return out


def scan(text: str | None, machine) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, merged ranges of hit words (end exclusive), items that occur."""
    normal, n = normalised(text)
    ranges: list[tuple[int, int]] = []
    items: set[str] = set()
    if machine is None or not n:
        return n, ranges, items
    blanks = None
    for end, (length, holders) in machine.iter(normal):
        if blanks is None:
            points = np.frombuffer(normal.encode("utf-32-le", "surrogatepass"), np.uint32)
            blanks = np.flatnonzero(points == 0x20)
        last = int(np.searchsorted(blanks, end))  # words that end at or before the blank
        ranges.append((last - length, last))
        items |= holders
    return n, merged(ranges), items


def merged(ranges: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def original_spans(text: str, ranges: list[tuple[int, int]]) -> list[dict]:
    """Ranges of words as offsets of code points in the original text."""
    if not ranges:
        return []
    at = [m.span() for m in WORD.finditer(text)]
    return [{"start": at[a][0], "end": at[b - 1][1]} for a, b in ranges]


RESULTS = ["n_words", "n_hit", "item_ids", "spans"]


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    keep: Iterable[str] = ("doc_id",),
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``n_words``, ``n_hit``, ``item_ids`` and ``spans`` of every document.

    The benchmark's size is summed first: within ``block_bytes`` one automaton serves all
    of it, beyond that the items are split by hash and the documents pass one automaton
    after the other, without a shuffle.
    """
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
        F.col("text").alias("body"),
    ).filter("body is not null")
    # names of its own, so that a kept column may have any name
    kept = [c for c in dict.fromkeys(keep) if c not in RESULTS]
    inner = [f"__k{i}" for i in range(len(kept))]
    found = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(kept, inner, strict=True)], F.col(f"`{text}`").alias("__text"))
    size = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    for i in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == i)
        rows = [(r.item, r.body) for r in block.collect()]
        found = _scan_block(found, docs.sparkSession.sparkContext.broadcast(rows), "__text", inner,
                            window, first=i == 0, last=i == blocks - 1)
    return found.select(*inner, *RESULTS).toDF(*kept, *RESULTS)


def _scan_block(found, shared, text, keep, window, first, last):
    fields = "n_words long, n_hit long, item_ids array<string>, spans array<struct<start: int, end: int>>"
    if not (first and last):
        fields = "__now struct<n: long, ranges: array<array<long>>, items: array<string>>"

    def start():
        machine = automaton(shared.value, window)

        def whole(texts):
            out: list[list] = [[], [], [], []]
            for t in texts:
                n, ranges, items = scan(t, machine)
                out[0].append(n)
                out[1].append(sum(b - a for a, b in ranges))
                out[2].append(sorted(items))
                out[3].append(original_spans(t or "", ranges))
            return out

        def part(texts):
            rows = [scan(t, machine) for t in texts]
            return [[{"n": n, "ranges": [list(r) for r in rs], "items": sorted(i)}
                     for n, rs, i in rows]]

        return whole if first and last else part

    if first and last:
        return append_columns(found, text, keep, fields, start)
    carried = [*keep, "__body"] if first else [*keep, "__body", "__earlier"]
    source = found.withColumn("__body", F.col(text)) if first else found
    now = append_columns(source, "__body", carried, fields, start)
    if not first:
        now = now.withColumn(
            "__now",
            F.struct(
                F.col("__now.n"),
                F.concat("__earlier.ranges", "__now.ranges").alias("ranges"),
                F.array_union("__earlier.items", "__now.items").alias("items"),
            ),
        )
    now = now.drop("__earlier").withColumnRenamed("__now", "__earlier")
    return _finish(now, keep) if last else now


def _finish(found: DataFrame, keep: Iterable[str]) -> DataFrame:
    """Merge the ranges that several automata have found."""
    packed = found.withColumn("__body", F.to_json(F.struct("__body", "__earlier")))
    fields = "n_words long, n_hit long, item_ids array<string>, spans array<struct<start: int, end: int>>"

    def start():
        import json

        def work(texts):
            out: list[list] = [[], [], [], []]
            for t in texts:
                row = json.loads(t)
                ranges = merged(tuple(r) for r in row["__earlier"]["ranges"])
                out[0].append(row["__earlier"]["n"])
                out[1].append(sum(b - a for a, b in ranges))
                out[2].append(sorted(row["__earlier"]["items"]))
                out[3].append(original_spans(row.get("__body") or "", ranges))
            return out

        return work

    return append_columns(packed, "__body", keep, fields, start)

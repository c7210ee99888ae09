"""Byte-level BPE encoding and decoding.

Texts are cut into slices without a regex: every code point gets a class, a small automaton
over classes says where a slice starts, and the automaton's transition functions, closed
under composition, are scanned associatively, many blocks of text at a time. Slices are
merged to ids once and then found in a cache.

Defined results: null text encodes as the empty text (no ids, no bytes); a text of any length
is encoded whole; rows are independent, so repeated rows repeat their result; an empty table
gives an empty table; columns that are not kept are ignored, and a kept column whose name
is also a result's name gives way to the result.
"""

from __future__ import annotations

import base64
import heapq
import sys
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from alertweave.llm.common import append_columns

# slices kept in a task's cache before it starts anew
CACHE_SLICES = 400_000
# a vocabulary is broadcast; this bounds it
VOCABULARY_BYTES = 64 << 20

# classes of code points; the last ones look at what follows
LETTER, NUMBER, OTHER, SPACE_INSIDE, BLANK_LAST, WHITE_LAST, SHORT, LONG, RESET = range(9)
# states: what the slice that is being read consists of
NONE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_WHITE, AFTER_BLANK, ONE_MORE, TWO_MORE = range(8)

# fixed values: the white space of the pattern's \s
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
# fixed values: the endings that follow an apostrophe
SHORT_ENDINGS = ("s", "t", "m", "d")
LONG_ENDINGS = ("re", "ve", "ll")


def step(state: int, kind: int) -> tuple[int, bool]:
    """Next state, and whether a slice starts at a code point of class ``kind``."""
    if kind == LETTER:
        if state == TWO_MORE:
            return ONE_MORE, False
        if state == ONE_MORE:
            return NONE, False
        return IN_LETTERS, state not in (IN_LETTERS, AFTER_BLANK)
    if kind == NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, AFTER_BLANK)
    if kind in (SHORT, LONG) and state not in (IN_OTHERS, AFTER_BLANK):
        return (ONE_MORE if kind == SHORT else TWO_MORE), True
    if kind in (OTHER, SHORT, LONG):
        return IN_OTHERS, state not in (IN_OTHERS, AFTER_BLANK)
    if kind == SPACE_INSIDE:
        return IN_WHITE, state != IN_WHITE
    return (AFTER_BLANK if kind == BLANK_LAST else NONE), True


class Scan:
    """Finds slice starts by scanning compositions of transition functions."""

    BLOCK = 128

    def __init__(self) -> None:
        kinds = range(RESET + 1)
        maps = [tuple(step(s, k)[0] for s in range(8)) for k in kinds]
        known = {m: i for i, m in enumerate(dict.fromkeys(maps))}
        todo = list(known)
        while todo:  # close under composition
            f = todo.pop()
            for g in dict.fromkeys(maps):
                h = tuple(g[x] for x in f)
                if h not in known:
                    known[h] = len(known)
                    todo.append(h)
        self.size = len(known)
        elements = list(known)
        self.element = np.array([known[m] for m in maps], np.int32)
        self.then = np.array(
            [known[tuple(g[x] for x in f)] for f in elements for g in elements], np.int32
        )
        self.identity = known.get(tuple(range(8)), -1)
        self.from_none = np.array([f[NONE] for f in elements], np.int32)
        self.next = np.array([step(s, k)[0] for s in range(8) for k in kinds], np.int32)
        self.starts = np.array([step(s, k)[1] for s in range(8) for k in kinds], bool)

    def compose(self, f: np.ndarray, g: np.ndarray) -> np.ndarray:
        return self.then.take(f * self.size + g)

    def boundaries(self, kinds: np.ndarray) -> np.ndarray:
        """True where a slice starts; the text starts in state NONE."""
        n, width = len(kinds), self.BLOCK
        rows = -(-n // width)
        padded = np.full(rows * width, RESET, np.int32)
        padded[:n] = kinds
        columns = np.ascontiguousarray(padded.reshape(rows, width).T)
        whole = self.element.take(columns[0])
        for column in columns[1:]:
            whole = self.compose(whole, self.element.take(column))
        reach = 1
        while reach < rows:  # inclusive scan over the blocks
            whole = np.concatenate([whole[:reach], self.compose(whole[:-reach], whole[reach:])])
            reach *= 2
        state = np.concatenate([[NONE], self.from_none.take(whole[:-1])]).astype(np.int32)
        found = np.empty((width, rows), bool)
        for i, column in enumerate(columns):
            at = state * (RESET + 1) + column
            found[i] = self.starts.take(at)
            state = self.next.take(at)
        return found.T.reshape(-1)[:n]


@lru_cache(maxsize=1)
def code_point_classes() -> np.ndarray:
    kinds = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for point in range(sys.maxunicode + 1):
        major = unicodedata.category(chr(point))[0]
        if major == "L":
            kinds[point] = LETTER
        elif major == "N":
            kinds[point] = NUMBER
    kinds[list(WHITE_SPACE)] = SPACE_INSIDE
    return kinds


def text_classes(points: np.ndarray, resets: np.ndarray) -> np.ndarray:
    """Classes of the code points of several texts; ``resets`` are the marks between them."""
    kinds = code_point_classes().take(points)
    following = np.append(points[1:], ord("\n"))
    # white space before something else: its last code point is read apart
    last = (kinds == SPACE_INSIDE) & (np.append(kinds[1:], SPACE_INSIDE) != SPACE_INSIDE)
    kinds[last] = np.where(points[last] == ord(" "), BLANK_LAST, WHITE_LAST)
    apostrophes = np.flatnonzero(points == ord("'"))
    if len(apostrophes):
        one = following[apostrophes]
        two = following[np.minimum(apostrophes + 1, len(points) - 1)]
        short = np.isin(one, [ord(c) for c in SHORT_ENDINGS])
        long = np.zeros(len(apostrophes), bool)
        for a, b in LONG_ENDINGS:
            long |= (one == ord(a)) & (two == ord(b))
        kinds[apostrophes[short]] = SHORT
        kinds[apostrophes[long]] = LONG
    kinds[resets] = RESET
    return kinds


def slices(texts: list[str], scan: Scan) -> tuple[list[str], np.ndarray, list[int]]:
    """Slices of all texts in order, each slice's start in its text, and slices per text."""
    joined = "\n".join(texts)
    if not joined:
        return [], np.zeros(0, np.int64), [0] * len(texts)
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths + 1) - 1
    begins = ends - lengths
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    resets = ends[:-1]
    starts = np.flatnonzero(scan.boundaries(text_classes(points, resets)))
    stops = np.append(starts[1:], len(points))
    real = np.ones(len(points) + 1, bool)
    real[resets] = False
    kept = real[starts]
    starts, stops = starts[kept], stops[kept]
    pieces = [joined[a:b] for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
    owner = np.searchsorted(ends, starts, side="left")
    counts = np.bincount(owner, minlength=len(texts))
    return pieces, starts - begins[owner], counts.tolist()


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one slice: the adjacent pair of lowest rank, the first of equals, is merged."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    parts: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [
        (ranks[pair], i, pair) for i in range(n - 1) if (pair := piece[i : i + 2]) in ranks
    ]
    heapq.heapify(heap)
    while heap:
        _, i, pair = heapq.heappop(heap)
        j = after[i]
        if parts[i] is None or j >= n or parts[i] + parts[j] != pair:
            continue  # one of the two has been merged meanwhile
        parts[i], parts[j] = pair, None
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
            longer = pair + parts[after[i]]
            if longer in ranks:
                heapq.heappush(heap, (ranks[longer], i, longer))
        if before[i] >= 0:
            longer = parts[before[i]] + pair
            if longer in ranks:
                heapq.heappush(heap, (ranks[longer], before[i], longer))
    return [ranks[p] for p in parts if p is not None]


class SliceCache(dict):
    """Slice to its ids, as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE_SLICES:
            self.clear()
        ids = np.array(merge(piece.encode(), self.ranks), "<u4").tobytes()
        self[piece] = ids
        return ids


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    rows = (line.split() for line in data.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in rows}


def encode(
    docs: DataFrame,
    vocabulary: str,
    text: str = "text",
    keep: Iterable[str] = ("doc_id",),
    offsets: bool = True,
    decode: bool = False,
) -> DataFrame:
    """Ids of every text.

    ``n_tokens``; ``ids``, little-endian unsigned 32-bit integers; with ``offsets``,
    ``slices``: start of a slice in the text in code points and its number of ids; with
    ``decode``, ``decoded``: the bytes that the ids stand for, looked up id by id.
    """
    with open(vocabulary, "rb") as file:  # an installed file, read by the driver
        data = file.read(VOCABULARY_BYTES + 1)
    if len(data) > VOCABULARY_BYTES:
        raise ValueError(f"vocabulary larger than {VOCABULARY_BYTES} bytes")
    shared = docs.sparkSession.sparkContext.broadcast(data)
    fields = "n_tokens long, ids binary"
    fields += ", slices array<struct<start: int, n: int>>" * offsets + ", decoded binary" * decode

    def start():
        ranks = parse_ranks(shared.value)
        scan, cache = Scan(), SliceCache(ranks)
        words = np.empty(max(ranks.values()) + 1, object)
        for token, rank in ranks.items():
            words[rank] = token

        def work(texts):
            pieces, begins, counts = slices([t or "" for t in texts], scan)
            parts = list(map(cache.__getitem__, pieces))
            out: list[list] = [[] for _ in range(2 + offsets + decode)]
            at = 0
            for n in counts:
                ids = b"".join(parts[at : at + n])
                row = [len(ids) // 4, ids]
                if offsets:
                    spans = zip(begins[at : at + n].tolist(), parts[at : at + n], strict=True)
                    row.append([{"start": a, "n": len(p) // 4} for a, p in spans])
                if decode:
                    row.append(b"".join(words[np.frombuffer(ids, "<u4")].tolist()))
                for column, value in zip(out, row, strict=True):
                    column.append(value)
                at += n
            return out

        return work

    return append_columns(docs, text, keep, fields, start)

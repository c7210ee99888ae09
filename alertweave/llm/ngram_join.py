"""Similarity join on word 5-grams by vertical partitioning, and its components.

A document's set holds its distinct 5-word shingles as 64-bit hashes. The global order of
shingles is by frequency, then hash, the rare first. It is cut into ``FRAGMENTS`` of about as many
occurrences each, so that a set is cut into as many parts. Two sets that overlap enough share
one of their rarest shingles, so documents meet by those; where documents meet, each fragment's
overlaps are counted for all of their pairs in a task of its own, and the partial overlaps
of a pair are summed over its fragments in another. Partial overlaps of a group travel packed, as
rows of a matrix of its pairs. Only links that join what is not joined yet leave a task, and
each document's number of links, so a group of n near copies gives about 2 n rows and not n * n.

Copies with the same words are one node. Where few meet at a shingle, pairs that cannot link by
their sizes and its places are left out. Groups that meet are first compared on the first fragment
alone, by half of each hash: its partial overlap and the sizes of the rest bound the whole, which
leaves few pairs. Only for these texts are read again and all fragments are sent. A large group is cut into blocks of bounded size,
in shingles and in documents, and pairs of blocks are compared in separate tasks.

Defined results: null, empty and blank texts have no shingles and stand alone; a text of one to
four words is one shingle of its own kind; repeated rows and copies share a component, and are
links of each other; a null id takes part in nothing and has a null component; texts of any length
are read whole; an empty table gives an empty table; other columns are ignored.

Nodes and shingles are 64-bit hashes. Two texts whose node hashes collide are detected by a
second hash, and another seed is taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertweave.llm.common import append_columns, by_size, keyed_join
from alertweave.operators.lineage import cut

WORDS = 5
# a link: 100 * intersection >= PERCENT * union
PERCENT = 80
# shingles that one fragment of the frequency count holds, about
FRAGMENT_SHINGLES = 2_000_000
# shingles at least this frequent are put last in the order, the most frequent ones first found;
# the bound keeps the broadcast small and moves only work, never results
FREQUENT = 16
FREQUENT_SHINGLES = 400_000
# parts that the global order is cut into
FRAGMENTS = 4
# shingles, and nodes, of a block of documents that are compared in one task, about
BLOCK_SHINGLES = 1_000_000
BLOCK_NODES = 1500
PLACE_BITS = 31
# rows of one shingle whose pairs are tested in memory; those of a more frequent one all meet
HELD_ROWS = 4096
# rows of a matrix of documents that are worked on at once
STRIP_ROWS = 256
# cells of a matrix of documents and shingles
MATRIX_CELLS = 4_000_000
# rows, and bytes of matrices, that leave a task at once
SENT_ROWS = 5000
SENT_BYTES = 8 << 20
# first bits of a shingle that its frequency is counted by, after those of its fragment
COUNT_BITS = 24
# bits of the map of keys by which rows are left out before a join
KEY_BITS = 1 << 26

# odd numbers that hashes are multiplied with
ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    np.uint64,
)
# a random number for each byte, 0 for none
LETTERS = np.random.default_rng(1).integers(1, 1 << 64, 256, np.uint64, endpoint=False)
WHITE = np.zeros(256, bool)
WHITE[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    for shift in (32, 29):
        x = (x ^ (x >> np.uint64(shift))) * ODD[0]
    return x ^ (x >> np.uint64(32))


class Reader:
    """Hashes the words, shingles and word sequences of many texts at once.

    A sum of letters times powers of an odd number, modulo 2**64, gives every word's hash as
    the difference of two prefix sums, times an inverse power.
    """

    def __init__(self, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.base = int(rng.integers(1 << 62, 1 << 63)) * 2 + 1
        self.powers = self.inverses = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.powers) <= n:
            base, inverse = (np.uint64(x) for x in (self.base, pow(self.base, -1, 1 << 64)))
            self.powers, self.inverses = (
                np.multiply.accumulate(np.append(np.uint64(1), np.full(n, x))) for x in (base, inverse)
            )

    def sums(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of values[start:end] for each range, wherever it stands."""
        self.grow(len(values))
        prefix = np.append(np.uint64(0), np.cumsum(values * self.powers[: len(values)], dtype=np.uint64))
        return (prefix[ends] - prefix[starts]) * self.inverses[starts]

    def read(self, data: list[bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Node and ascending distinct shingles of each text; texts come with A-Z lower-cased."""
        letters = np.frombuffer(b"\n".join(data) + b"\n", np.uint8)
        inside = (~WHITE[letters]).view(np.int8)
        change = np.diff(inside, prepend=np.int8(0))
        starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        words = self.sums(LETTERS[letters], starts, ends)
        words = mixed(words + (ends - starts).astype(np.uint64) * ODD[1])
        stops = np.searchsorted(starts, np.cumsum([len(d) + 1 for d in data]))
        begins = np.append(0, stops[:-1])
        nodes = self.sums(words, begins, stops) + (stops - begins).astype(np.uint64) * ODD[2]
        every = shingled(words, WORDS)
        sets = []
        for a, b in zip(begins.tolist(), stops.tolist(), strict=True):
            if b - a >= WORDS:
                own = np.sort(every[a : b - WORDS + 1])
                sets.append(own[np.append(True, own[1:] != own[:-1])])
            else:
                sets.append(shingled(words[a:b], b - a))
        return mixed(nodes).view(np.int64), sets


def shingled(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` words in a row."""
    if not width or len(words) < width:
        return np.zeros(0, np.uint64)
    n = len(words) - width + 1
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out += words[i : i + n] * ODD[i]
    return mixed(out)


def lowered(text: str | None) -> bytes:
    """A-Z lower-cased; other letters stay as they are."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def signatures(docs: DataFrame, text: str, seed: int) -> DataFrame:
    """Node of every document, another hash of its words, and the size of its set."""

    def start():
        reader = Reader(seed)

        def work(texts):
            data = [lowered(t) for t in texts]
            nodes, sets = reader.read(data)
            other = [xxhash.xxh3_64_intdigest(b" ".join(d.split())) >> 1 for d in data]
            return [nodes.tolist(), other, [len(s) for s in sets]]

        return work

    fields = "node long, other long, n_shingles long"
    return append_columns(docs, text, ["doc_id"], fields, start)


def text_batches(batches: Iterator[pa.RecordBatch], reader: Reader):
    """Nodes and sets of the texts that have words, group by group."""
    for batch in batches:
        for group in by_size(batch.column("__text").to_pylist()):
            nodes, sets = reader.read([lowered(t) for t in group])
            yield [(node, own) for node, own in zip(nodes.tolist(), sets, strict=True) if len(own)]


def packed(keys: np.ndarray) -> bytes:
    """Ascending numbers as compressed differences, high and low bytes apart."""
    steps = np.diff(keys, prepend=keys[:1] * 0).astype("<u4")
    return zstandard.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked(blob: bytes) -> np.ndarray:
    data = np.frombuffer(zstandard.decompress(blob), np.uint8)
    return np.cumsum(np.ascontiguousarray(data.reshape(4, -1).T).view("<u4").ravel().astype(np.int64))


def frequent_shingles(docs: DataFrame, text: str, total: int, seed: int) -> Order:
    """The global order, from the most frequent shingles, without their last bits.

    Each task sends every fragment its part of the order, each shingle with its count. Shingles
    that agree in the bits that are counted share a count, which moves them in the order.
    """
    bits = max(6, (max(1, total) // FRAGMENT_SHINGLES).bit_length())
    left = 64 - bits - COUNT_BITS

    def count(batches):
        held: list[np.ndarray] = []
        size = 0

        def flush():
            keys, times = np.unique(np.concatenate(held) >> np.uint64(left), return_counts=True)
            fragment = (keys >> np.uint64(COUNT_BITS)).astype(np.int64)
            edges = np.flatnonzero(np.diff(fragment)) + 1
            inner = (keys & np.uint64((1 << COUNT_BITS) - 1)).astype(np.int64)
            made: list[list] = [fragment[np.append(0, edges)].tolist(), [], [], []]
            for part, n in zip(np.split(inner, edges), np.split(times, edges), strict=True):
                made[1].append(packed(part))
                made[2].append(packed(part[n > 1]))
                made[3].append((n[n > 1] - 1).astype(np.uint32).tobytes())
            arrays = [pa.array(c, t) for c, t in zip(made, (pa.int64(), *[pa.binary()] * 3), strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["fragment", "keys", "again", "often"])

        for group in text_batches(batches, Reader(seed)):
            held += [own for _, own in group]
            size += sum(len(own) for _, own in group)
            if size >= FRAGMENT_SHINGLES:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def merge(part: pa.Table) -> pa.Table:
        def column(name):
            return np.concatenate([unpacked(b) for b in part.column(name).to_pylist()])

        keys, times = np.unique(column("keys"), return_counts=True)
        more = np.frombuffer(b"".join(part.column("often").to_pylist()), np.uint32)
        times = times + np.bincount(np.searchsorted(keys, column("again")), more, len(keys)).astype(np.int64)
        often = times >= FREQUENT
        whole = (part.column("fragment")[0].as_py() << COUNT_BITS) | keys[often]
        return pa.table({"key": pa.array(whole, pa.int64()), "times": pa.array(times[often], pa.int64())})

    texts = docs.select(F.col(text).alias("__text"))
    schema = "fragment long, keys binary, again binary, often binary"
    counted = texts.mapInArrow(count, schema).groupBy("fragment").applyInArrow(merge, "key long, times long")
    rows = counted.orderBy(F.desc("times"), "key").limit(FREQUENT_SHINGLES).collect()
    keys = np.array([r.key for r in rows], np.uint64)
    order = np.argsort(keys)
    return Order(keys[order], np.array([r.times for r in rows], np.int64)[order], left, total)


class Order:
    """The global order of shingles, and its cuts into fragments of about as many occurrences."""

    def __init__(self, keys: np.ndarray, times: np.ndarray, shift: int, total: int) -> None:
        """``keys`` are the frequent shingles without their last bits, ascending."""
        self.keys, self.times, self.shift = keys, times, shift
        by_order = np.lexsort((keys, times))
        rare = max(0, total - int(times.sum()))
        ends = rare + np.cumsum(times[by_order])
        self.cuts = []
        for i in range(1, FRAGMENTS):
            occurrences = total * i // FRAGMENTS
            if occurrences < rare or not len(keys):
                self.cuts.append((0, min((occurrences << 64) // max(1, rare), (1 << 64) - 1)))
            else:
                at = by_order[min(np.searchsorted(ends, occurrences), len(keys) - 1)]
                self.cuts.append((int(times[at]), int(keys[at]) << shift))

    def often(self, hashes: np.ndarray) -> np.ndarray:
        """Frequencies; 0 for those that are not among the frequent ones."""
        if not len(self.keys):
            return np.zeros(len(hashes), np.int64)
        short = hashes >> np.uint64(self.shift)
        at = np.minimum(np.searchsorted(self.keys, short), len(self.keys) - 1)
        return np.where(self.keys[at] == short, self.times[at], 0)

    def parts(self, hashes: np.ndarray) -> list[np.ndarray]:
        """The set fragment by fragment, each in the order of ``hashes``."""
        often = self.often(hashes)
        fragment = np.zeros(len(hashes), np.int64)
        for times, first in self.cuts:
            fragment += (often > times) | ((often == times) & (hashes >= np.uint64(first)))
        return [hashes[fragment == i] for i in range(FRAGMENTS)]

    def rarest(self, hashes: np.ndarray) -> np.ndarray:
        """The set's prefix in the global order: one of it is in every set that overlaps enough."""
        n = len(hashes)
        length = n - (-(-PERCENT * n // 100)) + 1
        return hashes[np.lexsort((hashes, self.often(hashes)))[:length]]


def prefixes(docs: DataFrame, text: str, seed: int, shared: Broadcast) -> DataFrame:
    """``token`` and ``node`` for the rarest shingles of every set.

    ``place`` has the set's size and, in its low bits, the shingle's place in the set's order.
    """

    def run(batches):
        order = shared.value
        for group in text_batches(batches, Reader(seed)):
            tokens, nodes, places = [], [], []
            for node, own in dict(group).items():
                first = order.rarest(own)
                tokens.append(first)
                nodes.append(np.full(len(first), node, np.int64))
                places.append((len(own) << PLACE_BITS) + np.arange(len(first), dtype=np.int64))
            if tokens:
                columns = [np.concatenate(tokens).view(np.int64), np.concatenate(nodes), np.concatenate(places)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "node", "place"])

    texts = docs.select(F.col(text).alias("__text"))
    return texts.mapInArrow(run, "token long, node long, place long")


def can_link(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """If sets that share a shingle at these places, and no rarer one, can overlap enough."""
    size_a, size_b = a >> PLACE_BITS, b >> PLACE_BITS
    rest = np.minimum(size_a - (a & (1 << PLACE_BITS) - 1), size_b - (b & (1 << PLACE_BITS) - 1))
    near = 100 * np.minimum(size_a, size_b) >= PERCENT * np.maximum(size_a, size_b)
    return near & ((100 + PERCENT) * rest >= PERCENT * (size_a + size_b))


def spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of a symmetric matrix that connect what all of its pairs connect."""
    left = np.ones(len(linked), bool)
    out = []
    for first in range(len(linked)):
        if not left[first]:
            continue
        left[first] = False
        todo = [first]
        while todo:
            at = todo.pop()
            found = np.flatnonzero(linked[at] & left).tolist()
            left[found] = False
            out += [(at, i) for i in found]
            todo += found
    return out


def meetings_of(token: np.ndarray, place: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Rows (first, node, n) of nodes that meet and can link; rows come sorted by shingle."""
    new = np.append(True, (token[1:] != token[:-1]) | (node[1:] != node[:-1]) | (place[1:] != place[:-1]))
    token, place, node = token[new], place[new], node[new]  # copies
    starts = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
    counts = np.diff(np.append(starts, len(token)))
    two = starts[counts == 2]
    two = two[can_link(place[two], place[two + 1])]
    least = np.minimum(node[two], node[two + 1])
    first, at = [least, least], [two, two + 1]
    for start, count in zip(starts[counts > 2].tolist(), counts[counts > 2].tolist(), strict=True):
        own = place[start : start + count]
        linked = can_link(own[:, None], own[None])
        np.fill_diagonal(linked, False)
        if not linked.any():
            continue
        group = np.arange(count)
        pairs = spanning(linked)
        for a, b in pairs:  # in order of discovery, so a has its group already
            group[b] = group[a]
        met = np.unique(np.array(pairs))
        names = node[start : start + count]
        least = np.full(count, np.iinfo(np.int64).max)
        np.minimum.at(least, group, names)
        first.append(least[group[met]])
        at.append(start + met)
    at = np.concatenate(at)
    return np.unique(np.stack([np.concatenate(first), node[at], place[at] >> PLACE_BITS]), axis=1)


def meetings(rows: DataFrame) -> DataFrame:
    """Groups of nodes that share a rare shingle and can link, as ``grouped`` returns them.

    Rows are dealt and sorted by shingle and read as a stream. The pairs of a shingle are tested
    by size and place; a shingle of more than ``HELD_ROWS`` rows is passed on row by row, all
    as one group. Groups of several shingles with the same first node are one.
    """
    ordered = rows.repartition("token").sortWithinPartitions("token", "place", "node")

    def run(batches):
        held = [np.zeros(0, np.int64)] * 3
        passing = None
        for batch in batches:
            more = [batch.column(c).to_numpy() for c in ("token", "place", "node")]
            if passing is not None:
                n = int(np.searchsorted(more[0], passing[0], side="right"))
                if n:
                    yield made(np.stack([np.full(n, passing[1]), more[2][:n], more[1][:n] >> PLACE_BITS]))
                more = [c[n:] for c in more]
            if not len(more[0]):
                continue
            passing = None
            held = [np.concatenate(c) for c in zip(held, more, strict=True)]
            last = int(np.searchsorted(held[0], held[0][-1]))
            if last:
                yield made(meetings_of(*(c[:last] for c in held)))
            held = [c[last:] for c in held]
            if len(held[0]) > HELD_ROWS:
                passing = held[0][0], held[2][0]
                yield made(np.stack([np.full(len(held[0]), passing[1]), held[2], held[1] >> PLACE_BITS]))
                held = [np.zeros(0, np.int64)] * 3
        if len(held[0]):
            yield made(meetings_of(*held))

    def made(columns):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["first", "node", "n"])

    met = cut(ordered.mapInArrow(run, "first long, node long, n long").distinct())
    return grouped(met.withColumnRenamed("first", "root"))


def grouped(rows: DataFrame) -> DataFrame:
    """``root``, ``node`` with the number of ``blocks`` that the group of a root is cut into."""
    blocks = F.greatest(F.sum("n") / BLOCK_SHINGLES, F.count("*") / BLOCK_NODES)
    sizes = rows.groupBy("root").agg(F.ceil(blocks).alias("blocks"))
    return rows.join(sizes, "root").select("root", "node", "n", "blocks")


def among(large: DataFrame, small: DataFrame, on: str) -> DataFrame:
    """Rows of ``large`` whose key is in ``small``, and few others, before they are shuffled.

    The keys of ``small`` are bits of a map of ``KEY_BITS`` bits, 8 MB, whatever their number. A join
    by key must follow: other keys share bits, and more of them the more keys there are.
    """
    bit = F.pmod(F.xxhash64(on), F.lit(KEY_BITS))
    bits = small.groupBy(F.bitmap_bucket_number(bit).alias("__bucket"))
    bits = bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("__bits"))
    place = F.bitmap_bit_position(bit)
    byte = F.substring("__bits", (place / 8).cast("int") + 1, F.lit(1))
    number = F.conv(F.hex(byte), 16, 10).cast("int")
    is_set = F.expr("shiftright(__byte, __bit) & 1 = 1")
    placed = large.withColumn("__bucket", F.bitmap_bucket_number(bit)).join(F.broadcast(bits), "__bucket")
    placed = placed.withColumns({"__byte": number, "__bit": (place % 8).cast("int")}).filter(is_set)
    return placed.select(*large.columns)


def sets_read(
    docs: DataFrame, keep: list[str], seed: int, shared: Broadcast, fragments: int, narrow: bool
) -> DataFrame:
    """``node``, the size ``n`` of its set, and the first ``fragments`` of it, a column for each.

    ``narrow`` hashes have their last 32 bits only; those of a set that agree in them are one.
    """

    def start():
        reader, order = Reader(seed), shared.value

        def sent(part):
            return (np.unique(part.astype(np.uint32)) if narrow else part).tobytes()

        def work(texts):
            nodes, sets = reader.read([lowered(t) for t in texts])
            parts = [[sent(p) for p in order.parts(s)[:fragments]] for s in sets]
            return [nodes.tolist(), [len(s) for s in sets], *[[own[i] for own in parts] for i in range(fragments)]]

        return work

    fields = "node long, n long, " + ", ".join(f"p{i} binary" for i in range(fragments))
    return append_columns(docs, "text", keep, fields, start)


def first_sets(
    docs: DataFrame, met: DataFrame, classes: DataFrame, seed: int, shared: Broadcast
) -> DataFrame:
    """``hashes`` of every node that meets in the first fragment of the order, for each group it is in.

    The text with the least id of a node is read for it, and hashed before it meets its groups,
    so that no text is shuffled. The hashes are narrow: ``pairs_of`` works out a bound from them,
    which hashes that agree by chance only raise.
    """
    nodes = met.groupBy("node").agg(F.collect_list(F.struct("root", "blocks")).alias("groups"))
    wanted = nodes.join(classes, "node")
    wanted = cut(wanted.select(F.col("least_id").alias("doc_id"), F.col("node").alias("held"), "groups"))
    read = sets_read(among(docs, wanted, "doc_id"), ["doc_id"], seed, shared, 1, narrow=True)
    # another text with the same id is not the one that is wanted
    rows = keyed_join(read, wanted, "doc_id", "inner").filter("node = held")
    return rows.select(F.inline("groups"), "node", "n", F.col("p0").alias("hashes"))


def sets_of(
    docs: DataFrame, groups: DataFrame, classes: DataFrame, seed: int, shared: Broadcast
) -> DataFrame:
    """``hashes`` of every node of the groups in all fragments of the order, one by one.

    The texts of these few nodes are read again, as they take less room than their hashes.
    """
    wanted = groups.join(classes, "node")
    wanted = cut(
        wanted.select(F.col("least_id").alias("doc_id"), F.col("node").alias("held"), "root", "blocks", "copies")
    )
    texts = keyed_join(among(docs, wanted, "doc_id"), wanted, "doc_id", "inner")
    read = sets_read(texts, ["held", "root", "blocks", "copies"], seed, shared, FRAGMENTS, narrow=False)
    parts = F.array(*[F.struct(F.lit(i).alias("fragment"), F.col(f"p{i}").alias("hashes")) for i in range(FRAGMENTS)])
    return read.filter("node = held").select("root", "blocks", "node", "n", "copies", F.inline(parts))


def overlap_matrix(sets: list[np.ndarray]) -> np.ndarray:
    """Overlap of every two sets, counted over some of their shingles at a time."""
    total = np.zeros((len(sets), len(sets)), np.float32)
    values = np.concatenate(sets)
    if not len(values):
        return total
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.append(True, values[1:] != values[:-1])
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    owner = owner[shared]
    column = np.cumsum(new[shared]) - 1  # a shared shingle's first row is shared too
    if not len(column):
        return total
    width = min(int(column[-1]) + 1, max(64, MATRIX_CELLS // len(sets)))
    edges = np.searchsorted(column, np.arange(0, column[-1] + width + 1, width))
    for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        held = np.zeros((len(sets), width), np.float32)
        held[owner[a:b], column[a:b] - i * width] = 1
        total += held @ held.T
    return total


def linked_pairs(nodes: list[int], sets: list[np.ndarray], sizes: list[int], sides: list[int]):
    """Pairs that connect what all pairs connect whose overlap is, or still can be, large enough.

    Where ``sets`` are fragments, the rest of both sets may overlap as far as sizes allow.
    ``sides`` tells two blocks apart; if both occur, only pairs between them are looked for.
    """
    size = np.array(sizes, np.float64)
    rest = size - [len(s) for s in sets]
    if len(nodes) == 2:
        both = np.intersect1d(*sets, assume_unique=True).size + rest.min()
        return [(nodes[0], nodes[1])] if 100 * both >= PERCENT * (size.sum() - both) else []
    overlap = overlap_matrix(sets)
    linked = np.empty(overlap.shape, bool)
    # in strips, as the other matrices take several times its memory
    for a in range(0, len(nodes), STRIP_ROWS):
        rows = slice(a, a + STRIP_ROWS)
        both = overlap[rows] + np.minimum(rest[rows, None], rest[None])
        linked[rows] = 100 * both >= PERCENT * (size[rows, None] + size[None] - both)
    side = np.array(sides)
    if len(set(sides)) == 2:
        linked &= side[:, None] != side[None]
    np.fill_diagonal(linked, False)
    return [(nodes[a], nodes[b]) for a, b in spanning(linked)]


def in_blocks(sets: DataFrame) -> DataFrame:
    """``sets`` by group and pair (i, j) of its blocks."""
    block = F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks"))
    partner = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    placed = sets.withColumn("block", block).withColumn("partner", partner)
    low, high = F.least("block", "partner").alias("i"), F.greatest("block", "partner").alias("j")
    rest = [c for c in sets.columns if c not in ("root", "blocks")]
    return placed.select("root", low, high, "block", *rest)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], names: list[str]):
    """The rows of each key, which are sorted by it, as lists of the named columns."""
    at, held = None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in (*keys, *names)]
        for row in zip(*columns, strict=True):
            key = row[: len(keys)]
            if key != at:
                if held:
                    yield at, [list(c) for c in zip(*held, strict=True)]
                at, held = key, []
            held.append(row[len(keys) :])
    if held:
        yield at, [list(c) for c in zip(*held, strict=True)]


def pairs_of(sets: DataFrame) -> DataFrame:
    """``linked_pairs`` of each group by its first fragment, each pair of blocks in one task."""
    keys = ["root", "i", "j"]

    def run(batches):
        made: list[tuple] = []
        for _, (nodes, sizes, sides, hashes) in whole_groups(batches, keys, ["node", "n", "block", "hashes"]):
            # repeated ids bring a node several times
            own = {node: (np.frombuffer(h, np.uint32), n, side) for node, n, side, h in
                   zip(nodes, sizes, sides, hashes, strict=True)}
            if len(own) > 1:
                made += linked_pairs(list(own), *zip(*own.values(), strict=True))
            if len(made) > SENT_ROWS:
                yield rows_batch(["a", "b"], made, [pa.int64()] * 2)
                made = []
        if made:
            yield rows_batch(["a", "b"], made, [pa.int64()] * 2)

    placed = in_blocks(sets)
    return placed.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def rows_batch(names: list[str], rows: list[tuple], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


PARTIAL = ["root", "i", "j", "strip", "fragment", "nodes", "overlaps"]


def partial_overlaps(sets: DataFrame) -> DataFrame:
    """Overlaps of all pairs of a group in one fragment of the order, one task for each fragment.

    ``overlaps`` has some rows of the matrix of the group's pairs, in order of node, and
    ``nodes``, with the first fragment only, its nodes, their sizes, copies and sides.
    """
    keys = ["root", "i", "j", "fragment"]

    def run(batches):
        names = ["node", "n", "copies", "block", "hashes"]
        types = [pa.int64()] * 5 + [pa.binary()] * 2
        made, size = [], 0
        for (root, i, j, fragment), columns in whole_groups(batches, keys, names):
            rows = {row[0]: row for row in zip(*columns, strict=True)}
            rows = [rows[node] for node in sorted(rows)]
            if len(rows) < 2:
                continue
            total = overlap_matrix([np.frombuffer(r[4], np.uint64) for r in rows]).astype("<u4")
            own = np.array([r[:4] for r in rows], np.int64).tobytes() if fragment == 0 else None
            for strip, a in enumerate(range(0, len(rows), STRIP_ROWS)):
                packed_rows = zstandard.compress(total[a : a + STRIP_ROWS].tobytes(), 1)
                made.append((root, i, j, strip, fragment, own, packed_rows))
                size += len(packed_rows)
            if size > SENT_BYTES or len(made) > SENT_ROWS:
                yield rows_batch(PARTIAL, made, types)
                made, size = [], 0
        if made:
            yield rows_batch(PARTIAL, made, types)

    placed = in_blocks(sets).withColumn("fragment", F.col("fragment").cast("long"))
    schema = "root long, i long, j long, strip long, fragment long, nodes binary, overlaps binary"
    return placed.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def links_of(partial: DataFrame) -> DataFrame:
    """Partial overlaps of each pair, summed over the fragments, as links.

    Rows (a, b) connect what all links connect; rows (a, ``links``) have the number of documents
    that node ``a`` is linked with in some rows of a matrix.
    """
    keys = ["root", "i", "j", "strip"]

    def run(batches):
        made: list[tuple] = []
        for (*_, strip), (nodes, overlaps) in whole_groups(batches, keys, ["nodes", "overlaps"]):
            own = np.frombuffer(next(n for n in nodes if n is not None), np.int64).reshape(-1, 4)
            node, size, copies, side = own.T
            first = strip * STRIP_ROWS
            rows = slice(first, min(first + STRIP_ROWS, len(node)))
            both = np.zeros((rows.stop - first, len(node)), np.int64)
            for blob in overlaps:
                both += np.frombuffer(zstandard.decompress(blob), "<u4").reshape(both.shape)
            linked = 100 * both >= PERCENT * (size[rows, None] + size[None] - both)
            if side.min() != side.max():
                linked &= side[rows, None] != side[None]
            linked[np.arange(len(linked)), np.arange(first, rows.stop)] = False
            held = np.flatnonzero(linked.any(1))
            if len(held):
                number = linked[held] @ copies
                made += [(a, None, x) for a, x in zip(node[first + held].tolist(), number.tolist(), strict=True)]
                pairs = forest(linked)
                a, b = node[first + pairs[:, 0]].tolist(), node[pairs[:, 1]].tolist()
                made += [(x, y, None) for x, y in zip(a, b, strict=True)]
            if len(made) > SENT_ROWS:
                yield rows_batch(["a", "b", "links"], made, [pa.int64()] * 3)
                made = []
        if made:
            yield rows_batch(["a", "b", "links"], made, [pa.int64()] * 3)

    schema = "a long, b long, links long"
    return partial.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def forest(linked: np.ndarray) -> np.ndarray:
    """Pairs (row, column) of a matrix that connect what all of its pairs connect."""
    free = np.ones(linked.shape[1], bool)
    waiting = linked.any(1)
    out = []
    for start in range(len(linked)):
        todo = [start] if waiting[start] else []
        waiting[start] = False
        while todo:
            row = todo.pop()
            found = np.flatnonzero(linked[row] & free)
            free[found] = False
            out += [(row, c) for c in found.tolist()]
            # rows that share one of the columns come next; one pair ties each to the others
            for c in found.tolist():
                more = np.flatnonzero(linked[:, c] & waiting)
                waiting[more] = False
                out += [(r, c) for r in more.tolist()]
                todo += more.tolist()
    return np.array(out, np.int64).reshape(-1, 2)


def components(found: DataFrame) -> DataFrame:
    """``node`` and ``root``, its component's least node, for every node with a link.

    Rounds of large and small stars: each node hands its larger, then its smaller neighbours
    to its least one, until every component is a star. The number of rounds grows with the
    logarithm of the nodes.
    """
    pairs = found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    stars = cut(pairs.filter("a > b").distinct())
    before = None
    while True:
        state = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = state
        sides = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = sides.groupBy("a").agg(F.min("b").alias("least"))
        least = least.withColumn("least", F.least("a", "least"))
        large = sides.join(least, "a").filter("b > a")
        large = large.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a")
        handed = small.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            small.select("a", F.col("least").alias("b"))
        )
        stars = cut(handed.filter("a > b").distinct())


def near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, the least id reachable by links, ``n_links``."""
    docs = docs.select("doc_id", F.col(text).alias("text"))
    seed = 0
    while True:
        rows = cut(signatures(docs, "text", seed))
        known = rows.filter("n_shingles > 0 and doc_id is not null")
        classes = known.groupBy("node").agg(
            F.min("doc_id").alias("least_id"),
            F.count("*").alias("copies"),
            F.min("other").alias("x"),
            F.max("other").alias("y"),
        )
        classes = cut(classes)
        if classes.filter("x <> y").isEmpty():
            break
        seed += 1
    classes = classes.select("node", "least_id", "copies")
    named = docs.filter("doc_id is not null")
    total = known.agg(F.sum("n_shingles")).first()[0] or 0
    shared = docs.sparkSession.sparkContext.broadcast(frequent_shingles(named, "text", total, seed))
    met = meetings(prefixes(named, "text", seed, shared))
    near = components(pairs_of(first_sets(named, met, classes, seed, shared)))
    near = grouped(near.join(met.select("node", "n").distinct(), "node"))
    # every node is in one group now, so every pair is counted once
    partial = partial_overlaps(sets_of(named, near, classes, seed, shared))
    links = cut(links_of(partial))
    roots = components(links.filter("b is not null").select("a", "b"))
    linked = roots.join(classes, "node")
    linked = linked.join(linked.groupBy("root").agg(F.min("least_id").alias("component")), "root")
    linked = linked.select("node", "component")
    number = links.filter("links is not null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    placed = rows.join(classes, "node", "left").join(linked, "node", "left").join(number, "node", "left")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.coalesce("component", "least_id"))
    n_links = F.when(alone, 0).otherwise(F.col("copies") - 1 + F.coalesce("links", F.lit(0)))
    return placed.select(
        "doc_id", "n_shingles", component.alias("component_id"), n_links.cast("long").alias("n_links")
    )

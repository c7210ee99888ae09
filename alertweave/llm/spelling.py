"""Spelling variants: words that differ by one code point, and the form each one is grouped under.

Two words are near if one inserted, deleted or replaced code point makes one the other. A word's
form is its most frequent near word (ties: the smallest), if that one is at least ``RATIO`` times
as frequent; its root is where its forms end.

The words are sorted into a trie, and the reversed words into another, whose nodes are numbered.
A word then is a list of prefix nodes and a list of suffix nodes. It enters the pair dictionary
under (prefix node, suffix node) once with every position skipped and once cut at every position.
Two words under one pair that skip a position differ there only; a word cut there lacks the code
point that the other one skips. In a stretch of equal code points only the first is skipped for
a shorter word, so that near words meet under exactly one pair, and nothing is verified.

Words under one pair agree but for one code point, so a pair has no more words than the alphabet
has code points, and one more that is cut: no group grows with the data. Each member reads its
number of near words and its best one from the group's totals; pairs of words are not made.

Numbering is distributed. Words are dealt by boundary words into sorted ranges, one task each,
which number the nodes that no other range has. Nodes that two ranges may share are prefixes of
a boundary word; these are numbered beforehand. Boundary words come from a bounded sample, which
decides how much a task holds and no result.

Defined results: null and empty texts have no words; a null id is hashed as an empty text; repeated
rows count again; words of any length take part; an empty table, or one without words, gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertweave.operators.lineage import cut

RUN = r"[A-Za-zÀ-ÿ]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
# words that one range of the trie holds, about, and words sampled for each boundary
RANGE_WORDS = 200_000
SAMPLED = 32
# code points of a boundary word
BOUNDARY_LENGTH = 64
# a node's number is that of its range, then its own
RANGE_BITS = 40

# a word under a pair: cut there, skips a position for words of its length, or for shorter ones too
CUT, SKIPS, SKIPS_FIRST = 0, 1, 2
KINDS = 4


def runs_of(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id`` and ``run``, A-Z lower-cased, for every maximal run that is long enough."""
    found = F.regexp_extract_all(F.col(text), F.lit(f"{RUN}{{{MIN_LENGTH},}}"), F.lit(0))
    rows = docs.select("doc_id", F.explode(found).alias("run"))
    return rows.withColumn("run", F.translate("run", UPPER, UPPER.lower()))


def count_words(runs: DataFrame, word: Column | str = "run") -> DataFrame:
    """``word`` and its number ``n``, of those that are long and frequent enough."""
    words = runs.select((F.col(word) if isinstance(word, str) else word).alias("word"))
    counted = words.filter(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= MIN_COUNT)


def boundaries(words: DataFrame, column: Column, ranges: int) -> list[str]:
    """Words that cut the sorted ``column`` into about as many ranges of about the same size."""
    if ranges < 2:
        return []
    chosen = words.orderBy(F.xxhash64("word")).limit(ranges * SAMPLED)
    sample = sorted(r[0] for r in chosen.select(column.substr(1, BOUNDARY_LENGTH)).collect())
    return sorted(set(sample[SAMPLED::SAMPLED]))


class Ranges:
    """Sorted ranges of words, and the numbers of the nodes that several of them may share."""

    def __init__(self, cuts: list[str]) -> None:
        self.cuts = cuts
        prefixes = {word[:i] for word in cuts for i in range(1, len(word) + 1)}
        # negative, so that no range has them; 0 is the root
        self.shared = {prefix: -1 - i for i, prefix in enumerate(sorted(prefixes))}

    def dealt(self, words: DataFrame, column: Column) -> DataFrame:
        """``words`` with their ``range``, each in one partition, in order of ``sorted``."""
        cuts = np.array(self.cuts, object)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = np.searchsorted(cuts, np.array(batch.column("sorted").to_pylist(), object), "right")
                numbers = pa.array(found.astype(np.int64))
                yield pa.RecordBatch.from_arrays([*batch.columns, numbers], [*batch.schema.names, "range"])

        ready = words.withColumn("sorted", column)
        schema = T.StructType([*ready.schema, T.StructField("range", T.LongType())])
        placed = ready.mapInArrow(place, schema)
        return placed.repartition(len(self.cuts) + 1, "range").sortWithinPartitions("range", "sorted")

    def numbered(self, rows: Iterator[tuple]) -> Iterator[tuple[int, list[int], tuple]]:
        """Order and trie nodes of every word, from the root on; rows start with range and word."""
        at, before, path = None, "", [0]
        order = number = count()
        for row in rows:
            own, word = row[:2]
            if own != at:
                at, before, path = own, "", [0]
                order, number = count(own << RANGE_BITS), count((own << RANGE_BITS) + 1)
                low = self.cuts[own - 1] if own else ""
                high = self.cuts[own] if own < len(self.cuts) else ""
            same = common(before, word)
            known = max(common(low, word), common(high, word))
            del path[same + 1 :]
            for i in range(same + 1, len(word) + 1):
                path.append(self.shared[word[:i]] if i <= known else next(number))
            before = word
            yield next(order), path, row


def common(a: str, b: str) -> int:
    """Length of the longest common prefix."""
    if b.startswith(a):
        return len(a)
    for i, (x, y) in enumerate(zip(a, b, strict=False)):
        if x != y:
            return i
    return min(len(a), len(b))


def rows_of(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(n).to_pylist() for n in names], strict=True)


def grouped(rows: Iterator, size: int) -> Iterator[list]:
    """Lists of rows; ``size`` bounds the numbers that their second items hold, beside one row's."""
    held, n = [], 0
    for row in rows:
        held.append(row)
        n += len(row[1])
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def forward(words: DataFrame, ranges: Ranges) -> DataFrame:
    """``word``, ``n``, its number in sorted order ``id``, and its prefix nodes."""

    def run(batches):
        rows = ((i, list(p), r) for i, p, r in ranges.numbered(rows_of(batches, ["range", "word", "n"])))
        for part in grouped(rows, 200_000):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[1] for _, _, r in part], pa.string()),
                    pa.array([r[2] for _, _, r in part], pa.int64()),
                    pa.array([i for i, _, _ in part], pa.int64()),
                    pa.array([p for _, p, _ in part], pa.list_(pa.int64())),
                ],
                ["word", "n", "id", "prefixes"],
            )

    schema = "word string, n long, id long, prefixes array<long>"
    return ranges.dealt(words, F.col("word")).mapInArrow(run, schema)


def pair_dictionary(nodes: DataFrame, ranges: Ranges) -> DataFrame:
    """(``prefix``, ``suffix``) of every word with each position skipped, and cut at each one.

    ``member`` is the word's number and the kind of its entry.
    """

    def entries(i: int, n: int, word: str, prefixes: list[int], path: list[int]) -> np.ndarray:
        length = len(word)
        heads, tails = np.array(prefixes, np.int64), np.array(path[::-1], np.int64)
        letters = np.frombuffer(word.encode("utf-32-le"), np.uint32)[::-1]
        kinds = np.full(2 * length + 1, CUT, np.int64)
        kinds[length + 1 :] = SKIPS + np.append(True, letters[1:] != letters[:-1])
        return np.stack(
            [
                np.concatenate([heads, heads[:-1]]),
                np.concatenate([tails, tails[1:]]),
                i * KINDS + kinds,
                np.full(2 * length + 1, n, np.int64),
            ]
        )

    def run(batches):
        names = ["range", "sorted", "id", "n", "prefixes"]
        rows = ((r[2:], r[1], entries(r[2], r[3], r[1], r[4], p)) for _, p, r in ranges.numbered(rows_of(batches, names)))
        for part in grouped(rows, 100_000):
            columns = np.concatenate([e for _, _, e in part], axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], ["prefix", "suffix", "member", "n"]
            )

    rows = nodes.select("id", "n", "prefixes", F.reverse("word").alias("word"))
    schema = "prefix long, suffix long, member long, n long"
    return ranges.dealt(rows, F.col("word")).mapInArrow(run, schema)


def neighbours(entries: DataFrame) -> DataFrame:
    """``id`` of every word that has near words, with their number and the best of them."""
    names = ["prefix", "suffix", "member", "n"]
    ordered = entries.repartition("prefix", "suffix").sortWithinPartitions("prefix", "suffix")

    def run(batches):
        held = np.zeros((4, 0), np.int64)
        for batch in batches:
            more = np.stack([batch.column(c).to_numpy() for c in names])
            held = np.concatenate([held, more], axis=1)
            if not held.shape[1]:
                continue
            last = (held[:2] == held[:2, -1:]).all(axis=0)
            whole = int(np.argmax(last))  # rows of the last pair may go on in the next batch
            if whole:
                yield made(totals(held[:, :whole]))
                held = held[:, whole:]
        if held.shape[1]:
            yield made(totals(held))

    def made(columns):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "near", "best_n", "best_id"])

    near = ordered.mapInArrow(run, "id long, near long, best_n long, best_id long")
    best = F.max(F.struct("best_n", (-F.col("best_id")).alias("order")))
    found = near.groupBy("id").agg(F.sum("near").alias("n_near"), best.alias("best"))
    return found.select("id", "n_near", F.col("best.best_n").alias("best_n"), (-F.col("best.order")).alias("best_id"))


def totals(rows: np.ndarray) -> np.ndarray:
    """Rows (word, near words, frequency and number of the best) of the members of each pair.

    ``rows`` has prefix, suffix, member and frequency, and all rows of the pairs in it.
    """
    new = np.append(True, (rows[:2, 1:] != rows[:2, :-1]).any(axis=0))
    group = np.cumsum(new) - 1
    several = (np.bincount(group) > 1)[group]
    _, _, member, n = rows[:, several]
    group = np.unique(group[several], return_inverse=True)[1]
    if not len(group):
        return np.zeros((4, 0), np.int64)
    word, kind = member // KINDS, member % KINDS
    # the best first, in every group
    order = np.lexsort((word, -n, group))
    group, word, kind, n = group[order], word[order], kind[order], n[order]
    groups = int(group[-1]) + 1

    def firsts(these: np.ndarray, but: np.ndarray | None = None) -> np.ndarray:
        """Place of the first of these rows in each group, -1 for none."""
        at = np.flatnonzero(these if but is None else these & (np.arange(len(group)) != but[group]))
        out = np.full(groups, -1)
        out[group[at[::-1]]] = at[::-1]
        return out

    skips, first, whole = kind != CUT, kind == SKIPS_FIRST, kind == CUT
    number = {name: np.bincount(group[these], minlength=groups)[group] for name, these in
              (("skips", skips), ("first", first), ("whole", whole))}
    near = np.where(whole, number["first"], number["skips"] - 1 + first * number["whole"])
    top = firsts(skips)
    second, top_first, cut_word = firsts(skips, top), firsts(first), firsts(whole)
    place = np.arange(len(group))
    other = np.where(top[group] == place, second[group], top[group])
    shorter = np.where(first, cut_word[group], -1)
    # places are ordered by rank, so the better of two is the one that comes first
    far = len(group)
    better = np.minimum(np.where(other < 0, far, other), np.where(shorter < 0, far, shorter))
    best = np.where(whole, top_first[group], np.where(better == far, -1, better))
    kept = near > 0
    return np.stack([word[kept], near[kept], n[best[kept]], word[best[kept]]])


def follow(links: DataFrame, steps: int) -> DataFrame:
    """``id`` and ``root``, where the chain of ``form`` ends that starts at ``id``.

    Chains are doubled, so that ``steps``, the longest chain, takes its logarithm in rounds.
    """
    at = links.select("id", F.col("form").alias("root"))
    for _ in range(max(0, steps - 1).bit_length()):
        further = at.select(F.col("id").alias("root"), F.col("root").alias("next"))
        at = cut(at.join(further, "root", "left").select("id", F.coalesce("next", "root").alias("root")))
    return at


def variants(words: DataFrame, range_words: int = RANGE_WORDS) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of every row of ``words``.

    ``words`` has distinct ``word`` and their number ``n``.
    """
    words = cut(words.select("word", F.col("n").cast("long").alias("n")))
    rows, most = words.agg(F.count("*"), F.max("n")).first()
    ranges = -(-rows // range_words)

    def cuts(column: Callable[[str], Column]) -> Ranges:
        return Ranges(boundaries(words, column("word"), ranges))

    nodes = cut(forward(words, cuts(F.col)))
    near = cut(neighbours(pair_dictionary(nodes, cuts(F.reverse))))
    named = nodes.select("id", "word", "n").join(near, "id", "left")
    is_form = F.col("best_n") >= RATIO * F.col("n")
    links = near.join(nodes.select("id", "n"), "id").filter(is_form).select("id", F.col("best_id").alias("form"))
    # every form is ``RATIO`` times as frequent, so chains end soon
    steps, times = 0, MIN_COUNT * RATIO
    while times <= (most or 0):
        steps, times = steps + 1, times * RATIO
    roots = follow(cut(links), steps)
    texts = nodes.select("id", "word")
    grouped_words = (
        roots.join(links, "id")
        .join(texts.select(F.col("id").alias("form"), F.col("word").alias("form_word")), "form")
        .join(texts.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root")
        .select("id", "form_word", "root_word")
    )
    return named.join(grouped_words, "id", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.col("form_word").alias("form"),
        F.when(F.col("form_word").isNotNull(), F.col("best_n")).alias("form_n"),
        F.coalesce("root_word", "word").alias("root"),
    )

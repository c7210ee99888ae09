"""Exact top-k search by inner product over a pivot-distance index.

Vectors x get one more component, sqrt(M - |x|^2) with M the greatest squared norm, and queries
get 0; then a greater inner product is a smaller distance. Each vector is keyed by its nearest
pivot and its distance to it, cut into annuli and these into blocks of bounded size. A query
visits the annuli whose triangle-inequality bound is least, takes the distance of its k-th
result as radius, and then visits exactly those others whose bound is within it.

Pivots come from a bounded sample (``SAMPLE_VECTORS``); every vector is indexed, and the result
is exact. The driver sees one row per annulus (bounds and number of blocks, no vectors), at most
``PIVOTS`` * ``RINGS`` whatever the data.

Defined results: vectors that are null or hold a null or non-finite component take no part;
shorter vectors count as if filled up with zeros; rows without an id take no part; a query's
own row is every row with its id; rows that repeat another row, id and vector, are one; ties go to
the smaller id; fewer than k candidates give fewer rows; an empty table gives an empty table.
Scores are exact as long as they and all partial sums are below 2**53.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from alertweave.operators.lineage import cut

SAMPLE_VECTORS = 4096
PIVOTS = 24
# annuli of a pivot cover its sample's distances in so many steps
ANNULI = 6
# annuli of a pivot in all; the last one holds whatever is farther out
RINGS = 2 * ANNULI
# vectors of a block, and queries that visit a block in one task
BLOCK_VECTORS = 4096
BLOCK_QUERIES = 4096
# queries that are scored at once, and visits that are handed on at once
SCORED_QUERIES = 512
HANDED_VISITS = 4096
# annuli of which every query visits one block first
FIRST_BLOCKS = 2
# distances carry rounding errors; bounds are widened by this share
SLACK = 1e-9


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id`` and ``v``, floor(scale * x) of every component, of vectors that take part."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    kept = vectors.filter("vec_id is not null and embedding is not null").filter(whole)
    return kept.select("vec_id", v.alias("v")).dropDuplicates(["vec_id", "v"])


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of a matrix, filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width)[None] < lengths[:, None]] = flat
    return out


@dataclass
class Pivots:
    """Pivots in the lifted space, the squared norm bound and each pivot's annulus width."""

    points: np.ndarray
    bound: float
    width: np.ndarray

    @staticmethod
    def choose(sample: np.ndarray, bound: float) -> Pivots:
        """Far apart from each other: each next pivot is the farthest from those before."""
        lifted = np.hstack([sample, np.sqrt(np.maximum(bound - (sample**2).sum(1), 0))[:, None]])
        chosen = [0]
        away = np.linalg.norm(lifted - lifted[0], axis=1)
        while len(chosen) < min(PIVOTS, len(lifted)) and away.max() > 0:
            chosen.append(int(away.argmax()))
            away = np.minimum(away, np.linalg.norm(lifted - lifted[chosen[-1]], axis=1))
        points = lifted[chosen]
        out = Pivots(points, bound, np.ones(len(points)))
        nearest, distance = out.nearest(sample)
        for p in range(len(points)):
            own = distance[nearest == p]
            if len(own) and own.max() > 0:
                out.width[p] = own.max() / ANNULI
        return out

    def distances(self, rows: np.ndarray, query: bool = False) -> np.ndarray:
        """Distances to all pivots; queries have 0 as last component."""
        square = (rows**2).sum(1)
        last = np.zeros(len(rows)) if query else np.sqrt(np.maximum(self.bound - square, 0))
        lifted = np.hstack([rows, last[:, None]])
        apart = (lifted**2).sum(1)[:, None] + (self.points**2).sum(1) - 2 * lifted @ self.points.T
        return np.sqrt(np.maximum(apart, 0))

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        every = self.distances(rows)
        at = every.argmin(1)
        return at, every[np.arange(len(rows)), at]


def index(vectors: DataFrame, pivots: Pivots, width: int) -> tuple[DataFrame, list[Row]]:
    """Blocks of at most about ``BLOCK_VECTORS`` vectors of one annulus, and a row per annulus."""
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)

    def key(batches):
        for batch in batches:
            at, distance = shared.value.nearest(matrix(batch.column("v"), width))
            ring = np.minimum(distance // shared.value.width[at], RINGS - 1).astype(np.int64)
            made = [batch.column("vec_id"), batch.column("v"), pa.array(at.astype(np.int64)),
                    pa.array(ring), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(made, ["vec_id", "v", "pivot", "ring", "distance"])

    schema = "vec_id long, v array<double>, pivot long, ring long, distance double"
    keyed = cut(vectors.mapInArrow(key, schema))
    annuli = cut(
        keyed.groupBy("pivot", "ring").agg(
            F.min("distance").alias("near"),
            F.max("distance").alias("far"),
            F.ceil(F.count("*") / BLOCK_VECTORS).alias("parts"),
        )
    )
    part = F.pmod(F.xxhash64("vec_id", "v"), F.col("parts")).alias("part")
    # at most PIVOTS * RINGS rows
    parts = F.broadcast(annuli.select("pivot", "ring", "parts"))
    placed = keyed.join(parts, ["pivot", "ring"]).select("pivot", "ring", part, "vec_id", "v")
    # by all three keys, as an annulus may hold any share of the vectors
    blocks = placed.repartition("pivot", "ring", "part").groupBy("pivot", "ring", "part").agg(
        F.collect_list(F.struct("vec_id", "v")).alias("rows")
    )
    name = F.concat_ws(".", "pivot", "ring", "part").alias("block")
    blocks = cut(blocks.select(name, F.col("rows.vec_id").alias("ids"), F.col("rows.v").alias("vs")))
    return blocks, annuli.orderBy("pivot", "ring").collect()


def visits(queries: DataFrame, annuli: list[Row], pivots: Pivots, width: int) -> DataFrame:
    """Query, block pairs to visit: without a radius the first blocks, else all others in reach.

    ``queries`` has ``radius``, null before the first visit.
    """
    bounds = {c: np.array([r[c] for r in annuli]) for c in ("pivot", "ring", "near", "far", "parts")}
    shared = queries.sparkSession.sparkContext.broadcast((pivots, bounds))

    def chosen(query: int, to: np.ndarray, radius: float, slack: float) -> Iterator[str]:
        _, bounds = shared.value
        least = np.maximum(np.maximum(to - bounds["far"], bounds["near"] - to), 0)
        first = np.lexsort((np.abs(to - bounds["near"]), least))[:FIRST_BLOCKS]
        # which block of an annulus comes first is dealt by query
        seen = {int(i): query % int(bounds["parts"][i]) for i in first}
        if np.isnan(radius):
            yield from (f"{bounds['pivot'][i]}.{bounds['ring'][i]}.{part}" for i, part in seen.items())
            return
        for i in np.flatnonzero(least <= radius + slack).tolist():
            for part in range(bounds["parts"][i]):
                if seen.get(i) != part:
                    yield f"{bounds['pivot'][i]}.{bounds['ring'][i]}.{part}"

    def choose(batches):
        pivots, bounds = shared.value
        slack = 1000 * SLACK * (1 + np.sqrt(pivots.bound))
        made: list[list] = [[], [], []]
        for batch in batches:
            vectors = matrix(batch.column("v"), width)
            away = pivots.distances(vectors, query=True)
            radius = batch.column("radius").to_numpy(zero_copy_only=False)
            for i, query in enumerate(batch.column("query_id").to_pylist()):
                for block in chosen(query, away[i][bounds["pivot"]], radius[i], slack):
                    made[0].append(query)
                    made[1].append(block)
                    made[2].append(vectors[i])
                    if len(made[0]) == HANDED_VISITS:
                        yield handed(made)
                        made = [[], [], []]
        if made[0]:
            yield handed(made)

    def handed(made):
        kinds = pa.int64(), pa.string(), pa.list_(pa.float64())
        arrays = [pa.array(c, t) for c, t in zip(made, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["query_id", "block", "q"])

    return queries.mapInArrow(choose, "query_id long, block string, q array<double>")


def search(visited: DataFrame, blocks: DataFrame, k: int, width: int, groups: int) -> DataFrame:
    """The k best of each visited block, queries of a block in groups of bounded size."""
    group = F.pmod(F.xxhash64("query_id"), F.lit(groups)).alias("group")
    packed = visited.groupBy("block", group).agg(
        F.collect_list("query_id").alias("query_ids"), F.collect_list("q").alias("qs")
    )
    work = packed.join(blocks.select("block", "ids", "vs"), "block")

    def score(batches):
        for batch in batches:
            made: list[list] = [[], [], []]
            for i in range(batch.num_rows):
                query_ids = batch.column("query_ids")[i].values.to_numpy(zero_copy_only=False)
                ids = batch.column("ids")[i].values.to_numpy(zero_copy_only=False)
                queries = matrix(batch.column("qs")[i].values, width)
                vectors = matrix(batch.column("vs")[i].values, width)
                n = min(k, len(ids))
                for start in range(0, len(query_ids), SCORED_QUERIES):
                    asked = query_ids[start : start + SCORED_QUERIES]
                    scores = queries[start : start + SCORED_QUERIES] @ vectors.T
                    scores[asked[:, None] == ids[None]] = -np.inf
                    least = np.partition(scores, len(ids) - n, axis=1)[:, len(ids) - n]
                    for row, query in enumerate(asked.tolist()):
                        at = np.flatnonzero((scores[row] >= least[row]) & (scores[row] > -np.inf))
                        at = at[np.lexsort((ids[at], -scores[row][at]))][:n]
                        made[0] += [query] * len(at)
                        made[1] += ids[at].tolist()
                        made[2] += scores[row][at].astype(np.int64).tolist()
            arrays = [pa.array(c, pa.int64()) for c in made]
            yield pa.RecordBatch.from_arrays(arrays, ["query_id", "vec_id", "score"])

    return work.mapInArrow(score, "query_id long, vec_id long, score long")


def best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``; queries are ids divisible by ``every``."""
    spark = vectors.sparkSession
    rows = cut(quantised(vectors.select("vec_id", "embedding")))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    facts = rows.agg(F.max(square), F.max(F.size("v")), F.count_if(F.col("vec_id") % every == 0)).first()
    width = max(1, facts[1] or 1)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_VECTORS).select("v").collect()
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    points = np.zeros((len(sample), width))
    for i, r in enumerate(sample):
        points[i, : len(r.v)] = r.v
    pivots = Pivots.choose(points, facts[0])
    blocks, annuli = index(rows, pivots, width)
    asked = rows.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "v")
    # rows of one id are one query: its first vector in order
    asked = asked.groupBy("query_id").agg(F.min("v").alias("v"))
    groups = -(-facts[2] // BLOCK_QUERIES) or 1
    first = asked.withColumn("radius", F.lit(None).cast("double"))
    near = cut(best(search(visits(first, annuli, pivots, width), blocks, k, width, groups), k))
    kth = near.filter(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
    # distance squared = |q|^2 + bound - 2 * score; all blocks are in reach of too few results
    apart = square + F.lit(facts[0]) - 2 * F.col("kth")
    reach = F.sqrt(F.greatest(apart, F.lit(0.0)))
    radius = F.when(F.col("kth").isNull(), F.lit(float("inf"))).otherwise(reach)
    again = asked.join(kth, "query_id", "left").select("query_id", "v", radius.alias("radius"))
    rest = search(visits(again, annuli, pivots, width), blocks, k, width, groups)
    every_result = near.select("query_id", "vec_id", "score").unionByName(rest)
    out = best(every_result.distinct(), k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

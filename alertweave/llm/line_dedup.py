"""Reversible line dedup: sharded cuckoo filters before exact reference counts.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Of a key with at
least ``MIN_LENGTH`` code points that several documents hold, only the document with the least id
keeps its lines. An index remembers the keys of all documents that it was given, so that more can
be added, and others taken out, at the cost of what comes or goes:

* ``refs``, one row for every document and key, written as they come;
* ``counts``, for every key its exact number of references and its least and greatest document,
  where each change appends new rows for the keys that it touches;
* ``filters``, a cuckoo filter of the keys with references for each shard of the key space. A
  key that its filter does not know is new, so it is not looked up in ``counts``; what the filter
  lets through is looked up exactly. Keys without references leave the filter, which a cuckoo
  filter allows as each key is in it once.

Shards are doubled, and their filters built anew from ``counts``, when keys outgrow them, so that a
filter is of bounded size and one task's work. A frequent line is counted in its map tasks first,
and only distinct keys meet the filters. Every change is a new version: its tables are
written first and named in ``versions`` last, so a change that failed is as if it never was.

Keys are 128-bit hashes, references are one per row and key. Defined results: a null or empty text
is one empty line; rows without doc_id are in no index and keep all lines; rows that share a
doc_id are one document, and repeat their result; texts are read whole; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alertweave.llm.common import by_size
from alertweave.session import checkpoint_folder

MIN_LENGTH = 10
WHITE = "\t\n\v\f\r "
# keys of a shard, at which shards are doubled; its filter has twice as many places
SHARD_KEYS = 1 << 17
SLOTS = 4
# fingerprints that find no place in as many rounds are kept beside the table
ROUNDS = 200
KEY = ["hi", "lo"]


class CuckooFilter:
    """A set of 64-bit numbers that may also seem to hold others; what is in it once may leave."""

    def __init__(self, buckets: int) -> None:
        self.table = np.zeros((buckets, SLOTS), np.uint16)
        # fingerprints without a place, and their lesser bucket
        self.stash: list[tuple[int, int]] = []

    @classmethod
    def loads(cls, blob: bytes, buckets: int) -> CuckooFilter:
        out = cls(buckets)
        table = np.frombuffer(blob, np.uint16, buckets * SLOTS)
        out.table = table.reshape(buckets, SLOTS).copy()
        rest = np.frombuffer(blob, np.int64, offset=out.table.nbytes)
        out.stash = list(zip(rest[::2].tolist(), rest[1::2].tolist(), strict=True))
        return out

    def dumps(self) -> bytes:
        return self.table.tobytes() + np.array(self.stash, np.int64).tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys = keys.view(np.uint64)
        prints = np.maximum(keys & np.uint64(0xFFFF), np.uint64(1)).astype(np.int64)
        first = (keys >> np.uint64(16)).astype(np.int64) & (len(self.table) - 1)
        return prints, first, self._other(prints, first)

    def _other(self, prints: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        return bucket ^ ((prints * 0x5BD1E995) & (len(self.table) - 1))

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, first, second = self._places(keys)
        held = (self.table[first] == prints[:, None]).any(1) | (self.table[second] == prints[:, None]).any(1)
        if self.stash:
            beside = set(self.stash)
            least = np.minimum(first, second)
            pairs = zip(prints.tolist(), least.tolist(), strict=True)
            held |= np.fromiter((p in beside for p in pairs), bool, len(keys))
        return held

    def insert(self, keys: np.ndarray) -> None:
        """Add keys that are not in the set; all at once, in rounds of moves."""
        prints, bucket, _ = self._places(keys)
        draw = np.random.default_rng(len(keys))
        for i in range(ROUNDS):
            if not len(prints):
                return
            order = np.argsort(bucket, kind="stable")
            prints, bucket = prints[order], bucket[order]
            start = np.append(True, bucket[1:] != bucket[:-1])
            place = np.arange(len(bucket))
            rank = place - np.maximum.accumulate(np.where(start, place, 0))
            free = np.cumsum(self.table[bucket] == 0, axis=1)
            fits = rank < free[:, -1]
            slot = (free <= rank[:, None]).sum(1)
            self.table[bucket[fits], slot[fits]] = prints[fits]
            prints, bucket, rank = prints[~fits], bucket[~fits], rank[~fits]
            if i and len(prints):
                # one of each bucket takes the place of another, which moves on
                _, one = np.unique(bucket, return_index=True)
                out = draw.integers(0, SLOTS, len(one))
                moved = self.table[bucket[one], out].astype(np.int64)
                self.table[bucket[one], out] = prints[one]
                prints[one] = moved
            bucket = self._other(prints, bucket)
        least = np.minimum(bucket, self._other(prints, bucket))
        self.stash += zip(prints.tolist(), least.tolist(), strict=True)

    def remove(self, keys: np.ndarray) -> None:
        """Take out keys that are in the set."""
        prints, first, second = self._places(keys)
        while len(prints):
            both = np.concatenate([self.table[first], self.table[second]], axis=1) == prints[:, None]
            found, at = both.any(1), both.argmax(1)
            place = np.where(at < SLOTS, first, second) * SLOTS + at % SLOTS
            # keys that share a fingerprint and a place leave one after the other
            _, one = np.unique(np.where(found, place, -1 - np.arange(len(place))), return_index=True)
            one = one[found[one]]
            self.table.reshape(-1)[place[one]] = 0
            for p, low in zip(prints[~found].tolist(), np.minimum(first, second)[~found].tolist(), strict=True):
                self.stash.remove((p, low))
            found[one] = False
            prints, first, second = prints[found], first[found], second[found]


def key_of(line: str) -> bytes | None:
    """A line's 128-bit key; short lines have none."""
    line = line.strip(WHITE)
    if len(line) < MIN_LENGTH:
        return None
    return hashlib.blake2b(line.encode("utf-8", "surrogatepass").lower(), digest_size=16).digest()


def line_refs(docs: DataFrame, text: str) -> DataFrame:
    """``hi``, ``lo`` and ``doc_id`` for every distinct key of every row with an id."""
    named = docs.filter("doc_id is not null").select("doc_id", F.col(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = iter(batch.column("doc_id").to_pylist())
            for group in by_size(batch.column("__text").to_pylist()):
                keys, owners = [], []
                for t in group:
                    own = {key_of(line) for line in (t or "").split("\n")} - {None}
                    keys += own
                    owners += [next(ids)] * len(own)
                if keys:
                    halves = np.frombuffer(b"".join(keys), np.int64)
                    columns = [pa.array(halves[::2]), pa.array(halves[1::2]), pa.array(owners, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, [*KEY, "doc_id"])

    return named.mapInArrow(run, "hi long, lo long, doc_id long")


class LineIndex:
    """Keys of lines and the documents that hold them, in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str, shard_keys: int = SHARD_KEYS) -> None:
        """An index of no documents; ``open`` finds one that exists."""
        self.spark = spark
        self.path = path
        self.shard_keys = shard_keys
        # filters have two places and more for each key that a shard may hold
        self.buckets = max(2, 1 << (2 * shard_keys // SLOTS - 1).bit_length())
        self.version = self.keys = self.bits = 0

    @classmethod
    def open(cls, spark: SparkSession, path: str, shard_keys: int = SHARD_KEYS) -> LineIndex:
        index = cls(spark, path, shard_keys)
        last = spark.read.parquet(f"{path}/versions").orderBy(F.desc("version")).first()
        index.version, index.keys, index.bits = last.version, last["keys"], last.bits
        return index

    @classmethod
    def temporary(cls, spark: SparkSession) -> LineIndex:
        return cls(spark, f"{checkpoint_folder(spark)}/alertweave/{uuid.uuid4().hex}")

    def _write(self, name: str, rows: DataFrame) -> DataFrame:
        """A part of the next version; it counts only once ``versions`` names it."""
        path = f"{self.path}/{name}/version={self.version + 1}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _read(self, name: str, schema: str) -> DataFrame:
        """All rows of a table up to this version, with their ``version``."""
        if not self.version:
            return self.spark.createDataFrame([], f"{schema}, version int")
        rows = self.spark.read.schema(f"{schema}, version int").parquet(f"{self.path}/{name}")
        return rows.filter(F.col("version") <= self.version)

    def _commit(self, keys: int, bits: int) -> None:
        row = [(self.version + 1, keys, bits)]
        self.spark.createDataFrame(row, "version int, keys long, bits int").coalesce(1).write.mode(
            "append"
        ).parquet(f"{self.path}/versions")
        self.version, self.keys, self.bits = row[0]

    def refs(self) -> DataFrame:
        """References of the documents that are in the index."""
        rows = self._read("refs", "hi long, lo long, doc_id long")
        gone = self._read("removed", "doc_id long").withColumnRenamed("version", "until")
        gone = gone.groupBy("doc_id").agg(F.max("until").alias("until"))
        held = rows.join(gone, "doc_id", "left").filter("until is null or version > until")
        return held.select(*KEY, "doc_id")

    def counts(self, only: DataFrame | None = None) -> DataFrame:
        """References of every key, the least and the greatest document; of some keys only."""
        rows = self._read("counts", "hi long, lo long, refs long, low long, high long")
        if only is not None:
            rows = rows.join(only.select(*KEY), KEY, "left_semi")
        last = F.max(F.struct("version", "refs", "low", "high")).alias("last")
        found = rows.groupBy(*KEY).agg(last).filter("last.refs > 0")
        return found.select(*KEY, "last.refs", "last.low", "last.high")

    def _filters(self) -> DataFrame:
        """``shard`` and its newest ``blob``; shards are of the number that holds now."""
        rows = self._read("filters", "shard long, bits int, blob binary").filter(F.col("bits") == self.bits)
        last = rows.groupBy("shard").agg(F.max("version").alias("version"))
        return rows.join(last, ["shard", "version"]).select("shard", "blob")

    def _shard(self, bits: int) -> Column:
        return F.expr(f"shiftrightunsigned(hi, {64 - bits})") if bits else F.lit(0).cast("long")

    def _by_shard(self, rows: DataFrame, bits: int, filters: DataFrame | None) -> DataFrame:
        """Rows by shard, each shard's filter before them; columns of the filter row are null."""
        placed = rows.withColumn("shard", self._shard(bits)).withColumn("blob", F.lit(None).cast("binary"))
        if filters is not None:
            placed = filters.unionByName(placed, allowMissingColumns=True)
        order = F.col("blob").isNull()
        return placed.repartition("shard").sortWithinPartitions("shard", order).select("shard", "blob", *rows.columns)

    def _tested(self, keys: DataFrame) -> DataFrame:
        """``keys`` with ``seen``: false if the filter of their shard tells that they are new."""
        buckets, names = self.buckets, keys.columns

        def run(batches):
            at, known = None, None
            for batch in batches:
                for shard, part in shards_of(batch):
                    blob = part.column("blob")[0].as_py()
                    if shard != at:
                        at, known = shard, CuckooFilter.loads(blob, buckets) if blob else None
                    rows = part.slice(1) if blob else part
                    if rows.num_rows:
                        low = rows.column("lo").to_numpy()
                        seen = known.contains(low) if known else np.zeros(len(low), bool)
                        columns = [rows.column(c) for c in names]
                        yield pa.RecordBatch.from_arrays([*columns, pa.array(seen)], [*names, "seen"])

        ready = self._by_shard(keys, self.bits, self._filters())
        return ready.mapInArrow(run, f"{', '.join(f'{c} long' for c in names)}, seen boolean")

    def _changed(self, come: DataFrame | None, gone: DataFrame | None, bits: int, anew: bool) -> DataFrame:
        """New filters of the shards that keys come into or go from."""
        buckets = self.buckets
        signs = [k.select(*KEY, F.lit(sign).alias("sign")) for k, sign in ((come, 1), (gone, -1)) if k is not None]
        rows = reduce(DataFrame.unionByName, signs)
        filters = None
        if not anew:
            touched = rows.select(self._shard(bits).alias("shard")).distinct()
            filters = self._filters().join(touched, "shard", "left_semi")

        def run(batches):
            at, known = None, None

            def made():
                blob = pa.array([known.dumps()], pa.binary())
                columns = [pa.array([at], pa.int64()), pa.array([bits], pa.int32()), blob]
                return pa.RecordBatch.from_arrays(columns, ["shard", "bits", "blob"])

            for batch in batches:
                for shard, part in shards_of(batch):
                    blob = part.column("blob")[0].as_py()
                    if shard != at:
                        if known:
                            yield made()
                        at, known = shard, CuckooFilter.loads(blob, buckets) if blob else CuckooFilter(buckets)
                    rows = part.slice(1) if blob else part
                    if rows.num_rows:
                        low, sign = rows.column("lo").to_numpy(), rows.column("sign").to_numpy()
                        known.remove(low[sign < 0])
                        known.insert(low[sign > 0])
            if known:
                yield made()

        return self._by_shard(rows, bits, filters).mapInArrow(run, "shard long, bits int, blob binary")

    def add(self, docs: DataFrame, text: str = "text") -> None:
        """Put documents that are not in the index into it."""
        refs = self._write("refs", line_refs(docs, text))
        ends = F.min("doc_id").alias("low"), F.max("doc_id").alias("high")
        batch = refs.groupBy(*KEY).agg(F.count("*").alias("refs"), *ends)
        tested = self._write("tested", self._tested(batch))
        old = self.counts(tested.filter("seen")).select(
            *KEY, *[F.col(c).alias(f"old_{c}") for c in ("refs", "low", "high")]
        )
        known = tested.filter("seen").drop("seen").join(old, KEY, "left")
        known = known.select(
            *KEY,
            (F.col("refs") + F.coalesce("old_refs", F.lit(0))).alias("refs"),
            F.least("low", "old_low").alias("low"),
            F.greatest("high", "old_high").alias("high"),
            F.col("old_refs").isNull().alias("new"),
        )
        new = tested.filter("not seen").select(*KEY, "refs", "low", "high", F.lit(True).alias("new"))
        counts = self._write("counts", new.unionByName(known))
        come = counts.filter("new")
        keys = self.keys + come.count()
        self._write("removed", self.spark.createDataFrame([], "doc_id long"))
        bits = max(self.bits, (max(1, -(-keys // self.shard_keys)) - 1).bit_length())
        anew = bits != self.bits
        if anew:
            come = self.counts().select(*KEY).unionByName(come.select(*KEY))
        self._write("filters", self._changed(come, None, bits, anew))
        self._commit(keys, bits)

    def remove(self, ids: DataFrame) -> None:
        """Take the documents with these ``doc_id`` out of the index, as if never added."""
        ids = self._write("removed", ids.select("doc_id").distinct())
        held = self.refs()
        gone = self._write("gone", held.join(ids, "doc_id", "left_semi").select(*KEY).distinct())
        rest = held.join(ids, "doc_id", "left_anti").join(gone, KEY, "left_semi")
        rest = rest.groupBy(*KEY).agg(
            F.count("*").alias("refs"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")
        )
        left = gone.join(rest, KEY, "left").withColumn("refs", F.coalesce("refs", F.lit(0)).cast("long"))
        counts = self._write("counts", left.withColumn("new", F.lit(False)))
        none = counts.filter("refs = 0")
        self._write("refs", self.spark.createDataFrame([], "hi long, lo long, doc_id long"))
        self._write("filters", self._changed(None, none, self.bits, False))
        self._commit(self.keys - none.count(), self.bits)

    def kept(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """``doc_id``, ``n_lines``, ``n_dropped`` and the ``kept`` text of documents in the index."""
        repeated = self.counts().filter("low <> high").select(*KEY, "low")
        lost = self.refs().join(repeated, KEY).filter("doc_id <> low").distinct()
        # a document's own keys, which are no more than its lines
        lost = lost.groupBy("doc_id").agg(F.collect_list(F.struct(*KEY)).alias("lost"))
        rows = docs.select("doc_id", F.col(text).alias("__text")).join(lost, "doc_id", "left")

        def run(batches):
            for batch in batches:
                ids, at = batch.column("doc_id"), 0
                drops = batch.column("lost")
                for group in by_size(batch.column("__text").to_pylist()):
                    end = at + len(group)
                    made = [kept_lines(t or "", d) for t, d in zip(group, drops[at:end].to_pylist(), strict=True)]
                    lines, dropped, texts = zip(*made, strict=True)
                    columns = [pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(texts, pa.string())]
                    names = ["doc_id", "n_lines", "n_dropped", "kept"]
                    yield pa.RecordBatch.from_arrays([ids[at:end], *columns], names)
                    at = end

        doc_id = docs.schema["doc_id"].dataType.simpleString()
        return rows.mapInArrow(run, f"doc_id {doc_id}, n_lines long, n_dropped long, kept string")


def shards_of(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The batch, which is in order of shards, shard by shard."""
    shards = batch.column("shard").to_numpy()
    edges = np.flatnonzero(shards[1:] != shards[:-1]) + 1 if len(shards) else shards
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(shards)], strict=True):
        if b > a:
            yield int(shards[a]), batch.slice(a, b - a)


def kept_lines(text: str, lost: list[dict] | None) -> tuple[int, int, str]:
    """Number of lines, of those that go, and the others."""
    if not lost:
        return text.count("\n") + 1, 0, text
    keys = {np.array([k["hi"], k["lo"]], np.int64).tobytes() for k in lost}
    lines = text.split("\n")
    left = [line for line in lines if key_of(line) not in keys]
    return len(lines), len(lines) - len(left), "\n".join(left)

"""Snapshots and outputs of a micro-batch pipeline as parquet, idempotent per batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from alertweave.sources.envelope import latest_wins


class Store:
    """Tables below one folder of a shared file system.

    A snapshot is written whole as ``name/v=<batch>``; a reader of batch *b* takes the
    newest finished version below *b*. An output is ``name/batch=<batch>``. A batch that
    runs again overwrites exactly what it wrote before, so a retry changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _versions(self, name: str, prefix: str) -> list[int]:
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        done = []
        for status in fs.listStatus(folder):
            label = status.getPath().getName()
            marker = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if label.startswith(prefix) and fs.exists(marker):
                done.append(int(label.removeprefix(prefix)))
        return sorted(done)

    def snapshot(
        self, name: str, schema: T.StructType, before: int | None = None
    ) -> DataFrame:
        """Newest version, or the newest one below a batch; empty when there is none."""
        versions = [
            v for v in self._versions(name, "v=") if before is None or v < before
        ]
        if not versions:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}/v={versions[-1]}")

    def replace(self, name: str, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{name}/v={batch_id}")

    def append(self, name: str, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{name}/batch={batch_id}")

    def output(self, name: str, schema: T.StructType) -> DataFrame:
        """All finished batches of an output."""
        batches = self._versions(name, "batch=")
        if not batches:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/{name}/batch={b}" for b in batches]
        return self.spark.read.schema(schema).parquet(*paths)


def upsert_snapshot(
    store: Store, name: str, batch: DataFrame, keys: list[str], order: list[str], batch_id: int
) -> None:
    """Newest row per key of the snapshot before this batch and the batch, as a new
    version; an older row never replaces a newer one."""
    old = store.snapshot(name, batch.schema, before=batch_id)
    store.replace(name, latest_wins(old, batch, keys, order).select(*batch.columns), batch_id)


def merge_latest(batch: DataFrame, table: str, keys: list[str], order: str) -> None:
    """Upsert into a table of a format with MERGE support; an older row changes nothing."""
    from pyspark.sql import functions as F

    on = F.lit(True)
    for key in keys:
        on = on & F.col(f"{table}.{key}").eqNullSafe(F.col(f"_new.{key}"))
    newer = F.col(f"_new.{order}") > F.col(f"{table}.{order}")
    (
        batch.alias("_new")
        .mergeInto(table, on)
        .whenMatched(newer)
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )

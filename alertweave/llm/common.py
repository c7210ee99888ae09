"""What the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from alertweave.session import configure

# rows of one Arrow batch: texts are long, so a batch is kept to a few megabytes
BATCH_ROWS = 1000
BATCH_BYTES = 32 << 20
# characters that Python works on at once, unless one text is longer
GROUP_CHARS = 1 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """The library's settings, with Arrow batches sized for whole documents."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def append_columns(
    df: DataFrame,
    text: str,
    keep: Iterable[str],
    fields: str,
    start: Callable[[], Callable[[list[str | None]], list[list]]],
) -> DataFrame:
    """``keep`` columns of ``df`` with the columns that Python makes from ``text``.

    ``start`` is called once per task and gives a function from the texts of a batch to
    one list per field of ``fields`` (a DDL string). A kept column whose name is also in
    ``fields`` gives way to the new one; columns that are not kept do not reach Python.
    """
    made = T.StructType.fromDDL(fields)
    kept = [c for c in dict.fromkeys(keep) if c not in made.fieldNames()]
    columns = [F.col(f"`{c}`") for c in kept]
    read = text if text in kept else "__text"
    source = df.select(*columns, *[F.col(f"`{text}`").alias(read)] * (read not in kept))
    schema = T.StructType([f for f in source.schema if f.name in kept] + list(made))
    types = [to_arrow_type(f.dataType) for f in made]
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            columns: list[list] = [[] for _ in types]
            for group in by_size(batch.column(read).to_pylist()):
                for column, more in zip(columns, work(group), strict=True):
                    column.extend(more)
            arrays = [pa.array(c, type=t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + arrays, names)

    return source.mapInArrow(run, schema)


def by_size(texts: list[str | None]) -> Iterator[list[str | None]]:
    """The texts in order, in groups of bounded length; a longer text is a group of its own."""
    group: list[str | None] = []
    size = 0
    for text in texts:
        if group and size + len(text or "") > GROUP_CHARS:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text or "")
    if group:
        yield group


def keyed_join(large: DataFrame, small: DataFrame, on: str, how: str) -> DataFrame:
    """Join by key; Spark broadcasts ``small``, a written table, by its size in bytes or not at all."""
    return large.join(small, on, how)

"""Cutting long lineage with a table in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from alertweave.session import checkpoint_folder


def cut(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared folder and read them back.

    Several results built from one long plan then start from the written table. It is a
    parquet table, so later steps still prune columns, and a lost executor costs no
    recomputation of what came before.
    """
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/alertweave/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

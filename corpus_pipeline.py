"""A training corpus from the documents: filtered, deduplicated, decontaminated, cleaned, encoded.

Every stage takes (spark, docs, folder) and returns a DataFrame. All but the last return the
columns of ``docs``; extra columns pass through, also those named like an operator's result.
Rows without doc_id are kept by the stages that work by id. Rows that repeat an id and a text
count as copies of each other.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertweave.llm import bpe, decontaminate, ngram_join, secret_scan, toxicity
from alertweave.llm.common import keyed_join, prepare, table
from alertweave.llm.queries import BYTE_RANKS
from alertweave.operators.lineage import cut


def _renamed(docs: DataFrame) -> tuple[DataFrame, str, list[str]]:
    """``docs`` with column names that no operator uses, its text column, all columns."""
    names = [f"__c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), names[docs.columns.index("text")], names


def toxicity_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that are predicted to be toxic go."""
    prepare(spark)
    field = toxicity.train(docs, table(spark, folder, "labels"))
    plain, text, names = _renamed(docs)
    scored = toxicity.tag(plain, field, text=text, keep=names)
    return scored.filter("predicted = 0").select(*names).toDF(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of linked documents, the one with the least id stays."""
    prepare(spark)
    found = cut(ngram_join.near_duplicates(docs).filter("doc_id is not null"))
    ids = found.groupBy("doc_id").agg(
        F.min((F.col("component_id") != F.col("doc_id")).cast("int")).alias("goes"),
        F.count("*").alias("rows"),
    )
    ids = cut(ids.filter("goes = 1 or rows > 1"))
    kept = keyed_join(docs, ids.filter("goes = 1").select("doc_id"), "doc_id", "left_anti")
    repeated = ids.filter("goes = 0").select("doc_id")
    if repeated.isEmpty():
        return kept
    once = keyed_join(kept, repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return keyed_join(kept, repeated, "doc_id", "left_anti").unionByName(once).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    prepare(spark)
    plain, text, names = _renamed(docs)
    found = decontaminate.find_leaks(plain, table(spark, folder, "benchmark"), text=text, keep=names)
    return found.filter("n_hit = 0").select(*names).toDF(*docs.columns)


def secrets_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Secrets in texts are replaced by a mark; ``n_chars`` follows the text."""
    prepare(spark)
    plain, text, names = _renamed(docs)
    found = secret_scan.scan_secrets(plain, text=text, keep=names)
    found = found.withColumn(text, secret_scan.redact(F.col(text), F.col("spans")))
    if "n_chars" in docs.columns:
        number = names[docs.columns.index("n_chars")]
        changed = F.length(text).cast(docs.schema["n_chars"].dataType)
        found = found.withColumn(number, F.when(F.size("spans") > 0, changed).otherwise(F.col(number)))
    return found.select(*names).toDF(*docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of every text, and digests of the ids and of the bytes they decode to."""
    prepare(spark)
    ids = bpe.encode(docs, public_tokenizers.path(BYTE_RANKS), offsets=False, decode=True)
    return ids.select(
        "doc_id",
        "n_tokens",
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("byte_bpe", encoding_stage),
]
# the first stages have no SQL; tests compare the pipeline with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents, each written and read again before the next."""
    docs = table(prepare(spark), folder, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, folder)
        if i < len(STAGES) - 1:
            docs = cut(docs)
    return docs

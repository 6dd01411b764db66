"""The corpus pipeline: documents in, packed training sequences out."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm import line_dedup, mixing, near_dedup, packing, quality_rules
from tidewire.llm.common import table
from tidewire.session import shared_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is one of ``kept``; columns as they are."""
    ids = kept.select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(F.col("kept_id")), "left_semi")


def host_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or their host's verdict reject go."""
    return _only(docs, quality_rules.judge(docs).filter("kept"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go from all documents but their first; every document stays."""
    inside = docs.withColumnsRenamed({c: f"in_{c}" for c in docs.columns})
    cleaned = line_dedup.dedup_lines(inside, key="in_doc_id", text="in_text", site="in_source")
    length = F.when(F.col("n_removed") > 0, F.length("in_text"))
    return cleaned.select(*[
        F.coalesce(length, f"in_{c}").cast(kind).alias(c) if c == "n_chars"
        else F.col(f"in_{c}").alias(c)
        for c, kind in docs.dtypes
    ])


def near_dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays, that with the smallest id."""
    return near_dedup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; the others go."""
    return mixing.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("host_quality_rules", host_quality_rules),
    ("line_dedup", dedup_lines),
    ("minhash_near_dedup", near_dedup_documents),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

#: Tokens and near duplicates have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet to the shared folder and read again.

    What a stage wrote goes when the next one has been written, so that a run leaves its
    result only.
    """
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    before = None
    for number, (name, stage) in enumerate(STAGES):
        path = f"{base}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            _delete(spark, before)
        before = path
    return docs

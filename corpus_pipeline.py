"""Corpus pipeline: quality, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet to the shared folder and read again as the next one's docs.
All but the last return the columns of documents.

Rows with null ids or texts pass through the stages by the rules that each
operator states; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm.decontaminate import drop_contaminated
from quarry.llm.line_dedup import dedup_lines
from quarry.llm.packing import pack_documents
from quarry.llm.quality import fit_quality, keep_quality
from quarry.llm.simhash import keep_one
from quarry.session import scratch_path, ship_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality trees score 0.3 or more."""
    ship_package(spark)
    return keep_quality(docs, fit_quality(docs, _table(spark, sf_dir, "labels")), least=0.3)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without chunks of lines and passages that stand elsewhere before."""
    ship_package(spark)
    return dedup_lines(docs, passages=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: shingles of 4 words,
    fingerprints that differ in at most 4 bits."""
    ship_package(spark)
    return keep_one(docs, size=4, most=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    ship_package(spark)
    return drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids in packed sequences."""
    import public_tokenizers
    ship_package(spark)
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("packing", packing)]

#: SQL can express neither the trees nor the tokenizer; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that pass every stage."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

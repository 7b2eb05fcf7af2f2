"""Registered queries of the operators: production parameters, whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.hard_negatives import SQL as HARD_NEGATIVES_SQL
from quarry.llm.topk import SQL as TOP_K_SQL
from quarry.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.quality import fit_quality, remainder, score_quality
    docs = _table(spark, sf_dir, "documents")
    trees = fit_quality(docs, _table(spark, sf_dir, "labels"))
    scored = score_quality(docs, trees)
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.decontaminate import find_passages
    return find_passages(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.line_dedup import dedup_lines
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, detail=True, passages=True)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.secrets import scan_secrets
    found = scan_secrets(_table(spark, sf_dir, "documents"))
    return found.withColumn("base_sha256", F.sha2("base_spans", 256)).drop("base_spans")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.simhash import near_duplicates
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.topk import exact_top_k
    return exact_top_k(_table(spark, sf_dir, "embeddings"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.packing import pack_documents
    pieces = pack_documents(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.token_files import read_token_files, write_token_files
    path = scratch_path(spark, "token_files")
    write_token_files(_table(spark, sf_dir, "documents"), path, _tokenizer("word_bpe_49k.json"))
    return read_token_files(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.token_counts import count_tokens
    return count_tokens(_table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.language import fit_language, predict_language
    from quarry.llm.quality import remainder
    docs = _table(spark, sf_dir, "documents")
    found = predict_language(docs, fit_language(docs))
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.hard_negatives import mine_negatives
    return mine_negatives(_table(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.collocations import collocations
    return collocations(_table(spark, sf_dir, "documents"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.substrings import drop_repeated
    kept = drop_repeated(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_quality, op2_decontamination, op3_line_dedup, op4_secrets, op5_simhash, op6_top_k,
    op7_packing, op8_token_files, op9_token_counts, op10_language,
    op11_hard_negatives, op12_collocations, op13_substring_dedup)}
#: What SQL can express; the others are tested against brute force, round trips or held-out rows.
SQL: dict[str, str] = {"op6_top_k": TOP_K_SQL, "op11_hard_negatives": HARD_NEGATIVES_SQL}

"""A training corpus from the documents table, in five stages; each reads what the one before it has written.

quality rules -> SimHash near-dedup -> benchmark decontamination -> secret scans -> byte-level BPE

Stages match their verdicts to documents by (doc_id, hash of the text), so rows that share an id are told apart by
their text, and null ids match null ids. Rows that agree in both stay or go together, but near-dedup leaves one. Columns a stage does not need
pass through, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtrail.llm import bpe, decontaminate, quality, secret_ledger, simhash
from adtrail.llm.queries import RANK_FILE
from adtrail.llm.store import fresh_folder, written


def _matched(docs: DataFrame, verdicts: DataFrame, how: str) -> DataFrame:
    """``docs`` with (left_semi) or without (left_anti) the rows named by (doc_id, _key) in ``verdicts``.

    The verdicts are the side that is hashed: texts pass unsorted.
    """
    named = verdicts.select(F.col("doc_id").alias("_i"), F.col("_key").alias("_k")).hint("shuffle_hash")
    return docs.join(named, docs["doc_id"].eqNullSafe(named["_i"]) & F.xxhash64(docs["text"]).eqNullSafe(named["_k"]), how)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a base rule or a cutoff of their language and source go."""
    keyed = docs.withColumn("_key", F.xxhash64("text"))
    judged = quality.assess(keyed, ["doc_id", "_key"], ["lang", "source"])
    return _matched(docs, written(judged.where("not kept").select("doc_id", "_key").distinct(), fresh_folder(spark, "rejected")), "left_anti")


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id stays (of several with that id, the least text hash),
    once; of rows that agree in id and text any one."""
    found = simhash.near_duplicates(docs, shingle=3, distance=2)
    named = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("_root", "doc_id", "_key").agg(F.count("*").alias("n"))
    kept = named.groupBy("_root").agg(F.min(F.struct("doc_id", "_key", "n")).alias("k")).select("k.*")
    kept = written(kept, fresh_folder(spark, "kept"))
    if kept.where("n > 1").isEmpty():
        return _matched(docs, kept, "left_semi")
    several = _matched(docs, kept.where("n > 1"), "left_semi").dropDuplicates(["doc_id", "text"])
    return _matched(docs, kept.where("n = 1"), "left_semi").unionByName(several)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a test item is found, whole or edited, go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = docs.withColumn("_name", F.struct("doc_id", F.xxhash64("text").alias("_key")))
    leaks = decontaminate.find_leaks(keyed, benchmark, id="_name")
    return _matched(docs, written(leaks.select("_name.doc_id", "_name._key").distinct(), fresh_folder(spark, "leaking")), "left_anti")


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mask; no document goes. ``n_chars`` follows the text."""
    found = secret_ledger.scan_paths(spark, docs.select("doc_id", "text"), ["doc_id"], "text", fresh_folder(spark, "ledger"))
    hit = written(found.where("spans is not null").select(F.col("doc_id").alias("_i"), F.col("blob_id").alias("_b"), "spans").dropDuplicates(["_i", "_b"]), fresh_folder(spark, "spans"))
    blob = F.sha2(F.coalesce(docs["text"], F.lit("")), 256)
    joined = docs.join(hit.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(hit["_i"]) & (blob == hit["_b"]), "left")
    masked = joined.withColumn("text", secret_ledger.redact(F.col("text"), F.col("spans")))
    return masked.withColumn("n_chars", F.when(F.size("spans") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))).select(*docs.columns)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of every document that is left."""
    return bpe.encode_documents(docs, public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality rules", quality_stage),
    ("SimHash near-dedup", dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secrets_stage),
    ("byte-level BPE", tokens_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = fresh_folder(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"{folder}/{number}")
    return docs


#: No SQL: XXH64 majorities and byte-pair merges are not expressible; tests/llm holds a brute-force version.
ORACLE_SQL = None

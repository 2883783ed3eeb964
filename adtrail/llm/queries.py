"""The operators applied to whole tables with production parameters, one query each."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtrail.llm import alignment, bpe, collocations, decontaminate, licences, packing, quality, secret_ledger, sharding, simhash, substring, url_trie, warc
from adtrail.llm.store import fresh_folder

#: The rank file and pattern of op8.
RANK_FILE = "byte_bpe_multi_50k.tiktoken"

# The rules of op2.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, through a ledger that starts empty."""
    docs = table(spark, sf_dir, "documents")
    found = secret_ledger.scan_paths(spark, docs, ["doc_id"], "text", fresh_folder(spark, "ledger"))
    spans = F.coalesce("spans", F.array().cast(found.schema["spans"].dataType))
    listed = lambda these: F.array_join(F.transform(these, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of = lambda *kinds: F.filter(spans, lambda s: s["kind"].isin(*kinds))
    count = lambda kind: F.size(of(kind)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(listed(of(*secret_ledger.BASE_KINDS)), 256).alias("base_sha256"), listed(spans).alias("spans"), "blob_id",
    )


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL; a URL that no rule fits is allowed."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_trie.judge_urls(table(spark, sf_dir, "pages"), rules, "url", ("page_id",))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices of every document."""
    return licences.scan_licences(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a test item, whole or edited: one row per document and item."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint and the group of near-duplicates of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=2)
    return found.select("doc_id", "fingerprint", "component_id")


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document placed in shards 0 to 23 by its id, and where it would go if there were one more."""
    docs = table(spark, sf_dir, "documents")
    records = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
    )
    weights = {s: 1.0 for s in range(25)}
    out = sharding.assign_shards(records, "doc_id", {s: 1.0 for s in range(24)}, weights)
    return out.select("doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that an earlier document holds too, in a window of 50."""
    return substring.remove_repeats(table(spark, sf_dir, "documents"), window=50)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the bytes they decode to."""
    return bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives, normalised, and read back by the index."""
    pages = table(spark, sf_dir, "pages")
    back = warc.archive_round_trip(pages, fresh_folder(spark, "warc"), "page_id", "url", "html", least=0)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measures of every document and the verdict by cutoffs of its language and source."""
    judged = quality.assess(table(spark, sf_dir, "documents"), ["doc_id"], ["lang", "source"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, in pieces of at most 2048 tokens, with its sequence and the place there."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), room=2048, end_id=0)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of each language."""
    return collocations.mine_phrases(table(spark, sf_dir, "documents"), least=100, longest=5, top=2000)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alignment of every document's tokens by two tokenizers."""
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.Alignment(table(spark, sf_dir, "documents"), *paths).documents()


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline.py, one after the other."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_url_filter, op3_license_scan, op4_decontaminate, op5_simhash_dedup, op6_shards, op7_substring_dedup,
    op8_bpe, op9_warc, op10_quality_rules, op11_packing, op12_collocations, op13_alignment, pipeline,
)}

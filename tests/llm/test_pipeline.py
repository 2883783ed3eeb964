"""The pipeline against a plain version of its stages."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from adtrail.llm import bpe, quality
from adtrail.llm.queries import RANK_FILE
from tests.llm import brute

import public_tokenizers


@pytest.mark.parametrize("source", ["folder", "given"])
def test_stages(spark, folder, small, source):
    sf_dir = folder if source == "folder" else small
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}

    # 1: verdicts of the operator, which has its own brute-force test; here, that they take effect
    judged = {r.doc_id: r.kept for r in quality.assess(docs, ["doc_id"], ["lang", "source"]).collect()}
    first = corpus_pipeline.quality_stage(spark, docs, sf_dir)
    assert first.columns == columns
    kept = {r.doc_id: r.text for r in first.collect()}
    assert kept == {i: t for i, t in texts.items() if judged[i]} and kept

    # 2: the least id of each group
    second = corpus_pipeline.dedup_stage(spark, first, sf_dir)
    groups = brute.simhash_groups(kept.items())
    left = {r.doc_id: r.text for r in second.collect()}
    assert second.columns == columns and left == {i: t for i, t in kept.items() if groups[i][1] == i}

    # 3: no test item is left whole
    third = corpus_pipeline.decontamination_stage(spark, second, sf_dir)
    items = [" ".join(r.text.split()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect() if r.text and len(r.text.split()) > 12]
    holds = lambda t: any(i in " ".join(t.split()) for i in items)
    clean = {r.doc_id: r.text for r in third.collect()}
    assert third.columns == columns and clean == {i: t for i, t in left.items() if not holds(t)}

    # 4: base secrets are masked, texts without any secret stay as they are
    fourth = corpus_pipeline.secrets_stage(spark, third, sf_dir)
    masked = {r.doc_id: (r.text, r.n_chars) for r in fourth.collect()}
    assert fourth.columns == columns and masked.keys() == clean.keys()
    for i, (text, chars) in masked.items():
        if brute.secrets(clean[i])[4]:
            assert "[REDACTED]" in text and not brute.secrets(text)[4] and chars == len(text)
        elif text != clean[i]:
            assert "[REDACTED]" in text

    # 5 and the whole
    codec = bpe.codec_of(public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert found.keys() == masked.keys()
    for i, r in found.items():
        assert codec.decode(r.ids).decode() == masked[i][0] and r.n_tokens == len(r.ids) and r.decoded_sha256 == brute.SHA(masked[i][0])


def test_null_ids_and_repeated_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = docs.withColumn("doc_id", F.when(F.col("doc_id") % 5 == 0, F.lit(None)).otherwise(F.col("doc_id")))
    now = odd.unionByName(odd.limit(10))
    for _, stage in corpus_pipeline.STAGES[:4]:
        now = spark.createDataFrame(stage(spark, now, folder).collect(), docs.schema)
        assert now.columns == docs.columns
    assert corpus_pipeline.STAGES[4][1](spark, now, folder).count() == now.count() > 0


def test_one_row_of_a_group_stays_where_ids_are_repeated_or_null(spark, folder):
    words = [f"w{i}x" for i in range(400)]
    base = " ".join(words)
    near = next(t for i in range(400) for t in [" ".join([*words[:i], "other", *words[i + 1 :]])] if 0 < (brute.fingerprint(t) ^ brute.fingerprint(base)).bit_count() <= 2)
    far = " ".join(f"f{i}y" for i in range(300))
    rows = [(7, base), (7, near), (7, near), (8, base), (7, far), (7, far), (None, near.replace("w", "u")), (None, near.replace("w", "u"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text) for r in corpus_pipeline.dedup_stage(spark, docs, folder).collect()]
    assert len(got) == 3 and sorted(i or 0 for i, _ in got) == [0, 7, 7]
    assert {(7, far), (None, rows[6][1])} < set(got) and {t for _, t in got} & {base, near}

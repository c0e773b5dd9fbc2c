"""The operators over the given tables, as queries with fixed parameters, and SQL where it can say them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardmarts.llm import (
    chat, decontam, filter_audit, jaccard, licenses, lm, mixing, oracles, piece_bpe, quality, toxicity, urls, variants, warc,
)
from hazardmarts.llm.common import fold, shared_path, table

URL_RULES = (
    urls.Rule("block", "net"),
    urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"),
    urls.Rule("allow", "org", "/fr/"),
)
# Target shares: the hot source down to a tenth, nineteen others alike, and a little for any further source.
MIX_WEIGHTS = {"src0": 0.10} | {f"src{i}": 0.047 for i in range(1, 20)}
MIX_REST = 0.007
TOXIC_LIMIT = 0.7


def op1_maxent_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), fold("doc_id", 7) == 2)


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model | None:
    """Fitted on the labelled documents outside the held-out part."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.train(docs, labels, use=lambda c: fold(c, 3) != 1)


def op2_toxicity_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))
    return scored.select(
        "doc_id",
        (fold("doc_id", 3) == 1).alias("held_out"),
        F.col("toxicity").alias("score"),
        F.when(F.col("toxicity") >= TOXIC_LIMIT, 1).otherwise(0).alias("predicted"),
    )


def op3_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    failed = quality.base_failed()
    return judged.select(
        "doc_id",
        F.col("q_words").alias("n_words"),
        F.col("q_word_chars").alias("word_chars"),
        F.col("q_symbols").alias("n_symbols"),
        F.col("q_dup_lines").alias("n_dup_lines"),
        F.col("q_repeat_words").alias("n_repeat_words"),
        failed.alias("base_failed"),
        (~failed & F.col("q_kept")).alias("kept"),
    )


def op4_chat_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], given.schema)
    rendered = chat.format_conversations(given.unionByName(extra))
    return chat.digests(rendered, chat.expand(rendered))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = licenses.scan(table(spark, sf_dir, "documents"))
    starts = F.transform("lic_base", lambda x: x["start"])
    both = F.concat("lic_base", "lic_found")
    return scanned.select(
        "doc_id",
        F.col("lic_words").alias("n_words"),
        F.size("lic_base").cast("bigint").alias("n_base"),
        F.array_min(starts).cast("bigint").alias("first_word"),
        F.array_max(starts).cast("bigint").alias("last_word"),
        licenses.joined_labels(F.col("lic_base")).alias("base_labels"),
        licenses.joined_labels(both).alias("labels"),
        F.coalesce(F.array_max(F.transform(both, lambda x: x["score"])), F.lit(0.0)).alias("score"),
    )


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.classify(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "block_score")


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.link_classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "copies")


def op9_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), shared_path(spark, "warc"))
    records = warc.read_archives(manifest, with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS, MIX_REST)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


def op13_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = piece_bpe.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    told = piece_bpe.decode(piece_bpe.encode(docs, model).drop("text"), model)
    return told.select(
        "doc_id",
        F.size("piece_ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("piece_ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_maxent_score, op2_toxicity_svm, op3_quality_cascade, op4_chat_prefix_targets,
        op5_benchmark_decontamination, op6_license_scan, op7_url_filter, op8_ngram_jaccard, op9_warc_archives,
        op10_mix_sources, op11_filter_audit, op12_spelling_variants, op13_piece_bpe,
    )
}


# The others are tested against brute force, by exact round trips and on held-out rows.
SQL: dict[str, str] = {
    "op3_quality_cascade": oracles.QUALITY,
    "op4_chat_prefix_targets": oracles.CHAT,
    "op6_license_scan": oracles.licences(),
    "op9_warc_archives": oracles.WARC,
    "op10_mix_sources": oracles.mixing(MIX_WEIGHTS, MIX_REST),
    "op11_filter_audit": oracles.AUDIT,
    "op12_spelling_variants": oracles.VARIANTS,
}

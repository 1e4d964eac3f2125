"""The registered queries of the operators and of the pipeline, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mergelens.llm import (
    bpe,
    contamination,
    conversations,
    fingerprints,
    neardup,
    page_text,
    quality,
    repeats,
    secret_scan,
    shards,
    urls,
    vector_codes,
    warc,
)
from mergelens.session import new_dir

SHARDS = 40
#: The vocabulary file of a public tokenizer; None: where its package says.
VOCABULARY: str | None = None

#: Rules by host and path, then patterns for what no such rule decides.
URL_RULES = [
    urls.prefix_rule("net/", "block"),
    urls.prefix_rule("example.net/en/", "allow"),
    urls.prefix_rule("example.com/de/", "block"),
    urls.prefix_rule("org/fr/", "allow"),
    *(
        urls.UrlRule(f"~{word}", "block", rf"(^|\.){word}\.", tuple(word.split("-")), 1, named=False)
        for word in ("ads-track", "free-bets", "cheap-pills", "spam-farm", "casino-win", "adult-x")
    ),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path() -> str:
    if VOCABULARY:
        return VOCABULARY
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = secret_scan.fit_secrets(secret_scan.weak_findings(docs))
    return secret_scan.scan_secrets(docs, model, ["doc_id"]).drop("redacted")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs.select("doc_id", "text"), model).select(
        "doc_id",
        quality.is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.encode_texts(docs, vocabulary_path(), ["doc_id"], with_ids=False)


def op5_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract_pages(table(spark, sf_dir, "pages"), ["page_id", "url"], "html")


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = shards.deal(table(spark, sf_dir, "documents"), "doc_id", "text", SHARDS)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), texts=False)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), "page_id", "url", URL_RULES)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    records = warc.resolved(warc.read_archives(spark, path))
    return records.select(
        warc.page_of(F.col("record_id")).cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_of(F.col("refers_to")).cast("long").alias("refers_to"),
        "verified",
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.audits(conversations.damage(rows), every=rows)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_fingerprints,
        op3_quality,
        op4_bpe,
        op5_page_text,
        op6_shards,
        op7_near_duplicates,
        op8_contamination,
        op9_repeated_passages,
        op10_url_filter,
        op11_vector_codes,
        op12_warc,
        op13_conversation_repair,
    )
}

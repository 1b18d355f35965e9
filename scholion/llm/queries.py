"""The registered queries of this folder, one for each operator, and the pipeline's."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholion.llm import (
    chat,
    divergence,
    fill_in_middle,
    html_text,
    lattice,
    mixing,
    packing,
    quality,
    secret_scan,
    sharding,
    simhash,
    toxicity,
    warc,
)
from scholion.llm.common import table


def op1_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"
    )


def op2_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return toxicity.grade_documents(docs, toxicity.train(docs, table(spark, sf, "labels")))


def op3_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    found = html_text.extract_pages(table(spark, sf, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "path")


def op4_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(
        [(-1, t, role, "</s>[INST] ok [/INST]") for t, role in enumerate(("user", "assistant"))], rows.schema
    )
    back = chat.read_back(chat.format_chats(chat.rows_as_events(rows.unionByName(extra))))
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op5_mixing(spark: SparkSession, sf: str) -> DataFrame:
    mix = mixing.mix_documents(table(spark, sf, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op6_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return lattice.vector_links(table(spark, sf, "embeddings"))


def op7_simhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf, "documents"))
    return groups.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op8_sharding(spark: SparkSession, sf: str) -> DataFrame:
    shards = sharding.shard_by_bytes(table(spark, sf, "documents"))
    return shards.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    scanned = secret_scan.scan_secrets(table(spark, sf, "documents").select("doc_id", "text"))
    n = len(secret_scan.BASE)
    of_kind = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return scanned.select(
        "doc_id",
        *(of_kind(r.kind) for r in secret_scan.BASE),
        F.sha2(secret_scan.listed(F.filter("spans", lambda s: s["rank"] < n)), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
    )


def op10_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality.quality_rules(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


def op11_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(table(spark, sf, "documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op12_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf, "documents"))


def op13_warc(spark: SparkSession, sf: str) -> DataFrame:
    read = warc.pages_through_archives(table(spark, sf, "pages"))
    return read.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.col("refers_to_page").alias("refers_to")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_packing, op2_toxicity, op3_html_extraction, op4_chat_formatting, op5_mixing, op6_embedding_dedup,
        op7_simhash_dedup, op8_sharding, op9_secret_scan, op10_quality_rules, op11_fill_in_middle, op12_source_divergence,
        op13_warc,
    )
}

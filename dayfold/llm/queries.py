"""The operators with production parameters over the whole sample tables: ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayfold.llm import bpe, chat, decontaminate, fuzzy_lines, jaccard, main_text, merkle, near_vectors, phrases, quality, repeats, token_counts, warc
from dayfold.llm.common import table


def tokenizer_file(name: str) -> str:
    """Where a public vocabulary file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))
    names = F.concat_ws(",", "item_ids")
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), "contaminated", "longest_match")


def quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, folder, "labels"))
    scored = quality.with_score(docs, model)
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    row = F.struct(F.col("turn").alias("order"), "role", "text")
    records = rows.select("conv_id", F.to_json(row, {"ignoreNullFields": "false"}).alias("record"))
    words = "</s>[INST] ok [/INST]"
    extra = json.dumps({"messages": [{"role": r, "content": words} for r in ("user", "assistant")]})
    added = spark.range(1).select(F.lit(-7).cast("bigint").alias("conv_id"), F.lit(extra).alias("record"))
    return chat.digests(chat.format_chats(chat.canonical_turns(records.union(added))))


def bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"))


def repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.without_repeats(table(spark, folder, "documents")).drop("kept")


def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = fuzzy_lines.without_repeated_lines(docs)
    return found.select("doc_id", "lines_removed", F.length("text").cast("bigint").alias("chars_kept"), F.sha2("text", 256).alias("kept_sha256"))


def jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_documents(table(spark, folder, "documents")).drop("class")


def tokens(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"))


def warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    return warc.deduplicated_archives(table(spark, folder, "pages")).drop("target_uri")


def near_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, folder, "embeddings"))


def html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.main_texts(table(spark, folder, "pages"))


def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    names = ("doc_id", "source", "lang", "n_chars", "text")
    changed = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    one_more = F.when(changed, F.col("n_chars").cast("decimal(20,0)") + 1).otherwise(F.col("n_chars"))
    claimed = [one_more if name == "n_chars" else F.col(name) for name in names]
    made = merkle.build(docs, "doc_id", "lang", [F.col(name) for name in names], claimed)
    return merkle.audit(made).withColumnRenamed("key", "doc_id")


def phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents").select("lang", "text"))


QUERIES = {
    "op1_decontamination": decontamination,
    "op2_quality": quality_scores,
    "op3_chat_formatting": chat_formatting,
    "op4_bpe": bpe_round_trip,
    "op5_repeats": repeated_strings,
    "op6_line_dedup": line_dedup,
    "op7_token_counts": tokens,
    "op8_jaccard_join": jaccard_join,
    "op9_warc_revisits": warc_revisits,
    "op10_near_embeddings": near_embeddings,
    "op11_html_extraction": html_extraction,
    "op12_merkle_manifest": merkle_manifest,
    "op13_collocations": phrase_collocations,
}

"""One registered query per operator, as the contract words its result, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from tidelog.llm import align, fingerprint, langid, lm, packing, pii, quality, repair
from tidelog.llm.common import table
from tidelog.llm.decontaminate import decontaminate
from tidelog.llm.extract import extract
from tidelog.llm.linededup import LineDedup
from tidelog.llm.ngram_join import near_duplicates
from tidelog.llm.urls import CONTRACT_RULES, filter_urls


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                      ((F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))).alias("contaminated"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "class_id", "n_links")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality.order_rules(docs, quality.default_rules(*quality.learned(docs, table(spark, sf_dir, "labels"))))
    rows = quality.compute_once(quality.measured(docs), n_repeat_words=quality.n_repeat_words(F.col("__words")))
    failed = (F.col("__n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("__n_words") * 50)
    rows = rows.withColumn("base_failed", failed)
    return quality.judged(rows, rules, spare=F.col("base_failed")).select(
        "doc_id", F.col("__n_words").alias("n_words"), quality.word_chars(F.col("__words")).alias("word_chars"), quality.n_symbols(F.col("__text")).alias("n_symbols"),
        quality.n_dup_lines(F.col("__text")).alias("n_dup_lines"), "n_repeat_words", "base_failed", "kept")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def packed(docs: DataFrame) -> DataFrame:
    """The documents' pieces packed into sequences of 4096 tokens; every document ends with id 1."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(packing.pieces(docs, path, length=4096, end_id=1, drops_space=True), 4096)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(3)) == 1
    return langid.identify(docs.withColumn("held_out", held), ~held, keep=("held_out",))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.summarize(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *[f"n_{k}" for k in pii.KINDS], F.sha2("base", 256).alias("base_sha256"), "spans")


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, CONTRACT_RULES).select("page_id", "host", "path", "rule", "verdict")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = LineDedup(spark, min_docs=10, min_chars=1).insert(docs).clean(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(7))
    return lm.score(docs, held_out=fold == 2, tuning=fold == 3)


def op11_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return align.summarize(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.repair(repair.damage(turns), all_ids=turns)


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.near_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_ngram_join, op3_quality_rules, op4_html_text, op5_best_fit_packing, op6_language_id, op7_personal_data, op8_url_rules, op9_line_dedup, op10_lm_score,
                                   op11_align_tokens, op12_repair_conversations, op13_fingerprints)}

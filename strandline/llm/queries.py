"""The registered queries: each applies its operator with production parameters to the
whole of its tables and derives the digest columns of the contract."""

from __future__ import annotations

import os
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import (byte_bpe, decontaminate, importance_resampling, lattice_lm, line_dedup, near_dup, packing, quality_rules,
                            secret_scan, source_divergence, toxicity, url_rules, warc_zst)
from strandline.llm.common import checkpoint_dir, crc_rem, table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.decide(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.size("_dropped").cast("long").alias("n_dropped"), F.col("_dropped").alias("dropped_lines"),
                      line_dedup.keeps("_dropped", "_text").alias("kept"),
                      F.sha2(F.coalesce(F.col("_text").cast("string"), F.lit("")), 256).alias("text_sha256"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.rank_table(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    lex = toxicity.learn(docs, labels.where(crc_rem("doc_id", 5) != 0))
    return (toxicity.score(docs, lex)
            .select("doc_id", (crc_rem("doc_id", 5) == 0).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"), "matches"))


def op4_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (crc_rem("doc_id", 7) != 2).alias("train"))
    return (lattice_lm.score(docs, public_tokenizers.path("piece_bpe_32k.model"))
            .select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = os.path.join(checkpoint_dir(spark), "strandline", f"warc-{uuid.uuid4().hex}")
    warc_zst.write(table(spark, sf_dir, "pages"), out)
    return (warc_zst.read(spark, out, with_payload=False)
            .select(F.col("id").alias("page_id"), F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
                    F.col("type").alias("record_type"), F.col("refers").alias("refers_to")))


#: Fixed by the contract.
URL_RULES = [url_rules.FixedRule("allow", "com/"), url_rules.FixedRule("block", "example.com/en/"),
             url_rules.FixedRule("allow", "www.example.com/en/"), url_rules.FixedRule("block", "net/es/"),
             url_rules.FixedRule("block", "net/fr/")]


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = table(spark, sf_dir, "pages").select("page_id", "url"), table(spark, sf_dir, "labels")
    # a page shows the document whose number ends its path: that document's labels are its own
    shown = F.regexp_extract(url_rules.path(F.col("url")), r"/([0-9]{1,18})(?:\.html)?/?$", 1)
    numbered = pages.withColumn("doc_id", F.when(shown != "", shown).cast("long"))
    bad = (F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)
    labelled = numbered.join(labels.where("quality is not null or toxic is not null"), "doc_id").select("url", bad.alias("bad"))
    return (url_rules.judge(pages, url_rules.mine(labelled), URL_RULES)
            .select("page_id", "host", "path", "rule", "verdict"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.components(table(spark, sf_dir, "documents"), shingle=4)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality_rules.learn(docs, table(spark, sf_dir, "labels"))
    out, s = quality_rules.judge(docs, rules)
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
    return out.select("doc_id", *(F.col(s)[c].alias(c) for c in cols))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "start", F.length("candidate").alias("length"), "candidate", "path", "probability", "is_secret")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = importance_resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = packing.tokenizer(spark, public_tokenizers.path("word_bpe_49k.json"))
    return (packing.pack(table(spark, sf_dir, "documents"), spec)
            .select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_toxicity": op3_toxicity,
    "op4_lattice_lm": op4_lattice_lm,
    "op5_warc": op5_warc,
    "op6_url_rules": op6_url_rules,
    "op7_decontaminate": op7_decontaminate,
    "op8_near_dup": op8_near_dup,
    "op9_quality_rules": op9_quality_rules,
    "op10_secret_scan": op10_secret_scan,
    "op11_source_divergence": op11_source_divergence,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_packing": op13_packing,
}

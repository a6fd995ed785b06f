"""The training-text pipeline: five stages, each written as Parquet and reread.

quality rules -> line dedup -> MinHash near-dedup -> benchmark decontamination ->
byte-level BPE.  Every stage works on all rows its predecessor kept; all but the last
return the columns of ``documents``.

Defined results: null and empty texts fail the quality rules' base check and go there;
empty tables pass through as empty tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import byte_bpe, decontaminate, line_dedup, near_dup, quality_rules
from strandline.llm.common import materialize, table
from strandline.session import broadcast_checked


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base check and the learned decision list keep."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring templates' lines dropped from all documents but the first."""
    return line_dedup.drop_recurring(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group (five-word shingles, similarity 0.8 or more)."""
    return near_dup.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.  Rows are told apart by their text, which alone
    decides: neither a null nor a repeated id takes other rows along."""
    key, leak = _free(docs, "_key"), _free(docs, "_leak")
    keyed = docs.withColumn(key, F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))
    leaks = decontaminate.contaminated(keyed, table(spark, sf_dir, "benchmark"), id_col=key).select(F.col(key).alias(leak)).distinct()
    # a broadcast within measured bytes: only beyond them is all text shuffled
    leaks = broadcast_checked(leaks, "pipeline-leaks")
    return keyed.join(leaks, F.col(key) == F.col(leak), "left_anti").select(*docs.columns)


def _free(docs: DataFrame, name: str) -> str:
    while name.lower() in {c.lower() for c in docs.columns}:
        name = "_" + name
    return name


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded ids and of the decoded bytes."""
    ranks = byte_bpe.rank_table(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return byte_bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("near_dup", near_duplicates),
          ("decontaminate", decontaminated), ("byte_bpe", bpe)]

#: SQL cannot express the learned rules, the signatures or the merges; tests compare each
#: stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

"""Structured Streaming form of the pipeline front: aligned chunks arriving in a folder.

The original has no streaming; it lists the chunk files once and counts reads per
chromosome after aligning them all.  The same count (A2) and the region table built
from it (W1) can be kept up to date while chunks arrive: a file-stream source over the
folder of per-chunk alignment files, the P2 filter, a running ``groupBy`` (state kept by
Spark, checkpointed in the shared checkpoint folder so a restarted query resumes
exactly once), and ``foreachBatch`` publishing the current region table.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import sinks
from ..operators.reads import primary_mapped, primary_mapped_condition
from ..operators.regions import balance_regions, kept_per_chunk, reads_per_chrom
from ..session import checkpoint_dir


def read_alignment_stream(spark: SparkSession, folder: str, schema,
                          max_files_per_trigger: int | None = None) -> DataFrame:
    """Alignments (Parquet, one or more files per chunk) as they appear in ``folder``."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(folder).withColumn("chunk_file", F.col("_metadata.file_name"))


def running_reads_per_chrom(stream: DataFrame) -> DataFrame:
    """A2 on a stream: kept reads per chromosome, updated with every chunk."""
    return reads_per_chrom(primary_mapped(stream))


def running_kept_per_chunk(stream: DataFrame) -> DataFrame:
    """A8 on a stream: reads in and reads kept (P2) per arriving chunk file."""
    return kept_per_chunk(stream, primary_mapped_condition(), "chunk_file")


def start_chunk_counts(stream: DataFrame, out: str, name: str = "chunk_counts",
                       available_now: bool = True) -> StreamingQuery:
    """Keep per-chunk counts in ``out`` (published from the streaming state at every
    micro-batch, see :func:`strandline.sinks.read_published`; one row per chunk file)."""
    spark = stream.sparkSession
    ckpt = os.path.join(checkpoint_dir(spark), "streams", name)

    def publish(counts: DataFrame, batch_id: int) -> None:
        sinks.publish(counts, out)

    w = (running_kept_per_chunk(stream).writeStream.outputMode("complete")
         .option("checkpointLocation", ckpt).foreachBatch(publish))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def start_region_table(stream: DataFrame, n: int, out: str, name: str = "regions",
                       available_now: bool = True) -> StreamingQuery:
    """Keep the W1 region table of the reads seen so far in ``out`` (published
    at every micro-batch, so readers never see an empty or mixed table).  Counts are streaming state (complete mode: one
    row per chromosome); the ranking runs on that small table in ``foreachBatch``."""
    spark = stream.sparkSession
    ckpt = os.path.join(checkpoint_dir(spark), "streams", name)

    def publish(counts: DataFrame, batch_id: int) -> None:
        sinks.publish(balance_regions(counts, n), out)

    w = (running_reads_per_chrom(stream).writeStream.outputMode("complete")
         .option("checkpointLocation", ckpt).foreachBatch(publish))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()

"""Reference genome (FASTA) as chunks: ``ref_name, bin, chunk_start, chunk``.

The original hands a FASTA file to its external tools.  Here the reference is read
once into fixed bins of ``bin_size`` positions, so that reference bases reach the
reads by an equi-join on ``(contig, bin)`` - reads are shuffled, never bases - and the
base at position ``p`` is ``substr(chunk, p - chunk_start + 1, 1)``.

Positions come from exact running sums of line lengths (lines need not have equal
widths): per file split, the sum of sequence characters gives a split offset (a small
table, running sum, broadcast after a size check); inside a split a window ordered by
line gives the rest - its partitions are file splits, bounded by the split size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import broadcast_checked, materialize


def read_fasta_chunks(spark: SparkSession, path: str, bin_size: int = 1 << 10) -> DataFrame:
    """FASTA -> reference chunks.  Bin ``b`` of a contig holds positions
    ``b*B .. b*B + B - 1`` (1-based; bin 0 starts at position 1)."""
    B = F.lit(bin_size)
    # written once with its ids: offsets and lines come from the same table, so a later
    # job that cuts the files otherwise cannot part them
    lines = materialize(spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_f"),
        F.col("_metadata.file_block_start").alias("_b"),
        F.monotonically_increasing_id().alias("_mid")), "fasta_lines")
    is_hdr = F.col("value").startswith(">")
    lines = lines.select("*", is_hdr.cast("long").alias("_hdr"), F.when(is_hdr, F.lit(0)).otherwise(
        F.length(F.trim("value"))).cast("long").alias("_len"))
    # split offsets: headers and sequence characters before the split
    splits = lines.groupBy("_f", "_b").agg(F.sum("_hdr").alias("_hdrs"), F.sum("_len").alias("_chars"))
    wo = Window.orderBy("_f", "_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = broadcast_checked(splits.select(
        "_f", "_b", F.coalesce(F.sum("_hdrs").over(wo), F.lit(0)).alias("_hoff"),
        F.coalesce(F.sum("_chars").over(wo), F.lit(0)).alias("_coff")), "fasta_splits")
    ws = Window.partitionBy("_f", "_b").orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
    # a line belongs to the contig of the last header up to it, counted over all files
    x = lines.join(offs, ["_f", "_b"], "inner").select(
        "value", "_len", "_hdr", (F.col("_hoff") + F.sum("_hdr").over(ws)).alias("_contig"),
        (F.col("_coff") + F.sum("_len").over(ws) - F.col("_len")).alias("_cum"))
    hdr = broadcast_checked(x.filter("_hdr = 1").select(
        "_contig", F.col("_cum").alias("_hcum"),
        F.split(F.substring(F.col("value"), 2, 1 << 30), r"\s+").getItem(0).alias("ref_name")),
        "fasta_contigs")
    own = x.filter("_hdr = 0 and _len > 0").join(hdr, "_contig", "inner")
    p0 = F.col("_cum") - F.col("_hcum") + 1             # position of the line's first base
    pieces = own.select(
        "ref_name", p0.alias("_p0"), F.trim("value").alias("_s"),
        F.explode(F.sequence(F.floor(p0 / B).cast("long"),
                             F.floor((p0 + F.col("_len") - 1) / B).cast("long"))).alias("bin"))
    lo = F.greatest(F.col("_p0"), F.col("bin") * B)
    hi = F.least(F.col("_p0") + F.length("_s") - 1, F.col("bin") * B + B - 1)
    part = pieces.select("ref_name", "bin", lo.alias("_lo"),
                         F.col("_s").substr(lo - F.col("_p0") + 1, hi - lo + 1).alias("_sub"))
    # at most bin_size / line width + 1 pieces per group: bounded
    return part.groupBy("ref_name", "bin").agg(
        F.min("_lo").alias("chunk_start"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_lo", "_sub"))),
                                 lambda t: t["_sub"]), "").alias("chunk"))


def chunks_by_index(chunks: DataFrame, seq_dict: DataFrame) -> DataFrame:
    """Reference chunks keyed by ``ref_idx`` (contig names through the dictionary,
    broadcast after a size check)."""
    d = broadcast_checked(seq_dict.select("ref_name", "ref_idx"), "seq_dict")
    return chunks.join(d, "ref_name", "inner").select("ref_idx", "bin", "chunk_start", "chunk")

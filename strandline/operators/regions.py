"""Chromosome balancing and region layout.

The reference counts reads per chromosome, ranks chromosomes by count and deals them
round-robin over ``n`` regions, then sends every region's reads to one task.  Here the
count is a partially-aggregated ``groupBy``; the ranking runs on the per-contig table
(one row per contig, never the reads); the region table is joined to the reads by
broadcast after a size check, so the reads are not shuffled for it; and the coordinate
layout is a range partitioning into many partitions, so no task ever holds a region.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_checked, materialize

# Contig tables have one row per reference sequence.
def reads_per_chrom(aln: DataFrame, key: str = "ref_idx") -> DataFrame:
    """A2: ``ref_idx, n_reads``."""
    return aln.groupBy(key).agg(F.count(F.lit(1)).alias("n_reads"))


def balance_regions(counts: DataFrame, n: int, key: str = "ref_idx") -> DataFrame:
    """Rank contigs by read count (descending; ties by ``key`` so the result is
    defined) and deal them round-robin: ``region = (rank - 1) % n``.

    The window has no partition key on purpose: its input is the per-contig count
    table, one row per contig, bounded by the dictionary size and not by the reads."""
    w = Window.orderBy(F.col("n_reads").desc(), F.col(key))
    return counts.select(key, "n_reads",
                         ((F.row_number().over(w) - 1) % F.lit(n)).cast("int").alias("region"))


def assign_regions(aln: DataFrame, regions: DataFrame, key: str = "ref_idx") -> DataFrame:
    """Attach ``region`` to every read.  The region table (one row per contig) is
    broadcast after a size check, so the reads keep their partitioning."""
    r = broadcast_checked(regions.select(key, "region"), "regions")
    return aln.join(r, key, "inner")


# ---- regions below the contig ------------------------------------------------------

CELL = 1 << 12
#: A cell with more than this share of a region's mean load is cut into its positions.
HEAVY = 0.05


def balance_loci(reads: DataFrame, n: int, cell: int = CELL, heavy: float = HEAVY, key: str = "ref_idx", pos: str = "pos") -> DataFrame:
    """Cut the genome into ``n`` contiguous regions of near-equal load: a row per cell,
    ``key, cell, at (a position, or null for the whole cell), n_reads, region``.

    Whole contigs give no more units than there are contigs, the largest of them of any
    size.  Here the reads that start in each cell of ``cell`` bases are counted; cells with
    more than ``heavy`` of a region's mean are counted by position instead (so a region is
    over or under the mean by one light cell or one position at most).  Running sums in
    genome order then place each cell by the middle of its load.  The sums are windows over
    the counts of one contig, started from a table with a row per contig: neither reads nor
    the genome's cells meet in one task.  An empty input has no regions."""
    if n < 1:
        raise ValueError("at least one region")
    spots = reads.select(key, F.col(pos).cast("long").alias("at"), F.floor((F.col(pos) - 1) / cell).cast("long").alias("cell"))
    cells = materialize(spots.groupBy(key, "cell").agg(F.count(F.lit(1)).alias("n_reads")), "loci_cells")
    total = cells.agg(F.sum("n_reads").alias("t")).first()["t"] or 0
    deep = F.col("n_reads") > heavy * total / n
    by_pos = (spots.join(broadcast_checked(cells.where(deep).select(key, "cell"), "loci_deep"), [key, "cell"], "left_semi")
              .groupBy(key, "cell", "at").agg(F.count(F.lit(1)).alias("n_reads")))
    loads = materialize(cells.where(~deep).withColumn("at", F.lit(None).cast("long")).unionByName(by_pos), "loci_loads")
    contigs = loads.groupBy(key).agg(F.sum("n_reads").alias("load"))
    # one row per contig: bounded by the dictionary, not by the reads
    before = contigs.select(key, (F.sum("load").over(Window.orderBy(key)) - F.col("load")).alias("before"))
    upto = F.sum("n_reads").over(Window.partitionBy(key).orderBy("cell", "at"))
    placed = loads.withColumn("upto", upto).join(broadcast_checked(before, "loci_before"), key)
    middle = F.col("before") + F.col("upto") - F.col("n_reads") / 2
    return placed.select(key, "cell", "at", "n_reads", F.least(F.floor(middle * n / max(1, total)), F.lit(n - 1)).cast("int").alias("region"))


def assign_loci(reads: DataFrame, loci: DataFrame, cell: int = CELL, key: str = "ref_idx", pos: str = "pos") -> DataFrame:
    """Attach the ``region`` of :func:`balance_loci` to every read: by its cell, or by its
    position where the cell was cut.  Both tables are broadcast within measured bytes."""
    at, cell_of = F.col(pos).cast("long"), F.floor((F.col(pos) - 1) / cell).cast("long")
    whole = broadcast_checked(loci.where("at is null").select(key, F.col("cell").alias("_cell"), F.col("region").alias("_r1")), "loci_whole")
    cut = broadcast_checked(loci.where("at is not null").select(key, F.col("at").alias("_at"), F.col("region").alias("_r2")), "loci_cut")
    x = reads.withColumn("_cell", cell_of).withColumn("_at", at).join(whole, [key, "_cell"], "left").join(cut, [key, "_at"], "left")
    return x.select(*(reads[c] for c in reads.columns), F.coalesce("_r1", "_r2").alias("region"))


def coordinate_sort(aln: DataFrame, num_partitions: int | None = None,
                    order=("region", "ref_idx", "pos", "qname")) -> DataFrame:
    """A3/O3: lay reads out by region, then coordinate.

    A range partitioning on the full sort key (the read name breaks ties, so a hot
    locus is split across partitions) followed by a sort inside each partition: the
    partitions, read in order, are the regions in coordinate order.  No task holds a
    whole region and no array of reads is built."""
    spark = aln.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return aln.repartitionByRange(n, *order).sortWithinPartitions(*order)


def rank_within(df: DataFrame, group: str, order: list[str],
                num_partitions: int | None = None, name: str = "rank") -> DataFrame:
    """Position (1-based) of every row inside its ``group`` in ``order`` - a window
    ``row_number`` without a window partition per group.

    Rows are range partitioned and sorted on ``(group, *order)``; each row records its
    partition and its index there; the layout is written once (so those ids are data,
    fixed under retries); per ``(partition, group)`` counts form a small table whose
    running sums are the offsets, joined back by broadcast after a size check."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = (df.repartitionByRange(n, group, *order).sortWithinPartitions(group, *order)
            .withColumn("_pid", F.spark_partition_id())
            .withColumn("_mid", F.monotonically_increasing_id()))
    laid = materialize(laid, "rank")
    counts = laid.groupBy("_pid", group).agg(F.count(F.lit(1)).alias("_c"),
                                             F.min("_mid").alias("_m0"))
    w = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("_pid", group, "_m0",
                         F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_off"))
    offs = broadcast_checked(offs, "rank_offsets")
    out = laid.join(offs, ["_pid", group], "inner")
    return (out.withColumn(name, (F.col("_off") + F.col("_mid") - F.col("_m0") + 1)
                           .cast("long"))
            .drop("_pid", "_mid", "_m0", "_off"))


def kept_per_chunk(aln: DataFrame, kept_condition, chunk: str = "chunk") -> DataFrame:
    """Per input chunk, reads in and reads passing the keep filter (one scan, one
    partially aggregated shuffle)."""
    return aln.groupBy(chunk).agg(F.count(F.lit(1)).alias("n_reads"),
                                  F.count_if(kept_condition).alias("n_kept"))

"""The two jobs of the original, composed from the library's operators.

* :func:`chunk_fastq` - two FASTQ files of mates -> ``n`` ordered, interleaved gzip
  chunks (the chunker).
* :func:`call_variants_from_alignments` - aligned reads -> one merged, ordered VCF
  (the analyser, from the point where the user's aligner has produced alignments;
  plug the aligner itself in with :func:`strandline.operators.hooks.map_chunks`).

Where the original runs external programs (clean-up, duplicate marking, read groups,
recalibration, calling), the re-aimed operators of this library run instead, as Spark
jobs over all regions at once; nothing is collected to the driver and no region is
sent to a single task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.chrom import chrom_number
from .operators import bases as B
from .operators import duplicates as D
from .operators import intervals as I
from .operators import pairing as P
from .operators import reads as R
from .operators import regions as G
from .session import broadcast_checked, materialize, scratch
from .sinks import to_bed, write_by_region, write_chunks, write_text_by_region, write_vcf
from .sources.fasta import chunks_by_index
from .sources.fastq import read_fastq


def chunk_fastq(spark: SparkSession, fastq1: str, fastq2: str, out: str, n: int,
                mode: str = "errorifexists") -> DataFrame:
    """Mates of ``fastq1`` / ``fastq2`` (same ordinal = same template) -> ``n`` gzip
    text files in ``out``, chunk ``i`` holding the ``i``-th run of pairs, mate 1 then
    mate 2 per pair.  Returns the chunk assignment (``chunk, record_id, value``)."""
    l1, l2 = read_fastq(spark, fastq1), read_fastq(spark, fastq2)
    pairs = P.pair_mates(P.group_records(l1), P.group_records(l2))
    # the pair count from line counts: the pairs are never written twice
    return write_chunks(pairs, out, n, mode, total=P.pair_count(l1, l2))


def call_variants_from_alignments(
        aln: DataFrame, seq_dict: DataFrame, n_regions: int, out: str | None = None,
        ref_base: Callable[[Column, Column], Column] | DataFrame | None = None,
        known_sites: DataFrame | None = None, targets: DataFrame | None = None,
        min_qual: int = 30, single_file: bool = False, recal_per_region: bool = False,
        mode: str = "errorifexists", region_out: str | None = None, header: Sequence[str] = ()) -> DataFrame:
    """Aligned reads (``read_id, qname, flag, ref_idx, pos, mapq, cigar, seq, qual``)
    -> variant calls, written as one ordered VCF body when ``out`` is given.

    Without ``read_id`` (SAM text from an aligner) the reads are numbered and written
    once.  Steps: P2 filter; A2 + W1 + J2 regions (kept as a column for per-region
    output); P5 + P6 quality encoding guessed and fixed per region; J7 + P7 clean-up;
    W2 duplicates (paired rule; fragments by the unpaired one) removed; P8 read group;
    optionally J3 + J4 - keep reads on targets that intersect the covered ranges (A6),
    and calls inside the targets; A11 + J5 recalibration
    table (known sites excluded; per region with ``recal_per_region``) and J6
    applied; A12 pileup; W5 calls; U1/A4/O4 merge.
    ``ref_base`` gives the reference base of a site: a column function
    ``f(ref_pos, ref_idx)``, or reference chunks from
    :func:`strandline.sources.fasta.read_fasta_chunks` (default bin size), which reach
    the reads by bin.  With ``region_out`` the outputs that the original leaves per region
    are written there too, a folder per region in each: ``metrics`` (A9), ``ranges`` (A6 as
    BED lines, K2), ``targets`` (A13) and ``vcf`` (the region's calls in order, K4 + K5).

    Intermediates are deleted when the outputs are written, also after a failure; the calls
    are returned as a written table (``region, chrom, pos, line, ...``), which the caller's
    own :func:`strandline.session.scratch` scope deletes, if there is one."""
    if ref_base is None:
        raise ValueError("ref_base is required to call variants")
    with scratch(aln.sparkSession) as held:
        calls = _call_variants(aln, seq_dict, n_regions, ref_base, known_sites, targets, min_qual,
                               recal_per_region, mode, region_out)
        if out is not None:
            merged = B.merge_variants(calls.select("chrom", "pos", "line"))
            write_vcf(merged, out, single_file=single_file, mode=mode, header=header)
        return held.keep(calls)


def _call_variants(aln: DataFrame, seq_dict: DataFrame, n_regions: int, ref_base, known_sites, targets, min_qual: int,
                   recal_per_region: bool, mode: str, region_out: str | None) -> DataFrame:
    cols = ["qname", "flag", "ref_idx", "pos", "mapq", "cigar", "seq", "qual"]
    if "read_id" in aln.columns:
        aln = aln.select("read_id", *cols)
    else:
        aln = materialize(aln.select(F.monotonically_increasing_id().alias("read_id"), *cols), "job_reads")
    kept = R.with_alignment_end(R.primary_mapped(aln))
    # one row per contig, written once: the reads are counted once
    regions = materialize(G.balance_regions(G.reads_per_chrom(kept), n_regions), "job_regions")
    reads = R.fix_qualities(G.assign_regions(kept, regions), by="region").drop("encoding", "quality_error")
    reads = R.clean_alignments(R.with_reference(reads, seq_dict))
    # the cleaned, marked reads feed several later steps: written once
    marked = materialize(R.with_read_group(D.mark_duplicates_paired(reads)), "job_clean_reads")
    reads = marked.filter(F.col("dup") == 0).drop("dup", "score")
    if region_out is not None:
        _write_region_tables(marked, reads, seq_dict, regions, region_out, mode)
    if targets is not None:
        ranges = I.covered_ranges(reads).select(
            "ref_idx", (F.col("start_pos") - 1).alias("start0"), F.col("end_pos").alias("end0"))
        on = I.interval_intersect(targets, ranges, "ref_idx", ("bstart", "bend"),
                                  ("start0", "end0")).select(
            "ref_idx", F.col("istart").alias("bstart"), F.col("iend").alias("bend"))
        reads = materialize(I.interval_restrict(
            reads.withColumn("start0", F.col("pos") - 1).withColumn("end0", F.col("end_pos")),
            on, "ref_idx", ("start0", "end0"), ("bstart", "bend")).drop("start0", "end0"),
            "job_target_reads")

    keep = ("read_id", "ref_idx", "region")

    def fan_out(r: DataFrame, sites: DataFrame | None) -> DataFrame:
        # bases of r with ref_base; sites and reference chunks reach the reads by bin
        if isinstance(ref_base, DataFrame):
            return B.aligned_bases_binned(r, sites=sites, keep=keep,
                                          reference=chunks_by_index(ref_base, seq_dict))
        b = (B.aligned_bases(r, keep=keep) if sites is None
             else B.aligned_bases_binned(r, sites=sites, keep=keep))
        return b.withColumn("ref_base", ref_base(F.col("ref_pos"), F.col("ref_idx")))

    # one table for all regions, or one per region as the original builds them
    by = ("region", "q", "cyc") if recal_per_region else ("q", "cyc")
    table = B.recal_table(fan_out(reads, known_sites), by=by)
    recal = B.recal_apply(reads, table, group="region" if recal_per_region else None)
    calls = B.call_variants(B.pileup(fan_out(recal, None)), min_qual)
    names = broadcast_checked(seq_dict.select("ref_idx", "ref_name"), "seq_dict")
    reg = broadcast_checked(regions.select("ref_idx", "region"), "regions")
    calls = (calls.join(names, "ref_idx", "inner").join(reg, "ref_idx", "inner")
             .withColumn("line", B.vcf_line(F.col("ref_name")))
             .withColumn("chrom", chrom_number("ref_name"))
             .withColumn("pos", F.col("ref_pos").cast("int")))
    if targets is not None:
        # a read on a target may reach past it: only calls inside the targets stay
        calls = I.interval_restrict(
            calls.withColumn("start0", F.col("ref_pos") - 1).withColumn("end0", F.col("ref_pos")),
            targets, "ref_idx", ("start0", "end0"), ("bstart", "bend")).drop("start0", "end0")
    calls = materialize(calls, "job_calls")
    if region_out is not None:
        write_text_by_region(calls.select("region", "chrom", "pos", F.col("line").alias("value")),
                             f"{region_out}/vcf", "region", ["chrom", "pos", "value"], mode)
    return calls


def _write_region_tables(marked: DataFrame, reads: DataFrame, seq_dict: DataFrame, regions: DataFrame, out: str, mode: str) -> None:
    """Duplicate metrics of all marked reads; covered ranges and realignment targets of those kept."""
    write_by_region(D.duplicate_metrics(marked, ("region", "rg_library")), f"{out}/metrics", mode=mode)
    names = broadcast_checked(seq_dict.select("ref_idx", "ref_name").join(regions.select("ref_idx", "region"), "ref_idx"), "job_names")

    def lines(ranges: DataFrame, folder: str) -> None:
        x = ranges.join(names, "ref_idx").select("region", "ref_idx", "bed_start", F.concat_ws(
            "\t", F.col("ref_name"), F.col("bed_start").cast("string"), F.col("bed_end").cast("string")).alias("value"))
        write_text_by_region(x, f"{out}/{folder}", "region", ["ref_idx", "bed_start", "value"], mode)

    lines(to_bed(I.covered_ranges(reads), "ref_idx").withColumnRenamed("chrom", "ref_idx"), "ranges")
    targets = B.indel_targets(reads)
    lines(targets.select("ref_idx", F.col("start0").alias("bed_start"), F.col("end0").alias("bed_end")), "targets")
